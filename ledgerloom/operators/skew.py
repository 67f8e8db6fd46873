"""Equality joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import shuffle_width

SALT = "__salt"
# Items the frequency sketch follows: its error is a few of these parts of all rows.
SKETCH_ITEMS = 20_000
# Rows of a large join or aggregate in one task, on average.
TASK_ROWS = 1 << 18


def task_count(spark: SparkSession, rows: int | None) -> int | None:
    """Number of tasks for so many rows; None if Spark's own choice will do.

    Spark keeps its number of shuffle partitions, or merges them, whatever the table's
    size, so the memory of one task would grow with the table.
    """
    if rows is None or rows <= TASK_ROWS:
        return None
    return max(shuffle_width(spark), math.ceil(rows / TASK_ROWS))


def top_hashes(on: str, width: int) -> Column:
    """Aggregate of the most frequent hashes of the (comma-joined) columns, with counts."""
    return F.expr(f"approx_top_k(xxhash64({on}), {width}, {max(SKETCH_ITEMS, 16 * width)})")


def heavy_of(counts: dict[int, int], rows: int, width: int) -> dict[int, int]:
    """Number of salts of the hashes with more than one partition's share of the rows.

    Numbers are rounded up to powers of two, so that few different ones occur; they add
    up to less than four times the number of partitions, whatever the data.
    """
    share = max(rows / width, 1.0)
    return {
        item: 1 << (math.ceil(count / share) - 1).bit_length()
        for item, count in counts.items()
        if count > share
    }


def heavy_keys(df: DataFrame, on: list[str], width: int | None = None) -> dict[int, int]:
    """Hashes of the keys that hold more than one partition's share, with a number of salts.

    One pass over the key columns with a mergeable frequent-items sketch of fixed size;
    its result is one row.  Fewer keys than shuffle partitions can pass.  The counts only
    steer the balance, so their small error never changes a result.  ``width`` is the number
    of partitions, if it is not the session's.
    """
    width = width or shuffle_width(df.sparkSession)
    names = ", ".join(f"`{name}`" for name in on)
    found = df.agg(
        F.count(F.lit(1)).alias("rows"), top_hashes(names, width).alias("top")
    ).first()
    counts = {item["item"]: item["count"] for item in found["top"] or []}
    return heavy_of(counts, found["rows"], width)


def _fan(on: list[str], heavy: dict[int, int]) -> Column:
    """Number of salts of a row's key: a set lookup for each different number."""
    hashed, fan = F.xxhash64(*on), F.lit(1)
    for salts in sorted(set(heavy.values())):
        keys = [key for key, own in heavy.items() if own == salts]
        fan = F.when(hashed.isin(keys), F.lit(salts)).otherwise(fan)
    return fan


def _dealt(df: DataFrame, keys: list[str], tasks: int | None) -> DataFrame:
    return df.repartition(tasks, *keys) if tasks else df


def skew_safe_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    sketch_of: DataFrame | None = None,
    heavy: dict[int, int] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Join many ``left`` rows to few ``right`` rows per key.

    Rows of a heavy left key are spread over salts in proportion to their number, and
    the matching right rows are copied once per salt; without heavy keys it is a plain
    join.  ``how`` is inner, left, left_semi or left_anti.  ``sketch_of`` is a cheaper
    table with the same keys to look for heavy ones in; ``heavy`` is what such a look found.
    With ``rows``, about the number of left rows, many rows get tasks in proportion.
    """
    tasks = task_count(left.sparkSession, rows)
    if heavy is None:
        heavy = heavy_keys(left if sketch_of is None else sketch_of, on, tasks)
    if not heavy:
        return _dealt(left, on, tasks).join(_dealt(right, on, tasks), on, how)
    fan = _fan(on, heavy)
    scatter = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), fan).cast("int")
    salts = F.explode(F.sequence(F.lit(0), fan - 1))
    keys = [*on, SALT]
    left = _dealt(left.withColumn(SALT, scatter), keys, tasks)
    return left.join(_dealt(right.withColumn(SALT, salts), keys, tasks), keys, how).drop(SALT)
