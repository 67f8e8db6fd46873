"""Counts, histograms, pivots and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import ratio


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value, largest first; NULL values are left out."""
    return (
        df.dropna(subset=list(columns))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), *columns)
    )


def mean_of_counts(df: DataFrame, key: Column, counted: str, name: str) -> DataFrame:
    """Mean over groups of the non-NULL count per group (one row)."""
    per_key = (
        df.select(key.alias("__k"), counted)
        .filter(F.col("__k").isNotNull())
        .groupBy("__k")
        .agg(F.count(counted).alias("n"))
    )
    return per_key.agg(F.avg("n").alias(name))


def top_value_per_key(
    df: DataFrame, key: str, value: str, values: Sequence[str], amount: Column, result: str = "n"
) -> DataFrame:
    """Per key the value with the largest summed amount; ties go to the first name.

    ``values`` are all names that occur, a short list.  One hash aggregate sums every name
    per key, so the rows are shuffled once, after the map side has summed them.
    """
    names = sorted(values)
    sums = [
        F.sum(F.when(F.col(value) == name, amount)).alias(f"__n{i}") for i, name in enumerate(names)
    ]
    per_key = df.filter(F.col(value).isin(names)).groupBy(key).agg(*sums)
    best = F.greatest(*[F.col(f"__n{i}") for i in range(len(names))])
    name = F.coalesce(*[F.when(F.col(f"__n{i}") == best, F.lit(n)) for i, n in enumerate(names)])
    return per_key.select(key, name.alias(value), best.alias(result))


def histogram(
    df: DataFrame,
    value: str,
    bins: int = 50,
    by: str | None = None,
    labels: Sequence = (),
    density: bool = False,
) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last bin closed.

    With ``by`` one histogram per listed label.  Returns ``by``, ``bin`` (from 1),
    ``bin_left``, ``bin_right``, ``n`` for non-empty bins and with ``density`` the count
    divided by rows and width.
    """
    keys = [by] if by else []
    data = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("v"))
    if by:
        data = data.filter(F.col(by).isin(list(labels)))
    # A single value gets a range of one around it, as numpy does.
    pad = F.when(F.min("v") == F.max("v"), F.lit(0.5)).otherwise(F.lit(0.0))
    limits = data.groupBy(*keys).agg(
        (F.min("v") - pad).alias("lo"), (F.max("v") + pad).alias("hi"), F.count("v").alias("rows")
    )
    if by:
        joined = data.join(F.broadcast(limits), by)  # one row per label
    else:
        one = limits.select(F.struct("lo", "hi", "rows").alias("s")).scalar()
        joined = data.withColumn("__s", one).select("v", "__s.*")
    place = F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1
    counted = (
        joined.withColumn("bin", F.least(place, F.lit(bins)).cast("int"))
        .groupBy(*keys, "bin", "lo", "hi", "rows")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    step = (F.col("hi") - F.col("lo")) / bins
    columns = [
        *[F.col(k) for k in keys],
        F.col("bin"),
        (F.col("lo") + step * (F.col("bin") - 1)).alias("bin_left"),
        (F.col("lo") + step * F.col("bin")).alias("bin_right"),
        F.col("n"),
    ]
    if density:
        columns.append(ratio(F.col("n"), F.col("rows") * step).alias("density"))
    return counted.select(*columns)


def pivot_counts(
    df: DataFrame, index: str, column: str, value: str, wanted: Sequence[int], prefix: str
) -> DataFrame:
    """Wide table with one column per wanted value; the list is given, so no extra job runs."""
    wide = df.groupBy(index).pivot(column, list(wanted)).agg(F.max(value))
    return wide.select(index, *[F.col(str(w)).alias(f"{prefix}{w}") for w in wanted])


def category_bars(df: DataFrame, category: str, hue: str | None = None, mean_of: str | None = None):
    """Chart data of a bar plot: rows, or the mean of a column, per category (and hue)."""
    keys = [category] + ([hue] if hue else [])
    bar = F.avg(mean_of).alias("bar") if mean_of else F.count(F.lit(1)).alias("bar")
    return df.dropna(subset=keys).groupBy(*keys).agg(bar)
