"""Global order without a global window: running counts, ranks and exact quantiles.

A window without a partition key would send every row to one task.  Instead equal
values are counted first, the distinct values are range-partitioned, each slice is
summed, and only the slice totals are accumulated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import reliable_checkpoint

SLICE = "__slice"
# Rank error of a sketch as a part of all rows is 1 / accuracy; a bracket reaches so many
# errors to both sides.
SKETCH_ACCURACY, BRACKET_ERRORS = 10_000, 2


def running_counts(
    df: DataFrame, value: str, weights: Mapping[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Per distinct (keys, value): summed weights, the sums before it, and the group total.

    Columns: keys, value, and for every weight ``w``: ``w``, ``w_before``, ``w_total``.
    NULL values are left out.  The range-partitioned counts are checkpointed, because
    the slice number of a row must not change when a lost task runs again.
    """
    keys = list(keys)
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(*[F.sum(weight).alias(name) for name, weight in weights.items()])
    )
    sliced = reliable_checkpoint(
        counted.repartitionByRange(*keys, value).withColumn(SLICE, F.spark_partition_id())
    )
    earlier = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy(SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    # One row per slice and key: at most one per shuffle partition for each key.
    totals = sliced.groupBy(*keys, SLICE).agg(
        *[F.sum(name).alias(f"{name}_slice") for name in weights]
    )
    offsets = totals.select(
        *keys,
        SLICE,
        *[
            F.coalesce(F.sum(f"{name}_slice").over(earlier), F.lit(0)).alias(f"{name}_offset")
            for name in weights
        ],
        *[F.sum(f"{name}_slice").over(whole).alias(f"{name}_total") for name in weights],
    )
    inside = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return sliced.join(offsets, [*keys, SLICE]).select(
        *keys,
        value,
        *weights,
        *[
            (F.sum(name).over(inside) - F.col(name) + F.col(f"{name}_offset")).alias(
                f"{name}_before"
            )
            for name in weights
        ],
        *[f"{name}_total" for name in weights],
    )


def quantiles_from_counts(
    counts: DataFrame,
    value: str,
    probabilities: Sequence[float],
    weight: str = "n",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Exact quantiles (linear interpolation) of running counts: one row per key group.

    Columns: keys, ``n_rows`` and ``q0``, ``q1``, ... in the order of ``probabilities``.
    """
    before, total = F.col(f"{weight}_before"), F.col(f"{weight}_total")
    picks = []
    for i, probability in enumerate(probabilities):
        position = (total - 1) * F.lit(float(probability))
        for side, index in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (before <= index) & (index < before + F.col(weight))
            picks.append(F.max(F.when(here, F.col(value))).alias(f"{side}{i}"))
    picked = counts.groupBy(*keys).agg(F.max(total).alias("n_rows"), *picks)
    results = []
    for i, probability in enumerate(probabilities):
        position = (F.col("n_rows") - 1) * F.lit(float(probability))
        low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        results.append((low + (high - low) * (position - F.floor(position))).alias(f"q{i}"))
    return picked.select(*keys, "n_rows", *results)


def _brackets(
    df: DataFrame, value: str, probabilities: Sequence[float], keys: Sequence[str]
) -> DataFrame:
    """Per key group the values ``low`` and ``high`` between which each quantile must lie.

    From one mergeable sketch; a limit at an end of the order is NULL, for none.
    """
    reach = BRACKET_ERRORS / SKETCH_ACCURACY
    edges = sorted({edge for p in probabilities for edge in (p - reach, p + reach) if 0 < edge < 1})
    sketch = F.percentile_approx(value, edges or [0.5], SKETCH_ACCURACY)
    found = df.groupBy(*keys).agg(sketch.alias("__q"))

    def limits(sign: int) -> Column:
        picks = [p + sign * reach for p in probabilities]
        none = F.lit(None).cast(df.schema[value].dataType)
        return F.array(*[F.col("__q")[edges.index(x)] if 0 < x < 1 else none for x in picks])

    return found.select(*keys, limits(-1).alias("__low"), limits(1).alias("__high"))


def _narrowed(
    df: DataFrame, value: str, probabilities: Sequence[float], keys: Sequence[str]
) -> DataFrame:
    """Running counts in which only values between two brackets' limits are told apart.

    All values between one bracket and the next are a single NULL with their number, so
    the shuffle holds the rows inside the brackets and a few more per partition.
    """
    brackets = reliable_checkpoint(_brackets(df, value, probabilities, keys))
    if keys:  # one row per group; its written size decides how it is joined
        bounded = df.join(brackets, list(keys))
        lows, highs = ([F.col(f"__{side}")[i] for i in range(len(probabilities))] for side in ("low", "high"))
    else:
        row = brackets.first()
        kind = df.schema[value].dataType
        bounded = df
        lows, highs = ([F.lit(x).cast(kind) for x in row[side]] for side in ("__low", "__high"))
    v = F.col(value)
    inside = [
        F.coalesce(v >= low, F.lit(True)) & F.coalesce(v <= high, F.lit(True)) for low, high in zip(lows, highs)
    ]
    # Brackets that end below a value; a value outside all is smaller than those inside
    # the brackets that are left.
    passed = sum((F.coalesce(v > high, F.lit(False)).cast("int") for high in highs), F.lit(0))
    place = F.struct(passed.alias("passed"), F.when(reduce(Column.__or__, inside), v).alias("value"))
    folded = bounded.filter(v.isNotNull()).select(*keys, place.alias("__place"))
    counts = running_counts(folded, "__place", {"n": F.lit(1)}, keys)
    return counts.withColumn(value, F.col("__place.value")).drop("__place")


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles of a column, per key group, by narrowing.

    A sketch brackets every wanted rank, then one pass counts the rows around the brackets
    and keeps only the values inside, so what is shuffled grows with the error of the
    sketch, not with the distinct values.  A group whose rank the sketch should have missed
    is counted in full: the result never depends on the sketch.
    """
    keys = list(keys)
    rows = df.select(*keys, value)
    narrow = quantiles_from_counts(_narrowed(rows, value, probabilities, keys), value, probabilities, "n", keys)
    if rows.schema[value].dataType.typeName() in ("float", "double"):
        narrow = narrow.withColumn("__missed", reduce(Column.__or__, [
            F.col(f"q{i}").isNull() | F.isnan(f"q{i}") for i in range(len(probabilities))
        ]))
    else:
        narrow = narrow.withColumn("__missed", reduce(Column.__or__, [
            F.col(f"q{i}").isNull() for i in range(len(probabilities))
        ]))
    found = reliable_checkpoint(narrow)  # one row per group
    missed = found.filter(F.col("__missed") & (F.col("n_rows") > 0))
    if missed.isEmpty():
        return found.drop("__missed")
    again = rows.join(missed.select(*keys), keys, "left_semi") if keys else rows
    full = quantiles_from_counts(
        running_counts(again, value, {"n": F.lit(1)}, keys), value, probabilities, "n", keys
    )
    return found.filter(~F.col("__missed") | (F.col("n_rows") == 0)).drop("__missed").unionByName(full)


def approximate_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    keys: Sequence[str] = (),
    accuracy: int = 10000,
) -> DataFrame:
    """One-pass sketch with the columns of ``exact_quantiles``; rank error 1/accuracy."""
    sketch = F.percentile_approx(value, list(probabilities), accuracy)
    return (
        df.groupBy(*keys)
        .agg(F.count(value).alias("n_rows"), sketch.alias("__q"))
        .select(
            *keys,
            "n_rows",
            *[F.col("__q")[i].cast("double").alias(f"q{i}") for i in range(len(probabilities))],
        )
    )


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], exact: bool = True
) -> DataFrame:
    """Quantiles of several numeric columns in one pass: one row per ``column_name``."""
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("column_name"), F.col(name).cast("double").alias("v")
                    )
                    for name in columns
                ]
            )
        ).alias("cell")
    ).select("cell.*")
    compute = exact_quantiles if exact else approximate_quantiles
    return compute(long, "v", probabilities, ["column_name"])


def average_ranks(
    df: DataFrame, value: str, weights: Mapping[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Distinct values with their counts and the average rank of their ties, per key group.

    ``weights`` counts the rows of each sample; the rank is over all samples pooled.
    """
    counts = running_counts(df, value, weights, keys)
    ties = sum((F.col(name) for name in weights), F.lit(0))
    before = sum((F.col(f"{name}_before") for name in weights), F.lit(0))
    return counts.withColumn("ties", ties).withColumn("average_rank", before + (ties + 1) / 2)
