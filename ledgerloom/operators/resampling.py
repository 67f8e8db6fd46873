"""Bootstrap and repeated sampling, expressed as one replicate-expanded plan.

Each replicate is a pure function of (seed, row key, replicate number), so replicates
need no order, no row numbers and no driver loop.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import normal_tail, ratio
from ledgerloom.functions.sampling import (
    FINE_BITS, binomial_count, place_in, poisson_weight, power_cuts, scattered_place, with_draw,
    with_fine_draw, with_key_hash, with_second_draw,
)
from ledgerloom.operators.aggregates import histogram
from ledgerloom.operators.ordering import quantiles_from_counts, running_counts
from ledgerloom.operators.stats import t_test
from ledgerloom.session import reliable_checkpoint, shuffle_width

REPLICATE = "replicate"
# Half width, in deviations of its rank, of the band that may hold a resample's median.
BAND_SIGMAS = 6.0
# Samples of a block that a row is wanted by on average, at most; with it a list of cuts
# has a few dozen entries.
BLOCK_WANTED = 8


def _with_draw(df: DataFrame) -> DataFrame:
    """The draw of every (row, replicate) pair."""
    return with_draw(df, "__draw", "__h", REPLICATE)


def _expand(df: DataFrame, replicates: int) -> DataFrame:
    """Every row once per replicate, with its draw.

    The rows are spread evenly first: each becomes as many as there are replicates, so one
    shuffle of narrow rows is small beside the work it balances, even from one input split.
    """
    numbers = F.explode(F.sequence(F.lit(1), F.lit(replicates)))
    spread = df.repartition(shuffle_width(df.sparkSession), "__h")
    return _with_draw(spread.withColumn(REPLICATE, numbers))


def _keep(df: DataFrame, column: str, condition: Column) -> DataFrame:
    """Rows that meet a condition on a computed column.

    Written as a generator: a filter would be pushed below the projections and copy the
    whole chain of the column into itself.
    """
    return df.withColumn(column, F.explode(F.when(condition, F.array(F.col(column)))))


def _sides(df: DataFrame, value: str, group: str, key: Column, a, b) -> DataFrame:
    is_a, is_b = F.col(group) == F.lit(a), F.col(group) == F.lit(b)
    return df.filter((is_a | is_b) & F.col(value).isNotNull()).select(
        F.when(is_a, F.lit("a")).otherwise(F.lit("b")).alias("__side"),
        F.col(value).cast("double").alias("__v"),
        key.cast("bigint").alias("__key"),
    )


def _samples(df: DataFrame, value: str, group: str, key: Column, a, b, seed: int) -> DataFrame:
    rows = _sides(df, value, group, key, a, b)
    return with_key_hash(rows, "__h", F.col("__key"), seed).drop("__key")


def _weighted(drawn: DataFrame) -> DataFrame:
    """How many times each replicate picks a row."""
    return drawn.withColumn("__w", poisson_weight(F.col("__draw"))).drop("__draw")


def _picked(drawn: DataFrame) -> DataFrame:
    """Rows picked at least once, with the number of times."""
    return _keep(_weighted(drawn), "__w", F.col("__w") > 0)


def _mean_replicates(weighted: DataFrame) -> DataFrame:
    """Difference of weighted means per replicate: partial sums on the map side only."""
    sides = []
    for side in ("a", "b"):
        here = F.col("__side") == side
        sides += [
            F.sum(F.when(here, F.col("__w") * F.col("__v"))).alias(f"s{side}"),
            F.sum(F.when(here, F.col("__w"))).alias(f"n{side}"),
        ]
    return (
        weighted.groupBy(REPLICATE)
        .agg(*sides)
        .select(
            REPLICATE,
            (ratio(F.col("sa"), F.col("na")) - ratio(F.col("sb"), F.col("nb"))).alias("difference"),
        )
    )


def _counted_weights(samples: DataFrame, replicates: int, seed: int) -> DataFrame:
    """How many times each replicate picks the rows of one key, all at once.

    The weights of ``c`` rows add up to a Poisson count of mean ``c``, which is a sum of
    independent counts, one of mean ``2**k`` for each binary digit of ``c``.  So a replicate
    draws a few times per different value, not per row.  The tables of those counts are
    made for the digits that occur, at most 62.
    """
    spark = samples.sparkSession
    counted = reliable_checkpoint(
        samples.groupBy("__side", "__v", "__key").agg(F.count(F.lit(1)).alias("__c"))
    )
    most = counted.agg(F.max("__c")).first()[0] or 0
    tables = [(k, *power_cuts(k)) for k in range(most.bit_length())]
    cuts = spark.createDataFrame(tables, "__digit int, __least bigint, __cuts array<bigint>")
    digits = F.filter(
        F.sequence(F.lit(0), F.lit(max(most.bit_length() - 1, 0))),
        lambda k: F.getbit(F.col("__c"), k) == 1,
    )
    rows = with_key_hash(counted, "__h", F.col("__key"), seed).withColumn("__digit", F.explode(digits))
    numbers = F.explode(F.sequence(F.lit(1), F.lit(replicates)))
    spread = rows.repartition(shuffle_width(spark), "__h", "__digit").withColumn(REPLICATE, numbers)
    drawn = spread.withColumn("__number", F.col(REPLICATE).cast("bigint") * 64 + F.col("__digit"))
    drawn = with_fine_draw(with_draw(drawn, "__draw", "__h", "__number"), "__fine", "__draw", "__h")
    # At most 62 rows, whose length follows the square root of the largest count.
    longest = max((len(table[2]) for table in tables), default=1)
    weight = F.col("__least") + place_in(F.col("__cuts"), F.col("__fine"), longest)
    return drawn.join(F.broadcast(cuts), "__digit").select("__side", "__v", REPLICATE, weight.alias("__w"))


def _weighted_medians(weighted: DataFrame) -> DataFrame:
    counts = running_counts(weighted, "__v", {"w": F.col("__w")}, [REPLICATE, "__side"])
    return quantiles_from_counts(counts, "__v", (0.5,), "w", [REPLICATE, "__side"]).select(
        REPLICATE, "__side", F.col("q0").alias("median")
    )


def _median_bands(samples: DataFrame) -> DataFrame:
    """Per side the values between which resample medians are expected.

    The rank share of a resample's median has a deviation of about 1/sqrt(n), so the band
    holds a number of rows that grows with sqrt(n) only.
    """
    counted = samples.groupBy("__side").agg(F.count("__v").alias("n"))
    wanted, accuracy = {}, 10_000
    for side, n in counted.collect():  # two rows
        half = min(BAND_SIGMAS / math.sqrt(n), 0.5) if n else 0.5
        wanted[side] = (0.5 - half, 0.5 + half)
        accuracy = max(accuracy, math.ceil(10 / half))
    shares = sorted({share for pair in wanted.values() for share in pair}) or [0.5]
    sketch = samples.groupBy("__side").agg(
        F.percentile_approx("__v", shares, min(accuracy, 2**31 - 1)).alias("__q")
    )
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for side, (below, above) in wanted.items():
        here = F.col("__side") == side
        if below > 0:
            low = F.when(here, F.col("__q")[shares.index(below)]).otherwise(low)
            high = F.when(here, F.col("__q")[shares.index(above)]).otherwise(high)
    return sketch.select("__side", low.alias("low"), high.alias("high"))


def _median_replicates(samples: DataFrame, replicates: int) -> DataFrame:
    """Difference of resample medians.

    Values far from the median only matter by their number, so they are folded into one
    value per side before the shuffle.  Where a resample's median falls outside the band
    (checked for every replicate) that replicate is computed again from all its rows.
    """
    bands = F.broadcast(_median_bands(samples))  # two rows
    outside_low, outside_high = F.lit(float("-inf")), F.lit(float("inf"))
    folded = samples.join(bands, "__side").withColumn(
        "__v",
        F.when(F.col("__v") < F.col("low"), outside_low)
        .when(F.col("__v") > F.col("high"), outside_high)
        .otherwise(F.col("__v")),
    )
    quick = reliable_checkpoint(_weighted_medians(_picked(_expand(folded, replicates))))
    inside = F.abs("median") < F.lit(float("inf"))  # false for infinite and NaN medians
    medians = quick.filter(inside)
    missed = quick.filter(~inside).select(REPLICATE, "__side")
    if not missed.isEmpty():
        # At most two rows per replicate, and none in practice.
        again = _picked(_with_draw(samples.join(F.broadcast(missed), "__side")))
        medians = medians.unionByName(_weighted_medians(again))
    return _side_difference(medians)


def _side_difference(medians: DataFrame) -> DataFrame:
    return (
        medians.groupBy(REPLICATE)
        .agg(
            F.max(F.when(F.col("__side") == "a", F.col("median"))).alias("a"),
            F.max(F.when(F.col("__side") == "b", F.col("median"))).alias("b"),
        )
        .select(REPLICATE, (F.col("a") - F.col("b")).alias("difference"))
    )


def bootstrap_replicates(
    df: DataFrame,
    value: str,
    group: str,
    a,
    b,
    key: Column,
    replicates: int = 1000,
    statistic: str = "mean",
    seed: int = 1,
    equal_values: bool = False,
) -> DataFrame:
    """Statistic of ``a`` minus statistic of ``b`` for every resample.

    Sampling with replacement is a Poisson(1) weight per row and replicate (the Poisson
    bootstrap): resample sizes vary by about sqrt(n), which keeps the plan free of
    row numbering.  ``key`` must identify a row and be a whole number.

    With ``equal_values`` the key identifies a value instead, and all rows of a side with one
    value are drawn together: the same law, for work in proportion to the different values.
    """
    if statistic not in ("mean", "median"):
        raise ValueError(f"unknown statistic {statistic!r}")
    if equal_values:
        weighted = _counted_weights(_sides(df, value, group, key, a, b), replicates, seed)
        if statistic == "mean":
            return _mean_replicates(weighted)
        return _side_difference(_weighted_medians(weighted.filter(F.col("__w") > 0)))
    samples = _samples(df, value, group, key, a, b, seed)
    if statistic == "mean":
        return _mean_replicates(_weighted(_expand(samples, replicates)))
    return _median_replicates(samples, replicates)


def bootstrap_summary(replicates: DataFrame, level: float = 0.95) -> DataFrame:
    """Interval, normal p-value and zero-inside test (one row for bounded replicates)."""
    tail = (1 - level) / 2
    summary = replicates.agg(
        F.count("difference").alias("n_replicates"),
        F.avg("difference").alias("mean"),
        F.stddev_pop("difference").alias("sd"),
        F.percentile("difference", F.lit(tail)).alias("ci_low"),
        F.percentile("difference", F.lit(1 - tail)).alias("ci_high"),
    )
    return summary.withColumn(
        "p_value", 2 * normal_tail(F.abs(ratio(F.col("mean"), F.col("sd"))))
    ).withColumn("zero_inside", (F.col("ci_low") <= 0) & (F.col("ci_high") >= 0))


def bootstrap_histogram(replicates: DataFrame, bins: int = 50, level: float = 0.95) -> DataFrame:
    """Histogram of the replicates with the bins outside the interval marked."""
    summary = bootstrap_summary(replicates, level).select(F.struct("ci_low", "ci_high").alias("s"))
    bars = histogram(replicates, "difference", bins).withColumn("__ci", summary.scalar())
    outside = (F.col("bin_left") <= F.col("__ci.ci_low")) | (
        F.col("bin_left") >= F.col("__ci.ci_high")
    )
    return bars.withColumn("tail", outside).drop("__ci")


def _wanted_by(
    rows: DataFrame, strata: str, shares: dict, replicates: int
) -> DataFrame:
    """Every row once per replicate that wants it, each with the chance of the row's stratum.

    Replicates are cut into blocks of a power of two.  A row draws once per block how many
    of its replicates want it (binomial), and only these are made; a one-to-one scatter of
    0, 1, 2, ... says which.  That is the law of a draw per row and replicate, for work in
    proportion to the rows and the wanted ones: with rare wants one draw serves them all.
    """
    bits = (replicates - 1).bit_length()
    most = max(shares.values(), default=1.0)
    bits = max(0, min(bits, math.floor(math.log2(BLOCK_WANTED / most))))
    blocks = -(-replicates >> bits)
    if blocks > 1:  # rows are multiplied: deal them evenly first, even from one input split
        rows = rows.repartition(shuffle_width(rows.sparkSession), "__h")
    block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))) if blocks > 1 else F.lit(0)
    # Blocks draw by negative numbers, replicates by positive ones.
    drawn = rows.withColumn("__block", block).withColumn("__number", -1 - F.col("__block"))
    drawn = with_draw(drawn, "__draw", "__h", "__number")
    drawn = with_fine_draw(drawn, "__fine", "__draw", "__h")
    count = F.lit(0)
    for label, share in shares.items():
        count = F.when(F.col(strata) == F.lit(label), binomial_count(F.col("__fine"), 1 << bits, share)).otherwise(count)
    drawn = drawn.withColumn("__count", count)
    each = F.explode(F.when(F.col("__count") > 0, F.sequence(F.lit(0), F.col("__count") - 1)))
    drawn = with_second_draw(drawn, "__key", "__other", "__draw", "__h").withColumn("__place", each)
    place = scattered_place(F.col("__place").cast("bigint"), F.col("__key"), F.col("__other"), bits)
    number = (F.col("__block") * F.lit(1 << bits) + place + 1).cast("int")
    found = drawn.withColumn(REPLICATE, number)
    if blocks << bits != replicates:
        found = _keep(found, REPLICATE, F.col(REPLICATE) <= replicates)
    return found.drop("__block", "__number", "__draw", "__fine", "__count", "__key", "__other", "__place")


def repeated_samples(
    df: DataFrame,
    strata: str,
    labels: Sequence,
    key: str,
    size: int,
    replicates: int,
    seed: int = 1,
) -> DataFrame:
    """``size`` rows without replacement from each labelled stratum, once per replicate.

    Each replicate first wants every row by chance, with a chance that nearly always gives
    it more than ``size`` rows, and keeps those with the smallest draws of 53 bits (all
    rows when the stratum is smaller); equal draws are ordered by the other half of the
    row's hash.  Only wanted rows are ever made, so the work is in proportion to the rows
    and the samples.  Samples that chance left short are taken again from a draw per row,
    with a limit ten times as high, until none is short: every sample has its exact size
    and each set of rows the same chance.
    """
    rows = with_key_hash(
        df.filter(F.col(strata).isin(list(labels))), "__h", F.col(key), seed
    )
    # One row per label.
    sizes = rows.groupBy(strata).agg(F.count(F.lit(1)).alias("__n"))
    counts = dict(sizes.select(strata, "__n").collect())
    target = F.least(F.col("__n"), F.lit(size))
    wanted = sizes.select(
        strata, "__n", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias(REPLICATE)
    )
    order = Window.partitionBy(REPLICATE, strata).orderBy("__draw", "__h_b", key)
    spare, short, parts = size + 8 * math.sqrt(size) + 20, None, []
    while True:
        if short is None:
            shares = {label: min(1.0, spare / n) for label, n in counts.items()}
            expanded = _with_draw(_wanted_by(rows, strata, shares, replicates))
            fine = with_fine_draw(expanded, "__draw", "__draw", "__h")
        else:  # at most one row per replicate and label, and none in practice
            limit = (F.lit(float(spare)) / F.col("__n") * F.lit(float(1 << FINE_BITS))).alias("__limit")
            asked = short.join(sizes.select(strata, limit), strata).select(REPLICATE, strata, "__limit")
            expanded = _with_draw(rows.join(F.broadcast(asked), strata))
            fine = with_fine_draw(expanded, "__draw", "__draw", "__h")
            fine = _keep(fine, "__draw", F.col("__draw") < F.col("__limit"))
        few = reliable_checkpoint(fine.select(*df.columns, REPLICATE, "__draw", "__h_b"))
        reached = few.groupBy(REPLICATE, strata).agg(F.count(F.lit(1)).alias("__got"))
        asked = wanted if short is None else short
        cut_short = (
            asked.join(reached, [REPLICATE, strata], "left")
            .filter(F.coalesce(F.col("__got"), F.lit(0)) < target)
            .select(*asked.columns)
        )
        ranked = few.withColumn("__rank", F.row_number().over(order))
        taken = ranked.filter(F.col("__rank") <= size).select(*df.columns, REPLICATE)
        if cut_short.isEmpty():
            return reduce(DataFrame.unionByName, [*parts, taken])
        short = reliable_checkpoint(cut_short)
        again = F.broadcast(short.select(REPLICATE, strata))
        parts.append(
            taken.join(again, [REPLICATE, strata], "left_anti").select(*taken.columns)
        )
        spare *= 10


def aa_simulation(
    df: DataFrame,
    value: str,
    group: str,
    a,
    b,
    key: str,
    size: int = 1000,
    simulations: int = 1000,
    seed: int = 1,
) -> DataFrame:
    """Welch tests of repeated samples of two variants that should not differ."""
    both = df.select(key, group, value)
    sampled = repeated_samples(both, group, [a, b], key, size, simulations, seed)
    return t_test(sampled, value, group, a, b, equal_var=False, keys=(REPLICATE,))


def false_positive_rate(simulated: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Share of simulations that call a difference (one row)."""
    return simulated.agg(
        F.count(F.lit(1)).alias("simulations"),
        F.avg((F.col("p_value") < alpha).cast("double")).alias("fpr"),
    )
