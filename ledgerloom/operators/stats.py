"""Two-sample tests from moments, counts and ranks.

All data work ends in one row of aggregates per test; statistics and p-values are
column arithmetic on that row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.arrays import rank_sum_ways
from ledgerloom.functions.numeric import normal_tail, ratio
from ledgerloom.functions.student import t_two_sided
from ledgerloom.operators.ordering import average_ranks


def two_sample_moments(value: str, group: str, a, b) -> list[Column]:
    """Aggregates n1, m1, v1, n2, m2, v2 of the two samples."""
    columns = []
    for index, label in ((1, a), (2, b)):
        x = F.when(F.col(group) == F.lit(label), F.col(value).cast("double"))
        columns += [
            F.count(x).alias(f"n{index}"),
            F.avg(x).alias(f"m{index}"),
            F.var_samp(x).alias(f"v{index}"),
        ]
    return columns


def student_columns() -> tuple[Column, Column]:
    """t and degrees of freedom with a pooled variance, from moment columns."""
    n1, n2 = F.col("n1"), F.col("n2")
    freedom = (n1 + n2 - 2).cast("double")
    pooled = ratio((n1 - 1) * F.col("v1") + (n2 - 1) * F.col("v2"), freedom)
    error = F.sqrt(pooled * (ratio(F.lit(1), n1) + ratio(F.lit(1), n2)))
    return ratio(F.col("m1") - F.col("m2"), error), freedom


def welch_columns() -> tuple[Column, Column]:
    """t and Satterthwaite degrees of freedom, from moment columns."""
    e1, e2 = ratio(F.col("v1"), F.col("n1")), ratio(F.col("v2"), F.col("n2"))
    spread = e1 + e2
    freedom = ratio(
        spread * spread,
        ratio(e1 * e1, F.col("n1") - 1) + ratio(e2 * e2, F.col("n2") - 1),
    )
    return ratio(F.col("m1") - F.col("m2"), F.sqrt(spread)), freedom


def t_test(
    df: DataFrame, value: str, group: str, a, b, equal_var: bool = True, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Student's (or Welch's) t test of sample ``a`` against ``b``, one row per key group."""
    moments = df.groupBy(*keys).agg(*two_sample_moments(value, group, a, b))
    t, freedom = student_columns() if equal_var else welch_columns()
    scored = moments.withColumn("t", t).withColumn("df", freedom)
    return scored.withColumn("p_value", t_two_sided("t", "df")).select(
        *keys, "n1", "n2", "m1", "m2", "t", "df", "p_value"
    )


def normality_test(df: DataFrame, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Omnibus K2 test of D'Agostino and Pearson: skewness part, kurtosis part, sum, p."""
    x = F.col(value).cast("double")
    moments = df.groupBy(*keys).agg(
        F.count(x).alias("n"), F.skewness(x).alias("g"), (F.kurtosis(x) + 3).alias("b")
    )
    n = F.col("n").cast("double")
    # Skewness (D'Agostino 1970).  A zero is replaced by one as in common practice.
    raw = F.col("g") * F.sqrt(ratio((n + 1) * (n + 3), 6 * (n - 2)))
    y = F.when(raw == 0, F.lit(1.0)).otherwise(raw)
    beta = ratio(
        3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3), (n - 2) * (n + 5) * (n + 7) * (n + 9)
    )
    w2 = F.sqrt(2 * (beta - 1)) - 1
    delta = ratio(F.lit(1), F.sqrt(F.lit(0.5) * F.log(w2)))
    z_skew = delta * F.asinh(y / F.sqrt(ratio(F.lit(2), w2 - 1)))
    # Kurtosis (Anscombe and Glynn 1983).
    expected = 3 * (n - 1) / (n + 1)
    variance = ratio(24 * n * (n - 2) * (n - 3), (n + 1) * (n + 1) * (n + 3) * (n + 5))
    x_std = ratio(F.col("b") - expected, F.sqrt(variance))
    root = (
        ratio(6 * (n * n - 5 * n + 2), (n + 7) * (n + 9))
        * F.sqrt(ratio(6 * (n + 3) * (n + 5), n * (n - 2) * (n - 3)))
    )
    a = 6 + ratio(F.lit(8), root) * (
        ratio(F.lit(2), root) + F.sqrt(1 + ratio(F.lit(4), root * root))
    )
    shrink = 2 / (9 * a)
    inner = ratio(1 - 2 / a, 1 + x_std * F.sqrt(2 / (a - 4)))
    z_kurt = (1 - shrink - F.cbrt(inner)) / F.sqrt(shrink)
    return (
        moments.withColumn("z_skew", z_skew)
        .withColumn("z_kurt", z_kurt)
        .withColumn("k2", F.col("z_skew") * F.col("z_skew") + F.col("z_kurt") * F.col("z_kurt"))
        .withColumn("p_value", F.exp(-F.col("k2") / 2))
        .select(*keys, "n", "z_skew", "z_kurt", "k2", "p_value")
    )


def contingency(df: DataFrame, group: str, flag: Column, a, b) -> DataFrame:
    """2x2 counts in one row: a_yes, a_no, b_yes, b_no.  ``flag`` is true, false or NULL."""
    cells = []
    for name, label in (("a", a), ("b", b)):
        here = F.col(group) == F.lit(label)
        cells += [
            F.count_if(here & flag).alias(f"{name}_yes"),
            F.count_if(here & ~flag).alias(f"{name}_no"),
        ]
    return df.agg(*cells)


def chi_square(table: DataFrame, correction: bool = True) -> DataFrame:
    """Chi-square test of a 2x2 table (Yates-corrected), with the expected counts."""
    names = ("a_yes", "a_no", "b_yes", "b_no")
    cell = {name: F.col(name).cast("double") for name in names}
    total = sum(cell.values(), F.lit(0.0))
    sides = {
        "a": cell["a_yes"] + cell["a_no"],
        "b": cell["b_yes"] + cell["b_no"],
        "yes": cell["a_yes"] + cell["b_yes"],
        "no": cell["a_no"] + cell["b_no"],
    }
    statistic, expected = F.lit(0.0), []
    for name in names:
        row, column = name.split("_")
        want = ratio(sides[row] * sides[column], total)
        expected.append(want.alias(f"expected_{name}"))
        distance = F.abs(cell[name] - want)
        if correction:
            distance = distance - F.least(F.lit(0.5), distance)
        statistic = statistic + ratio(distance * distance, want)
    return table.select(
        *names, *expected, statistic.alias("chi2"), F.lit(1).alias("dof")
    ).withColumn("p_value", 2 * normal_tail(F.sqrt("chi2")))


# A sample of at most so many values, without ties, has an exact p-value.
EXACT_SAMPLE = 8


def _exact_tail(u: Column, n1: Column, n2: Column) -> Column:
    """Chance of a U statistic of at least ``u`` where all orders are equally likely."""
    small, large = F.least(n1, n2), F.greatest(n1, n2)
    # U and n1 * n2 - U have one distribution; the lower tail needs its first counts only.
    ways = rank_sum_ways(small, large, n1 * n2 - u)
    orders = F.aggregate(
        F.sequence(F.lit(1), small.cast("int")), F.lit(1.0), lambda total, i: total * (large + i) / i
    )
    return F.aggregate(ways, F.lit(0.0), lambda total, x: total + x) / orders


def mann_whitney(
    df: DataFrame, value: str, group: str, a, b, alternative: str = "two-sided",
    method: str = "auto", keys: Sequence[str] = (),
) -> DataFrame:
    """U test with tie correction and continuity correction: one row, or one per key group.

    ``u`` belongs to sample ``a``.  ``alternative`` is two-sided, greater or less.
    ``method`` is asymptotic (normal), or auto: the exact p-value where the smaller sample
    has at most EXACT_SAMPLE values and no two values are equal; with ``keys`` a column
    ``exact`` tells which.
    Ranks come from value counts in range slices, never from one global sort task.
    """
    keys = list(keys)
    counts = average_ranks(
        df.filter(F.col(group).isin(a, b)),
        value,
        {
            "na": F.when(F.col(group) == F.lit(a), 1).otherwise(0),
            "nb": F.when(F.col(group) == F.lit(b), 1).otherwise(0),
        },
        keys,
    )
    tie = F.col("ties").cast("double")
    sums = counts.groupBy(*keys).agg(
        F.sum("na").cast("double").alias("n1"),
        F.sum("nb").cast("double").alias("n2"),
        F.sum(F.col("na") * F.col("average_rank")).alias("rank_sum"),
        F.sum(tie * tie * tie - tie).alias("tie_sum"),
    )
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    mean = n1 * n2 / 2
    u1 = F.col("rank_sum") - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n2 / 12 * ((n + 1) - ratio(F.col("tie_sum"), n * (n - 1))))
    if alternative == "two-sided":
        side, factor = F.greatest(u1, n1 * n2 - u1), 2.0
    elif alternative == "greater":
        side, factor = u1, 1.0
    elif alternative == "less":
        side, factor = n1 * n2 - u1, 1.0
    else:
        raise ValueError(f"unknown alternative {alternative!r}")
    z = ratio(side - mean - F.lit(0.5), sd)
    tail = normal_tail(F.col("z"))
    if method == "auto":
        few = F.least(n1, n2).between(1, EXACT_SAMPLE) & (F.col("tie_sum") == 0)
        tail = F.when(F.col("exact"), _exact_tail(F.col("side"), n1, n2)).otherwise(tail)
    elif method == "asymptotic":
        few = F.lit(False)
    else:
        raise ValueError(f"unknown method {method!r}")
    return (
        sums.withColumns({"u": u1, "z": z, "side": side, "exact": few})
        .withColumn("p_value", F.least(F.lit(1.0), F.lit(factor) * tail))
        .select(*keys, F.col("n1").cast("long"), F.col("n2").cast("long"), "u", "z", "p_value", *(["exact"] if keys else []))
    )

