"""Operators on small tables with known answers, and against brute force."""

import itertools
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerloom.functions import arrays, sampling
from ledgerloom.operators import (
    aggregates, forest, graph, models, ordering, pages, quality, resampling, skew, stats,
)
from ledgerloom.session import reliable_checkpoint


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, how):
    random.seed(1)
    left = [(7 if i % 3 == 0 else random.randrange(50), i) for i in range(3000)]
    left += [(None, 5000 + i) for i in range(700)]
    right = [(k, k * 10) for k in range(0, 40)] + [(7, 71)]
    a = spark.createDataFrame(left, "k int, x int")
    b = spark.createDataFrame(right, "k int, y int")
    heavy = skew.heavy_keys(a, ["k"])
    assert heavy and all(fan > 1 for fan in heavy.values())
    assert len(heavy) < 4 and sum(heavy.values()) < 16
    got = skew.skew_safe_join(a, b, ["k"], how)
    assert "__salt" in got._jdf.queryExecution().analyzed().toString()
    want = a.join(b, ["k"], how)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_heavy_means_a_share_of_the_rows(spark):
    one_key = spark.createDataFrame([(1,)] * 100, "k int")
    assert list(skew.heavy_keys(one_key, ["k"]).values()) == [4]
    assert skew.heavy_keys(spark.range(100).withColumnRenamed("id", "k"), ["k"]) == {}
    assert skew.heavy_keys(one_key.limit(0), ["k"]) == {}
    assert skew.heavy_of({1: 30, 2: 26, 3: 25}, 100, 4) == {1: 2, 2: 2}


@pytest.fixture(params=["one slice", "many slices"])
def slices(request, spark):
    """Small data makes one slice; without coalescing every shuffle partition is one."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, str(request.param == "one slice").lower())
    yield request.param
    spark.conf.unset(name)


def test_running_counts_ranks_and_quantiles(spark, slices):
    random.seed(2)
    data = [(random.choice("ab"), float(int(random.gauss(0, 20)))) for _ in range(4000)]
    df = spark.createDataFrame(data, "g string, v double")
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = ordering.exact_quantiles(df, "v", probabilities, ["g"]).collect()
    for row in got:
        sample = pd.Series([v for g, v in data if g == row["g"]])
        assert row["n_rows"] == len(sample)
        for i, p in enumerate(probabilities):
            assert row[f"q{i}"] == pytest.approx(sample.quantile(p), abs=1e-12)
    counts = ordering.running_counts(df, "v", {"n": F.lit(1)}, ["g"])
    assert counts.filter("n_before + n > n_total").isEmpty()
    ranks = ordering.average_ranks(df, "v", {"n": F.lit(1)}).collect()
    want = pd.Series([v for _, v in data]).rank()
    expected = dict(zip([v for _, v in data], want))
    assert {r["v"]: r["average_rank"] for r in ranks} == expected


@pytest.mark.parametrize("reach", [2, 0, -3])
def test_quantiles_do_not_depend_on_the_sketch(spark, monkeypatch, reach):
    # Without reach, or with limits on the wrong sides, ranks are missed and counted in full.
    monkeypatch.setattr(ordering, "BRACKET_ERRORS", reach)
    monkeypatch.setattr(ordering, "SKETCH_ACCURACY", 50)
    rng = random.Random(3)
    data = [(g, rng.choice([rng.gauss(0, 1), float(rng.randrange(5))])) for g in "abb" for _ in range(3000)]
    data += [("c", 1.5), ("d", None), ("e", float("inf")), ("e", 1.0), (None, 2.0)]
    df = spark.createDataFrame(data, "g string, v double")
    probabilities = (0.0, 0.013, 0.5, 0.51, 0.999, 1.0)
    for keys in ([], ["g"]):
        got = ordering.exact_quantiles(df, "v", probabilities, keys).collect()
        assert {r["g"] for r in got} == set("abce") if keys else len(got) == 1
        for row in got:
            sample = pd.Series([v for g, v in data if v is not None and (not keys or g == row["g"])])
            assert row["n_rows"] == len(sample)
            for i, p in enumerate(probabilities):
                want = sample.sort_values().reset_index(drop=True)
                place = (len(want) - 1) * p
                low, high = want[math.floor(place)], want[math.ceil(place)]
                assert row[f"q{i}"] == pytest.approx(low + (high - low) * (place - math.floor(place)), abs=1e-12, nan_ok=True)


def test_quantiles_tell_few_values_apart(spark):
    df = spark.range(200_000).select((F.xxhash64("id") / 1e9).alias("v"))
    told = ordering._narrowed(df, "v", (0.2, 0.5, 0.8), [])
    kept, total = told.count(), told.agg(F.sum("n")).first()[0]
    assert total == 200_000 and kept < 3 * 200_000 * 5 * ordering.BRACKET_ERRORS / ordering.SKETCH_ACCURACY
    whole = spark.range(9).select(F.col("id").cast("int").alias("v"))
    assert tuple(ordering.exact_quantiles(whole, "v", (0.0, 0.5, 1.0)).first()) == (9, 0.0, 4.0, 8.0)
    assert ordering.exact_quantiles(whole.limit(0), "v", (0.5,)).collect()[0]["q0"] is None


def test_quantiles_of_one_value_and_sketch(spark):
    df = spark.createDataFrame([(3.0,)], "v double")
    assert tuple(ordering.exact_quantiles(df, "v", (0.2, 0.8)).first()) == (1, 3.0, 3.0)
    many = spark.range(1, 1001).select(F.col("id").cast("double").alias("v"))
    row = ordering.approximate_quantiles(many, "v", (0.5,)).first()
    assert row["q0"] == pytest.approx(500, abs=2)


def test_histogram_keeps_the_maximum(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "v double")
    assert rows(aggregates.histogram(df, "v", 50), "bin", "n") == [(1, 1), (26, 1), (50, 1)]
    flat = spark.createDataFrame([(2.0,)] * 3, "v double")
    bar = aggregates.histogram(flat, "v", 50, density=True).first()
    assert (bar["bin"], bar["n"]) == (26, 3)
    assert bar["density"] == pytest.approx(50.0)


def test_top_value_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [("p", d) for d in ("Tue", "Tue", "Mon", "Mon", "Sun")], "product string, weekday string"
    )
    assert rows(aggregates.top_value_per_key(df, "product", "weekday", ["Mon", "Sun", "Tue"], F.lit(1))) == [("p", "Mon", 2)]


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "k int, s string")
    assert rows(quality.column_profile(df), "column_name", "non_null", "nulls", "data_type") == [
        ("k", 3, 0, "int"), ("s", 2, 1, "string"),
    ]
    assert rows(quality.null_counts(df)) == [("k", 0), ("s", 1)]
    assert quality.key_is_unique(df, "k", "t").first()["is_unique"] is False
    described = quality.describe(df, ["k"]).first()
    series = pd.Series([1, 2, 2])
    assert described["mean"] == pytest.approx(series.mean())
    assert described["std"] == pytest.approx(series.std())
    assert (described["q25"], described["q50"], described["q75"]) == (1.5, 2.0, 2.0)


def test_semi_and_anti_are_complements(spark):
    a = spark.range(10).withColumnRenamed("id", "k")
    b = spark.createDataFrame([(1,), (3,), (3,), (99,)], "j long")
    inside, outside = quality.overlap(a, b, "k", "j"), quality.orphans(a, b, "k", "j")
    assert rows(inside) == [(1,), (3,)]
    assert inside.count() + outside.count() == 10


def sample_frame(spark, first, second):
    data = [("a", float(v)) for v in first] + [("b", float(v)) for v in second]
    return spark.createDataFrame(data, "g string, v double")


def test_normality_published_values(spark):
    def z(values, column):
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        return stats.normality_test(df, "v").first()[column]

    assert z(range(1, 9), "z_skew") == pytest.approx(1.0108048609, abs=1e-9)
    assert z([2, 8, 0, 4, 1, 9, 9, 0], "z_skew") == pytest.approx(0.4462638537, abs=1e-9)
    assert z([1, 2, 3, 4, 5, 6, 7, 8000], "z_skew") == pytest.approx(3.5717735104, abs=1e-9)
    assert z(range(20), "z_kurt") == pytest.approx(-1.7058104152, abs=1e-9)


def exact_u(a, b, alternative):
    """p-value by all ways to pick the first sample's ranks."""
    u = sum(x > y for x in a for y in b)
    ranks = range(len(a) + len(b))
    every = [sum(chosen) - len(a) * (len(a) - 1) // 2 for chosen in itertools.combinations(ranks, len(a))]
    top = {"two-sided": max(u, len(a) * len(b) - u), "greater": u, "less": len(a) * len(b) - u}[alternative]
    share = sum(x >= top for x in every) / len(every)
    return min(1.0, share * (2 if alternative == "two-sided" else 1))


@pytest.mark.parametrize("alternative", ["two-sided", "greater", "less"])
def test_exact_u_against_every_order(spark, alternative):
    rng = random.Random(8)
    groups = {}
    for n1, n2 in [(1, 1), (1, 6), (3, 3), (3, 4), (8, 5), (4, 8), (8, 9), (2, 14), (7, 7)]:
        values = rng.sample(range(1000), n1 + n2)
        groups[f"{n1}x{n2}"] = ([float(x) for x in values[:n1]], [float(x) for x in values[n1:]])
    groups["ties"] = ([1.0, 2.0, 3.0], [3.0, 4.0, 5.0])
    groups["many"] = ([float(x) for x in range(9)], [x + 0.5 for x in range(20)])
    groups["one side"] = ([1.0, 2.0], [])
    data = [(k, side, v) for k, pair in groups.items() for side, some in zip("ab", pair) for v in some]
    df = spark.createDataFrame(data, "k string, g string, v double")
    found = {r["k"]: r for r in stats.mann_whitney(df, "v", "g", "a", "b", alternative, keys=["k"]).collect()}
    normal = {r["k"]: r for r in stats.mann_whitney(df, "v", "g", "a", "b", alternative, "asymptotic", ["k"]).collect()}
    for name, (a, b) in groups.items():
        row = found[name]
        assert (row["n1"], row["n2"]) == (len(a), len(b))
        assert row["exact"] == (name not in ("ties", "many", "one side")) and not normal[name]["exact"]
        if row["exact"]:
            assert row["p_value"] == pytest.approx(exact_u(a, b, alternative), rel=1e-12)
        else:
            assert row["p_value"] == normal[name]["p_value"]


def test_exact_u_published_values(spark):
    # Critical values of the tables: 8 and 10 values, U 17 at 5 % two-sided; 5 and 5, U 2.
    for n1, n2, u in ((8, 10, 17), (5, 5, 2), (4, 4, 0)):
        for k, significant in ((u, True), (u + 1, False)):
            sizes = spark.createDataFrame([(float(n1), float(n2), float(n1 * n2 - k))], "a double, b double, u double")
            p = 2 * sizes.select(stats._exact_tail(F.col("u"), F.col("a"), F.col("b"))).first()[0]
            assert (p <= 0.05) == significant
    # A long second sample: the counts of U add up to all orders, and mirror each other.
    ways = spark.range(1).select(arrays.rank_sum_ways(F.lit(3), F.lit(400), F.lit(1200)).alias("w")).first()["w"]
    assert sum(ways) == math.comb(403, 3) and ways == ways[::-1] and len(ways) == 1201


def test_mann_whitney_published_value(spark):
    df = sample_frame(spark, [19, 22, 16, 29, 24], [20, 11, 17, 12])
    for method, p in (("asymptotic", 0.1113468865), ("auto", 14 / 126)):
        row = stats.mann_whitney(df, "v", "g", "a", "b", method=method).first()
        assert row["u"] == 17
        assert row["p_value"] == pytest.approx(p, abs=1e-9)
        one = stats.mann_whitney(df, "v", "g", "a", "b", "greater", method).first()
        assert one["p_value"] == pytest.approx(p / 2, abs=1e-9)


def test_mann_whitney_with_ties_against_brute_force(spark, slices):
    random.seed(3)
    a = [random.randrange(15) for _ in range(300)]
    b = [random.randrange(1, 17) for _ in range(250)]
    row = stats.mann_whitney(sample_frame(spark, a, b), "v", "g", "a", "b").first()
    u = sum(1.0 if x > y else 0.5 if x == y else 0.0 for x in a for y in b)
    assert row["u"] == u


def test_t_tests(spark):
    df = sample_frame(spark, [1, 2, 3, 4, 9], [2, 2, 5])
    student = stats.t_test(df, "v", "g", "a", "b").first()
    x, y = np.array([1, 2, 3, 4, 9.0]), np.array([2, 2, 5.0])
    pooled = (4 * x.var(ddof=1) + 2 * y.var(ddof=1)) / 6
    assert student["t"] == pytest.approx((x.mean() - y.mean()) / math.sqrt(pooled * (1 / 5 + 1 / 3)))
    welch = stats.t_test(df, "v", "g", "a", "b", equal_var=False).first()
    assert welch["t"] == pytest.approx(
        (x.mean() - y.mean()) / math.sqrt(x.var(ddof=1) / 5 + y.var(ddof=1) / 3)
    )
    assert 0 < welch["p_value"] < 1


def test_chi_square_with_correction(spark):
    table = spark.createDataFrame([(10, 20, 30, 40)], "a_yes int, a_no int, b_yes int, b_no int")
    row = stats.chi_square(table).first()
    assert row["chi2"] == pytest.approx(0.4464285714, abs=1e-9)
    assert row["p_value"] == pytest.approx(0.5040358665, abs=1e-8)


def test_bootstrap_median_equals_brute_force(spark):
    """The folded plan must give the medians of the fully expanded samples."""
    random.seed(4)
    data = [(i, random.choice("ab"), random.lognormvariate(0, 1)) for i in range(1500)]
    df = spark.createDataFrame(data, "k long, g string, v double")
    samples = resampling._samples(df, "v", "g", F.col("k"), "a", "b", 9)
    weighted = resampling._picked(resampling._expand(samples, 5)).collect()
    groups = defaultdict(list)
    for row in weighted:
        groups[(row["replicate"], row["__side"])] += [row["__v"]] * row["__w"]
    want = {r: np.median(groups[(r, "a")]) - np.median(groups[(r, "b")]) for r in range(1, 6)}
    got = resampling.bootstrap_replicates(df, "v", "g", "a", "b", F.col("k"), 5, "median", 9)
    assert {r["replicate"]: r["difference"] for r in got.collect()} == pytest.approx(want)


def test_bootstrap_median_outside_the_band(spark, monkeypatch):
    """Replicates whose median leaves the band are computed again from all rows."""
    df = spark.createDataFrame(
        [(i, "ab"[i % 2], float((i * 37) % 1009)) for i in range(1000)], "k long, g string, v double"
    )
    want = resampling.bootstrap_replicates(df, "v", "g", "a", "b", F.col("k"), 8, "median", 2)
    want = rows(want)
    monkeypatch.setattr(resampling, "BAND_SIGMAS", 0.01)
    got = resampling.bootstrap_replicates(df, "v", "g", "a", "b", F.col("k"), 8, "median", 2)
    assert rows(got) == want


def test_bootstrap_mean_is_centred(spark):
    df = spark.createDataFrame(
        [(i, "ab"[i % 2], float(i % 2) + (i % 7)) for i in range(2000)], "k long, g string, v double"
    )
    replicates = resampling.bootstrap_replicates(df, "v", "g", "b", "a", F.col("k"), 200)
    row = resampling.bootstrap_summary(replicates).first()
    plain = df.groupBy("g").agg(F.avg("v").alias("m")).collect()
    means = {r["g"]: r["m"] for r in plain}
    assert row["mean"] == pytest.approx(means["b"] - means["a"], abs=0.03)
    assert row["ci_low"] < row["mean"] < row["ci_high"]
    assert row["sd"] == pytest.approx(math.sqrt(4 / 1000 * 2), rel=0.2)


def test_bootstrap_over_equal_values_has_the_law_of_rows(spark):
    data = [("a", float(v)) for v in [1] * 700 + [2] * 45 + [5]] + [("b", float(v)) for v in [3] * 64 + [4] * 1000]
    df = spark.createDataFrame([*data, ("a", None), ("c", 9.0)], "g string, v double")
    key = (F.col("v") * 10).cast("bigint") * 2 + (F.col("g") == "a").cast("int")
    samples = resampling._sides(df, "v", "g", key, "a", "b")
    weights = resampling._counted_weights(samples, 2000, 4).groupBy("__side", "__v", "replicate").agg(F.sum("__w").alias("w"))
    counts = Counter(data)
    for row in weights.groupBy("__side", "__v").agg(F.avg("w").alias("m"), F.var_samp("w").alias("s"), F.count("w").alias("n")).collect():
        c = counts[(row["__side"], row["__v"])]
        assert row["n"] == 2000  # a Poisson count of mean c: both moments are c
        assert abs(row["m"] - c) < 5 * math.sqrt(c / 2000)
        assert abs(row["s"] - c) < 6 * math.sqrt((c + 2 * c * c) / 2000)
    drawn = resampling._counted_weights(samples, 50, 4).count()
    assert drawn == 50 * sum(bin(c).count("1") for c in counts.values())
    for statistic in ("mean", "median"):
        found = resampling.bootstrap_replicates(df, "v", "g", "a", "b", key, 200, statistic, 4, equal_values=True)
        summary = resampling.bootstrap_summary(found).first()
        want = {"mean": 795 / 746 - 4192 / 1064, "median": -3.0}[statistic]
        assert summary["n_replicates"] == 200 and summary["mean"] == pytest.approx(want, abs=0.02)
    with pytest.raises(ValueError):
        resampling.bootstrap_replicates(df, "v", "g", "a", "b", key, 2, "mode")


def test_cuts_of_poisson_counts(spark):
    for exponent in (0, 3, 10):
        low, cuts = sampling.power_cuts(exponent)
        chance = [(b - a) / 2**53 for a, b in zip([0, *cuts], cuts)]
        mean = sum((low + i) * p for i, p in enumerate(chance))
        assert mean == pytest.approx(2**exponent, rel=1e-9) and cuts == sorted(cuts)
    values = spark.createDataFrame([([1, 3, 3, 8],)], "a array<bigint>")
    places = [values.select(sampling.place_in(F.col("a"), F.lit(x), 4)).first()[0] for x in (0, 1, 3, 7, 8, 9)]
    assert places == [0, 1, 3, 3, 4, 4]


def test_repeated_samples_are_exact_and_distinct(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3).cast("int").alias("g"))
    drawn = resampling.repeated_samples(df, "g", [0, 1], "id", 100, 6, 3)
    counts = drawn.groupBy("replicate", "g").agg(
        F.count("id").alias("n"), F.count_distinct("id").alias("d")
    )
    assert {(r["n"], r["d"]) for r in counts.collect()} == {(100, 100)}
    assert counts.count() == 12
    whole = resampling.repeated_samples(df, "g", [0], "id", 5000, 2, 3)
    assert whole.count() == 2000


def test_repeated_samples_when_the_limit_is_too_low(spark, monkeypatch):
    df = spark.range(2000).select("id", (F.col("id") % 2).cast("int").alias("g"))
    # Wanted by half as many rows as a sample has: every sample is short and taken again.
    monkeypatch.setattr(resampling.math, "sqrt", lambda x: -x / 8)
    drawn = resampling.repeated_samples(df, "g", [0, 1], "id", 50, 40, 3)
    counts = drawn.groupBy("replicate", "g").agg(F.count("id").alias("n"), F.count_distinct("id").alias("d"))
    assert {(r["n"], r["d"]) for r in counts.collect()} == {(50, 50)} and counts.count() == 80


@pytest.mark.parametrize("n,size,replicates", [(40, 5, 3000), (900, 20, 500), (30, 30, 100), (4000, 3, 64)])
def test_samples_take_every_row_and_pair_alike(spark, n, size, replicates):
    df = spark.range(n).select("id", F.lit(1).alias("g"))
    drawn = resampling.repeated_samples(df, "g", [1], "id", size, replicates, 9)
    sets = defaultdict(set)
    for r in drawn.select("id", "replicate").collect():
        sets[r["replicate"]].add(r["id"])
    assert len(sets) == replicates and {len(x) for x in sets.values()} == {size}
    taken = Counter(i for x in sets.values() for i in x)
    mean = size * replicates / n
    spread = sum((taken[i] - mean) ** 2 for i in range(n)) / n
    assert spread <= max(1.6 * mean * (1 - size / n), 1e-9)  # binomial, as without gaps
    # Two replicates share as many rows as two independent samples, near and far apart.
    for gap in (1, 2, 3, 16, 32):
        pairs = [(a, a + gap) for a in range(1, replicates - gap)]
        shared = sum(len(sets[a] & sets[b]) for a, b in pairs) / len(pairs)
        want = size * size / n
        assert abs(shared - want) <= 5 * math.sqrt(want / len(pairs)) + 1e-9


def test_work_of_samples_follows_the_wanted_rows(spark):
    rows_of = spark.range(20_000).select("id", F.lit(1).alias("g"))
    hashed = resampling.with_key_hash(rows_of, "__h", F.col("id"), 1)
    for replicates in (100, 1000):
        made = resampling._wanted_by(hashed, "g", {1: 0.002}, replicates)
        n = made.count()
        assert abs(n - 40 * replicates) < 6 * math.sqrt(40 * replicates)
        assert made.select("id", "replicate").distinct().count() == n
        assert set(made.agg(F.min("replicate"), F.max("replicate")).first()) <= set(range(1, replicates + 1))


def test_false_positive_rate_on_a_true_null(spark):
    df = spark.range(6000).select(
        "id", (F.col("id") % 2).cast("int").alias("g"),
        (F.xxhash64("id") % 10 == 0).cast("int").alias("v"),
    )
    simulated = resampling.aa_simulation(df, "v", "g", 1, 0, "id", 300, 200, 5)
    row = resampling.false_positive_rate(simulated).first()
    assert row["simulations"] == 200 and row["fpr"] < 0.12


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("named", [False, True])
def test_components_against_union_find(spark, named):
    random.seed(6)
    edges = [(i, i + 1) for i in range(60)]  # a path
    edges += [(1000, 1000 + i) for i in range(1, 300)]  # a hub with most edges
    edges += [(random.randrange(2000, 2400), random.randrange(2000, 2400)) for _ in range(200)]
    edges += [(5000, 5000)]
    df = spark.createDataFrame(edges, "src long, dst long")
    if named:
        edges = [(f"n{a}", f"n{b}") for a, b in edges]
        df = spark.createDataFrame(edges, "src string, dst string")
    rounds = []
    got = {r["node"]: r["component"] for r in graph.connected_components(df, report=rounds.append).collect()}
    assert got == union_find(edges)
    # Every round leaves fewer links, at last none.
    links = len({frozenset(e) for e in edges if e[0] != e[1]})
    assert all(a > b for a, b in zip([links, *rounds], rounds)) and rounds[-1] == 0


def test_components_where_node_hashes_clash(spark, monkeypatch):
    short = lambda named, width, f=graph._hashed: f(named, width, lambda c: F.length(c).cast("bigint"))
    monkeypatch.setattr(graph, "_hashed", short)
    edges = [("a", "bb"), ("bb", "cc"), ("d", "eee"), ("f", "f"), ("g", "d"), ("hh", "ii"), ("cc", "a")]
    df = spark.createDataFrame([*edges, (None, "a"), ("zz", None)], "src string, dst string")
    got = {r["node"]: r["component"] for r in graph.connected_components(df).collect()}
    assert got == union_find(edges)


def test_components_of_a_long_path_and_of_stars(spark):
    rounds = []
    path = spark.range(3000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    got = graph.connected_components(path, report=rounds.append)
    assert got.filter("component = 0").count() == 3001 and len(rounds) <= 14
    rounds.clear()
    stars = spark.range(4000).select((F.col("id") % 7).alias("src"), (F.col("id") + 10).alias("dst"))
    got = graph.connected_components(stars, report=rounds.append)
    assert got.filter("component = node % 7 or node >= 10").count() == 4007 and rounds == [0]
    assert sorted(r["component"] for r in got.select("component").distinct().collect()) == list(range(7))


def test_roles_widths_and_totals(spark):
    df = spark.createDataFrame(
        [("1", "a", 1.0), ("2", "a", 2.0), ("3", "b", 3.0), ("b", "4", 4.0), ("3", "b", 2.0)],
        "s string, r string, x double",
    )
    edges = graph.aggregate_edges(df, "s", "r", "x")
    assert ("3", "b", 5.0) in rows(edges)
    assert tuple(graph.graph_size(edges).first()) == (6, 4)
    looks = {r["node"]: (r["color"], r["size"]) for r in graph.node_roles(edges).collect()}
    assert looks["b"] == ("red", 500) and looks["3"] == ("blue", 300)
    found = graph.connected_components(edges)
    assert {r["node"]: r["component"] for r in found.collect()} == {
        "1": "1", "2": "1", "a": "1", "3": "3", "4": "3", "b": "3",
    }
    assert rows(graph.component_totals(edges, found)) == [("1", 3, 2, 3.0), ("3", 3, 2, 9.0)]
    widths = {r["amount"]: r["width"] for r in graph.edge_widths(edges).collect()}
    assert widths[1.0] == 0.1 and widths[5.0] == 3.0
    written = {r["amount"]: r["width"] for r in graph.edge_widths(edges, as_written=True).collect()}
    assert written == {1.0: 0.1, 2.0: 0.3, 4.0: 0.3, 5.0: 0.3}


HTML = """<html><script>var t="<h2>no</h2>";</script><!-- <h2>no</h2> -->
<h2 class="">One &amp; only</h2><h2 class="add-bottom">Ad</h2><h2>
 Two <b>bold</b></h2><p class="overflow text-muted">i1</p><p class='text-muted'>i2</p>
<pre>x</pre><a class="th-in with-mask" href="/f?a=1&amp;b=2">F</a><a name="x">none</a></html>"""


def test_elements_by_class(spark):
    page = spark.createDataFrame([(1, HTML)], "page_id int, html string")
    texts = lambda *where: [r["text"] for r in pages.elements(page, *where).collect()]
    assert texts("h2") == ["One & only", "Ad", "Two bold"]
    assert texts("h2", "") == ["One & only", "Two bold"]
    assert texts("p", "text-muted") == ["i1", "i2"]
    assert texts("p", "overflow text-muted") == ["i1"]
    assert rows(pages.links(page), "position", "link", "title") == [(0, "/f?a=1&b=2", "F")]
    assert pages.links(page, "other").isEmpty()
    assert rows(pages.result_message(page), "n_found", "message") == [(1, "found: /f?a=1&b=2")]
    records = pages.extract_records(page, {"job": ("h2", ""), "info": ("p", "text-muted")}, 14)
    assert rows(records, "position", "job", "info") == [(0, "One & only", "i1"), (1, "Two bold", "i2")]


@pytest.mark.parametrize("html,where,want", [
    ("<H1>Hi</H1>", ("h1",), ["Hi"]),
    ('<div class="ad">a<div>b</div>c</div>', ("div", "ad"), ["abc"]),
    ('<div class="x">a<div class="ad">b</div>c</div>', ("div", "ad"), ["b"]),
    ('<div data-class="q" class=z>k</div>', ("div", "q"), []),
    ('<div data-class="q" class=z>k</div>', ("div", "z"), ["k"]),
    ("<div title='class=\"z\" >' CLASS = 'z y'>k</div>", ("div", "z"), ["k"]),
    ('<p>one<p>two</p>three<p class=">">four<div>x</div>', ("p",), ["one", "two", "four"]),
    ("<ul><li>a<li>b<ul><li>c</ul>d<li>e</ul>", ("li",), ["a", "bcd", "c", "e"]),
    ("<p>&#1078;&#x41;&eacute;&amp;lt;&bogus;&#0; & 1<2", ("p",), ["жAé&lt;&bogus;\ufffd & 1<2"]),
    ("no element", ("p",), []), (None, ("p",), []), ("", ("p",), []),
])
def test_elements_as_a_parser_gives_them(spark, html, where, want):
    page = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert [r["text"] for r in pages.elements(page, *where).collect()] == want


def plain_elements(pieces, tag):
    """Texts of the elements by one walk to the end of each, as the module's text says."""
    names = [re.match(r"</?(\w+)", x).group(0)[1:].lower() if x.startswith("<") else "" for x in pieces]
    found = []
    for i, name in enumerate(names):
        if name != tag:
            continue
        depth, end = 0, len(pieces)
        for j in range(i + 1, len(pieces)):
            other = names[j]
            if tag == "p":
                over = other in ("p", "/p") or other.lstrip("/") in pages.BLOCKS
            elif tag == "li":
                depth += (other in pages.LISTS) - (other[:1] == "/" and other[1:] in pages.LISTS)
                over = depth < 0 or (depth == 0 and other in ("li", "/li"))
            else:
                depth += (other == tag) - (other == f"/{tag}")
                over = depth < 0
            if over:
                end = j
                break
        found.append("".join(x for x in pieces[i + 1 : end] if not x.startswith("<")).strip(" \n\t\r"))
    return found


def test_elements_against_a_plain_walk(spark):
    rng = random.Random(11)
    tags = ["<p>", "</p>", "<li>", "</li>", "<ul>", "</ul>", "<div class=ad>", "</div>", "<B>", "</b>", "<ol>", "</OL>"]
    cut = [[rng.choice([*tags, "x", " y\n"]) for _ in range(rng.randrange(0, 90))] for _ in range(60)]
    cut.append([rng.choice(tags) for _ in range(arrays.SUM_BLOCK * 3)] + ["z"])  # several blocks
    df = spark.createDataFrame([(i, "".join(x)) for i, x in enumerate(cut)], "page_id int, html string")
    names = ["p", "li", "div", "b", "ul"]
    lists = df.select("page_id", *[pages.element_texts(F.col("html"), name).alias(name) for name in names])
    for row in lists.collect():
        for name in names:
            assert row[name] == plain_elements(cut[row["page_id"]], name), name


@pytest.mark.parametrize("piece,where,n", [
    ("<li>x", ("li",), 100_000), ("<li class='k'>x</li>", ("li", "k"), 100_000), ("<p>x", ("p", ""), 100_000),
    ("<div><div>x</div></div>", ("div",), 100_000), ("</div><div>x", ("div",), 50_000),
])
def test_work_follows_the_length_of_a_page(spark, piece, where, n):
    started = time.time()
    df = spark.range(1).select(F.col("id").alias("page_id"), F.repeat(F.lit(piece), F.lit(n)).alias("html"))
    found = pages.elements(df, *where).agg(F.count(F.lit(1)), F.min("text"), F.max("text")).first()
    assert tuple(found) == (n * piece.count(f"<{where[0]}"), "x", "x")
    assert time.time() - started < 60


def test_lists_of_a_page_side_by_side(spark):
    html = "<h1>t</h1><ul><li>a<li>b</ul><a href=/1>k</a><a>no</a>"
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id int, html string")
    wanted = {"title": ("h1", None), "item": ("li", ""), "to": pages.targets_of()}
    found = pages.extract_records(df, wanted)
    assert found.columns == ["page_id", "position", "title", "item", "to"]
    assert rows(found, "page_id", "position", "title", "item", "to") == [(1, 0, "t", "a", "/1"), (1, 1, None, "b", None)]
    assert rows(pages.extract_records(df, wanted, shortest=True), "item", "to") == [("a", "/1")]
    assert rows(pages.extract_records(df, wanted, max_rows=1), "position") == [(0,)]


def test_links_of_every_quoting(spark):
    html = "<a href='/x'>1</a><A HREF=\"/z\">2</A><a href=/q class='k l'>3</a><a name=n>4</a>"
    page = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert rows(pages.links(page), "link", "title") == [("/q", "3"), ("/x", "1"), ("/z", "2")]
    assert rows(pages.links(page, "k l"), "position", "link") == [(0, "/q")]


def test_ragged_rows(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], ["x"])], "k int, a array<int>, b array<string>")
    padded = pages.ragged_rows(df, "k", ["a", "b"]).collect()
    assert [(r["a"], r["b"]) for r in padded] == [(1, "x"), (2, None), (3, None)]
    cut = pages.ragged_rows(df, "k", ["a", "b"], shortest=True).collect()
    assert [(r["a"], r["b"]) for r in cut] == [(1, "x")]
    assert pages.ragged_rows(df, "k", ["a", "b"], max_rows=2).count() == 2


def test_linear_model(spark):
    points = spark.createDataFrame(
        [(0.0, 1.0), (2.0, 2.0), (4.0, 3.0), (9.0, 8.0), (3.0, 5.0)], "x double, y double"
    )
    fit = models.linear_fit(points, "x", "y")
    assert tuple(fit.first()) == (1.0442, 0.7655)
    ten = spark.createDataFrame([(10.0,)], "x double")
    assert models.linear_predict(ten, fit, "x").first()["predicted"] == 8.699
    predicted = models.linear_predict(points, fit, "x")
    errors = models.prediction_error(predicted, "y", "predicted").first()
    assert errors["rmse"] == pytest.approx(math.sqrt(errors["squared_errors"] / 5), abs=1e-3)


def test_forest_learns_a_rule(spark):
    df = spark.range(400).select(
        (F.col("id") % 20).cast("double").alias("salary"),
        F.when(F.col("id") % 20 < 10, "sea").otherwise("city").alias("target"),
        *models.one_hot("id", [0, 1], "first"),
    )
    model = models.fit_forest(df, ["salary", "first_0", "first_1"], "target", trees=5, max_depth=4)
    got = models.forest_predict(model, df)
    assert got.filter(F.col("target") == F.col("predicted")).count() > 390


def test_large_joins_get_tasks_in_proportion(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    assert [skew.task_count(spark, n) for n in (None, 100, 101, 450, 1000)] == [None, None, 4, 5, 10]
    a = spark.range(1000).select(F.when(F.col("id") % 7 > 0, F.col("id") % 90).alias("k"), "id")
    b = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = a.withColumn("k", F.when(F.col("id") < 500, 5).otherwise(F.col("k")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for left in (a, hot):
            got = skew.skew_safe_join(left, b, ["k"], rows=1000)
            assert got.rdd.getNumPartitions() == 10
            assert rows(got) == rows(left.join(b, "k"))
            kept = skew.skew_safe_join(left, b, ["k"], "left_anti", rows=1000)
            want = left.join(b, "k", "left_anti")
            assert kept.exceptAll(want).isEmpty() and want.exceptAll(kept).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_forest_grows_large_nodes_from_blocks_and_small_ones_in_tasks(spark, monkeypatch):
    """No rule to learn: every tree has about as many leaves as different rows."""
    rng = np.random.default_rng(3)
    data = [([float(x) for x in rng.normal(size=9)], str(rng.integers(5))) for _ in range(1500)]
    df = spark.createDataFrame(data, "values array<double>, target string").select(
        array_to_vector("values").alias("vector"), "target"
    )
    monkeypatch.setattr(forest, "FINISH_ROWS", 200)
    model = models.fit_forest(df, ["vector"], "target", trees=20)
    # Each subtree was grown from a part of a tree's rows; the large nodes were split before.
    assert model.subtrees.count() > 100 and (model.top.feature >= 0).sum() > 100
    got = models.forest_predict(model, df)
    assert got.count() == 1500 and got.filter("target <> predicted").count() == 0
    twice = models.forest_predict(model, df.unionAll(df).unionAll(df))
    assert twice.count() == 4500 and twice.filter("target <> predicted").count() == 0


def test_forest_keeps_copies_it_cannot_split(spark, monkeypatch):
    monkeypatch.setattr(forest, "FINISH_ROWS", 20)
    df = spark.range(300).select(
        F.lit(1.0).alias("x"), F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("target")
    )
    model = models.fit_forest(df, ["x"], "target", trees=5)
    assert rows(models.forest_predict(model, df).groupBy("predicted").count()) == [("a", 300)]
    assert model.subtrees.count() == 0  # no task got the copies


def test_subtrees_are_pure_and_split_by_gini():
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 32, (400, 6)).astype(np.uint8)
    label, weight = rng.integers(0, 4, 400), rng.integers(1, 4, 400).astype(float)
    tree = forest._grow(bins, label, weight, 4, 30, np.random.default_rng(2))
    at = forest._walked(tree["feature"], tree["split"], tree["child"], bins, 0)
    assert (tree["kinds"][tree["child"][at]] == label).mean() > 0.99
    shallow = forest._grow(bins, label, weight, 4, 1, np.random.default_rng(2))
    f, cut = shallow["feature"][0], shallow["split"][0]
    counts = np.zeros((1, 32, 4), np.int64)
    np.add.at(counts[0], (bins[:, f], label), weight.astype(int))

    def score(k):
        sides = [np.bincount(label[s], weight[s], 4) for s in (bins[:, f] <= k, bins[:, f] > k)]
        return sum((side**2).sum() / side.sum() for side in sides if side.sum())

    assert score(cut) == pytest.approx(max(map(score, range(31))))
    assert forest._best(counts)[1] == cut
    assert shallow["votes"].sum() == pytest.approx(2 * forest.VOTE, abs=8)


def test_value_counts_and_bars(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 9.0)], "c string, x double")
    assert [tuple(r) for r in aggregates.value_counts(df, "c").collect()] == [("a", 2), ("b", 1)]
    assert rows(aggregates.category_bars(df, "c", mean_of="x")) == [("a", 2.0), ("b", 5.0)]
    assert Counter(dict(rows(aggregates.category_bars(df, "c")))) == Counter({"a": 2, "b": 1})


def shuffles(df):
    """Shuffles of a plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def test_plans_shuffle_no_more_than_they_need(spark, small):
    from ledgerloom import catalog
    from ledgerloom.plans import commerce, experiment
    from ledgerloom.sources import standins

    shop = standins.shop(spark, small)
    bought = commerce.purchases(shop.orders)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # Two sides of the join, then one per product.
        assert shuffles(commerce.favourite_weekday(shop.items, bought)) <= 3
        features = experiment.student_features(*standins.platform(spark, small))
        once = experiment.platform_metrics(reliable_checkpoint(features))
        assert shuffles(once) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hot = catalog.QUERIES["hot_customer_purchases"](spark, small)
    assert "__salt" in hot._jdf.queryExecution().analyzed().toString()


def test_component_rounds_leave_roots_only(spark):
    from ledgerloom.session import checkpoint_folder

    def tables():
        path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_folder(spark))
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return len(files.listStatus(path)) if files.exists(path) else 0

    rounds, before = [], tables()
    edges = spark.range(64).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = graph.connected_components(edges, report=rounds.append)
    assert found.filter("component = 0").count() == 65
    assert 2 <= len(rounds) <= 12
    # The edges, the roots of every round, the last links, and labels between first and last.
    assert tables() - before == 2 + len(rounds) + max(len(rounds) - 2, 0)
