"""Column helpers against hand-computed values."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, numeric, sampling, scoring, student, text
from ledgerloom.plans import commerce
from ledgerloom.sources import readers


def one(spark, column, value=None, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(column.alias("r")).first()["r"]


def column_of(spark, column, values, schema):
    rows = spark.createDataFrame([(v,) for v in values], schema).select(column.alias("r"))
    return [row["r"] for row in rows.collect()]


def test_zone_of_domain(spark):
    zones = column_of(spark, text.last_part(F.col("v")), ["a.co.uk", "b.com", "localhost"], "v string")
    assert zones == ["uk", "com", "localhost"]


def test_nth_part_is_null_when_missing(spark):
    assert one(spark, text.nth_part(F.col("v"), ".", 2), "a.b") == "b"
    assert one(spark, text.nth_part(F.col("v"), ".", 3), "a.b") is None


def test_name_parts(spark):
    row = spark.createDataFrame([("Ivanov Petr Ilich",)], "v string").select(
        *text.full_name_parts(F.col("v"))
    ).first()
    assert tuple(row) == ("Petr", "Ivanov", "Ilich")


def test_strip_and_remove(spark):
    assert one(spark, text.strip(F.col("v")), " \n\tab c\r\n") == "ab c"
    assert one(spark, text.remove(F.col("v"), "a", "\n"), "a\nbab") == "bb"
    assert one(spark, text.remove_first(F.col("v"), "s"), "asbs") == "abs"
    assert one(spark, text.remove_first(F.col("v"), "s"), "abc") == "abc"


def test_decimal_comma(spark):
    got = column_of(spark, text.decimal_comma(F.col("v")), ["3,5", "x", None], "v string")
    assert got == [3.5, None, None]


def test_entities_and_find_all(spark):
    assert one(spark, text.decode_entities(F.col("v")), "&lt;a&gt; &amp;lt;") == "<a> &lt;"
    assert one(spark, text.find_all(F.col("v"), 'href="([^"]*)"'), 'href="a" href="b"') == ["a", "b"]


def test_dates(spark):
    parse = lambda s: F.lit(s).cast("timestamp_ntz")
    assert one(spark, dates.whole_days(parse("2018-09-02 23:00:00"), parse("2018-09-04 17:40:06"))) == 1
    assert one(spark, dates.calendar_days(parse("2018-09-02"), parse("2018-09-04"))) == 2
    assert one(spark, dates.weekday_name(parse("2023-03-07"))) == "Tuesday"
    assert one(spark, dates.month_label(parse("2023-03-07"))) == "2023-03"
    assert one(spark, dates.months_between_labels(parse("2023-01-31"), parse("2023-02-01"))) == 1
    assert one(spark, dates.days_in_month(parse("2016-02-10"))) == 29
    assert one(spark, dates.days_in_month(parse("2016-02-10"), leap=False)) == 28
    assert one(spark, dates.date_or_28(F.lit(2023), F.lit(2), F.lit(31))) == datetime.date(2023, 2, 28)
    assert one(spark, dates.date_or_28(F.lit(2023), F.lit(4), F.lit(30))) == datetime.date(2023, 4, 30)
    assert one(spark, dates.parse_timestamp(F.col("v")), "not a date") is None
    assert one(spark, dates.report_day(parse("2018-09-03 17:40:06"))) == datetime.datetime(
        2018, 9, 4, 17, 40, 6
    )


def test_rounding_and_ratio(spark):
    assert one(spark, numeric.round_even(F.lit(0.125), 2)) == 0.12
    assert one(spark, numeric.round_even(F.lit(2.5), 0)) == 2.0
    assert one(spark, numeric.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, numeric.percent(F.lit(1), F.lit(3))) == 33.33


def test_normal_tail(spark):
    points = [-9.0, -3.0, -0.5, 0.0, 0.1, 1.0, 1.96, 5.0, 7.2, 12.0]
    got = column_of(spark, numeric.normal_tail(F.col("v")), points, "v double")
    for z, p in zip(points, got):
        assert p == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-9)


def test_student_p_values(spark):
    """Against published values and a numeric integral of the density."""
    points = [(0.9051358093, 22.0), (0.3, 1.0), (2.0, 2.5), (3.0, 40.0), (1.2, 99.5),
              (1.2, 100.5), (4.0, 5000.0), (0.0, 3.0)]
    frame = spark.createDataFrame(points, "t double, df double")
    got = [r["p"] for r in frame.select(student.t_two_sided("t", "df").alias("p")).collect()]

    def integral(t, df, steps=20000):
        front = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
        total = 0.0
        for i in range(steps + 1):
            weight = 1 if i in (0, steps) else 4 if i % 2 else 2
            total += weight * (1 + (t * i / steps) ** 2 / df) ** (-(df + 1) / 2)
        return 1 - 2 * front * t / steps / 3 * total

    assert got[0] == pytest.approx(0.3751996798, abs=1e-9)
    for (t, df), p in zip(points, got):
        assert p == pytest.approx(integral(t, df), abs=1e-9)


def test_scores_and_segments(spark):
    cuts = [F.lit(c) for c in (1.8, 2.6, 3.4, 4.2)]
    values = [1, 2, 3, 4, 5]
    assert column_of(spark, scoring.low_is_good(F.col("v"), cuts), values, "v int") == [5, 4, 3, 2, 1]
    assert column_of(spark, scoring.high_is_good(F.col("v"), cuts), values, "v int") == values
    codes = [11, 12, 15, 35, 41, 43, 45, 51, 55, 21]
    named = scoring.segment_name(F.floor(F.col("v") / 10), F.col("v") % 10)
    assert column_of(spark, named, codes, "v int") == [
        "Одноразовые", None, "Ушедшие", "Ушедшие", "Недавние", None,
        "Потенциально - постоянные", "Новенькие", "Потенциально - постоянные", "Одноразовые",
    ]


def test_draws_do_not_depend_on_partitions(spark):
    ids = spark.range(20_000)
    draw = sampling.uniform_draw(F.col("id"), 3)
    few = ids.coalesce(1).select("id", draw.alias("u"))
    many = ids.repartition(7).select("id", draw.alias("u"))
    assert few.exceptAll(many).isEmpty()
    stats = few.agg(F.avg("u").alias("m"), F.var_pop("u").alias("v"), F.max("u").alias("h")).first()
    assert stats["m"] == pytest.approx(0.5, abs=0.01)
    assert stats["v"] == pytest.approx(1 / 12, abs=0.002)
    assert stats["h"] < 1
    stepped = sampling.with_key_hash(few, "h", F.col("id"), 3)
    whole = F.shiftleft("h", 21) + F.shiftright("h_b", 11)
    assert stepped.filter(whole / 2.0**53 != F.col("u")).isEmpty()
    assert stepped.select("h", "h_b").distinct().count() == 20_000


def test_keys_beyond_32_bits_have_draws_of_their_own(spark):
    """Keys that agree in one half of their hash still differ in their draws."""
    ids = spark.range(3000).select(
        F.explode(F.array(F.col("id"), F.col("id") + F.lit(1 << 40), -F.col("id") - 1)).alias("id")
    )
    hashed = sampling.with_key_hash(ids, "h", F.col("id"), 5)
    assert hashed.select("h", "h_b").distinct().count() == 9000
    same_half = spark.createDataFrame([(7, 1), (7, 2), (7, 3)], "h long, h_b long").crossJoin(
        spark.range(1, 41).withColumnRenamed("id", "r")
    )
    drawn = sampling.with_draw(same_half, "d", "h", "r")
    assert drawn.groupBy("r").agg(F.count_distinct("d").alias("n")).filter("n = 3").count() == 40
    fine = sampling.with_fine_draw(drawn, "f", "d", "h")
    assert fine.filter((F.col("f") < 0) | (F.col("f") >= F.lit(1 << 53))).isEmpty()


def test_poisson_weights(spark):
    hashed = sampling.with_key_hash(spark.range(50_000), "h", F.col("id"), 5)
    drawn = sampling.with_draw(hashed.withColumn("r", F.lit(4)), "d", "h", "r")
    got = drawn.select(sampling.poisson_weight(F.col("d")).alias("w")).agg(
        F.avg("w").alias("m"), F.var_pop("w").alias("v")
    ).first()
    assert got["m"] == pytest.approx(1, abs=0.02)
    assert got["v"] == pytest.approx(1, abs=0.04)


def test_hosts_of_what_is_no_url(spark):
    urls = ["http://a b/c", "https://x.example.net/p?q=1", "nothing", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(readers.url_host(F.col("url"))).collect()] == [
        None, "x.example.net", None, None,
    ]


def test_weekday_names_do_not_follow_the_locale(spark):
    days = [F.lit(f"2024-01-0{i}").cast("timestamp_ntz") for i in range(1, 8)]
    named = spark.range(1).select(*[dates.weekday_name(day) for day in days]).first()
    assert tuple(named) == commerce.WEEKDAYS
