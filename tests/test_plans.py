"""Whole jobs on the hand fixtures."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import skew
from ledgerloom.plans import (
    cohort, commerce, domains, experiment, films, readout, rfm, sales, transfer_graph, transfers,
)
from ledgerloom.session import reliable_checkpoint
from ledgerloom.sources import generators, readers, schemas, sinks


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def orders_of(spark, data):
    """(order, customer, status, approved) rows to an orders table."""
    schema = "order_id string, customer_id string, order_status string, approved string"
    return spark.createDataFrame(data, schema).select(
        "order_id", "customer_id", "order_status",
        F.col("approved").cast("timestamp_ntz").alias("order_approved_at"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_customer_date"),
        F.lit("2017-03-01").cast("timestamp_ntz").alias("order_estimated_delivery_date"),
    )


def customers_of(spark, pairs):
    return spark.createDataFrame(
        [(c, u, "SP") for c, u in pairs], "customer_id string, customer_unique_id string, customer_state string"
    )


def test_purchases_and_one_time_buyers(spark):
    orders = orders_of(spark, [
        ("o1", "c1", "delivered", "2017-01-01"), ("o2", "c2", "canceled", "2017-01-01"),
        ("o3", "c3", None, "2017-01-01"), ("o4", "c4", "unavailable", "2017-01-01"),
        ("o5", "c5", "shipped", None), ("o6", "c6", "delivered", "2017-01-01"),
    ])
    bought = commerce.purchases(orders)
    assert rows(bought, "order_id") == [("o1",), ("o3",), ("o6",)]
    customers = customers_of(spark, [("c1", "u1"), ("c6", "u1"), ("c3", "u2")])
    assert commerce.one_time_buyers(customers, bought).first()[0] == 1
    assert commerce.customer_purchases(customers, bought).count() == 3


def test_purchases_per_week(spark):
    orders = orders_of(spark, [
        ("o1", "c1", "x", "2017-01-02"), ("o2", "c1", "x", "2017-01-30"), ("o3", "c2", "x", "2016-02-10"),
    ])
    customers = customers_of(spark, [("c1", "u1"), ("c2", "u2")])
    long = commerce.purchases_per_week(customers, orders)
    short = commerce.purchases_per_week(customers, orders, leap=False)
    column = "purchases_per_week"
    got = {r["customer_unique_id"]: r[column] for r in long.collect()}
    assert got["u1"] == pytest.approx(0.451613, abs=1e-6)
    assert got["u2"] == pytest.approx(0.241379, abs=1e-6)
    assert short.filter("customer_unique_id = 'u2'").first()[column] == pytest.approx(0.25)


def test_non_delivery(spark):
    orders = orders_of(spark, [("o1", "c1", "delivered", "2017-01-01"), ("o2", "c1", None, "2017-01-01")])
    missing = commerce.not_delivered(orders)
    assert rows(commerce.orders_by_estimated_month(missing, "n")) == [(3, 2)]
    assert commerce.mean_by_estimated_month(missing, "m").first()["m"] == 2.0
    assert rows(commerce.status_counts(missing)) == [("delivered", 1)]
    customers = customers_of(spark, [("c1", "u1")])
    assert rows(commerce.missing_delivery_by_state(customers, orders)) == [("SP", 1)]


def test_retention(spark):
    months = {"u1": ("2017-01", "2017-04"), "u2": ("2017-01",), "u3": ("2017-02", "2017-05")}
    data = [(f"{u}{m}", u, "x", f"{m}-15") for u, ms in months.items() for m in ms]
    orders = orders_of(spark, data)
    customers = customers_of(spark, [(u, u) for u in months])
    kept = cohort.retention(cohort.cohort_counts(customers, orders))
    assert rows(kept) == [
        ("2017-01", 0, 2, 100.0), ("2017-01", 3, 1, 50.0),
        ("2017-02", 0, 1, 100.0), ("2017-02", 3, 1, 100.0),
    ]
    wide = cohort.retention_table(kept)
    assert wide.columns == ["first_month", "m0", "m3"]
    assert rows(wide) == [("2017-01", 2, 1), ("2017-02", 1, 1)]
    assert tuple(cohort.best_cohort(kept).first()) == ("2017-02", 100.0)


def test_rfm(spark):
    orders = orders_of(spark, [
        ("o1", "c1", "x", "2018-09-03 17:40:06"), ("o2", "c2", "x", "2018-09-02 23:00:00"),
        ("o3", "c2", "x", "2018-08-01 00:00:00"), ("o4", "c3", "x", "2018-09-03 00:00:00"),
    ])
    items = spark.createDataFrame(
        [("o1", "p", 10.0), ("o1", "q", 5.0), ("o2", "p", 1.0), ("o3", "p", 2.0)],
        "order_id string, product_id string, price double",
    )
    customers = customers_of(spark, [("c1", "u1"), ("c2", "u2"), ("c3", "u3")])
    measures = rfm.rfm_measures(customers, orders, items)
    assert rows(measures) == [("u1", 1, 1, 15.0), ("u2", 1, 2, 3.0)]
    scored = rfm.rfm(customers, orders, items)
    assert scored.filter(~F.col("R").between(1, 5) | ~F.col("M").between(1, 5)).isEmpty()
    sketched = rfm.rfm(customers, orders, items, exact=False)
    assert sketched.count() == 2
    assert rfm.rfm(customers, orders.limit(0), items).collect() == []


@pytest.fixture(scope="module")
def trial(spark):
    groups = spark.createDataFrame([(1, "A"), (2, "B")], schemas.GROUPS)
    late = spark.createDataFrame([(3, "A")], "user bigint, g string")
    active = spark.createDataFrame([(1,), (2,), (3,)], schemas.ACTIVE)
    checks = spark.createDataFrame([(1, 10.0), (9, 5.0)], schemas.CHECKS)
    return groups, late, active, checks


def test_experiment_metrics(trial):
    result = experiment.experiment_metrics(*trial)
    assert rows(result.metrics, "grp", "cr", "mean_check") == [("A", 50.0, 10.0), ("B", 0.0, None)]
    assert ("9" in {str(r["id"]) for r in result.full.filter("grp IS NULL").collect()})
    assert rows(experiment.group_sizes(result.full)) == [("A", "all", 2), ("A", "paying", 1), ("B", "all", 1)]


def test_readouts_are_complete(trial, spark):
    groups, late, active, checks = trial
    full = experiment.participants(groups, late, active, checks)
    assert readout.conversion_readout(full).count() == 1
    data = [(i, "AB"[i % 2], float(i % 11) + 1) for i in range(200)]
    payers = spark.createDataFrame(data, "id bigint, grp string, rev double")
    tested = readout.average_check_readout(payers, F.col("id"), replicates=20)
    assert {r["test"] for r in tested.collect()} == {
        "normality A", "normality B", "bootstrap mean", "mann-whitney",
    }


def test_platform_metrics(spark):
    students = spark.createDataFrame(
        [(1, "control"), (2, "control"), (3, "pilot")], schemas.STUDENTS
    )
    def answers(st_id, correct, subject):
        return [(st_id, datetime.datetime(2021, 10, 1), 1, subject)] * correct

    data = answers(1, 11, "Other") + answers(2, 2, "Math") + answers(2, 1, "Other")
    data += answers(3, 2, "Math") + answers(3, 10, "Other")
    answered = spark.createDataFrame(data, schemas.ANSWERS)
    paid = spark.createDataFrame([(1, 100.0, "Other"), (3, 50.0, "Math")], schemas.PAYMENTS)
    metrics = experiment.platform_metrics(experiment.student_features(students, answered, paid))
    assert rows(metrics) == [
        ("control", 50.0, 100.0, 50.0, 100.0, 0.0), ("pilot", 50.0, 50.0, 100.0, 100.0, 100.0),
    ]


def test_diligent_students(spark):
    jan, feb = datetime.datetime(2021, 1, 31, 23), datetime.datetime(2021, 2, 1)
    data = [(1, jan, 1, "Math")] * 20 + [(2, jan, 1, "Math")] * 10 + [(2, feb, 1, "Math")] * 10
    data += [(3, jan, 1, "Math")] * 20 + [(3, feb, 1, "Math")] + [(4, jan, 1, "Math")] * 19
    answers = spark.createDataFrame(data, schemas.ANSWERS)
    assert experiment.diligent_students(answers).first()[0] == 1
    assert experiment.diligent_students(answers, by_subject=True).first()[0] == 1
    assert experiment.diligent_monthly(answers).first()[0] == 2


def test_link_cleaning_and_graph(spark, tmp_path):
    day = lambda d: datetime.date(2024, 1, d)
    data = [(1, 10, day(9)), (1, 11, day(17)), (1, 12, day(8)), (1, 12, day(12)), (1, 13, day(18)),
            (1, 13, day(10)), (2, 10, day(10))]
    moved = spark.createDataFrame([(*r, 5.0) for r in data], schemas.TRANSFERS)
    issues = spark.createDataFrame([(1, day(10))], schemas.ISSUE_DATES)
    dated = transfers.dated_transfers(moved, issues)
    cleaned = transfers.clean_links(dated)
    assert rows(cleaned, "id_sender", "id_receiver") == [(1, 10), (1, 11)]
    assert rows(transfers.known_pairs(dated), "id_receiver") == [(12,), (13,)]
    built = transfer_graph.transfer_graph(cleaned)
    assert rows(built.components) == [(1, 3, 2, 10.0)]
    transfer_graph.export_graph(built, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/edges").count() == 2
    assert sinks.read_component(spark, str(tmp_path), "nodes", 1).count() == 3
    assert sinks.read_component(spark, str(tmp_path), "edges", 1).count() == 2


def test_many_transfers_get_tasks_in_proportion(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 20)
    moved = spark.range(300).selectExpr(
        "id % 40 AS id_sender", "id % 50 AS id_receiver",
        "date_add(DATE'2024-01-01', CAST(id % 31 AS INT)) AS dates", "5.0D AS amount_new",
    )
    issues = spark.range(30).selectExpr("id AS id_sender", "DATE'2024-01-10' AS date_cred")
    plain = transfers.dated_transfers(moved, issues)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dated = transfers.dated_transfers(moved, issues, rows=300)
        known = transfers.known_pairs(dated)
        # By sender all the way: no task has more than its part, and pairs need no further shuffle.
        assert known.rdd.getNumPartitions() == 15
        assert rows(known) == rows(transfers.known_pairs(plain))
        assert rows(transfers.known_pairs(reliable_checkpoint(dated), rows=300)) == rows(known)
        assert rows(transfers.clean_links(dated)) == rows(transfers.clean_links(plain))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sales_rank_and_fibonacci(spark):
    people = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], schemas.PEOPLE)
    data = [(i, p, "s", 1.0) for i, p in enumerate([1, 1, 2, 2, 3, 3, 3, 3, 3])]
    sold = spark.createDataFrame(data, schemas.SALES)
    assert rows(sales.sales_rank(people, sold), "id", "sale_count", "sale_rank") == [
        (1, 2, 1), (2, 2, 1), (3, 5, 3),
    ]
    numbers = sales.fibonacci(spark)
    assert (numbers.count(), numbers.agg(F.max("number")).first()[0]) == (90, 1779979416004714189)


def test_domain_report(spark, tmp_path):
    staged = tmp_path / "top.csv"
    staged.write_text("1,a.com\n2,b.com\n3,long.co.uk\n4,localhost\n")
    landed = readers.land_raw(spark, str(staged), schemas.DOMAINS, str(tmp_path / "landed"))
    assert landed.count() == 4
    report = domains.domain_report(landed, "2023-03-03", "b.com", rows=2)
    assert rows(report, "section", "key", "value") == [
        ("domain rank", "b.com", "2"), ("longest domain", "long.co.uk", "10"),
        ("top zones", "com", "2"), ("top zones", "localhost", "1"),
    ]
    sinks.write_csv(report, str(tmp_path / "out"), header=False, one_file=True)
    back = readers.read_csv(
        spark, str(tmp_path / "out"), "ds string, section string, key string, value string", header=False
    )
    assert back.count() == 4


def test_films(spark):
    raw = spark.createDataFrame(
        [(1, "1.\nFilm\n(1999)", "8.5", "Drama", "Directors:\nAnn\nStars:\nBob"),
         (2, "2.\nSola", "x", "Drama", "Director:\nSusan")],
        "id int, heading string, rating string, genre string, credits string",
    )
    cleaned = films.clean_films(raw)
    assert rows(cleaned, "title", "year", "director", "actors", "rating") == [
        ("Film", "(1999)", "Ann", "Bob", 8.5), ("Sola", None, "Susan", None, None),
    ]
    assert films.average_rating(cleaned).first()[0] == 8.5


def test_csv_variants(spark, tmp_path):
    path = tmp_path / "ab.csv"
    path.write_text(";value;experimentVariant\n1;3,5;Control\n2;4,25;Treatment\n")
    raw = readers.read_csv(spark, str(path), schemas.AB_VALUES, sep=";")
    assert rows(readout.parse_ab_values(raw)) == [(1, 3.5, "Control"), (2, 4.25, "Treatment")]
    feature = tmp_path / "trips.csv"
    feature.write_text("i,age,target\n0,31,sea\n")
    assert rows(readers.read_features(spark, str(feature), "i int, age int, target string", "i")) == [
        (31, "sea"),
    ]
    raw.createOrReplaceTempView("ab_raw")
    assert readers.query_source(spark, "SELECT count(*) AS n FROM ab_raw").first()["n"] == 2
    assert sinks.single_value(raw.select(F.max("number"))) == 2
    assert sinks.preview(raw, 1).count() == 1


def test_generators(spark):
    made = generators.transfers(spark, 2000, 5)
    low = made.agg(*[F.min(c) for c in made.columns], *[F.max(c) for c in made.columns]).first()
    assert low[0] >= 1000 and low[4] <= 10000 and low[3] >= 100.5 and low[7] <= 1_000_000
    assert low[2].year == 2023 and low[6].year == 2024
    assert made.exceptAll(generators.transfers(spark, 2000, 5)).isEmpty()
    issued = generators.issue_dates(made)
    assert issued.count() == made.select("id_sender").distinct().count()
    picked = generators.graph_rows(spark, 100, [123450, 678900, 135790])
    assert {r[0] for r in picked.select("id_receiver").distinct().collect()} <= {123450, 678900, 135790}
    urls = readers.page_urls(spark, "https://x/?start=", 1, 152, 50)
    assert [r["url"][-4:] for r in urls.orderBy("id").collect()] == ["rt=1", "t=51", "=101", "=151"]
    table = generators.columns_to_table(spark, {"x": [1, 2], "y": [3, 4]}, "x int, y int")
    assert rows(table) == [(1, 3), (2, 4)]
    assert generators.literal_table(spark, [(0.0, 1.0)], schemas.POINTS).count() == 1


def test_null_rules(spark):
    df = spark.createDataFrame([("v1", 1), ("v2", 0), (None, 1)], "version string, p int")
    assert rows(readout.without_version(df, "v2"), "p") == [(1,), (1,)]
    assert rows(readout.segment_means(df, "p", "version")) == [("v1", 1.0), ("v2", 0.0)]
    cut = readout.cut_outliers(df.withColumn("g", F.lit("T")), "p", "g", "T", 1.0)
    assert cut.count() == 1


def test_a_report_run_again_replaces_its_day_only(spark, tmp_path):
    def files(day):
        return {(f.name, f.stat().st_mtime_ns) for f in (tmp_path / "r" / f"ds={day}").iterdir()}

    path = str(tmp_path / "r")
    listed = spark.createDataFrame([(1, "a.com"), (2, "b.org"), (3, "c.com")], "rank bigint, domain string")
    for day in ("2024-01-01", "2024-01-02"):
        domains.publish_report(domains.domain_report(listed, day, "b.org"), path)
    other, first = files("2024-01-02"), domains.published_reports(spark, path, "2024-01-01").collect()
    domains.publish_report(domains.domain_report(listed.filter("rank = 1"), "2024-01-01", "b.org"), path)
    assert files("2024-01-02") == other
    again = domains.published_reports(spark, path, "2024-01-01")
    assert rows(again, "section", "key", "value") == [("longest domain", "a.com", "5"), ("top zones", "com", "1")]
    assert len(first) == 4 and domains.published_reports(spark, path).count() == 2 + 4
    both = [domains.domain_report(listed, day, "b.org") for day in ("2024-01-01", "2024-01-03")]
    domains.publish_report(both[0].unionByName(both[1]), path)  # two days at once
    assert files("2024-01-02") == other and domains.published_reports(spark, path).count() == 12
    domains.publish_report(both[0], path)  # the same day, the same rows
    assert domains.published_reports(spark, path).schema["ds"].dataType.typeName() == "string"
    assert domains.published_reports(spark, path).count() == 12


def test_bad_lines_are_set_aside(spark, tmp_path):
    lines = ["id;x;day", "1;2.5;2024-01-02", "2;y;2024-01-02", "3;1.0", "4;1.0;2024-01-02;z", "", "junk", "junk",
             ";4.0;2024-01-03", "5;;", "6;7.0;2024-13-01", '7;"8.0";2024-01-04']
    (tmp_path / "f.csv").write_text("\n".join(lines))
    read = lambda **more: readers.read_checked_csv(spark, str(tmp_path), "id INT, x DOUBLE, day DATE", ";", **more)
    checked = read()
    assert [r["id"] for r in checked.good.orderBy("x").collect()] == [5, 1, None, 7]
    rejected = {"2;y;2024-01-02": 1, "3;1.0": 1, "4;1.0;2024-01-02;z": 1, "junk": 2, "6;7.0;2024-13-01": 1}
    assert {r["line"]: r["n"] for r in checked.rejects.collect()} == rejected
    assert checked.rejects.agg(F.sum("n")).first()[0] == 6
    # A query on one column sees the same good rows.
    assert checked.good.select("id").count() == 4 == checked.good.count()
    strict = read(required=("id", "x"))
    assert rows(strict.good, "id", "x") == [(1, 2.5), (7, 8.0)]
    assert {r["line"] for r in strict.rejects.collect()} == {*rejected, ";4.0;2024-01-03", "5;;"}
    (tmp_path / "f.csv").write_text("id;x;day\n1;1.0;2024-01-01")
    assert read().rejects.isEmpty()


def test_bitmap_retention_equals_the_count_of_people(spark, tmp_path):
    rng = random.Random(2)
    people = [rng.choice([i, 32768 * i, 10**10 + i]) for i in range(1, 250)]
    customers = spark.createDataFrame([(i, p) for i, p in enumerate(people)] + [(999, None)], "customer_id int, customer_unique_id bigint")
    bought = [
        (rng.choice([*range(249), 999, 1234]), f"20{rng.choice(['16-12', '17-01', '17-02', '17-03', '17-11', '18-02'])}-{rng.randrange(1, 28):02d}")
        for _ in range(900)
    ]
    bought = spark.createDataFrame(bought, "customer_id int, t string").select(
        "customer_id", F.to_timestamp_ntz("t", F.lit("yyyy-MM-dd")).alias("order_approved_at")
    )
    want = rows(cohort.cohort_counts(customers, bought))
    bitmaps = cohort.activity_bitmaps(customers, bought)
    path = str(tmp_path / "a")
    last = 2018 * 12 + 2
    cohort.write_activity(bitmaps.filter(F.col("month") < last), path)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "a").glob("month=*/*.parquet")}
    cohort.write_activity(bitmaps.filter(F.col("month") == last), path)  # a new month
    cohort.write_activity(bitmaps.filter(F.col("month") == last), path)  # and again
    assert before and all(f.stat().st_mtime_ns == time for f, time in before.items())
    stored = cohort.read_activity(spark, path)
    assert rows(cohort.cohort_counts_from_bitmaps(stored)) == want
    assert rows(cohort.cohort_counts_from_bitmaps(stored, "2016-01", "2018-12")) == rows(
        cohort.cohort_counts(customers, bought, "2016-01", "2018-12")
    )
