"""Cohort retention by month of first purchase."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import label_of_number, month_number
from ledgerloom.functions.numeric import percent
from ledgerloom.operators.aggregates import pivot_counts
from ledgerloom.sources.sinks import write_partitions


def monthly_activity(customers: DataFrame, bought: DataFrame) -> DataFrame:
    """Person and month pairs, each once, with the person's first month.

    Months are whole numbers (hash aggregation needs fixed-width minima).  Purchases
    shrink to distinct pairs on the map side before the first month is taken, so a person
    holds at most one row per month, however often they buy.
    """
    months = bought.select(
        "customer_id", month_number(F.col("order_approved_at")).alias("month")
    ).distinct()
    pairs = (
        months.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .filter(F.col("customer_unique_id").isNotNull())
        .select("customer_unique_id", "month")
        .distinct()
    )
    first = pairs.groupBy("customer_unique_id").agg(F.min("month").alias("first_month"))
    return pairs.join(first, "customer_unique_id")


def cohort_counts(
    customers: DataFrame, bought: DataFrame, first: str = "2017-01", last: str = "2017-12"
) -> DataFrame:
    """Distinct people per first month and months since then."""
    bounds = [int(label[:4]) * 12 + int(label[5:]) for label in (first, last)]
    counted = (
        monthly_activity(customers, bought)
        .filter(F.col("first_month").between(*bounds))
        .groupBy("first_month", (F.col("month") - F.col("first_month")).alias("months_since"))
        .agg(F.count("customer_unique_id").alias("people"))  # pairs are distinct
    )
    return counted.withColumn("first_month", label_of_number(F.col("first_month")))


def retention(counts: DataFrame) -> DataFrame:
    """Every cohort and offset that occurs, with people and their share of the cohort."""
    started = counts.filter(F.col("months_since") == 0).select(
        "first_month", F.col("people").alias("started")
    )
    share = percent(F.col("people"), F.col("started")).alias("retention")
    return counts.join(started, "first_month").select(
        "first_month", "months_since", "people", share
    )


def retention_table(retained: DataFrame, value: str = "people") -> DataFrame:
    """Cohorts as rows and every offset that occurs as a column.

    The offsets are read first: there are no more than calendar months.
    """
    offsets = [row[0] for row in retained.select("months_since").distinct().collect()]
    return pivot_counts(retained, "first_month", "months_since", value, sorted(offsets), "m")


def best_cohort(retained: DataFrame, month: int = 3) -> DataFrame:
    """The cohort with the highest share after ``month``; the earliest one on ties (one row)."""
    best = F.min_by(
        F.struct("first_month", "retention"), F.struct(-F.col("retention"), F.col("first_month"))
    )
    return retained.filter(F.col("months_since") == month).agg(best.alias("b")).select("b.*")


BITMAPS = "bucket BIGINT, bits BINARY, month INT"


def activity_bitmaps(customers: DataFrame, bought: DataFrame) -> DataFrame:
    """Who bought in a month, as one bitmap per month and bucket of 32,768 person numbers.

    ``customer_unique_id`` must be a whole number.  A bitmap is built on the map side, so
    the shuffle holds at most one per task, month and bucket, however many purchases.
    """
    person = F.col("customer_unique_id").cast("bigint")
    return (
        bought.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .select(month_number(F.col("order_approved_at")).alias("month"), person.alias("person"))
        .filter("month IS NOT NULL AND person IS NOT NULL")
        .groupBy("month", F.bitmap_bucket_number("person").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("person")).alias("bits"))
        .select("bucket", "bits", "month")
    )


def write_activity(bitmaps: DataFrame, path: str) -> None:
    """Add months to a table of bitmaps, or replace them; no other month is read or touched."""
    write_partitions(bitmaps, path, ["month"])


def read_activity(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BITMAPS).parquet(path)


def _shared(pairs: DataFrame, keys: Sequence[str], *bitmaps: str) -> DataFrame:
    """Number of people that are in all bitmaps of a row: ``people``."""
    each = F.explode(F.array(*bitmaps)).alias("bits")
    return pairs.select(*keys, each).groupBy(*keys).agg(
        F.bitmap_count(F.bitmap_and_agg("bits")).alias("people")
    )


def cohort_counts_from_bitmaps(
    bitmaps: DataFrame, first: str = "2017-01", last: str = "2017-12"
) -> DataFrame:
    """``cohort_counts`` from the monthly bitmaps.

    A cohort is who was seen up to its month less who was seen before, so a cell is the
    difference of two intersections of a month with people seen.  All of it works on the
    bitmaps of one bucket, which are shuffled once, by bucket.
    """
    bounds = [int(label[:4]) * 12 + int(label[5:]) for label in (first, last)]
    dealt = bitmaps.repartition("bucket")
    upto = Window.partitionBy("bucket").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    seen = dealt.select(
        "bucket", F.col("month").alias("cohort"), F.bitmap_or_agg("bits").over(upto).alias("seen")
    )
    pairs = dealt.join(seen, "bucket").filter("cohort <= month")
    shared = _shared(pairs, ["bucket", "month", "cohort"], "bits", "seen")
    before = F.lag("people", 1, 0).over(Window.partitionBy("bucket", "month").orderBy("cohort"))
    cells = shared.withColumn("people", F.col("people") - before).filter(
        F.col("cohort").between(*bounds)
    )
    counted = cells.groupBy(
        F.col("cohort").alias("first_month"), (F.col("month") - F.col("cohort")).alias("months_since")
    ).agg(F.sum("people").alias("people")).filter("people > 0")
    return counted.withColumn("first_month", label_of_number(F.col("first_month")))
