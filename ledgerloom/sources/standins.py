"""The test tables in the shape the jobs expect.

The star-schema tables have no missing values, so the missing statuses and dates the
jobs care about are derived from other columns.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.skew import skew_safe_join
from ledgerloom.sources.readers import table, url_host


class Shop(NamedTuple):
    customers: DataFrame
    orders: DataFrame
    items: DataFrame


def shop(spark: SparkSession, folder: str) -> Shop:
    """Customers with state, orders with status and dates, order lines."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    date = F.col("o_orderdate")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_totalprice") < 5000, F.lit(None))
        .when(status == "F", F.lit("delivered"))
        .when(status == "O", F.lit("shipped"))
        .otherwise(F.lit("canceled"))
        .alias("order_status"),
        F.when((priority == "4-NOT SPECIFIED") & (status == "O"), F.lit(None))
        .otherwise(date)
        .alias("order_approved_at"),
        F.when((status == "F") & (priority != "5-LOW"), date + F.expr("INTERVAL 10 DAY")).alias(
            "order_delivered_customer_date"
        ),
        (date + F.expr("INTERVAL 30 DAY")).alias("order_estimated_delivery_date"),
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").cast("string").alias("customer_state"),
    )
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
    )
    return Shop(customers, orders, items)


class Trial(NamedTuple):
    groups: DataFrame
    late: DataFrame
    active: DataFrame
    checks: DataFrame


def trial(spark: SparkSession, folder: str) -> Trial:
    """Experiment files: groups, the late group file, active ids, payments.

    One market segment arrives late with other headers; the trial ran in the first half
    of 1996, payments are urgent orders from April to September.
    """
    customer = table(spark, folder, "customer")
    grp = F.when(F.col("c_custkey") % 2 == 0, F.lit("A")).otherwise(F.lit("B"))
    late_segment = F.col("c_mktsegment") == "MACHINERY"
    orders = table(spark, folder, "orders")
    day = F.col("o_orderdate")
    return Trial(
        customer.filter(~late_segment).select(F.col("c_custkey").alias("id"), grp.alias("grp")),
        customer.filter(late_segment).select(F.col("c_custkey").alias("user"), grp.alias("g")),
        orders.filter((day >= "1996-01-01") & (day < "1996-07-01"))
        .select(F.col("o_custkey").alias("student_id"))
        .distinct(),
        orders.filter(
            (F.col("o_orderpriority") == "1-URGENT") & (day >= "1996-04-01") & (day < "1996-10-01")
        )
        .groupBy(F.col("o_custkey").alias("student_id"))
        .agg(F.sum("o_totalprice").alias("rev")),
    )


class Platform(NamedTuple):
    students: DataFrame
    answers: DataFrame
    payments: DataFrame


def platform(spark: SparkSession, folder: str) -> Platform:
    """Course platform: students with a test group, answers, payments."""
    events = table(spark, folder, "events")
    subject = F.when(F.col("event_id") % 7 == 0, F.lit("Math")).otherwise(F.lit("Other"))
    test_grp = F.when(F.col("user_id") % 2 == 0, F.lit("control")).otherwise(F.lit("pilot"))
    student = F.col("user_id").alias("st_id")
    return Platform(
        events.select(student, test_grp.alias("test_grp")).distinct(),
        events.select(
            student,
            F.col("ts").alias("timest"),
            (F.col("event_type") == "click").cast("int").alias("correct"),
            subject.alias("subject"),
        ),
        events.filter((F.col("event_type") == "purchase") & (F.col("value") > 150)).select(
            student, F.col("value").alias("money"), subject.alias("subject")
        ),
    )


def ab_values(spark: SparkSession, folder: str) -> DataFrame:
    """Order totals written with a decimal comma, in two variants and a rest."""
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("number"),
        F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(",")).alias("value"),
        F.when(status == "F", F.lit("Treatment"))
        .when(status == "O", F.lit("Control"))
        .otherwise(F.lit("Other"))
        .alias("experimentVariant"),
    )


def aa_events(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases of two variants in four app versions; v2.8.0 loses them in variant 0."""
    variant = (F.col("user_id") % 2).cast("int")
    version = F.concat(F.lit("v2."), (F.col("user_id") % 3 + 7).cast("string"), F.lit(".0"))
    bought = (F.col("event_type") == "purchase").cast("int")
    return (
        table(spark, folder, "events")
        .select(
            F.col("event_id").alias("number"),
            variant.alias("experimentVariant"),
            version.alias("version"),
            bought.alias("bought"),
        )
        .withColumn(
            "purchase",
            F.when(
                (F.col("version") == "v2.8.0") & (F.col("experimentVariant") == 0), F.lit(0)
            ).otherwise(F.col("bought")),
        )
        .drop("bought")
    )


class Payments(NamedTuple):
    transfers: DataFrame
    issues: DataFrame
    senders: DataFrame
    rows: int


def payments(spark: SparkSession, folder: str) -> Payments:
    """Transfers from customers to suppliers, and an issue date for every sender.

    ``rows`` is the number of order lines, read from the files' footers: about that of transfers.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_shipdate", "l_extendedprice"
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"
    )
    rows = lines.count()
    transfers = skew_safe_join(
        lines, orders.select("l_orderkey", "o_custkey"), ["l_orderkey"], rows=rows
    ).select(
        F.col("o_custkey").alias("id_sender"),
        F.col("l_suppkey").alias("id_receiver"),
        F.col("l_shipdate").cast("date").alias("dates"),
        F.col("l_extendedprice").alias("amount_new"),
    )
    issues = orders.groupBy(F.col("o_custkey").alias("id_sender")).agg(
        F.date_add(
            F.min("o_orderdate").cast("date"), (F.col("o_custkey") % 365).cast("int")
        ).alias("date_cred")
    )
    senders = orders.select(F.col("o_custkey").alias("id_sender"))
    return Payments(transfers, issues, senders, rows)


def graph_transfers(spark: SparkSession, folder: str, cleaned: DataFrame) -> DataFrame:
    """Cleaned transfers with ids that tell customers from suppliers."""
    return cleaned.select(
        F.concat(F.lit("c"), F.col("id_sender").cast("string")).alias("id_sender"),
        F.concat(F.lit("s"), F.col("id_receiver").cast("string")).alias("id_receiver"),
        "amount_new",
    )


def domains(spark: SparkSession, folder: str) -> DataFrame:
    """Ranked domain list: the host of every page."""
    return table(spark, folder, "pages").select(
        F.col("page_id").cast("bigint").alias("rank"), url_host(F.col("url")).alias("domain")
    )


class Register(NamedTuple):
    people: DataFrame
    sales: DataFrame


def register(spark: SparkSession, folder: str) -> Register:
    people = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    sales = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("people_id"),
        F.col("o_orderpriority").alias("sale"),
        F.col("o_totalprice").alias("price"),
    )
    return Register(people, sales)


def film_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Listing texts of films written from the part table; some ratings are no numbers."""
    text = lambda name: F.col(name).cast("string")
    size = F.col("p_size")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.concat(
            text("p_partkey"), F.lit(".\n"), text("p_name"), F.lit("\n("),
            (size + 1950).cast("string"), F.lit(")"),
        ).alias("heading"),
        F.when(size == 13, F.lit("n/a"))
        .otherwise(F.concat((size % 10).cast("string"), F.lit(".5")))
        .alias("rating"),
        text("p_type").alias("genre"),
        F.concat(
            F.when(size % 2 == 0, F.lit("Directors:\n")).otherwise(F.lit("Director:\n")),
            text("p_brand"), F.lit("\nStars:\n"), text("p_name"), F.lit(",\n"), text("p_type"),
        ).alias("credits"),
    )


def embedding_features(spark: SparkSession, folder: str) -> DataFrame:
    """Embedding vectors, whatever their length, as ``vector`` with a text target."""
    vector = array_to_vector(F.col("embedding").cast("array<double>")).alias("vector")
    return table(spark, folder, "embeddings").select(
        "vec_id", vector, F.col("label").cast("string").alias("target")
    )
