"""Recency, frequency and monetary segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import report_day, whole_days
from ledgerloom.functions.scoring import high_is_good, low_is_good, segment_name
from ledgerloom.operators.aggregates import value_counts
from ledgerloom.operators.ordering import column_quantiles
from ledgerloom.session import reliable_checkpoint

MEASURES = ("Recency", "Frequency", "Monetary")
QUINTILES = (0.2, 0.4, 0.6, 0.8)


def rfm_measures(customers: DataFrame, bought: DataFrame, items: DataFrame) -> DataFrame:
    """Per person: full days since the last purchase, purchases, money.

    The report day is one day after the last purchase of all.  Only purchases with items
    count.  Everything is summed per order, then per customer id, before each join.  The
    one row per person that remains is checkpointed: the report day, the cut points and
    the scores all read it.
    """
    order_totals = items.groupBy("order_id").agg(
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("price")
    )
    priced = bought.select("order_id", "customer_id", "order_approved_at").join(
        order_totals, "order_id"
    )
    per_customer = priced.groupBy("customer_id").agg(
        F.max("order_approved_at").alias("last"),
        F.count("customer_id").alias("n"),
        F.sum("price").alias("price"),
    )
    per_person = reliable_checkpoint(
        per_customer.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .filter(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id")
        .agg(
            F.max("last").alias("last"),
            F.sum("n").alias("Frequency"),
            F.sum("price").alias("Monetary"),
        )
    )
    today = per_person.agg(report_day(F.max("last")).alias("today")).scalar()
    return per_person.select(
        "customer_unique_id",
        whole_days(F.col("last"), today).alias("Recency"),
        "Frequency",
        "Monetary",
    )


def rfm_cuts(measures: DataFrame, exact: bool = True) -> DataFrame:
    """Quintile cut points of the three measures, one row per measure."""
    return column_quantiles(measures, MEASURES, QUINTILES, exact)


def rfm_scores(measures: DataFrame, cuts: DataFrame) -> DataFrame:
    """Scores 1 to 5, the three-digit code and the segment of every person.

    The cut points, four numbers for each of three measures, enter the plan as one row;
    without purchases there are none, and no person to score.
    """
    names = [f"q{i}" for i in range(len(QUINTILES))]
    per_measure = F.map_from_entries(F.collect_list(F.struct("column_name", F.array(*names))))
    points = cuts.agg(per_measure.alias("points")).scalar()
    measures = measures.withColumn("__cuts", points)
    cut = {
        name: [F.col("__cuts")[name][i] for i in range(len(QUINTILES))] for name in MEASURES
    }
    scored = measures.select(
        *[name for name in measures.columns if name != "__cuts"],
        low_is_good(F.col("Recency"), cut["Recency"]).alias("R"),
        high_is_good(F.col("Frequency"), cut["Frequency"]).alias("F"),
        high_is_good(F.col("Monetary"), cut["Monetary"]).alias("M"),
    )
    coded = scored.withColumn("RFM", F.concat("R", "F", "M").cast("int"))
    return coded.withColumn("segment", segment_name(F.col("R"), F.col("F")))


def rfm(
    customers: DataFrame, bought: DataFrame, items: DataFrame, exact: bool = True
) -> DataFrame:
    """The whole job: measures, cut points, scores, segments."""
    measures = rfm_measures(customers, bought, items)
    return rfm_scores(measures, rfm_cuts(measures, exact))


def segment_counts(scored: DataFrame) -> DataFrame:
    """People per segment; people without one are left out."""
    return value_counts(scored, "segment")
