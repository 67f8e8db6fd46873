"""Orders: purchases, non-delivery, favourite weekday, purchases per week.

Tables: ``customers`` (customer_id, customer_unique_id, customer_state), ``orders``
(order_id, customer_id, order_status, order_approved_at, order_delivered_customer_date,
order_estimated_delivery_date), ``items`` (order_id, product_id, price).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_label, weekday_name, weeks_in_month
from ledgerloom.operators.aggregates import mean_of_counts, top_value_per_key, value_counts
from ledgerloom.operators.skew import skew_safe_join

# Weekdays as Spark names them.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
# Order states that are not a purchase.
NOT_BOUGHT = ("canceled", "unavailable")


def purchases(orders: DataFrame, not_bought: Sequence[str] = NOT_BOUGHT) -> DataFrame:
    """Orders that count as a purchase: approved, and not canceled or unavailable.

    A missing status is kept, as an inequality in pandas keeps it.
    """
    kept = F.col("order_approved_at").isNotNull()
    for status in not_bought:
        kept = kept & ~F.col("order_status").eqNullSafe(status)
    return orders.filter(kept)


def customer_purchases(customers: DataFrame, bought: DataFrame) -> DataFrame:
    """Purchases with the customer's attributes, balanced when one customer buys most."""
    return skew_safe_join(bought, customers, ["customer_id"])


def purchases_per_customer(customers: DataFrame, bought: DataFrame) -> DataFrame:
    """Number of purchases per person; counted per customer id before the join."""
    counted = bought.groupBy("customer_id").agg(F.count("customer_id").alias("n"))
    return (
        counted.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .filter(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id")
        .agg(F.sum("n").alias("number_orders"))
    )


def one_time_buyers(customers: DataFrame, bought: DataFrame) -> DataFrame:
    """How many people bought exactly once (one row)."""
    once = purchases_per_customer(customers, bought).filter(F.col("number_orders") == 1)
    return once.agg(F.count("customer_unique_id").alias("one_time_buyers"))


def not_delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_delivered_customer_date").isNull())


def orders_by_estimated_month(orders: DataFrame, name: str) -> DataFrame:
    """Orders per month number of the estimated delivery date, fewest first."""
    return (
        orders.withColumn("month", F.month("order_estimated_delivery_date"))
        .filter(F.col("month").isNotNull())
        .groupBy("month")
        .agg(F.count("order_id").alias(name))
        .orderBy(name, "month")
    )


def mean_by_estimated_month(orders: DataFrame, name: str) -> DataFrame:
    """Mean over months of the orders per month (one row)."""
    return mean_of_counts(orders, F.month("order_estimated_delivery_date"), "order_id", name)


def status_counts(orders: DataFrame) -> DataFrame:
    return value_counts(orders, "order_status")


def missing_delivery_by_status(orders: DataFrame) -> DataFrame:
    """Per status: orders, and orders without a delivery date."""
    return orders.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("order_delivered_customer_date").isNull()).alias("n_missing"),
    )


def missing_delivery_by_state(
    customers: DataFrame, orders: DataFrame, status: str = "delivered"
) -> DataFrame:
    """Orders of one status without a delivery date, per state; counted before the join."""
    missing = (
        not_delivered(orders)
        .filter(F.col("order_status") == status)
        .groupBy("customer_id")
        .agg(F.count("order_id").alias("n"))
    )
    return (
        missing.join(customers.select("customer_id", "customer_state"), "customer_id")
        .filter(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(F.sum("n").alias("n_missing"))
    )


def months_present(orders: DataFrame, column: str) -> DataFrame:
    """Distinct ``YYYY-MM`` labels of a timestamp column."""
    return orders.select(month_label(F.col(column)).alias("month")).distinct()


def favourite_weekday(items: DataFrame, bought: DataFrame) -> DataFrame:
    """Per product the weekday it is bought most; ties go to the first name.

    The join spreads an order with very many lines.
    """
    lines = items.filter(F.col("product_id").isNotNull()).select("order_id", "product_id")
    days = bought.select("order_id", weekday_name(F.col("order_approved_at")).alias("weekday"))
    joined = skew_safe_join(lines, days, ["order_id"])
    return top_value_per_key(
        joined, "product_id", "weekday", WEEKDAYS, F.lit(1), "prod_count"
    )


def purchases_per_week(customers: DataFrame, bought: DataFrame, leap: bool = True) -> DataFrame:
    """Per person and month: purchases, weeks in the month, purchases per week.

    ``leap=False`` gives February 28 days in every year.
    """
    monthly = bought.groupBy(
        "customer_id", F.trunc(F.col("order_approved_at").cast("date"), "month").alias("start")
    ).agg(F.count("customer_id").alias("n"))
    per_person = (
        monthly.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .filter(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id", "start")
        .agg(F.sum("n").alias("purchases"))
    )
    weeks = weeks_in_month(F.col("start"), leap)
    return per_person.select(
        "customer_unique_id",
        month_label(F.col("start")).alias("month"),
        "purchases",
        weeks.alias("weeks"),
        (F.col("purchases") / weeks).alias("purchases_per_week"),
    )
