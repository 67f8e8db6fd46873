"""People ranked by their number of sales; recursive query check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.ordering import running_counts
from ledgerloom.operators.skew import skew_safe_join


def sales_rank(people: DataFrame, sales: DataFrame) -> DataFrame:
    """All columns of the people with sales, ``sale_count`` and ``sale_rank`` (fewest first).

    A rank is one more than the people with fewer sales, from the running counts of the
    distinct numbers of sales; the join spreads a number that very many people have.
    """
    counted = sales.groupBy(F.col("people_id").alias("id")).agg(F.count("sale").alias("sale_count"))
    ranked = people.join(counted, "id")
    ranks = running_counts(counted.join(people.select("id"), "id"), "sale_count", {"n": F.lit(1)})
    ranks = ranks.select("sale_count", (F.col("n_before") + 1).alias("sale_rank"))
    return skew_safe_join(ranked, ranks, ["sale_count"], sketch_of=counted).select(
        *people.columns, "sale_count", "sale_rank"
    )


def fibonacci(spark: SparkSession, below: int = 1_700_000_000_000_000_000) -> DataFrame:
    """Fibonacci numbers by a recursive query (90 with the default limit)."""
    return spark.sql(
        """
        WITH RECURSIVE pairs(a, b) AS (
            SELECT CAST(0 AS BIGINT), CAST(1 AS BIGINT)
            UNION ALL
            SELECT b, a + b FROM pairs WHERE a < :below
        )
        SELECT a AS number FROM pairs
        """,
        args={"below": below},
    )
