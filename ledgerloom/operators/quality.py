"""Profiles and key checks of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ordering import column_quantiles
from ledgerloom.operators.skew import skew_safe_join


def _unpivot_row(df: DataFrame, columns: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """One wide row with ``<prefix><column>`` fields to one row per column."""
    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            *[F.col(f"{prefix}{i}").alias(field) for field, prefix in fields.items()],
        )
        for i, name in enumerate(columns)
    ]
    return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type, non-NULL count and NULL count of every column, in one pass."""
    counts = df.agg(
        *[F.count(F.col(name)).alias(f"f{i}") for i, name in enumerate(df.columns)],
        *[F.count_if(F.col(name).isNull()).alias(f"m{i}") for i, name in enumerate(df.columns)],
    )
    long = _unpivot_row(counts, df.columns, {"non_null": "f", "nulls": "m"})
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return long.withColumn("data_type", types[F.col("column_name")])


def null_counts(df: DataFrame) -> DataFrame:
    """NULL count per column."""
    return column_profile(df).select("column_name", "nulls")


def distinct_count(
    df: DataFrame, column: str, keys: Sequence[str] = (), approximate: bool = False
) -> DataFrame:
    """Distinct values of a column, per key group; a sketch when ``approximate``."""
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    known = df.dropna(subset=list(keys)) if keys else df
    return known.groupBy(*keys).agg(count.alias("n_distinct"))


def key_is_unique(df: DataFrame, key: str, name: str) -> DataFrame:
    """Row count, distinct keys and whether they agree (one row)."""
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(key).alias("n_keys"),
    ).withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles: one row per column."""
    moments = df.agg(
        *[
            aggregate(F.col(name).cast("double")).alias(f"{prefix}{i}")
            for i, name in enumerate(columns)
            for prefix, aggregate in (
                ("n", F.count), ("a", F.avg), ("s", F.stddev_samp), ("l", F.min), ("h", F.max)
            )
        ]
    )
    fields = {"n": "n", "mean": "a", "std": "s", "min": "l", "max": "h"}
    long = _unpivot_row(moments, columns, fields)
    quartiles = column_quantiles(df, columns, (0.25, 0.5, 0.75)).select(
        "column_name", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75")
    )
    return long.join(quartiles, "column_name", "left")


def overlap(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``."""
    ids = right.select(F.col(right_key).alias(left_key)).distinct()
    return skew_safe_join(left, ids, [left_key], "left_semi")


def orphans(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``."""
    ids = right.select(F.col(right_key).alias(left_key)).distinct()
    return skew_safe_join(left, ids, [left_key], "left_anti")


def add_orphans(known: DataFrame, orphan_rows: DataFrame, key: str) -> DataFrame:
    """The known keys plus the keys of the orphan rows."""
    return known.unionByName(orphan_rows, allowMissingColumns=True).select(key)
