"""Seeded synthetic tables, generated on the executors from a row range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import date_or_28
from ledgerloom.functions.sampling import uniform_draw

ID_LOW, ID_HIGH = 1000, 10000
AMOUNT_LOW, AMOUNT_HIGH = 100.5, 1_000_000.0


def whole_number(key: Column, seed: int, low: int, high: int) -> Column:
    """Uniform whole number in [low, high]."""
    return (F.floor(uniform_draw(key, seed) * (high - low + 1)) + low).cast("int")


def pick(key: Column, seed: int, choices: Sequence) -> Column:
    """Uniform choice from a short fixed list."""
    position = whole_number(key, seed, 1, len(choices))
    return F.element_at(F.array(*[F.lit(c) for c in choices]), position)


def random_date(key: Column, seed: int, years: tuple[int, int] = (2023, 2024)) -> Column:
    """Uniform year, month and day 1..31; a day the month lacks becomes the 28th."""
    return date_or_28(
        whole_number(key, seed, *years),
        whole_number(key, seed + 1, 1, 12),
        whole_number(key, seed + 2, 1, 31),
    )


def amounts(key: Column, seed: int) -> Column:
    return F.round(AMOUNT_LOW + uniform_draw(key, seed) * (AMOUNT_HIGH - AMOUNT_LOW), 2)


def transfers(spark: SparkSession, rows: int, seed: int = 1) -> DataFrame:
    """``id_sender, id_receiver, dates, amount_new`` with uniform values."""
    key = F.col("id")
    return spark.range(rows).select(
        whole_number(key, seed, ID_LOW, ID_HIGH).alias("id_sender"),
        whole_number(key, seed + 10, ID_LOW, ID_HIGH).alias("id_receiver"),
        random_date(key, seed + 20).alias("dates"),
        amounts(key, seed + 30).alias("amount_new"),
    )


def issue_dates(
    transfers: DataFrame, sender: str = "id_sender", seed: int = 1, years=(2023, 2024)
) -> DataFrame:
    """One row per known sender with a random issue date."""
    senders = transfers.select(sender).dropna().distinct()
    return senders.withColumn("date_cred", random_date(F.col(sender), seed, years))


def graph_rows(
    spark: SparkSession, rows: int, receivers: Sequence[int], seed: int = 1
) -> DataFrame:
    """``id_sender, id_receiver, amount`` with receivers from a short list."""
    key = F.col("id")
    return spark.range(rows).select(
        whole_number(key, seed, 100, ID_HIGH).alias("id_sender"),
        pick(key, seed + 10, receivers).alias("id_receiver"),
        amounts(key, seed + 20).alias("amount"),
    )


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows written in the program, with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def columns_to_table(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    """A dict of equally long value lists to a table."""
    return spark.createDataFrame(list(zip(*columns.values(), strict=True)), schema)
