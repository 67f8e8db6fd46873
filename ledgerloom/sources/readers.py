"""CSV variants, SQL sources and test tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import reliable_checkpoint

BAD_LINE = "__line"


def read_csv(
    spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True
) -> DataFrame:
    """CSV with a declared schema; ``header=False`` for files that start with data."""
    return (
        spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)
    )


class CheckedRows(NamedTuple):
    """The rows of a file that fit its schema, and the lines that do not: ``line`` and ``n``."""

    good: DataFrame
    rejects: DataFrame


def read_checked_csv(
    spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True,
    required: tuple[str, ...] = (),
) -> CheckedRows:
    """CSV split into rows that fit the declared schema and a table of rejected lines.

    A line is rejected if it has too few or too many fields, a field that is no value of
    its type, or nothing in a ``required`` column.  Every column is parsed whatever a query
    asks for, so a row is never good for one query and bad for another.  The rejects are
    written to the checkpoint folder at once, equal lines counted; good rows are read from
    the file.
    """
    read = (
        spark.read.schema(f"{schema}, {BAD_LINE} STRING").option("sep", sep).option("header", header)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE).csv(path)
    )
    columns = [name for name in read.columns if name != BAD_LINE]
    lacking = F.lit(False)
    for name in required:
        lacking = lacking | F.col(name).isNull()
    # A line whose fields all fit keeps no text, so one that lacks a value is written anew.
    anew = F.concat_ws(sep, *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns])
    # The reader only parses columns that are asked for, so the test asks for all of them:
    # its second part always holds.
    read_all = F.abs(F.shiftright(F.xxhash64(*columns), 1)) >= 0
    bad = ~(F.col(BAD_LINE).isNull() & read_all)
    rejected = read.filter(bad | lacking).select(F.coalesce(BAD_LINE, anew).alias("line"))
    rejects = reliable_checkpoint(rejected.groupBy("line").agg(F.count(F.lit(1)).alias("n")))
    return CheckedRows(read.filter(~bad & ~lacking).select(*columns), rejects)


def read_domains(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``rank,domain`` list."""
    return read_csv(spark, path, "rank BIGINT, domain STRING", header=False)


def land_raw(spark: SparkSession, staged_path: str, schema: str, out_path: str) -> DataFrame:
    """Land a staged (already unpacked) headerless CSV as Parquet and return the landed table."""
    read_csv(spark, staged_path, schema, header=False).write.mode("overwrite").parquet(out_path)
    return spark.read.schema(schema).parquet(out_path)


def read_features(
    spark: SparkSession, path: str, schema: str, index_column: str | None = None
) -> DataFrame:
    """Feature table from CSV without its index column."""
    table = read_csv(spark, path, schema)
    return table.drop(index_column) if index_column else table


def query_source(
    spark: SparkSession, query: str, options: dict[str, str] | None = None, **tables: DataFrame
) -> DataFrame:
    """Result of a SQL text: on the given tables, or pushed to a JDBC database.

    The text names a table as ``{name}``.  Give connection options (url, user, ...) from
    your own secret store.
    """
    if options is None:
        return spark.sql(query, **tables)
    return spark.read.format("jdbc").options(query=query, **options).load()


def rename_by_position(df: DataFrame, *names: str) -> DataFrame:
    """First columns get the given names, whatever the file's headers say; the rest goes."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in zip(df.columns, names)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def page_urls(spark: SparkSession, base: str, first: int, last: int, step: int) -> DataFrame:
    """URLs of a paginated listing: ``base`` followed by first, first+step, ... up to last."""
    return spark.range(first, last + 1, step).select(
        "id", F.concat(F.lit(base), F.col("id").cast("string")).alias("url")
    )


def url_host(url: Column) -> Column:
    """Host name of a URL; NULL for what is no URL."""
    return F.try_parse_url(url, F.lit("HOST"))
