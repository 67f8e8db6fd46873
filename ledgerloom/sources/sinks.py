"""Writers of results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.skew import skew_safe_join


def write_csv(
    df: DataFrame, path: str, header: bool = True, one_file: bool = False, sep: str = ","
) -> None:
    """CSV with or without a header; ``one_file`` is for short reports."""
    writer = (df.coalesce(1) if one_file else df).write.mode("overwrite")
    writer.option("header", header).option("sep", sep).csv(path)


def write_partitions(
    df: DataFrame, path: str, keys: Sequence[str], files_per_partition: int = 1
) -> None:
    """Add or replace the partitions whose keys occur in ``df``; all others stay untouched.

    A second run of a day replaces that day and nothing else.  The new files come into
    place when the job commits, so a run that fails leaves the table as it was.  The rows
    of a partition are written as a fixed number of files.
    """
    dealt = df.withColumn("__file", F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition)))
    (
        dealt.repartition(*keys, "__file").drop("__file")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).parquet(path)
    )


def component_folder(component: Column, folders: int) -> Column:
    """Number of the folder that holds a component."""
    return F.pmod(F.xxhash64(component), F.lit(folders)).cast("int")


def write_components(
    nodes: DataFrame,
    edges: DataFrame,
    totals: DataFrame,
    path: str,
    rows_per_file: int = 1_000_000,
    folders: int = 1000,
) -> None:
    """Nodes and edges of a graph, each component in one of ``folders`` folders.

    The number of folders does not grow with the number of components, and inside a folder
    the rows are sorted, so one component is read from few row groups.  A giant component is
    written by as many tasks as its size (from ``totals``: component, n_nodes, n_edges)
    asks for.
    """
    for table, key, size, name in (
        (nodes, "node", "n_nodes", "nodes"), (edges, "dst", "n_edges", "edges")
    ):
        files = F.greatest(F.ceil(F.col(size) / rows_per_file), F.lit(1))
        sized = totals.select("component", files.alias("__files"))
        (
            skew_safe_join(table, sized, ["component"])
            .withColumn("folder", component_folder(F.col("component"), folders))
            .withColumn("__file", F.pmod(F.xxhash64(key), F.col("__files")))
            .repartition("folder", "__file")
            .sortWithinPartitions("folder", "component")
            .drop("__files", "__file")
            .write.mode("overwrite")
            .partitionBy("folder")
            .parquet(f"{path}/{name}")
        )


def read_component(spark: SparkSession, path: str, name: str, component, folders: int = 1000):
    """Nodes or edges of one written component; only its folder is read."""
    folder = component_folder(F.lit(component), folders)
    return spark.read.parquet(f"{path}/{name}").filter(
        (F.col("folder") == folder) & (F.col("component") == component)
    ).drop("folder")


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows, for looking at a table."""
    return df.limit(rows)


def single_value(df: DataFrame):
    """The value of a one-row, one-column result, for use at the edge of a program."""
    row = df.first()
    return None if row is None else row[0]
