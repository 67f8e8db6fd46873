"""Session settings and reliable checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession


def build_session(name: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    ``conf`` keys use ``__`` in place of dots, e.g. ``spark__sql__shuffle__partitions``.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_width(spark: SparkSession) -> int:
    """Number of partitions a shuffle of this session makes."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it.

    On a cluster the library is installed on every machine; an extra path does no harm.
    """
    root = str(Path(__file__).resolve().parent.parent)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        joined = os.pathsep.join(filter(None, [paths, root]))
        spark.sparkContext.environment["PYTHONPATH"] = joined


def checkpoint_folder(spark: SparkSession) -> str:
    """This application's own folder below ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    folder = folder or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="ledgerloom-")
        context.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/{context.applicationId}"


def measured_checkpoint(df: DataFrame, *metrics: Column) -> tuple[DataFrame, str, dict]:
    """Write ``df`` as a table of its own: the table, its path, and aggregates of its rows.

    The named aggregates are read from the written table, in one job for all.  (An
    ``Observation`` would save that job, but a session that has one can no longer
    serialize the functions of Spark ML models.)
    """
    path = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return table, path, table.agg(*metrics).first().asDict(recursive=True) if metrics else {}


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    This cuts the lineage, survives the loss of any executor, and gives the next plan the
    real size of the table.  The folder comes from ``spark.checkpoint.dir``; a temporary
    one is made only in local mode.
    """
    return measured_checkpoint(df)[0]


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table or folder of the checkpoint folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def remove_checkpoints(spark: SparkSession) -> None:
    """Delete all tables this application wrote to the checkpoint folder, at its end."""
    remove_path(spark, checkpoint_folder(spark))
