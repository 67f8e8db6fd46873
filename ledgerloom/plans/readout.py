"""Readouts: conversion, average check, A/B on heavy-tailed values, A/A audit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scoring import verdict
from ledgerloom.functions.text import decimal_comma
from ledgerloom.operators.resampling import (
    aa_simulation,
    bootstrap_replicates,
    bootstrap_summary,
    false_positive_rate,
)
from ledgerloom.operators.stats import (
    chi_square,
    contingency,
    mann_whitney,
    normality_test,
    t_test,
)
from ledgerloom.session import reliable_checkpoint


def conversion_readout(full: DataFrame, a="A", b="B", alpha: float = 0.05) -> DataFrame:
    """Contingency of payers, chi-square test and verdict (one row)."""
    table = contingency(full, "grp", F.col("rev") > 0, a, b)
    tested = chi_square(table)
    return tested.withColumn("verdict", verdict(F.col("p_value"), alpha))


def _row(df: DataFrame, test: str, statistic: str, p_value: str = "p_value") -> DataFrame:
    return df.select(
        F.lit(test).alias("test"),
        F.col(statistic).cast("double").alias("statistic"),
        F.col(p_value).cast("double").alias("p_value"),
    )


def _readout(rows: Sequence[DataFrame], alpha: float) -> DataFrame:
    return reduce(DataFrame.unionByName, rows).withColumn(
        "verdict", verdict(F.col("p_value"), alpha)
    )


def _normality_rows(df: DataFrame, value: str, group: str, labels: Sequence, suffix: str = ""):
    tested = normality_test(df.filter(F.col(group).isin(list(labels))), value, (group,))
    name = F.concat(F.lit(f"normality{suffix} "), F.col(group).cast("string"))
    return tested.select(
        name.alias("test"), F.col("k2").alias("statistic"), F.col("p_value")
    )


def average_check_readout(
    full: DataFrame, key: Column, a="A", b="B", replicates: int = 1000, alpha: float = 0.05
) -> DataFrame:
    """Payments of payers: normality per group, bootstrap of the mean, U test.

    The payers are checkpointed, because every test reads them.
    """
    payers = reliable_checkpoint(
        full.filter((F.col("rev") > 0) & F.col("grp").isin(a, b)).select(
            "grp", "rev", key.alias("__key")
        )
    )
    key = F.col("__key")
    boot = bootstrap_summary(bootstrap_replicates(payers, "rev", "grp", a, b, key, replicates))
    rows = [
        _normality_rows(payers, "rev", "grp", (a, b)),
        _row(boot, "bootstrap mean", "mean"),
        _row(mann_whitney(payers, "rev", "grp", a, b), "mann-whitney", "u"),
    ]
    return _readout(rows, alpha)


def ab_readout(
    df: DataFrame,
    value: str,
    group: str,
    treatment,
    control,
    key: Column,
    cut: float,
    replicates: int = 1000,
    alpha: float = 0.05,
) -> DataFrame:
    """All tests of a heavy-tailed value, then the t test without the treatment's outliers.

    One row per test: normality, t, U, median bootstrap, and after the cut normality of
    the treatment and t again.  The parsed values are checkpointed, because every test
    reads them.
    """
    df = reliable_checkpoint(
        df.filter(F.col(group).isin(treatment, control)).select(group, value, key.alias("__key"))
    )
    key = F.col("__key")
    boot = bootstrap_summary(
        bootstrap_replicates(df, value, group, treatment, control, key, replicates, "median")
    )
    kept = cut_outliers(df, value, group, treatment, cut)
    rows = [
        _normality_rows(df, value, group, (treatment, control)),
        _row(t_test(df, value, group, treatment, control), "t test", "t"),
        _row(mann_whitney(df, value, group, treatment, control), "mann-whitney", "u"),
        _row(boot, "bootstrap median", "mean"),
        _normality_rows(kept, value, group, (treatment,), " after cut"),
        _row(t_test(kept, value, group, treatment, control), "t test after cut", "t"),
    ]
    return _readout(rows, alpha)


def cut_outliers(df: DataFrame, value: str, group: str, label, limit: float) -> DataFrame:
    """Drop the rows of one group at or above a limit."""
    return df.filter(~F.col(group).eqNullSafe(label) | (F.col(value) < limit))


def parse_ab_values(raw: DataFrame) -> DataFrame:
    """Experiment values written with a decimal comma."""
    return raw.withColumn("value", decimal_comma(F.col("value")))


def without_version(df: DataFrame, version: str, column: str = "version") -> DataFrame:
    """All rows but one version; rows without a version stay."""
    return df.filter(~F.col(column).eqNullSafe(version))


def segment_means(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Mean of a value per segment, to find the one that breaks an A/A test."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.avg(value).alias("mean"))


def aa_audit(
    df: DataFrame,
    value: str,
    group: str,
    a,
    b,
    key: str,
    size: int = 1000,
    simulations: int = 1000,
    seed: int = 1,
    alpha: float = 0.05,
) -> DataFrame:
    """Share of A/A simulations that call a difference (one row)."""
    simulated = aa_simulation(df, value, group, a, b, key, size, simulations, seed)
    return false_positive_rate(simulated, alpha)
