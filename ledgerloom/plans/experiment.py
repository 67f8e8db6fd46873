"""Experiment metrics by group, platform metrics by group, diligent students."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_number, month_start
from ledgerloom.functions.numeric import percent, ratio, round_even
from ledgerloom.operators.quality import add_orphans, orphans
from ledgerloom.sources.readers import rename_by_position


class Experiment(NamedTuple):
    """Result of ``experiment_metrics``."""

    metrics: DataFrame
    full: DataFrame


def all_groups(groups: DataFrame, late: DataFrame) -> DataFrame:
    """Both group files; the late one may have other headers."""
    return rename_by_position(groups, "id", "grp").unionByName(
        rename_by_position(late, "id", "grp")
    )


def participants(
    groups: DataFrame, late: DataFrame, active: DataFrame, checks: DataFrame
) -> DataFrame:
    """One row per active id: ``id``, ``grp``, ``rev`` (0 without a payment).

    Payers missing from the active list are added to it.  An id outside both group files
    keeps a NULL group, so that it is visible and never forms a group of its own.
    """
    payers = orphans(checks, active, "student_id", "student_id")
    known = add_orphans(active, payers, "student_id").withColumnRenamed("student_id", "id")
    paid = checks.withColumnRenamed("student_id", "id")
    return (
        known.join(all_groups(groups, late), "id", "left")
        .join(paid, "id", "left")
        .fillna({"rev": 0.0})
        .select("id", "grp", "rev")
    )


def group_metrics_of(full: DataFrame) -> DataFrame:
    """Per group: ids, payers, conversion in percent, mean payment of the payers."""
    paying = F.col("rev") > 0
    return (
        full.filter(F.col("grp").isNotNull())
        .groupBy("grp")
        .agg(
            F.count("id").alias("count_id"),
            F.count(F.when(paying, F.col("id"))).alias("pay_id"),
            F.avg(F.when(paying, F.col("rev"))).alias("mean"),
        )
        .select(
            "grp",
            "count_id",
            "pay_id",
            percent(F.col("pay_id"), F.col("count_id")).alias("cr"),
            round_even(F.col("mean"), 2).alias("mean_check"),
        )
    )


def experiment_metrics(
    groups: DataFrame, late: DataFrame, active: DataFrame, checks: DataFrame
) -> Experiment:
    """Metrics by group together with the full table they come from."""
    full = participants(groups, late, active, checks)
    return Experiment(group_metrics_of(full), full)


def group_sizes(full: DataFrame) -> DataFrame:
    """Chart data: all ids and paying ids of every group, with a label."""
    counted = group_metrics_of(full)
    return counted.select(
        "grp",
        F.inline(
            F.array(
                F.struct(F.lit("paying").alias("label"), F.col("pay_id").alias("n_ids")),
                F.struct(F.lit("all").alias("label"), F.col("count_id").alias("n_ids")),
            )
        ),
    ).filter((F.col("label") == "all") | (F.col("n_ids") > 0))


def student_features(
    students: DataFrame, answers: DataFrame, payments: DataFrame, subject: str = "Math"
) -> DataFrame:
    """One row per student: correct answers, money and purchases, in all and in a subject."""
    correct = answers.groupBy("st_id").agg(
        F.sum("correct").alias("correct"),
        F.sum(F.when(F.col("subject") == subject, F.col("correct"))).alias("correct_subject"),
    )
    paid = payments.groupBy("st_id").agg(
        F.sum("money").alias("money"),
        F.lit(1).alias("bought"),
        F.max(F.when(F.col("subject") == subject, 1).otherwise(0)).alias("bought_subject"),
    )
    return (
        students.select("st_id", "test_grp")
        .distinct()
        .join(correct, "st_id", "left")
        .join(paid, "st_id", "left")
        .fillna(0)
    )


def platform_metrics(features: DataFrame, active_over: int = 10, subject_from: int = 2):
    """Per group: ARPU, ARPAU, conversion of all, of the active, of the active in a subject.

    ARPAU divides the money of the whole group by its active students.  Groups without
    buyers stay, with 0.
    """
    active = F.col("correct") > active_over
    active_subject = F.col("correct_subject") >= subject_from
    bought, bought_subject = F.col("bought") == 1, F.col("bought_subject") == 1
    counts = (
        features.filter(F.col("test_grp").isNotNull())
        .groupBy("test_grp")
        .agg(
            F.count("st_id").alias("students"),  # one row per student and group
            F.sum("money").alias("income"),
            F.count_if(bought).alias("buyers"),
            F.count_if(active).alias("active"),
            F.count_if(active & bought).alias("active_buyers"),
            F.count_if(active_subject).alias("active_subject"),
            F.count_if(active_subject & bought_subject).alias("subject_buyers"),
        )
    )
    return counts.select(
        "test_grp",
        round_even(ratio(F.col("income"), F.col("students")), 2).alias("arpu"),
        round_even(ratio(F.col("income"), F.col("active")), 2).alias("arpau"),
        percent(F.col("buyers"), F.col("students")).alias("cr"),
        percent(F.col("active_buyers"), F.col("active")).alias("cr_active"),
        percent(F.col("subject_buyers"), F.col("active_subject")).alias("cr_active_subject"),
    )


def diligent_students(
    answers: DataFrame, by_subject: bool = False, at_least: int = 20
) -> DataFrame:
    """Students with enough correct answers whose answers all lie in one month (one row).

    ``by_subject`` counts student and subject pairs instead.
    """
    keys = ["st_id", "subject"] if by_subject else ["st_id"]
    spans = answers.groupBy(*keys).agg(
        F.sum("correct").alias("correct"),
        F.min("timest").alias("first_time"),
        F.max("timest").alias("last_time"),
    )
    months = month_number(F.col("last_time")) - month_number(F.col("first_time"))
    return (
        spans.filter((F.col("correct") >= at_least) & (months < 1))
        .agg(F.count("st_id").alias("count_id"))
    )


def diligent_monthly(answers: DataFrame, at_least: int = 20) -> DataFrame:
    """Students who reach the number in at least one month (one row)."""
    months = answers.groupBy("st_id", month_start(F.col("timest")).alias("month")).agg(
        F.sum("correct").alias("correct")
    )
    return months.filter(F.col("correct") >= at_least).agg(
        F.count_distinct("st_id").alias("count_id")
    )
