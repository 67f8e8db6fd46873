"""Transfer links: keep counterparties known only inside a window around an issue date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import calendar_days
from ledgerloom.operators.skew import skew_safe_join, task_count
from ledgerloom.session import measured_checkpoint

WINDOW = (-1, 7)


def dated_transfers(
    transfers: DataFrame,
    issues: DataFrame,
    senders: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Transfers with ``diff_time``, the days since the sender's issue date.

    Senders without an issue date drop out.  A sender with very many transfers is spread
    over several tasks; ``senders`` is a cheaper table to find such senders in.  ``rows``,
    about the number of transfers, gives many transfers tasks in proportion.
    """
    joined = skew_safe_join(transfers, issues, ["id_sender"], sketch_of=senders, rows=rows)
    return joined.withColumn("diff_time", calendar_days(F.col("date_cred"), F.col("dates")))


def inside_window(dated: DataFrame, window: tuple[int, int] = WINDOW) -> DataFrame:
    """Transfers inside the window."""
    return dated.filter(F.col("diff_time").between(*window))


def known_pairs(
    dated: DataFrame, window: tuple[int, int] = WINDOW, rows: int | None = None
) -> DataFrame:
    """Sender and receiver pairs with a transfer outside the window, each once.

    Transfers just dated are together by sender already; of a table, give the number of rows.
    """
    outside = dated.filter(~F.col("diff_time").between(*window))
    pairs = outside.select("id_sender", "id_receiver")
    tasks = task_count(dated.sparkSession, rows)
    if tasks:
        pairs = pairs.repartition(tasks, "id_sender", "id_receiver")
    return pairs.distinct().withColumn("flag", F.lit("known link"))


def clean_links(dated: DataFrame, window: tuple[int, int] = WINDOW) -> DataFrame:
    """Transfers inside the window to receivers the sender never paid outside of it.

    The dated transfers are checkpointed once, because both branches read them.
    """
    dated, _, seen = measured_checkpoint(dated, F.count(F.lit(1)).alias("rows"))
    known = known_pairs(dated, window, seen["rows"]).drop("flag")
    # One row per pair on the right; a hot pair on the left is spread.
    return skew_safe_join(
        inside_window(dated, window), known, ["id_sender", "id_receiver"], "left_anti"
    )
