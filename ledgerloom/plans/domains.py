"""Daily domain report: top zones, longest domain, rank of one domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import last_part
from ledgerloom.sources.sinks import write_partitions


def top_zones(domains: DataFrame, rows: int = 10) -> DataFrame:
    """The zones with most domains."""
    zone = last_part(F.col("domain")).alias("zone")
    counted = domains.groupBy(zone).agg(F.count("domain").alias("n"))
    return counted.filter(F.col("n") > 0).orderBy(F.desc("n"), "zone").limit(rows)


def longest_domain(domains: DataFrame) -> DataFrame:
    """The longest domain with its rank and length (one row); the first name on ties."""
    return (
        domains.select("rank", "domain", F.length("domain").alias("len_domain"))
        .filter(F.col("domain").isNotNull())
        .orderBy(F.desc("len_domain"), "domain", "rank")
        .limit(1)
    )


def domain_rank(domains: DataFrame, domain: str) -> DataFrame:
    """Rank of one domain."""
    return domains.filter(F.col("domain") == domain).select("rank")


def domain_report(domains: DataFrame, ds: str, domain: str, rows: int = 10) -> DataFrame:
    """The three results of one day as labelled rows: ``ds``, ``section``, ``key``, ``value``.

    Each part is one pruned scan: a hash aggregate, a top-1 per partition, and a filter.
    """

    def section(df: DataFrame, name: str, key, value) -> DataFrame:
        return df.select(
            F.lit(ds).alias("ds"),
            F.lit(name).alias("section"),
            key.alias("key"),
            value.cast("string").alias("value"),
        )

    parts = [
        section(top_zones(domains, rows), "top zones", F.col("zone"), F.col("n")),
        section(longest_domain(domains), "longest domain", F.col("domain"), F.col("len_domain")),
        section(domain_rank(domains, domain), "domain rank", F.lit(domain), F.col("rank")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


REPORT = "section STRING, key STRING, value STRING, ds STRING"


def publish_report(report: DataFrame, path: str) -> None:
    """Write the reports of one or more days; a day that was written before is replaced."""
    write_partitions(report.select("section", "key", "value", "ds"), path, ["ds"])


def published_reports(spark: SparkSession, path: str, ds: str | None = None) -> DataFrame:
    """Reports of all days, or of one, of which only the folder is read."""
    reports = spark.read.schema(REPORT).parquet(path)
    return reports if ds is None else reports.filter(F.col("ds") == ds)
