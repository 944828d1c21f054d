"""Analyses of the remediation history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater.functions import rules
from breakwater.functions.ordering import ordered, top
from breakwater.tables import Tables

HISTORY = "vulnerability_remediation"


def remediation_overview(t: Tables) -> DataFrame:
    """Remediated and still present findings, with the average time to fix."""
    days = rules.days_between("firstFoundTimestamp", "lastRemoved")  # NULL while still present
    return (
        t.read(HISTORY, "lastRemoved", "firstFoundTimestamp", "assetId", "cvssV3Score")
        .groupBy(rules.remediation_status().alias("status"))
        .agg(
            F.count("*").alias("vuln_count"),
            F.countDistinct("assetId").alias("affected_assets"),
            F.avg("cvssV3Score").alias("avg_cvss"),
            F.avg(days).alias("avg_days_to_remediate"),
        )
    )


def cve_remediation_status(t: Tables, limit: int = 25) -> DataFrame:
    """Per CVE: assets, findings fixed and open, most open first."""
    keys = ("cveId", "cvssV3Score", "cvssV3Severity")
    history = t.read(HISTORY, *keys, "title", "assetId", "lastRemoved")
    per_asset = history.groupBy(*keys, rules.digest("title"), "assetId").agg(
        F.count("lastRemoved").alias("removed"), F.count("*").alias("found")
    )
    removed, found = F.sum("removed"), F.sum("found")
    counts = per_asset.groupBy(*keys, "title_digest").agg(
        F.count("assetId").alias("total_assets"),
        removed.alias("remediated_count"),
        (found - removed).alias("still_present_count"),
        rules.percent(removed, found).alias("remediation_pct"),
    )
    rows = rules.with_text(counts, history, "title", "cveId").select(
        "cveId", "title", *keys[1:], "total_assets", "remediated_count", "still_present_count", "remediation_pct"
    )
    return top(rows, limit, "-still_present_count")


def remediation_velocity(t: Tables, weeks: int = 12) -> DataFrame:
    """Findings fixed per week, latest weeks first."""
    rows = (
        t.read(HISTORY, "lastRemoved", "firstFoundTimestamp", "assetId", "cvssV3Score")
        .where(F.col("lastRemoved").isNotNull())
        .groupBy(rules.week_of("lastRemoved").alias("remediation_week"))
        .agg(
            F.count("*").alias("vulns_remediated"),
            F.countDistinct("assetId").alias("assets_affected"),
            F.avg(rules.days_between("firstFoundTimestamp", "lastRemoved")).alias("avg_days_open"),
            F.avg("cvssV3Score").alias("avg_cvss_remediated"),
        )
    )
    return top(rows, weeks, "-remediation_week")


def _with_host(t: Tables, rows: DataFrame, limit: int, *keys: str) -> DataFrame:
    """The first ``limit`` rows with host and address of their asset.

    Order depends on the findings alone, so at most ``limit`` rows reach the
    join; the limit applies again after it in case ``assets`` repeats an asset.
    """
    first = top(rows, limit, *keys)
    found = first.join(t.read("assets", "assetId", "hostName", "ip"), "assetId", "left")
    named = ["assetId", "hostName", "ip", *[c for c in rows.columns if c != "assetId"]]
    return top(found.select(*named), limit, *keys, *[c for c in rows.columns if c not in {k.lstrip("-") for k in keys}])


def remediation_regressions(t: Tables, limit: int = 50) -> DataFrame:
    """Findings that came back after removal, newest first."""
    rows = (
        t.read(
            HISTORY, "assetId", "cveId", "title", "cvssV3Score", "firstFoundTimestamp", "lastRemoved",
            "reintroducedTimestamp",
        )
        .where(F.col("reintroducedTimestamp").isNotNull())
        .withColumn("days_until_reintroduction", rules.days_between("lastRemoved", "reintroducedTimestamp"))
    )
    return _with_host(t, rows, limit, "-reintroducedTimestamp")


def high_risk_unremediated(
    t: Tables, as_of: datetime | str | None = None, cvss: float = rules.HIGH_CVSS, limit: int = 50
) -> DataFrame:
    """Open findings at or above a score, by score and age."""
    rows = (
        t.read(
            HISTORY, "assetId", "cveId", "title", "cvssV3Score", "cvssV3Severity", "epssscore",
            "firstFoundTimestamp", "lastRemoved",
        )
        .where(F.col("lastRemoved").isNull() & (F.col("cvssV3Score") >= cvss))
        .drop("lastRemoved")
        .withColumn("days_open", rules.days_between("firstFoundTimestamp", rules.moment(as_of)))
    )
    return _with_host(t, rows, limit, "-cvssV3Score", "-days_open")


def mttr_by_severity(t: Tables) -> DataFrame:
    """Days to remediate by severity: count, average, range and exact median.

    Findings are first counted per severity and number of days. That histogram
    has one row per day count at most, so the median reads a few thousand rows
    whatever the number of findings.
    """
    days = rules.days_between("firstFoundTimestamp", "lastRemoved")
    histogram = (
        t.read(HISTORY, "cvssV3Severity", "firstFoundTimestamp", "lastRemoved")
        .where(F.col("lastRemoved").isNotNull())
        .groupBy("cvssV3Severity", days.alias("days"))
        .agg(F.count("*").alias("n"))
    )
    known = F.when(F.col("days").isNotNull(), F.col("n"))
    rows = histogram.groupBy("cvssV3Severity").agg(
        F.sum("n").alias("remediated_count"),
        (F.sum(F.col("days") * F.col("n")) / F.sum(known)).alias("avg_mttr_days"),
        F.min("days").alias("min_mttr_days"),
        F.max("days").alias("max_mttr_days"),
        F.percentile("days", 0.5, F.coalesce(known, F.lit(0))).alias("median_mttr_days"),
    )
    return ordered(rows, "-avg_mttr_days")


def mttr_by_severity_flow(t: Tables) -> DataFrame:
    """As ``mttr_by_severity`` without the range."""
    return mttr_by_severity(t).drop("min_mttr_days", "max_mttr_days")


def findings_per_cve(t: Tables) -> DataFrame:
    """Findings per CVE."""
    return t.read(HISTORY, "cveId").groupBy("cveId").agg(F.count("*").alias("count"))
