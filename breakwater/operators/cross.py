"""Analyses that combine assets with findings or policy results.

Wherever the result has one row per asset, findings are aggregated per asset
before the join: the shuffle then carries one row per asset and task, also for
an asset that holds a third of all findings. The partial results are added up
again after the join, so repeated rows in ``assets`` count as they would if the
tables were joined first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater.functions import rules
from breakwater.functions.ordering import ordered, top
from breakwater.tables import Tables

_CRITICAL, _SEVERE = "Critical", "Severe"
_CLOUD_IDS = ("awsInstanceId", "azureResourceId", "gcpObjectId")


def _total(column: str, name: str | None = None):
    return F.coalesce(F.sum(column), F.lit(0)).alias(name or column)


def assets_with_vuln_counts(t: Tables, limit: int = 50) -> DataFrame:
    """Every asset with its findings, also those that have none."""
    per_asset = (
        t.read("vulnerabilities", "assetId", "vulnId", "severity", "hasExploits", "cvssV3Score")
        .groupBy("assetId")
        .agg(
            F.count("vulnId").alias("total_vulns"),
            F.count_if(F.col("severity") == _CRITICAL).alias("critical_count"),
            F.count_if(F.col("severity") == _SEVERE).alias("severe_count"),
            F.count_if("hasExploits").alias("exploitable_count"),
            F.sum("cvssV3Score").alias("score_sum"),
            F.count("cvssV3Score").alias("scored"),
        )
    )
    keys = ("assetId", "hostName", "ip", "osDescription", "riskScore")
    rows = (
        t.read("assets", *keys)
        .join(per_asset, "assetId", "left")
        .groupBy(*keys)
        .agg(
            _total("total_vulns"),
            _total("critical_count"),
            _total("severe_count"),
            _total("exploitable_count"),
            F.try_divide(F.sum("score_sum"), F.sum("scored")).alias("avg_cvss_score"),
        )
    )
    return top(rows, limit, "-critical_count", "-riskScore")


def cloud_assets_critical(t: Tables, limit: int = 50) -> DataFrame:
    """Assets with critical findings and where they run."""
    per_asset = (
        t.read("vulnerabilities", "assetId", "vulnId", "severity", "cvssV3Score")
        .where(F.col("severity") == _CRITICAL)
        .groupBy("assetId")
        .agg(
            F.count("vulnId").alias("critical_vuln_count"),
            F.sum("cvssV3Score").alias("score_sum"),
            F.count("cvssV3Score").alias("scored"),
        )
    )
    rows = (
        t.read("assets", "assetId", "hostName", "ip", *_CLOUD_IDS)
        .join(per_asset, "assetId")
        .groupBy("assetId", "hostName", "ip", rules.cloud_provider().alias("cloud_provider"), *_CLOUD_IDS)
        .agg(
            F.sum("critical_vuln_count").alias("critical_vuln_count"),
            F.try_divide(F.sum("score_sum"), F.sum("scored")).alias("avg_cvss"),
        )
    )
    return top(rows, limit, "-critical_vuln_count")


def windows_servers_high_risk(t: Tables, epss: float = 0.3, limit: int = 100) -> DataFrame:
    """Critical, likely exploited findings on Windows servers."""
    servers = (
        t.read("assets", "assetId", "hostName", "ip", "osProduct", "osVersion", "osFamily", "osType")
        .where(F.col("osFamily").like("%Windows%") & (F.col("osType") == "Server"))
        .drop("osFamily", "osType")
    )
    findings = (
        t.read("vulnerabilities", "assetId", "vulnId", "title", "cvssV3Score", "epssscore", "hasExploits", "severity")
        .where((F.col("severity") == _CRITICAL) & (F.col("epssscore") > epss))
        .drop("severity")
    )
    return top(servers.join(findings, "assetId"), limit, "-epssscore", "-cvssV3Score")


def clean_assets(t: Tables) -> DataFrame:
    """Assets without a finding, riskiest first.

    The findings side is reduced to its distinct asset ids before the shuffle;
    an anti join cannot split a hot key on that side.
    """
    found = t.read("vulnerabilities", "assetId", "vulnId").where(F.col("vulnId").isNotNull())
    rows = t.read("assets", "assetId", "hostName", "ip", "osDescription", "riskScore").join(
        found.select("assetId").distinct(), "assetId", "left_anti"
    )
    return ordered(rows, "-riskScore")


def top_hosts(t: Tables, limit: int = 5) -> DataFrame:
    """Hosts with most findings."""
    per_asset = (
        t.read("vulnerabilities", "assetId", "vulnId").groupBy("assetId").agg(F.count("vulnId").alias("findings"))
    )
    rows = (
        t.read("assets", "assetId", "hostName")
        .where(F.col("hostName").isNotNull())
        .join(per_asset, "assetId")
        .groupBy("hostName")
        .agg(F.sum("findings").alias("vuln_count"))
    )
    return top(rows, limit, "-vuln_count")


def policy_status_distribution(t: Tables) -> DataFrame:
    """Policy results by status; the NULL status is a group of its own."""
    rows = t.read("policies", "finalStatus").groupBy("finalStatus").agg(F.count("*").alias("count"))
    return ordered(rows, "-count")
