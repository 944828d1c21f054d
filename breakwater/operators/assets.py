"""Analyses of assets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater.functions import rules
from breakwater.functions.ordering import ordered, top
from breakwater.tables import Tables


def asset_inventory(t: Tables, limit: int = 100) -> DataFrame:
    """Assets by risk."""
    rows = t.read(
        "assets", "assetId", "hostName", "ip", "mac", "osFamily", "osProduct", "osVersion", "osType", "riskScore"
    )
    return top(rows, limit, "-riskScore")


def assets_by_os(t: Tables) -> DataFrame:
    """Assets and average risk per operating system."""
    keys = ("osFamily", "osProduct", "osVendor")
    rows = (
        t.read("assets", *keys, "riskScore")
        .groupBy(*keys)
        .agg(F.count("*").alias("asset_count"), F.avg("riskScore").alias("avg_risk_score"))
    )
    return ordered(rows, "-asset_count")


def assets_by_cloud(t: Tables) -> DataFrame:
    """Assets and average risk per cloud provider."""
    rows = (
        t.read("assets", "awsInstanceId", "azureResourceId", "gcpObjectId", "riskScore")
        .groupBy(rules.cloud_provider().alias("cloud_provider"))
        .agg(F.count("*").alias("asset_count"), F.avg("riskScore").alias("avg_risk_score"))
    )
    return ordered(rows, "-asset_count")


def high_risk_assets(t: Tables, threshold: float = 800, limit: int = 50) -> DataFrame:
    """Assets above a risk score, with their sites and groups."""
    rows = t.read(
        "assets", "assetId", "hostName", "ip", "osDescription", "riskScore", "sites", "assetGroups"
    ).where(F.col("riskScore") > threshold)
    return top(rows, limit, "-riskScore")


def assets_by_site(t: Tables, pattern: str = "%Production%") -> DataFrame:
    """Assets with a site like the pattern."""
    rows = t.read("assets", "assetId", "hostName", "ip", "osFamily", "riskScore", "sites").where(
        rules.any_like("sites", pattern)
    )
    return ordered(rows.drop("sites"), "-riskScore", spread_by=("assetId",))


def os_category_distribution(t: Tables) -> DataFrame:
    """Assets and average risk by coarse system family and asset type."""
    rows = (
        t.read("assets", "osFamily", "osType", "riskScore")
        .groupBy(rules.os_category().alias("os_category"), "osType")
        .agg(F.count("*").alias("count"), F.avg("riskScore").alias("avg_risk"))
    )
    return ordered(rows, "-count")
