"""Fixed profile of the loaded tables.

Each block reads only its own columns. Exact distinct counts run apart from the
other aggregates so that they do not multiply wide rows, and the score
statistics come from a histogram with one row per distinct score.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater.functions.ordering import ordered
from breakwater.functions.rules import HIGH_EPSS
from breakwater.schemas import KNOWN_TABLES
from breakwater.tables import Tables


def total_rows(t: Tables) -> DataFrame:
    """Rows of every loaded table."""
    counts = [
        t[name].agg(F.count("*").alias("total_rows")).select(F.lit(name).alias("table_name"), "total_rows")
        for name in KNOWN_TABLES
        if name in t
    ]
    return reduce(DataFrame.unionByName, counts)


def unique_counts(t: Tables, table: str, **columns: str) -> DataFrame:
    """Exact distinct values of columns: ``unique_counts(t, "assets", unique_assets="assetId")``.

    Every column is counted alone, so no row is copied for another column.
    """
    counts = [
        t[table].select(F.col(column).alias("value")).distinct().agg(F.count("value").alias("n")).select(F.lit(name).alias("name"), "n")
        for name, column in columns.items()
    ]
    every = reduce(DataFrame.unionByName, counts)
    return every.agg(*[F.sum(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in columns])


def distribution(t: Tables, table: str, column: str) -> DataFrame:
    """Rows per value of a column, most frequent first; NULL is left out."""
    rows = t[table].where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    return ordered(rows, "-count")


def cvss_v3_stats(t: Tables) -> DataFrame:
    """Smallest, largest, average and exact median score."""
    rows = t["vulnerabilities"].where(F.col("cvssV3Score").isNotNull())
    return score_stats(rows.groupBy("cvssV3Score").agg(F.count("*").alias("n")))


def score_stats(histogram: DataFrame) -> DataFrame:
    """The same from ``cvssV3Score, n``, one row per score."""
    return histogram.agg(
        F.min("cvssV3Score").alias("min_score"),
        F.max("cvssV3Score").alias("max_score"),
        (F.sum(F.col("cvssV3Score") * F.col("n")) / F.sum("n")).alias("avg_score"),
        F.percentile("cvssV3Score", 0.5, F.col("n")).alias("median_score"),
    )


def exploit_stats(t: Tables) -> DataFrame:
    """Findings with known exploits, with a high likelihood, and the average likelihood."""
    return t["vulnerabilities"].agg(
        F.count_if("hasExploits").alias("with_exploits"),
        F.count_if(F.col("epssscore") > HIGH_EPSS).alias("high_epss"),
        F.avg("epssscore").alias("avg_epss"),
    )


def cloud_distribution(t: Tables) -> DataFrame:
    """Findings with each kind of cloud id (these count findings, not assets)."""
    return t["vulnerabilities"].agg(
        F.count("awsInstanceId").alias("aws_rows"),
        F.count("azureResourceId").alias("azure_rows"),
        F.count("gcpObjectId").alias("gcp_rows"),
    )


def cloud_assets(t: Tables) -> DataFrame:
    """Distinct assets behind ``cloud_distribution``."""
    flags = (
        t["vulnerabilities"]
        .groupBy("assetId")
        .agg(
            (F.count("awsInstanceId") > 0).alias("aws"),
            (F.count("azureResourceId") > 0).alias("azure"),
            (F.count("gcpObjectId") > 0).alias("gcp"),
        )
        .where(F.col("assetId").isNotNull())
    )
    return flags.agg(*[F.count_if(name).alias(f"{name}_assets") for name in ("aws", "azure", "gcp")])


# Blocks of the profile and the columns they need.
UNIQUES = {
    "vulnerabilities": {"unique_assets": "assetId", "unique_vulnerabilities": "vulnId"},
    "assets": {"unique_assets": "assetId"},
    "asset_software": {"unique_assets": "assetId"},
}
DISTRIBUTIONS = {
    ("vulnerabilities", "severity"): "severity_distribution",
    ("assets", "osFamily"): "os_family_distribution",
    ("policies", "finalStatus"): "finalStatus_distribution",
    ("policies", "source"): "source_distribution",
    ("vulnerability_remediation", "cvssV3Severity"): "severity_distribution",
}
_FINDING_BLOCKS: dict[str, tuple[Callable[[Tables], DataFrame], tuple[str, ...]]] = {
    "cvss_v3_stats": (cvss_v3_stats, ("cvssV3Score",)),
    "exploit_stats": (exploit_stats, ("hasExploits", "epssscore")),
    "cloud_distribution": (cloud_distribution, ("awsInstanceId", "azureResourceId", "gcpObjectId")),
}


def blocks(t: Tables) -> dict[tuple[str, str], DataFrame]:
    """Every block that the loaded tables and their columns allow, not yet run."""
    found: dict[tuple[str, str], DataFrame] = {}
    for table, uniques in UNIQUES.items():
        if table in t and set(uniques.values()) <= set(t[table].columns):
            found[table, "unique"] = unique_counts(t, table, **uniques)
    for (table, column), name in DISTRIBUTIONS.items():
        if table in t and column in t[table].columns:
            found[table, name] = distribution(t, table, column)
    for name, (block, needed) in _FINDING_BLOCKS.items():
        if "vulnerabilities" in t and set(needed) <= set(t["vulnerabilities"].columns):
            found["vulnerabilities", name] = block(t)
    return found


def profile(t: Tables) -> dict[str, dict[str, Any]]:
    """The profile as nested dicts, in the shape and rounding its readers expect.

    Everything collected here is a scalar row or a distribution over one
    low-cardinality column. As before, an average or median of exactly 0 shows
    as None; the DataFrame blocks keep the true 0. Exceptions have no profile.
    """
    loaded = any(name in t for name in KNOWN_TABLES)
    return nested({row.table_name: row.total_rows for row in total_rows(t).collect()} if loaded else {}, blocks(t))


def nested(rows_of: dict[str, int], found: dict[tuple[str, str], DataFrame]) -> dict[str, dict[str, Any]]:
    """Rows of the tables and their blocks as nested dicts."""
    result: dict[str, dict[str, Any]] = {
        table: {"total_rows": rows} for table, rows in rows_of.items() if table != "vulnerability_exceptions"
    }

    def shown(value: float | None, digits: int) -> float | None:
        return round(value, digits) if value else None

    for (table, name), frame in found.items():
        section, rows = result[table], frame.collect()
        if name == "unique":
            section.update(rows[0].asDict())
        elif name == "cvss_v3_stats":
            low, high, average, median = rows[0]
            section[name] = {"min": low, "max": high, "avg": shown(average, 2), "median": shown(median, 2)}
        elif name == "exploit_stats":
            known, likely, average = rows[0]
            section[name] = {
                "vulnerabilities_with_exploits": known,
                "high_epss_score_count": likely,
                "avg_epss_score": shown(average, 4),
            }
        elif name == "cloud_distribution":
            if any(rows[0]):
                section[name] = dict(zip(("aws", "azure", "gcp"), rows[0]))
        elif rows or table == "vulnerabilities":
            section[name] = {value: count for value, count in rows}
    return result
