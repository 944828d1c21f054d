"""Analyses of findings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breakwater.functions import rules
from breakwater.functions.ordering import ordered, top
from breakwater.tables import Tables

FINDINGS = "vulnerabilities"


def _is_critical() -> Column:
    return F.col("severity") == "Critical"


def _top(
    t: Tables, columns: tuple[str, ...], condition: Column, limit: int, *keys: str, needed: tuple[str, ...] = ()
) -> DataFrame:
    """The first findings that meet a condition; it may read ``needed`` columns that are not shown."""
    borrowed = t.borrowed(FINDINGS, *columns)
    own = [c for c in columns if c not in borrowed]
    rows = top(t.read(FINDINGS, *own, *needed).where(condition).select(*own), limit, *keys)
    return top(t.borrow(rows, borrowed).select(*columns), limit, *keys) if borrowed else rows


def _by_asset(t: Tables, *more: Column) -> DataFrame:
    """Findings, critical ones and exploitable ones per asset."""
    keys = ("assetId", "hostName", "ip", "osDescription")
    borrowed = t.borrowed(FINDINGS, *keys)
    own = [k for k in keys if k not in borrowed]
    rows = (
        t.read(FINDINGS, *own, "severity", "hasExploits", "riskScoreV2_0", "cvssV3Score")
        .groupBy(*own)
        .agg(
            F.count("*").alias("total_vulns"),
            F.count_if(_is_critical()).alias("critical_count"),
            F.count_if("hasExploits").alias("exploitable_count"),
            *more,
        )
    )
    return t.borrow(rows, borrowed).select(*keys, *[c for c in rows.columns if c not in keys])


def _by_provider(t: Tables) -> DataFrame:
    """Findings per asset with the cloud provider of the asset."""
    ids = ("awsInstanceId", "azureResourceId", "gcpObjectId")
    borrowed = t.borrowed(FINDINGS, *ids)
    own = [i for i in ids if i not in borrowed]
    per_asset = (
        t.read(FINDINGS, "assetId", *own, "severity", "cvssV3Score")
        .groupBy("assetId", *own)
        .agg(
            F.count("*").alias("findings"),
            F.count_if(_is_critical()).alias("critical"),
            F.sum("cvssV3Score").alias("score_sum"),
            F.count("cvssV3Score").alias("scored"),
        )
    )
    return t.borrow(per_asset, borrowed).withColumn("cloud_provider", rules.cloud_provider())


def critical_exploitable(t: Tables, epss: float = 0.5, limit: int = 20) -> DataFrame:
    """Critical findings that are likely to be exploited."""
    columns = (
        "assetId", "hostName", "vulnId", "title", "cvssV3Score", "epssscore", "epsspercentile", "hasExploits",
        "firstFoundTimestamp",
    )
    likely = _is_critical() & (F.col("epssscore") > epss)
    return _top(t, columns, likely, limit, "-epssscore", "-cvssV3Score", needed=("severity",))


def asset_vuln_summary(t: Tables, limit: int = 50) -> DataFrame:
    """Findings per asset with the highest risk and the average score."""
    rows = _by_asset(
        t, F.max("riskScoreV2_0").alias("max_risk_score"), F.avg("cvssV3Score").alias("avg_cvss_score")
    )
    return top(rows, limit, "-critical_count", "-max_risk_score")


def asset_risk_summary(t: Tables, limit: int = 20) -> DataFrame:
    """Findings per asset, worst first."""
    return top(_by_asset(t), limit, "-critical_count", "-total_vulns")


def vuln_age_buckets(t: Tables, as_of: datetime | str | None = None) -> DataFrame:
    """Findings by age and severity."""
    rows = (
        t.read(FINDINGS, "firstFoundTimestamp", "severity", "cvssV3Score")
        .groupBy(rules.age_bucket("firstFoundTimestamp", as_of).alias("age_bucket"), "severity")
        .agg(F.count("*").alias("count"), F.avg("cvssV3Score").alias("avg_cvss"))
    )
    return ordered(rows, "age_bucket", "severity")


def cve_search(t: Tables, pattern: str = "%CVE-2024-1234%") -> DataFrame:
    """Findings with a CVE like the pattern, highest score first."""
    rows = t.read(
        FINDINGS, "assetId", "hostName", "ip", "osDescription", "vulnId", "title", "cvssV3Score", "severity", "cves",
        "firstFoundTimestamp",
    ).where(rules.any_like("cves", pattern))
    return ordered(rows, "-cvssV3Score", spread_by=("assetId", "vulnId"))


def cve_search_flow(t: Tables, pattern: str = "%CVE-2024%") -> DataFrame:
    """Findings with a CVE like the pattern, in no order."""
    return t.read(FINDINGS, "assetId", "hostName", "vulnId", "title", "cvssV3Score", "cves").where(
        rules.any_like("cves", pattern)
    )


def epss_prioritisation(t: Tables, epss: float = 0.1, min_assets: int = 5, limit: int = 25) -> DataFrame:
    """Likely exploited vulnerabilities on more than ``min_assets`` assets."""
    keys = ("vulnId", "cvssV3Score", "epssscore", "epsspercentile", "hasExploits")
    likely = t.read(FINDINGS, *keys, "title", "assetId", "riskScoreV2_0").where(F.col("epssscore") > epss)
    per_asset = likely.groupBy(*keys, rules.digest("title"), "assetId").agg(
        F.sum("riskScoreV2_0").alias("risk"), F.count("riskScoreV2_0").alias("rated")
    )
    counts = (
        per_asset.groupBy(*keys, "title_digest")
        .agg(F.count("assetId").alias("affected_assets"), F.try_divide(F.sum("risk"), F.sum("rated")).alias("avg_risk_score"))
        .where(F.col("affected_assets") > min_assets)
    )
    rows = rules.with_text(counts, likely, "title", "vulnId").select(
        "vulnId", "title", *keys[1:], "affected_assets", "avg_risk_score"
    )
    return top(rows, limit, "-epssscore", "-affected_assets")


def epss_prioritisation_flow(t: Tables, epss: float = 0.1, min_assets: int = 5) -> DataFrame:
    """As ``epss_prioritisation`` without exploit flag, average risk and limit."""
    keys = ("vulnId", "cvssV3Score", "epssscore", "epsspercentile")
    likely = t.read(FINDINGS, *keys, "title", "assetId").where(F.col("epssscore") > epss)
    counts = (
        likely.select(*keys, rules.digest("title"), "assetId")
        .distinct()
        .groupBy(*keys, "title_digest")
        .agg(F.count("assetId").alias("affected_assets"))
        .where(F.col("affected_assets") > min_assets)
    )
    rows = rules.with_text(counts, likely, "title", "vulnId").select("vulnId", "title", *keys[1:], "affected_assets")
    return ordered(rows, "-epssscore")


def best_solution_availability(t: Tables) -> DataFrame:
    """Findings per kind of solution; the NULL kind is a group of its own."""
    rows = t.read(FINDINGS, "bestSolutionType").groupBy("bestSolutionType").agg(F.count("*").alias("count"))
    return ordered(rows, "-count")


def actionable_vulns(t: Tables, limit: int = 50) -> DataFrame:
    """Findings that come with a fix to apply."""
    columns = (
        "assetId", "hostName", "vulnId", "title", "severity", "cvssV3Score", "bestSolutionType", "bestSolutionSummary"
    )
    fixable = F.col("bestSolutionType").isin(*rules.ACTIONABLE_SOLUTIONS) & F.col("bestSolutionSummary").isNotNull()
    return _top(t, columns, fixable, limit, "-cvssV3Score")


def critical_by_fix(t: Tables, limit: int = 25) -> DataFrame:
    """Critical findings per recommended fix; vulnerabilities and assets are counted in a pass each."""
    text, keys = "bestSolutionSummary", ("bestSolutionType", "bestSolutionSummary_digest")
    fixable = t.read(FINDINGS, text, "bestSolutionType", "vulnId", "assetId", "cvssV3Score", "hasExploits", "severity").where(
        _is_critical() & F.col("bestSolutionType").isin(*rules.ACTIONABLE_SOLUTIONS)
    )
    slim = fixable.withColumn(keys[1], rules.digest(text))
    assets = (
        slim.groupBy(*keys, "assetId")
        .agg(F.max("cvssV3Score").alias("max_cvss"), F.count_if("hasExploits").alias("with_exploits"))
        .groupBy(*keys)
        .agg(
            F.count("assetId").alias("affected_assets"), F.max("max_cvss").alias("max_cvss"),
            F.sum("with_exploits").alias("with_exploits"),
        )
    )
    vulns = slim.select(*keys, "vulnId").distinct().groupBy(*keys).agg(F.count("vulnId").alias("distinct_vulns"))
    rows = rules.with_text(assets.join(vulns, list(keys)), fixable, text, "bestSolutionType").select(
        text, "bestSolutionType", "distinct_vulns", "affected_assets", "max_cvss", "with_exploits"
    )
    return top(rows, limit, "-affected_assets")


def cloud_vulns(t: Tables) -> DataFrame:
    """Findings and assets per cloud provider."""
    rows = (
        _by_provider(t)
        .groupBy("cloud_provider")
        .agg(
            F.countDistinct("assetId").alias("asset_count"),
            F.sum("findings").alias("vuln_count"),
            F.sum("critical").alias("critical_vulns"),
            F.try_divide(F.sum("score_sum"), F.sum("scored")).alias("avg_cvss"),
        )
    )
    return ordered(rows, "-critical_vulns")


def cloud_breakdown(t: Tables) -> DataFrame:
    """Findings and assets per cloud provider, counts only."""
    return (
        _by_provider(t)
        .groupBy("cloud_provider")
        .agg(F.sum("findings").alias("vuln_count"), F.countDistinct("assetId").alias("asset_count"))
    )


def reintroduced_vulns(t: Tables, limit: int = 50) -> DataFrame:
    """Findings that came back, newest first."""
    columns = ("assetId", "hostName", "vulnId", "title", "severity", "firstFoundTimestamp", "reintroducedTimestamp")
    rows = _top(t, columns, F.col("reintroducedTimestamp").isNotNull(), limit, "-reintroducedTimestamp")
    return rows.withColumn("days_between", rules.days_between("firstFoundTimestamp", "reintroducedTimestamp"))


def pci_report(t: Tables) -> DataFrame:
    """Findings by card-industry severity and compliance."""
    rows = (
        t.read(FINDINGS, "pciSeverity", "pciCompliant", "assetId", "cvssV3Score")
        .where(F.col("pciSeverity").isNotNull())
        .groupBy("pciSeverity", "pciCompliant")
        .agg(
            F.count("*").alias("vuln_count"),
            F.countDistinct("assetId").alias("affected_assets"),
            F.avg("cvssV3Score").alias("avg_cvss"),
        )
    )
    return ordered(rows, "-pciSeverity")


def risk_priority(t: Tables, epss: float = 0.5, limit: int = 20) -> DataFrame:
    """Critical findings that are likely to be, or already can be, exploited."""
    columns = ("assetId", "hostName", "vulnId", "title", "cvssV3Score", "epssscore", "hasExploits", "severity")
    urgent = _is_critical() & ((F.col("epssscore") > epss) | F.col("hasExploits"))
    return _top(t, columns, urgent, limit, "-epssscore", "-cvssV3Score")


def severity_distribution(t: Tables) -> DataFrame:
    """Findings and average score by severity."""
    rows = (
        t.read(FINDINGS, "severity", "cvssV3Score")
        .groupBy("severity")
        .agg(F.count("*").alias("count"), F.avg("cvssV3Score").alias("avg_cvss"))
    )
    return ordered(rows, "-count")


def critical_sample(t: Tables, limit: int = 10) -> DataFrame:
    """Any ``limit`` critical findings, all columns; which ones is not defined."""
    return t[FINDINGS].where(_is_critical()).limit(limit)


def known_exploits_top(t: Tables, limit: int = 20, severity: str | None = None) -> DataFrame:
    """Findings with a known exploit by score, optionally of one severity."""
    columns = ("assetId", "vulnId", "title", "cvssV3Score", "hasExploits", "severity")
    known = F.col("hasExploits") if severity is None else F.col("hasExploits") & (F.col("severity") == severity)
    return _top(t, columns, known, limit, "-cvssV3Score")


def top_findings_per_asset(t: Tables, per_asset: int = 3) -> DataFrame:
    """The most exploitable findings of every asset.

    The rank filter sits on the window, so tasks cut each asset to
    ``per_asset`` rows before the shuffle, however many one asset holds.
    """
    rows = t.read(FINDINGS, "assetId", "vulnId", "checkId", "title", "severity", "epssscore", "cvssV3Score")
    best_first = Window.partitionBy("assetId").orderBy(
        F.col("epssscore").desc_nulls_last(),
        F.col("cvssV3Score").desc_nulls_last(),
        F.col("vulnId").asc_nulls_last(),
        F.col("checkId").asc_nulls_last(),
    )
    return rows.withColumn("finding_rank", F.row_number().over(best_first)).where(
        F.col("finding_rank") <= per_asset
    )
