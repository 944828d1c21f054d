"""Analyses that are only described in words elsewhere; the definitions are ours."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breakwater.functions import releases, rules, skew
from breakwater.functions.ordering import ordered, top
from breakwater.operators.policies import AGENT, FAIL, PASS, SCAN
from breakwater.tables import Tables

_RULE = ("benchmarkTitle", "ruleNaturalId")


def agent_scan_discrepancies(t: Tables) -> DataFrame:
    """Asset and rule pairs where the latest agent and scan results differ.

    Aggregations instead of a self join: pairs of results of the same asset and
    rule are never enumerated. The first one keeps the latest time per result,
    in a hash table without text buffers, so repeated assessments vanish before
    the shuffle; the second picks the latest result of the few that remain.
    """

    def latest(source: str) -> Column:
        result = F.when(F.col("source") == source, F.struct("at", "finalStatus"))
        return F.max(result)["finalStatus"].alias(f"{source}_status")

    results = (
        t.read("policies", "assetId", *_RULE, "source", "finalStatus", "lastAssessmentTimestamp")
        .groupBy("assetId", *_RULE, "source", "finalStatus")
        .agg(F.max("lastAssessmentTimestamp").alias("at"))
    )
    rows = (
        results.groupBy("assetId", *_RULE)
        .agg(latest(AGENT), latest(SCAN))
        .where(F.col("agent_status") != F.col("scan_status"))
    )
    return ordered(rows, "assetId", *_RULE)


def assessment_coverage_gaps(t: Tables) -> DataFrame:
    """Per rule: assets that only agents, only scans, or both have assessed."""
    seen = (
        t.read("policies", "assetId", *_RULE, "source")
        .groupBy(*_RULE, "assetId")
        .agg(
            F.bool_or(F.col("source") == AGENT).alias("by_agent"),
            F.bool_or(F.col("source") == SCAN).alias("by_scan"),
        )
    )
    rows = seen.groupBy(*_RULE).agg(
        F.count_if(F.col("by_agent") & ~F.col("by_scan")).alias("agent_only_assets"),
        F.count_if(F.col("by_scan") & ~F.col("by_agent")).alias("scan_only_assets"),
        F.count_if(F.col("by_agent") & F.col("by_scan")).alias("both_assets"),
    )
    return ordered(rows, *_RULE)


def compliance_trend(t: Tables) -> DataFrame:
    """Pass rate per month of assessment."""
    rows = (
        t.read("policies", "lastAssessmentTimestamp", "finalStatus")
        .groupBy(rules.month_of("lastAssessmentTimestamp").alias("month"))
        .agg(
            F.count("*").alias("total_rules"),
            F.count_if(F.col("finalStatus") == PASS).alias("passed"),
            rules.percent(F.count_if(F.col("finalStatus") == PASS), F.count("*")).alias("pass_rate_pct"),
        )
    )
    return ordered(rows, "month")


def rule_failures_by_os(t: Tables) -> DataFrame:
    """Failed results and failing assets by operating system and asset type."""
    per_asset = (
        t.read("policies", "assetId", "finalStatus")
        .where(F.col("finalStatus") == FAIL)
        .groupBy("assetId")
        .agg(F.count("*").alias("failures"))
    )
    rows = (
        t.read("assets", "assetId", "osFamily", "osType")
        .join(per_asset, "assetId")
        .groupBy("osFamily", "osType")
        .agg(F.sum("failures").alias("failures"), F.countDistinct("assetId").alias("failing_assets"))
    )
    return ordered(rows, "-failures")


def discovery_trend(t: Tables) -> DataFrame:
    """New findings per week and severity."""
    rows = (
        t.read("vulnerabilities", "firstFoundTimestamp", "severity")
        .where(F.col("firstFoundTimestamp").isNotNull())
        .groupBy(rules.week_of("firstFoundTimestamp").alias("week"), "severity")
        .agg(F.count("*").alias("new_findings"))
    )
    return ordered(rows, "week", "severity")


def cve_still_present_assets(t: Tables, cve: str) -> DataFrame:
    """Assets on which a CVE is still present."""
    rows = (
        t.read("vulnerability_remediation", "assetId", "cveId", "lastRemoved")
        .where((F.col("cveId") == cve) & F.col("lastRemoved").isNull())
        .select("assetId")
        .distinct()
    )
    return ordered(rows, "assetId")


def _percent_rank(pairs: DataFrame, value: str, bucket: Column, name: str) -> DataFrame:
    """Percent rank of every distinct ``value`` of counted ``pairs``, without sorting rows in one task.

    Distinct values are ranked inside order-keeping buckets, in parallel; only
    the totals per bucket, whose number ``bucket`` must bound, are summed up in
    one task.
    """
    values = pairs.groupBy(value).agg(F.sum("n").alias("n")).withColumn("bucket", bucket)
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        values.groupBy("bucket")
        .agg(F.sum("n").alias("in_bucket"))
        .select(
            "bucket",
            F.coalesce(F.sum("in_bucket").over(before.orderBy("bucket")), F.lit(0)).alias("below"),
            F.sum("in_bucket").over(Window.partitionBy()).alias("everything"),
        )
    )
    inside = Window.partitionBy("bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    less = F.col("below") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    return values.join(totals, "bucket").select(
        value, F.coalesce(F.try_divide(less, F.col("everything") - 1), F.lit(0.0)).alias(name)
    )


def risk_vs_count_discrepancy(t: Tables, limit: int = 50) -> DataFrame:
    """Assets whose risk rank and finding-count rank differ most.

    Risk is on a capped scale, so thousandths of a point make about a million
    buckets. N findings spread over assets give at most sqrt(2N) different
    counts, and at most N / 1e6 of them above a million. Both ranks and the gap
    are worked out on the distinct pairs of risk and count, and assets meet them
    in one join.
    """
    per_asset = t.read("vulnerabilities", "assetId").groupBy("assetId").agg(F.count("*").alias("findings"))
    rows = (
        t.read("assets", "assetId", "hostName", "riskScore", "riskScoreV2_0")
        .select("assetId", "hostName", rules.asset_risk().alias("risk"))
        .where(F.col("risk").isNotNull())
        .join(per_asset, "assetId", "left")
        .withColumn("findings", F.coalesce("findings", F.lit(0)))
    )
    by_risk = F.greatest(F.floor(F.col("risk") * 1000), F.lit(-1))
    by_count = F.least(F.col("findings"), F.lit(1_000_000))
    pairs = rows.groupBy("risk", "findings").agg(F.count("*").alias("n"))
    ranked = (
        pairs.drop("n")
        .join(_percent_rank(pairs, "risk", by_risk, "risk_rank"), "risk")
        .join(_percent_rank(pairs, "findings", by_count, "count_rank"), "findings")
    )
    gaps = rows.join(ranked, ["risk", "findings"]).select(
        "assetId", "hostName", "risk", "findings",
        F.round("risk_rank", 6).alias("risk_rank"),
        F.round("count_rank", 6).alias("count_rank"),
        F.round(F.abs(F.col("risk_rank") - F.col("count_rank")), 6).alias("gap"),
    )
    return top(gaps, limit, "-gap")


def software_vs_findings(t: Tables, package: tuple[str, ...] = ("softwareName",), limit: int = 50) -> DataFrame:
    """Packages on assets with critical findings.

    ``package`` names the columns that identify a package; exports differ.
    """
    critical = (
        t.read("vulnerabilities", "assetId", "severity")
        .where(F.col("severity") == "Critical")
        .groupBy("assetId")
        .agg(F.count("*").alias("critical"))
    )
    installed = t["asset_software"].select("assetId", *package).distinct()
    rows = (
        skew.join(installed, critical, "assetId")
        .groupBy(*package)
        .agg(F.count("*").alias("affected_assets"), F.sum("critical").alias("critical_findings"))
    )
    return top(rows, limit, "-critical_findings")


def by_group(t: Tables) -> DataFrame:
    """Assets and average risk per asset group."""
    rows = (
        t.read("assets", "assetId", "assetGroups", "riskScore")
        .select("assetId", F.explode("assetGroups").alias("asset_group"), "riskScore")
        .groupBy("asset_group")
        .agg(F.countDistinct("assetId").alias("asset_count"), F.avg("riskScore").alias("avg_risk_score"))
    )
    return ordered(rows, "-asset_count")


def by_tag(t: Tables) -> DataFrame:
    """Assets and average risk per tag."""
    rows = (
        t.read("assets", "assetId", "tags", "riskScore")
        .select("assetId", F.inline("tags"), "riskScore")
        .groupBy("tagType", F.col("name").alias("tag"))
        .agg(F.countDistinct("assetId").alias("asset_count"), F.avg("riskScore").alias("avg_risk_score"))
    )
    return ordered(rows, "-asset_count")


def os_type_arch_distribution(t: Tables) -> DataFrame:
    """Assets by type and processor architecture."""
    keys = ("osType", "osArchitecture")
    return ordered(t.read("assets", *keys).groupBy(*keys).agg(F.count("*").alias("asset_count")), "-asset_count")


def net_of_exceptions(t: Tables) -> DataFrame:
    """Findings that no exception covers, all columns."""
    key = ["assetId", "vulnId", "checkId"]
    return t["vulnerabilities"].join(t.read("vulnerability_exceptions", *key).distinct(), key, "left_anti")


def severity_net_of_exceptions(t: Tables) -> DataFrame:
    """Findings by severity once excepted ones are taken out."""
    rows = net_of_exceptions(t).groupBy("severity").agg(F.count("*").alias("count"))
    return ordered(rows, "-count")


def priority_score(t: Tables, min_assets: int = 5, high_risk: float = 800, limit: int = 50) -> DataFrame:
    """Vulnerabilities by the number of urgency signals they show.

    Signals: exploit likely, critical score, exploit known, a high-risk asset
    affected, many assets affected. Ties go to likelihood, score and reach.
    """
    pairs = (
        t.read("vulnerabilities", "vulnId", "assetId", "epssscore", "cvssV3Score", "hasExploits")
        .groupBy("vulnId", "assetId")
        .agg(
            F.max("epssscore").alias("epss"),
            F.max("cvssV3Score").alias("cvss"),
            F.bool_or("hasExploits").alias("exploitable"),
        )
    )
    risk = (
        t.read("assets", "assetId", "riskScore", "riskScoreV2_0")
        .groupBy("assetId")
        .agg(F.max(rules.asset_risk()).alias("risk"))
    )
    rows = (
        skew.join(pairs, risk, "assetId", "left")
        .groupBy("vulnId")
        .agg(
            F.max("epss").alias("epssscore"),
            F.max("cvss").alias("cvssV3Score"),
            F.coalesce(F.bool_or("exploitable"), F.lit(False)).alias("hasExploits"),
            F.max("risk").alias("max_asset_risk"),
            F.count("assetId").alias("affected_assets"),
        )
    )
    signals = (
        F.col("epssscore") > rules.HIGH_EPSS,
        F.col("cvssV3Score") >= rules.CRITICAL_CVSS,
        F.col("hasExploits"),
        F.col("max_asset_risk") > high_risk,
        F.col("affected_assets") > min_assets,
    )
    count = sum((F.coalesce(s.cast("int"), F.lit(0)) for s in signals), F.lit(0))
    return top(
        rows.withColumn("signals", count), limit, "-signals", "-epssscore", "-cvssV3Score", "-affected_assets"
    )


def clean_fix_text(frame: DataFrame, html: str = "bestSolutionFix", name: str = "fix_text") -> DataFrame:
    """Add the text of an HTML column, without tags."""
    return frame.withColumn(name, rules.strip_tags(html))


def fix_guidance(t: Tables) -> DataFrame:
    """Findings per readable fix and kind of solution, unknown kinds included.

    Tags are stripped once from each different text, not from every finding.
    """
    findings = t.read("vulnerabilities", "bestSolutionFix", "bestSolutionType")
    different = findings.groupBy(rules.solution_type().alias("solution_type"), "bestSolutionFix").agg(F.count("*").alias("n"))
    rows = clean_fix_text(different).groupBy("solution_type", "fix_text").agg(F.sum("n").alias("findings"))
    return ordered(rows, "-findings")


def high_risk_remediation_rate(t: Tables) -> DataFrame:
    """Share remediated and median days to fix, high-risk findings against the rest.

    Counted per number of days first, so the median reads a small histogram.
    """
    high = (F.col("cvssV3Score") >= rules.HIGH_CVSS) | (F.col("epssscore") > rules.HIGH_EPSS)
    histogram = (
        t.read("vulnerability_remediation", "cvssV3Score", "epssscore", "firstFoundTimestamp", "lastRemoved")
        .groupBy(
            F.coalesce(high, F.lit(False)).alias("high_risk"),
            F.col("lastRemoved").isNotNull().alias("removed"),
            rules.days_between("firstFoundTimestamp", "lastRemoved").alias("days"),
        )
        .agg(F.count("*").alias("n"))
    )
    removed = F.when(F.col("removed"), F.col("n")).otherwise(0)
    rows = histogram.groupBy("high_risk").agg(
        F.sum("n").alias("findings"),
        F.sum(removed).alias("remediated"),
        rules.percent(F.sum(removed), F.sum("n")).alias("remediation_pct"),
        F.percentile("days", 0.5, F.col("n")).alias("median_days"),
    )
    return ordered(rows, "-high_risk")


def severity_by_cloud(t: Tables) -> DataFrame:
    """Findings by cloud provider and severity, on-premise assets left out."""
    ids = ("awsInstanceId", "azureResourceId", "gcpObjectId")
    borrowed = t.borrowed("vulnerabilities", *ids)
    own = [i for i in ids if i not in borrowed]
    per_asset = (
        t.read("vulnerabilities", "assetId", *own, "severity")
        .groupBy("assetId", *own, "severity")
        .agg(F.count("*").alias("n"))
    )
    rows = (
        t.borrow(per_asset, borrowed)
        .where(F.coalesce(*ids).isNotNull())
        .groupBy(rules.cloud_provider().alias("cloud_provider"), "severity")
        .agg(F.sum("n").alias("count"))
    )
    return ordered(rows, "cloud_provider", "-count")


def eol_flagging(
    frame: DataFrame, end_of_life: DataFrame, on: list[str], as_of: datetime | str | None = None
) -> DataFrame:
    """Rows whose product is past its end of life.

    ``end_of_life`` is supplied by the caller with the columns ``on`` and
    ``eol_date``; a product listed twice counts with its latest date.
    """
    latest = end_of_life.groupBy(*on).agg(F.max("eol_date").alias("eol_date"))
    past = latest.where(F.col("eol_date") < rules.moment(as_of).cast("date"))
    return frame.join(past, on)


def eol_by_version(
    frame: DataFrame, end_of_life: DataFrame, on: list[str], version: str = "version", as_of: datetime | str | None = None
) -> DataFrame:
    """Rows whose version belongs to a release line past its end of life, with ``entry`` and ``eol_date``.

    ``end_of_life`` lists release lines by ``on`` and ``version``: 7.9.2 belongs to 7.9, and to 7.9.2 or 7.9.2.1 only if
    that is what it begins with; the longest line wins. A line listed twice counts with its latest date. Rows without a
    version, or of no line, are not past anything.
    """
    found = releases.longest_entry(frame, end_of_life, on, version, "eol_date")
    return found.where(F.col("eol_date") < rules.moment(as_of).cast("date"))
