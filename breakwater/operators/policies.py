"""Analyses of policy results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breakwater.functions import rules
from breakwater.functions.ordering import ordered, top
from breakwater.tables import Tables

# Results and sources of a policy check.
PASS, FAIL, ERROR, NOT_APPLICABLE = "pass", "fail", "error", "notApplicable"
AGENT, SCAN = "agent", "scan"


def _status(value: str, source: str | None = None) -> Column:
    hit = F.col("finalStatus") == value
    return F.count_if(hit if source is None else hit & (F.col("source") == source))


def _pass_rate() -> Column:
    return rules.percent(_status(PASS), F.count("*")).alias("pass_rate_pct")


def benchmark_compliance(t: Tables) -> DataFrame:
    """Results and pass rate per benchmark, profile and source, worst first."""
    keys = ("benchmarkTitle", "profileTitle", "source")
    rows = (
        t.read("policies", *keys, "finalStatus")
        .groupBy(*keys)
        .agg(
            F.count("*").alias("total_rules"),
            _status(PASS).alias("passed"),
            _status(FAIL).alias("failed"),
            _status(ERROR).alias("errors"),
            _status(NOT_APPLICABLE).alias("not_applicable"),
            _pass_rate(),
        )
    )
    return ordered(rows, "pass_rate_pct")


def policy_compliance_flow(t: Tables) -> DataFrame:
    """As ``benchmark_compliance``, passed and failed only."""
    return benchmark_compliance(t).drop("errors", "not_applicable")


def _failed(t: Tables, *columns: str) -> DataFrame:
    return t.read("policies", *columns, "finalStatus").where(F.col("finalStatus") == FAIL)


def _of_chosen(rows: DataFrame, chosen: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows whose keys are among ``chosen``, a top-k result, with its other columns."""
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys])
    more = [F.col(f"c.{c}") for c in chosen.columns if c not in keys]
    return rows.alias("r").join(chosen.alias("c"), same).select("r.*", *more)


def _with_guidance(t: Tables, counts: DataFrame, limit: int, keys: tuple[str, ...]) -> DataFrame:
    """The rules that fail on most assets, with the greatest guidance text of each.

    Texts are long and repeat. They are read for the chosen rules alone, and
    each task reduces them to the different ones, so none is shuffled twice
    and no row carries its text through the count of assets.
    """
    best = top(counts, limit, "-affected_assets")
    texts = _of_chosen(_failed(t, *keys, "fixTexts").drop("finalStatus"), best, keys).distinct()
    return top(texts.groupBy(*best.columns).agg(F.max("fixTexts").alias("fix_guidance")), limit, "-affected_assets")


def top_failed_rules(t: Tables, limit: int = 25) -> DataFrame:
    """Rules that fail on most assets."""
    keys = ("ruleNaturalId", "ruleTitle", "benchmarkTitle")
    counts = (
        _failed(t, *keys, "assetId")
        .groupBy(*keys)
        .agg(F.countDistinct("assetId").alias("affected_assets"), F.count("*").alias("total_failures"))
    )
    return _with_guidance(t, counts, limit, keys)


def top_failed_rules_flow(t: Tables, limit: int = 25) -> DataFrame:
    """As ``top_failed_rules``, by title and without the total."""
    keys = ("ruleTitle", "benchmarkTitle")
    counts = _failed(t, *keys, "assetId").groupBy(*keys).agg(F.countDistinct("assetId").alias("affected_assets"))
    return _with_guidance(t, counts, limit, keys)


def asset_policy_comparison(t: Tables, limit: int = 50) -> DataFrame:
    """Pass rate per asset and benchmark with the asset's attributes, worst first.

    The rate does not depend on the asset's attributes, so the worst ``limit``
    are found first and only those look up their asset.
    """
    per_asset = (
        t.read("policies", "assetId", "benchmarkTitle", "finalStatus")
        .groupBy("assetId", "benchmarkTitle")
        .agg(
            F.count("*").alias("total_rules"),
            _status(PASS).alias("passed"),
            _status(FAIL).alias("failed"),
        )
        .withColumn("pass_rate_pct", rules.percent(F.col("passed"), F.col("total_rules")))
    )
    keys = ("assetId", "hostName", "ip", "osFamily", "benchmarkTitle")
    worst = top(per_asset, limit, "pass_rate_pct")
    rows = (
        worst.join(t.read("assets", *keys[:-1]), "assetId", "left")
        .groupBy(*keys)
        .agg(
            F.sum("total_rules").alias("total_rules"),
            F.sum("passed").alias("passed"),
            F.sum("failed").alias("failed"),
            F.max("pass_rate_pct").alias("pass_rate_pct"),
        )
    )
    return top(rows, limit, "pass_rate_pct", "assetId", "benchmarkTitle")


def agent_vs_scan(t: Tables) -> DataFrame:
    """Rules that agents and scans both assess, and what each found.

    Results are added up per asset first: counting assets per source is then a
    count of rows, and no row is copied for a second distinct count.
    """
    keys = ("benchmarkTitle", "ruleNaturalId", "ruleTitle")
    results = [(f"{source}_{status}", source, status) for source in (AGENT, SCAN) for status in (PASS, FAIL)]
    per_asset = (
        t.read("policies", *keys, "source", "assetId", "finalStatus")
        .groupBy(*keys, "assetId")
        .agg(
            *[F.bool_or(F.col("source") == source).alias(source) for source in (AGENT, SCAN)],
            *[_status(status, source).alias(name) for name, source, status in results],
        )
    )
    known = F.col("assetId").isNotNull()
    rows = (
        per_asset.groupBy(*keys)
        .agg(
            *[F.count_if(F.col(source) & known).alias(f"{source}_assessed") for source in (AGENT, SCAN)],
            *[F.sum(name).alias(name) for name, _, _ in results],
        )
        .where((F.col("agent_assessed") > 0) & (F.col("scan_assessed") > 0))
    )
    return ordered(rows, "benchmarkTitle", "ruleNaturalId")


def failed_rules_guidance(t: Tables, limit: int = 20) -> DataFrame:
    """Failed rules that come with guidance.

    Guidance and rationale are long, and every failing asset repeats them.
    Assets are counted under the texts' SHA-256 digests; the texts themselves
    are fetched for the best ``limit`` groups only.
    """
    short = ("ruleNaturalId", "ruleTitle", "benchmarkTitle", "finalStatus")
    digests = ("fix_digest", "why_digest")
    failed = (
        t.read("policies", *short, "fixTexts", "rationales", "assetId")
        .where((F.col("finalStatus") == FAIL) & F.col("fixTexts").isNotNull())
        .withColumns(dict(zip(digests, (F.sha2("fixTexts", 256), F.sha2("rationales", 256)))))
    )
    counts = failed.groupBy(*short, *digests).agg(F.countDistinct("assetId").alias("affected_assets"))
    best = top(counts, limit, "-affected_assets", *short, *digests)
    rows = _of_chosen(failed.drop("assetId"), best, (*short, *digests)).distinct()
    return top(
        rows.select(*short, "fixTexts", "rationales", "affected_assets"), limit, "-affected_assets"
    )


def failed_sample(t: Tables, limit: int = 10) -> DataFrame:
    """Any ``limit`` failed results, all columns; which ones is not defined."""
    return t["policies"].where(F.col("finalStatus") == FAIL).limit(limit)
