"""Shape of the physical plans, with broadcasts by size switched off."""

from __future__ import annotations

import re

import pytest

from breakwater.operators import derived, policies, remediation, vulnerabilities
from breakwater.plans import registry
from breakwater.session import settings
from breakwater.tables import Tables

# Queries that end in one row per table or in totals per bucket, so that one task takes the last step.
ONE_TASK_AT_THE_END = re.compile("profile_|table_overview|risk_vs_count|critical_sample|failed_sample")

TOTAL = re.compile(r"Exchange SinglePartition[^\n]*\n[^\n]*HashAggregate\(keys=\[\], functions=\[partial_")


def plan_of(spark, frame) -> str:
    frame.createOrReplaceTempView("planned")
    return frame.sparkSession.sql("EXPLAIN SELECT * FROM planned").first()[0]


@pytest.fixture(scope="module")
def no_broadcast(spark):
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "5000"}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def test_no_query_joins_every_row_with_every_row(no_broadcast, sf_dir):
    for name, query in registry.queries().items():
        plan = plan_of(no_broadcast, query(no_broadcast, sf_dir))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
        if not ONE_TASK_AT_THE_END.match(name):
            # a total of one row a task may meet in one; rows may not
            assert "SinglePartition" not in TOTAL.sub("", plan), name


@pytest.fixture
def stored(no_broadcast, tmp_path):
    """Findings and policies as Parquet files with every column, as a load would leave them."""
    no_broadcast.sql(
        "select 'a' as assetId, 'v' as vulnId, 'Critical' as severity, 1.0D as cvssV3Score, 1.0D as epssscore,"
        " true as hasExploits, 't' as title, 'text' as proof, 'h' as hostName"
    ).write.parquet(str(tmp_path / "v"))
    no_broadcast.sql(
        "select 'a' as assetId, 'r' as ruleNaturalId, 'r' as ruleTitle, 'b' as benchmarkTitle, 'fail' as finalStatus,"
        " 'f' as fixTexts, 'w' as rationales, 'agent' as source"
    ).write.parquet(str(tmp_path / "p"))
    return Tables(
        vulnerabilities=no_broadcast.read.parquet(str(tmp_path / "v")),
        policies=no_broadcast.read.parquet(str(tmp_path / "p")),
    )


def test_filters_and_columns_reach_the_scan(no_broadcast, stored):
    plan = plan_of(no_broadcast, vulnerabilities.risk_priority(stored))
    assert "EqualTo(severity,Critical)" in plan and "Or(GreaterThan(epssscore,0.5),EqualTo(hasExploits,true))" in plan
    assert "proof" not in plan
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_severity_distribution_reads_two_columns_and_aggregates_before_the_shuffle(no_broadcast, stored):
    plan = plan_of(no_broadcast, vulnerabilities.severity_distribution(stored))
    assert "ReadSchema: struct<severity:string,cvssV3Score:double>" in plan
    assert re.search(r"Exchange hashpartitioning\(severity.*\n.*partial_count", plan)


def test_ranks_are_cut_before_the_shuffle(no_broadcast, stored):
    plan = plan_of(no_broadcast, vulnerabilities.top_findings_per_asset(stored))
    assert re.search(r"Exchange hashpartitioning\(assetId.*\n.*WindowGroupLimit.* 3, Partial", plan)


def test_distinct_assets_of_a_rule_shuffle_by_asset_too(no_broadcast, stored):
    plan = plan_of(no_broadcast, policies.agent_vs_scan(stored))
    assert "Expand" not in plan
    assert re.search(r"Exchange hashpartitioning\(benchmarkTitle[^,]*, ruleNaturalId[^,]*, ruleTitle[^,]*, assetId", plan)


def test_counting_failing_assets_leaves_the_texts_alone(no_broadcast, stored):
    plan = plan_of(no_broadcast, policies.top_failed_rules(stored))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted("fixTexts" in s for s in schemas) == [False, True]
    assert not any("fixTexts" in s and "assetId" in s for s in schemas)


@pytest.mark.parametrize(
    "analysis, text",
    [
        (vulnerabilities.epss_prioritisation, "title"), (vulnerabilities.epss_prioritisation_flow, "title"),
        (vulnerabilities.critical_by_fix, "bestSolutionSummary"), (remediation.cve_remediation_status, "title"),
    ],
)
def test_texts_stay_out_of_the_shuffles_that_count_assets(no_broadcast, tmp_path, analysis, text):
    no_broadcast.sql(
        "select 'a' as assetId, 'v' as vulnId, 'c' as cveId, 'Critical' as severity, 'High' as cvssV3Severity, 1.0D as cvssV3Score,"
        " 1.0D as epssscore, 1.0D as epsspercentile, true as hasExploits, 5 as riskScoreV2_0, 't' as title,"
        " 'PATCH' as bestSolutionType, 's' as bestSolutionSummary, timestamp_ntz'2024-01-01' as lastRemoved"
    ).write.parquet(str(tmp_path / "t"))
    rows = no_broadcast.read.parquet(str(tmp_path / "t"))
    plan = plan_of(no_broadcast, analysis(Tables(vulnerabilities=rows, vulnerability_remediation=rows)))
    counting = [line for line in re.findall(r"Exchange hashpartitioning\((.*)", plan) if "assetId" in line]
    assert counting and not any(re.search(rf"\b{text}#", line) for line in counting)
    assert "Expand" not in plan


def test_assets_and_findings_are_ranked_from_two_uses_of_one_frame(no_broadcast, tmp_path):
    no_broadcast.sql("select 'a' as assetId, 'h' as hostName, 5.0D as riskScore, 3 as riskScoreV2_0").write.parquet(str(tmp_path / "a"))
    no_broadcast.sql("select 'a' as assetId").write.parquet(str(tmp_path / "v"))
    t = Tables(assets=no_broadcast.read.parquet(str(tmp_path / "a")), vulnerabilities=no_broadcast.read.parquet(str(tmp_path / "v")))
    frame = derived.risk_vs_count_discrepancy(t)
    frame.collect()
    ran = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    print(ran.count("FileScan"), ran.count("Reused"))
    assert ran.count("FileScan") <= 4


def test_settings():
    assert "spark.sql.shuffle.partitions" not in settings()
    assert settings(10**14)["spark.sql.shuffle.partitions"] == str(-(-(10**14) // (128 * 2**20)))
    assert settings(10**12)["spark.sql.shuffle.partitions"] == str(-(-(10**12) // (128 * 2**20)))
    assert settings(1)["spark.sql.shuffle.partitions"] == "200"


def test_a_full_sort_does_not_repeat_the_scan(no_broadcast, stored):
    plan = plan_of(no_broadcast, vulnerabilities.cve_search(stored, "%x%"))
    assert re.search(r"Exchange rangepartitioning.*\n.*Exchange hashpartitioning\(assetId", plan)


def test_versions_are_taken_apart_once_each(no_broadcast, tmp_path):
    """Keys of versions are made of different versions, after the rows of each have been counted; not of every row."""
    no_broadcast.sql("select 'os' as product, '7.9.' || id % 3 as version from range(9) union all select null, null").write.parquet(str(tmp_path / "i"))
    no_broadcast.sql("select 'os' as product, '7.9' as version, date'2020-01-01' as eol_date").write.parquet(str(tmp_path / "e"))
    installed, listed = (no_broadcast.read.parquet(str(tmp_path / name)) for name in ("i", "e"))
    found = derived.eol_by_version(installed, listed, ["product"], "version", "2025-01-01")
    lines = plan_of(no_broadcast, found).splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line]
    assert len(scans) > 2 and not any("regexp" in line for i in scans for line in lines[i - 2 : i + 1])
    assert any("regexp" in line for line in lines) and found.count() == 9
