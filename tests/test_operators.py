"""Edge cases that the driver tables do not hold, against brute force."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from breakwater import Tables
from breakwater.functions import rules
from breakwater.functions.ordering import ordered, top
from breakwater.operators import assets, cross, derived, policies, remediation, software, vulnerabilities
from breakwater.plans import driver_views
from breakwater.tables import MissingTable


def plain(frame):
    return [tuple(r) for r in frame.collect()]


@pytest.fixture(scope="module")
def hot(spark):
    """Three assets, one listed twice, one without findings; one asset holds most findings."""
    rng = random.Random(7)
    owned = spark.createDataFrame(
        [("A", "host-a", "1", 10.0), ("A", "host-a", "1", 10.0), ("B", "host-b", "2", None), ("C", None, "3", 5.0)],
        "assetId string, hostName string, ip string, riskScore double",
    )
    rows = [
        (rng.choice("AAAAAABX"), f"V{rng.randrange(40)}", rng.choice(["Critical", "Severe", None]),
         rng.choice([None, 1.0, 9.5]), rng.choice([True, False, None]))
        for _ in range(500)
    ]
    found = spark.createDataFrame(
        rows, "assetId string, vulnId string, severity string, cvssV3Score double, hasExploits boolean"
    )
    return Tables(assets=owned, vulnerabilities=found), rows


def test_counts_per_asset_equal_joining_first(hot):
    tables, rows = hot
    got = {r.assetId: r for r in cross.assets_with_vuln_counts(tables).collect()}
    assert set(got) == {"A", "B", "C"}
    for asset, copies in (("A", 2), ("B", 1), ("C", 0)):
        mine = [r for r in rows if r[0] == asset]
        assert got[asset].total_vulns == copies * len(mine)
        assert got[asset].critical_count == copies * sum(r[2] == "Critical" for r in mine)
        assert got[asset].exploitable_count == copies * sum(r[4] is True for r in mine)
        scores = [r[3] for r in mine if r[3] is not None]
        if scores:
            assert got[asset].avg_cvss_score == pytest.approx(sum(scores) / len(scores))
        else:
            assert got[asset].avg_cvss_score is None
    assert got["B"].osDescription is None  # a documented column the export lacks


def test_clean_assets_and_top_hosts(hot):
    tables, rows = hot
    assert [r.assetId for r in cross.clean_assets(tables).collect()] == ["C"]
    hosts = {r.hostName: r.vuln_count for r in cross.top_hosts(tables).collect()}
    counts = Counter(r[0] for r in rows)
    assert hosts == {"host-a": 2 * counts["A"], "host-b": counts["B"]}


def test_software_of_a_repeated_and_of_an_unknown_asset(spark, hot):
    tables = Tables(assets=hot[0]["assets"], asset_software=spark.createDataFrame([("A",), ("A",), ("Z",)], "assetId string"))
    assert plain(software.software_per_asset(tables).select("assetId", "hostName", "software_count")) == [
        ("A", "host-a", 4), ("Z", None, 1),
    ]


def test_top_findings_per_asset_of_a_hot_asset(hot):
    tables, rows = hot
    got = Counter(r.assetId for r in vulnerabilities.top_findings_per_asset(tables).collect())
    assert got == {asset: min(3, n) for asset, n in Counter(r[0] for r in rows).items()}


def test_samples_return_only_matching_rows(spark, sf_dir):
    tables = driver_views.tables(spark, sf_dir)
    critical = vulnerabilities.critical_sample(tables).collect()
    assert len(critical) == 10 and {r.severity for r in critical} == {"Critical"}
    failed = policies.failed_sample(tables).collect()
    assert len(failed) == 10 and {r.finalStatus for r in failed} == {"fail"}


def test_attributes_come_from_assets_when_findings_lack_them(hot):
    tables, rows = hot
    named = tables.read("vulnerabilities", "assetId", "hostName", "vulnId").collect()
    assert len(named) == len(rows)  # the repeated asset does not multiply findings
    assert {(r.assetId, r.hostName) for r in named} == {("A", "host-a"), ("B", "host-b"), ("X", None)}
    assert {r.ip for r in tables.read("vulnerabilities", "ip").collect()} == {"1", "2", None}
    alone = Tables(vulnerabilities=tables["vulnerabilities"])
    assert {r.hostName for r in alone.read("vulnerabilities", "hostName").collect()} == {None}


def test_tables_refuse_what_they_cannot_give(hot):
    tables, _ = hot
    with pytest.raises(MissingTable):
        tables["policies"]
    with pytest.raises(ValueError, match="no column"):
        tables.read("assets", "colour")
    with pytest.raises(ValueError, match="not tables"):
        Tables(something=None)


def test_findings_without_optional_columns_still_answer(hot):
    tables, rows = hot
    assert plain(vulnerabilities.best_solution_availability(tables)) == [(None, len(rows))]
    assert vulnerabilities.actionable_vulns(tables).isEmpty()
    assert vulnerabilities.pci_report(tables).isEmpty()


def test_percent_rank_equals_brute_force(spark):
    rng = random.Random(3)
    values = [rng.choice([0.0, 1.0, 1.0004, 1.0009, 2.5, 999.9, 1000.0, -3.0, -3.5]) for _ in range(400)]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double").repartition(7)
    bucket = F.greatest(F.floor(F.col("v") * 1000), F.lit(-1))
    counted = frame.groupBy("v").agg(F.count("*").alias("n"))
    got = {r.v: r.rank for r in derived._percent_rank(counted, "v", bucket, "rank").collect()}
    for v in values:
        assert got[v] == pytest.approx(sum(w < v for w in values) / (len(values) - 1))
    (only,) = derived._percent_rank(spark.createDataFrame([(1, 5.0)], "n int, v double"), "v", bucket, "rank").collect()
    assert only.rank == 0.0


def test_age_buckets(spark):
    ages = {0: "0-30 days", 29: "0-30 days", 30: "30-90 days", 89: "30-90 days", 90: "90-180 days", 179: "90-180 days", 180: "180+ days"}
    frame = spark.createDataFrame([(d,) for d in [*ages, None]], "d int").selectExpr(
        "d", "timestamp_ntz'2024-06-30 23:00:00' - make_dt_interval(d) as firstFoundTimestamp"
    )
    got = {r.d: r.b for r in frame.select("d", rules.age_bucket("firstFoundTimestamp", "2024-06-30 01:00:00").alias("b")).collect()}
    assert got == {**ages, None: "180+ days"}


def test_days_count_midnights(spark):
    frame = spark.sql("select timestamp_ntz'2024-01-01 23:00:00' as a, timestamp_ntz'2024-01-02 01:00:00' as b")
    assert frame.select(rules.days_between("a", "b"), rules.days_between("b", "a")).first() == (1, -1)


def test_weeks_start_on_monday(spark):
    frame = spark.sql("select timestamp_ntz'2024-01-07 23:59:59' as a, timestamp_ntz'2024-02-29 12:00:00' as b")
    row = frame.select(rules.week_of("a").alias("w"), rules.month_of("b").alias("m")).first()
    assert (str(row.w), str(row.m)) == ("2024-01-01 00:00:00", "2024-02-01 00:00:00")


def test_risk_is_capped_and_prefers_the_current_score(spark):
    frame = spark.createDataFrame([(5, 9.0), (None, 9.0), (2000, 1.0), (None, 1500.0), (None, None)], "riskScoreV2_0 int, riskScore double")
    assert [r[0] for r in frame.select(rules.asset_risk()).collect()] == [5.0, 9.0, 1000.0, 1000.0, None]


def test_like_has_no_escape_character(spark):
    frame = spark.createDataFrame([("a\\b",), ("a_b",), ("axb",)], "s string")
    assert [r.s for r in frame.where(rules.like(F.col("s"), "a\\b")).collect()] == ["a\\b"]
    assert frame.where(rules.like(F.col("s"), "a_b")).count() == 3


def test_tags_are_stripped_over_lines(spark):
    frame = spark.createDataFrame([("<p\nclass='x'>Run <b>this</b></p>",), (None,)], "h string")
    assert [r.t for r in derived.clean_fix_text(frame, "h", "t").collect()] == ["Run this", None]


def test_nulls_sort_last_both_ways_and_ties_are_decided(spark):
    frame = spark.createDataFrame([(1, "b"), (None, "a"), (2, "c"), (1, "a")], "k int, s string")
    assert plain(ordered(frame, "k")) == [(1, "a"), (1, "b"), (2, "c"), (None, "a")]
    assert plain(ordered(frame, "-k")) == [(2, "c"), (1, "a"), (1, "b"), (None, "a")]
    assert plain(top(frame, 2, "-k")) == [(2, "c"), (1, "a")]


def test_sites_and_cves_may_be_null(spark):
    frame = spark.createDataFrame([("A", ["x Production y"]), ("B", None), ("C", [None])], "assetId string, sites array<string>")
    assert [r.assetId for r in assets.assets_by_site(Tables(assets=frame)).collect()] == ["A"]


def test_median_of_open_and_undated_findings(spark):
    frame = spark.sql("""
        select * from values
          ('High', timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-02'),
          ('High', timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-05'),
          ('High', null, timestamp_ntz'2024-01-05'),
          ('High', timestamp_ntz'2024-01-01', null),
          ('Low', null, timestamp_ntz'2024-01-05')
        as t(cvssV3Severity, firstFoundTimestamp, lastRemoved)""")
    rows = {r.cvssV3Severity: tuple(r)[1:] for r in remediation.mttr_by_severity(Tables(vulnerability_remediation=frame)).collect()}
    assert rows == {"High": (3, 2.5, 1, 4, 2.5), "Low": (1, None, None, None, None)}


def test_discrepancies_compare_latest_results(spark):
    rows = [
        ("A", "agent", "pass", "2024-01-01"), ("A", "agent", "fail", "2024-01-02"), ("A", "scan", "pass", "2024-01-01"),
        ("B", "agent", "pass", "2024-01-01"), ("B", "scan", "fail", "2024-01-01"), ("B", "scan", "pass", "2024-01-03"),
        ("C", "agent", "pass", "2024-01-01"),
    ]
    frame = spark.createDataFrame(
        [(a, "bench", "rule", s, f, t) for a, s, f, t in rows],
        "assetId string, benchmarkTitle string, ruleNaturalId string, source string, finalStatus string, at string",
    ).withColumn("lastAssessmentTimestamp", F.col("at").cast("timestamp_ntz"))
    tables = Tables(policies=frame)
    assert plain(derived.agent_scan_discrepancies(tables)) == [("A", "bench", "rule", "fail", "pass")]
    assert plain(derived.assessment_coverage_gaps(tables)) == [("bench", "rule", 1, 0, 2)]


def test_worst_assets_of_repeated_attributes(spark):
    owned = spark.createDataFrame([("A", "h1"), ("A", "h1"), ("A", "h2")], "assetId string, hostName string")
    results = spark.createDataFrame([("A", "b", "pass"), ("A", "b", "fail"), ("Z", "b", "fail")], "assetId string, benchmarkTitle string, finalStatus string")
    rows = policies.asset_policy_comparison(Tables(assets=owned, policies=results), limit=3)
    assert plain(rows.select("assetId", "hostName", "total_rules", "passed", "pass_rate_pct")) == [
        ("Z", None, 1, 0, 0.0), ("A", "h1", 4, 2, 50.0), ("A", "h2", 2, 1, 50.0),
    ]


def test_guidance_of_rules_without_an_id_and_with_several_texts(spark):
    rows = [
        ("A", None, "rule", "b", "fail", "x", None), ("B", None, "rule", "b", "fail", "y", None),
        ("C", None, "rule", "b", "fail", None, None), ("A", None, "rule", "b", "fail", "x", None),
        ("A", "2", "other", "b", "fail", None, "why"), ("A", "2", "other", "b", "pass", "z", "why"),
    ]
    frame = spark.createDataFrame(
        rows,
        "assetId string, ruleNaturalId string, ruleTitle string, benchmarkTitle string, finalStatus string,"
        " fixTexts string, rationales string",
    )
    tables = Tables(policies=frame)
    assert plain(policies.top_failed_rules(tables)) == [(None, "rule", "b", 3, 4, "y"), ("2", "other", "b", 1, 1, None)]
    assert plain(policies.top_failed_rules_flow(tables, limit=1)) == [("rule", "b", 3, "y")]
    assert sorted(plain(policies.failed_rules_guidance(tables))) == [
        (None, "rule", "b", "fail", "x", None, 1), (None, "rule", "b", "fail", "y", None, 1),
    ]


def test_borrowed_attributes_give_the_same_answers(spark, sf_dir):
    """Findings without asset attributes answer as findings that carry them."""
    full = driver_views.tables(spark, sf_dir)
    lean = Tables(
        assets=full["assets"],
        vulnerabilities=full["vulnerabilities"].drop(
            "hostName", "ip", "osDescription", "awsInstanceId", "azureResourceId", "gcpObjectId"
        ),
    )
    for analysis in (
        vulnerabilities.critical_exploitable, vulnerabilities.asset_vuln_summary, vulnerabilities.asset_risk_summary,
        vulnerabilities.actionable_vulns, vulnerabilities.cloud_vulns, vulnerabilities.cloud_breakdown,
        vulnerabilities.reintroduced_vulns, vulnerabilities.risk_priority, derived.severity_by_cloud,
        lambda t: vulnerabilities.cve_search(t, "%CVE-12%"), lambda t: vulnerabilities.cve_search_flow(t, "%CVE-12%"),
    ):
        expected, got = analysis(full), analysis(lean)
        assert got.columns == expected.columns

        def shown(frame):
            return sorted(repr([round(v, 6) if isinstance(v, float) else v for v in r]) for r in frame.collect())

        assert shown(got) == shown(expected)


def test_long_top_lists_join_without_a_hint(spark, sf_dir):
    tables = driver_views.tables(spark, sf_dir)
    short, long = (plain(policies.top_failed_rules(tables, limit=n)) for n in (10_000, 10_001))
    assert short == long and len(short) > 10
    assert plain(policies.failed_rules_guidance(tables, 10_000)) == plain(policies.failed_rules_guidance(tables, 10_001))
