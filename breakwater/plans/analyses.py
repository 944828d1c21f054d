"""Analyses over the driver-table views, each with the SQL that checks it.

Averages are rounded to six digits on both sides, because the order of a
floating-point sum is not defined, and arrays are compared as joined text; the
library itself returns plain averages and arrays.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breakwater.operators import assets, cross, derived, policies, profile, remediation, software, vulnerabilities
from breakwater.tables import Tables

# Parameters under which the checks run.
AS_OF = "2001-12-31"
SITE = "%ASIA%"
CVE = "%CVE-12%"
ONE_CVE = "CVE-12"


class Analysis(NamedTuple):
    run: Callable[[Tables], DataFrame]
    sql: str | None
    rounded: tuple[str, ...] = ()
    joined: tuple[str, ...] = ()

    def result(self, t: Tables) -> DataFrame:
        return self.run(t).withColumns(
            {c: F.round(c, 6) for c in self.rounded} | {c: F.array_join(c, ", ") for c in self.joined}
        )


def _sorted(sql: str, order: str, limit: int) -> str:
    """The first rows by their rank, where the operators cut a sort."""
    return f"select * exclude (place) from (select *, row_number() over (order by {order}) as place from ({sql})) where place <= {limit}"


_PROVIDER = """case when awsInstanceId is not null then 'AWS' when azureResourceId is not null then 'Azure'
               when gcpObjectId is not null then 'GCP' else 'On-Premise' end"""

_RISK = """case when coalesce(cast(a.riskScoreV2_0 as double), a.riskScore) > 1000 then 1000.0E0
           else coalesce(cast(a.riskScoreV2_0 as double), a.riskScore) end"""


def _size_and_match(sample: DataFrame, rule: Column) -> DataFrame:
    return sample.agg(F.count("*").alias("sampled"), F.count_if(rule).alias("matching"))


ANALYSES: dict[str, Analysis] = {
    # assets
    "asset_inventory": Analysis(
        assets.asset_inventory,
        _sorted(
            "select assetId, hostName, ip, mac, osFamily, osProduct, osVersion, osType, riskScore from assets",
            "riskScore desc, assetId", 100,
        ),
    ),
    "assets_by_os": Analysis(
        assets.assets_by_os,
        """select osFamily, osProduct, osVendor, count(*) as asset_count, round(avg(riskScore), 6) as avg_risk_score
           from assets group by all""",
        ("avg_risk_score",),
    ),
    "assets_by_cloud": Analysis(
        assets.assets_by_cloud,
        f"""select {_PROVIDER} as cloud_provider, count(*) as asset_count,
                   round(avg(riskScore), 6) as avg_risk_score from assets group by all""",
        ("avg_risk_score",),
    ),
    "high_risk_assets": Analysis(
        assets.high_risk_assets,
        _sorted(
            """select assetId, hostName, ip, osDescription, riskScore, array_to_string(sites, ', ') as sites,
                      array_to_string(assetGroups, ', ') as assetGroups
               from assets where riskScore > 800""",
            "riskScore desc, assetId", 50,
        ),
        joined=("sites", "assetGroups"),
    ),
    "assets_by_site": Analysis(
        lambda t: assets.assets_by_site(t, SITE),
        f"""select assetId, hostName, ip, osFamily, riskScore from assets
            where exists (select 1 from unnest(sites) as u(x) where x like '{SITE}')""",
    ),
    "os_category_distribution": Analysis(
        assets.os_category_distribution,
        """select case when contains(osFamily, 'Windows') then 'Windows' when contains(osFamily, 'Linux') then 'Linux'
                       when contains(osFamily, 'Unix') then 'Unix' else 'Other' end as os_category,
                  osType, count(*) as count, round(avg(riskScore), 6) as avg_risk from assets group by all""",
        ("avg_risk",),
    ),
    # findings
    "critical_exploitable": Analysis(
        vulnerabilities.critical_exploitable,
        _sorted(
            """select assetId, hostName, vulnId, title, cvssV3Score, epssscore, epsspercentile, hasExploits,
                      firstFoundTimestamp
               from vulnerabilities where severity = 'Critical' and epssscore > 0.5""",
            """epssscore desc, cvssV3Score desc, assetId, hostName, vulnId, title, epsspercentile, hasExploits,
               firstFoundTimestamp""", 20,
        ),
    ),
    "asset_vuln_summary": Analysis(
        vulnerabilities.asset_vuln_summary,
        _sorted(
            """select assetId, hostName, ip, osDescription, count(*) as total_vulns,
                      count(*) filter (where severity = 'Critical') as critical_count,
                      count(*) filter (where hasExploits) as exploitable_count,
                      max(riskScoreV2_0) as max_risk_score, round(avg(cvssV3Score), 6) as avg_cvss_score
               from vulnerabilities group by all""",
            "critical_count desc, max_risk_score desc, assetId", 50,
        ),
        ("avg_cvss_score",),
    ),
    "vuln_age_buckets": Analysis(
        lambda t: vulnerabilities.vuln_age_buckets(t, AS_OF),
        f"""select case when age < 30 then '0-30 days' when age < 90 then '30-90 days'
                        when age < 180 then '90-180 days' else '180+ days' end as age_bucket,
                   severity, count(*) as count, round(avg(cvssV3Score), 6) as avg_cvss
            from (select *, date_diff('day', firstFoundTimestamp, timestamp '{AS_OF}') as age from vulnerabilities)
            group by all""",
        ("avg_cvss",),
    ),
    "cve_search": Analysis(
        lambda t: vulnerabilities.cve_search(t, CVE),
        f"""select assetId, hostName, ip, osDescription, vulnId, title, cvssV3Score, severity,
                   array_to_string(cves, ', ') as cves, firstFoundTimestamp
            from vulnerabilities where exists (select 1 from unnest(cves) as u(x) where x like '{CVE}')""",
        joined=("cves",),
    ),
    "epss_prioritisation": Analysis(
        vulnerabilities.epss_prioritisation,
        _sorted(
            """select vulnId, title, cvssV3Score, epssscore, epsspercentile, hasExploits,
                      count(distinct assetId) as affected_assets, round(avg(riskScoreV2_0), 6) as avg_risk_score
               from vulnerabilities where epssscore > 0.1 group by all having count(distinct assetId) > 5""",
            "epssscore desc, affected_assets desc, vulnId", 25,
        ),
        ("avg_risk_score",),
    ),
    "best_solution_availability": Analysis(
        vulnerabilities.best_solution_availability,
        "select bestSolutionType, count(*) as count from vulnerabilities group by all",
    ),
    "actionable_vulns": Analysis(
        vulnerabilities.actionable_vulns,
        _sorted(
            """select assetId, hostName, vulnId, title, severity, cvssV3Score, bestSolutionType, bestSolutionSummary
               from vulnerabilities
               where bestSolutionType in ('PATCH', 'ROLLUP', 'WORKAROUND') and bestSolutionSummary is not null""",
            "cvssV3Score desc, assetId, hostName, vulnId, title, severity, bestSolutionType, bestSolutionSummary", 50,
        ),
    ),
    "critical_by_fix": Analysis(
        vulnerabilities.critical_by_fix,
        _sorted(
            """select bestSolutionSummary, bestSolutionType, count(distinct vulnId) as distinct_vulns,
                      count(distinct assetId) as affected_assets, max(cvssV3Score) as max_cvss,
                      count(*) filter (where hasExploits) as with_exploits
               from vulnerabilities
               where severity = 'Critical' and bestSolutionType in ('PATCH', 'ROLLUP', 'WORKAROUND') group by all""",
            "affected_assets desc, bestSolutionSummary, bestSolutionType", 25,
        ),
    ),
    "cloud_vulns": Analysis(
        vulnerabilities.cloud_vulns,
        f"""select {_PROVIDER} as cloud_provider, count(distinct assetId) as asset_count, count(*) as vuln_count,
                   count(*) filter (where severity = 'Critical') as critical_vulns,
                   round(avg(cvssV3Score), 6) as avg_cvss
            from vulnerabilities group by all""",
        ("avg_cvss",),
    ),
    "reintroduced_vulns": Analysis(
        vulnerabilities.reintroduced_vulns,
        _sorted(
            """select assetId, hostName, vulnId, title, severity, firstFoundTimestamp, reintroducedTimestamp,
                      cast(date_diff('day', firstFoundTimestamp, reintroducedTimestamp) as integer) as days_between
               from vulnerabilities where reintroducedTimestamp is not null""",
            "reintroducedTimestamp desc, assetId, hostName, vulnId, title, severity, firstFoundTimestamp", 50,
        ),
    ),
    "pci_report": Analysis(
        vulnerabilities.pci_report,
        """select pciSeverity, pciCompliant, count(*) as vuln_count, count(distinct assetId) as affected_assets,
                  round(avg(cvssV3Score), 6) as avg_cvss
           from vulnerabilities where pciSeverity is not null group by all""",
        ("avg_cvss",),
    ),
    "risk_priority": Analysis(
        vulnerabilities.risk_priority,
        _sorted(
            """select assetId, hostName, vulnId, title, cvssV3Score, epssscore, hasExploits, severity
               from vulnerabilities where severity = 'Critical' and (epssscore > 0.5 or hasExploits)""",
            "epssscore desc, cvssV3Score desc, assetId, hostName, vulnId, title, hasExploits", 20,
        ),
    ),
    "severity_distribution": Analysis(
        vulnerabilities.severity_distribution,
        """select severity, count(*) as count, round(avg(cvssV3Score), 6) as avg_cvss
           from vulnerabilities group by all""",
        ("avg_cvss",),
    ),
    "asset_risk_summary": Analysis(
        vulnerabilities.asset_risk_summary,
        _sorted(
            """select assetId, hostName, ip, osDescription, count(*) as total_vulns,
                      count(*) filter (where severity = 'Critical') as critical_count,
                      count(*) filter (where hasExploits) as exploitable_count
               from vulnerabilities group by all""",
            "critical_count desc, total_vulns desc, assetId", 20,
        ),
    ),
    "cve_search_flow": Analysis(
        lambda t: vulnerabilities.cve_search_flow(t, CVE),
        f"""select assetId, hostName, vulnId, title, cvssV3Score, array_to_string(cves, ', ') as cves
            from vulnerabilities where exists (select 1 from unnest(cves) as u(x) where x like '{CVE}')""",
        joined=("cves",),
    ),
    "cloud_breakdown": Analysis(
        vulnerabilities.cloud_breakdown,
        f"""select {_PROVIDER} as cloud_provider, count(*) as vuln_count, count(distinct assetId) as asset_count
            from vulnerabilities group by all""",
    ),
    "epss_prioritisation_flow": Analysis(
        vulnerabilities.epss_prioritisation_flow,
        """select vulnId, title, cvssV3Score, epssscore, epsspercentile, count(distinct assetId) as affected_assets
           from vulnerabilities where epssscore > 0.1 group by all having count(distinct assetId) > 5""",
    ),
    # which rows a bare LIMIT returns is undefined: how many they are and whether all of them match is not
    "critical_sample": Analysis(
        lambda t: _size_and_match(vulnerabilities.critical_sample(t), F.col("severity") == "Critical"),
        "select least(10, count(*)) as sampled, least(10, count(*)) as matching from vulnerabilities where severity = 'Critical'",
    ),
    "known_exploits_top": Analysis(
        vulnerabilities.known_exploits_top,
        _sorted(
            "select assetId, vulnId, title, cvssV3Score, hasExploits, severity from vulnerabilities where hasExploits",
            "cvssV3Score desc, assetId, vulnId, title, severity", 20,
        ),
    ),
    "known_exploits_critical_top": Analysis(
        lambda t: vulnerabilities.known_exploits_top(t, limit=10, severity="Critical"),
        _sorted(
            """select assetId, vulnId, title, cvssV3Score, hasExploits, severity from vulnerabilities
               where hasExploits and severity = 'Critical'""",
            "cvssV3Score desc, assetId, vulnId, title", 10,
        ),
    ),
    "top_findings_per_asset": Analysis(
        vulnerabilities.top_findings_per_asset,
        """select assetId, vulnId, checkId, title, severity, epssscore, cvssV3Score,
                  cast(row_number() over (partition by assetId order by epssscore desc nulls last,
                       cvssV3Score desc nulls last, vulnId, checkId) as integer) as finding_rank
           from vulnerabilities qualify finding_rank <= 3""",
    ),
    # software
    "software_per_asset": Analysis(
        software.software_per_asset,
        _sorted(
            """select s.assetId, a.hostName, a.ip, a.osFamily, count(*) as software_count
               from asset_software s left join assets a using (assetId) group by all""",
            "software_count desc, assetId", 50,
        ),
    ),
    # policies
    "benchmark_compliance": Analysis(
        policies.benchmark_compliance,
        """select benchmarkTitle, profileTitle, source, count(*) as total_rules,
                  count(*) filter (where finalStatus = 'pass') as passed,
                  count(*) filter (where finalStatus = 'fail') as failed,
                  count(*) filter (where finalStatus = 'error') as errors,
                  count(*) filter (where finalStatus = 'notApplicable') as not_applicable,
                  round(100.0E0 * passed / total_rules, 2) as pass_rate_pct
           from policies group by all""",
    ),
    "policy_compliance_flow": Analysis(
        policies.policy_compliance_flow,
        """select benchmarkTitle, profileTitle, source, count(*) as total_rules,
                  count(*) filter (where finalStatus = 'pass') as passed,
                  count(*) filter (where finalStatus = 'fail') as failed,
                  round(100.0E0 * passed / total_rules, 2) as pass_rate_pct
           from policies group by all""",
    ),
    "top_failed_rules": Analysis(
        policies.top_failed_rules,
        _sorted(
            """select ruleNaturalId, ruleTitle, benchmarkTitle, count(distinct assetId) as affected_assets,
                      count(*) as total_failures, max(fixTexts) as fix_guidance
               from policies where finalStatus = 'fail' group by all""",
            "affected_assets desc, ruleNaturalId, ruleTitle, benchmarkTitle", 25,
        ),
    ),
    "top_failed_rules_flow": Analysis(
        policies.top_failed_rules_flow,
        _sorted(
            """select ruleTitle, benchmarkTitle, count(distinct assetId) as affected_assets,
                      max(fixTexts) as fix_guidance
               from policies where finalStatus = 'fail' group by all""",
            "affected_assets desc, ruleTitle, benchmarkTitle", 25,
        ),
    ),
    "asset_policy_comparison": Analysis(
        policies.asset_policy_comparison,
        _sorted(
            """select p.assetId, a.hostName, a.ip, a.osFamily, p.benchmarkTitle, count(*) as total_rules,
                      count(*) filter (where p.finalStatus = 'pass') as passed,
                      count(*) filter (where p.finalStatus = 'fail') as failed,
                      round(100.0E0 * passed / total_rules, 2) as pass_rate_pct
               from policies p left join assets a using (assetId) group by all""",
            "pass_rate_pct, assetId, benchmarkTitle", 50,
        ),
    ),
    "agent_vs_scan": Analysis(
        policies.agent_vs_scan,
        """select * from (
             select benchmarkTitle, ruleNaturalId, ruleTitle,
                    count(distinct assetId) filter (where source = 'agent') as agent_assessed,
                    count(distinct assetId) filter (where source = 'scan') as scan_assessed,
                    count(*) filter (where source = 'agent' and finalStatus = 'pass') as agent_pass,
                    count(*) filter (where source = 'agent' and finalStatus = 'fail') as agent_fail,
                    count(*) filter (where source = 'scan' and finalStatus = 'pass') as scan_pass,
                    count(*) filter (where source = 'scan' and finalStatus = 'fail') as scan_fail
             from policies group by all)
           where agent_assessed > 0 and scan_assessed > 0""",
    ),
    "failed_rules_guidance": Analysis(
        policies.failed_rules_guidance,
        _sorted(
            """select ruleNaturalId, ruleTitle, benchmarkTitle, finalStatus, fixTexts, rationales,
                      count(distinct assetId) as affected_assets
               from policies where finalStatus = 'fail' and fixTexts is not null group by all""",
            "affected_assets desc, ruleNaturalId, ruleTitle, benchmarkTitle, sha256(fixTexts), sha256(rationales)", 20,
        ),
    ),
    "failed_sample": Analysis(
        lambda t: _size_and_match(policies.failed_sample(t), F.col("finalStatus") == "fail"),
        "select least(10, count(*)) as sampled, least(10, count(*)) as matching from policies where finalStatus = 'fail'",
    ),
    # remediation
    "remediation_overview": Analysis(
        remediation.remediation_overview,
        """select if(lastRemoved is null, 'Still Present', 'Remediated') as status, count(*) as vuln_count,
                  count(distinct assetId) as affected_assets, round(avg(cvssV3Score), 6) as avg_cvss,
                  round(avg(date_diff('day', firstFoundTimestamp, lastRemoved)), 6) as avg_days_to_remediate
           from vulnerability_remediation group by all""",
        ("avg_cvss", "avg_days_to_remediate"),
    ),
    "cve_remediation_status": Analysis(
        remediation.cve_remediation_status,
        _sorted(
            """select cveId, title, cvssV3Score, cvssV3Severity, count(distinct assetId) as total_assets,
                      count(lastRemoved) as remediated_count,
                      count(*) - count(lastRemoved) as still_present_count,
                      round(100.0E0 * remediated_count / count(*), 2) as remediation_pct
               from vulnerability_remediation group by all""",
            "still_present_count desc, cveId, title, cvssV3Score, cvssV3Severity", 25,
        ),
    ),
    "remediation_velocity": Analysis(
        remediation.remediation_velocity,
        _sorted(
            """select date_trunc('week', lastRemoved) as remediation_week, count(*) as vulns_remediated,
                      count(distinct assetId) as assets_affected,
                      round(avg(date_diff('day', firstFoundTimestamp, lastRemoved)), 6) as avg_days_open,
                      round(avg(cvssV3Score), 6) as avg_cvss_remediated
               from vulnerability_remediation where lastRemoved is not null group by all""",
            "remediation_week desc", 12,
        ),
        ("avg_days_open", "avg_cvss_remediated"),
    ),
    "remediation_regressions": Analysis(
        remediation.remediation_regressions,
        _sorted(
            """select m.assetId, a.hostName, a.ip, m.cveId, m.title, m.cvssV3Score, m.firstFoundTimestamp,
                      m.lastRemoved, m.reintroducedTimestamp,
                      cast(date_diff('day', m.lastRemoved, m.reintroducedTimestamp) as integer)
                          as days_until_reintroduction
               from vulnerability_remediation m left join assets a using (assetId)
               where m.reintroducedTimestamp is not null""",
            "reintroducedTimestamp desc, assetId, cveId, title, cvssV3Score, firstFoundTimestamp, lastRemoved", 50,
        ),
    ),
    "high_risk_unremediated": Analysis(
        lambda t: remediation.high_risk_unremediated(t, AS_OF),
        _sorted(
            f"""select m.assetId, a.hostName, a.ip, m.cveId, m.title, m.cvssV3Score, m.cvssV3Severity, m.epssscore,
                       m.firstFoundTimestamp,
                       cast(date_diff('day', m.firstFoundTimestamp, timestamp '{AS_OF}') as integer) as days_open
                from vulnerability_remediation m left join assets a using (assetId)
                where m.lastRemoved is null and m.cvssV3Score >= 7""",
            """cvssV3Score desc, days_open desc, assetId, cveId, title, cvssV3Severity, epssscore,
               firstFoundTimestamp""", 50,
        ),
    ),
    "mttr_by_severity": Analysis(
        remediation.mttr_by_severity,
        """select cvssV3Severity, count(*) as remediated_count, round(avg(d), 6) as avg_mttr_days,
                  cast(min(d) as integer) as min_mttr_days, cast(max(d) as integer) as max_mttr_days,
                  quantile_cont(d, 0.5) as median_mttr_days
           from (select cvssV3Severity, date_diff('day', firstFoundTimestamp, lastRemoved) as d
                 from vulnerability_remediation where lastRemoved is not null) group by all""",
        ("avg_mttr_days",),
    ),
    "mttr_by_severity_flow": Analysis(
        remediation.mttr_by_severity_flow,
        """select cvssV3Severity, count(*) as remediated_count, round(avg(d), 6) as avg_mttr_days,
                  quantile_cont(d, 0.5) as median_mttr_days
           from (select cvssV3Severity, date_diff('day', firstFoundTimestamp, lastRemoved) as d
                 from vulnerability_remediation where lastRemoved is not null) group by all""",
        ("avg_mttr_days",),
    ),
    "findings_per_cve": Analysis(
        remediation.findings_per_cve,
        "select cveId, count(*) as count from vulnerability_remediation group by all",
    ),
    # across tables
    "assets_with_vuln_counts": Analysis(
        cross.assets_with_vuln_counts,
        _sorted(
            """select a.assetId, a.hostName, a.ip, a.osDescription, a.riskScore, count(v.vulnId) as total_vulns,
                      count(*) filter (where v.severity = 'Critical') as critical_count,
                      count(*) filter (where v.severity = 'Severe') as severe_count,
                      count(*) filter (where v.hasExploits) as exploitable_count,
                      round(avg(v.cvssV3Score), 6) as avg_cvss_score
               from assets a left join vulnerabilities v using (assetId) group by all""",
            "critical_count desc, riskScore desc, assetId", 50,
        ),
        ("avg_cvss_score",),
    ),
    "cloud_assets_critical": Analysis(
        cross.cloud_assets_critical,
        _sorted(
            f"""select assetId, hostName, ip, {_PROVIDER} as cloud_provider, awsInstanceId, azureResourceId,
                       gcpObjectId, count(vulnId) as critical_vuln_count, round(avg(cvssV3Score), 6) as avg_cvss
                from assets join (select assetId, vulnId, cvssV3Score from vulnerabilities
                                  where severity = 'Critical') using (assetId) group by all""",
            "critical_vuln_count desc, assetId", 50,
        ),
        ("avg_cvss",),
    ),
    "windows_servers_high_risk": Analysis(
        cross.windows_servers_high_risk,
        _sorted(
            """select a.assetId, a.hostName, a.ip, a.osProduct, a.osVersion, v.vulnId, v.title, v.cvssV3Score,
                      v.epssscore, v.hasExploits
               from assets a join vulnerabilities v using (assetId)
               where a.osFamily like '%Windows%' and a.osType = 'Server'
                 and v.severity = 'Critical' and v.epssscore > 0.3""",
            "epssscore desc, cvssV3Score desc, assetId, vulnId, title, hasExploits", 100,
        ),
    ),
    "clean_assets": Analysis(
        cross.clean_assets,
        """select assetId, hostName, ip, osDescription, riskScore from assets
           where not exists (select 1 from vulnerabilities v where v.assetId = assets.assetId and v.vulnId is not null)""",
    ),
    "top_hosts": Analysis(
        cross.top_hosts,
        _sorted(
            """select a.hostName, count(v.vulnId) as vuln_count
               from assets a join vulnerabilities v using (assetId) where a.hostName is not null group by all""",
            "vuln_count desc, hostName", 5,
        ),
    ),
    "policy_status_distribution": Analysis(
        cross.policy_status_distribution,
        "select finalStatus, count(*) as count from policies group by all",
    ),
    # described in words only
    "agent_scan_discrepancies": Analysis(
        derived.agent_scan_discrepancies,
        """select * from (
             select assetId, benchmarkTitle, ruleNaturalId,
                    max(finalStatus) filter (where source = 'agent') as agent_status,
                    max(finalStatus) filter (where source = 'scan') as scan_status
             from (select * from policies qualify row_number() over (
                     partition by assetId, benchmarkTitle, ruleNaturalId, source
                     order by lastAssessmentTimestamp desc, finalStatus desc) = 1)
             group by all)
           where agent_status <> scan_status""",
    ),
    "assessment_coverage_gaps": Analysis(
        derived.assessment_coverage_gaps,
        """with a as (select distinct benchmarkTitle, ruleNaturalId, assetId from policies where source = 'agent'),
                s as (select distinct benchmarkTitle, ruleNaturalId, assetId from policies where source = 'scan')
           select coalesce(a.benchmarkTitle, s.benchmarkTitle) as benchmarkTitle,
                  coalesce(a.ruleNaturalId, s.ruleNaturalId) as ruleNaturalId,
                  count(*) filter (where s.assetId is null) as agent_only_assets,
                  count(*) filter (where a.assetId is null) as scan_only_assets,
                  count(*) filter (where a.assetId = s.assetId) as both_assets
           from a full join s on a.benchmarkTitle = s.benchmarkTitle and a.ruleNaturalId = s.ruleNaturalId
                and a.assetId = s.assetId
           group by 1, 2""",
    ),
    "compliance_trend": Analysis(
        derived.compliance_trend,
        """select date_trunc('month', lastAssessmentTimestamp) as month, count(*) as total_rules,
                  count(*) filter (where finalStatus = 'pass') as passed,
                  round(100.0E0 * passed / total_rules, 2) as pass_rate_pct
           from policies group by all""",
    ),
    "rule_failures_by_os": Analysis(
        derived.rule_failures_by_os,
        """select a.osFamily, a.osType, count(*) as failures, count(distinct assetId) as failing_assets
           from policies p join assets a using (assetId) where p.finalStatus = 'fail' group by all""",
    ),
    "discovery_trend": Analysis(
        derived.discovery_trend,
        """select date_trunc('week', firstFoundTimestamp) as week, severity, count(*) as new_findings
           from vulnerabilities where firstFoundTimestamp is not null group by all""",
    ),
    "cve_still_present_assets": Analysis(
        lambda t: derived.cve_still_present_assets(t, ONE_CVE),
        f"""select distinct assetId from vulnerability_remediation
            where lastRemoved is null and cveId = '{ONE_CVE}'""",
    ),
    "risk_vs_count_discrepancy": Analysis(
        derived.risk_vs_count_discrepancy,
        _sorted(
            f"""select assetId, hostName, risk, findings, round(r, 6) as risk_rank, round(c, 6) as count_rank,
                      round(abs(r - c), 6) as gap
               from (select *, percent_rank() over (order by risk) as r, percent_rank() over (order by findings) as c
                     from (select a.assetId, a.hostName,
                                  {_RISK} as risk,
                                  count(v.assetId) as findings
                           from assets a left join vulnerabilities v using (assetId) group by all)
                     where risk is not null)""",
            "gap desc, assetId", 50,
        ),
    ),
    "software_vs_findings": Analysis(
        derived.software_vs_findings,
        _sorted(
            """select softwareName, count(*) as affected_assets, cast(sum(critical) as bigint) as critical_findings
               from (select distinct assetId, softwareName from asset_software)
               join (select assetId, count(*) as critical from vulnerabilities where severity = 'Critical'
                     group by all) using (assetId) group by all""",
            "critical_findings desc, softwareName", 50,
        ),
    ),
    "by_group": Analysis(
        derived.by_group,
        """select g as asset_group, count(distinct assetId) as asset_count, round(avg(riskScore), 6) as avg_risk_score
           from (select assetId, riskScore, unnest(assetGroups) as g from assets) group by all""",
        ("avg_risk_score",),
    ),
    "by_tag": Analysis(
        derived.by_tag,
        """select g.tagType as tagType, g.name as tag, count(distinct assetId) as asset_count,
                  round(avg(riskScore), 6) as avg_risk_score
           from (select assetId, riskScore, unnest(tags) as g from assets) group by all""",
        ("avg_risk_score",),
    ),
    "os_type_arch_distribution": Analysis(
        derived.os_type_arch_distribution,
        "select osType, osArchitecture, count(*) as asset_count from assets group by all",
    ),
    "net_of_exceptions": Analysis(
        derived.severity_net_of_exceptions,
        """select severity, count(*) as count from vulnerabilities v
           where not exists (select 1 from vulnerability_exceptions e where e.assetId = v.assetId
                             and e.vulnId = v.vulnId and e.checkId = v.checkId)
           group by all""",
    ),
    "priority_score": Analysis(
        derived.priority_score,
        _sorted(
            f"""select *, if(epssscore > 0.5, 1, 0) + if(cvssV3Score >= 9, 1, 0) + if(hasExploits, 1, 0)
                         + if(max_asset_risk > 800, 1, 0) + if(affected_assets > 5, 1, 0) as signals
               from (select v.vulnId, max(v.epssscore) as epssscore, max(v.cvssV3Score) as cvssV3Score,
                            bool_or(v.hasExploits) as hasExploits,
                            max({_RISK})
                                as max_asset_risk,
                            count(distinct v.assetId) as affected_assets
                     from vulnerabilities v left join assets a using (assetId) group by all)""",
            "signals desc, epssscore desc, cvssV3Score desc, affected_assets desc, vulnId", 50,
        ),
    ),
    "fix_guidance": Analysis(
        derived.fix_guidance,
        """select coalesce(bestSolutionType, 'UNKNOWN') as solution_type,
                  regexp_replace(bestSolutionFix, '<[^>]*>', '', 'g') as fix_text, count(*) as findings
           from vulnerabilities group by all""",
    ),
    "high_risk_remediation_rate": Analysis(
        derived.high_risk_remediation_rate,
        """select coalesce(cvssV3Score >= 7 or epssscore > 0.5, false) as high_risk, count(*) as findings,
                  count(lastRemoved) as remediated, round(100.0E0 * remediated / findings, 2) as remediation_pct,
                  quantile_cont(date_diff('day', firstFoundTimestamp, lastRemoved), 0.5) as median_days
           from vulnerability_remediation group by all""",
    ),
    "severity_by_cloud": Analysis(
        derived.severity_by_cloud,
        f"""select * from (select {_PROVIDER} as cloud_provider, severity, count(*) as count
                           from vulnerabilities group by all) where cloud_provider <> 'On-Premise'""",
    ),
    # profile
    "profile_total_rows": Analysis(
        profile.total_rows,
        "\nunion all ".join(
            f"select '{name}' as table_name, count(*) as total_rows from {name}"
            for name in (
                "assets", "vulnerabilities", "vulnerability_exceptions", "policies", "vulnerability_remediation",
                "asset_software",
            )
        ),
    ),
    "profile_vulnerabilities_unique": Analysis(
        lambda t: profile.unique_counts(
            t, "vulnerabilities", unique_assets="assetId", unique_vulnerabilities="vulnId"
        ),
        """select count(distinct assetId) as unique_assets, count(distinct vulnId) as unique_vulnerabilities
           from vulnerabilities""",
    ),
    "profile_severity": Analysis(
        lambda t: profile.distribution(t, "vulnerabilities", "severity"),
        "select severity, count(*) as count from vulnerabilities where severity is not null group by all",
    ),
    "profile_cvss_v3": Analysis(
        profile.cvss_v3_stats,
        """select min(cvssV3Score) as min_score, max(cvssV3Score) as max_score,
                  round(avg(cvssV3Score), 6) as avg_score, round(quantile_cont(cvssV3Score, 0.5), 6) as median_score
           from vulnerabilities""",
        ("avg_score", "median_score"),
    ),
    "profile_exploits": Analysis(
        profile.exploit_stats,
        """select count(*) filter (where hasExploits) as with_exploits,
                  count(*) filter (where epssscore > 0.5) as high_epss, round(avg(epssscore), 6) as avg_epss
           from vulnerabilities""",
        ("avg_epss",),
    ),
    "profile_cloud_rows": Analysis(
        profile.cloud_distribution,
        """select count(awsInstanceId) as aws_rows, count(azureResourceId) as azure_rows,
                  count(gcpObjectId) as gcp_rows from vulnerabilities""",
    ),
    "profile_cloud_assets": Analysis(
        profile.cloud_assets,
        """select count(distinct assetId) filter (where awsInstanceId is not null) as aws_assets,
                  count(distinct assetId) filter (where azureResourceId is not null) as azure_assets,
                  count(distinct assetId) filter (where gcpObjectId is not null) as gcp_assets
           from vulnerabilities""",
    ),
    "profile_assets_unique": Analysis(
        lambda t: profile.unique_counts(t, "assets", unique_assets="assetId"),
        "select count(distinct assetId) as unique_assets from assets",
    ),
    "profile_os_family": Analysis(
        lambda t: profile.distribution(t, "assets", "osFamily"),
        "select osFamily, count(*) as count from assets where osFamily is not null group by all",
    ),
    "profile_final_status": Analysis(
        lambda t: profile.distribution(t, "policies", "finalStatus"),
        "select finalStatus, count(*) as count from policies where finalStatus is not null group by all",
    ),
    "profile_source": Analysis(
        lambda t: profile.distribution(t, "policies", "source"),
        "select source, count(*) as count from policies where source is not null group by all",
    ),
    "profile_remediation_severity": Analysis(
        lambda t: profile.distribution(t, "vulnerability_remediation", "cvssV3Severity"),
        """select cvssV3Severity, count(*) as count from vulnerability_remediation
           where cvssV3Severity is not null group by all""",
    ),
    "profile_software_unique": Analysis(
        lambda t: profile.unique_counts(t, "asset_software", unique_assets="assetId"),
        "select count(distinct assetId) as unique_assets from asset_software",
    ),
}
