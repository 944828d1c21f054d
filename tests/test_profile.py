from __future__ import annotations

import pytest

from breakwater import Tables
from breakwater.operators import profile
from tests.fixtures import ASSETS, FINDINGS, POLICIES, REMEDIATION


def frame(spark, columns: dict, schema: str | None = None):
    return spark.createDataFrame(list(zip(*columns.values())), schema or list(columns))


@pytest.fixture
def tables(spark):
    return Tables(
        vulnerabilities=frame(spark, FINDINGS),
        assets=frame(spark, ASSETS),
        policies=frame(spark, POLICIES),
        vulnerability_remediation=frame(spark, REMEDIATION),
        vulnerability_exceptions=frame(spark, {"assetId": ["A"]}),
        asset_software=frame(spark, {"assetId": ["A", "A", "B"], "name": ["x", "y", "x"]}),
    )


def test_profile_of_tiny_tables(tables):
    assert profile.profile(tables) == {
        "vulnerabilities": {
            "total_rows": 5, "unique_assets": 2, "unique_vulnerabilities": 4,
            "severity_distribution": {"Critical": 2, "Moderate": 1, "Severe": 1},
            "cvss_v3_stats": {"min": 4.0, "max": 9.1, "avg": 7.0, "median": 7.45},
        },
        "assets": {"total_rows": 4, "unique_assets": 3, "os_family_distribution": {"Unix": 2, "Linux": 1}},
        "policies": {"total_rows": 6, "finalStatus_distribution": {"fail": 2, "pass": 2, "error": 1, "notApplicable": 1}},
        "vulnerability_remediation": {"total_rows": 3, "severity_distribution": {"Low": 2}},
        "asset_software": {"total_rows": 3, "unique_assets": 2},
    }


def test_missing_tables_have_no_section(spark):
    assert profile.profile(Tables()) == {}
    assert set(profile.profile(Tables(assets=frame(spark, ASSETS)))) == {"assets"}


def test_zero_shows_as_none_and_stays_zero_in_the_blocks(spark):
    schema = (
        "severity string, cvssV3Score double, hasExploits boolean, epssscore double, awsInstanceId string,"
        " azureResourceId string, gcpObjectId string"
    )
    tables = Tables(vulnerabilities=spark.createDataFrame([(None, 0.0, None, 0.0, None, None, None)], schema))
    section = profile.profile(tables)["vulnerabilities"]
    assert section["cvss_v3_stats"] == {"min": 0.0, "max": 0.0, "avg": None, "median": None}
    assert section["exploit_stats"] == {
        "vulnerabilities_with_exploits": 0, "high_epss_score_count": 0, "avg_epss_score": None,
    }
    assert section["severity_distribution"] == {}
    assert "cloud_distribution" not in section and "unique_assets" not in section
    assert profile.cvss_v3_stats(tables).first().median_score == 0.0


def test_empty_table(spark):
    tables = Tables(
        vulnerabilities=spark.createDataFrame([], "severity string, cvssV3Score double"),
        assets=spark.createDataFrame([], "assetId string, osFamily string"),
    )
    assert profile.profile(tables) == {
        "vulnerabilities": {
            "total_rows": 0, "severity_distribution": {},
            "cvss_v3_stats": {"min": None, "max": None, "avg": None, "median": None},
        },
        "assets": {"total_rows": 0, "unique_assets": 0},
    }


def test_rounding_of_the_report(spark):
    scores = {"cvssV3Score": [2.675, 2.675], "hasExploits": [True, False], "epssscore": [0.60001, 0.50004]}
    section = profile.profile(Tables(vulnerabilities=frame(spark, scores)))["vulnerabilities"]
    assert section["cvss_v3_stats"]["avg"] == round(2.675, 2)
    assert section["exploit_stats"] == {
        "vulnerabilities_with_exploits": 1, "high_epss_score_count": 2, "avg_epss_score": 0.55,
    }
