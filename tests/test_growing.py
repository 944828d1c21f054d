from __future__ import annotations

import pytest

from breakwater import Tables
from breakwater.operators import growing, profile
from breakwater.plans import loading
from breakwater.sources import versions
from breakwater.sources.catalog import purge
from breakwater.sources.loader import load
from tests.fixtures import ASSETS, FINDINGS, POLICIES, REMEDIATION, write

MORE = {
    "assetId": ["web-1", "nas-3"],
    "vulnId": ["openssl-heap", "new-one"],
    "severity": ["Severe", "Severe"],
    "cvssV3Score": [7, 10],
    "hasExploits": [True, None],
    "epssscore": [0.9, None],
    "awsInstanceId": ["i-1", None],
    "azureResourceId": [None, None],
    "gcpObjectId": [None, "g"],
}


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE growing_test")
    yield "growing_test"
    spark.sql("DROP DATABASE growing_test CASCADE")


def files(folder):
    return {
        "asset_vulnerability": [write(folder, "findings", FINDINGS)],
        "asset": [write(folder, "assets", ASSETS)],
        "asset_policy": [write(folder, "policies", POLICIES)],
        "vulnerability_remediation": [write(folder, "remediation", REMEDIATION)],
        "asset_software": [write(folder, "software", {"assetId": ["x", "x", "y"]})],
    }


def same(spark, database):
    found = growing.profile(spark, database)
    assert found == profile.profile(Tables.from_catalog(spark, database))
    return found


def test_an_append_reads_only_what_is_new(spark, database, tmp_path):
    load(spark, database, files(tmp_path))
    first = versions.latest(spark, database, "vulnerabilities").parts
    assert growing.summarise(spark, database, "vulnerabilities") == list(first)
    assert growing.summarise(spark, database, "vulnerabilities") == []
    before = same(spark, database)
    load(spark, database, {"asset_vulnerability": [write(tmp_path, "more", MORE)]}, append=True)
    both = versions.latest(spark, database, "vulnerabilities").parts
    assert both[0] == first[0] and growing.summarise(spark, database, "vulnerabilities") == [both[1]]
    after = same(spark, database)["vulnerabilities"]
    assert before["vulnerabilities"]["total_rows"] == 5 and after["total_rows"] == 7
    assert after["unique_assets"] == 3 and after["unique_vulnerabilities"] == 5
    assert after["cvss_v3_stats"]["max"] == 10.0 and after["exploit_stats"]["vulnerabilities_with_exploits"] == 1
    # What the blocks scan lies in the summaries' folders alone.
    _, found = growing.blocks(spark, database)
    scanned = [file for frame in found.values() for file in frame.inputFiles()]
    assert scanned and all("__cells_" in file or "__values_" in file for file in scanned)


def test_ids_of_wider_types_are_the_same_ids(spark, database, tmp_path):
    load(spark, database, {"asset_software": [write(tmp_path, "numbers", {"assetId": [1, 2, None]})]})
    load(spark, database, {"asset_software": [write(tmp_path, "texts", {"assetId": ["2", "three"]})]}, append=True)
    assert same(spark, database) == {"asset_software": {"total_rows": 5, "unique_assets": 3}}


def test_snapshots_compaction_and_clearing(spark, database, tmp_path):
    load(spark, database, files(tmp_path))
    load(spark, database, {"asset": [write(tmp_path, "again", ASSETS)]}, append=True)
    same(spark, database)
    assert versions.compact(spark, database, "assets") == 2
    assert growing.summarise(spark, database, "assets") == list(versions.latest(spark, database, "assets").parts)
    assert same(spark, database)["assets"]["total_rows"] == 8
    # Parts of no version go with their summaries; what is shown keeps its own.
    assert versions.drop_versions(spark, database, "assets") == 2
    assert growing.summarise(spark, database, "assets") == [] and same(spark, database)["assets"]["unique_assets"] == 3
    load(spark, database, {"asset": [write(tmp_path, "other", {"assetId": ["only"]})]})
    assert same(spark, database)["assets"] == {"total_rows": 1, "unique_assets": 1}
    purge(spark, database)
    assert growing.profile(spark, database) == {}
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 0


def test_tables_without_rows_or_parts(spark, database, tmp_path):
    empty = spark.createDataFrame([], "assetId string, vulnId string, severity string, cvssV3Score double, hasExploits boolean, epssscore double")
    part = versions.write_part(spark, database, "vulnerabilities", empty.selectExpr("*", f"'a' as {versions.LOAD}"), "a")
    versions.commit(spark, database, "vulnerabilities", lambda now: [part])
    spark.createDataFrame([("a", "Linux"), ("b", None)], "assetId string, osFamily string").write.saveAsTable(f"{database}.assets")
    found = same(spark, database)
    assert found["assets"]["unique_assets"] == 2 and found["vulnerabilities"]["total_rows"] == 0


def test_views_are_worked_out_once(spark, monkeypatch):
    """Both loads of the query read what one run of a view gave; rows without an asset and repeated ones stay."""
    seen = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in rows:
            seen.add(1)
            yield row

    def made(table):
        columns = ", ".join(
            f"cast(null as {kind}) as {c}" for c, kind in (
                ("vulnId", "string"), ("severity", "string"), ("cvssV3Score", "double"), ("hasExploits", "boolean"), ("epssscore", "double"),
                ("awsInstanceId", "string"), ("azureResourceId", "string"), ("gcpObjectId", "string"), ("osFamily", "string"),
                ("finalStatus", "string"), ("source", "string"), ("cvssV3Severity", "string"),
            )
        )
        rows = spark.sql(f"select nullif(concat('a', id % 5), 'a4') as assetId, {columns} from range(20)").select(*loading._GROWN_COLUMNS[table])
        return spark.createDataFrame(rows.rdd.mapPartitions(counted), rows.schema)

    monkeypatch.setattr(loading.driver_views, "tables", lambda spark, sf_dir: {table: made(table) for table in loading._GROWN})
    found = {(r.table_name, r.item): r.value for r in loading.grown_profile(spark, "").collect() if r.block in ("rows", "unique")}
    assert seen.value == 20 * len(loading._GROWN)
    assert {t: found[t, "total_rows"] for t in loading._GROWN} == dict.fromkeys(loading._GROWN, 20.0)
    assert found["vulnerabilities", "unique_assets"] == 4 and found["vulnerabilities", "unique_vulnerabilities"] == 0
