from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrame

from breakwater import Tables
from breakwater.plans import loading
from breakwater.sources import catalog, versions
from breakwater.sources.loader import current_version, drop_versions, load, load_path
from tests.fixtures import ASSETS, FINDINGS, POLICIES, REMEDIATION, write


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def rows(spark, database, table, *columns):
    return sorted(tuple(r) for r in spark.table(f"{database}.{table}").select(*columns).collect())


def test_files_go_to_the_table_of_their_prefix(spark, database, tmp_path):
    report = load(
        spark,
        database,
        {
            "asset": [write(tmp_path, "a", ASSETS)],
            "asset_vulnerability": [write(tmp_path, "v", FINDINGS)],
            "vulnerability_remediation/daily": [write(tmp_path, "r", REMEDIATION)],
        },
    )
    assert report.row_counts == {"assets": 4, "vulnerabilities": 5, "vulnerability_remediation": 3}
    assert report.warnings == []
    critical = spark.table(f"{database}.vulnerabilities").where("severity = 'Critical'")
    assert sorted(r.vulnId for r in critical.collect()) == ["kernel-leak", "sudo-race"]
    assert len(spark.table(f"{database}.vulnerabilities").columns) == 5


def test_policy_sources_share_a_table_and_are_tagged(spark, database, tmp_path):
    path = write(tmp_path, "p", POLICIES)
    load(spark, database, {"asset_policy": [path], "asset_scan_policy": [path]})
    assert spark.table(f"{database}.policies").columns == [*POLICIES, "source"]
    assert rows(spark, database, "policies", "assetId", "source") == sorted(
        (asset, source) for asset in POLICIES["assetId"] for source in ("agent", "scan")
    )


def test_unknown_and_skipped_prefixes(spark, database, tmp_path):
    path = write(tmp_path, "a", ASSETS)
    report = load(spark, database, {"mystery": [path], "asset/v2": [path], "asset_policy": [path]}, skip={"asset"})
    assert set(report.row_counts) == {"policies"}
    assert report.warnings == ["unknown prefix 'mystery', skipped"]


def test_no_files(spark, database):
    assert load(spark, database, {}).row_counts == {}
    assert load(spark, database, {"asset": []}).row_counts == {}


def test_snapshot_replaces_its_tables_and_no_others(spark, database, tmp_path):
    findings, assets = write(tmp_path, "v", FINDINGS), write(tmp_path, "a", ASSETS)
    load(spark, database, {"vulnerability_remediation": [write(tmp_path, "r", REMEDIATION)]})
    load(spark, database, {"asset_policy": [write(tmp_path, "p", POLICIES)]})
    for _ in range(3):
        report = load(spark, database, {"asset_vulnerability": [findings], "asset": [assets]})
    assert report.row_counts == {"vulnerabilities": 5, "assets": 4}
    assert spark.table(f"{database}.vulnerability_remediation").count() == 3
    assert spark.table(f"{database}.policies").count() == 6
    assert [drop_versions(spark, database, t) for t in ("vulnerabilities", "assets", "policies")] == [2, 2, 0]
    kept = [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect() if "__" in r.tableName]
    assert len([k for k in kept if "__v" not in k]) == len([k for k in kept if "__v" in k]) == 4  # a version of one part per table


def test_append_adds_and_does_not_deduplicate(spark, database, tmp_path):
    path = write(tmp_path, "r", REMEDIATION)
    for expected in (3, 6, 9):
        report = load(spark, database, {"vulnerability_remediation": [path]}, append=True)
        assert report.row_counts == {"vulnerability_remediation": expected}


def test_append_with_other_columns(spark, database, tmp_path):
    load(spark, database, {"vulnerability_remediation": [write(tmp_path, "r", REMEDIATION)]}, append=True)
    more = {"epssscore": [0.9], "cveId": ["CVE-3"], "assetId": ["tv-2"]}
    load(spark, database, {"vulnerability_remediation": [write(tmp_path, "m", more)]}, append=True)
    table = f"{database}.vulnerability_remediation"
    assert spark.table(table).columns == [*REMEDIATION, "epssscore"]
    found = spark.table(table).select("cveId", "proof", "epssscore").collect()
    assert len(found) == 4 and ("CVE-3", None, 0.9) in map(tuple, found)
    assert ("CVE-1999-0017", "banner says 1.0", None) in map(tuple, found)


def test_files_combine_by_name(spark, database, tmp_path):
    other = {"protocol": ["tcp"], "assetId": ["tv-2"], "vulnId": ["late"]}
    load(spark, database, {"asset_vulnerability": [write(tmp_path, "v", FINDINGS), write(tmp_path, "w", other)]})
    assert spark.table(f"{database}.vulnerabilities").columns == [*FINDINGS, "protocol"]
    late = spark.table(f"{database}.vulnerabilities").where("vulnId = 'late'").first().asDict()
    assert late == dict.fromkeys(FINDINGS) | {"vulnId": "late", "assetId": "tv-2", "protocol": "tcp"}


def test_files_combine_by_position(spark, database, tmp_path):
    same = {"a": ["tv-2"], "b": ["late"], "c": ["Severe"], "d": [1.0], "e": [datetime(2024, 1, 2)]}
    fewer = {"a": ["tv-3"]}
    report = load(
        spark,
        database,
        {"asset_vulnerability": [write(tmp_path, n, c) for n, c in (("v", FINDINGS), ("s", same), ("f", fewer))]},
        by="position",
    )
    assert report.row_counts == {"vulnerabilities": 6}
    assert any("1 columns instead of 5" in w for w in report.warnings)
    late = spark.table(f"{database}.vulnerabilities").where("vulnId = 'late'").first()
    assert (late.assetId, late.firstFoundTimestamp) == ("tv-2", datetime(2024, 1, 2))


@pytest.mark.parametrize("by", ["name", "position"])
@pytest.mark.parametrize(
    "values, kind, shown",
    [
        ([[1], [7.5]], "double", ["1.0", "7.5"]),
        ([[7.5], [1]], "double", ["1.0", "7.5"]),
        ([[1], ["7"], ["8", "z"]], "string", ["1", "7", "8", "z"]),
        ([[date(2024, 1, 2)], [datetime(2024, 1, 2, 3, 4)]], "timestamp_ntz", ["2024-01-02 00:00:00", "2024-01-02 03:04:00"]),
        ([[Decimal("1.5")], [Decimal("2.125")]], "decimal(4,3)", ["1.500", "2.125"]),
        ([[True], [3]], "string", ["3", "true"]),
    ],
)
def test_columns_take_the_type_that_holds_all_values(spark, database, tmp_path, by, values, kind, shown):
    files = [write(tmp_path, f"f{i}", {"assetId": ["A"] * len(v), "port": v}) for i, v in enumerate(values)]
    report = load(spark, database, {"asset_vulnerability": files}, by=by)
    table = spark.table(f"{database}.vulnerabilities")
    assert report.warnings == [] and dict(table.dtypes)["port"] == kind
    assert sorted(r.port for r in table.select(table.port.cast("string").alias("port")).collect()) == shown


def test_whole_numbers_that_doubles_do_not_hold_are_kept(spark, database, tmp_path):
    files = [write(tmp_path, n, {"assetId": [n], "port": v}) for n, v in (("half", [0.5]), ("big", [2**53 + 1]), ("even", [2**53]))]
    report = load(spark, database, {"asset_vulnerability": files})
    assert dict(spark.table(f"{database}.vulnerabilities").dtypes)["port"] == "decimal(38,1)"
    assert rows(spark, database, "vulnerabilities", "assetId", "port") == [
        ("big", Decimal(2**53 + 1)), ("even", Decimal(2**53)), ("half", Decimal("0.5")),
    ]
    assert ["port" in w and "decimal(38,1)" in w for w in report.warnings] == [True]


@pytest.mark.parametrize(
    "values, kind, shown",
    [
        ([[2**53], [0.1]], "double", ["0.1", "9.007199254740992E15"]),
        ([[2**60], [0.1, 12.345]], "decimal(38,3)", ["0.100", "1152921504606846976.000", "12.345"]),
        ([[-(2**60)], [1e-30]], "string", ["-1152921504606846976", "1.0E-30"]),
        ([[2**60], [float("nan"), float("inf")]], "string", ["1152921504606846976", "Infinity", "NaN"]),
        ([[7], [Decimal("1.25")]], "decimal(21,2)", ["1.25", "7.00"]),
        ([[0.5], [Decimal("1.25")]], "decimal(38,2)", ["0.50", "1.25"]),
        ([[None, 2**60], [0.5]], "decimal(38,1)", ["0.5", "1152921504606846976.0", None]),
    ],
)
def test_types_come_from_the_values_of_all_files(spark, database, tmp_path, values, kind, shown):
    files = [write(tmp_path, f"f{i}", {"assetId": ["A"] * len(v), "port": v}) for i, v in enumerate(values)]
    for order in (files, files[::-1]):
        load(spark, database, {"asset_vulnerability": order})
        table = spark.table(f"{database}.vulnerabilities")
        assert dict(table.dtypes)["port"] == kind
        found = [r.port for r in table.select(table.port.cast("string").alias("port")).collect()]
        assert sorted(found, key=str) == sorted(shown, key=str)


def test_files_without_statistics_are_read(spark, database, tmp_path):
    pq.write_table(pa.table({"assetId": ["a"], "port": [2**53 + 1]}), tmp_path / "bare.parquet", write_statistics=False)
    files = [str(tmp_path / "bare.parquet"), write(tmp_path, "half", {"assetId": ["b"], "port": [0.5]})]
    load(spark, database, {"asset_vulnerability": files})
    assert rows(spark, database, "vulnerabilities", "port") == [(Decimal("0.5"),), (Decimal(2**53 + 1),)]


def test_an_append_that_widens_a_column_keeps_the_rows(spark, database, tmp_path):
    for name, port in (("a", [1]), ("b", [2.5]), ("c", ["x"])):
        load(spark, database, {"vulnerability_remediation": [write(tmp_path, name, {"cveId": [name], "port": port})]}, append=True)
    assert rows(spark, database, "vulnerability_remediation", "cveId", "port") == [("a", "1"), ("b", "2.5"), ("c", "x")]  # as they were written


def test_an_append_never_rounds_stored_values(spark, database, tmp_path):
    for name, port in (("a", [2**53 + 1]), ("b", [2.5])):
        report = load(spark, database, {"vulnerability_remediation": [write(tmp_path, name, {"cveId": [name], "port": port})]}, append=True)
    assert [w for w in report.warnings if "port" in w] == ["vulnerability_remediation.port: bigint is decimal(38,1) now"]
    assert rows(spark, database, "vulnerability_remediation", "cveId", "port") == [("a", Decimal(2**53 + 1)), ("b", Decimal("2.5"))]


def sizes(spark, database, table):
    """Rows of every part of the latest version."""
    return [spark.table(f"{database}.{part}").count() for part in versions.latest(spark, database, table).parts]


def test_an_append_with_a_wider_type_writes_its_own_rows_alone(spark, database, tmp_path):
    def add(name, port):
        path = write(tmp_path, name, {"cveId": [name] * len(port), "port": port})
        return load(spark, database, {"vulnerability_remediation": [path]}, append=True)

    add("a", list(range(1000)))
    add("b", [0.5])
    assert add("c", ["x"]).row_counts == {"vulnerability_remediation": 1002}
    assert sizes(spark, database, "vulnerability_remediation") == [1000, 1, 1]
    found = rows(spark, database, "vulnerability_remediation", "cveId", "port")
    assert found[-3:] == [("a", "999"), ("b", "0.5"), ("c", "x")]
    assert versions.compact(spark, database, "vulnerability_remediation") == 3
    assert sizes(spark, database, "vulnerability_remediation") == [1002]
    assert rows(spark, database, "vulnerability_remediation", "cveId", "port") == found
    assert add("c", ["y"]).row_counts == {"vulnerability_remediation": 1003}


def between(monkeypatch, act):
    """Run ``act`` once, after the next load has written its part and before it commits."""
    write_part, waiting = versions.write_part, [act]

    def wrapped(*args):
        part = write_part(*args)
        if waiting:
            waiting.pop()()
        return part

    monkeypatch.setattr(versions, "write_part", wrapped)


def test_a_snapshot_that_ends_during_an_append_survives(spark, database, tmp_path, monkeypatch):
    name = "vulnerability_remediation"
    old, fresh = (write(tmp_path, n, {"cveId": v}) for n, v in (("old", ["old"]), ("fresh", ["s1", "s2", "s3"])))
    late = write(tmp_path, "late", {"cveId": ["l1", "l2"], "port": [0.5, 1.5]})
    load(spark, database, {name: [old]})
    between(monkeypatch, lambda: load(spark, database, {name: [fresh]}))
    assert load(spark, database, {name: [late]}, append=True).row_counts == {name: 5}
    assert rows(spark, database, name, "cveId") == [("l1",), ("l2",), ("s1",), ("s2",), ("s3",)]


def test_two_appends_at_once_both_stay(spark, database, tmp_path, monkeypatch):
    name = "vulnerability_remediation"
    for i, value in enumerate((1, 0.5, "x")):
        write(tmp_path, str(i), {"cveId": [str(i)], "port": [value]})
    load(spark, database, {name: [str(tmp_path / "0.parquet")]}, append=True)
    between(monkeypatch, lambda: load(spark, database, {name: [str(tmp_path / "1.parquet")]}, append=True))
    load(spark, database, {name: [str(tmp_path / "2.parquet")]}, append=True)
    assert rows(spark, database, name, "cveId", "port") == [("0", "1"), ("1", "0.5"), ("2", "x")]


def test_one_load_twice_at_once_is_there_once(spark, database, tmp_path, monkeypatch):
    name, path = "vulnerability_remediation", write(tmp_path, "r", REMEDIATION)
    between(monkeypatch, lambda: load(spark, database, {name: [path]}, append=True, load_id="same"))
    report = load(spark, database, {name: [path]}, append=True, load_id="same")
    assert report.row_counts == {name: 3} and any("there already" in w for w in report.warnings)
    assert sizes(spark, database, name) == [3]


def test_unique_holds_against_a_load_that_came_first(spark, database, tmp_path, monkeypatch):
    name = "vulnerability_remediation"
    one, two = (write(tmp_path, n, {"cveId": v}) for n, v in (("one", ["a", "b"]), ("two", ["b", "c", "c"])))
    between(monkeypatch, lambda: load(spark, database, {name: [one]}, append=True, unique=["cveId"]))
    load(spark, database, {name: [two]}, append=True, unique=["cveId"])
    assert rows(spark, database, name, "cveId") == [("a",), ("b",), ("c",)]


def test_an_append_during_a_fold_stays(spark, database, tmp_path, monkeypatch):
    name = "vulnerability_remediation"
    files = [write(tmp_path, n, {"cveId": [n]}) for n in "abc"]
    for path in files[:2]:
        load(spark, database, {name: [path]}, append=True)
    between(monkeypatch, lambda: load(spark, database, {name: [files[2]]}, append=True))
    assert versions.compact(spark, database, name) == 2
    assert rows(spark, database, name, "cveId") == [("a",), ("b",), ("c",)] and sizes(spark, database, name) == [2, 1]
    between(monkeypatch, lambda: load(spark, database, {name: [files[0]]}))
    assert versions.compact(spark, database, name) == 0  # a snapshot came first, and stays
    assert rows(spark, database, name, "cveId") == [("a",)]


def test_loads_from_many_threads(spark, database, tmp_path):
    name = "vulnerability_remediation"
    files = [write(tmp_path, f"t{i}", {"cveId": [f"c{i}"] * (i + 1)}) for i in range(6)]
    with ThreadPoolExecutor(6) as pool:
        reports = list(pool.map(lambda path: load(spark, database, {name: [path]}, append=True), files))
    assert all(r.failures == {} for r in reports) and max(r.total for r in reports) == 21
    assert spark.table(f"{database}.{name}").count() == 21
    assert len(versions.latest(spark, database, name).parts) == 6


def test_many_appends_fold_their_newest_parts(spark, database, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "MOST_PARTS", 3)
    name = "vulnerability_remediation"
    load(spark, database, {name: [write(tmp_path, "big", {"cveId": ["big"] * 500})]}, append=True)
    for i in range(8):
        load(spark, database, {name: [write(tmp_path, f"n{i}", {"cveId": [f"n{i}"]})]}, append=True, load_id=f"n{i}")
    parts = sizes(spark, database, name)
    assert parts[0] == 500 and len(parts) <= 4 and sum(parts) == 508
    again = load(spark, database, {name: [write(tmp_path, "n0", {"cveId": ["n0"]})]}, append=True, load_id="n0")
    assert any("there already" in w for w in again.warnings) and again.total == 508


def test_counts_come_from_the_write(spark, database, tmp_path):
    """No job reads the table after it is written, and an empty file warns."""
    path = write(tmp_path, "r", REMEDIATION)
    scans = []
    count = DataFrame.count
    DataFrame.count = lambda self: scans.append(1) or count(self)
    try:
        assert load(spark, database, {"vulnerability_remediation": [path]}).row_counts == {"vulnerability_remediation": 3}
        assert load(spark, database, {"vulnerability_remediation": [path]}, append=True).total == 6
    finally:
        DataFrame.count = count
    assert scans == []
    empty = load(spark, database, {"asset": [write(tmp_path, "none", {"assetId": pa.array([], pa.string())})]})
    assert empty.row_counts == {"assets": 0} and any("0 rows loaded" in w for w in empty.warnings)


def test_unreachable_places_fail_the_load(spark, database, tmp_path):
    load(spark, database, {"asset": [write(tmp_path, "a", ASSETS)]})
    with pytest.raises(Exception, match="nowhere"):
        load(spark, database, {"asset": ["nowhere://bucket/a.parquet", write(tmp_path, "b", ASSETS)]})
    assert spark.table(f"{database}.assets").count() == 4


def test_places_only_spark_reaches_are_read(spark, database, tmp_path):
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("fs.viewfs.mounttable.t.link./in", f"file://{tmp_path}")
    write(tmp_path, "a", ASSETS)
    (tmp_path / "bad.parquet").write_bytes(b"x" * 200)
    report = load(spark, database, {"asset": ["viewfs://t/in/a.parquet", "viewfs://t/in/bad.parquet"]})
    assert report.row_counts == {"assets": 4} and sum("bad.parquet" in w for w in report.warnings) == 1


def test_unreadable_files_are_left_out(spark, database, tmp_path):
    broken = tmp_path / "broken.parquet"
    broken.write_bytes(b"not parquet at all" * 20)
    small = tmp_path / "small.parquet"
    small.write_bytes(b"PAR1")
    files = [str(broken), write(tmp_path, "v", FINDINGS), str(small), str(tmp_path / "absent.parquet")]
    report = load(spark, database, {"asset_vulnerability": files})
    assert report.row_counts == {"vulnerabilities": 5}
    assert sum("not readable" in w for w in report.warnings) == 3
    assert any("small.parquet" in w and "unusually small" in w for w in report.warnings)


def test_snapshot_without_a_readable_file_keeps_the_table(spark, database, tmp_path):
    load(spark, database, {"asset": [write(tmp_path, "a", ASSETS)]})
    broken = tmp_path / "broken.parquet"
    broken.write_bytes(b"x" * 200)
    report = load(spark, database, {"asset": [str(broken)]})
    assert report.row_counts == {}
    assert any("left as it was" in w for w in report.warnings)
    assert any("0 rows loaded" in w for w in report.warnings)
    assert spark.table(f"{database}.assets").count() == 4


def test_a_file_listed_twice_is_loaded_twice(spark, database, tmp_path):
    path = write(tmp_path, "a", ASSETS)
    assert load(spark, database, {"asset": [path, path]}).row_counts == {"assets": 8}


def test_versions_left_by_a_failed_load_are_removed(spark, database, tmp_path):
    path = write(tmp_path, "a", ASSETS)
    load(spark, database, {"asset": [path]})
    spark.range(3).write.saveAsTable(f"{database}.assets__19990101000000_dead")
    load(spark, database, {"asset": [path]})
    assert drop_versions(spark, database, "assets", older_than=timedelta(days=1)) == 1
    assert drop_versions(spark, database, "assets", older_than=timedelta(days=1)) == 0
    tables = [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()]
    assert "assets__19990101000000_dead" not in tables
    assert current_version(spark, database, "assets").split(".")[1] in tables


def test_catalogue(spark, database, tmp_path):
    assert not catalog.has_data(Tables.from_catalog(spark, database))
    load(spark, database, {"asset": [write(tmp_path, "a", ASSETS)], "asset_vulnerability": [write(tmp_path, "v", FINDINGS)]})
    tables = Tables.from_catalog(spark, database)
    assert catalog.has_data(tables) and set(tables) == {"assets", "vulnerabilities"}
    listed = [tuple(r) for r in catalog.schema(spark, tables).where("table_name = 'vulnerabilities'").collect()]
    assert [(i, c, t) for _, i, c, t in listed] == [
        (1, "assetId", "string"), (2, "vulnId", "string"), (3, "severity", "string"), (4, "cvssV3Score", "double"),
        (5, "firstFoundTimestamp", "timestamp_ntz"),
    ]
    catalog.purge(spark, database)
    assert not catalog.has_data(Tables.from_catalog(spark, database))
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 0
    assert load(spark, database, {"asset": [write(tmp_path, "a", ASSETS)]}).row_counts == {"assets": 4}


def test_load_path_sorts_files_by_their_columns(spark, database, tmp_path):
    for name, columns in (("v", FINDINGS), ("a", ASSETS), ("p", POLICIES), ("r", REMEDIATION), ("o", {"other": [1]})):
        write(tmp_path, name, columns)
    (tmp_path / "notes.txt").write_text("not data")
    (tmp_path / "sub").mkdir()
    write(tmp_path / "sub", "deep", ASSETS)
    report = load_path(spark, database, str(tmp_path))
    assert report.row_counts == {"assets": 4, "vulnerabilities": 5, "policies": 6, "vulnerability_remediation": 3}
    assert ["o.parquet" in w for w in report.warnings] == [True]


def test_load_path_basic_knows_findings_and_assets(spark, database, tmp_path):
    write(tmp_path, "v", FINDINGS)
    write(tmp_path, "p", POLICIES)
    report = load_path(spark, database, str(tmp_path), mode="basic")
    assert report.row_counts == {"vulnerabilities": 5, "assets": 6}


def test_load_path_of_one_file(spark, database, tmp_path):
    assert load_path(spark, database, write(tmp_path, "v", FINDINGS)).row_counts == {"vulnerabilities": 5}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_path(spark, database, str(tmp_path / "absent"))


def test_json(spark, tmp_path):
    frame = spark.sql("select 1 as a, cast(null as string) as b, timestamp_ntz'2024-01-02 03:04:05' as c, array(1,2) as d")
    assert catalog.json_rows(frame).first().json == '{"a":1,"b":null,"c":"2024-01-02 03:04:05","d":[1,2]}'
    catalog.write_json(frame, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first().value == catalog.json_rows(frame).first().json


def test_rows_are_clustered_within_files(spark, database, tmp_path):
    mixed = {"assetId": list("ABCDEF"), "severity": ["Severe", "Critical", None, "Moderate", "Critical", "Severe"]}
    load(spark, database, {"asset_vulnerability": [write(tmp_path, "v", mixed)]})
    per_file = spark.table(f"{database}.vulnerabilities").select("severity").collect()
    assert [r.severity for r in per_file] == [None, "Critical", "Critical", "Moderate", "Severe", "Severe"]


def test_paths_with_spaces_and_types_without_a_conversion(spark, database, tmp_path):
    folder = tmp_path / "a folder"
    folder.mkdir()
    first = write(folder, "first file", {"assetId": ["A"], "port": [1]})
    bad = write(folder, "bad file", {"assetId": ["B"], "port": ["z"]})
    nested = write(folder, "nested", {"assetId": ["C"], "port": [[1, 2]]})
    report = load(spark, database, {"asset_vulnerability": [first, bad, f"file://{nested}"]})
    assert rows(spark, database, "vulnerabilities", "assetId", "port") == [("A", "1"), ("B", "z")]
    assert sum("port" in w for w in report.warnings) == 1
    assert load_path(spark, database, first).row_counts == {}  # no column tells its table


def test_column_names_differing_in_case_are_one_column(spark, database, tmp_path):
    load(spark, database, {"asset": [write(tmp_path, "a", ASSETS), write(tmp_path, "b", {"ASSETID": ["Z"], "IP": ["9"]})]})
    assert spark.table(f"{database}.assets").columns == list(ASSETS)
    assert ("Z", "9") in rows(spark, database, "assets", "assetId", "ip")


def torn(tmp_path, name="torn"):
    path = tmp_path / f"{name}.parquet"
    write(tmp_path, name, {"assetId": [f"asset-{i}" for i in range(5000)], "ip": [str(i) for i in range(5000)]})
    content = bytearray(path.read_bytes())
    content[4:4000] = b"\xff" * 3996
    path.write_bytes(content)
    return str(path)


def test_damage_past_the_footer_costs_that_file(spark, database, tmp_path):
    files = {"asset": [write(tmp_path, "a", ASSETS), torn(tmp_path)], "asset_vulnerability": [write(tmp_path, "v", FINDINGS)]}
    report = load(spark, database, files)
    assert report.row_counts == {"assets": 4, "vulnerabilities": 5} and report.failures == {}
    assert ["torn.parquet" in w for w in report.warnings] == [True]
    report = load(spark, database, {"asset": [torn(tmp_path, "alone")]})
    assert report.row_counts == {} and any("left as it was" in w for w in report.warnings)
    assert spark.table(f"{database}.assets").count() == 4


def test_a_table_that_fails_leaves_the_others_and_the_report(spark, database, tmp_path):
    spark.sql(f"CREATE DATABASE {database}")
    spark.sql(f"CREATE TABLE {database}.assets (x INT) USING parquet")  # a view cannot take its name
    files = {"asset": [write(tmp_path, "a", ASSETS)], "asset_vulnerability": [write(tmp_path, "v", FINDINGS)]}
    report = load(spark, database, files)
    assert report.row_counts == {"vulnerabilities": 5} and set(report.failures) == {"assets"}


def test_a_reader_finishes_on_the_rows_it_began_with(spark, database, tmp_path):
    load(spark, database, {"asset": [write(tmp_path, "a", ASSETS)]})
    began = spark.table(f"{database}.assets")
    load(spark, database, {"asset": [write(tmp_path, "b", {"assetId": ["only"]})]})
    assert began.count() == 4 and spark.table(f"{database}.assets").count() == 1


def test_a_load_tried_again_adds_nothing(spark, database, tmp_path):
    files = {"vulnerability_remediation": [write(tmp_path, "r", REMEDIATION)]}
    for name, expected in (("first", 3), ("first", 3), ("second", 6), ("first", 6)):
        assert load(spark, database, files, append=True, load_id=name).total == expected
    assert spark.table(f"{database}.vulnerability_remediation").columns == list(REMEDIATION)


def test_chunks_that_share_rows(spark, database, tmp_path):
    key = ["assetId", "cveId"]
    first = {"assetId": ["a", "b", None], "cveId": ["1", "1", "2"]}
    second = {"assetId": ["b", None, "c", "c"], "cveId": ["1", "2", "3", "3"]}
    for name, columns in (("x", first), ("y", second)):
        load(spark, database, {"vulnerability_remediation": [write(tmp_path, name, columns)]}, append=True, unique=key)
    found = spark.table(f"{database}.vulnerability_remediation").collect()
    assert sorted(map(str, found)) == sorted(map(str, [("a", "1"), ("b", "1"), (None, "2"), ("c", "3")])) or len(found) == 4


def test_agent_results_are_read_from_their_folder_alone(spark, database, tmp_path):
    path = write(tmp_path, "p", POLICIES)
    load(spark, database, {"asset_policy": [path], "asset_scan_policy": [path]})
    chosen = spark.table(f"{database}.policies").where("source = 'agent'")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "source" in plan.split("PartitionFilters")[1].split("]")[0]
    assert chosen.count() == 6


def test_sniffed_files_are_never_read_whole(spark, tmp_path):
    """Files of any size are placed by the tasks that write them; no content passes through the driver or one row."""
    whole = {
        "customer": {"c_custkey": [1, 2, None], "c_name": ["a", None, "c"]},
        "lineitem": {"l_orderkey": [1, 1, None, 4], "l_partkey": [7, 7, 8, None]},
        "orders": {"o_custkey": [1, 1], "o_orderstatus": ["F", None]},
        "part": {"p_partkey": [7], "p_name": ["bolt"]},
        "nation": {"n_nationkey": [0, 1], "n_name": ["X", "Y"]},
    }
    for name, columns in whole.items():
        write(tmp_path, name, columns)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "10")
    try:
        found = loading.sniffed_files(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert sorted((r.kind, r.name, r.n) for r in found) == [
        ("rows", "assets", 3), ("rows", "policies", 2), ("rows", "vulnerabilities", 4), ("rows", "vulnerability_remediation", 1),
        ("warning", "other", 1),
    ]
