from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest

from breakwater import Tables
from breakwater.sources import ledger as rules
from breakwater.sources import manifest, versions
from breakwater.sources.exports import load_export
from breakwater.sources.ledger import ExportLedger
from tests.fixtures import ASSETS, FINDINGS, POLICIES, REMEDIATION, write


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def ledger(spark, database):
    return ExportLedger(spark, f"{database}.exports")


def test_round_trip(ledger):
    ledger.save("e-1", "COMPLETE", ["u1", "u2"], ["f1"], row_count=1000)
    saved = ledger.get("e-1").first()
    assert (saved.status, saved.file_count, saved.row_count) == ("COMPLETE", 2, 1000)
    assert (saved.parquet_urls, saved.local_files, saved.export_type) == (["u1", "u2"], ["f1"], "vulnerability")
    assert ledger.get("absent").isEmpty()


def test_update_keeps_the_first_dates(ledger):
    ledger.save("e-1", "PROCESSING", None, ["f"], at=datetime(2024, 1, 1, 8))
    ledger.save("e-1", "COMPLETE", ["u"], row_count=2000, at=datetime(2024, 1, 2, 9))
    (saved,) = ledger.exports().collect()
    assert (saved.export_date, saved.created_at) == (date(2024, 1, 1), datetime(2024, 1, 1, 8))
    assert (saved.status, saved.file_count, saved.row_count, saved.local_files) == ("COMPLETE", 1, 2000, None)


def test_same_instant_keeps_arrival_order(ledger):
    at = datetime(2024, 1, 1)
    for status in ("PROCESSING", "FAILED", "COMPLETE"):
        ledger.save("e-1", status, [], at=at)
    assert ledger.get("e-1").first().status == "COMPLETE"


def test_today(ledger):
    day = date(2024, 5, 1)
    ledger.save("old", "COMPLETE", [], at=datetime(2024, 4, 30, 23))
    ledger.save("a", "COMPLETE", [], at=datetime(2024, 5, 1, 8))
    ledger.save("b", "COMPLETE", [], at=datetime(2024, 5, 1, 9))
    ledger.save("c", "SUCCEEDED", [], at=datetime(2024, 5, 1, 10))
    ledger.save("p", "COMPLETE", [], export_type="policy", at=datetime(2024, 5, 1, 11))
    assert ledger.today(day=day).first().export_id == "b"
    assert ledger.today("policy", day).first().export_id == "p"
    assert ledger.today("remediation", day).isEmpty()


def test_reuse(spark, ledger):
    for kind in ("vulnerability", "remediation"):
        ledger.save(kind, "COMPLETE", [], export_type=kind, at=datetime(2024, 5, 1, 8))
    asked = spark.createDataFrame(
        [(date(2024, 5, 1), k) for k in ("vulnerability", "remediation", "policy")], "export_date date, export_type string"
    )
    answers = {r.export_type: (r.reused_export_id, r.reuse) for r in rules.reuse_decision(asked, ledger.exports()).collect()}
    assert answers == {"vulnerability": ("vulnerability", True), "remediation": (None, False), "policy": (None, False)}


def test_recent(ledger):
    for i in range(5):
        ledger.save(f"e-{i}", "COMPLETE", [], export_type="policy" if i % 2 else "vulnerability", at=datetime(2024, 1, 1 + i))
    assert [r.export_id for r in ledger.recent(3).collect()] == ["e-4", "e-3", "e-2"]
    assert [r.export_id for r in ledger.recent(export_type="policy").collect()] == ["e-3", "e-1"]


def test_staleness_and_purge(ledger):
    ledger.save("v", "COMPLETE", [], at=datetime(2024, 1, 9))
    ledger.save("p", "COMPLETE", [], export_type="policy", at=datetime(2024, 1, 7))
    stale = {r.export_type: r.stale for r in rules.staleness(ledger.exports(), "2024-01-10").collect()}
    assert stale == {"vulnerability": False, "policy": True}
    ledger.purge()
    assert ledger.exports().isEmpty()


MANIFEST = "id string, status string, result array<struct<prefix string, urls array<string>>>"


def test_manifest_lists_every_url_with_its_last_prefix(spark):
    frame = spark.createDataFrame(
        [("e", "COMPLETE", [("asset", ["a"]), ("asset_policy", ["p1", "p2", "a"]), ("asset_scan_policy", ["s"])]),
         ("none", "COMPLETE", None), ("empty", "COMPLETE", [])],
        MANIFEST,
    )
    flat = manifest.flatten(frame).orderBy("item", "position").collect()
    assert [(r.id, r.url, r.prefix, r.copies) for r in flat] == [
        ("e", "a", "asset_policy", 2), ("e", "p1", "asset_policy", 1), ("e", "p2", "asset_policy", 1),
        ("e", "s", "asset_scan_policy", 1),
    ]


def by_loop(start: date, end: date, days: int) -> list[tuple[date, date]]:
    chunks, at = [], start.toordinal()
    while at < end.toordinal():
        until = min(at + days, end.toordinal())
        chunks.append((date.fromordinal(at), date.fromordinal(until)))
        at = until
    return chunks


@pytest.mark.parametrize("end", ["2024-01-02", "2024-02-01", "2024-02-02", "2024-03-31", "2025-12-31"])
def test_date_chunks(spark, end):
    ranges = spark.createDataFrame([("2024-01-01", end)], "start_date string, end_date string")
    got = [(r.chunk_start, r.chunk_end) for r in manifest.date_chunks(ranges).orderBy("chunk_start").collect()]
    assert got == by_loop(date(2024, 1, 1), date.fromisoformat(end), 31)


@pytest.mark.parametrize("end", ["2024-01-01", "2023-12-31"])
def test_a_range_must_start_before_it_ends(spark, end):
    ranges = spark.createDataFrame([("2024-01-01", end)], "start_date string, end_date string")
    with pytest.raises(Exception, match="must be before"):
        manifest.date_chunks(ranges).collect()


def test_exports_from_manifest_to_tables(spark, database, ledger, tmp_path):
    place = {
        "u/a": write(tmp_path, "a", ASSETS), "u/v": write(tmp_path, "v", FINDINGS),
        "u/p": write(tmp_path, "p", POLICIES), "u/r": write(tmp_path, "r", REMEDIATION),
    }

    def export(name, *items, status="COMPLETE"):
        return spark.createDataFrame([(name, status, list(items))], MANIFEST)

    first = export("v-1", ("asset", ["u/a"]), ("asset_vulnerability", ["u/v"]))
    report = load_export(spark, database, ledger, first, "vulnerability", place.__getitem__)
    assert report.row_counts == {"assets": 4, "vulnerabilities": 5}
    policy = export("p-1", ("asset", ["u/a"]), ("asset_policy", ["u/p"]), status="SUCCEEDED")
    assert load_export(spark, database, ledger, policy, "policy", place.__getitem__).row_counts == {"policies": 6}
    history = export("r-1", ("vulnerability_remediation/daily", ["u/r"]))
    for _ in range(2):  # as after a lost ledger row: the rows know their export, so they are not doubled
        report = load_export(spark, database, ledger, history, "remediation", place.__getitem__)
        assert report.row_counts == {"vulnerability_remediation": 3}
    again = load_export(spark, database, ledger, history, "remediation", place.__getitem__, once=True)
    assert again.row_counts == {} and again.warnings == ["export r-1 is loaded already"]
    assert {t: f.count() for t, f in Tables.from_catalog(spark, database).items()} == {
        "assets": 4, "vulnerabilities": 5, "policies": 6, "vulnerability_remediation": 3,
    }
    saved = {r.export_id: (r.status, r.row_count, r.export_type) for r in ledger.exports().collect()}
    assert saved == {
        "v-1": ("COMPLETE", 9, "vulnerability"), "p-1": ("COMPLETE", 6, "policy"), "r-1": ("COMPLETE", 3, "remediation"),
    }
    with pytest.raises(ValueError, match="not complete"):
        load_export(spark, database, ledger, export("x", ("asset", ["u/a"]), status="PROCESSING"))
    with pytest.raises(ValueError, match="no files"):
        load_export(spark, database, ledger, export("x"))
    with pytest.raises(ValueError, match="export_type"):
        load_export(spark, database, ledger, first, "other")


def test_compacting_changes_no_row(spark, ledger):
    for i in range(4):
        ledger.save(f"e{i % 3}", "COMPLETE", ["u"], row_count=i)
    before = sorted(map(str, ledger.events().collect()))
    ledger.compact()
    assert sorted(map(str, ledger.events().collect())) == before
    numbers = [r.seq for r in ledger.events().collect()]
    ledger.save("later", "FAILED", None)
    assert ledger.exports().count() == 4 and ledger.events().agg({"seq": "max"}).first()[0] > max(numbers)


def test_interleaved_saves_get_numbers_of_their_own(spark, ledger, monkeypatch):
    write_part, waiting = versions.write_part, [lambda: ledger.save("other", "FAILED", None)]

    def wrapped(*args):
        part = write_part(*args)
        if waiting:
            waiting.pop()()
        return part

    monkeypatch.setattr(versions, "write_part", wrapped)
    ledger.save("mine", "COMPLETE", ["u"])
    found = {r.export_id: r.seq for r in ledger.events().collect()}
    assert set(found) == {"mine", "other"} and found["mine"] > found["other"]


def test_many_writers_and_a_fold(spark, ledger, monkeypatch):
    monkeypatch.setattr(versions, "MOST_PARTS", 4)
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda i: ledger.save(f"e{i % 4}", "COMPLETE", [f"u{i}"]), range(9)))
    rows = ledger.events().collect()
    assert len(rows) == 9 and len({r.seq for r in rows}) == 9
    assert ledger.exports().count() == 4
    ledger.purge()
    assert ledger.exports().isEmpty()


def test_two_ledgers_of_one_table_are_one(spark, ledger):
    ledger.save("a", "COMPLETE", [])
    again = ExportLedger(spark, ledger.table)
    again.save("b", "COMPLETE", [])
    assert ledger.exports().count() == 2
