"""Generated inputs against a few lines of plain Python."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from breakwater.schemas import LEDGER
from breakwater.sources import ledger, manifest, prefixes

few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
day = st.dates(date(2000, 1, 1), date(2030, 1, 1))


@few
@given(st.lists(st.tuples(day, st.integers(1, 900), st.just(None)), min_size=1, max_size=40), st.integers(1, 60))
def test_chunks_cover_a_range_without_gaps(spark, ranges, width):
    rows = [(i, start, start + timedelta(days=length)) for i, (start, length, _) in enumerate(ranges)]
    frame = spark.createDataFrame(rows, "id int, start_date date, end_date date")
    found: dict[int, list] = {}
    for r in manifest.date_chunks(frame, max_days=width).orderBy("id", "chunk_start").collect():
        found.setdefault(r.id, []).append((r.chunk_start, r.chunk_end))
    for i, start, end in rows:
        chunks = found[i]
        assert chunks[0][0] == start and chunks[-1][1] == end
        assert all(a[1] == b[0] for a, b in zip(chunks, chunks[1:]))
        assert all(0 < (b - a).days <= width for a, b in chunks)
        assert all((b - a).days == width for a, b in chunks[:-1])


part = st.sampled_from([*prefixes.PREFIXES, "mystery", "", "Asset", "asset_"])


@few
@given(st.lists(st.builds("/".join, st.lists(part, min_size=1, max_size=3)), min_size=1, max_size=60), st.sets(part))
def test_routing(spark, given_prefixes, skip):
    tables = {p: (t, s) for p, t, s in prefixes.ROUTES}
    frame = spark.createDataFrame([(p,) for p in given_prefixes], "prefix string")
    for r in prefixes.route(frame, skip).collect():
        base = r.prefix.split("/")[0]
        key = base if r.prefix not in tables and base in tables else r.prefix
        assert r.normalised == key
        assert (r.table_name, r.source) == tables.get(key, (None, None))
        skipped = r.prefix in skip or key in skip
        assert r.outcome == ("skip" if skipped else "load" if key in tables else "unknown")


entry = st.tuples(
    st.sampled_from(["e1", "e2", "e3"]), st.sampled_from(["PROCESSING", "COMPLETE", "FAILED"]),
    st.none() | st.integers(0, 10**12), st.none() | st.lists(st.text(max_size=3), max_size=3), st.integers(0, 3),
)


@few
@given(st.lists(entry, min_size=1, max_size=50))
def test_ledger_is_an_upsert_that_keeps_the_first_dates(spark, entries):
    state: dict[str, dict] = {}
    rows = []
    for seq, (export, status, count, urls, hours) in enumerate(entries):
        at = datetime(2024, 1, 1) + timedelta(hours=hours * 13)
        rows.append((seq, export, at.date(), at, status, None, count, urls, None, "policy"))
        kept = state.setdefault(export, {"export_date": at.date(), "created_at": at})
        kept.update(status=status, row_count=count, parquet_urls=urls, file_count=len(urls or []))
    events = spark.createDataFrame(rows, LEDGER).repartition(4)
    got = {r.export_id: r.asDict() for r in ledger.current(ledger.with_file_count(events)).collect()}
    assert set(got) == set(state)
    for export, expected in state.items():
        assert {k: got[export][k] for k in expected} == expected
