from __future__ import annotations

import hashlib

import pytest

from breakwater.llm import fingerprints as fp
from breakwater.llm import queries
from breakwater.llm.words import WordNumbers


def of(text):
    return fp.fingerprint(text, WordNumbers())


def plain(rows):
    """``doc_id, text`` in the order of the operator, each with the text that follows."""
    found = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        found.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), of(text).text(), of(changed).text(), of(text).likeness(of(following))))
    return found


def told(frame):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_next) for r in frame.collect()]


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    frame = queries.op6_fingerprint(spark, sf_dir)
    assert sorted(told(frame)) == sorted(plain(sorted(map(tuple, docs), reverse=True)))
    rows = frame.collect()
    long = [r for r in rows if r.n_chars > 1500]
    assert sum(r.near_edited for r in long) / len(long) > 0.35
    assert sum(r.near_next for r in long) / len(long) < 0.15


def test_insert_delete_and_order():
    a, b, c = "one two three", "four five six seven", "eight\x0bnine"
    assert of("\n".join([a, b, c])) == of("\n".join([c, a, b])) == of(a) + of(b) + of(c)
    assert of("\n".join([a, b, c])) - of(b) == of("\n".join([a, c]))
    assert of("a\na") != of("a") and of("") != of("\n")
    assert fp.Fingerprint.parse(of(a).text()) == of(a)
    assert of("").likeness(of("")) == 1.0 and of("").likeness(of("x y")) == 0.0


def test_likeness_tells_shares():
    base = [f"w{i} v{i} u{i}" for i in range(300)]
    for kept in (60, 150, 270):
        other = base[:kept] + [f"n{i} m{i} o{i}" for i in range(300 - kept)]
        assert of("\n".join(base)).likeness(of("\n".join(other))) == pytest.approx(kept / 300, abs=0.2)


def test_long_text_wraps_and_stays_equal():
    text = "ha " * 700_000
    assert of(text).likeness(of(text)) == 1.0
    assert fp.Fingerprint.parse(of(text).text()) == of(text)


@pytest.mark.parametrize("rows", [
    [], [(1, "only one")], [(2, "ab"), (2, "ab"), (2, "ab"), (1, None), (None, "é日😀x"), (None, ""), (3, "x\ny z")],
    [(i % 3, f"text {i % 7}") for i in range(60)],
])
def test_ties_nulls_and_small_tables(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, h string").repartition(3)
    order = docs.selectExpr("doc_id", "coalesce(text, '') as text").selectExpr("*", "xxhash64(text) as x").collect()
    order.sort(key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.x))
    assert sorted(map(str, told(fp.followed(docs)))) == sorted(map(str, plain([(r.doc_id, r.text) for r in order])))


def test_general_interface(spark):
    docs = spark.createDataFrame([("a\nb",), ("b\na",), (None,)], "text string")
    found = [r.fingerprint for r in fp.added(docs).collect()]
    assert found[0] == found[1] == of("a\nb").text() and found[2] == of("").text()


def test_very_long_repeats_do_not_wrap():
    numbers = WordNumbers()
    whole, half = (fp.fingerprint("a " * n, numbers) for n in (600_002, 300_002))
    assert abs(whole.likeness(half) - 0.5) < 0.01
    assert fp.Fingerprint.parse(whole.text()) == whole
