from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from breakwater.llm import deepshallow, queries, repeats
from tests import oracle


def brute(docs, length):
    """By definition: every string of every text counted."""
    data = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(raw[s : s + length] for _, raw in data for s in range(len(raw) - length + 1))
    out = []
    for d, raw in data:
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if seen[raw[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(raw)))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((d, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def found(spark, docs, length):
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, row int, key string")
    return sorted(repr(tuple(r)) for r in repeats.digests(frame, length).collect())


def noise(rng, n):
    return "".join(rng.choice("abcdefgh é日") for _ in range(n))


def test_query_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(repr((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in queries.op13_suffix_dedup(spark, sf_dir).collect())
    assert got == brute(docs, 400)


def test_query_equals_sql(spark, sf_dir):
    assert oracle.differences(queries.op13_suffix_dedup(spark, sf_dir), oracle.connect(sf_dir), repeats.SQL) is None


def made_texts(rng):
    """Passages in many surroundings, near copies, copies, overlaps, repeats inside a text, periods."""
    passages = [noise(rng, n) for n in (47, 60, 90, 200, 400)]
    docs = []
    for _ in range(40):
        docs.append("".join(noise(rng, rng.randrange(0, 60)) + rng.choice(passages)[rng.randrange(0, 20) :] for _ in range(rng.randrange(0, 5))))
    base = noise(rng, 700)
    for _ in range(25):
        at = rng.randrange(0, 700)
        docs.append(base[:at] + noise(rng, rng.randrange(0, 3)) + base[at + rng.randrange(0, 3) :])
    docs += [base, base, "a" * 500, "a" * 130, "xyz" * 90, noise(rng, 300) * 2, "b" * 59, "b" * 60, "b" * 61, "", None]
    return list(enumerate(docs))


@pytest.mark.parametrize("seed, most", [(0, 1024), (1, 3), (2, 2), (3, 1024)])
def test_equals_brute_force(spark, monkeypatch, seed, most):
    """With groups split at a few contexts and never."""
    monkeypatch.setattr(repeats, "MOST", most)
    docs = made_texts(random.Random(seed))
    assert found(spark, docs, 60) == brute(docs, 60)


def test_chunks_of_a_very_long_text(spark, monkeypatch):
    rng = random.Random(4)
    whole = noise(rng, 3000)
    docs = [(1, whole + noise(rng, 500) + whole[100:2500]), (2, whole[:900]), (3, noise(rng, 2000))]
    want = brute(docs, 60)
    assert found(spark, docs, 60) == want
    monkeypatch.setattr(repeats, "CHUNK", 200)
    raw = np.frombuffer(whole.encode(), np.uint8)
    assert len(repeats.anchors(raw, 60)[0]) > 20
    survey = repeats._surveyed(60)
    import pyarrow as pa

    rows = pa.concat_tables(pa.Table.from_batches([b]) for b in survey([pa.RecordBatch.from_pydict({"row": [1], "text": [docs[0][1]]})])).to_pylist()
    assert {s for r in rows for s in range(r["first"], r["last"] + 1)} == set(range(len(docs[0][1].encode()) - 59))


def test_nulls_and_empty(spark):
    assert found(spark, [], 60) == []
    docs = [(None, "z" * 70), (None, None), (5, ""), (5, "z" * 70)]
    assert found(spark, docs, 60) == brute(docs, 60)
    with pytest.raises(ValueError):
        found(spark, docs, 10)


def test_rows_in_another_order_are_noticed(spark):
    """Dealt anew at every read, rows may come back as others: it raises, or is right."""
    rng = random.Random(8)
    passage = noise(rng, 90)
    docs = [(i, noise(rng, 40) + passage + noise(rng, 40)) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    try:
        got = sorted(repr(tuple(r)) for r in repeats.digests(frame, 60).collect())
    except Exception as error:
        assert "store the documents first" in str(error)
    else:
        assert got == brute(docs, 60)


def test_a_third_hold_one_passage(spark, monkeypatch):
    """A run with a context for each document is split by offsets; copies never meet."""
    monkeypatch.setattr(repeats, "MOST", 16)
    rng = random.Random(6)
    passage = noise(rng, 150)
    docs = [(i, noise(rng, 30) + (passage if i % 3 == 0 else noise(rng, 150)) + noise(rng, 30)) for i in range(240)]
    docs += [(i, docs[1][1]) for i in range(1000, 1100)]
    assert found(spark, docs, 60) == brute(docs, 60)


@pytest.mark.parametrize("seed", range(6))
def test_deep_shallow_sorts(seed):
    rng = random.Random(seed)
    stem = bytes(rng.randrange(3) for _ in range(90))
    strings = [stem[: rng.randrange(91)] + bytes(rng.randrange(3) for _ in range(rng.randrange(12))) for _ in range(300)] + [b"", b"", stem]
    order = deepshallow.deep_shallow(strings)
    assert [s for s, _ in order] == sorted(set(strings))
    for (a, _), (b, lcp) in zip(order, order[1:]):
        assert lcp == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
