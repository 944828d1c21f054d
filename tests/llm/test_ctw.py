from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pytest

from breakwater.llm import ctw, queries

WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def stream(text):
    return " ".join(WORD.findall(lower(text))).encode() + b"\xff"


def plain(docs):
    """The model by its definition: a recursion over nodes, with counts kept in dictionaries."""
    train = [t for i, t in docs if zlib.crc32(str(i).encode() if i is not None else b"") % 7 != 2]
    counts = Counter()

    def decisions(text):
        data = b"\xff" * ctw.DEPTH + stream(text)
        for at in range(ctw.DEPTH, len(data)):
            for bit in range(8):
                yield data[at - ctw.DEPTH : at][::-1], bit, data[at] >> (8 - bit), data[at] >> (7 - bit) & 1

    for text in train:
        for context, bit, prefix, value in decisions(text):
            for depth in range(ctw.DEPTH + 1):
                counts[context[:depth], bit, prefix, value] += 1
    below = {}
    for context, bit, prefix, _ in list(counts):
        if context:
            below.setdefault((context[:-1], bit, prefix), set()).add(context)
    cache = {}

    def own(context, bit, prefix):
        return counts[context, bit, prefix, 0], counts[context, bit, prefix, 1]

    def weighted(context, bit, prefix):
        key = (context, bit, prefix)
        if key not in cache:
            a, b = own(*key)
            kt = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            if len(context) == ctw.DEPTH:
                cache[key] = (kt, 1.0)
            else:
                deeper = sum(weighted(c, bit, prefix)[0] for c in below.get(key, ()))
                top = max(kt, deeper)
                total = top + math.log(math.exp(kt - top) + math.exp(deeper - top)) - math.log(2)
                cache[key] = (total, math.exp(kt - math.log(2) - total))
        return cache[key]

    def one(context, depth, bit, prefix):
        a, b = own(context[:depth], bit, prefix)
        p = (b + 0.5) / (a + b + 1)
        if depth == ctw.DEPTH or sum(own(context[: depth + 1], bit, prefix)) == 0:
            return p
        stop = weighted(context[:depth], bit, prefix)[1]
        return stop * p + (1 - stop) * one(context, depth + 1, bit, prefix)

    words = Counter(w for t in train for w in [*WORD.findall(lower(t)), "\n"])
    n, v = sum(words.values()), len(words)
    for doc_id, text in docs:
        tokens = [*WORD.findall(lower(text)), "\n"]
        score = 0.0
        for context, bit, prefix, value in decisions(text):
            p = one(context, 0, bit, prefix)
            score += math.log10(p if value else 1 - p)
        yield (
            doc_id, zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 7 == 2, len(tokens), sum(words[t] > 0 for t in tokens), n,
            sum(math.log10((words[t] + 1) / (n + v + 1)) for t in tokens), score,
        )


def compare(frame, docs):
    def key(r):
        return (r[0] is None, r[0] or 0, r[2], r[6])

    got, want = sorted(map(tuple, frame.collect()), key=key), sorted(plain(docs), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-5)


TEXTS = [
    (1, "The cat sat on the mat. The cat!"), (2, "a cat  SAT\n\ton the\x0bmat É É É"), (3, None), (4, ""), (None, "the the the"), (5, "\0zero \0"),
    (6, "the cat sat on the mat again and again"), (6, "the cat sat on the mat again and again"), (9, "日本 語 cat"), (16, "the dog sat"),
    (17, "on the mat"), (20, "xylophone quartz"), (33, "word " * 50),
]


def test_equals_the_recursion(spark, tmp_path):
    place = str(tmp_path / "docs")
    spark.createDataFrame([(*t, "b") for t in TEXTS], "doc_id long, text string, block string").repartition(3).write.parquet(place)
    compare(ctw.scores(spark.read.parquet(place)), TEXTS)


def test_bounds_change_nothing(spark, tmp_path):
    place = str(tmp_path / "docs")
    spark.createDataFrame(TEXTS, "doc_id long, text string").coalesce(1).write.parquet(place)
    held = ctw._Held()
    for _, text in TEXTS:
        held.add(text or "")
        held.settle()
    whole = {(k, b): (keys, counts) for k, b, keys, counts in held.rows(3)}
    for _, text in TEXTS:
        held.add(text or "")
    assert whole == {(k, b): (keys, counts) for k, b, keys, counts in held.rows(3)}


@pytest.mark.parametrize("texts", [[], [(4, "held out alone")] if zlib.crc32(b"4") % 7 == 2 else [(3, "only one")], [(3, None)]])
def test_small_tables(spark, tmp_path, texts):
    place = str(tmp_path / "docs")
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(place)
    compare(ctw.scores(spark.read.parquet(place)), texts)


def test_query_beats_the_base_on_held_out_texts(spark):
    rows = queries.op2_ctw_score(spark, "/root/testdata/sf0.1").where("held_out").collect()
    assert len(rows) > 100
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
