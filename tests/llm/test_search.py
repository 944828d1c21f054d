from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from breakwater.llm import queries, search
from tests import oracle

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, best=10):
    """By definition: every item against every document."""
    own = [(d, terms(t)) for d, t in docs]
    count, total = sum(bool(w) for _, w in own), sum(len(w) for _, w in own)
    by_item = {}
    for item, text in items:
        by_item.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in by_item.items():
        scores = []
        for d, w in own:
            score = 0
            for t in wanted & set(w):
                df, tf = sum(t in x for _, x in own), w.count(t)
                weight = math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1)))
                score += weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * (10 + (90 * len(w) * count) // total)))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:best])]
    return sorted(map(repr, out))


def found(spark, docs, items, **more):
    docs = spark.createDataFrame([(*d, "x", 7) for d in docs], "doc_id long, text string, term string, item int")
    items = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")
    return sorted(repr(tuple(r)) for r in search.ranked(docs, items, **more).collect())


def test_query_equals_sql(spark, sf_dir):
    assert oracle.differences(queries.op11_ranked_search(spark, sf_dir), oracle.connect(sf_dir), search.SQL) is None


@pytest.mark.parametrize("block", [12, 20_000])
def test_equals_brute_force(spark, monkeypatch, block):
    """Many shared terms, ties, repeated rows, nulls; one block of items and many."""
    monkeypatch.setattr(search, "BLOCK_TERMS", block)
    rng = random.Random(block)
    words = ["Ab", "ab", "c9", "Éa", "éa", "zoë", "q", "x1y", "the", "von", "日本", "ß"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "-", "\n", "  ", "_", "\x7f"]) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 30))) for i in range(60)] + [(None, text(9)), (None, None), (99, ""), (98, " .. ")]
    docs += [docs[3], docs[3], (7, docs[8][1])]
    items = [(i, text(rng.randrange(1, 12))) for i in range(8)] + [(3, "ab q"), (None, "zoë"), (50, None), (51, "nowhere"), (52, "")]
    assert found(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a b")], []) == []
    assert found(spark, [(1, None), (2, "--")], [(1, "a")]) == []


def test_very_long_text_is_cut_piece_by_piece(spark, monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(20_000))
    monkeypatch.setattr(search, "PIECE", 100)
    assert [w for part in search.terms_of(text) for w in part] == text.encode().split()
    docs = [(1, text), (2, "w5 other")]
    assert found(spark, docs, [(1, "w5 w6 W7")]) == brute(docs, [(1, "w5 w6 W7")])


@pytest.mark.parametrize("seed", range(5))
def test_graph_adds_up(seed):
    """Every item's part is the sum of its terms, and sharing needs fewer additions than adding alone."""
    rng = random.Random(seed)
    common = [set(rng.sample(range(40), 6)) for _ in range(4)]
    items = [set().union(*rng.sample(common, 2)) | set(rng.sample(range(40, 300), 5)) for _ in range(30)] + [set(), {5}]
    graph = search.shared_sums(items, 300)
    parts = np.zeros(graph.parts, np.int64)
    parts[:300] = rng.sample(range(10**9), 300)
    for made, left, right in graph.levels:
        parts[made] = parts[left] + parts[right]
    for own, top in zip(items, graph.tops):
        assert sum(parts[t] for t in own) == (parts[top] if top >= 0 else 0)
    assert graph.parts - 300 < 0.7 * sum(max(0, len(i) - 1) for i in items)


def test_many_partitions(spark):
    docs = [(i, f"common word{i % 50} tail{i % 7}") for i in range(500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(40)
    items = spark.createDataFrame([(1, "common tail3"), (2, "word9 common")], "item_id long, text string")
    assert sorted(repr(tuple(r)) for r in search.ranked(frame, items).collect()) == brute(docs, [(1, "common tail3"), (2, "word9 common")])
