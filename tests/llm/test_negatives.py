from __future__ import annotations

import math

import numpy as np
import pytest

from breakwater.llm import negatives, queries
from tests import oracle

SCHEMA = "vec_id long, label int, embedding array<float>, row string, win int, leaf string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def brute(rows, positives=5, negatives_=10, every=100):
    """By definition: every anchor against every row."""
    ok = []
    for vec_id, label, x in rows:
        if label is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            ok.append((vec_id, label, [math.floor(256 * float(np.float32(c))) for c in x]))
    out = []
    for i, (anchor, label, a) in enumerate(ok):
        if anchor is None or anchor % every:
            continue
        scored = [(-sum(p * q for p, q in zip(a, x)), v is None, v or 0, v, own) for j, (v, own, x) in enumerate(ok) if j != i]
        scored.sort(key=lambda s: s[:3])
        for best in [s for s in scored if s[4] == label][:positives]:
            top = -best[0]
            fits = [s for s in scored if s[4] != label and 30 * top <= -100 * s[0] <= 90 * top][:negatives_]
            out += [(anchor, best[3], k + 1, s[3], top, -s[0]) for k, s in enumerate(fits)]
    return out


def sorted_rows(rows):
    return sorted(map(repr, (tuple(r) for r in rows)))


def test_query_equals_sql(spark, sf_dir):
    assert oracle.differences(queries.op12_hard_negatives(spark, sf_dir), oracle.connect(sf_dir), negatives.SQL) is None


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, monkeypatch):
    """Clusters, ties, norms of all kinds; several rounds of anchors and a tree of several levels."""
    monkeypatch.setattr(negatives, "ROUND", 7)
    monkeypatch.setattr(negatives, "LEAF_ROWS", 20)
    monkeypatch.setattr(negatives, "PENDING", 50)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 6))
    rows = []
    for i in range(900):
        x = centres[i % 12] * rng.uniform(0.2, 2) + rng.normal(size=6) * 0.05
        rows.append((i * 10, int(rng.integers(0, 4)), [float(np.float32(c)) for c in (np.round(x, 1) if i % 3 else x)]))
    got = negatives.hard_negatives(frame(spark, rows)).collect()
    assert sorted_rows(got) == sorted_rows(brute(rows))


def test_nulls_repeats_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 3, [float(np.float32(c)) for c in rng.normal(size=4)]) for i in range(200)]
    rows += [(200, None, [1.0] * 4), (300, 1, None), (400, 1, [1.0, None, 1.0, 1.0]), (500, 1, [math.nan] * 4), (600, 1, [math.inf] * 4)]
    rows += [(None, 0, [2.0, 1.0, 0.5, 0.5]), (None, 1, [2.0, 1.0, 0.5, 0.5]), (700, 1, []), (800, 2, [1.0, 2.0]), (900, -3, [1.0] * 4)]
    rows += [rows[0], rows[100], rows[100], rows[7]]
    got = negatives.hard_negatives(frame(spark, rows)).collect()
    assert sorted_rows(got) == sorted_rows(brute(rows))


def test_a_third_are_one_vector(spark):
    rng = np.random.default_rng(9)
    rows = [(i, i % 2, [1.0, 0.5, 0.0] if i % 3 == 0 else [float(np.float32(c)) for c in rng.normal(size=3)]) for i in range(900)]
    got = negatives.hard_negatives(frame(spark, rows)).collect()
    assert sorted_rows(got) == sorted_rows(brute(rows))


def test_empty_and_without_anchors(spark):
    for rows in ([], [(1, 1, [1.0])], [(100, None, [1.0])], [(100, 1, [1.0])]):
        got = negatives.hard_negatives(frame(spark, rows))
        assert got.count() == 0
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_too_long_vectors_are_refused(spark):
    with pytest.raises(ValueError, match="exact"):
        negatives.hard_negatives(frame(spark, [(100, 1, [1e30])]))


def test_ranges_rule_leaves_out():
    """Far clusters are never compared: their ranges do not meet the annulus."""
    rng = np.random.default_rng(1)
    rows = np.floor(np.concatenate([rng.normal(size=(200, 8)) * 5 + 2000 * np.eye(8)[k] for k in range(8)]))
    tree = negatives.Tree(rows, float((rows * rows).sum(axis=1).max()), 0.05)
    tree.low, tree.high = tree.ranges()
    leaves = tree.place(rows, tree.low, tree.high)
    anchors, owner = rows[:1], np.array([0])
    walk = negatives.Walk(tree, anchors, owner)
    scores = rows @ anchors[0]
    lo, hi = np.array([np.sort(scores)[-50]]), np.array([np.inf])
    met = {leaf for leaf in range(len(tree.paths)) if len(walk.open(leaf, *walk.annulus(lo, hi)))}
    assert {int(x) for x in leaves[scores >= lo[0]]} <= met
    assert len(met) < len(tree.paths) / 2
