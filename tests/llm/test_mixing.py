from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from breakwater.llm import mixing, queries
from breakwater.llm.mixing import Target


def plain_weights(tokens, x):
    powers = {s: (t / sum(tokens.values())) ** x for s, t in tokens.items()}
    return {s: p / sum(powers.values()) for s, p in powers.items()}


def check(rows, sizes, weights, quotas, block_tokens):
    """``sizes``: tokens of every document by source. Epochs are whole orders, blocks hold weights, positions no gap."""
    drawn = defaultdict(lambda: defaultdict(list))
    for r in rows:
        drawn[r.source][r.epoch].append(r)
    for source, docs in sizes.items():
        total, stream = sum(docs.values()), 0
        for epoch in range(math.ceil(quotas[source] / total)):
            got = drawn[source][epoch]
            assert len({r.doc_id for r in got}) == len(got)
            spent = sum(r.n_tokens for r in got)
            if (epoch + 1) * total <= quotas[source]:
                assert len(got) == len(docs) and spent == total
            else:
                over = epoch * total + spent - quotas[source]
                assert 0 <= over < max(docs.values())
            stream += spent
        by_block = Counter()
        for got in drawn[source].values():
            for r in got:
                by_block[r.block] += r.n_tokens
        share = weights[source] * block_tokens
        assert all(abs(by_block[b] - share) <= max(docs.values()) for b in range(max(by_block)))
    places = defaultdict(list)
    for r in rows:
        places[r.block].append(r.position)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text").collect()
    sizes = defaultdict(dict)
    for d in docs:
        sizes[d.source][d.doc_id] = len(d.text.encode().split()) + 1
    tokens = {s: sum(v.values()) for s, v in sizes.items()}
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        repeats = {s: w / tokens[s] for s, w in plain_weights(tokens, middle).items()}
        low, high = (middle, high) if max(repeats.values()) / min(repeats.values()) > 2 else (low, middle)
    weights = plain_weights(tokens, high)
    budget = max(tokens[s] / weights[s] for s in tokens)
    rows = queries.op5_source_mix(spark, sf_dir).collect()
    check(rows, sizes, weights, {s: math.ceil(weights[s] * budget - 1e-3) for s in tokens}, 1 << 18)
    assert {r.doc_id for r in rows} == {d.doc_id for d in docs}


def frame(spark, counts):
    rows = [(i, s, "word " * (1 + i % 7)) for s, n in counts.items() for i in range(n)]
    return spark.createDataFrame([(k, s, t) for k, (_, s, t) in enumerate(rows)], "doc_id long, source string, text string")


@pytest.mark.parametrize("goal", [0.8, 0.97])
def test_entropy_target_with_budget(spark, tmp_path, goal):
    counts = {"hot": 4000, "b": 700, "c": 200, None: 90}
    frame(spark, counts).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    sizes = defaultdict(dict)
    for d in docs.collect():
        sizes[d.source][d.doc_id] = len(d.text.split()) + 1
    tokens = {s: sum(v.values()) for s, v in sizes.items()}
    sources = spark.createDataFrame([(t, sum(tokens.values())) for t in tokens.values()], "tokens long, whole long")
    x = mixing.exponent(sources, Target(entropy=goal), 20_000)
    weights = plain_weights(tokens, x)
    assert -sum(w * math.log(w) for w in weights.values()) == pytest.approx(goal * math.log(4), abs=1e-6)
    rows = mixing.draws(docs, Target(entropy=goal), 20_000, block_tokens=1000).collect()
    check(rows, sizes, weights, {s: math.ceil(weights[s] * 20_000 - 1e-6) for s in tokens}, 1000)


def test_bounds_of_the_exponent(spark):
    even = spark.createDataFrame([(10, 20), (10, 20)], "tokens long, whole long")
    assert mixing.exponent(even, Target(repetition=1.0)) == 0.0 and mixing.exponent(even, Target(entropy=1.0)) == 1.0
    assert mixing.exponent(even, Target(repetition=1.0), 100.0) == 1.0
    with pytest.raises(ValueError):
        mixing.exponent(even, Target())


def test_mixed_keeps_rows_and_columns(spark, tmp_path):
    rows = [(1, "a", None, 1), (1, "a", None, 1), (None, None, "", 2), (2, "b", "x y", 3)]
    spark.createDataFrame(rows, "doc_id long, source string, text string, block int").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    found = mixing.mixed(docs, Target(repetition=1.0))
    assert found.columns == docs.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, docs.collect()))
    assert mixing.mixed(docs.limit(0), Target(repetition=1.0)).count() == 0
    assert mixing.draws(docs.limit(0), Target(entropy=0.5)).count() == 0


def test_no_budget_draws_nothing(spark):
    docs = spark.createDataFrame([(i, "a b c", f"s{i % 2}") for i in range(6)], "doc_id long, text string, source string")
    assert mixing.draws(docs, mixing.Target(entropy=1.0), budget=0).count() == 0
    assert mixing.mixed(docs, mixing.Target(entropy=1.0), budget=0).columns == docs.columns
