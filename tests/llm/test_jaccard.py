from __future__ import annotations

import random
import re

import numpy as np
import pytest

from breakwater.llm import graph, jaccard, queries

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(docs, words, num, den):
    """All pairs, and components by walking."""
    sets = []
    for _, text in docs:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        size = min(words, len(w))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set())
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * den >= max(len(a), len(b)) * num and den * len(a & b) >= num * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(docs[i][0], len(s), least.get(root(i))) for i, s in enumerate(sets)]


def told(frame):
    return sorted(map(str, [(r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()]))


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert told(queries.op10_ngram_join(spark, sf_dir)) == sorted(map(str, plain(docs, 4, 85, 100)))


def corpus(seed):
    """Chains of edits, near-copy groups, texts that are mostly one common passage, short texts."""
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = chance.choices(words, k=60)
    docs = []
    for _ in range(12):
        text = chance.choices(words, k=chance.randrange(20, 120))
        for _ in range(chance.randrange(1, 14)):
            text = list(text)
            for _ in range(chance.randrange(0, 3)):
                text[chance.randrange(len(text))] = chance.choice(words)
            docs.append(" ".join(text))
    docs += [" ".join(common + chance.choices(words, k=chance.randrange(0, 14))) for _ in range(40)]
    docs += [" ".join(chance.choices(words[:6], k=chance.randrange(0, 7))) for _ in range(40)]
    chance.shuffle(docs)
    return [(i // 2 if i % 17 == 0 else i, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed, words, num", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_equals_all_pairs(spark, tmp_path, seed, words, num):
    docs = corpus(seed)
    place = str(tmp_path / "docs")
    spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, size string").repartition(4).write.parquet(place)
    assert told(jaccard.linked(spark.read.parquet(place), words, num, 100)) == sorted(map(str, plain(docs, words, num, 100)))


def test_odd_rows(spark, tmp_path):
    docs = [(1, None), (2, ""), (3, " \n"), (None, "a b c d e f"), (None, "A B C d e f"), (5, "a b c d e f"), (5, "a b c d e f"),
            (6, "x"), (7, "X"), (8, "É é"), (None, "lonely words stand here"), (9, "long " * 30000), (10, "long " * 20000)]
    place = str(tmp_path / "docs")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(place)
    assert told(jaccard.linked(spark.read.parquet(place), 4, 85, 100)) == sorted(map(str, plain(docs, 4, 85, 100)))
    empty = spark.read.parquet(place).limit(0)
    assert jaccard.linked(empty).count() == 0


def test_longer_prefixes_where_candidates_cost(spark):
    import numpy as np

    rare = np.zeros(200)
    assert jaccard.choose(rare, 200, 160) == 1
    busy = np.concatenate([[500.0], np.zeros(199)])
    assert jaccard.choose(busy, 200, 160) == jaccard.MOST_MATCHES


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (103, 101), (200, 200), (300, 7), (7, 300)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in [*range(51), 300]) and found[103] == found[101] == 100 and 200 not in found


def test_query_equals_sql(spark, sf_dir):
    from breakwater.llm import queries
    from tests import oracle

    assert oracle.differences(queries.op10_ngram_join(spark, sf_dir), oracle.connect(sf_dir), jaccard.SQL) is None


def test_a_group_whose_hub_links_with_few(spark, monkeypatch):
    """Near copies of a base that no row holds: most pairs miss the threshold, yet links join them; few hubs suffice."""
    monkeypatch.setattr(jaccard, "HUBS", 3)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(80):
        own = list(base)
        for at in rng.sample(range(120), rng.randrange(1, 4)):
            own[at] = f"x{i}-{at}"
        docs.append((i, " ".join(own)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    sets = {i: {tuple(t.split()[k : k + 4]) for k in range(117)} for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    least = {i: i for i in sets}
    while any(least[a] != least[b] for a, b in links):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert 50 < len(links) < 80 * 79 / 2 * 0.8
    got = {r.doc_id: r.component_id for r in jaccard.linked(frame, words=4, num=85, den=100).collect()}
    assert got == least


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    for size in (0, 1, 50, 3000):
        a = rng.integers(0, 2**63, size).astype(np.uint64)
        b = np.concatenate([a[: size // 2], rng.integers(0, 2**63, size // 3).astype(np.uint64)])
        bits = np.bitwise_count((jaccard._parities(a) ^ jaccard._parities(b)).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(a, b))
