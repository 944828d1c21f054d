from __future__ import annotations

import random

import numpy as np
import pytest

from breakwater.llm import passages, queries
from breakwater.llm.words import WordNumbers


def prose(chance, n):
    return [f"w{chance.randrange(10**6)}" for _ in range(n)]


def corpus(seed=5):
    """Documents of which some share passages of 51 to 90 words, exact or with one word changed, in odd places."""
    chance = random.Random(seed)
    shared = [prose(chance, chance.randrange(51, 91)) for _ in range(12)]
    common = prose(chance, 10)
    docs, holders = [], {}
    for i in range(200):
        text = prose(chance, chance.randrange(40, 200))
        if i % 3 == 0:
            text += common + prose(chance, 40)
        if i % 4 == 0:
            p = chance.randrange(len(shared))
            passage = list(shared[p])
            cut = chance.randrange(len(text))
            text = text[:cut] + passage + text[cut:]
            holders.setdefault(p, []).append(i)
        docs.append((i, " ".join(w if chance.random() < 0.9 else w + "\n é" for w in text)))
    return docs, holders


def saved(spark, tmp_path, rows, schema="doc_id long, text string"):
    place = str(tmp_path / "docs")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(place)
    return spark.read.parquet(place)


def test_shared_passages_are_found_and_clean_documents_left_alone(spark, tmp_path):
    chance = random.Random(1)
    shared = [prose(chance, 51 + 3 * k) for k in range(12)]
    docs = []
    for k, passage in enumerate(shared):
        for copy in range(1 + k % 4 + 1):
            before, after = prose(chance, chance.randrange(0, 60)), prose(chance, chance.randrange(0, 60))
            docs.append((100 * k + copy, " ".join(before + passage + after)))
    clean = [(5000 + i, " ".join(prose(chance, 150) + ["one", "common", "line", "of", "eight", "words", "it", "is"] + prose(chance, 50))) for i in range(60)]
    found = passages.passages(saved(spark, tmp_path, docs + clean)).collect()
    assert {r.doc_id for r in found} == {d for d, _ in docs}
    texts = dict(docs)
    by_class = {}
    for r in found:
        inside = texts[r.doc_id][r.start : r.end]
        # A paragraph counts as repeated from a similarity of 0.8 on, so an end may reach over by three words.
        assert " ".join(inside.split()[3:-3]) in " ".join(shared[r.doc_id // 100]) and len(inside.split()) >= passages.PARAGRAPH
        assert r.doc_id // 100 == r.class_id // 100 and r.removed == (r.doc_id != r.class_id)
        by_class.setdefault(r.class_id, set()).add(r.doc_id)
    for k in range(12):
        members = {d for d, _ in docs if d // 100 == k}
        assert any(got == members for got in by_class.values())


def test_equal_to_brute_force(spark, tmp_path):
    """Every pair of paragraphs of one key that is similar ends in one class, against all pairs in plain Python."""
    docs, _ = corpus()
    numbers, units = WordNumbers(), []
    for i, text in docs:
        own = passages.Paragraphs(text, numbers)
        units += [(i, int(own.keys[k]), int(own.begins[k]), int(own.ends[k]), frozenset(np.frombuffer(own.set_of(k), np.uint64).tolist())) for k in range(len(own.at))]
    repeated = set()
    for x in units:
        for y in units:
            if x[0] != y[0] and x[1] == y[1] and 100 * len(x[4] & y[4]) >= 80 * len(x[4] | y[4]):
                repeated.add((x[0], x[2], x[3]))
    found = saved(spark, tmp_path, docs)
    ids = {r.row: r.doc_id for r in found.selectExpr("monotonically_increasing_id() as row", "doc_id").collect()}
    assert {(ids[r.row], r.begin, r.end) for r in passages.repeats(found).collect()} == repeated and repeated


def test_near_copies_meet(spark, tmp_path):
    chance = random.Random(9)
    base = prose(chance, 90)
    other = list(base)
    other[45] = "changed"
    docs = [(1, " ".join(prose(chance, 30) + base)), (2, " ".join(other + prose(chance, 30))), (3, " ".join(prose(chance, 200)))]
    assert {r.doc_id for r in passages.passages(saved(spark, tmp_path, docs)).collect()} == {1, 2}


def test_cut_out(spark, tmp_path):
    chance = random.Random(4)
    passage = " ".join(prose(chance, 80))
    rows = [(1, "start " + passage + " end", 1), (1, "start " + passage + " end", 1), (None, None, None), (2, "", 0), (3, "short é", 7)]
    docs = saved(spark, tmp_path, rows, "doc_id long, text string, n_chars long").coalesce(1)
    out = passages.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == 5
    texts = sorted((r.text or "" for r in out.collect() if r.doc_id == 1), key=len)
    assert len(texts[0]) < len(texts[1]) - 300 and texts[1] == rows[0][1]
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect() if r.doc_id == 1)
    empty = docs.limit(0)
    assert passages.passages(empty).count() == 0 and passages.without_repeats(empty).count() == 0


def test_anchors_are_local():
    chance = np.random.default_rng(2)
    hashes = chance.integers(0, 2**63, 500).astype(np.uint64)
    for begin in range(0, 400, 7):
        inside = set((passages.anchors(hashes)).tolist())
        part = hashes[begin : begin + passages.REACH + passages._SPAN - 1]
        assert any(begin <= a and a + passages._SPAN <= begin + len(part) for a in inside)


@pytest.mark.parametrize("text", ["", "a " * 29, "é " * 31, "same " * 5000])
def test_odd_texts(text):
    own = passages.Paragraphs(text, WordNumbers())
    points = [text[b:e] for b, e in zip(own.begins, own.ends)]
    assert all(len(p.split()) == passages.PARAGRAPH and p == p.strip() for p in points)


def test_query(spark, sf_dir):
    rows = queries.op4_passage_dedup(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in rows:
        if r.removed:
            assert r.doc_id != r.class_id
        assert len(texts[r.doc_id][r.start : r.end].split()) >= passages.PARAGRAPH


def test_a_phrase_said_on_and_on_is_one_row(spark, tmp_path):
    own = passages.Paragraphs("la " * 5000 + "end", WordNumbers())
    assert len(own.at) > 1000 and len(passages._joined(own)[0]) < 100
    docs = saved(spark, tmp_path, [(1, "la " * 300), (2, "x " + "la " * 200 + "y"), (3, "lo " * 300)])
    found = {(r.doc_id, r.start, r.end) for r in passages.passages(docs).collect()}
    assert {d for d, _, _ in found} == {1, 2} and any(e - s > 500 for _, s, e in found)


def test_every_keeper_of_a_text_is_named(spark, tmp_path):
    said = prose(random.Random(6), 130)
    place = str(tmp_path / "docs")
    texts = [" ".join(said[:80]), " ".join(said[50:]), " ".join(said)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(place)
    docs = spark.read.parquet(place)
    found = [r for r in passages.passages(docs).collect() if r.doc_id == 2]
    assert {(r.class_id, r.removed) for r in found} == {(0, True), (1, True)}
    gone = {i for r in found for i in range(r.start, r.end)}
    left = "".join(c for i, c in enumerate(texts[2]) if i not in gone)
    assert {r.doc_id: r.text for r in passages.without_repeats(docs).collect()}[2] == left


def variants(chance):
    """Four texts of one key: A, B and C unlike each other, D like C but for its last word."""
    while True:
        head = prose(chance, 9)
        texts = [" ".join(head + prose(chance, 21)) for _ in range(3)]
        texts.append(texts[2].rsplit(" ", 1)[0] + " other")
        keys = [passages.Paragraphs(text, WordNumbers()).keys.tolist() for text in texts]
        if keys[0] and all(k == keys[0] for k in keys):
            return texts


def test_similar_paragraphs_meet_beside_the_leaders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(passages, "SPLIT", 2)  # driver side: rows of one token fill several blocks
    a, b, c, d = variants(random.Random(8))
    docs = [(i, text) for i, text in enumerate([a] * 3 + [b] * 3 + [c, d])]
    found = {(r.doc_id, r.removed) for r in passages.passages(saved(spark, tmp_path, docs)).collect() if r.doc_id > 5}
    assert len(found) == 2 and {removed for _, removed in found} == {True, False}


def plain_anchors(hashes):
    """The last least place of every window, window by window."""
    reach, found = min(passages.REACH, len(hashes)), set()
    for begin in range(len(hashes) - reach + 1) if len(hashes) >= passages._SPAN else ():
        window = hashes[begin : begin + reach].tolist()
        found.add(begin + max(k for k, h in enumerate(window) if h == min(window)))
    return sorted(a for a in found if a + passages._SPAN <= len(hashes))


def test_anchors_equal_the_definition():
    chance = np.random.default_rng(4)
    for size in [*range(0, 60), 300]:
        for top in (2, 9, 2**63):
            hashes = chance.integers(0, top, size).astype(np.uint64)
            assert passages.anchors(hashes).tolist() == plain_anchors(hashes)


def test_sets_are_cut_without_places(monkeypatch):
    """The second reading of the texts asks for sets alone; places and digests of the other paragraphs cost nothing."""
    text = " ".join(prose(random.Random(2), 300))
    own = passages.Paragraphs(text, WordNumbers())
    wanted = passages.Paragraphs(text, WordNumbers()).digests[::3]
    monkeypatch.setattr(passages, "_word_places", None)
    assert own.digests_of(np.arange(0, len(own.at), 3)).tolist() == wanted.tolist() and len(own.set_of(0)) == 8 * passages._SPAN
    assert "digests" not in own.__dict__


def edited(chance, words, changes):
    """``words`` with changes spread evenly: one put in place of another, put in, or left out."""
    out, kind = list(words), chance.randrange(3)
    for k in range(changes, 0, -1):
        at = k * len(words) // (changes + 1)
        out[at : at + (kind != 1)] = [] if kind == 2 else [f"new{chance.randrange(10**6)}"]
    return out


def near_pairs(docs):
    """Pairs of documents with runs of 51 words whose shingles have a similarity of 0.8, every run of one with every run of the other."""
    size = passages.LEAST - passages.SHINGLE + 1
    cut = [[tuple(words[k : k + passages.SHINGLE]) for k in range(len(words) - passages.SHINGLE + 1)] for words in docs]
    found = set()
    for a in range(len(cut)):
        for b in range(a):
            if len(set(cut[a]) & set(cut[b])) < passages._SHARED:
                continue
            runs = [[frozenset(own[k : k + size]) for k in range(len(own) - size + 1)] for own in (cut[a], cut[b])]
            if any(100 * len(x & y) >= 80 * len(x | y) for x in runs[0] for y in runs[1]):
                found.add((b, a))
    return found


def test_near_passages_are_linked_against_all_pairs(spark, tmp_path):
    """No condition on keys: every two documents with near passages of 51 to 100 words anywhere are in one class."""
    chance, docs = random.Random(12), []
    for k in range(60):
        size, changes = [(51, 1), (51, 1), (60, 1), (70, 1), (100, 2), (100, 3)][k % 6]
        said = prose(chance, size)
        for words in (said, edited(chance, said, changes)):
            docs.append(prose(chance, 40) + words + prose(chance, 40))
    wanted = near_pairs(docs)
    assert len(wanted) > 45
    classes = {}
    for r in passages.passages(saved(spark, tmp_path, [(i, " ".join(words)) for i, words in enumerate(docs)])).collect():
        classes.setdefault(r.class_id, set()).add(r.doc_id)
    lost = [pair for pair in sorted(wanted) if not any(set(pair) <= members for members in classes.values())]
    assert lost == []
    assert all(members in ({2 * k, 2 * k + 1} for k in range(60)) for members in classes.values())


def test_near_passages_end_where_they_stop_being_alike(spark, tmp_path):
    chance = random.Random(3)
    said = prose(chance, 51)
    other = [*said[:25], "é" * 9, *said[26:]]
    texts = ["é  " + " ".join(prose(chance, 30) + words + prose(chance, 30)).replace(" ", "\n ") for words in (said, other)]
    found = passages.passages(saved(spark, tmp_path, list(enumerate(texts)))).collect()
    assert len(found) == 2 and sum(r.removed for r in found) == 1 and len({r.class_id for r in found}) == 1
    assert {" ".join(texts[r.doc_id][r.start : r.end].split()) for r in found} == {" ".join(said), " ".join(other)}


def test_near_passages_beside_the_leaders(spark, tmp_path, monkeypatch):
    """Two variants that are unlike both leaders of their seed's key meet, in one task and in blocks."""
    chance = random.Random(7)
    seed = prose(chance, 24)
    heads = [prose(chance, 60) for _ in range(3)]
    ends = [prose(chance, 60) for _ in range(3)]
    c = [*heads[2], *seed, *ends[2]]
    texts = [[*heads[0], *seed, *ends[0]]] * 3 + [[*heads[1], *seed, *ends[1]]] * 3
    texts += [c[:59] + ["one"] + c[60:85] + ["two"] + c[86:], c]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    for split, place in ((passages.SPLIT, "whole"), (2, "blocks")):
        monkeypatch.setattr(passages, "SPLIT", split)
        found = [r for r in passages.passages(saved(spark, tmp_path / place, rows)).collect() if r.doc_id > 5]
        assert {r.doc_id for r in found} == {6, 7} and len({r.class_id for r in found}) == 1


def test_texts_cut_side_by_side_are_cut_as_alone():
    texts = [" ".join(words) for words in (prose(random.Random(k), 12 * k) for k in range(9))] + ["", "é " * 60, " "]
    numbers = WordNumbers()
    together, alone = passages.Paragraphs(texts, numbers), [passages.Paragraphs(text, numbers) for text in texts]
    for name, at in (("begins", "at"), ("ends", "at"), ("digests", "at"), ("keys", "at")):
        assert getattr(together, name).tolist() == [x for own in alone for x in getattr(own, name).tolist()], (name, at)
    assert together.seeds[1].tolist() == [x for own in alone for x in own.seeds[1].tolist()]
    count = np.arange(len(together.seeds[0]))
    assert together.surroundings_of(count).tolist() == [x for own in alone for x in own.surroundings_of(np.arange(len(own.seeds[0]))).tolist()]
    assert [together.words_of(i) for i in count] == [own.words_of(i) for own in alone for i in range(len(own.seeds[0]))]


def test_equal_runs_that_overlap_keep_their_first_and_last_place():
    """Against the definition, on texts that say phrases of one to eleven words on and on."""
    chance = random.Random(3)
    for _ in range(60):
        texts = []
        for _ in range(chance.randrange(1, 4)):
            words = []
            while len(words) < chance.randrange(20, 120):
                words += [chance.choice("ab") for _ in range(chance.randrange(1, 12))] * chance.randrange(1, 20) if chance.random() < 0.5 else prose(chance, 1)
            texts.append(" ".join(words))
        own = passages.Paragraphs(texts, WordNumbers())
        hashes = passages.shingles(own.words, passages.SEED) if len(own.words) >= passages.LEAST else np.zeros(0, np.uint64)
        wanted = set()

        def same(a, b):
            inside = own.first[at] <= min(a, b) and max(a, b) + passages.SEED <= own.last[at]
            return inside and own.words[a : a + passages.SEED].tolist() == own.words[b : b + passages.SEED].tolist()

        for at in own._leasts(hashes, passages.SEED_REACH, passages.SEED, passages.LEAST).tolist():
            period = next((p for p in range(1, passages.SEED) if same(at, at - p) or same(at, at + p)), None)
            first = last = at
            while period and same(first, first - period):
                first -= period
            while period and same(last, last + period):
                last += period
            wanted |= {first, last}
        assert own.seeds[0].tolist() == sorted(wanted)


def test_a_word_said_on_and_on_claims_nothing_around_it(spark, tmp_path):
    """Seeds of one run met each other, and so claimed words around it that no other document has."""
    chance = random.Random(1)
    docs = [(i, " ".join(prose(chance, 60) + ["the"] * (50 + i) + prose(chance, 60))) for i in range(4)]
    found = passages.passages(saved(spark, tmp_path, docs)).collect()
    assert {r.doc_id for r in found} == {0, 1, 2, 3} and len({r.class_id for r in found}) == 1
    assert all(set(docs[r.doc_id][1][r.start : r.end].split()) == {"the"} for r in found)


def test_variants_of_a_run_are_few_pairs():
    """Every place of a run was a seed of one key, and so a node: forty or more of each text."""
    chance = random.Random(2)
    texts = [" ".join(prose(chance, 60) + ["the"] * chance.randrange(24, 70) + prose(chance, 60)) for _ in range(50)]
    own = passages.Paragraphs(texts, WordNumbers())
    assert np.unique(own.seeds[1], return_counts=True)[1].max() <= 100


def test_words_are_asked_for_one_by_one(spark):
    """Marks of words of neighbouring rows were the same, so that nearly half of all words were looked up."""
    rows = np.repeat(np.array([p << 33 | i for p in range(4) for i in range(400)]), 500)
    words = np.tile(np.arange(500), 1600)
    marks = passages._word_marks(rows, words)
    assert len(np.unique(marks.view(np.uint64) >> np.uint64(38))) > 0.9 * len(rows)
    some = np.arange(0, len(rows), 9973)
    asked = spark.createDataFrame(list(zip(rows[some].tolist(), words[some].tolist())), "row long, word long")
    found = sorted(r.mark for r in asked.select(passages._word_mark()).collect())
    assert found == sorted((marks[some].view(np.uint64) >> np.uint64(38)).tolist())


def test_words_in_place_are_the_words_of_the_text():
    """Their numbers are those of the words, whatever stands around them, however long they are and whatever came before."""
    chance = random.Random(5)
    words = ["a" * k for k in range(1, 40)] + ["é" * k for k in range(1, 20)] + ["a\x00", "a\x00\x00", "ab", "ba", "\x00"] + prose(chance, 50)
    numbers = WordNumbers()
    for said in ([chance.choice(words) for _ in range(3000)], prose(chance, 3000), words, [], words[::-1]):
        raw = "".join(word + chance.choice([" ", "\n", "\t\x0b ", "\r\x0c"]) for word in said).encode()
        assert numbers.of_places(raw, *passages.word_bytes(raw)).tolist() == WordNumbers().of([word.encode() for word in said]).tolist()


def test_copies_with_words_said_on_and_on_are_claimed_up_to_their_ends(spark, tmp_path, monkeypatch):
    """Words that two documents have around a run are claimed with it, in one task and in blocks."""
    chance = random.Random(4)
    text = " ".join(prose(chance, 12) + ["the"] * 70 + prose(chance, 14))
    docs = [(1, text), (1, text), (2, " ".join(prose(chance, 70) + ["the"] * 60 + prose(chance, 70)))]
    for split, place in ((passages.SPLIT, "whole"), (2, "blocks")):
        monkeypatch.setattr(passages, "SPLIT", split)
        found = [r for r in passages.passages(saved(spark, tmp_path / place, docs)).collect() if r.doc_id == 1]
        assert len(found) in (2, 3) and any((r.start, r.end) == (0, len(text)) and r.removed for r in found)


def kept_frames(monkeypatch):
    """The frames that are stored from now on."""
    frames, store = [], passages.stored
    monkeypatch.setattr(passages, "stored", lambda frame: frames.append(store(frame)) or frames[-1])
    return frames


def test_only_what_meets_is_cut_again(spark, tmp_path, monkeypatch):
    """A bitmap told what to cut again; filled up, as many millions of nodes do, it had every unit of every text cut."""
    monkeypatch.setattr(passages, "bitmap_of", lambda marks, width: np.full(1 << 23, 255, np.uint8), raising=False)
    docs, _ = corpus()
    chance, rows = random.Random(8), []
    for k in range(12):
        said = prose(chance, 70)
        rows += [(1000 + 2 * k + i, " ".join(prose(chance, 40) + words + prose(chance, 40))) for i, words in enumerate((said, edited(chance, said, 1)))]
    docs, numbers, holders = docs + rows, WordNumbers(), {}
    for i, text in docs:
        own = passages.Paragraphs(text, numbers)
        for keys, digests in ((own.keys, own.digests), (own.seeds[1], own.surroundings_of(np.arange(len(own.seeds[0]))))):
            for key, digest in zip(keys.tolist(), digests.tolist()):
                holders.setdefault(key, {}).setdefault(digest, set()).add(i)
    wanted = sum(len(digests) for digests in holders.values() if len(digests) > 1 and len(set().union(*digests.values())) > 1)
    frames = kept_frames(monkeypatch)
    assert passages.passages(saved(spark, tmp_path, docs)).count()
    cut = [frame for frame in frames if {"tokens", "word"} & set(frame.columns)]
    assert wanted > 50 and max(frame.count() for frame in cut) == wanted


def test_units_cut_again_are_those_of_the_first_reading():
    """By the span of each in its text, among words of several bytes and blanks of any kind."""
    import pyarrow as pa

    chance, numbers = random.Random(5), WordNumbers()
    texts = ["".join(word + chance.choice([" ", "\n é ", "\t\x0b "]) for word in prose(chance, size)) for size in (300, 0, 70, 20, 200)]
    asked, wanted, node = [], {}, 0
    for text in texts:
        own, units = passages.Paragraphs(text, numbers), []
        for i in range(0, len(own.at), 2):
            units.append((int(own.begins[i]) << 32 | int(own.ends[i]), int(own.keys[i]), own.set_of(i)))
        for i in range(0, len(own.seeds[0]), 3):
            units.append((int(own.seeds[0][i]), int(own.seeds[1][i]), own.words_of(i)))
        asked.append([])
        for span, key, tokens in chance.sample(units, len(units)):
            node += 1
            wanted[node] = key, node, 1, False, 1, tokens
            asked[-1].append({"span": span, "key": key, "node": node, "rank": 1, "twice": False, "splits": 1})
    kinds = [("span", pa.int64()), ("key", pa.int64()), ("node", pa.int64()), ("rank", pa.int32()), ("twice", pa.bool_()), ("splits", pa.int32())]
    columns = [pa.array(range(len(texts))), pa.array(texts), pa.array(asked, pa.list_(pa.struct(kinds)))]
    batch = pa.RecordBatch.from_arrays(columns, ["row", "text", "asked"])
    found = [tuple(row.values()) for part in passages._sets(iter([batch.slice(0, 1), batch.slice(1)])) for row in part.to_pylist()]
    assert len(wanted) > 50 and len(found) == len(wanted) and all(wanted[row[1]] == row for row in found)


def test_words_said_on_and_on_are_not_compared_with_all_others(monkeypatch):
    """Texts of a few runs, of which they share one too short for a near passage: few shingles, so each was tried with all others."""
    pairs, near = [], passages._near
    texts = [" ".join([f"a{i}"] * 40 + ["the"] * 30 + [f"z{i}"] * 40) for i in range(120)]
    own = passages.Paragraphs(texts, WordNumbers())
    at, keys = own.seeds
    key = max(keys.tolist(), key=keys.tolist().count)
    tokens = [own.words_of(i) for i in np.flatnonzero(keys == key)]
    monkeypatch.setattr(passages, "_near", lambda around, one, other: pairs.extend(one) or near(around, one, other))
    around = passages._aligned(tokens)
    links = list(passages._group_links(np.arange(len(tokens)), around, passages._bands(around), np.arange(len(tokens))))
    assert len(tokens) >= 120 and links == [] and len(pairs) < 10 * len(tokens)


def plain_near(x, y, seed):
    """The most shingles that passages around a seed share, over all begins and ends; the pairing of shingles is that of ``_near``."""
    where, last = {}, -1
    near = sorted(range(-passages.SLIP, passages.SLIP + 1), key=abs)
    for k, shingle in enumerate(x):
        hit = next((k + step for step in near if shingle is not None and 0 <= k + step < len(y) and y[k + step] == shingle), -1)
        if hit > last:
            where[k] = hit
        last = max(last, hit)
    if any(k not in where for k in range(seed, seed + passages.SEED - passages.SHINGLE + 1)):
        return 0
    best = 0
    for begin in (k for k in where if k <= seed):
        for end in (k for k in where if k >= seed + passages.SEED - passages.SHINGLE):
            shared = sum(begin <= k <= end for k in where)
            wide = [max(b - a + 1, passages._SIZE) for a, b in ((begin, end), (where[begin], where[end]))]
            if (100 + passages.PERCENT) * shared >= passages.PERCENT * sum(wide):
                best = max(best, shared)
    return best


def test_passages_that_share_most_are_found_by_where_runs_begin_and_end():
    """Against all begins and ends, on texts of few and of many words."""
    chance, some = random.Random(4), 0
    for words in (2, 4, 10**6):
        said = [f"w{chance.randrange(words)}" for _ in range(93)]
        texts = []
        for _ in range(14):
            one = list(said)
            for _ in range(chance.randrange(7)):
                at = chance.choice([k for k in range(93) if k < 38 or k > 54])
                one[at] = f"new{chance.randrange(10**6)}"
            texts.append(one[chance.randrange(20) : 93 - chance.randrange(20)] if words == 10**6 else one)
        numbers = WordNumbers()
        tokens = []
        for one in texts:
            at = max(k for k in range(len(one) - 8) if one[k : k + 9] == said[42:51] and k <= 42)
            own = passages.Words(" ".join(one), numbers)
            tokens.append(own.words_at(np.array([at]))[0])
        around = passages._aligned(tokens)
        rows = [[int(shingle) if there else None for shingle, there in zip(*row)] for row in zip(*around)]
        one, other = np.triu_indices(len(texts), 1)
        good, spans = passages._near(around, one, other)
        found = dict(zip(good.tolist(), spans.tolist()))
        for pair, (i, j) in enumerate(zip(one.tolist(), other.tolist())):
            back = next((k for k in range(passages._MARGIN + 1) if rows[i][42 - k] is None or rows[i][42 - k] != rows[j][42 - k]), 43)
            on = next((k for k in range(len(rows[i]) - 42) if rows[i][42 + k] is None or rows[i][42 + k] != rows[j][42 + k]), len(rows[i]) - 42)
            best = plain_near(rows[i], rows[j], 42) if back and back + on - 1 >= passages._RUN else 0
            assert (pair in found) == (best > 0), (words, i, j)
            some += pair in found
    assert some > 40


def test_hashes_of_short_words_are_those_of_the_library():
    import xxhash

    from breakwater.llm.words import short_hashes

    chance = random.Random(2)
    words = [bytes(chance.randrange(256) for _ in range(size)) for size in range(1, 17) for _ in range(50)]
    low, high = (np.array([int.from_bytes(word[k : k + 8], "little") for word in words], np.uint64) for k in (0, 8))
    found = short_hashes(low, high, np.array([len(word) for word in words]))
    assert found.tolist() == [xxhash.xxh64_intdigest(word) for word in words]


def test_two_rows_of_blocks_meet_once(spark, tmp_path, monkeypatch):
    """Variants beside the leaders were tried for each rare shingle that they share, in keys that one task does not take whole."""
    monkeypatch.setattr(passages, "SPLIT", 20)
    chance, said = random.Random(3), prose(random.Random(2), 101)
    texts = []
    for k in range(60):
        words = list(said)
        for at in (10, 26, 74, 90):
            words[at + k % 7 - 3] = f"new{k}"
        texts.append(words if k % 2 else [*words[:40], *said[40:61], *prose(chance, 40)])
    docs = saved(spark, tmp_path, [(i, " ".join(words)) for i, words in enumerate(texts)])
    frames, map_in_arrow = [], type(docs).mapInArrow

    def tapped(self, func, *args, **kwargs):
        if func.__name__ in ("_try_across", "_try_blocks"):
            frames.append(self)
        return map_in_arrow(self, func, *args, **kwargs)

    monkeypatch.setattr(type(docs), "mapInArrow", tapped)
    passages.passages(docs).count()
    tried = [row for frame in frames for row in frame.select("key", "node", "one", "other").collect() if row.key & 1]
    assert len(tried) > 100 and len(tried) == len(set(tried))
