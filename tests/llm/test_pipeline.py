from __future__ import annotations

import hashlib

import sentencepiece

import corpus_pipeline
from breakwater.llm import jaccard, lines
from breakwater.llm.queries import vocabulary
from tests.llm.test_jaccard import plain


def stages(spark, docs, sf_dir, tmp_path):
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        place = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
        kept.append(docs)
    return kept


def test_stages_on_the_documents(spark, sf_dir, tmp_path):
    start = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good, single, masked, mixed, encoded = stages(spark, start, sf_dir, tmp_path)
    assert all(x.columns == start.columns for x in (good, single, masked, mixed))
    rows = {r.doc_id: r for r in start.collect()}
    want = {i: lines.judge(r.text, True) for i, r in rows.items()}
    got = {r.doc_id: r.text for r in good.collect()}
    assert got == {i: v.cleaned for i, v in want.items() if v.kept}
    linked = plain(sorted(got.items()), 5, 80, 100)
    left = {r.doc_id for r in single.collect()}
    groups = {}
    for doc_id, _, component in linked:
        groups.setdefault(component, set()).add(doc_id)
    assert all(len(members & left) == 1 for members in groups.values())
    assert {r.doc_id for r in masked.collect()} == left
    assert all(r.n_chars == len(r.text) for r in masked.collect())
    drawn = [r.doc_id for r in mixed.collect()]
    assert set(drawn) == left and max(map(drawn.count, left)) <= 2
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary())
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert encoded.count() == len(drawn)
    for r in encoded.collect():
        ids = model.encode(texts[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())


def test_run_equals_the_stages(spark, sf_dir, tmp_path):
    whole = sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))
    last = stages(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir, tmp_path)[-1]
    assert whole == sorted(map(tuple, last.collect()))


def test_odd_rows_pass_every_stage(spark, sf_dir, tmp_path):
    text = "\n".join(f"Line {i} has word{i * 3} and thing{i * 5} with password=abcdef{i:06d} near place{i}." for i in range(12))
    rows = [(None, text, None, None, None, 1), (1, None, "x", None, 0, 2), (2, "", None, "s", 0, 3), (3, text, "en", "s", 9, 4), (3, text, "en", "s", 9, 4)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = stages(spark, docs, sf_dir, tmp_path)
    assert [x.count() for x in found[:3]] == [3, 1, 1]
    assert "password" not in found[2].first().text and found[2].columns == docs.columns
    empty = tmp_path / "empty"
    empty.mkdir()
    assert [x.count() for x in stages(spark, docs.limit(0), sf_dir, empty)] == [0] * 5


def test_representatives_keep_texts_without_words(spark, tmp_path):
    rows = [(1, None, 0), (2, None, 0), (3, " ", 0), (4, "a b c d e f g", 0), (5, "A b c d e f g", 0), (6, "x", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, node int").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    kept = {r.doc_id for r in jaccard.representatives(docs).collect()}
    assert kept - {4, 5} == {1, 2, 3, 6} and len(kept & {4, 5}) == 1
