from __future__ import annotations

import hashlib
import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from breakwater.llm import pieces
from breakwater.llm.queries import op1_sentencepiece, vocabulary

ODD = ["", None, " ", "  ", "a", "a ", " a", "  a  b ", "\ta\n b", "▁", "▁x", "a▁ b", "日本\x00x​", "</s> <unk>",
       "x" * 5000, "ab " * 4000, "\n\n", "é ﬁ Å", "a　b", "😀 😀", "�", "   tail   "]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary())


def expected(model, text):
    ids = model.encode(text or "", add_eos=True)
    return ids, model.decode(ids)


def test_ids_and_text_equal_the_library(spark, model):
    letters = ["a", "the", "é", "▁", " ", "  ", "\n", "ing", "日", "😀", "9", ".", "</s>", "\t"]
    chance = random.Random(7)
    texts = ODD + ["".join(chance.choices(letters, k=chance.randrange(40))) for _ in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = pieces.encoded(docs, vocabulary()).withColumn("back", pieces.decode(F.col("ids"), vocabulary())).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert (row.ids, row.back) == expected(model, row.text)


def test_table_restarts(spark, model, monkeypatch):
    table = pieces.Chunks(vocabulary())
    monkeypatch.setattr(pieces, "TABLE_CHUNKS", 5)
    for words in (["one two three four"], ["five six one"], [], ["two  one "]):
        ids, upto = table.encode(words, end=False)
        assert [ids[a:b].tolist() for a, b in zip(upto, upto[1:])] == [model.encode(w) for w in words]


def test_query_equals_the_library(spark, sf_dir, model):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op1_sentencepiece(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids, back = expected(model, texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_nulls_repeats_and_extra_columns(spark):
    docs = spark.createDataFrame([(None, None, "x"), (1, "a b", None), (1, "a b", None)], "doc_id long, text string, ids string")
    assert [r.n_tokens for r in pieces.digests(docs, vocabulary()).orderBy("n_tokens").collect()] == [1, 3, 3]
    assert pieces.digests(docs.limit(0), vocabulary()).count() == 0
