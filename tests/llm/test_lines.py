from __future__ import annotations

import re
import textwrap

import pytest
from pyspark.sql import functions as F

from breakwater.llm import lines
from breakwater.llm.queries import op3_quality_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    """The base columns, read off their definition."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    split = text.split("\n")
    copies = sum(bool(WORD.search(line)) and line in split[:i] for i, line in enumerate(split))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), copies, len(covered), failed


def test_query_counts(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op3_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        if len(texts[r.doc_id]) < 9000:
            assert tuple(r)[1:7] == plain(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("text", [None, "", " \n\t", "a a a a", "a b c a b c", "x\x0by z\n\nx\ny\nx", "é b　c 😀", "a b\na b\n \n "])
def test_odd_texts(text):
    got = lines.judge(text, True)
    assert got[:6] == plain(text)


def prose(n, seed=0):
    return [f"Sentence {seed} number {i} tells of item{i * 7 + seed} and place{i * 3} near river{i}." for i in range(n)]


def test_rules_remove_lines_and_reject_losers(spark):
    menu = "Home | About | Blog | Contact"
    mostly_menu = "\n".join(prose(6) + [" | ".join(f"w{i}{j}" for j in range(40)) for i in range(6)])
    docs = [
        (1, "\n".join([*prose(9), menu, "All rights reserved.", prose(9)[0]]), 1),
        (2, mostly_menu, 2),
        (3, "\n".join(prose(9, 3)), 3),
        (3, "\n".join(prose(9, 3)), 3),
        (4, None, 4),
        (None, "LOUD WORDS HERE AND THERE!!\n" * 20, 5),
        (6, " ".join(f"w{i}###" for i in range(60)) + ".", 6),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, verdict int").withColumn("n_chars", F.length("text").cast("long"))
    kept = {(r.doc_id, r.text, r.n_chars, r.verdict) for r in lines.clean(frame).collect()}
    whole = "\n".join(prose(9, 3))
    assert kept == {(1, "\n".join(prose(9)), len("\n".join(prose(9))), 1), (3, whole, len(whole), 3)}
    assert lines.clean(frame).count() == 3
    assert lines.clean(frame).columns == frame.columns
    assert lines.report(frame.limit(0)).count() == 0


def test_wrapped_and_indented_prose_keeps_its_text():
    wrapped = textwrap.fill(" ".join(prose(30)).replace(".", ",").replace("river9,", "river9."), 80)
    assert any(len(line.split()) >= lines.OPEN_WORDS and "." not in line for line in wrapped.split("\n"))
    poem = "\n".join(f"{' ' * 24}verse{i} of\tword{i * 3}" for i in range(20))
    tabbed = "\t".join(f"w{i}" for i in range(60)) + "."
    for text in (wrapped, poem, tabbed, f"{wrapped}\n\n{poem}\n    TITLE", ("x" * 50 + " y. ") * 20_000):
        verdict = lines.judge(text, True)
        assert (verdict.cleaned, verdict.lost_chars) == (text, 0)
    assert lines.judge("a b c d e f g h i j k l m\n\nEnd.", True).cleaned == "\nEnd."


def test_labelled_documents(spark, sf_dir):
    """Every clean labelled document that the base rules pass is kept; of the poor ones none."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    judged = op3_quality_rules(spark, sf_dir).where("not base_failed").join(labels, "doc_id")
    assert {(r.quality, r.kept) for r in judged.select("quality", "kept").distinct().collect()} <= {(1, True), (0, False)}


def test_query_equals_sql(spark, sf_dir):
    from breakwater.llm import queries
    from tests import oracle

    assert oracle.differences(queries.op3_quality_rules(spark, sf_dir), oracle.connect(sf_dir), lines.SQL) is None


def test_texts_are_judged_once(spark, tmp_path):
    text = "\n".join(f"Line {i} has word{i * 3} and thing{i * 5} near place{i} and more to say here." for i in range(12))
    rows = [(1, text, "en", "s", 9), (1, text, "en", "s", 9), (2, "short", "en", "s", 5), (None, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "d"))
    found = lines.clean(spark.read.parquet(str(tmp_path / "d")))
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [r.doc_id for r in found.collect()] == [1, 1]
