from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from breakwater.llm import queries, secrets
from tests import oracle

PLAIN = {
    "assign": re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def base(text):
    found = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text or ""):
            if {"assign": len(m[m.lastindex or 0]) >= 6, "access": len(m[0]) >= 20, "hex": len(m[0]) >= 24}[kind]:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [span for _, _, span in sorted(found)]


def test_query_equals_sql(spark, sf_dir):
    frame = queries.op7_secret_scan(spark, sf_dir)
    assert oracle.differences(frame, oracle.connect(sf_dir), secrets.SQL) is None


ODD = [
    None, "", "password=abc", "secret=token:abcdefghij and token=token=abcdefgh", "😀é token : 'Abc.def-1'",
    "AKIAAKIA" + "B" * 16, "AKIA" + "B" * 15, "x" + "0123456789abcdef" * 2 + "g" + "a" * 24, "api_key=" + "f" * 30,
    "APIKEY\"='zzzzzz' passwd==abcdef", "a\nPaSsWoRd= \"QQQQQQ\"\npassword=\nqqqqqq", "abc " * 30_000 + "token=abcdef123",
    "http://bob:hunter2@host/ AAAAAAAAAAAA0000000000000000", "0123456789abcdef01234567 " * 300,
]


def test_base_spans_by_plain_search(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    rows = {r.doc_id: r for r in secrets.report(docs).collect()}
    assert len(rows) == len(ODD)
    for i, text in enumerate(ODD):
        want = base(text)
        assert rows[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        assert [s for s in rows[i].spans.split(",") if s.split(":")[0] in PLAIN] == want
        assert rows[i].n_hex == sum(s.startswith("hex") for s in want)
    assert "login" in rows[12].spans and "upperhex" in rows[12].spans


def test_owners_tell_examples_from_live_values(spark):
    key, own = "Zx9" * 9, "Qw8" * 9
    rows = [(i, f"see {key} here", f"s{i % 4}", "en") for i in range(40)] + [(90, f"my {own}", "s1", "en"), (91, f"my {own}", "s1", "de")]
    rows += [(99, f"hex {'0a' * 12}", f"s{i}", None) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("row", F.lit("x"))
    found = {}
    for r in secrets.report(docs).collect():
        found.setdefault(r.doc_id, []).append((r.spans, r.n_live, r.n_examples))
    assert found[0] == [("", 0, 0)]
    assert found[90] == found[91] == [("mixed:3:30", 1, 0)]
    assert found[99] == [("hex:4:28", 0, 1)] * 5
    _, spans = secrets.found_secrets(docs)
    assert {(r.owners, r.repositories) for r in spans.where("doc_id = 90").collect()} == {(1, 2)}


def test_masked(spark):
    rows = [
        (1, "a password=abcdef123456abcdef123456ab b", 9), (1, "a password=abcdef123456abcdef123456ab b", 9), (2, "é clean", 7),
        (None, None, None), (3, "token=abc", 9), (4, "AKIA" + "B" * 16 + "😀" + "AKIA" + "C" * 16, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("digest", F.lit(1)).withColumn("hits", F.lit(2))
    out = secrets.masked(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, [(r.doc_id, r.text, r.n_chars) for r in out.collect()])) == sorted(map(str, [
        (1, "a [SECRET] b", 12), (1, "a [SECRET] b", 12), (2, "é clean", 7), (None, None, None), (3, "token=abc", 9),
        (4, "[SECRET]😀[SECRET]", 17),
    ]))
    assert secrets.masked(docs.limit(0)).count() == 0 and secrets.report(docs.limit(0)).count() == 0


KEY = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\n\n" + "\n".join(("Ab9/" * 16, "Qz7+" * 16, "xy==")) + "\n-----END RSA PRIVATE KEY-----"


def test_whole_keys_and_long_logins_are_masked(spark):
    cut = KEY.partition("\n\n")[2].partition("\n---")[0]
    rows = [
        (1, f"before\n{KEY}\nafter it", "a"),
        (2, "http://" + "u" * 90 + ":" + "p" * 70 + "@host/ ok", "a"),
        (3, f"-----BEGIN PRIVATE KEY-----\n{cut}\n\nThe end. -----", "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in secrets.masked(docs).collect()}
    assert got[1] == "before\n[SECRET]\nafter it"
    assert got[2] == "http[SECRET]host/ ok"
    assert got[3].startswith("[SECRET]") and "Ab9/" not in got[3] and got[3].endswith(" end. -----")


def test_repositories_count_and_holders_before_copies_left(spark):
    key, own = "Zx9" * 9, "Qw8" * 9
    rows = [(i, f"see {key}", "s", f"l{i}") for i in range(5)] + [(9, f"my {own}", "s", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    assert {r.doc_id for r in secrets.report(docs).where("n_live > 0").collect()} == {9}
    left = docs.where("doc_id in (0, 9)")
    assert {r.doc_id: r.text for r in secrets.masked(left).collect()} == {0: "see [SECRET]", 9: "my [SECRET]"}
    assert {r.doc_id: r.text for r in secrets.masked(left, docs).collect()} == {0: f"see {key}", 9: "my [SECRET]"}
