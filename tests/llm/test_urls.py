from __future__ import annotations

import random
import re

import pytest

from breakwater.llm import queries, urls
from tests import oracle


def test_query_equals_sql(spark, sf_dir):
    frame = queries.op8_url_filter(spark, sf_dir)
    assert oracle.differences(frame, oracle.connect(sf_dir), urls.SQL) is None


def as_regex(glob):
    parts = {"**": ".*", "*": "[^/]*", "?": "[^/]"}
    return re.compile("".join(parts.get(t, re.escape(t)) for t in urls._TOKENS.findall(glob)).encode(), re.S)


def test_automaton_equals_regular_expressions():
    chance = random.Random(3)
    globs = tuple("".join(chance.choices(["a", "b", "/", ".", "*", "**", "?", "é"], k=chance.randrange(0, 12))) for _ in range(60))
    machine, plain = urls.Automaton(globs), [as_regex(g) for g in globs]
    assert machine.words > 3
    texts = ["".join(chance.choices("ab/.é", k=chance.randrange(0, 14))).encode() for _ in range(2000)] + [b""]
    for text, best in zip(texts, machine.best(texts)):
        assert best == max((i for i, p in enumerate(plain) if p.fullmatch(text)), default=-1), text


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("example.net/en/", "", "", None, "allow"),
        ("http://A.Example.NET/en/X?q#f", "a.example.net", "/en/X", "example.net/en/", "allow"),
        ("http://example.net", "example.net", "", None, "allow"),
        ("x://b.net?en/", "b.net", "", None, "allow"),
        ("http://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
        ("http://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
        ("http://example.com/x.net/y", "example.com", "/x.net/y", None, "allow"),
        ("a://b://c.org/fr/", "b:", "//c.org/fr/", None, "allow"),
        ("https://spam-farm.example.org/en/728", "spam-farm.example.org", "/en/728", None, "block"),
        ("https://É.net/\nq", "É.net", "/\nq", "net/", "block"),
        ("http://c.d/" + "y" * 20000 + "/wp-admin/z", "c.d", "/" + "y" * 20000 + "/wp-admin/z", None, "block"),
        ("http://casino.example", "casino.example", "", None, "block"),
        ("http://user@spam-x.com/", "user@spam-x.com", "/", None, "block"),
        ("http://c.d/%77p-admin/", "c.d", "/%77p-admin/", None, "block"),
        ("http://c.d/WP-ADMIN/", "c.d", "/WP-ADMIN/", None, "block"),
        ("http://c.d/a.EXE?x", "c.d", "/a.EXE", None, "block"),
        ("http://c.d/a.exe/../b", "c.d", "/a.exe/../b", None, "allow"),
        ("http://c.d/x/.%2E/cgi-bin/./", "c.d", "/x/.%2E/cgi-bin/./", None, "block"),
    ],
)
def test_single_urls(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "h", 2)], "page_id long, url string, Host string, verdict int")
    row = urls.verdicts(pages).first()
    assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)
    assert urls.judge(pages).columns == ["page_id", "url", "host", "path", "rule", "verdict"]


@pytest.mark.parametrize(
    "parts, form",
    [
        (("", "", ""), ""),
        (("http", "a.b:80", ""), "a.b/"),
        (("https", "a.b:80", "/x"), "a.b:80/x"),
        (("ftp", "u:p@a.b.:", "/x/../../y/."), "a.b/y/"),
        (("http", "%41.b", "//a%2Fb/%7e/%zz%"), "a.b//a%2Fb/~/%zz%"),
        (("", "", "/.."), "/"),
    ],
)
def test_canonical_form(parts, form):
    assert urls.canonical(*parts) == form


def test_sql_has_the_same_canonical_form(spark, tmp_path):
    hosts = ["c.d", "u@spam-x.com", "ads.c", "%61ds.c:80", "casino.c.", "a.net", "b.org:", ":80"]
    paths = ["", "/", "/%77p-admin/", "/a/../WP-Admin/x", "/cgi-bin/..", "/a.EXE", "/a.exe/.", "/x/robots.txt", "/fr/", "/%2e%2E/%", "//", "/é.exe"]
    places = [f"{scheme}://{host}{path}{rest}" for scheme in ("http", "HTTPS") for host in hosts for path in paths for rest in ("", "?q")]
    frame = spark.createDataFrame(list(enumerate([None, "", "x", "://", *places])), "page_id long, url string")
    frame.write.parquet(str(tmp_path / "pages.parquet"))
    import duckdb

    with duckdb.connect() as held:
        held.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
        want = sorted(map(tuple, held.sql(f"select page_id, host, path, rule, verdict from ({urls.SQL})").fetchall()))
    got = urls.verdicts(frame).select("page_id", "host", "path", "rule", "verdict")
    assert sorted(map(tuple, got.collect())) == want


def test_globs_of_a_table(spark, monkeypatch):
    rows = [("block", "*/Bad/**", True), ("block", "*/Bad/**", True), ("allow", "*/x", None), (None, "*", True), ("block", None, None)]
    table = spark.createDataFrame(rows, "verdict string, pattern string, any_case boolean")
    found = urls.globs_of(table)
    assert found == (urls.Glob("allow", "*/x"), urls.Glob("block", "*/Bad/**", True))
    pages = spark.createDataFrame([(1, "h://a/bAD/"), (2, "h://a/X")], "page_id long, url string")
    assert [r.verdict for r in urls.judge(pages, globs=found).orderBy("page_id").collect()] == ["block", "allow"]
    assert [r.verdict for r in urls.judge(pages, rules=(), globs=()).collect()] == ["allow"] * 2
    monkeypatch.setattr(urls, "MOST_GLOBS", 1)
    with pytest.raises(ValueError):
        urls.globs_of(table)


def test_repeats_and_empty_tables(spark):
    pages = spark.createDataFrame([(None, "http://a.net/"), (None, "http://a.net/")], "page_id long, url string")
    assert [r.verdict for r in urls.verdicts(pages).collect()] == ["block", "block"]
    assert urls.verdicts(pages.limit(0)).count() == 0
