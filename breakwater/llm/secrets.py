"""Secrets and who owns them, with DataFrame functions only.

Patterns give candidates. Every candidate's value is counted over the whole corpus by the distinct repositories
and owners that hold it: a value of many owners is a copied example, one of few looks like a live credential.
Base kinds are always reported; a value of the wider kinds only where it looks live.

Where a match lies follows from the lengths of the gaps before it: each pattern takes the text up to a match, the
match's head and its value, anchored to the end of the match before, so a text is walked once whatever its length.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from breakwater.llm.common import stored


class Kind(NamedTuple):
    """``head`` and ``value`` are the two parts of a match; a value of fewer characters than ``least``, or without
    one of ``needs``, is passed over."""

    name: str
    head: str
    value: str
    least: int = 1
    needs: tuple[str, ...] = ()


# Kinds in the order they are listed, the base ones first. A private key goes on to its END line, through
# lines of base64 and headers; one that is cut off ends with its last line of base64.
KEY_BODY = r"[\x20\t\r\nA-Za-z0-9+/=:,-]"
BASE = (
    Kind("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]+", 6),
    Kind("access", "AKIA", "[A-Z0-9]{16,}"),
    Kind("hex", "", "[0-9a-f]{24,}"),
)
WIDER = (
    Kind("upperhex", "", "[0-9A-F]{24,}", needs=("[0-9]", "[A-F]")),
    Kind("mixed", "", "[A-Za-z0-9+/_-]{24,}", needs=("[0-9]", "[A-Z]", "[a-z]")),
    Kind("private", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", rf"(?:{KEY_BODY}*?-----END [A-Z ]{{0,40}}PRIVATE KEY-----|[\r\nA-Za-z0-9+/=]+)", 16),
    Kind("login", r"://[^\x20\t\r\n/:@]+:", r"[^\x20\t\r\n/:@]{3,}@"),
)
KINDS = BASE + WIDER
MASK = "[SECRET]"

# Parameters: a value of at most so many owners and repositories looks live; ways in which a hot value or text is split
# for a join.
MAX_OWNERS, MAX_REPOSITORIES, SALTS = 2, 4, 16


_HITS = "array<struct<kind:int,place:int,gap:bigint,size:bigint,value:string>>"


def _described(kind: Kind, part: Column, place: Column) -> Column:
    """One match: kind, its place among its kind, lengths of the gap before and of the match, digest if it counts."""
    value = part["g3"]
    counts = F.char_length(value) >= kind.least
    for need in kind.needs:
        counts = counts & value.rlike(need)
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        place.alias("place"),
        F.char_length(part["g1"]).cast("long").alias("gap"),
        (F.char_length(part["g2"]) + F.char_length(value)).cast("long").alias("size"),
        F.when(counts, F.sha2(value, 256)).alias("value"),
    )


def _hits_of(kind: Kind, text: Column) -> Column:
    pattern = F.lit(rf"(?s)\G(.*?)({kind.head})({kind.value})")
    parts = F.arrays_zip(*[F.regexp_extract_all(text, pattern, F.lit(g)).alias(f"g{g}") for g in (1, 2, 3)])
    found = F.transform(parts, lambda part, place: _described(kind, part, place))
    return F.when(text.rlike(kind.head + kind.value), found).otherwise(F.array().cast(_HITS))


def _hits(text: Column) -> Column:
    """All matches of all kinds in a text."""
    return F.concat(*[_hits_of(kind, text) for kind in KINDS])


def _spans(hits: DataFrame, keys: list[str]) -> DataFrame:
    """One row per hit that counts: ``keys``, kind, start, end, value; hits of a row and kind lie one after the other."""
    flat = hits.select(*keys, F.explode("hits").alias("hit")).select(*keys, "hit.*")
    upto = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy(keys[0], "kind").orderBy("place"))
    placed = flat.withColumn("end", upto).withColumn("start", F.col("end") - F.col("size"))
    return placed.where(F.col("value").isNotNull()).drop("gap", "size", "place")


def ownership(values: DataFrame) -> DataFrame:
    """``value, owners, repositories`` from rows of ``value, owner, repository``; a null owner counts as one owner.

    Pairs are made distinct first, so a value that fills the corpus reaches its count as one row per repository.
    """
    held = values.select("value", "owner", "repository").distinct().groupBy("value", "owner").agg(F.count("*").alias("n"))
    return held.groupBy("value").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def _judged(spans: DataFrame, frequencies: DataFrame, salt: Column) -> DataFrame:
    """Spans with owners and repositories of their value and whether it looks live, without copied values of wider kinds."""
    salted = frequencies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = spans.withColumn("salt", salt).join(salted, ["value", "salt"]).drop("salt")
    live = (F.col("owners") <= MAX_OWNERS) & (F.col("repositories") <= MAX_REPOSITORIES)
    return joined.withColumn("live", live).where((F.col("kind") < len(BASE)) | F.col("live"))


def _column(docs: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in docs.columns else F.lit(None).cast("string")


def _repository(docs: DataFrame, owner: str, language: str) -> Column:
    return F.concat_ws("/", *[F.coalesce(_column(docs, name), F.lit("?")) for name in (owner, language)])


def found_secrets(docs: DataFrame, text: str = "text", owner: str = "source", language: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Documents by row number, and their secrets.

    The first has ``row, doc_id`` for every row of ``docs``; the second ``row, doc_id, kind, start, end, value,
    owners, repositories, live``, positions in code points. An owner is a source, a repository a source's part in one
    language. Texts are read once; what was found is stored.
    """
    repository = _repository(docs, owner, language)
    narrow = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id"),
            _column(docs, owner).alias("owner"),
            repository.alias("repository"),
            _hits(F.coalesce(F.col(text), F.lit(""))).alias("hits"),
        )
    )
    spans = stored(_spans(narrow.where(F.size("hits") > 0), ["row", "doc_id", "owner", "repository"]))
    judged = _judged(spans, ownership(spans), F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    return narrow.select("row", "doc_id", (F.size("hits") > 0).alias("has_hits")), judged.drop("owner", "repository")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _count_of(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """Per document its base counts and digest, all spans, and how many look live or are copied examples.

    Null and empty texts have none; repeated rows are reported each; extra columns are not read.
    """
    rows, spans = found_secrets(docs)
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,live:boolean>>").alias("spans")
    # All spans of one text: no more than the text has room for.
    grouped = spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("spans")
    )
    without = rows.where("not has_hits").select("row", "doc_id", none)
    # Rows whose hits all fell away are in neither; an outer join among rows with hits keeps them.
    having = rows.where("has_hits").join(grouped, "row", "left")
    every = without.unionByName(having.select("row", "doc_id", F.coalesce("spans", none).alias("spans")))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return every.select(
        "doc_id",
        *[_count_of(i).alias(f"n_{kind.name}") for i, kind in enumerate(BASE)],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_examples"),
    )


def _candidate(text: Column) -> Column:
    """Whether a text holds a match of any kind."""
    found = F.lit(False)
    for kind in KINDS:
        found = found | text.rlike(kind.head + kind.value)
    return F.coalesce(found, F.lit(False))


def _holders(docs: DataFrame, *columns: Column) -> DataFrame:
    """``owner, repository, hits`` and the given columns of the rows that hold a match."""
    owner, repository = _column(docs, "source").alias("owner"), _repository(docs, "source", "lang").alias("repository")
    return docs.where(_candidate(F.col("text"))).select(*columns, owner, repository, _hits(F.col("text")).alias("hits"))


def _values(holders: DataFrame) -> DataFrame:
    return holders.select("owner", "repository", F.explode("hits.value").alias("value")).where(F.col("value").isNotNull())


def masked(docs: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """``docs`` with every secret's span replaced by ``MASK``, ``n_chars`` following; all rows and columns stay.

    What is masked depends on the text and the holders of its values alone, so spans are found once for each
    distinct text; only texts that hold a candidate are moved. Holders are counted in ``docs`` and, where given, in
    ``corpus``: documents as they were before copies left, so that an example copied by many owners stays one.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    own = docs.select(whole, F.col("text"), _candidate(F.col("text")).alias("candidate"))
    digest = F.sha2("text", 256).alias("digest")
    narrow = stored(_holders(docs, digest))
    values = narrow.groupBy("digest", "owner", "repository").agg(F.any_value("hits").alias("hits"))
    held = _values(values)
    if corpus is not None:
        held = held.unionByName(_values(_holders(corpus)))
    texts = values.groupBy("digest").agg(F.any_value("hits").alias("hits"))
    spans = _judged(_spans(texts, ["digest"]), ownership(held), F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int"))
    by_text = spans.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    moved = (
        own.where("candidate")
        .select("doc", "text", digest, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int").alias("salt"))
        .join(by_text.select("*", salts), ["digest", "salt"], "left")
        .select("doc", _masked(F.col("text"), F.col("spans")).alias("masked"))
    )
    still = own.where("not candidate").select("doc", F.col("text").alias("masked"))
    changed = {"text": F.col("masked"), "n_chars": F.char_length("masked").cast("long")}
    return still.unionByName(moved).select(
        *[changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns]
    )


def _masked(text: Column, spans: Column) -> Column:
    """The text with spans, sorted by start and maybe overlapping, replaced."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("upto"))

    def step(acc, span):
        between = F.substr(text, (acc["upto"] + 1).cast("int"), (span["start"] - acc["upto"]).cast("int"))
        more = F.when(span["start"] >= acc["upto"], F.concat(acc["done"], between, F.lit(MASK))).otherwise(acc["done"])
        return F.struct(more.alias("done"), F.greatest(acc["upto"], span["end"]).alias("upto"))

    folded = F.aggregate(F.coalesce(spans, F.array().cast("array<struct<start:bigint,end:bigint>>")), start, step)
    return F.concat(folded["done"], F.substr(text, (folded["upto"] + 1).cast("int")))


def _sql() -> str:
    """The report for SQL: gaps added up by a window, owners counted by grouping."""
    hits = []
    for number, kind in enumerate(KINDS):
        pattern = f"(?s)(.*?)({kind.head})({kind.value})".replace("'", "''")
        part = [f"unnest(regexp_extract_all(text, '{pattern}', {g})) as g{g}" for g in (1, 2, 3)]
        needs = "".join(f" and regexp_matches(g3, '{need}')" for need in kind.needs)
        hits.append(
            f"select r, doc_id, source, lang, {number} as k, '{kind.name}' as kind, pos, length(g1) as gap, length(g2) + length(g3) as size, "
            f"case when length(g3) >= {kind.least}{needs} then g3 end as v from (select r, doc_id, source, lang, {', '.join(part)}, "
            f"generate_subscripts(regexp_extract_all(text, '{pattern}', 1), 1) as pos from d)"
        )
    counts = ", ".join(f"count(*) filter (where kind = '{k.name}') as n_{k.name}" for k in BASE)
    return f"""
with d as (select row_number() over () as r, * from documents),
hits as ({' union all '.join(hits)}),
spans as (select * from (select *, sum(gap + size) over (partition by r, k order by pos) as e from hits) where v is not null),
owned as (select v, count(distinct coalesce(source, chr(1))) <= {MAX_OWNERS}
                 and count(distinct coalesce(source, chr(1)) || chr(2) || coalesce(lang, '?')) <= {MAX_REPOSITORIES} as live
          from spans group by v),
judged as (select r, k, kind, cast(e - size as bigint) as s, cast(e as bigint) as e, live
           from spans join owned using (v) where k < {len(BASE)} or live),
told as (select r, {counts},
                string_agg(kind || ':' || s || ':' || e, ',' order by s, k) filter (where k < {len(BASE)}) as base,
                string_agg(kind || ':' || s || ':' || e, ',' order by s, k) as spans,
                count(*) filter (where live) as n_live, count(*) filter (where not live) as n_examples
         from judged group by r)
select doc_id, {', '.join(f'coalesce(n_{k.name}, 0) as n_{k.name}' for k in BASE)}, sha256(coalesce(base, '')) as base_sha256,
       coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_examples, 0) as n_examples
from d left join told using (r)
"""


SQL = _sql()
