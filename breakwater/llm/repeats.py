"""Removal of long byte strings that occur more than once, over a sparse suffix array sorted deep-shallow.

A string of ``length`` bytes holds one anchor, the leftmost of its runs of ``GRAM`` bytes whose hash is least. Equal
strings have equal anchors at equal offsets, so only anchors with equal runs need to be compared, and neighbouring
strings share anchors: an anchor stands for a range of starts, about one in 150 bytes. It is described by its context,
the bytes from its first start to the end of its last string.

1. Contexts are counted by a digest, copies first within a text. One met twice is repeated as a whole, so groups of
   copies never meet.
2. Where an anchor's run has several contexts and one of them is met once, the contexts are cut from a text that holds
   them. The suffixes from the anchors are sorted deep-shallow, and so are the reversed bytes before them. At an offset
   o two starts are equal where the suffixes share ``length - o`` bytes and the prefixes o bytes; both classes are
   intervals of the sorted orders, and they change at few offsets only.
3. A run with more contexts than ``MOST`` is dealt anew by halves of its offsets: what is equal at one of the offsets
   of a half shares the bytes common to all of them, so a half is keyed by these as well, until its groups are small.
   A single offset is keyed by the whole string and needs a count alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater.llm.bitmap import bitmap_of, mark, might_hold
from breakwater.llm.common import prepare, shuffle_width, steady_scans, stored
from breakwater.llm.deepshallow import deep_shallow

# Parameters: bytes of an anchor's run, starts looked at together, contexts of one run compared in one task, cells of
# offsets and contexts held at a time.
GRAM, CHUNK, MOST, CELLS = 24, (1 << 20) - 4096, 1024, 1 << 21

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_PLACE = np.uint64(20)

_ANCHORS = "row long, text_mark int, key long, context binary, first long, last long, at long, n int"
_CHANGED = "a text changed between two reads; store the documents first"
_CUT = "key long, context binary, low int, high int, left binary, right binary, n long"
_FOUND = "context binary, key long, low int, high int"


def _grams(raw: np.ndarray) -> np.ndarray:
    """A hash of every run of ``GRAM`` bytes, from those of half as many, and so on."""
    hashes, power = {1: raw.astype(np.uint64) + np.uint64(1)}, {1: _STEP}
    size = 1
    with np.errstate(over="ignore"):
        while 2 * size <= GRAM:
            own = hashes[size]
            hashes[2 * size] = own[:-size] * power[size] + own[size:]
            power[2 * size] = power[size] * power[size]
            size *= 2
        count, found, at = len(raw) - GRAM + 1, None, 0
        for size in sorted(hashes, reverse=True):
            if GRAM & size:
                own = hashes[size][at : at + count]
                found = own.copy() if found is None else found * power[size] + own
                at += size
        found ^= found >> np.uint64(29)
        found *= _MIX[0]
        found ^= found >> np.uint64(32)
        found *= _MIX[1]
        found ^= found >> np.uint64(29)
    return found


def anchors(raw: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """First and last start, place and hash of the anchors of the strings of ``length`` bytes in ``raw``."""
    hashes = _grams(raw)
    width, count = length - GRAM + 1, len(raw) - length + 1
    keyed = (hashes >> _PLACE << _PLACE) | np.arange(len(hashes), dtype=np.uint64)
    padded = np.full(-(-len(keyed) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keyed)] = keyed
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[:count], before[width - 1 : width - 1 + count])
    at = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.append(first[1:] - 1, count - 1)
    return first, last, at[first], hashes[at[first]].view(np.int64)


def _text_mark(data: bytes) -> int:
    """Tells whether a row read again has the text it had."""
    return zlib.crc32(data) - (1 << 31)


def _merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of starts joined where they touch or overlap."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate(([True], first[1:] > last[:-1] + 1))
    return first[new], last[np.append(np.flatnonzero(new)[1:] - 1, len(last) - 1)]


def _surveyed(length: int):
    """Texts to their anchors; what a text itself repeats goes as joined ranges, without a key, and one of each context."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            out: list[tuple] = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = (text.as_py() or "").encode()
                own = _text_mark(data)
                held: dict[bytes, int] = {}
                again: list[tuple[int, int]] = []
                for start in range(0, len(data) - length + 1, CHUNK):
                    raw = np.frombuffer(data, np.uint8, min(CHUNK + length - 1, len(data) - start), start)
                    for first, last, at, key in zip(*(x.tolist() for x in anchors(raw, length))):
                        first, last, at = first + start, last + start, at + start
                        context = xxhash.xxh3_128_digest(data[first : last + length], seed=at - first)
                        if (known := held.get(context)) is None:
                            held[context] = len(out)
                            out.append((row, own, key, context, first, last, at, 1))
                        else:
                            if out[known][-1] == 1:
                                out[known] = (*out[known][:-1], 2)
                                again.append(out[known][4:6])
                            again.append((first, last))
                if again:
                    for first, last in zip(*(x.tolist() for x in _merged(*np.array(again, np.int64).T))):
                        out.append((row, own, None, None, first, last, None, None))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            columns = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["row", "text_mark", "key", "context", "first", "last", "at", "n"])

    return run


def _held(asked: np.ndarray):
    """``row, text, mark`` to ``row, text`` of the rows that may be asked for."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            kept = batch.filter(pa.array(might_hold(asked, batch.column(2).to_numpy())))
            yield kept.select(["row", "text"])

    return run


def _cut(length: int):
    """Texts with what is wanted of them to contexts, cut at their anchors."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            out: list[tuple] = []
            for text, wanted in zip(batch.column(0), batch.column(1)):
                data = (text.as_py() or "").encode()
                for w in wanted.as_py():
                    first, last, at = w["first"], w["last"], w["at"]
                    if xxhash.xxh3_128_digest(data[first : last + length], seed=at - first) != w["context"]:
                        raise ValueError(_CHANGED)
                    out.append((w["key"], w["context"], at - last, at - first, data[first:at], data[at : last + length], w["n"]))
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]
            columns = list(zip(*out)) or [()] * len(kinds)
            names = ["key", "context", "low", "high", "left", "right", "n"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def equal_offsets(lefts: list[bytes], rights: list[bytes], low: np.ndarray, high: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """``number, from, to``: offsets at which a context's string equals that of another context of the same anchor.

    A context has strings from offset ``low`` to ``high``; its bytes lie left and right of the anchor.
    """
    sides = []
    for strings in (rights, [s[::-1] for s in lefts]):
        order = deep_shallow(strings)
        rank = {s: i for i, (s, _) in enumerate(order)}
        sides.append((np.array([rank[s] for s in strings]), np.array([lcp for _, lcp in order])))
    (right, right_lcp), (left, left_lcp) = sides
    cuts = np.unique(np.concatenate([low, high + 1, length - right_lcp[1:], left_lcp[1:] + 1]))
    cuts = cuts[(cuts >= low.min()) & (cuts <= high.max())]
    ends, found = np.append(cuts[1:] - 1, high.max()), []
    step = max(1, CELLS // len(low))
    for k in range(0, len(cuts), step):
        offset = cuts[k : k + step, None]
        by_right = np.cumsum(right_lcp[None, :] < length - offset, axis=1)[:, right]
        by_left = np.cumsum(left_lcp[None, :] < offset, axis=1)[:, left]
        there = (offset >= low) & (offset <= high)
        label = np.where(there, by_right * (len(low) + 1) + by_left, -1 - np.arange(len(low)))
        order = np.argsort(label, axis=1, kind="stable")
        ranked = np.take_along_axis(label, order, axis=1)
        same = ranked[:, 1:] == ranked[:, :-1]
        edge = np.zeros((len(offset), 1), bool)
        twice = np.zeros(label.shape, bool)
        np.put_along_axis(twice, order, np.concatenate([same, edge], axis=1) | np.concatenate([edge, same], axis=1), axis=1)
        number, span = np.nonzero(twice.T)
        if len(number):
            new = np.concatenate(([True], (number[1:] != number[:-1]) | (span[1:] != span[:-1] + 1)))
            first = np.flatnonzero(new)
            last = np.append(first[1:] - 1, len(number) - 1)
            found += zip(number[first].tolist(), cuts[k + span[first]].tolist(), ends[k + span[last]].tolist())
    return found


def _compared(length: int):
    """Contexts, those of one key after the other, to the offsets that those met once share with others."""

    def run(batches: Iterable) -> Iterator:
        def done() -> None:
            if len(own) > 1:
                low, high = (np.array([r[c] for r in own], np.int64) for c in ("low", "high"))
                for number, start, end in equal_offsets([r["left"] for r in own], [r["right"] for r in own], low, high, length):
                    if own[number]["n"] == 1:
                        out.append((own[number]["context"], own[number]["key"], start, end))

        own: list[dict] = []
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if own and own[-1]["deal"] != row["deal"]:
                    done()
                    own = []
                own.append(row)
            yield _rows(out)
        out = []
        done()
        yield _rows(out)

    def _rows(out: list[tuple]):
        import pyarrow as pa

        kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int32()]
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["context", "key", "low", "high"])

    return run


def _kept(length: int):
    """Documents with ranges of repeated starts to what is left of them."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out: dict[str, list] = {"kept": [], "n_bytes": [], "n_removed": [], "spans": []}
            for text, ranges, text_mark in zip(batch.column(1), batch.column(2), batch.column(3)):
                data, spans = (text.as_py() or "").encode(), []
                if ranges.is_valid:
                    first, last = (ranges.values.field(c).to_numpy() for c in ("first", "last"))
                    if text_mark.as_py() != _text_mark(data):
                        raise ValueError(_CHANGED)
                    start, end = _merged(first, last + length - 1)
                    spans = list(zip(start.tolist(), (end + 1).tolist()))
                edges = [0, *(x for span in spans for x in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out["kept"].append(kept)
                out["n_bytes"].append(len(data))
                out["n_removed"].append(len(data) - len(kept))
                out["spans"].append([{"start": a, "end": b} for a, b in spans])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = {"kept": pa.binary(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "spans": span}
            columns = [batch.column(0), *(pa.array(out[c], k) for c, k in kinds.items())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *kinds])

    return run


def _halves(hot: DataFrame, length: int) -> DataFrame:
    """Contexts of groups that are too large, as two: by the lower and the upper offsets of the group's."""
    middle = F.floor((F.col("from") + F.col("to")) / 2).cast("int")
    bounds = F.array(F.struct(F.col("from"), middle.alias("to")), F.struct((middle + 1).alias("from"), F.col("to")))
    cut = hot.withColumn("half", F.explode(bounds)).withColumn("from", F.col("half.from")).withColumn("to", F.col("half.to"))
    cut = cut.withColumn("low", F.greatest("low", "from")).withColumn("high", F.least("high", "to")).where("low <= high")
    # What all strings of the half's offsets hold, and no more of either side than its strings reach.
    right = F.substring("right", F.lit(1), F.lit(length) - F.col("to"))
    cut = cut.withColumn("deal", F.xxhash64("deal", "from", right, _tail("left", "from")))
    return cut.withColumn("left", _tail("left", "high")).withColumn("right", F.substring("right", F.lit(1), F.lit(length) - F.col("low"))).drop("half")


def _tail(side: str, count: str):
    """The last bytes of a side."""
    return F.expr(f"substring({side}, length({side}) - {count} + 1, {count})")


def _shared_starts(wanted: DataFrame, length: int) -> DataFrame:
    """``context, key, low, high``: offsets at which contexts met once are equal to others of their anchor."""
    width = shuffle_width(wanted.sparkSession)
    rest = wanted.withColumns({"deal": F.col("key"), "from": F.lit(0), "to": F.lit(length - GRAM)})
    parts = []
    while True:
        sizes = rest.groupBy("deal").agg(F.count("*").alias("m"))
        sized = stored(rest.join(sizes.where("m > 1"), "deal"))
        small = sized.where(F.col("m") <= MOST).drop("m", "from", "to")
        dealt = small.repartition(width, "deal").sortWithinPartitions("deal")
        parts.append(dealt.mapInArrow(_compared(length), _FOUND))
        hot = sized.where(F.col("m") > MOST).drop("m")
        # A group of one offset is one string, many times.
        parts.append(hot.where("from = to and n = 1").select("context", "key", "low", "high"))
        hot = hot.where("from < to")
        if hot.isEmpty():
            break
        rest = _halves(hot, length)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


class Repeats:
    """One run over ``docs``: the ranges of starts whose strings of ``length`` bytes are not the only ones."""

    def __init__(self, docs: DataFrame, length: int):
        if length < 2 * GRAM:
            raise ValueError(f"strings must have {2 * GRAM} bytes at least")
        steady_scans(docs)
        self.length = length
        self.texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
        self.anchors = stored(self.texts.select("row", "text").mapInArrow(_surveyed(length), _ANCHORS))

    def ranges(self) -> DataFrame:
        """``row, text_mark, first, last``: starts of a row that are repeated."""
        keyed = self.anchors.where(F.col("key").isNotNull())
        holder = F.min(F.struct("row", "first", "last", "at")).alias("holder")
        counted = keyed.groupBy("key", "context").agg(F.sum("n").alias("n"), holder)
        by_key = counted.groupBy("key").agg(F.count("*").alias("contexts"), F.min("n").alias("least"), F.max("n").alias("most"))
        met = stored(counted.join(by_key.where("contexts > 1 or most > 1"), "key"))
        twice = met.where("n > 1").select("key", "context", F.lit(None).cast("int").alias("low"), F.lit(None).cast("int").alias("high"))
        wanted = self.cut(met.where("contexts > 1 and least = 1").select("key", "context", "n", "holder.*"))
        verdict = twice.unionByName(_shared_starts(wanted, self.length))
        met = self.anchors.where(F.col("key").isNotNull()).join(verdict, ["key", "context"])
        first = F.coalesce(F.col("at") - F.col("high"), "first").alias("first")
        last = F.coalesce(F.col("at") - F.col("low"), "last").alias("last")
        inside = self.anchors.where(F.col("key").isNull()).select("row", "text_mark", "first", "last")
        return met.select("row", "text_mark", first, last).unionByName(inside)

    def cut(self, wanted: DataFrame) -> DataFrame:
        """The contexts, from the texts that hold them."""
        one = F.struct("key", "context", "first", "last", "at", "n")
        by_row = stored(wanted.groupBy("row").agg(F.collect_list(one).alias("wanted")))
        asked = bitmap_of(by_row.select(mark(F.xxhash64("row")).alias("mark")), shuffle_width(wanted.sparkSession))
        texts = self.texts.select("row", "text", F.xxhash64("row").alias("mark")).mapInArrow(_held(asked), "row long, text string")
        return stored(texts.join(by_row, "row").select("text", "wanted").mapInArrow(_cut(self.length), _CUT))

    def kept(self) -> DataFrame:
        ranges = self.ranges().groupBy("row").agg(
            F.collect_list(F.struct("first", "last")).alias("ranges"), F.any_value("text_mark").alias("text_mark")
        )
        joined = self.texts.join(ranges, "row", "left").select("doc_id", "text", "ranges", "text_mark")
        schema = "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>"
        return joined.mapInArrow(_kept(self.length), schema)


def without_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """Per document ``doc_id, kept, n_bytes, n_removed, spans``: its UTF-8 bytes without those that repeats cover.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else too, in the same text or another;
    strings are judged on the texts as they came and never cross texts. ``kept`` is what remains, joined (it may cut a
    character), ``spans`` the removed runs, as long as they go, in bytes. A null text is empty; texts shorter than
    ``length`` stay whole. Repeated rows are copies of each other, so both lose what they share. A null ``doc_id`` stays
    null. Other columns are not read; ``docs`` must give the same rows when read again (a text that differs raises).
    """
    prepare(docs.sparkSession)
    return Repeats(docs, length).kept()


def digests(docs: DataFrame, length: int = 400) -> DataFrame:
    """:func:`without_repeats` with the number of spans and the SHA-256 of the bytes kept."""
    found = without_repeats(docs, length)
    n_spans, kept = F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", "n_removed", n_spans, kept)


#: The query's result for SQL: every string of 400 bytes, two hexadecimal digits a byte, by its hash.
SQL = r"""
with docs as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as hx from documents),
starts as (
    select r, s, hash(substr(hx, 2 * s + 1, 800)) as h
    from (select r, hx, unnest(range(0, len(hx) // 2 - 399)) as s from docs where len(hx) >= 800)),
repeated as (select r, s from starts where h in (select h from starts group by h having count(*) > 1)),
runs as (
    select r, s, sum(case when s <= before + 400 then 0 else 1 end) over (partition by r order by s) as run
    from (select r, s, lag(s) over (partition by r order by s) as before from repeated)),
spans as (select r, min(s) as a, max(s) + 400 as b from runs group by r, run),
edged as (select r, a, b, lag(b, 1, 0) over (partition by r order by a) as before from spans),
kept as (
    select r, sum(b - a) as n_removed, count(*) as n_spans, max(b) as last,
           string_agg(substr(hx, 2 * before + 1, 2 * (a - before)), '' order by a) as head
    from edged join docs using (r) group by r)
select doc_id, cast(len(hx) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
       cast(coalesce(n_spans, 0) as bigint) as n_spans,
       sha256(unhex(coalesce(head, '') || substr(hx, 2 * coalesce(last, 0) + 1))) as kept_sha256
from docs left join kept using (r)
"""
