"""Language-model scores by context-tree weighting over bytes, in binary decomposition.

A text counts as its words in lower case, one blank between two, and an end symbol. Each byte is eight binary
decisions; every decision has a node in the context of each depth from 0 to ``DEPTH`` preceding bytes, with
a Krichevsky-Trofimov estimate from the training counts. A node weighs "stop here" against "go one byte
deeper" by how well either codes the training texts, so a prediction mixes the estimates of all depths. A node
without counts predicts as the node above it. The score is the log10 probability of the text.

Work is spread by contexts and by blocks of documents (the partitions of the scan):
  1. every task counts the grams (context and byte) and words of its training texts and deals them to buckets;
  2. a bucket adds up counts and weights the deeper part of its subtrees; only the sums for nodes of depth 2, at
     most 2^24 whatever the corpus, meet on the driver, where the tree is finished and handed to all tasks;
  3. every block asks for the distinct grams and words it holds, the buckets answer with log probabilities and
     counts, and the block's documents look theirs up. Texts move once, to meet their block's answers.
Buckets and blocks hold distinct grams, never texts; documents stream past them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breakwater.llm.common import shuffle_width, steady_scans, stored
from breakwater.llm.words import split_words

# Parameters: bytes of context; bytes joined before their grams are counted; distinct grams or words held by a
# task before it hands them on. None of the bounds changes a result. A gram and a byte beside it fill 64 bits.
DEPTH, SLICE, HELD = 6, 1_500_000, 2_000_000
# The byte that ends a text and precedes it (no UTF-8 text has it), the end among the words, the
# depth whose sums meet on the driver, and which documents are held out.
END, END_WORD, SHARED = 0xFF, b"\n", 2
FOLDS, HELD_FOLD = 7, 2
GRAMS, WORDS = 0, 1


def held_out(doc_id: Column) -> Column:
    """Whether a document is scored only; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_FOLD


# -- grams ------------------------------------------------------------------------------------------------------


def grams(texts: list[bytes]) -> np.ndarray:
    """All grams of some texts: nearest byte of context on top, then the farther ones, the byte itself last."""
    pad = bytes([END]) * DEPTH
    joined = np.frombuffer(b"".join([pad + t + pad[:1] for t in texts]) + bytes(8), np.uint8)
    sizes = np.fromiter((len(t) + DEPTH + 1 for t in texts), np.int64, len(texts))
    # Eight bytes from every place on, as one number whose higher bytes come later in the text.
    ahead = np.ndarray(len(joined) - 8, "<u8", joined, strides=(1,))
    context, byte = ahead & np.uint64((1 << 8 * DEPTH) - 1), ahead >> np.uint64(8 * DEPTH) & np.uint64(0xFF)
    counted = np.ones(len(ahead), bool)
    counted[((np.cumsum(sizes) - DEPTH)[:, None] + np.arange(DEPTH)).ravel()] = False  # would reach past a text's end
    return (context << np.uint64(8) | byte)[counted]


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[begins], np.add.reduceat(counts, begins) if len(begins) else counts


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Grams that share their three nearest context bytes share a bucket."""
    near = (keys >> np.uint64(8 * (DEPTH - 2))) * np.uint64(0x9E3779B97F4A7C15)
    return ((near >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


# -- packing ----------------------------------------------------------------------------------------------------


def _pack(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.compress(values.tobytes(), 1)


def _unpack(packed: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.decompress(packed), kind)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Rising keys as differences, their bytes plane by plane."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return _pack(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T))


def _unpack_keys(packed: bytes) -> np.ndarray:
    planes = _unpack(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _pack_words(words: list[bytes]) -> bytes:
    import zstandard

    return zstandard.compress(b" ".join(words), 1)


def _unpack_words(packed: bytes) -> list[bytes]:
    import zstandard

    return zstandard.decompress(packed).split(b" ")


# -- the tree ---------------------------------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    z = x + 7.0
    series = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    product = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6)
    return series - np.log(product)


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


class Level(NamedTuple):
    """Nodes of one depth, by rising ``context << 8 | node``."""

    keys: np.ndarray
    one: np.ndarray  # estimate that the bit is set
    stop: np.ndarray  # weight of stopping here
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray  # log of the weighted probability


def _nodes(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of all eight bits from ``context << 8 | byte``, with their zeros and ones."""
    found = []
    for bit in range(8):
        prefix = keys >> np.uint64(8 - bit)
        begins = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))
        ones = np.add.reduceat(np.where(keys >> np.uint64(7 - bit) & np.uint64(1), counts, 0), begins)
        total = np.add.reduceat(counts, begins)
        context, upper = keys[begins] >> np.uint64(8), prefix[begins] & np.uint64((1 << bit) - 1)
        found.append((context << np.uint64(8) | np.uint64(1 << bit) | upper, total - ones, ones))
    keys, zeros, ones = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(keys)
    return keys[order], zeros[order], ones[order]


def _above(keys: np.ndarray) -> np.ndarray:
    """The same node or byte one byte of context less."""
    return keys >> np.uint64(16) << np.uint64(8) | keys & np.uint64(0xFF)


def level(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, deeper: np.ndarray | None) -> Level:
    """``deeper``: summed logs of the weighted probabilities one byte deeper; None at the full depth."""
    here = estimate(zeros, ones)
    weighted = here if deeper is None else np.logaddexp(here, deeper) - math.log(2)
    stop = np.ones(len(keys)) if deeper is None else np.exp(here - math.log(2) - weighted)
    return Level(keys, (ones + 0.5) / (zeros + ones + 1.0), stop, zeros, ones, weighted)


def subtrees(keys: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels from ``DEPTH`` to one below ``SHARED``."""
    levels: list[Level] = []
    for depth in range(DEPTH, SHARED, -1):
        nodes, zeros, ones = _nodes(keys, counts)
        deeper = None
        if levels:
            deeper = np.bincount(np.searchsorted(nodes, _above(levels[-1].keys)), levels[-1].weighted, len(nodes))
        levels.append(level(nodes, zeros, ones, deeper))
        if depth > SHARED + 1:
            keys, counts = _merged(_above(keys), counts)
    return levels


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return at, (keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool))


_NO_LEVELS = [level(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), None)] * (DEPTH - SHARED)


class Top(NamedTuple):
    """Depths 0 to ``SHARED`` as ``P = part + rest * deeper``; ``alone`` where nothing deeper is known."""

    keys: np.ndarray
    part: np.ndarray
    rest: np.ndarray
    alone: np.ndarray


def top_levels(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, deeper: np.ndarray) -> list[Top]:
    """From the nodes of depth ``SHARED`` and what lies below them, the upper levels from the root down."""
    levels = [level(keys, zeros, ones, deeper)]
    for _ in range(SHARED):
        last = levels[-1]
        above, owner = np.unique(_above(last.keys), return_inverse=True)
        zeros, ones, deeper = (np.bincount(owner, x, len(above)) for x in (last.zeros, last.ones, last.weighted))
        levels.append(level(above, zeros, ones, deeper))
    tops: list[Top] = []
    for found in reversed(levels):
        part, rest = np.zeros(len(found.keys)), np.ones(len(found.keys))
        if tops:
            at, _ = _find(tops[-1].keys, _above(found.keys))
            part, rest = tops[-1].part[at], tops[-1].rest[at]
        tops.append(Top(found.keys, part + rest * found.stop * found.one, rest * (1 - found.stop), part + rest * found.one))
    return tops


def log_probabilities(wanted: np.ndarray, levels: list[Level], tops: list[Top]) -> np.ndarray:
    """log10 of the probability of the byte of each gram in its context."""
    total = np.zeros(len(wanted))
    byte = wanted & np.uint64(0xFF)
    for bit in range(8):
        node = np.uint64(1 << bit) | byte >> np.uint64(8 - bit)
        key = wanted & ~np.uint64(0xFF) | node
        p, known = np.full(len(wanted), 0.5), np.zeros(len(wanted), bool)
        for found in levels:
            at, seen = _find(found.keys, key)
            if len(found.keys):
                mix = np.where(known, found.stop[at] * found.one[at] + (1 - found.stop[at]) * p, found.one[at])
                p = np.where(seen, mix, p)
            known |= seen
            key = _above(key)
        done = np.zeros(len(wanted), bool)
        for top in reversed(tops):
            at, seen = _find(top.keys, key)
            if len(top.keys):
                now = np.where(known, top.part[at] + top.rest[at] * p, top.alone[at])
                p = np.where(seen & ~done, now, p)
            done |= seen
            key = _above(key)
        total += np.log10(np.where(byte >> np.uint64(7 - bit) & np.uint64(1), p, 1 - p))
    return total


# -- tasks ------------------------------------------------------------------------------------------------------


class _Held:
    """Distinct grams and words of a task with their counts."""

    def __init__(self):
        self.words: Counter = Counter()
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[bytes] = []
        self.bytes = 0

    def add(self, text: str) -> None:
        words = split_words(text, lower=True)
        self.words.update(words)
        self.words[END_WORD] += 1
        joined = b" ".join(words)
        self.waiting.append(joined)
        self.bytes += len(joined) + DEPTH + 1
        if self.bytes > SLICE:
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            keys, counts = np.unique(grams(self.waiting), return_counts=True)
            self.keys, self.counts = _merged(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
            self.waiting, self.bytes = [], 0

    def full(self) -> bool:
        return len(self.keys) > HELD or len(self.words) > HELD

    def rows(self, buckets: int) -> Iterator[tuple]:
        """``kind, bucket, keys, counts``, then forget everything."""
        import xxhash

        self.settle()
        owner = _bucket(self.keys, buckets)
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(buckets + 1))
        for b in range(buckets):
            mine = order[bounds[b] : bounds[b + 1]]
            if len(mine):
                yield GRAMS, b, _pack_keys(self.keys[mine]), _pack(self.counts[mine])
        dealt: dict[int, list[bytes]] = {}
        for word in self.words:
            dealt.setdefault(xxhash.xxh64_intdigest(word) % buckets, []).append(word)
        for b, words in dealt.items():
            yield WORDS, b, _pack_words(words), _pack(np.array([self.words[w] for w in words], np.int64))
        self.__init__()


_DEALT = "block int, kind int, bucket int, keys binary, counts binary"


def _rows(rows: list[tuple], schema: str):
    import pyarrow as pa

    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    names = [f.split()[0] for f in schema.split(", ")]
    types = [kinds[f.split()[1]] for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _deal(buckets: int):
    """Rows of ``block, text``, a task holding one block, to that block's distinct grams and words."""

    def run(batches: Iterable) -> Iterator:
        held, block = _Held(), 0
        for batch in batches:
            numbers, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                block = numbers[i].as_py()
                held.add(texts[i].as_py())
                if held.full():
                    yield from (_rows([(block, *row)], _DEALT) for row in held.rows(buckets))
        yield from (_rows([(block, *row)], _DEALT) for row in held.rows(buckets))

    return run


_MODEL = "kind int, bucket int, keys binary, counts binary, tokens long, distinct long, shared binary, zeros binary, ones binary, deeper binary"


def _add_up(batches: Iterable) -> Iterator:
    """A bucket's rows, one kind and bucket after the other, to its part of the model."""
    at, keys, counts, words = None, [], [], Counter()

    def done():
        if at is None:
            return
        kind, bucket = at
        if kind == WORDS:
            yield _rows([(kind, bucket, _pack_words(list(words)), _pack(np.array(list(words.values()), np.int64)),
                          sum(words.values()), len(words), None, None, None, None)], _MODEL)
            return
        own, sums = _merged(np.concatenate(keys), np.concatenate(counts))
        last = subtrees(own, sums)[-1]
        shared, owner = np.unique(_above(last.keys), return_inverse=True)
        zeros, ones, deeper = (np.bincount(owner, x, len(shared)) for x in (last.zeros, last.ones, last.weighted))
        yield _rows([(kind, bucket, _pack_keys(own), _pack(sums), 0, 0, shared.tobytes(), zeros.tobytes(), ones.tobytes(),
                      deeper.tobytes())], _MODEL)

    for batch in batches:
        for row in batch.to_pylist():
            if at != (row["kind"], row["bucket"]):
                yield from done()
                at, keys, counts, words = (row["kind"], row["bucket"]), [], [], Counter()
            amounts = _unpack(row["counts"], np.int64)
            if row["kind"] == WORDS:
                words.update(dict(zip(_unpack_words(row["keys"]), amounts.tolist())))
            else:
                keys.append(_unpack_keys(row["keys"]))
                counts.append(amounts)
                if sum(map(len, keys[1:])) > HELD:
                    own, sums = _merged(np.concatenate(keys), np.concatenate(counts))
                    keys, counts = [own], [sums]
    yield from done()


_ANSWER = "block int, kind int, keys binary, values binary"


def _answer(tops: list[Top]):
    """A bucket's model row, then the blocks' questions, to log probabilities and counts."""

    def run(batches: Iterable) -> Iterator:
        at, known, values, levels, words = None, np.zeros(0, np.uint64), np.zeros(0), _NO_LEVELS, {}
        for batch in batches:
            for row in batch.to_pylist():
                if at != (row["kind"], row["bucket"]):
                    at, known, values, levels, words = (row["kind"], row["bucket"]), known[:0], values[:0], _NO_LEVELS, {}
                if row["block"] < 0:
                    amounts = _unpack(row["counts"], np.int64)
                    if row["kind"] == WORDS:
                        words = dict(zip(_unpack_words(row["keys"]), amounts.tolist()))
                    else:
                        known = _unpack_keys(row["keys"])
                        levels = subtrees(known, amounts)
                        values = log_probabilities(known, levels, tops)
                elif row["kind"] == WORDS:
                    asked = _unpack_words(row["keys"])
                    found = np.array([words.get(w, 0) for w in asked], np.int64)
                    yield _rows([(row["block"], WORDS, row["keys"], _pack(found))], _ANSWER)
                else:
                    asked = _unpack_keys(row["keys"])
                    place, seen = _find(known, asked)
                    found = values[place] if len(values) else np.zeros(len(asked))
                    found[~seen] = log_probabilities(asked[~seen], levels, tops)
                    yield _rows([(row["block"], GRAMS, row["keys"], _pack(found.astype(np.float32)))], _ANSWER)

    return run


_SCORES = "doc_id long, n_tokens long, n_known long, n_bytes long, known_log double, score double"


def _looked_up(docs: list[tuple[int | None, list[bytes]]], words: dict[bytes, int], known: np.ndarray, logs: np.ndarray) -> list[tuple]:
    """Scores of up to 256 documents. Their grams are sorted together, each with its document in the low byte."""
    if not docs:
        return []
    joined = [b" ".join(tokens) for _, tokens in docs]
    owner = np.repeat(np.arange(len(docs), dtype=np.uint64), [len(j) + 1 for j in joined])
    asked = np.sort(grams(joined) << np.uint64(8) | owner)
    owner, asked = (asked & np.uint64(0xFF)).astype(np.int64), asked >> np.uint64(8)
    begins = np.flatnonzero(np.concatenate(([True], asked[1:] != asked[:-1])))
    at, seen = _find(known, asked[begins])
    if not seen.all():
        raise ValueError("a block has other documents than before; store the documents first")
    found = np.bincount(owner, np.repeat(logs[at], np.diff(begins, append=len(asked))), len(docs))
    rows = []
    for (doc_id, tokens), text, score in zip(docs, joined, found.tolist()):
        tokens.append(END_WORD)
        counts = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
        rows.append((doc_id, len(tokens), int((counts > 0).sum()), len(text) + 1, float(np.log10(counts + 1.0).sum()), score))
    return rows


def _score(batches: Iterable) -> Iterator:
    """A block's answers, then its documents one by one."""
    block, keys, values, words, ready = None, [], [], {}, False
    known = logs = np.zeros(0)
    waiting: list[tuple[int | None, list[bytes]]] = []
    size = 0
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if row["block"] != block:
                rows += _looked_up(waiting, words, known, logs)
                waiting, size = [], 0
                block, keys, values, words, ready = row["block"], [], [], {}, False
            if row["kind"] == GRAMS:
                keys.append(_unpack_keys(row["keys"]))
                values.append(_unpack(row["values"], np.float32))
            elif row["kind"] == WORDS:
                words.update(zip(_unpack_words(row["keys"]), _unpack(row["values"], np.int64).tolist()))
            else:
                if not ready:
                    known, logs = np.concatenate(keys), np.concatenate(values)
                    order = np.argsort(known)
                    known, logs, ready = known[order], logs[order].astype(np.float64), True
                    keys = values = []
                waiting.append((row["doc_id"], split_words(row["text"], lower=True)))
                size += len(row["text"])
                if len(waiting) == 256 or size > SLICE:
                    rows += _looked_up(waiting, words, known, logs)
                    waiting, size = [], 0
        yield _rows(rows, _SCORES)
    yield _rows(_looked_up(waiting, words, known, logs), _SCORES)


# -- the operator -----------------------------------------------------------------------------------------------


def _blocks(docs: DataFrame) -> DataFrame:
    """``block, doc_id, text, held``: a block is a partition of the scan."""
    return docs.select(
        F.spark_partition_id().alias("block"), "doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held")
    )


def scores(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    ``base_score`` is the add-one unigram score of the same tokens. Null and empty texts are an end symbol; a
    null id belongs to the training texts; repeated rows count each time they occur. Without any training text
    the counts are 0 and every decision is even. ``docs`` must give the same partitions when read again, as files
    do; where they might not, store them first.
    """
    steady_scans(docs)
    buckets = shuffle_width(docs.sparkSession)
    own = _blocks(docs)
    to_bucket = F.col("kind") * F.lit(buckets) + F.col("bucket")
    training = own.where("not held").select("block", "text").mapInArrow(_deal(buckets), _DEALT)
    model = stored(
        training.select("kind", "bucket", "keys", "counts").repartitionById(2 * buckets, to_bucket).mapInArrow(_add_up, _MODEL)
    )
    totals = model.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("v")).first()
    tops = _tops(model)
    asked = own.select("block", "text").mapInArrow(_deal(buckets), _DEALT)
    told = model.select(F.lit(-1).alias("block"), "kind", "bucket", "keys", "counts").unionByName(asked)
    answers = (
        told.repartitionById(2 * buckets, to_bucket).sortWithinPartitions("kind", "bucket", "block").mapInArrow(_answer(tops), _ANSWER)
    )
    none = [F.lit(None).cast("binary").alias(c) for c in ("keys", "values")]
    texts = own.select("block", F.lit(2).alias("kind"), *none, "doc_id", "text")
    met = answers.select("*", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text")).unionByName(texts)
    count = max(1, docs.rdd.getNumPartitions())
    scored = met.repartitionById(count, F.pmod("block", F.lit(count))).sortWithinPartitions("block", "kind").mapInArrow(_score, _SCORES)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(totals.n).cast("long").alias("train_tokens"),
        (F.col("known_log") - F.col("n_tokens") * F.lit(math.log10(totals.n + totals.v + 1))).alias("base_score"),
        "score",
        (-F.col("score") / F.lit(math.log10(2)) / F.col("n_bytes")).alias("bits_per_byte"),
    )


_SUMS = "key long, zeros double, ones double, deeper double"


def _unfold(batches: Iterable) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            parts = [np.frombuffer(row["shared"], np.uint64).astype(np.int64)]
            parts += [np.frombuffer(row[c], np.float64) for c in ("zeros", "ones", "deeper")]
            yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], ["key", "zeros", "ones", "deeper"])


def _tops(model: DataFrame) -> list[Top]:
    """The upper levels, from at most 2^24 summed nodes."""
    parts = model.where(F.col("kind") == GRAMS).select("shared", "zeros", "ones", "deeper").mapInArrow(_unfold, _SUMS)
    sums = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "deeper")]).toArrow().sort_by("key")
    keys, *rest = [sums.column(i).to_numpy() for i in range(4)]
    return top_levels(keys.astype(np.uint64), *rest)
