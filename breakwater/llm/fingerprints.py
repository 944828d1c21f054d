"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph (a line) is hashed into two wide vectors, a fingerprint is their sum over the paragraphs:
  ``EXACT`` lanes modulo 2^64, cut from one long digest of the paragraph. Equal multisets of paragraphs give
  equal sums, whatever their order; anything else collides only by the chance of the digest.
  ``SOFT`` lanes modulo 2^40, which no text's number of runs reaches, in which every run of two words of the paragraph adds +1 or -1. Products of two
  such sums estimate how many runs two documents share, with a relative error of about 1 / sqrt(SOFT).
Sums only need adding: a paragraph is inserted by adding its vectors and deleted by subtracting them, and
fingerprints of parts add up to the fingerprint of the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breakwater.llm.common import shuffle_width
from breakwater.llm.words import WordNumbers, mixed, shingles, split_words

# Parameters: lanes of each kind, bits of a soft lane, words of a run.
EXACT, SOFT, SOFT_BITS, RUN = 8, 128, 40, 2
_TURNS = np.arange(1, SOFT // 64 + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)


class Fingerprint:
    """The two sums. ``+`` and ``-`` insert and delete whole documents or paragraphs."""

    __slots__ = ("exact", "soft")

    def __init__(self, exact: np.ndarray | None = None, soft: np.ndarray | None = None):
        self.exact = np.zeros(EXACT, np.uint64) if exact is None else exact
        self.soft = np.zeros(SOFT, np.int64) if soft is None else soft

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, _wrapped(self.soft + other.soft))

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, _wrapped(self.soft - other.soft))

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and bool((self.exact == other.exact).all() and (self.soft == other.soft).all())

    __hash__ = None

    def text(self) -> str:
        """Hexadecimal digits: the exact lanes, then the soft ones."""
        soft = (self.soft & ((1 << SOFT_BITS) - 1)).tolist()
        return self.exact.astype(">u8").tobytes().hex() + "".join([f"{v:0{SOFT_BITS // 4}x}" for v in soft])

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        cut, digits = EXACT * 16, SOFT_BITS // 4
        exact = np.frombuffer(bytes.fromhex(text[:cut]), ">u8").astype(np.uint64)
        return cls(exact, _wrapped(np.array([int(text[i : i + digits], 16) for i in range(cut, len(text), digits)], np.int64)))

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal multisets, else the shared part of the larger one, between 0 and 1."""
        if self == other:
            return 1.0
        a, b = self.soft.astype(np.float64), other.soft.astype(np.float64)
        larger = max(float(a @ a), float(b @ b))
        return min(1.0, max(0.0, float(a @ b) / larger)) if larger else 0.0


def _wrapped(soft: np.ndarray) -> np.ndarray:
    """Into the signed range of a soft lane."""
    half = 1 << (SOFT_BITS - 1)
    return ((soft + half) & ((1 << SOFT_BITS) - 1)) - half


def _soft_sum(runs: np.ndarray) -> np.ndarray:
    """Sum of the signs of all runs, lane by lane; a long text is summed in slices."""
    ones = np.zeros(SOFT, np.int64)
    for begin in range(0, len(runs), 4096):
        part = runs[begin : begin + 4096]
        bits = mixed(part[:, None] + _TURNS)
        ones += np.unpackbits(bits.view(np.uint8), axis=1).sum(axis=0, dtype=np.int32)
    return 2 * ones - len(runs)


def _runs(paragraphs: list[str], numbers: WordNumbers) -> np.ndarray:
    """Hashes of all runs of words, none across two paragraphs; a paragraph shorter than a run is one run."""
    words = [split_words(p) for p in paragraphs]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    whole = numbers.of(list(chain.from_iterable(words)))
    owner = np.repeat(np.arange(len(words)), sizes)
    found = shingles(whole, RUN)[owner[: len(whole) - RUN + 1] == owner[RUN - 1 :]] if len(whole) >= RUN else whole[:0]
    ends = np.cumsum(sizes)
    short = [shingles(whole[ends[i] - sizes[i] : ends[i]], RUN) for i in np.flatnonzero((sizes > 0) & (sizes < RUN))]
    return np.concatenate([found, *short])


def fingerprint(text: str, numbers: WordNumbers) -> Fingerprint:
    """Of a whole text; an empty one has one empty paragraph, a null one counts as empty."""
    paragraphs = text.split("\n")
    digests = [hashlib.blake2b(p.encode(), digest_size=8 * EXACT, person=b"paragraph").digest() for p in paragraphs]
    exact = np.frombuffer(b"".join(digests), "<u8").reshape(-1, EXACT).sum(axis=0, dtype=np.uint64)
    return Fingerprint(exact, _wrapped(_soft_sum(_runs(paragraphs, numbers))))


def added(docs: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a string; equal texts get equal ones."""

    @F.arrow_udf("string")
    def prints(batch):
        import pyarrow as pa

        numbers = WordNumbers()
        return pa.array([fingerprint(t, numbers).text() for t in batch.fill_null("").to_pylist()], pa.string())

    return docs.withColumn(into, prints(F.col(text)))


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by the first as many characters of the text that follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_PAIRS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(batches: Iterable) -> Iterator:
    """Rows in the order of ``_in_order``: every row is held until the one after it has come."""
    import pyarrow as pa

    numbers, held = WordNumbers(), None
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(4)]
        rows = []
        for part, doc_id, text, closing in zip(*columns):
            own = fingerprint(text, numbers)
            if held is not None and held[0] == part:
                _, before_id, before, print_before = held
                changed = edited(before, text)
                other = fingerprint(changed, numbers)
                rows.append((
                    before_id, len(before), hashlib.sha256(changed.encode()).hexdigest(), print_before.text(), other.text(),
                    print_before.likeness(other), print_before.likeness(own),
                ))
            # A closing row is the first of the next part, there only to complete the last row of this one.
            held = None if closing else (part, doc_id, text, own)
        names = [field.split()[0] for field in _PAIRS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        found = list(zip(*rows)) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(found, kinds)], names)


def _rank(doc_id: Column) -> Column:
    """A number that rises in the order: the greatest id first, nulls last."""
    return F.coalesce(-1 - doc_id, F.lit((1 << 63) - 1))


def _breaks(keys: DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys at which the parts of the order begin: at most ``parts``, from ranks and digests alone.

    Found by range-partitioning the keys; what reaches the driver is one key for each part.
    """
    dealt = keys.repartitionByRange(parts, "rank", "h").withColumn("part", F.spark_partition_id())
    found = dealt.groupBy("part").agg(F.min(F.struct("rank", "h")).alias("key")).orderBy("part").collect()
    return np.array([r.key.rank for r in found], np.int64), np.array([r.key.h for r in found], np.int64)


def followed(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, and that of its text edited with the document that follows.

    The order is by ``doc_id`` from the greatest, nulls last, then by a digest of the text; the first follows
    the last. Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. A null text counts as empty; rows alike in id and text follow each other; one row follows
    itself. Texts are shuffled once, into the parts of the order; the first row of a part goes to the part
    before it as well. A task holds two texts and a batch, however many rows its part has.
    """
    parts = shuffle_width(docs.sparkSession)
    own = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), _rank(F.col("doc_id")).alias("rank")
    ).withColumn("h", F.xxhash64("text"))
    ranks, digests = _breaks(own.select("rank", "h"), parts)
    count = len(ranks)

    @F.arrow_udf("struct<part:int,first:boolean>")
    def placed(rank, h):
        import pyarrow as pa

        rank, digest = rank.to_numpy(), h.to_numpy()
        low, high = np.searchsorted(ranks, rank, "left"), np.searchsorted(ranks, rank, "right")
        part, first = low - 1, np.zeros(len(rank), bool)
        for i in np.flatnonzero(high > low):  # a part begins at this very rank
            part[i] = low[i] - 1 + np.searchsorted(digests[low[i] : high[i]], digest[i], "right")
            first[i] = part[i] >= low[i] and digests[part[i]] == digest[i]
        return pa.StructArray.from_arrays([pa.array(part.astype(np.int32)), pa.array(first)], ["part", "first"])

    at = own.withColumn("at", placed("rank", "h"))
    here = F.struct(F.col("at.part").alias("part"), F.lit(False).alias("closing"))
    before = F.struct(F.pmod(F.col("at.part") + F.lit(count - 1), F.lit(max(1, count))).alias("part"), F.lit(True).alias("closing"))
    doubled = at.select("doc_id", "text", "rank", "h", F.explode(F.when(F.col("at.first"), F.array(here, before)).otherwise(F.array(here))).alias("to"))
    ordered = (
        doubled.select("to.part", "doc_id", "text", "to.closing", "rank", "h")
        .repartitionById(max(1, count), F.col("part"))
        .sortWithinPartitions("part", "closing", "rank", "h")
    )
    return ordered.select("part", "doc_id", "text", "closing").mapInArrow(_compared, _PAIRS)
