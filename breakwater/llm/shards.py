"""Shards from a k-d tree: split at weighted medians along the widest metadata dimension.

Every row is a point of integer dimensions in 0 .. 2^32-1 and weighs its bytes. A node that stands for k shards
is cut along its widest dimension (largest distance between its least and greatest value, as a share of that
distance over all rows) where ``floor(k/2)/k`` of its weight lies below, until every node stands for one shard,
which then holds the target bytes. Rows that agree in a dimension are ordered by group, then by row, so a
dimension on which a third of all rows agree still gets cut in the right place, and a group is divided only
where a cut falls inside one that weighs more than ``TOLERANCE`` of a shard.

A cut is found by narrowing: weights are summed by the leading digits of the key, the digit in which the cut
falls is opened, and so on until what straddles it weighs at most that share. Each round is one aggregation whose
result has at most ``2^DIGIT_BITS`` rows for each node, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from breakwater.llm.common import stored

# Parameters: bits of a key looked at in one round, and the share of a shard that a cut may leave undivided.
DIGIT_BITS, TOLERANCE = 10, 0.004
# A key has the value of a dimension, a digest of the group and a digest of the row, from the top.
_VALUE_BITS, _GROUP_BITS, _ROW_BITS = 32, 14, 14
_KEY_BITS = _VALUE_BITS + _GROUP_BITS + _ROW_BITS


def text_size(text: Column) -> Column:
    """Bytes of the text plus one; a null text has one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc32(text: Column) -> Column:
    """CRC-32 of the text's UTF-8 bytes; of nothing for a null text."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def _digest(bits: int, *values: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*values), 64 - bits)


def hashed(value: Column) -> Column:
    """Any value, null too, as a point of a dimension."""
    return _digest(_VALUE_BITS, value)


def logarithm(value: Column) -> Column:
    """A positive number as a point of a dimension, doublings evenly spaced."""
    return F.least(F.lit(2.0**32 - 1), F.log2(F.greatest(value, F.lit(1))) * 2.0**26).cast("long")


def _of_node(values: dict[int, int], node: str) -> Column:
    """What belongs to a row's node, out of constants."""
    return F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in sorted(values.items()) for x in pair]), F.col(node).cast("long"))


def _key(axis: dict[int, int], dimensions: Sequence[str], node: str, group: str, row: str) -> Column:
    """The place of a row along the widest dimension of its node."""
    chosen = _of_node(axis, node)
    value = reduce(
        lambda other, i: F.when(chosen == i, F.col(dimensions[i])).otherwise(other), sorted(set(axis.values())), F.lit(None).cast("long")
    )
    tail = F.shiftleft(_digest(_GROUP_BITS, F.col(group)), _ROW_BITS).bitwiseOR(_digest(_ROW_BITS, F.col(row)))
    return F.shiftleft(value, _GROUP_BITS + _ROW_BITS).bitwiseOR(tail)


def split(
    rows: DataFrame, dimensions: Sequence[str], weight: str, shards: int, group: str, row: str, into: str = "shard"
) -> DataFrame:
    """``rows`` with a column ``into`` from 0 to ``shards - 1``, the leaves of the tree.

    The rows are stored once for each level of the tree and read a few times there, so hand over narrow ones.
    Dimensions are integers in 0 .. 2^32-1, without nulls. ``group`` keeps rows together, ``row`` tells them
    apart. An empty table gives an empty result; with fewer rows than shards some shards stay empty.
    """
    if shards < 1:
        raise ValueError("shards is at least 1")
    ends = rows.agg(*[f(d).alias(f"{f.__name__}{i}") for i, d in enumerate(dimensions) for f in (F.min, F.max)]).first()
    scale = [max(1, (ends[f"max{i}"] or 0) - (ends[f"min{i}"] or 0)) for i in range(len(dimensions))]
    # A node is named by the first shard it stands for; ``counts`` has how many those are.
    counts, placed = {0: shards}, rows.withColumn(into, F.lit(0))
    while True:
        inner = {n: k for n, k in counts.items() if k > 1}
        wide = placed.where(F.col(into).isin(list(inner)))
        axis = _widest(wide, dimensions, into, scale) if inner else {}
        if not axis:
            return placed
        keyed = placed.withColumn("_key", _key(axis, dimensions, into, group, row))
        cuts = _cuts(keyed.select(F.col(into).alias("node"), F.col(weight).alias("w"), F.col("_key").alias("key")), axis, counts)
        upper = {n: n + counts[n] // 2 for n in axis}
        above = F.col("_key") >= _of_node(cuts, into)
        placed = stored(keyed.withColumn(into, F.when(above, _of_node(upper, into).cast("int")).otherwise(F.col(into))).drop("_key"))
        for n in axis:
            counts[upper[n]], counts[n] = counts[n] - counts[n] // 2, counts[n] // 2
        counts = {n: 1 if n in inner and n not in axis else k for n, k in counts.items()}  # nodes without rows


def _widest(rows: DataFrame, dimensions: Sequence[str], into: str, scale: list[int]) -> dict[int, int]:
    """The widest dimension of every node that has rows."""
    spreads = rows.groupBy(into).agg(*[(F.max(d) - F.min(d)).alias(f"d{i}") for i, d in enumerate(dimensions)])
    return {r[into]: max(range(len(dimensions)), key=lambda i: (r[f"d{i}"] / scale[i], -i)) for r in spreads.collect()}


def _cuts(keyed: DataFrame, axis: dict[int, int], counts: dict[int, int]) -> dict[int, int]:
    """For every node the key at which its upper part begins."""
    cuts: dict[int, int] = {}
    opened = dict.fromkeys(axis, 0)  # the digits found so far, and the weight of all keys below them
    below = dict.fromkeys(axis, 0)
    goal: dict[int, float] = {}
    slack: dict[int, float] = {}
    for shift in range(_KEY_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        waiting = [n for n in axis if n not in cuts]
        if not waiting:
            break
        rows = keyed.where(F.col("node").isin(waiting))
        if goal:
            rows = rows.where(F.shiftrightunsigned("key", shift + DIGIT_BITS) == _of_node({n: opened[n] for n in waiting}, "node"))
        sums = rows.groupBy("node", F.shiftrightunsigned("key", shift).alias("digit")).agg(F.sum("w").alias("w"))
        digits: dict[int, list[tuple[int, int]]] = {n: [] for n in waiting}
        for r in sums.collect():
            digits[r["node"]].append((r["digit"], r["w"]))
        for n in waiting:
            if n not in goal:
                total = sum(w for _, w in digits[n])
                goal[n], slack[n] = total * (counts[n] // 2) / counts[n], total / counts[n] * TOLERANCE
            ordered = sorted(digits[n])
            for digit, w in ordered:
                if below[n] + w >= goal[n] or digit == ordered[-1][0]:
                    break
                below[n] += w
            opened[n] = digit
            if w <= slack[n] or shift == 0:
                over = below[n] + w - goal[n]
                cuts[n] = (digit if goal[n] - below[n] <= over else digit + 1) << shift
    return cuts


def numbered(rows: DataFrame, shard: str, part: str, place: str, slot: str = "slot") -> DataFrame:
    """Number the rows of every shard from 0 without a gap.

    ``part`` and ``place`` say where a row lies. Counts by shard and part give each part its first number, and
    rows are ranked inside one part, so no task sees a whole shard.
    """
    within = Window.partitionBy(shard, part)
    earlier = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(shard, part).agg(F.count("*").alias("_n"))
    firsts = counts.select(shard, part, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    ranked = rows.withColumn("_rank", F.row_number().over(within.orderBy(place)) - 1)
    return ranked.join(firsts, [shard, part]).withColumn(slot, F.col("_first") + F.col("_rank")).drop("_first", "_rank")


def document_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Documents in shards of nearly equal bytes: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Dimensions are size, source, language and text digest. Null texts weigh one byte, nulls elsewhere are a
    value like any other, repeated rows are told apart by where they lie. Columns the tables lack are left out.
    """
    sides = [hashed(F.col(c)).alias(f"_{c}") for c in ("source", "lang") if c in docs.columns]
    narrow = stored(
        docs.select(
            "doc_id",
            text_size(F.col("text")).alias("size"),
            text_crc32(F.col("text")).alias("text_crc32"),
            *sides,
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_place"),
        ).withColumn("_size", logarithm(F.col("size")))
    )
    # The digest comes last: of dimensions of equal spread the first is cut, and a digest says nothing of a document.
    dimensions = ["_size", *[c for c in ("_source", "_lang") if c in narrow.columns], "text_crc32"]
    placed = split(narrow, dimensions, "size", shards, group="text_crc32", row="_place")
    return numbered(placed, "shard", "_part", "_place").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast(T.IntegerType()).alias("grown_shard"),
    )
