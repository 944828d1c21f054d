"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

A source's weight is its share of all tokens raised to an exponent between 0 (all sources alike) and 1 (shares as
they are), normalised. The exponent is found by bisection: either the mix closest to the shares whose entropy still
reaches a target, or the most even mix in which no source is repeated more often than a limit.

A budget of tokens is then dealt by weight. Each source is read in one random order after another, an epoch each,
until its part of the budget is full; every block of the mix takes each source's weight in tokens from where the
source stands, and rows are shuffled inside their block. Without a given budget it is the least one in which every
document appears, so mixing repeats documents of rare sources and drops none.

Where a row stands in its source's order is a sum over all rows before it. It is taken in three steps (coarse bins,
bins, rows), so a source with a third of all rows is never gathered in one task.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from breakwater.llm.common import steady_scans, stored

# Parameters: points of one round of the bisection and rounds, rows of a bin, salts of the join with weights.
POINTS, ROUNDS, BIN_ROWS, SALTS = 32, 6, 1024, 16
_KEY_BITS = 60


class Target(NamedTuple):
    """Exactly one of the two: entropy as a share of the greatest possible, or how often a source may be read."""

    entropy: float | None = None
    repetition: float | None = None


def n_tokens(text: Column) -> Column:
    """Words of a text plus its end; a null text has its end alone."""
    return (F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1).cast("long")


def _source(name: str) -> Column:
    """A source as a key; null is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))


def _measured(sources: DataFrame, exponents: list[float], budget: float | None, target: Target) -> list[tuple[float, bool]]:
    """For each exponent its normaliser and whether it is even enough, or repeats too often: so it may rise."""
    share = F.col("tokens") / F.col("whole")
    measures = []
    for i, x in enumerate(exponents):
        measures += [F.sum(F.pow(share, F.lit(x))).alias(f"s{i}"), F.sum(F.pow(share, F.lit(x)) * F.log(share)).alias(f"e{i}")]
        measures += [F.max(F.pow(share, F.lit(x - 1))).alias(f"hi{i}"), F.min(F.pow(share, F.lit(x - 1))).alias(f"lo{i}")]
    row = sources.agg(F.count("*").alias("n"), F.max("whole").alias("whole"), *measures).first()
    found = []
    for i, x in enumerate(exponents):
        s = row[f"s{i}"]
        if target.entropy is not None:
            may_rise = math.log(s) - x * row[f"e{i}"] / s >= target.entropy * math.log(row.n) - 1e-12
        else:
            repeated = row[f"hi{i}"] / row[f"lo{i}"] if budget is None else budget / row.whole * row[f"hi{i}"] / s
            may_rise = repeated > target.repetition + 1e-12
        found.append((s, may_rise))
    return found


def exponent(sources: DataFrame, target: Target, budget: float | None = None) -> float:
    """Bisect the exponent. ``sources`` has a row ``tokens, whole`` for each source; each round is one aggregation.

    For an entropy it is the greatest exponent that reaches it (0 if none does), for a repetition limit the least
    that keeps it (1 if none does).
    """
    if (target.entropy is None) == (target.repetition is None):
        raise ValueError("the target is an entropy or a repetition limit")
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        points = [low + (high - low) * i / POINTS for i in range(POINTS + 1)]
        rises = [may for _, may in _measured(sources, points, budget, target)]
        if all(rises):
            return high
        first = rises.index(False)
        if first == 0:
            return low
        low, high = points[first - 1], points[first]
    return low if target.entropy is not None else high


def weighted(sources: DataFrame, target: Target, budget: float | None = None) -> DataFrame:
    """``sources`` with ``weight`` and ``quota``, the tokens a source gives to the mix."""
    x = exponent(sources, target, budget)
    normaliser = _measured(sources, [x], budget, target)[0][0]
    mixed = sources.withColumn("weight", F.pow(F.col("tokens") / F.col("whole"), F.lit(x)) / F.lit(normaliser))
    if budget is None:
        budget = mixed.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0]
    return mixed.withColumn("quota", F.ceil(F.col("weight") * F.lit(budget) - F.lit(1e-6)))


def _bits(rows: Column) -> Column:
    return F.greatest(F.lit(0), F.ceil(F.log2(rows / F.lit(BIN_ROWS)))).cast("int")


def _starts(drawn: DataFrame) -> DataFrame:
    """Tokens of the source's epoch before each row: ``drawn`` with ``before``."""
    source, epoch = "source_key", "epoch"
    upto = (Window.unboundedPreceding, -1)
    fine = drawn.groupBy(source, epoch, "coarse", "bin").agg(F.sum("tokens").alias("t"))
    coarse = fine.groupBy(source, epoch, "coarse").agg(F.sum("t").alias("t"))
    whole = Window.partitionBy(source, epoch).orderBy("coarse").rowsBetween(*upto)
    inside = Window.partitionBy(source, epoch, "coarse").orderBy("bin").rowsBetween(*upto)
    coarse = coarse.select(source, epoch, "coarse", F.coalesce(F.sum("t").over(whole), F.lit(0)).alias("before_coarse"))
    fine = fine.select(source, epoch, "coarse", "bin", F.coalesce(F.sum("t").over(inside), F.lit(0)).alias("before_bin"))
    offsets = fine.join(coarse, [source, epoch, "coarse"]).select(
        source, epoch, "bin", (F.col("before_coarse") + F.col("before_bin")).alias("before_rows")
    )
    rows = Window.partitionBy(source, epoch, "bin").orderBy("key", "row").rowsBetween(*upto)
    ranked = drawn.withColumn("among", F.coalesce(F.sum("tokens").over(rows), F.lit(0)))
    return ranked.join(offsets, [source, epoch, "bin"]).withColumn("before", F.col("before_rows") + F.col("among")).drop("among", "before_rows")


def draws(
    docs: DataFrame, target: Target, budget: float | None = None, block_tokens: int = 1 << 18, seed: int = 0,
    source: str = "source", text: str = "text",
) -> DataFrame:
    """The mix, a row for each time a document is drawn.

    Columns: ``row`` (number of the document's row), ``doc_id, source, n_tokens, epoch, block, position``.
    Blocks count from 0, positions from 0 inside a block; a block holds about ``block_tokens`` tokens, the last
    less. A null source is a source of its own; repeated rows are drawn each; an empty table gives none.
    """
    narrow = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", F.col(source).alias("source"),
            _source(source).alias("source_key"), n_tokens(F.col(text)).alias("tokens"),
        )
    )
    sums = narrow.groupBy("source_key").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    sources = stored(sums)
    whole = sources.agg(F.sum("tokens")).first()[0]
    if whole is None:
        return narrow.select("row", "doc_id", "source", F.col("tokens").alias("n_tokens"),
                             *[F.lit(0).cast("long").alias(c) for c in ("epoch", "block", "position")])
    weights = weighted(sources.withColumn("whole", F.lit(whole)), target, budget).select(
        "source_key", "weight", "quota", F.col("tokens").alias("source_tokens"), _bits(F.col("rows")).alias("bits")
    )
    salted = weights.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = narrow.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(salted, ["source_key", "salt"]).drop("salt")
    joined = joined.where("quota > 0")  # a source without a quota has no epochs; a sequence to -1 would count down
    epochs = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("quota") / F.col("source_tokens")) - 1)
    keyed = joined.withColumn("epoch", F.explode(epochs)).withColumn(
        "key", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "epoch", "doc_id", "row"), 64 - _KEY_BITS)
    )
    half = (F.col("bits") / 2).cast("int")
    binned = keyed.withColumns({
        "bin": F.floor(F.col("key") / F.pow(F.lit(2.0), F.lit(_KEY_BITS) - F.col("bits"))),
        "coarse": F.floor(F.col("key") / F.pow(F.lit(2.0), F.lit(_KEY_BITS) - half)),
    })
    placed = _starts(binned).withColumn("start", F.col("epoch") * F.col("source_tokens") + F.col("before"))
    taken = placed.where("start < quota").withColumn("block", F.floor(F.col("start") / (F.col("weight") * F.lit(block_tokens))))
    order = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 1), "key", "row"), "row", "epoch")
    return taken.select(
        "row", "doc_id", "source", F.col("tokens").alias("n_tokens"), "epoch", "block",
        (F.row_number().over(order) - 1).cast("long").alias("position"),
    )


def mixed(docs: DataFrame, target: Target, budget: float | None = None, block_tokens: int = 1 << 18, seed: int = 0) -> DataFrame:
    """The documents in the order of the mix, repeated as often as drawn, columns as they are.

    Rows are dealt by block and sorted by position, so written files follow one another in the mix. ``docs``
    must give the same rows when read again, as files do.
    """
    steady_scans(docs)
    drawn = draws(docs, target, budget, block_tokens, seed).select("row", "block", "position")
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    met = docs.select(columns.alias("doc"), F.monotonically_increasing_id().alias("row")).join(drawn, "row")
    ordered = met.repartitionByRange("block", "position").sortWithinPartitions("block", "position")
    return ordered.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
