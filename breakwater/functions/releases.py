"""Version strings in order, and the entry of a list that a version falls under."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def release_key(version: str | Column) -> Column:
    """A version as a list of parts that sorts as versions do: 7.9 before 7.10, rc before numbers, prefixes first.

    Runs of digits and of letters are parts; anything else parts them and does not count. Leading zeros do not count,
    nor does case. NULL for a text without either.
    """
    text = F.col(version) if isinstance(version, str) else version
    parts = F.regexp_extract_all(F.lower(text), F.lit("([0-9]+|[a-z]+)"), F.lit(1))
    digits = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    ranked = F.transform(
        parts,
        lambda p: F.when(p.rlike("^[0-9]"), F.concat(F.lit("1"), F.lpad(F.length(digits(p)).cast("string"), 4, "0"), digits(p))).otherwise(
            F.concat(F.lit("0"), p)
        ),
    )
    return F.when(F.size(ranked) > 0, ranked)


def _is_prefix(short: Column, long: Column) -> Column:
    return F.slice(long, F.lit(1), F.size(short)) == short


def _keyed(rows: DataFrame, version: str) -> DataFrame:
    """``rows`` of a count ``_n`` with ``_at``, the key of their version; those whose version has none drop out.

    The key depends on the count, so the optimizer cannot move it below the aggregation that counts, where it would be
    worked out for every row instead of for each different version.
    """
    return rows.withColumn("_at", F.when(F.col("_n") > 0, release_key(version))).where("_at is not null").drop("_n")


def as_of(points: DataFrame, entries: DataFrame, by: list[str], at: str, value: str) -> DataFrame:
    """``points`` with ``value`` of the last of ``entries`` at or before ``at`` of the same ``by``; NULL before the first.

    Both are put into one sorted run of rows per ``by`` and the last value is carried along, so nothing is compared
    pairwise. ``entries`` should have one row for each ``by`` and ``at``; ``points`` are best reduced to different ones.
    """
    rows = points.select(*by, at, F.lit(1).alias("_side"), F.lit(None).cast(entries.schema[value].dataType).alias(value))
    rows = rows.unionByName(entries.select(*by, at, F.lit(0).alias("_side"), value))
    before = Window.partitionBy(*by).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = rows.withColumn(value, F.last(value, ignorenulls=True).over(before))
    return carried.where("_side = 1").drop("_side")


def longest_entry(points: DataFrame, entries: DataFrame, on: list[str], version: str, value: str) -> DataFrame:
    """``points`` (``on, version``) with ``entry`` and ``value`` of the longest listed version that theirs begins with.

    Rows without such an entry drop out. An entry listed twice counts with its greatest value. Of the entries that a
    version begins with, each leads to the next; the last entry before the version knows all that lead to it, and among
    those are all that the version begins with.
    """
    once = entries.groupBy(*on, version).agg(F.max(value).alias(value), F.count("*").alias("_n"))
    listed = _keyed(once, version).groupBy(*on, "_at").agg(F.max(value).alias(value), F.min(version).alias("entry"))
    item = F.struct(F.size("_at").alias("length"), F.col("_at").alias("key"), F.col("entry"), F.col(value))
    lengths = F.explode(F.sequence(F.lit(1), F.size("_at")))
    starts = listed.select(*on, "_at", lengths.alias("_length")).withColumn("_start", F.slice("_at", F.lit(1), F.col("_length")))
    leads = starts.join(listed.select(*on, F.col("_at").alias("_start"), item.alias("_lead")), [*on, "_start"])
    chains = leads.groupBy(*on, "_at").agg(F.sort_array(F.collect_list("_lead")).alias("_chain"))
    given = reduce(and_, [F.col(c).isNotNull() for c in (*on, version)])  # others meet nothing; said here, one scan serves twice
    different = _keyed(points.where(given).groupBy(*on, version).agg(F.count("*").alias("_n")), version)
    met = as_of(different.select(*on, "_at").distinct(), chains, on, "_at", "_chain")
    fitting = F.filter("_chain", lambda lead: _is_prefix(lead["key"], F.col("_at")))
    found = met.withColumn("_best", F.try_element_at(fitting, F.lit(-1))).where("_best is not null")
    named = different.join(found.select(*on, "_at", "_best"), [*on, "_at"])
    same = [F.col(f"p.{c}") == F.col(f"n.{c}") for c in (*on, version)]
    return (
        points.alias("p")
        .join(named.alias("n"), same)
        .select("p.*", F.col("n._best.entry").alias("entry"), F.col(f"n._best.{value}").alias(value))
    )
