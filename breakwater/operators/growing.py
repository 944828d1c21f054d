"""A profile that grows with the loads: every written part is summarised once, and summaries add up.

Parts never change, so what is known of one stays true. Two small tables lie beside a part: cells, the rows of each
combination of its profiled low-cardinality columns, and values, its different ids. The profile of a table adds the
summaries of the parts of its latest version; loaded rows are read only for parts that have none, which after an append is
the appended part alone. A snapshot starts anew, and so does the part that a compaction writes.

Where parts hold a column in different types, summaries are cast as the table's view casts their rows. Tables without
parts (fed by a stream, or not written by the loader) are profiled from their rows. NULL ids count nowhere, NULLs of a
distribution are left out, a column that a part lacks is NULL there, and a table without rows has zeros and no scores.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breakwater.functions.ordering import ordered
from breakwater.functions.rules import HIGH_EPSS
from breakwater.operators import profile as plain
from breakwater.schemas import KNOWN_TABLES
from breakwater.sources import versions
from breakwater.tables import Tables

_CELLS, _VALUES = "cells", "values"
_CLOUDS = {"awsInstanceId": "aws_rows", "azureResourceId": "azure_rows", "gcpObjectId": "gcp_rows"}
_STATS = ("cvssV3Score", "hasExploits")
_FLAGS: dict[str, T.DataType] = {**{name: T.BooleanType() for name in (*_CLOUDS.values(), "high_epss")}, "epss_total": T.DoubleType(), "epss_n": T.LongType()}


def _keys(table: str) -> list[str]:
    """Columns whose combinations are counted as they are."""
    own = [column for owner, column in plain.DISTRIBUTIONS if owner == table]
    return [*own, *_STATS] if table == "vulnerabilities" else own


def _ids(table: str) -> list[str]:
    return list(plain.UNIQUES.get(table, {}).values())


def _cells(rows: DataFrame, table: str) -> DataFrame:
    """``n`` rows of every combination, counted before they are shuffled; scores of likelihood go in as sums."""
    present = {c.lower() for c in rows.columns}
    keys = [F.col(c).alias(c) for c in _keys(table) if c.lower() in present]
    sums = [F.count(F.lit(1)).alias("n")]
    if table == "vulnerabilities":
        keys += [F.col(c).isNotNull().alias(name) for c, name in _CLOUDS.items() if c.lower() in present]
        if "epssscore" in present:
            likely = F.col("epssscore").cast("double")
            keys.append((likely > HIGH_EPSS).alias("high_epss"))
            sums += [F.sum(likely).alias("epss_total"), F.count(likely).alias("epss_n")]
    return rows.groupBy(*keys).agg(*sums)


def _values(rows: DataFrame, table: str) -> DataFrame | None:
    """Different ids of a part, each in a row of its own; every id column is read alone."""
    present = {c.lower() for c in rows.columns}
    each = [rows.select(F.col(c).alias(c)).where(F.col(c).isNotNull()).distinct() for c in _ids(table) if c.lower() in present]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each) if each else None


def summarise(spark: SparkSession, database: str, table: str) -> list[str]:
    """Write the summaries that parts of a table's latest version lack; returns the parts that were read for it."""
    version, read = _shown(spark, database, table), []
    for part in version.parts if version else ():
        rows = spark.table(f"{database}.{part}")
        wanted = {_CELLS: _cells(rows, table), _VALUES: _values(rows, table)}
        for kind, frame in wanted.items():
            if frame is not None and versions.summary(spark, database, part, kind) is None:
                versions.write_summary(spark, database, part, kind, frame)
                read.append(part)
    return list(dict.fromkeys(read))


def _shown(spark: SparkSession, database: str, table: str) -> versions.Version | None:
    """The version that the table's view shows, if it has a record."""
    shown, version = versions.current_version(spark, database, table), versions.latest(spark, database, table)
    return version if version is not None and version.number and version.name == shown else None


def _merged(spark: SparkSession, version: versions.Version, kind: str, columns: dict[str, T.DataType]) -> DataFrame:
    """The summaries of all parts below each other, in the columns and types asked for."""
    found = [versions.summary(spark, version.database, part, kind) for part in version.parts]
    none = spark.createDataFrame([], T.StructType([T.StructField(c, k) for c, k in columns.items()]))
    frames = [
        frame.select(*[(F.col(c) if c in frame.columns else F.lit(None)).cast(k).alias(c) for c, k in columns.items()])
        for frame in found
        if frame is not None
    ]
    return reduce(DataFrame.unionByName, frames) if frames else none


def _unique(spark: SparkSession, version: versions.Version, table: str, types: dict[str, T.DataType]) -> DataFrame:
    """Different ids over all parts; those of one part are different already."""
    counts = []
    for name, column in plain.UNIQUES[table].items():
        ids = _merged(spark, version, _VALUES, {column: types[column]}).where(F.col(column).isNotNull())
        apart = ids if len(version.parts) == 1 else ids.distinct()
        counts.append(apart.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n"))
    every = reduce(DataFrame.unionByName, counts)
    return every.agg(*[F.sum(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in plain.UNIQUES[table]])


def _rows_where(condition: str, name: str):
    return F.coalesce(F.sum(F.when(F.col(condition), F.col("n"))), F.lit(0)).cast("long").alias(name)


def _summed(spark: SparkSession, version: versions.Version, table: str) -> dict[tuple[str, str], DataFrame]:
    """The blocks of one table from its summaries."""
    types = versions.shown_types(spark, version.database, version.parts)
    keys = {c: types[c] for c in _keys(table) if c in types}
    cells = _merged(spark, version, _CELLS, {**keys, **(_FLAGS if table == "vulnerabilities" else {}), "n": T.LongType()})
    found: dict[tuple[str, str], DataFrame] = {}
    if _ids(table) and set(_ids(table)) <= set(types):
        found[table, "unique"] = _unique(spark, version, table, types)
    for (owner, column), name in plain.DISTRIBUTIONS.items():
        if owner == table and column in types:
            counted = cells.where(F.col(column).isNotNull()).groupBy(column).agg(F.sum("n").alias("count"))
            found[table, name] = ordered(counted, "-count")
    if table != "vulnerabilities":
        return found
    if "cvssV3Score" in types:
        scores = cells.where(F.col("cvssV3Score").isNotNull()).groupBy("cvssV3Score").agg(F.sum("n").alias("n"))
        found[table, "cvss_v3_stats"] = plain.score_stats(scores)
    if {"hasExploits", "epssscore"} <= set(types):
        found[table, "exploit_stats"] = cells.agg(
            _rows_where("hasExploits", "with_exploits"),
            _rows_where("high_epss", "high_epss"),
            F.try_divide(F.sum("epss_total"), F.sum("epss_n")).alias("avg_epss"),
        )
    if set(_CLOUDS) <= set(types):
        found[table, "cloud_distribution"] = cells.agg(*[_rows_where(name, name) for name in _CLOUDS.values()])
    return found


def blocks(spark: SparkSession, database: str) -> tuple[dict[str, int], dict[tuple[str, str], DataFrame]]:
    """Rows of every loaded table, and every block of the profile, not yet run; missing summaries are written first."""
    loaded = Tables.from_catalog(spark, database)
    rows_of: dict[str, int] = {}
    found: dict[tuple[str, str], DataFrame] = {}
    tables = [table for table in KNOWN_TABLES if table in loaded]
    # Tables do not depend on each other, so the last tasks of one leave no cores idle.
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        list(pool.map(lambda table: summarise(spark, database, table), tables))
    for table in tables:
        version = _shown(spark, database, table)
        if version is None:
            own = Tables(**{table: loaded[table]})
            rows_of[table] = plain.total_rows(own).first().total_rows
            found |= plain.blocks(own)
        else:
            rows_of[table] = versions.rows_of(spark, version)
            found |= _summed(spark, version, table)
    return rows_of, found


def profile(spark: SparkSession, database: str) -> dict[str, dict[str, Any]]:
    """What ``breakwater.operators.profile.profile`` gives for a database, from summaries."""
    return plain.nested(*blocks(spark, database))


def as_rows(spark: SparkSession, database: str) -> DataFrame:
    """The same as rows ``table_name, block, item, value``; the block ``rows`` has a table's number of rows."""
    rows_of, found = blocks(spark, database)
    every = [spark.createDataFrame([(t, "rows", "total_rows", float(n)) for t, n in rows_of.items()], "table_name string, block string, item string, value double")]
    for (table, name), frame in found.items():
        if frame.columns[1:] == ["count"]:
            items = frame.select(F.col(frame.columns[0]).cast("string").alias("item"), F.col("count").cast("double").alias("value"))
        else:
            items = frame.select(*[F.col(c).cast("double").alias(c) for c in frame.columns]).unpivot([], frame.columns, "item", "value")
        every.append(items.select(F.lit(table).alias("table_name"), F.lit(name).alias("block"), "item", "value"))
    return reduce(DataFrame.unionByName, every)
