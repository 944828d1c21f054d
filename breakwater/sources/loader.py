"""Loading export files into the six tables.

A load writes its rows as one part and commits it (see ``versions``): a
snapshot load as the only part of the next version, an append load on top of
the parts of the latest one, whichever that is by then. So a failed load changes
nothing, and loads that run at the same time never undo each other. Every row
carries the id of its load, which the table's view hides, so a load that is
tried again adds nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breakwater.sources import files as footers
from breakwater.sources import prefixes, versions, widening
from breakwater.sources.versions import FED, LOAD, current_version, drop_versions, point

__all__ = ["FED", "LoadReport", "current_version", "drop_versions", "load", "load_path", "point"]


@dataclass
class LoadReport:
    """Total rows of every table the load touched, and what went wrong on the way."""

    row_counts: dict[str, int] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)
    failures: dict[str, str] = field(default_factory=dict)

    @property
    def total(self) -> int:
        return sum(self.row_counts.values())


def load(
    spark: SparkSession,
    database: str,
    prefix_files: Mapping[str, Sequence[str]],
    skip: Iterable[str] = (),
    append: bool = False,
    by: str = "name",
    load_id: str | None = None,
    unique: Sequence[str] = (),
) -> LoadReport:
    """Load Parquet files into their tables.

    A snapshot load replaces the tables its files belong to and no others. An
    append load adds rows; one whose ``load_id`` the table holds already adds
    none. Neighbouring chunks may share rows: with ``unique``, an append keeps
    one row of each value of those columns and none that the table has.

    Files combine by column name, missing columns as NULL; ``by="position"``
    matches columns by place, and then every file must have as many as the
    first. A column takes the narrowest type that holds the values of all files
    and of the table (``widening.common_type``); the statistics of the files say
    whether doubles hold their whole numbers. A file whose type has no form in
    common with the others is left out and reported, and so is a file that is
    damaged, in its footer or further in. A column of the table whose type
    becomes another is reported. A file that cannot be reached at all fails the
    load before anything is written. A table that fails for another reason stays
    as it was and is named in ``failures``.
    """
    if by not in ("name", "position"):
        raise ValueError("by is 'name' or 'position'")
    report = LoadReport()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    listed = [(p, path) for p, paths in prefix_files.items() for path in paths]
    if not listed:
        return report
    work = _plan(spark, listed, list(skip), report)
    tables = list(dict.fromkeys(row.table_name for row in work))
    fed = [t for t in tables if append and current_version(spark, database, t) == FED]
    if fed:
        raise ValueError(f"{', '.join(fed)}: fed by a stream, takes no append loads")
    identity = load_id or uuid.uuid4().hex

    def load_table(table: str) -> LoadReport:
        mine = [row for row in work if row.table_name == table]
        try:
            return _load_table(spark, database, table, mine, append, by, identity, unique)
        except Exception as problem:  # the other tables go on, and the report survives
            return LoadReport(failures={table: f"{type(problem).__name__}: {str(problem).splitlines()[0]}"})

    # Tables do not depend on each other, so the last tasks of one leave no cores idle.
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        for part in pool.map(load_table, tables):
            report.row_counts.update(part.row_counts)
            report.warnings.extend(part.warnings)
            report.failures.update(part.failures)
    report.warnings.extend(f"{table}: failed, table left as it was: {why}" for table, why in report.failures.items())
    if report.total == 0:
        report.warnings.append(f"{len(listed)} file(s) but 0 rows loaded; prefixes: {sorted(prefix_files)}")
    return report


def _load_table(
    spark: SparkSession, database: str, table: str, rows: list[Row], append: bool, by: str, identity: str, unique: Sequence[str]
) -> LoadReport:
    report = LoadReport()
    for _ in range(10):
        base = versions.latest(spark, database, table) if append else None
        if versions.holds(spark, base, identity):
            report.warnings.append(f"{table}: load {identity} is there already")
            report.row_counts[table] = versions.rows_of(spark, base)
            return report
        frame = _combine(spark, rows, base, by, report)
        if frame is None:
            report.warnings.append(f"{table}: no file could be read, table left as it was")
            return report
        if append and unique:
            frame = _unseen(spark, frame, base, unique)
        try:
            part = versions.write_part(spark, database, table, frame.withColumn(LOAD, F.lit(identity)), identity)
        except Exception:
            bad = _torn(spark, [row.path for row in rows if row.schema is not None])
            if not bad:
                raise
            report.warnings.extend(f"{path}: not readable, skipped: {why}" for path, why in bad.items())
            rows = [row for row in rows if row.path not in bad]
            continue
        if _committed(spark, database, table, part, base, append, identity, unique, report):
            return report
    raise versions.Conflict(f"{table}: files or table kept changing while they were loaded")


def _committed(
    spark: SparkSession,
    database: str,
    table: str,
    part: str,
    base: versions.Version | None,
    append: bool,
    identity: str,
    unique: Sequence[str],
    report: LoadReport,
) -> bool:
    """Put a part into the next version. False if what it was compared with is not the latest version any more."""
    stale = False

    def change(now: versions.Version | None) -> list[str] | None:
        nonlocal stale
        if not append:
            return [part]
        stale = bool(unique) and now != base
        if stale or now != base and versions.holds(spark, now, identity):
            return None
        return [*(now.parts if now else ()), part]

    try:
        made, changed = versions.commit(spark, database, table, change)
    except Exception:
        versions.drop_part(spark, database, part)
        raise
    if made is None or part not in made.parts:
        versions.drop_part(spark, database, part)
        return False
    report.warnings.extend(f"{table}.{what}" for what in changed)
    if len(made.parts) > versions.MOST_PARTS:
        versions.compact(spark, database, table, newest=True)
    report.row_counts[table] = versions.rows_of(spark, made)
    return True


def _unseen(spark: SparkSession, frame: DataFrame, base: versions.Version | None, unique: Sequence[str]) -> DataFrame:
    """One row of each value of the columns, and none that the version has."""
    frame = frame.dropDuplicates(list(unique))
    if base is None:
        return frame
    held = [spark.table(f"{base.database}.{part}") for part in base.parts]
    known = versions.joined([h.select(*[F.col(f"`{c}`") for c in unique if c in h.columns]) for h in held])
    known = known.select(*[F.col(f"`{c}`") if c in known.columns else F.lit(None).alias(c) for c in unique])
    same = reduce(lambda a, b: a & b, [F.col(f"n.`{c}`").eqNullSafe(F.col(f"h.`{c}`")) for c in unique])
    return frame.alias("n").join(known.alias("h"), same, "left_anti")


def _torn(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Files whose pages cannot be read, each tried alone; only a failed load looks."""

    def tried(path: str) -> str | None:
        try:
            spark.read.parquet(path).write.format("noop").mode("overwrite").save()
            return None
        except Exception as problem:
            return f"{type(problem).__name__}: {str(problem).splitlines()[0]}"

    different = list(dict.fromkeys(paths))
    with ThreadPoolExecutor(max_workers=16) as pool:
        return {path: why for path, why in zip(different, pool.map(tried, different)) if why}


def _plan(spark: SparkSession, listed: list[tuple[str, str]], skip: list[str], report: LoadReport) -> list[Row]:
    """One row per file to load, in the order given; whatever is amiss becomes a warning.

    Files in places that only Spark's file systems reach are looked at through
    Spark, one by one. What Spark cannot reach either raises.
    """
    numbered = [(i, prefix, path) for i, (prefix, path) in enumerate(listed)]
    routed = prefixes.route(footers.spread(spark, numbered, "place long, prefix string, path string"), skip)
    wanted = routed.where(F.col("outcome") != prefixes.SKIP)
    probed = (
        footers.probe(wanted.where(F.col("outcome") == prefixes.LOAD).select("path").distinct())
        .withColumn("schema", F.xxhash64(F.to_json("columns")).cast("string"))
        .withColumnRenamed("outcome", "state")
        .drop("columns", "rows")
    )
    rows = wanted.join(probed, "path", "left").orderBy("place").collect()
    for prefix in dict.fromkeys(r.prefix for r in rows if r.outcome == prefixes.UNKNOWN):
        report.warnings.append(f"unknown prefix {prefix!r}, skipped")
    work = [row for row in rows if row.outcome == prefixes.LOAD]
    far = list(dict.fromkeys(row.path for row in work if row.state == footers.UNREACHABLE))
    with ThreadPoolExecutor(max_workers=16) as pool:
        looked = dict(zip(far, pool.map(lambda path: footers.look(spark, path), far)))
    kept = []
    for row in work:
        if row.bytes is not None and row.bytes < footers.SMALL_FILE_BYTES:
            report.warnings.append(f"{row.path} (prefix {row.prefix}): unusually small, {row.bytes} bytes")
        state, error, schema = row.state, row.error, row.schema
        if row.path in looked:
            state, found, error = looked[row.path]
            schema = found.json() if found else None
        if state == footers.READABLE:
            kept.append(Row(path=row.path, table_name=row.table_name, source=row.source, schema=schema, ranges=row.ranges))
        else:
            report.warnings.append(f"{row.path}: not readable, skipped: {error}")
            kept.append(Row(path=row.path, table_name=row.table_name, source=row.source, schema=None, ranges=None))
    return kept


@dataclass
class _Scan:
    """Files of one source and schema, the names their columns go by, and their types."""

    rows: list[Row]
    names: list[str]
    frame: DataFrame

    @property
    def paths(self) -> list[str]:
        return [row.path for row in self.rows]

    def kind(self, column: str) -> T.DataType | None:
        return self.frame.schema[column].dataType if column in self.names else None


def _combine(spark: SparkSession, rows: list[Row], base: versions.Version | None, by: str, report: LoadReport) -> DataFrame | None:
    """All files of a table as one DataFrame: one scan per distinct source and file schema."""
    groups: dict[tuple[str | None, str], list[Row]] = {}
    for row in rows:
        if row.schema is not None:
            groups.setdefault((row.source, row.schema), []).append(row)
    stored = versions.shown_types(spark, base.database, base.parts) if base else {}
    kinds: dict[str, list[T.DataType]] = {c: [k] for c, k in stored.items()}
    scans: list[_Scan] = []
    for (source, _), own in groups.items():
        paths = [row.path for row in own]
        frame = _scan(spark, paths, source)
        if by == "position" and kinds and len(frame.columns) != len(kinds):
            report.warnings.append(f"{len(frame.columns)} columns instead of {len(kinds)}, skipped: {paths}")
            continue
        spelled = {c.lower(): c for c in kinds}
        names = list(kinds) if by == "position" and kinds else [spelled.get(c.lower(), c) for c in frame.columns]
        found = {n: [*kinds.get(n, []), f.dataType] for n, f in zip(names, frame.schema.fields)}
        strange = [n for n, k in found.items() if widening.common_type(k, bool, int) is None]
        if strange:
            report.warnings.extend(f"{path}: values of {strange} do not fit the table, skipped" for path in dict.fromkeys(paths))
            continue
        kinds.update(found)
        scans.append(_Scan(own, names, frame.toDF(*names)))
    if not scans:
        return None
    target = {c: _narrowest(spark, c, scans) for c in kinds if any(scan.kind(c) for scan in scans)}
    for column, kind in target.items():
        own = [k for k in (scan.kind(column) for scan in scans) if k is not None]
        if any(isinstance(k, (T.FloatType, T.DoubleType)) for k in own) and isinstance(kind, T.DecimalType):
            report.warnings.append(f"{column}: whole numbers that doubles do not hold, kept as {kind.simpleString()}")
    frames = [scan.frame.select(*[F.col(f"`{c}`").cast(target[c]).alias(c) for c in scan.names]) for scan in scans]
    whole = versions.joined(frames)
    return whole.select(*[F.col(f"`{c}`") for c in target])


def _narrowest(spark: SparkSession, column: str, scans: list[_Scan]) -> T.DataType:
    """The narrowest type for a column of all files; data is read only where statistics do not settle it."""
    own = [scan for scan in scans if scan.kind(column) is not None]

    def beyond() -> bool:
        return any(widening.is_beyond(_file_range(spark, row, scan, column)) for scan in own if scan.kind(column) == T.LongType() for row in scan.rows)

    def scale() -> int | None:
        scales = [widening.scale_of(scan.frame, column) for scan in own if isinstance(scan.kind(column), (T.FloatType, T.DoubleType))]
        return None if None in scales else max(scales, default=0)

    kind = widening.common_type([scan.kind(column) for scan in own], beyond, scale)
    assert kind is not None  # scans without a form in common were left out
    return kind


def _file_range(spark: SparkSession, row: Row, scan: _Scan, column: str) -> tuple[int, int] | None:
    """Least and greatest value, from the file's statistics if they have them."""
    place = scan.names.index(column)
    for span in row.ranges or []:
        if span.place == place:
            return None if span.low is None else (span.low, span.high)
    file = spark.read.parquet(row.path)
    return widening.range_of(file, file.columns[place])


def _scan(spark: SparkSession, paths: list[str], source: str | None) -> DataFrame:
    """One scan of files with one schema; a path given twice is read twice."""
    times = {p: paths.count(p) for p in dict.fromkeys(paths)}
    scans = [spark.read.parquet(*[p for p, n in times.items() if n > i]) for i in range(max(times.values()))]
    frame = reduce(DataFrame.unionByName, scans)
    return frame if source is None else frame.withColumn("source", F.lit(source))


def load_path(spark: SparkSession, database: str, path: str, mode: str = "full") -> LoadReport:
    """Snapshot-load a file, or the files of a directory, by what their columns look like."""
    paths = footers.list_files(spark, path).select("path").repartition(4 * spark.sparkContext.defaultParallelism)
    found = (
        footers.probe(paths)
        .withColumn("prefix", footers.sniffed_prefix(F.transform("columns", lambda c: c["name"]), mode))
        .select("path", "readable", "prefix", "error")
        .orderBy("path")
        .collect()
    )
    by_prefix: dict[str, list[str]] = {}
    ignored = []
    for row in found:
        if row.readable and row.prefix:
            by_prefix.setdefault(row.prefix, []).append(row.path)
        else:
            ignored.append(f"{row.path}: {row.error or 'columns of no known table'}, skipped")
    report = load(spark, database, by_prefix)
    report.warnings[:0] = ignored
    return report
