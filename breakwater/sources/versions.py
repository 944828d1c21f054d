"""Versions of a table: an ordered record of the written parts that it consists of.

A part is a table of its own that nobody changes once it is written. A version is a view ``<table>__v<number>`` over
parts that names its parent; where parts hold a column in different types, the view casts each to the narrowest type for
all, so adding a part never rewrites another. A load commits by creating the view of the next number. The catalogue
refuses a name that is taken, so of two loads that began on the same version the second one finds the number gone, reads
the version that took it and puts its part on top: no load can undo another, and none waits while another writes.

The table's own view shows the latest version. Readers that began on an earlier one finish on it, until
``drop_versions`` removes it; ``compact`` folds parts into one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breakwater.sources import widening

# Columns that most queries filter on; rows are written sorted by them within a file.
CLUSTERED = {
    "vulnerabilities": ("severity", "vulnId"),
    "policies": ("finalStatus", "ruleNaturalId"),
    "vulnerability_remediation": ("cveId",),
}

# Tables stored in a folder for each value of a column that queries name.
PARTITIONED = {"policies": ("source",)}

# The hidden column with the id of a row's load, and what the table's view says of itself when a stream fills it.
LOAD, FED = "_load_id", "fed by a stream"
# Parts above which an append folds the newest ones, and how much older rows than newer ones that may rewrite.
MOST_PARTS, FOLD_FACTOR = 48, 4

_STAMP = "%Y%m%d%H%M%S"
_SHOWN, _PARENT, _PARTS, _AT = "breakwater.version", "breakwater.parent", "breakwater.parts", "breakwater.at"
_ROWS, _RANGES, _ONE_LOAD = "breakwater.rows", "breakwater.ranges", "breakwater.load"


class Conflict(RuntimeError):
    """Other loads kept committing first."""


@dataclass(frozen=True)
class Version:
    """The parts of a version, by table name inside the database; ``number`` 0 has no record."""

    database: str
    table: str
    number: int
    parts: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{self.database}.{self.table}__v{self.number:08d}"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _now() -> str:
    return datetime.now(timezone.utc).strftime(_STAMP)


def current_version(spark: SparkSession, database: str, table: str) -> str | None:
    """Name of the version a table's view shows; None if the table does not exist."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return None
    return _properties(spark, f"{database}.{table}").get(_SHOWN)


def _records(spark: SparkSession, database: str, table: str) -> dict[int, str]:
    """Versions by number. Names that merely look alike are left out."""
    start = f"{table}__v"
    names = [row.tableName for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{start}*'").collect()]
    return {int(n[len(start) :]): n for n in names if n.startswith(start) and n[len(start) :].isdigit()}


def latest(spark: SparkSession, database: str, table: str) -> Version | None:
    """The version committed last; None if there is none."""
    records = _records(spark, database, table)
    if records:
        number = max(records)
        parts = _properties(spark, f"{database}.{records[number]}")[_PARTS]
        return Version(database, table, number, tuple(p for p in parts.split(",") if p))
    shown = current_version(spark, database, table)
    if shown and shown != FED and spark.catalog.tableExists(shown):  # written before versions had records
        return Version(database, table, 0, (shown.split(".", 1)[1],))
    return None


# -- parts ------------------------------------------------------------------------------------------------------


def _clustered(frame: DataFrame, table: str) -> DataFrame:
    """Sort inside each task, without a shuffle, so that scans can skip pages by their value ranges."""
    columns = [c for c in CLUSTERED.get(table, ()) if c in frame.columns]
    return frame.sortWithinPartitions(*columns) if columns else frame


def write_part(spark: SparkSession, database: str, table: str, frame: DataFrame, load_id: str | None) -> str:
    """Write rows, which carry the ids of their loads, as a part of no version yet; returns its name.

    The write itself counts them and takes the range of every column of whole numbers; nothing is read again.
    """
    name, seen = f"{table}__{_now()}_{uuid.uuid4().hex[:8]}", Observation()
    whole = [f.name for f in frame.schema.fields if f.dataType == T.LongType()]
    facts = [f(F.col(f"`{c}`")).alias(f"{k}{i}") for i, c in enumerate(whole) for k, f in (("low", F.min), ("high", F.max))]
    watched = _clustered(frame, table).observe(seen, F.count(F.lit(1)).alias("rows"), *facts)
    writer, parts = watched.write.format("parquet"), [c for c in PARTITIONED.get(table, ()) if c in frame.columns]
    (writer.partitionBy(*parts) if parts else writer).saveAsTable(f"{database}.{name}")
    found = seen.get
    ranges = {c: [found[f"low{i}"], found[f"high{i}"]] for i, c in enumerate(whole) if found[f"low{i}"] is not None}
    told = {_ROWS: str(found["rows"]), _RANGES: json.dumps(ranges)} | ({_ONE_LOAD: load_id} if load_id else {})
    shown = ", ".join(f"'{k}' = '{_quoted(v)}'" for k, v in told.items())
    spark.sql(f"ALTER TABLE {database}.{name} SET TBLPROPERTIES ({shown})")
    return name


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def write_summary(spark: SparkSession, database: str, part: str, kind: str, frame: DataFrame) -> None:
    """Write what a part's rows add up to beside it. It counts once the part names it; of two writers either is right."""
    name = f"{part}__{kind}_{uuid.uuid4().hex[:8]}"
    frame.write.format("parquet").saveAsTable(f"{database}.{name}")
    spark.sql(f"ALTER TABLE {database}.{part} SET TBLPROPERTIES ('breakwater.{kind}' = '{name}')")


def summary(spark: SparkSession, database: str, part: str, kind: str) -> DataFrame | None:
    """What ``write_summary`` wrote of a part; None if nothing has been written yet."""
    name = _properties(spark, f"{database}.{part}").get(f"breakwater.{kind}")
    return None if name is None else spark.table(f"{database}.{name}")


def drop_part(spark: SparkSession, database: str, part: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {database}.{part}")


def rows_of(spark: SparkSession, version: Version | None) -> int:
    """Rows of a version, as its writes counted them."""
    total = 0
    for part in version.parts if version else ():
        name = f"{version.database}.{part}"
        known = _properties(spark, name).get(_ROWS)
        total += int(known) if known is not None else spark.table(name).count()
    return total


def holds(spark: SparkSession, version: Version | None, load_id: str) -> bool:
    """Whether rows of a load are in a version. Only parts folded out of several loads are read."""
    for part in version.parts if version else ():
        name = f"{version.database}.{part}"
        known = _properties(spark, name)
        if known.get(_ONE_LOAD) == load_id and known.get(_ROWS) != "0":
            return True
        if _ONE_LOAD not in known and not spark.table(name).where(F.col(LOAD) == load_id).isEmpty():
            return True
    return False


def shown_types(spark: SparkSession, database: str, parts: Sequence[str]) -> dict[str, T.DataType]:
    """Columns of the parts together, in order of appearance, each in the narrowest type that holds all of its values.

    Raises ``TypeError`` where a column's types have no form in common.
    """
    frames = {part: spark.table(f"{database}.{part}") for part in parts}
    held: dict[str, list[tuple[str, str, T.DataType]]] = {}
    spelled: dict[str, str] = {}
    for part, frame in frames.items():
        for f in frame.schema.fields:
            if f.name != LOAD:
                held.setdefault(spelled.setdefault(f.name.lower(), f.name), []).append((part, f.name, f.dataType))
    found = {}
    for column, owners in held.items():

        def beyond() -> bool:
            wide = [(part, own) for part, own, kind in owners if kind == T.LongType()]
            return any(widening.is_beyond(_range(spark, database, part, own)) for part, own in wide)

        def scale() -> int | None:
            scales = [widening.scale_of(frames[p], own) for p, own, kind in owners if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType)]
            return None if None in scales else max(scales, default=0)

        kind = widening.common_type([kind for _, _, kind in owners], beyond, scale)
        if kind is None:
            raise TypeError(f"column {column} holds {', '.join(sorted({k.simpleString() for _, _, k in owners}))}")
        found[column] = kind
    return found


def _range(spark: SparkSession, database: str, part: str, column: str) -> tuple[int, int] | None:
    """What the write of a part has seen of a column; a part that says nothing is read."""
    known = _properties(spark, f"{database}.{part}").get(_RANGES)
    if known is None:
        return widening.range_of(spark.table(f"{database}.{part}"), column)
    span = json.loads(known).get(column)
    return tuple(span) if span else None


# -- commits ----------------------------------------------------------------------------------------------------


def _select(spark: SparkSession, database: str, parts: Sequence[str], types: dict[str, T.DataType]) -> str:
    """SQL for the rows of parts, columns cast where a part has them in another type."""
    each = []
    for part in parts:
        own = {f.name.lower(): f for f in spark.table(f"{database}.{part}").schema.fields}
        shown = []
        for column, kind in types.items():
            field = own.get(column.lower())
            if field is None:
                shown.append(f"CAST(NULL AS {kind.simpleString()}) AS `{column}`")
            elif field.dataType == kind:
                shown.append(f"`{field.name}` AS `{column}`")
            else:
                shown.append(f"CAST(`{field.name}` AS {kind.simpleString()}) AS `{column}`")
        each.append(f"SELECT {', '.join([*shown, f'`{LOAD}`'])} FROM {database}.{part}")
    return " UNION ALL ".join(each)


def commit(
    spark: SparkSession,
    database: str,
    table: str,
    change: Callable[[Version | None], Sequence[str] | None],
    attempts: int = 20,
) -> tuple[Version | None, list[str]]:
    """Make the next version out of the latest one; returns it, and what its columns became.

    ``change`` gives the parts of the next version for the latest one, or None to leave it. It is called again for
    each version that other loads committed in the meantime, so it must look at what it is given alone.
    """
    for _ in range(attempts):
        base = latest(spark, database, table)
        parts = change(base)
        if parts is None:
            return base, []
        made = Version(database, table, (base.number if base else 0) + 1, tuple(parts))
        try:
            types = shown_types(spark, database, parts)
            told = {_PARENT: str(base.number if base else 0), _PARTS: ",".join(parts), _AT: _now()}
            shown = ", ".join(f"'{k}' = '{v}'" for k, v in told.items())
            spark.sql(f"CREATE VIEW {made.name} TBLPROPERTIES ({shown}) AS {_select(spark, database, parts, types)}")
        except AnalysisException as problem:
            if (problem.getCondition() or "").split(".")[0] not in ("TABLE_OR_VIEW_ALREADY_EXISTS", "TABLE_OR_VIEW_NOT_FOUND"):
                raise
            if latest(spark, database, table) == base:  # nobody else came: this will not get better
                raise
            continue
        show(spark, database, table)
        return made, _changed(spark, base, types)
    raise Conflict(f"{database}.{table}: other loads committed first, {attempts} times")


def _changed(spark: SparkSession, base: Version | None, types: dict[str, T.DataType]) -> list[str]:
    """Columns of the version before whose type is another now."""
    if base is None or not base.parts:
        return []
    try:
        before = spark.table(base.name if base.number else f"{base.database}.{base.parts[0]}").schema.fields
    except AnalysisException:  # dropped meanwhile
        return []
    return [f"{f.name}: {f.dataType.simpleString()} is {types[f.name].simpleString()} now" for f in before if f.name in types and types[f.name] != f.dataType]


def point(spark: SparkSession, database: str, table: str, data: str, version: str) -> None:
    """Make the table's view show ``data``, in one step."""
    columns = [c for c in spark.sql(f"SELECT * FROM {data} LIMIT 0").columns if c != LOAD]
    shown = ", ".join(f"`{c}`" for c in columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.{table} TBLPROPERTIES ('{_SHOWN}' = '{version}') AS SELECT {shown} FROM {data}"
    )


def show(spark: SparkSession, database: str, table: str) -> None:
    """Make the table's view show the latest version, also if another one is committed just now.

    Whoever points it looks again afterwards, so the last to point has seen the last commit.
    """
    while True:
        wanted = latest(spark, database, table)
        point(spark, database, table, wanted.name, wanted.name)
        if latest(spark, database, table) == wanted:
            return


# -- upkeep -----------------------------------------------------------------------------------------------------


def _newest(spark: SparkSession, version: Version) -> list[str]:
    """The newest parts, as long as no older one among them has far more rows than all newer ones together."""
    chosen, total = [], 0
    for part in reversed(version.parts):
        rows = rows_of(spark, Version(version.database, version.table, 0, (part,)))
        if len(chosen) > 1 and rows > FOLD_FACTOR * max(1, total):
            break
        chosen.append(part)
        total += rows
    return chosen[::-1]


def compact(spark: SparkSession, database: str, table: str, newest: bool = False) -> int:
    """Fold a table's parts into one, columns in the types shown; returns how many were folded.

    With ``newest`` only the newest parts, of which each row is rewritten a few times at most, however many appends
    come. Parts that other loads add meanwhile stay beside the folded one; if one of the folded parts was replaced
    meanwhile, the fold is given up.
    """
    base = latest(spark, database, table)
    if base is None or len(base.parts) < 2:
        return 0
    chosen = _newest(spark, base) if newest else list(base.parts)
    # The whole version's types: a fold of some parts must not narrow what the version shows.
    types = shown_types(spark, database, base.parts)
    own = {f.name.lower() for part in chosen for f in spark.table(f"{database}.{part}").schema.fields}
    frame = spark.sql(_select(spark, database, chosen, {c: k for c, k in types.items() if c.lower() in own}))
    made = write_part(spark, database, table, frame, None)

    def folded(now: Version | None) -> list[str] | None:
        if now is None or not set(chosen) <= set(now.parts):
            return None
        at = now.parts.index(chosen[0])
        rest = [p for p in now.parts if p not in chosen]
        return [*rest[:at], made, *rest[at:]]

    version, _ = commit(spark, database, table, folded)
    if version is None or made not in version.parts:
        drop_part(spark, database, made)
        return 0
    return len(chosen)


def drop_versions(spark: SparkSession, database: str, table: str, older_than: timedelta = timedelta(0), current: bool = False) -> int:
    """Drop a table's versions of at least some age, and parts of that age in no version that stays; returns how many parts.

    The version shown stays unless ``current`` asks for it too. What failed loads left behind goes as well. A query that
    still reads a dropped version fails, and so does a load that has not committed its part, so the age should exceed
    the longest query and the longest load.
    """
    last = datetime.now(timezone.utc) - older_than
    mark = last.strftime(_STAMP)
    newest = latest(spark, database, table)
    kept: set[str] = set()
    if newest is not None and not current:
        kept |= set(newest.parts)
    for number, name in sorted(_records(spark, database, table).items()):
        known = _properties(spark, f"{database}.{name}")
        if (current or newest is None or number != newest.number) and known.get(_AT, "") <= mark:
            spark.sql(f"DROP VIEW IF EXISTS {database}.{name}")
        else:
            kept |= set(known.get(_PARTS, "").split(","))
    dropped = 0
    for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{table}__*'").collect():
        name, _, rest = row.tableName.partition("__")
        part = f"{name}__{rest.partition('__')[0]}"  # summaries of a part carry its name and go with it
        if name == table and rest[:1].isdigit() and part not in kept and rest.split("_")[0] <= mark:
            drop_part(spark, database, row.tableName)
            dropped += row.tableName == part
    return dropped


def joined(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
