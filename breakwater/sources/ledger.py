"""Ledger of exports: what was exported when, and what became of it.

Every save adds a row with the next arrival number. The state of an export is
derived: date and time of its first row, everything else of its last.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breakwater.functions.ordering import top
from breakwater.schemas import LEDGER
from breakwater.sources import versions

# Export types, the status that counts as done, the type that is never reused.
EXPORT_TYPES = ("vulnerability", "policy", "remediation", "asset_software")
COMPLETE = "COMPLETE"
NEVER_REUSED = "remediation"
STALE_AFTER_DAYS = 1

_LATEST = ("status", "file_count", "row_count", "parquet_urls", "local_files", "export_type")


def with_file_count(events: DataFrame) -> DataFrame:
    return events.withColumn("file_count", F.coalesce(F.array_size("parquet_urls"), F.lit(0)))


def current(events: DataFrame) -> DataFrame:
    """One row per export: first dates, latest values (NULL where the latest is NULL)."""
    return (
        events.groupBy("export_id")
        .agg(
            F.min_by(F.struct("export_date", "created_at"), "seq").alias("first"),
            F.max_by(F.struct(*_LATEST), "seq").alias("last"),
        )
        .select("export_id", "first.*", "last.*")
    )


def completed_on(exports: DataFrame, day: date | str, export_type: str = "vulnerability") -> DataFrame:
    """The newest complete export of a day and type: one row or none."""
    hits = exports.where(
        (F.col("export_date") == F.lit(str(day)).cast("date"))
        & (F.col("status") == COMPLETE)
        & (F.col("export_type") == export_type)
    )
    return top(hits, 1, "-created_at")


def newest_complete(exports: DataFrame) -> DataFrame:
    """The newest complete export of every day and type."""
    return (
        exports.where(F.col("status") == COMPLETE)
        .groupBy("export_date", "export_type")
        .agg(F.max(F.struct("created_at", "export_id")).alias("newest"))
        .select("export_date", "export_type", "newest.export_id", "newest.created_at")
    )


def reuse_decision(requests: DataFrame, exports: DataFrame) -> DataFrame:
    """For requests (``export_date, export_type``): the export to reuse, if one may be."""
    answer = F.when(F.col("export_type") != NEVER_REUSED, F.col("export_id"))
    return requests.join(newest_complete(exports), ["export_date", "export_type"], "left").select(
        *requests.columns, answer.alias("reused_export_id"), answer.isNotNull().alias("reuse")
    )


def by_id(exports: DataFrame, export_id: str) -> DataFrame:
    return exports.where(F.col("export_id") == export_id)


def recent(exports: DataFrame, limit: int = 10, export_type: str | None = None) -> DataFrame:
    """Newest exports, optionally of one type."""
    rows = exports.select(
        "export_id", "export_date", "created_at", "status", "file_count", "row_count", "export_type"
    )
    return top(rows if export_type is None else rows.where(F.col("export_type") == export_type), limit, "-created_at")


def staleness(exports: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Newest export date per type, and whether it is too old."""
    day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    age = F.datediff(day, F.col("last_export_date"))
    return (
        exports.groupBy("export_type")
        .agg(F.max("export_date").alias("last_export_date"))
        .withColumn("age_days", age)
        .withColumn("stale", F.col("age_days") > STALE_AFTER_DAYS)
    )


class ExportLedger:
    """The ledger kept in the catalogue as versions of a table (see ``versions``); any number of writers.

    Every save is a part of its own and its arrival number is that of the version it commits, so numbers are given in
    the order of commits, no two saves get the same one and no save reads what is there. Small parts are folded as they
    come, and by ``compact``, while saves go on.
    """

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table
        self._database, self._name = table.rsplit(".", 1) if "." in table else (spark.catalog.currentDatabase(), table)
        if versions.latest(spark, self._database, self._name) is None:
            self._commit_alone(spark.createDataFrame([], LEDGER), only_if_none=True)

    def _written(self, rows: DataFrame) -> str:
        held = rows.coalesce(1).withColumn(versions.LOAD, F.col("export_id"))
        return versions.write_part(self.spark, self._database, self._name, held, None)

    def _commit_alone(self, rows: DataFrame, only_if_none: bool = False) -> None:
        """A version of these rows and no others."""
        part = self._written(rows)
        change = lambda now: None if only_if_none and now is not None else [part]
        made, _ = versions.commit(self.spark, self._database, self._name, change)
        if made is None or part not in made.parts:
            versions.drop_part(self.spark, self._database, part)

    def events(self) -> DataFrame:
        return self.spark.table(self.table)

    def exports(self) -> DataFrame:
        return current(self.events())

    def save(
        self,
        export_id: str,
        status: str,
        parquet_urls: Sequence[str] | None,
        local_files: Sequence[str] | None = None,
        row_count: int | None = None,
        export_type: str = "vulnerability",
        at: datetime | None = None,
    ) -> None:
        """Insert an export, or update all of it but its dates."""
        at = at or datetime.now()
        while True:
            base = versions.latest(self.spark, self._database, self._name)
            number = base.number + 1
            row = (
                number, export_id, at.date(), at, status, None, row_count,
                None if parquet_urls is None else list(parquet_urls),
                None if local_files is None else list(local_files),
                export_type,
            )
            part = self._written(with_file_count(self.spark.createDataFrame([row], LEDGER)))
            # The number is that of the next version, so another save that took it sends this one back.
            change = lambda now, base=base, part=part: [*now.parts, part] if now == base else None
            made, _ = versions.commit(self.spark, self._database, self._name, change)
            if made is not None and part in made.parts:
                break
            versions.drop_part(self.spark, self._database, part)
        if len(made.parts) > versions.MOST_PARTS:
            versions.compact(self.spark, self._database, self._name, newest=True)

    def compact(self) -> None:
        """Merge the parts of many saves into one; saves may go on meanwhile."""
        versions.compact(self.spark, self._database, self._name)

    def today(self, export_type: str = "vulnerability", day: date | None = None) -> DataFrame:
        return completed_on(self.exports(), day or date.today(), export_type)

    def get(self, export_id: str) -> DataFrame:
        return current(by_id(self.events(), export_id))

    def recent(self, limit: int = 10, export_type: str | None = None) -> DataFrame:
        return recent(self.exports(), limit, export_type)

    def purge(self) -> None:
        """Forget all exports; numbers go on."""
        self._commit_alone(self.spark.createDataFrame([], LEDGER))
