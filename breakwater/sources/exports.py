"""From a finished export to loaded tables, a ledger entry and a report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breakwater.sources.ledger import COMPLETE, EXPORT_TYPES, NEVER_REUSED, ExportLedger, by_id
from breakwater.sources.loader import LoadReport, load
from breakwater.sources.manifest import flatten

# Statuses under which an export has its files; what a policy load leaves out.
READY = (COMPLETE, "SUCCEEDED")
POLICY_SKIPS = ("asset",)


def load_export(
    spark: SparkSession,
    database: str,
    ledger: ExportLedger,
    manifest: DataFrame,
    export_type: str = "vulnerability",
    locate: Callable[[str], str] = str,
    once: bool = False,
) -> LoadReport:
    """Load the one export that ``manifest`` (``id, status, result``) describes.

    ``locate`` gives the place a URL's file was put, on storage that the
    cluster reads. Policy exports leave assets alone, remediation exports add
    to what is there, others replace. Rows carry the export's id, so an export
    whose ledger row was lost adds nothing when it is loaded again. With
    ``once``, an export that the ledger already holds as complete is not looked
    at. If a table failed, the report says so and the ledger keeps no row.
    """
    if export_type not in EXPORT_TYPES:
        raise ValueError(f"export_type is one of {', '.join(EXPORT_TYPES)}")
    header = manifest.select("id", "status").first()
    if header is None:
        raise ValueError("the manifest describes no export")
    if header.status not in READY:
        raise ValueError(f"export {header.id} is {header.status}, not complete")
    done = by_id(ledger.exports(), header.id).where(F.col("status") == COMPLETE)
    if once and not done.isEmpty():
        return LoadReport(warnings=[f"export {header.id} is loaded already"])
    files = flatten(manifest).orderBy("item", "position").collect()
    if not files:
        raise ValueError(f"export {header.id} is complete but has no files")
    by_prefix: dict[str, list[str]] = {}
    for file in files:
        by_prefix.setdefault(file.prefix, []).extend([locate(file.url)] * file.copies)
    report = load(
        spark,
        database,
        by_prefix,
        skip=POLICY_SKIPS if export_type == "policy" else (),
        append=export_type == NEVER_REUSED,
        load_id=header.id,
    )
    if report.failures:
        return report
    ledger.save(
        header.id,
        COMPLETE,
        [file.url for file in files for _ in range(file.copies)],
        row_count=report.total,
        export_type=export_type,
    )
    return report
