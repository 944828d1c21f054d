"""Which table an export file belongs to."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prefix of an export file, its table, and the source tag its rows get.
ROUTES = (
    ("asset", "assets", None),
    ("asset_vulnerability", "vulnerabilities", None),
    ("vulnerability_exception", "vulnerability_exceptions", None),
    ("asset_policy", "policies", "agent"),
    ("asset_scan_policy", "policies", "scan"),
    ("vulnerability_remediation", "vulnerability_remediation", None),
    ("asset_software", "asset_software", None),
)
PREFIXES = tuple(prefix for prefix, _, _ in ROUTES)

LOAD, SKIP, UNKNOWN = "load", "skip", "unknown"


def normalised(prefix: str = "prefix") -> Column:
    """The known prefix: as it is, else what stands before the first slash; others stay unchanged."""
    whole, base = F.col(prefix), F.substring_index(F.col(prefix), "/", 1)
    return F.when(~whole.isin(*PREFIXES) & base.isin(*PREFIXES), base).otherwise(whole)


def _lookup(values: Iterable[tuple[str, str | None]], key: Column) -> Column:
    return F.coalesce(*[F.when(key == prefix, F.lit(value)) for prefix, value in values])


def route(files: DataFrame, skip: Iterable[str] = ()) -> DataFrame:
    """Add target table, source tag and outcome to rows that have a ``prefix``.

    A prefix is skipped if it, or its normalised form, is in ``skip``. An
    unknown prefix is not an error; its rows come back with that outcome.
    """
    key = F.col("normalised")
    skipped = F.col("prefix").isin(*skip) | key.isin(*skip)
    return (
        files.withColumn("normalised", normalised())
        .withColumn("table_name", _lookup([(p, table) for p, table, _ in ROUTES], key))
        .withColumn("source", _lookup([(p, tag) for p, _, tag in ROUTES], key))
        .withColumn(
            "outcome",
            F.when(skipped, SKIP).when(F.col("table_name").isNull(), UNKNOWN).otherwise(LOAD),
        )
    )
