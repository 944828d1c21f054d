"""Analyses of installed software."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater.functions.ordering import top
from breakwater.tables import Tables


def software_per_asset(t: Tables, limit: int = 50) -> DataFrame:
    """Packages per asset.

    Packages are counted per asset before the join, so an asset that holds a
    large share of them costs one row. The counts are added up again per asset
    and attributes, which gives what joining first would give also where
    ``assets`` repeats an asset.
    """
    per_asset = t.read("asset_software", "assetId").groupBy("assetId").agg(F.count("*").alias("packages"))
    rows = (
        per_asset.join(t.read("assets", "assetId", "hostName", "ip", "osFamily"), "assetId", "left")
        .groupBy("assetId", "hostName", "ip", "osFamily")
        .agg(F.sum("packages").alias("software_count"))
    )
    return top(rows, limit, "-software_count")
