"""What is loaded, as DataFrames and JSON, and how to remove it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breakwater.schemas import KNOWN_TABLES
from breakwater.sources.ledger import ExportLedger
from breakwater.sources.loader import drop_versions
from breakwater.tables import Tables

# How times appear in JSON results.
_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
}


def has_data(t: Tables) -> bool:
    """True if at least one known table exists, with or without rows."""
    return len(t) > 0


def schema(spark: SparkSession, t: Tables) -> DataFrame:
    """Columns of the loaded tables: ``table_name, ordinal, column_name, data_type``."""
    rows = [
        (name, i, f.name, f.dataType.simpleString())
        for name in KNOWN_TABLES
        if name in t
        for i, f in enumerate(t[name].schema.fields, 1)
    ]
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, data_type string")


def overview(t: Tables) -> DataFrame:
    """Per loaded table: number of columns, number of rows, and whether there are any."""
    return reduce(
        DataFrame.unionByName,
        [
            t[name]
            .agg(F.count("*").alias("row_count"))
            .select(
                F.lit(name).alias("table_name"),
                F.lit(len(t[name].columns)).alias("column_count"),
                "row_count",
                (F.col("row_count") > 0).alias("has_rows"),
            )
            for name in KNOWN_TABLES
            if name in t
        ],
    )


def json_rows(frame: DataFrame) -> DataFrame:
    """Every row as one JSON object in the column ``json``; NULLs are kept."""
    return frame.select(F.to_json(F.struct("*"), _JSON).alias("json"))


def write_json(frame: DataFrame, path: str) -> None:
    """Every row as one line of JSON in the files under ``path``."""
    frame.write.mode("overwrite").options(**_JSON).json(path)


def purge(spark: SparkSession, database: str, ledger: ExportLedger | None = None) -> None:
    """Remove every known table and, if given, empty the ledger."""
    for table in KNOWN_TABLES:
        spark.sql(f"DROP VIEW IF EXISTS {database}.{table}")
        drop_versions(spark, database, table, current=True)
    if ledger is not None:
        ledger.purge()
