"""Append loads that never load a file twice.

An append load adds whatever it is given, so loading a chunk again doubles it.
Here the file source keeps the list of files it has read and the file sink the
list of files it has finished. A run adds the files that arrived since the last
one, and a run that was cut short continues without losing or repeating rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from breakwater.schemas import KNOWN_TABLES
from breakwater.sources.loader import FED, point


def append_arrivals(
    spark: SparkSession,
    database: str,
    table: str,
    folder: str,
    schema: T.StructType,
    feed: str,
    rows: str,
    files_per_batch: int | None = None,
) -> int:
    """Add the Parquet files that are new in ``folder`` to ``table``; returns its total rows.

    Columns that a file lacks are NULL. ``rows`` is the folder that keeps the
    table's rows; ``feed`` names the progress in the folder that
    ``spark.checkpoint.dir`` names. The two belong together: starting over takes
    new ones. The table takes no other append loads.
    """
    if table not in KNOWN_TABLES:
        raise ValueError(f"not a table of this model: {table}")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        raise LookupError("set spark.checkpoint.dir to a folder that all executors share")
    home = f"{shared.rstrip('/')}/breakwater/{feed}"
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    (
        reader.parquet(folder)
        .writeStream.format("parquet")
        .option("path", rows)
        .option("checkpointLocation", f"{home}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    point(spark, database, table, f"parquet.`{rows}`", FED)
    return spark.table(f"{database}.{table}").count()
