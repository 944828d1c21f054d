"""Export manifests and export date ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the longest date range one export may cover.
MAX_DAYS = 31


def flatten(manifests: DataFrame) -> DataFrame:
    """One row per export and URL: ``id, url, prefix, position, copies``.

    A manifest lists ``result``: prefixes with their URLs. Where a URL is listed
    more than once its last prefix counts; ``position`` is its first place in
    the flat list and ``copies`` how often it is there.
    """
    listed = manifests.select("id", F.posexplode("result").alias("i", "item")).select(
        "id", "i", F.coalesce("item.prefix", F.lit("")).alias("prefix"), F.posexplode("item.urls").alias("j", "url")
    )
    place = F.struct("i", "j")
    return (
        listed.groupBy("id", "url")
        .agg(
            F.max_by("prefix", place).alias("prefix"),
            F.min(place).alias("first"),
            F.count("*").alias("copies"),
        )
        .select("id", "url", "prefix", F.col("first.i").alias("item"), F.col("first.j").alias("position"), "copies")
    )


def date_chunks(
    ranges: DataFrame, start: str = "start_date", end: str = "end_date", max_days: int = MAX_DAYS
) -> DataFrame:
    """Split every date range into chunks of at most ``max_days``: adds ``chunk_start, chunk_end``.

    Adjacent chunks share their boundary date. A range that does not start
    before it ends fails the query.
    """
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    message = F.concat(F.lit("start "), first.cast("string"), F.lit(" must be before end "), last.cast("string"))
    starts = F.when(
        first < last, F.sequence(first, F.date_sub(last, 1), F.make_dt_interval(F.lit(max_days)))
    ).otherwise(F.raise_error(message).cast("array<date>"))
    return ranges.withColumn("chunk_start", F.explode(starts)).withColumn(
        "chunk_end", F.least(F.date_add("chunk_start", max_days), last)
    )
