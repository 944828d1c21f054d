"""Session settings for large inputs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What one task should get of a shuffle, and the least number of tasks.
TASK_BYTES = 128 * 1024 * 1024
MIN_PARTITIONS = 200


def settings(shuffle_bytes: int | None = None) -> dict[str, str]:
    """Settings the analyses are written for.

    ``shuffle_bytes`` is the largest shuffle expected; adaptive execution merges
    what turns out too small and splits the partitions of a hot key in joins,
    also where that costs one more shuffle.
    """
    chosen = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_bytes is not None:
        wanted = -(-shuffle_bytes // TASK_BYTES)
        chosen["spark.sql.shuffle.partitions"] = str(max(wanted, MIN_PARTITIONS))
    return chosen


def configure(builder: SparkSession.Builder, shuffle_bytes: int | None = None) -> SparkSession.Builder:
    for key, value in settings(shuffle_bytes).items():
        builder = builder.config(key, value)
    return builder
