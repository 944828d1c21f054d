"""Joins whose frequent keys are measured and split; all other rows move as in any join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parameters: the share of the rows from which a key counts as frequent, and the parts that such a key is split into.
SHARE, PARTS = 0.005, 64


def frequent(frame: DataFrame, key: str, share: float = SHARE) -> DataFrame:
    """Keys that more than ``share`` of the rows have: fewer than ``1 / share`` of them, whatever the input."""
    counts = frame.groupBy(key).agg(F.count("*").alias("_n"))
    least = frame.agg((F.count("*") * share).alias("_least")).scalar()
    return counts.where(F.col(key).isNotNull() & (F.col("_n") > least)).select(key)


def join(many: DataFrame, few: DataFrame, key: str, how: str = "inner", share: float = SHARE, parts: int = PARTS) -> DataFrame:
    """``many`` joined with ``few`` on ``key`` (inner, left or left_anti), no frequent key in one task.

    Rows of a frequent key of ``many`` are dealt to ``parts`` parts by their other columns, and the rows of that key in
    ``few`` go to each of them; so ``few`` should have few rows of a key. Rows without a key meet none and are dealt too.
    """
    if how not in ("inner", "left", "left_anti"):
        raise ValueError("how is inner, left or left_anti")
    # Bounded by 1 / share rows, so it fits every task.
    hot = F.broadcast(frequent(many, key, share).select(F.col(key).alias("_hot")))
    plain = [f.name for f in many.schema.fields if f.name != key and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    dealt = F.pmod(F.xxhash64(F.lit(0), *[F.col(f"`{c}`") for c in plain]), F.lit(parts)).cast("int")
    salt = F.when(F.col("_hot").isNotNull() | F.col(f"`{key}`").isNull(), dealt).otherwise(F.lit(0))
    left = many.join(hot, F.col(f"`{key}`") == F.col("_hot"), "left").withColumn("_salt", salt).drop("_hot")
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    right = few.join(hot, F.col(f"`{key}`") == F.col("_hot"), "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [key, "_salt"], how).drop("_salt")
