from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from breakwater.llm import queries, shards


def loads(rows):
    found = {}
    for r in rows:
        found[r.shard] = found.get(r.shard, 0) + r.size
    return found


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op9_kd_shards(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.size == len((texts[r.doc_id] or "").encode()) + 1
        assert r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode())
        assert r.law == "bytes" and r.grown_shard is None
    found = loads(rows)
    assert set(found) == set(range(16))
    assert max(found.values()) - min(found.values()) <= 4 * max(r.size for r in rows)
    for s in found:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


@pytest.mark.parametrize("count", [1, 3, 7])
def test_hot_text_and_repeated_rows(spark, count):
    """A third of all rows is one row over and over; shards still come out even."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"),
        F.lit(None).cast("string").alias("source"),
        F.lit("x").alias("shard"),
        F.lit(3).alias("slot"),
    )
    found = shards.document_shards(rows, count).collect()
    assert len(found) == 6000
    even = sum(r.size for r in found) / count
    assert all(abs(v - even) < 0.02 * even for v in loads(found).values())
    assert set(loads(found)) == set(range(count))
    for s in range(count):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))


def test_small_groups_stay_together(spark):
    rows = spark.range(9000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 3000).cast("string")).alias("text"))
    divided = shards.document_shards(rows, 4).groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).where("n > 1")
    assert divided.count() <= 3


def test_nulls_few_rows_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, None, None), (1, "", "s"), (1, None, "s")], "doc_id long, text string, source string")
    assert sorted((r.size, r.text_crc32) for r in shards.document_shards(rows).collect()) == [(1, 0)] * 3
    assert shards.document_shards(rows.limit(0)).count() == 0


def test_target_bytes_by_widest_dimension(spark):
    """With one dimension wide and one flat, the cut follows the wide one at its weighted median."""
    rows = spark.range(1000).select(
        "id", (F.col("id") * 4_000_000).alias("wide"), F.lit(7).cast("long").alias("flat"),
        F.when(F.col("id") < 100, 9).otherwise(1).cast("long").alias("w"),
    )
    placed = shards.split(rows, ["flat", "wide"], "w", 2, "id", "id").collect()
    assert max(r.id for r in placed if r.shard == 0) == min(r.id for r in placed if r.shard == 1) - 1
    assert abs(sum(r.w for r in placed if r.shard == 0) - 900) <= 9
