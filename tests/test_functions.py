"""Joins with frequent keys, and versions in order."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from breakwater.functions import releases, skew
from breakwater.operators import derived


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_a_split_join_equals_a_plain_one(spark, how):
    many = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 500).alias("key"), "id"
    )
    few = spark.range(0, 400, 1).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value")).where("key <> 11")
    few = few.unionByName(few.where("key = 7")).unionByName(spark.range(1).select(F.lit(None).cast("long").alias("key"), F.lit(1).cast("long").alias("value")))
    got, want = skew.join(many, few, "key", how), many.join(few, "key", how)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_third_on_one_key_is_spread(spark):
    """No task of the join holds more than a few times the median, with adaptive splitting off."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key"), "id")
        few = spark.range(30_000).select(F.col("id").alias("key"), (F.col("id") + 1).alias("value"))
        sizes = lambda frame: sorted(r.n for r in frame.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        plain, split = sizes(many.join(few, "key")), sizes(skew.join(many, few, "key"))
        assert plain[-1] > 3 * plain[len(plain) // 2]
        assert sum(split) == sum(plain) and split[-1] < 3 * split[len(split) // 2]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_frequent_keys_are_few(spark):
    rows = spark.range(1000).select((F.col("id") % 10).alias("key"))
    assert skew.frequent(rows, "key", 0.09).count() == 10 and skew.frequent(rows, "key", 0.1).count() == 0
    with pytest.raises(ValueError):
        skew.join(rows, rows, "key", "full")


def test_versions_sort_as_versions(spark):
    rising = ["1.0-rc1", "1.0", "1.0.1", "1.2", "1.9", "1.10", "1.10.0", "2", "10.0", "010.1", "123456789012345678901234567890", "1234567890123456789012345678901"]
    rising[0:2] = ["1.0", "1.0-rc1"]  # a prefix comes first
    shuffled = random.Random(1).sample(rising, len(rising))
    frame = spark.createDataFrame([(v,) for v in shuffled], "version string")
    assert [r.version for r in frame.orderBy(releases.release_key("version")).collect()] == rising
    none = spark.createDataFrame([("",), (None,), ("..-",)], "version string")
    assert none.where(releases.release_key("version").isNotNull()).isEmpty()


def test_the_longest_line_wins(spark):
    installed = [("os", v) for v in ("7.9.2", "7.10.1", "7.9", "7.91", "8", "7", "7.9.1.4", None, "x")] + [("db", "7.9.2"), (None, "7.9")]
    lines = [("os", "7", "2020-01-01"), ("os", "7.9", "2021-01-01"), ("os", "7.9.1", "2022-01-01"), ("os", "7.9", "2021-06-01"), ("os", "7.9.3", "2030-01-01"), (None, "7", "2000-01-01"), ("os", None, "2000-01-01")]
    frame = spark.createDataFrame(installed, "product string, version string")
    listed = spark.createDataFrame(lines, "product string, version string, eol_date string").withColumn("eol_date", F.to_date("eol_date"))
    found = {r.version: (r.entry, str(r.eol_date)) for r in derived.eol_by_version(frame, listed, ["product"], "version", "2025-01-01").collect()}
    assert found == {
        "7.9.2": ("7.9", "2021-06-01"), "7.9": ("7.9", "2021-06-01"), "7.9.1.4": ("7.9.1", "2022-01-01"),
        "7.10.1": ("7", "2020-01-01"), "7.91": ("7", "2020-01-01"), "7": ("7", "2020-01-01"),
    }


@pytest.mark.parametrize("seed", range(2))
def test_lines_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    made = lambda n: ".".join(str(rng.randrange(3)) for _ in range(rng.randrange(1, n)))
    installed, lines = [(f"p{rng.randrange(3)}", made(6)) for _ in range(300)], {(f"p{rng.randrange(3)}", made(4)): rng.randrange(100) for _ in range(40)}
    frame = spark.createDataFrame(installed, "product string, version string")
    listed = spark.createDataFrame([(*k, v) for k, v in lines.items()], "product string, version string, eol_date int")
    want = []
    for product, version in installed:
        own = [(e, d) for (p, e), d in lines.items() if p == product and (version + ".").startswith(e + ".")]
        if own:
            want.append((product, version, *max(own, key=lambda x: len(x[0]))))
    got = releases.longest_entry(frame, listed, ["product"], "version", "eol_date").collect()
    assert sorted(map(tuple, got)) == sorted(want)
