"""The left join that deals out hot keys."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from ledgerline.operators.joins import hot_keys, left_join_split


def skewed(spark):
    """A third of the rows on key 7, a tenth without a key, the rest on keys of their own."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") + 100)
    return spark.range(9000).select(key.cast("long").alias("k"), F.col("id").alias("n"))


def test_equals_a_plain_join(spark):
    rows = skewed(spark).union(skewed(spark).limit(50))  # repeated rows too
    lookup = spark.range(20).union(spark.range(2000, 6000)).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = left_join_split(rows, lookup, "k")
    assert got.columns == ["k", "n", "v"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, rows.join(lookup, "k", "left").collect()))
    empty = left_join_split(rows.limit(0), lookup, "k")
    assert empty.count() == 0
    assert left_join_split(rows, lookup.limit(0), "k").where("v is null").count() == rows.count()


def test_hot_key_is_dealt_out(spark):
    rows = skewed(spark)
    hot = {r["k"]: r["_parts"] for r in hot_keys(rows, "k").collect() if r["k"] is not None}
    assert set(hot) == {7} and 50 <= hot[7] <= 100  # a third of the rows, over a share of 1 / 200 each
    lookup = spark.range(10_000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for c, v in zip(old, ("-1", "50", "false")):
            spark.conf.set(c, v)
        joined = left_join_split(rows, lookup, "k").withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("task").count().collect()]
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert max(sizes) < 900  # the hot key alone has 3000 of the 9000 rows
