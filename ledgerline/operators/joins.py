"""Left joins of raw rows to a lookup that has one row per key, safe for hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than 1 / PARTS of the rows, so at most PARTS keys are.
PARTS = 200
#: Counters of the frequent-item sketch: its error is well below 1 / PARTS of the rows.
TRACKED = 10_000


def hot_keys(rows: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """(key, _parts) of the hot keys: at most ``parts`` rows, from one pass over the key column.

    The sketch is merged map-side; its estimates decide only how finely a key is dealt out.
    """
    top = rows.agg(F.expr(f"approx_top_k(`{key}`, {parts}, {TRACKED})").alias("top"), F.count(key).alias("total"))
    share = F.col("t.count") * parts / F.col("total")
    return (top.select(F.explode("top").alias("t"), "total").where(share > 1)
            .select(F.col("t.item").alias(key), F.ceil(share).cast("int").alias("_parts")))


def left_join_split(rows: DataFrame, lookup: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """``rows`` left join ``lookup`` (unique per key): hot keys are dealt out over several tasks.

    The rows of a hot key get a slot from a hash of the whole row, and only that key's single
    lookup row is repeated, once per slot. NULL keys match nothing and are dealt out too. The
    broadcast holds at most ``parts`` keys by construction.
    """
    hot = F.broadcast(hot_keys(rows, key, parts))
    slots = F.coalesce("_parts", F.lit(1))
    dealt = F.when(F.col(key).isNull(), F.lit(parts)).otherwise(slots)
    left = (rows.join(hot, key, "left")
            .withColumn("_slot", F.pmod(F.xxhash64(*rows.columns), dealt).cast("int")).drop("_parts"))
    right = (lookup.join(hot, key, "left")
             .withColumn("_slot", F.explode(F.sequence(F.lit(0), slots - 1))).drop("_parts"))
    return left.join(right, [key, "_slot"], "left").drop("_slot")
