"""Helpers shared by the operators: written tables, safe columns, components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This cuts the lineage with a file that outlives a lost executor, and lets
    several later steps read the rows without computing them again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def nested(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column ``_row``, so that no column of it can clash with a new one."""
    return docs.select(F.struct("*").alias("_row"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has."""
    while name.lower() in map(str.lower, df.columns):
        name = "_" + name
    return name


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the batches that go to Python by bytes, where the session has Spark's default of 64 MB.

    A task holds a batch several times over (JVM, Arrow, Python objects).
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, "67108864b") == "67108864b":
        conf.set(BATCH_SETTING, "4m")
    return df


def give_back() -> None:
    """Return freed memory to the system at a task's end, as its Python process waits for others."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Rows sorted by ``keys``, regrouped so that no group is cut between two tables."""
    rest = None
    for batch in batches:
        got = pa.Table.from_batches([batch])
        got = got if rest is None else pa.concat_tables([rest, got]).combine_chunks()
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in (got.column(n).to_numpy() for n in keys)], axis=0))
        cut = int(change[-1]) + 1 if len(change) else 0  # the last group may go on in the next batch
        if cut:
            yield got.slice(0, cut)
        rest = got.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest
    del rest
    give_back()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Component of every vertex of ``edges`` (a, b), named by its smallest vertex.

    Alternates the large-star and small-star steps (Kiveris et al., 2014) until
    the edge set stops changing: each step links the neighbours of a vertex to
    the smallest one, so chains shorten geometrically. The minimum per vertex is
    aggregated before the shuffle, so the centre of a large star costs one row
    per map task; the join back is a plain equi-join that adaptive execution can
    split. Every round is written, so no round depends on a lost executor.

    Returns (v, component) for the vertices that occur in an edge with a != b.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                 F.least("a", "b").alias("b")).distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        edges = written(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                        .union(low.select("a", F.col("m").alias("b"))).distinct(), "cc")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                          F.count_distinct("a")).first()
        if state[0] == state[2] and state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (edges.select(F.col("a").alias("v"), F.col("b").alias("component"))
            .union(edges.select(F.col("b").alias("v"), F.col("b").alias("component")).distinct()))
