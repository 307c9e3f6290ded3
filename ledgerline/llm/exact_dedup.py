"""Exact deduplication with a heavy-hitter split.

1. One pass over the texts writes a digest table (doc_id, SHA-256 of the
   normalised text); everything after it moves 32-byte digests, never texts.
2. Misra-Gries summaries (at most ``counters`` digests per partition) are
   summed. A digest with more than 2 n / counters rows is certain to be among
   the ``counters`` largest sums, so that bounded list holds every heavy hitter.
3. The candidates are counted exactly (partial aggregation, one row per digest
   and map task). Those with more than 2 n / counters rows are verified heavy
   hitters, fewer than ``counters / 2`` of them by arithmetic; they are broadcast
   and their rows resolved map-side.
4. The remaining digests use an ordinary shuffle: aggregate, join back.

Defined cases: a null text counts as empty; rows repeated with the same doc_id
share its fate (all are kept if that doc_id wins); a null doc_id never wins
against a number, and in a group of null ids alone keep_id is null and the rows
are kept, like repeated rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import nested, table, text_or_empty, written

COUNTERS = 1024


def normalised(text_col: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text_col), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of the text with each run of ASCII white space as one space."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(normalised(text_col), 256)).alias("digest"))


def misra_gries(k: int):
    """A mapInPandas function: the Misra-Gries summary of a partition's digests."""

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters: dict[bytes, int] = {}
        for batch in batches:
            for digest, n in batch["digest"].value_counts(sort=False).items():
                counters[digest] = counters.get(digest, 0) + int(n)
            if len(counters) > k:  # take the (k + 1)-th largest count off all of them
                cut = sorted(counters.values(), reverse=True)[k]
                counters = {d: n - cut for d, n in counters.items() if n > cut}
        yield pd.DataFrame({"digest": list(counters), "n": list(counters.values())},
                           columns=["digest", "n"]).astype({"n": "int64"})

    return summarise


def heavy_hitters(digest_table: DataFrame, n_rows: int, counters: int = COUNTERS) -> DataFrame:
    """Verified heavy digests: (digest, keep_id, group_size), fewer than ``counters`` / 2 rows."""
    candidates = (digest_table.select("digest")
                  .mapInPandas(misra_gries(counters), "digest binary, n long")
                  .groupBy("digest").agg(F.sum("n").alias("n"))
                  .orderBy(F.desc("n"), "digest").limit(counters).select("digest"))
    candidates = written(candidates, "heavy-candidates")
    exact = (digest_table.join(F.broadcast(candidates), "digest")  # at most `counters` rows
             .groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    return written(exact.where(F.col("group_size") * counters > 2 * n_rows), "heavy")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, digest, keep_id, group_size, kept."""
    rows = written(digests(docs, id_col, text_col), "digests")
    heavy = heavy_hitters(rows, rows.count(), counters)
    resolved = rows.join(F.broadcast(heavy), "digest")  # fewer than counters / 2 rows
    rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    groups = rest.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return (resolved.unionByName(rest.join(groups, "digest"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))))


def without_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    The kept (doc_id, digest) pairs are unique per group but for repeated rows; those
    are cut to one in the same partitioning as the join.
    """
    kept = exact_duplicates(docs, counters=counters).where("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    one = nested(docs).withColumns({"_exact_id": F.col("_row.doc_id").cast("long"), "_exact_digest": F.unhex(F.sha2(normalised("_row.text"), 256))})
    met = one.join(kept, F.col("_exact_id").eqNullSafe(F.col("_id")) & (F.col("_exact_digest") == F.col("_digest")), "left_semi")
    return met.dropDuplicates(["_exact_id", "_exact_digest"]).select("_row.*")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
