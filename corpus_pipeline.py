"""The corpus pipeline: filter, deduplicate, mix and encode the documents.

Each stage works on the whole table its predecessor kept, and its decisions take
effect. ``run`` writes every stage's rows to the shared folder and reads them
back, so a lost executor costs the work of one stage at most.

Null texts count as empty in every stage; repeated rows, ties, null ids, empty tables
and extra columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import byte_bpe, exact_dedup, minhash, mixing, quality
from ledgerline.llm.common import table, text_or_empty, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (operator 6), fitted on the labelled ones, accepts."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (operator 5)."""
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (operator 10): five-word shingles, similarity 0.8."""
    return minhash.without_near_copies(docs, width=5)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The curriculum (operator 8): a row per copy taken, in training order."""
    return mixing.curriculum(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row (operator 9), decoded again to check the round trip."""
    docs = docs.select("doc_id", "source", "text", F.sha2(text_or_empty(), 256).alias("digest"))
    coded = byte_bpe.encode(docs, byte_bpe.codec_of(), keep=["doc_id", "source", "digest"], decoded=True)
    return coded.select("doc_id", "source", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("digest")).alias("round_trip"))


STAGES = [("quality", quality_filter), ("exact_dedup", exact_copies), ("near_dedup", near_copies),
          ("mix", source_mix), ("encode", encoding)]

#: The classifier and the shingle links cannot be said in SQL; the tests hold copies,
#: links and ids against plain Python, but the classifier's and the mix's stages only against their operators and bounds.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
