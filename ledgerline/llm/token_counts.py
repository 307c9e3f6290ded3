"""Token counts: pieces counted once per distinct pre-token, joined and summed.

A pre-token is a maximal run of characters without ASCII white space, in lower
case where that cannot matter. The tokenizer drops white space and neither its
normaliser nor its split pattern joins anything across it, so a text's count is
the sum over its pre-tokens; what the library does inside one (normalising,
splitting, special strings) it does itself, once per distinct pre-token.

1. Document frequencies of all pre-tokens: counted per task, then summed.
2. The library counts the tokens of each distinct pre-token (a written table).
3. Frequent pre-tokens (at most ``hot_rows`` of at most 64 bytes, by a histogram
   of frequencies) are broadcast; documents sum those map-side. The other
   pre-tokens of each document go through a shuffle join, in which no key is
   frequent, and are summed per document. No id is ever made.

Defined cases: a null or blank text has 0 tokens; each input row gives one row,
repeated ones too; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.byte_bpe import slices
from ledgerline.llm.common import small_batches, table, text_or_empty, written

VOCABULARY = "word_bpe_49k.json"
HOT_ROWS = 1 << 18
HOT_BYTES = 64
LIMIT = 2048


def pre_tokens(text: bytes) -> list[bytes]:
    """Lower-casing A-Z first merges most keys; a text that may spell a special string keeps its case.

    So does a pre-token with a combining mark (U+0300 to U+036F begin with 0xCC or 0xCD, which no other
    place of UTF-8 holds): the library composes before it lower-cases, and j may compose where J does not.
    """
    if b"<|" in text:
        return text.split()
    if b"\xcc" in text or b"\xcd" in text:
        return [p if b"\xcc" in p or b"\xcd" in p else p.lower() for p in text.split()]
    return text.lower().split()


def frequencies(docs: DataFrame) -> DataFrame:
    """(piece, docs): the number of documents that hold each pre-token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                found.update(set(pre_tokens(text)))
            if len(found) > 500_000:  # sums later; only memory depends on it
                yield from parts(found)
                found = Counter()
        yield from parts(found)

    def parts(found: Counter) -> Iterator[pa.RecordBatch]:
        keys = list(found)
        for i in range(0, len(keys), 50_000):
            some = keys[i:i + 50_000]
            yield pa.RecordBatch.from_pydict({"piece": pa.array(some, pa.binary()), "docs": pa.array([found[k] for k in some], pa.int64())})

    return docs.select("text").mapInArrow(count, "piece binary, docs long").groupBy("piece").agg(F.sum("docs").alias("docs"))


def piece_counts(pieces: DataFrame, path: str) -> DataFrame:
    """``pieces`` with the tokens of each, by the library."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        for batch in slices(batches, "piece"):
            texts = [p.decode("utf-8", "replace") for p in batch.column("piece").to_pylist()]
            n = [len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], names=["piece", "docs", "tokens"])

    return pieces.mapInArrow(count, "piece binary, docs long, tokens long")


def frequent(counted: DataFrame, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, int]:
    """The pre-tokens to broadcast and the least document frequency of them.

    A histogram over frequencies (8 steps per power of two, so a few hundred
    rows) gives the lowest step from which at most ``hot_rows`` are left.
    """
    step = F.floor(F.log2("docs") * 8)
    short = counted.where(F.octet_length("piece") <= HOT_BYTES)
    bars = sorted(short.groupBy(step.alias("s")).count().collect(), key=lambda r: -r["s"])
    least, total = None, 0
    for bar in bars:
        total += bar["count"]
        if total > hot_rows:
            break
        least = bar["s"]
    return (short.where(step >= least) if least is not None else short.limit(0)), least


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens."""
    docs = small_batches(docs).select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(f"`{text_col}`").cast("binary").alias("text"))
    counted = written(piece_counts(frequencies(docs), path), "pieces")
    hot, least = frequent(counted, hot_rows)
    known = docs.sparkSession.sparkContext.broadcast({bytes(r["piece"]): r["tokens"] for r in hot.select("piece", "tokens").toLocalIterator()})
    cold = counted.where((F.octet_length("piece") > HOT_BYTES) | (F.floor(F.log2("docs") * 8) < F.lit(least))) if least is not None else counted

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = known.value
        for batch in slices(batches, "text"):
            sums, rest = [], []
            for text in batch.column("text").to_pylist():
                total, left = 0, []
                for piece, n in Counter(pre_tokens(text)).items():
                    of = tokens.get(piece)
                    if of is None:
                        left.append((piece, n))
                    else:
                        total += n * of
                sums.append(total)
                rest.append(left)
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("doc_id"), pa.compute.binary_length(batch.column("text")).cast(pa.int64()),
                pa.array(sums, pa.int64()), pa.array([[{"piece": p, "n": n} for p, n in x] for x in rest],
                                                     pa.list_(pa.struct([("piece", pa.binary()), ("n", pa.int64())])))],
                names=["row", "doc_id", "n_bytes", "sum", "rest"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        tally, "row long, doc_id long, n_bytes long, sum long, rest array<struct<piece:binary,n:long>>")
    # A row without rare pre-tokens gets a key that no pre-token equals (it holds a space) and that is its own.
    nothing = F.array(F.struct(F.concat(F.lit(" "), F.col("row").cast("string")).cast("binary").alias("piece"), F.lit(0).cast("long").alias("n")))
    rare = rows.select("row", "doc_id", "n_bytes", "sum", F.inline(F.when(F.size("rest") > 0, F.col("rest")).otherwise(nothing)))
    return (rare.join(cold.select("piece", "tokens"), "piece", "left")
            .groupBy("row", "doc_id", "n_bytes", "sum")
            .agg(F.sum(F.col("n") * F.coalesce("tokens", F.lit(0))).alias("rest"))
            .select("doc_id", "n_bytes", (F.col("sum") + F.col("rest")).alias("n_tokens")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
