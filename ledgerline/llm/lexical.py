"""Ranked lexical search by the Best Position Algorithm over impact lists.

1. The texts of the items are taken in blocks of at most ``BLOCK_BYTES`` (or one text);
   a block's terms are the vocabulary that its pass over the documents looks for. One
   block is broadcast at a time, so what is broadcast has that bound however many items
   there are. Equal texts are searched once.
2. A pass over the documents counts each one's terms and keeps, per document, the block's
   terms with their frequencies (written). The number of documents, their terms and each
   term's document frequency are aggregates of that table.
3. Each task turns its rows into shards of bounded size and searches them where they are;
   postings are never shuffled. A shard has a list per term, ordered by falling impact, and
   the postings of each document for direct access. For an item the search reads on behind
   the *best position* of each of its lists (the end of the positions seen without a gap),
   scores the new documents by direct access, which marks their positions in all lists as
   seen, moves the best positions, and stops when the sum of the impacts at the best
   positions is strictly below the k-th score found so far in the task. A document not
   seen then has less than the k-th score in its own right, and ties have been seen.
4. The tasks' best k of each item are ranked together.

All score arithmetic is 64-bit integer but for the logarithm of a term's weight.

Defined cases: null or wordless documents count for nothing and are never found; a null or
wordless item finds nothing; each row of items is an item and each row of documents a document,
repeated ones too; equal scores go by ascending doc_id, null ids last; very long texts are read
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.byte_bpe import slices
from ledgerline.llm.common import give_back, small_batches, table, text_or_empty, written

TOP = 10
#: Bytes of item texts searched in one pass over the documents.
BLOCK_BYTES = 1 << 20
#: Postings of a shard, which one task holds in memory.
SHARD = 2_000_000
#: Positions of each list read at first; doubled each time the threshold does not stop.
FIRST_READ = 16

#: Each byte of UTF-8 as a term's byte, or a space between terms: ASCII other than letters and digits.
TERM_BYTES = bytes(ord(chr(b).lower()) if b > 127 or chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))
LOCAL = "text_id binary, score long, doc_id long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split(b" ")


def counted(text: bytes) -> Counter[bytes]:
    found = Counter(terms_of(text))
    found.pop(b"", None)
    return found


def blocks_of(items: DataFrame, most: int) -> Iterator[list[tuple[bytes, bytes]]]:
    """The distinct texts, by digest, in blocks of at most ``most`` bytes or one text."""
    texts = written(items.select(F.sha2("text", 256).cast("binary").alias("text_id"), "text").groupBy("text_id").agg(F.any_value("text").alias("text")), "item-texts")
    size, parts = F.octet_length("text"), 1
    block = lambda: F.pmod(F.xxhash64("text_id"), F.lit(parts))
    while True:
        worst = texts.groupBy(block().alias("b")).agg(F.sum(size).alias("size"), F.count("*").alias("n")).where("n > 1").agg(F.max("size")).first()[0]
        if (worst or 0) <= most:
            break
        parts *= 2
    for b in range(parts):
        if rows := texts.where(block() == b).collect():
            yield [(bytes(r["text_id"]), r["text"].encode()) for r in rows]


def occurrences(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Documents with terms: doc_id, n, and the vocabulary's terms in them with frequencies."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in slices(batches, "text"):
            keep, n, terms, tfs, ends = [], [], [], [], [0]
            for row, text in enumerate(batch.column("text").to_pylist()):
                words = terms_of(text)
                of = len(words) - words.count(b"")
                if of:
                    found = Counter(map(number.get, words))
                    found.pop(None, None)
                    keep.append(row)
                    n.append(of)
                    terms.extend(found)
                    tfs.extend(found.values())
                    ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<long>")


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the half-open ranges, one range after the other."""
    n = ends - starts
    return np.repeat(starts - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


class Best:
    """The best k (score, doc) of one item, ties by document number; kept over a task's shards."""

    def __init__(self, k: int):
        self.k, self.scores, self.docs = k, np.zeros(0, "int64"), np.zeros(0, "int64")

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        if len(self.scores) == self.k:
            some = scores >= self.scores[-1]
            scores, docs = scores[some], docs[some]
        scores, docs = np.concatenate([self.scores, scores]), np.concatenate([self.docs, docs])
        order = np.lexsort((docs, -scores))[:self.k]
        self.scores, self.docs = scores[order], docs[order]

    def least(self) -> int:
        """The k-th score, or 0 while there are fewer."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 0


class Shard:
    """Impact lists and document rows of some documents; ``docs`` are their ids in ascending order."""

    def __init__(self, docs: np.ndarray, rows: np.ndarray, terms: np.ndarray, impacts: np.ndarray, size: int):
        self.docs, self.term, self.impact = docs, terms, impacts
        self.row_at = np.searchsorted(rows, np.arange(len(docs) + 1))
        order = np.lexsort((rows, -impacts, terms))
        self.list_doc, self.list_impact = rows[order], impacts[order]
        self.list_at = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=size))])
        self.place = np.empty(len(order), "int64")
        self.place[order] = np.arange(len(order))
        self.seen, self.scored = np.zeros(len(order), bool), np.zeros(len(docs), bool)
        self.weight = np.zeros(size, "int64")

    def search(self, terms: np.ndarray, repeats: np.ndarray, best: Best) -> int:
        """Adds the shard's best documents for an item; returns how many documents it scored."""
        some = self.list_at[terms] < self.list_at[terms + 1]
        terms, repeats = terms[some], repeats[some]
        at, end = self.list_at[terms], self.list_at[terms + 1]  # ``at``: behind the best position
        self.weight[terms] = repeats
        read, touched, scored = FIRST_READ, [], []
        while len(at):
            docs = self.list_doc[ranges(at, np.minimum(at + read, end))]
            new = np.unique(docs[~self.scored[docs]])
            if len(new):
                rows = ranges(self.row_at[new], self.row_at[new + 1])
                weight = self.weight[self.term[rows]]
                own = np.flatnonzero(weight)
                owner = np.repeat(np.arange(len(new)), self.row_at[new + 1] - self.row_at[new])[own]
                rows = rows[own]
                scores = np.add.reduceat(weight[own] * self.impact[rows], np.flatnonzero(np.diff(owner, prepend=-1)))
                places = self.place[rows]
                self.seen[places] = True
                self.scored[new] = True
                touched.append(places)
                scored.append(new)
                best.add(scores, self.docs[new])
            for k, (a, e) in enumerate(zip(at.tolist(), end.tolist())):
                step = int(self.seen[a:e].argmin())
                at[k] = a + step if not self.seen[a + step] else e
            open_ = at < end
            at, end, repeats = at[open_], end[open_], repeats[open_]
            if int((repeats * self.list_impact[at - 1]).sum()) < best.least():
                break
            read *= 2
        self.weight[terms] = 0
        for places in touched:
            self.seen[places] = False
        for new in scored:
            self.scored[new] = False
        return sum(map(len, scored))


def impacts_of(n: np.ndarray, tf: np.ndarray, weight: np.ndarray, count: int, total: int) -> np.ndarray:
    """Impact of postings: term weight times saturated frequency, in whole numbers."""
    product = 75 * int(n.max(initial=0)) * count
    m = 25 + ((75 * n * count) // total if product < 2**63 else np.array([75 * int(x) * count // total for x in n], "int64"))
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def shards(batches: Iterator[pa.RecordBatch], weights: np.ndarray, count: int, total: int, most: int) -> Iterator[Shard]:
    """Rows of ``occurrences`` as shards of about ``most`` postings."""
    held, size = [], 0

    def made() -> Shard:
        ids, n, terms, tfs = (pa.concat_arrays([b.column(c) for b in held]) for c in range(4))
        ids = np.array([2**63 - 1 if x is None else x for x in ids.to_pylist()], "int64")
        lengths = np.diff(terms.offsets.to_numpy())
        by_id = np.argsort(ids, kind="stable")
        terms_, tfs_ = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
        starts = np.cumsum(lengths) - lengths
        take = ranges(starts[by_id], starts[by_id] + lengths[by_id])
        rows = np.repeat(np.arange(len(ids)), lengths[by_id])
        terms_, n_ = terms_[take].astype("int64"), n.to_numpy()[by_id][rows]
        impact = impacts_of(n_, tfs_[take], weights[terms_], count, total)
        some = impact > 0
        return Shard(ids[by_id], rows[some], terms_[some], impact[some], len(weights))

    for batch in batches:
        held.append(batch)
        size += len(batch.column("terms").flatten())
        if size >= most:
            yield made()
            held, size = [], 0
    if held:
        yield made()


def block_results(docs: DataFrame, block: list[tuple[bytes, bytes]], top: int, shard: int) -> DataFrame:
    """The best ``top`` documents of each task for the block's texts: text_id, score, doc_id."""
    spark = docs.sparkSession
    found = [(text_id, counted(text)) for text_id, text in block]
    vocabulary = {t: k for k, t in enumerate(sorted({t for _, terms in found for t in terms}))}
    queries = [(text_id, np.array([vocabulary[t] for t in terms], "int64"), np.array(list(terms.values()), "int64")) for text_id, terms in found if terms]
    kept = written(occurrences(docs, vocabulary), "occurrences")
    count, total = kept.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(vocabulary), "int64")
    for r in kept.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row per term of the block
        weights[r["t"]] = math.floor(1000 * math.log((2 * count + 2) / (2 * r["count"] + 1)))
    shared = spark.sparkContext.broadcast((weights, queries))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries = shared.value
        best = [Best(top) for _ in queries]
        for part in shards(batches, weights, count, total, shard):
            for (_, terms, repeats), b in zip(queries, best):
                part.search(terms, repeats, b)
        for some in range(0, len(queries), 1000):
            rows = [(q[0], int(s), None if d == 2**63 - 1 else int(d)) for q, b in zip(queries[some:some + 1000], best[some:some + 1000]) for s, d in zip(b.scores, b.docs)]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows) if rows else ([], [], []), (pa.binary(), pa.int64(), pa.int64()))],
                                             names=["text_id", "score", "doc_id"])
        give_back()

    return kept.mapInArrow(search, LOCAL)


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", top: int = TOP, block_bytes: int = BLOCK_BYTES, shard: int = SHARD) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of each item."""
    small_batches(docs)
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(f"`{text_col}`").cast("binary").alias("text"))
    items = items.select(F.col(f"`{item_col}`").alias("item_id"), text_or_empty(f"`{item_text}`").alias("text"))
    parts = [written(block_results(docs, block, top, shard), "lexical") for block in blocks_of(items, block_bytes)]
    local = reduce(DataFrame.union, parts) if parts else docs.sparkSession.createDataFrame([], LOCAL)
    order = Window.partitionBy("text_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    owners = items.select("item_id", F.sha2("text", 256).cast("binary").alias("text_id"))
    return owners.join(best, "text_id").select("item_id", "rank", "doc_id", "score")


def op12_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH words AS (
    SELECT row_number() OVER () AS row_no, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
docs AS (SELECT row_no, doc_id, terms, len(terms)::BIGINT AS n FROM words WHERE len(terms) > 0),
totals AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM docs),
postings AS (SELECT row_no, doc_id, n, term, count(*)::BIGINT AS tf
             FROM (SELECT row_no, doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL),
items AS (SELECT row_number() OVER () AS item_no, item_id,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
asked AS (SELECT item_no, item_id, term, count(*)::BIGINT AS repeats
          FROM (SELECT item_no, item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM postings, totals WHERE term IN (SELECT term FROM asked) GROUP BY term, big_n),
scored AS (SELECT item_no, item_id, row_no, doc_id,
                  sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::BIGINT AS score
           FROM asked JOIN weights USING (term) JOIN postings USING (term), totals GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
