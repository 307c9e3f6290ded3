"""Near-duplicates by min-max hashing, verified on full shingle sets.

Each hash function keeps both its minimum and its maximum over a document's shingles:
two signature values for one evaluation. ``rows`` values make a band; two
documents are candidates when they agree on a whole band. With 36 functions and
24 bands of 3, a pair at similarity 0.8 is missed with probability below 1e-7.

Documents with equal sets form one class, found by grouping set digests (partial
aggregation, so a group of copies costs one row per map task); only classes go on.

Buckets of up to ``small`` classes compare all their pairs. Larger ones never do:

* their classes (near-copies, or texts that share a common passage) are banded again with
  88 bands of 8 values, which far pairs hardly ever share and pairs at 0.8 miss with
  probability below 1e-7;
* a large bucket of these is one unit of work: a class is compared with each group joined so
  far only until a link is found, so near-copies cost a few comparisons each, and no pair is emitted;
* a bucket of more than ``BLOCK`` classes first tries a few rounds of two pivots against its
  members, which merges groups of near-copies, and is then cut into pairs of blocks.

Comparisons use the documents' words themselves (compressed while shuffled).

Defined cases: null or blank texts have no shingle and link with nothing; with fewer
words than a shingle the whole sequence is the one shingle; rows repeated with a doc_id
share a component, which each of their texts that has shingles links on its own; a null doc_id links with nothing (component null, kept); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.byte_bpe import slices
from ledgerline.llm.common import connected_components, give_back, nested, small_batches, table, text_or_empty, whole_groups, written

#: (hash functions, rows of a band): the bands of all documents, then those of crowded buckets.
LEVELS = ((36, 3), (352, 8))
#: Rounds, of two pivots each, that a bucket of more than BLOCK classes tries.
ROUNDS = 3
#: Entries up to which a bucket's pairs are all compared.
SMALL = 16
#: Classes of a bucket that one unit of work compares.
BLOCK = 2048
#: Per cent of the union that the intersection must reach.
SIMILARITY = 80
SEED = 7


def words_of(text: bytes) -> list[bytes]:
    """A-Z in lower case; bytes.split cuts at [\\x20\\x09-\\x0D]+."""
    return text.lower().split()


def shingle_set(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(width)]))


def stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


class MinMax:
    """Set sizes, set digests and band keys of texts."""

    def __init__(self, width: int, functions: int, rows: int, seed: int):
        self.width, self.rows = width, rows
        rng = np.random.default_rng(seed)
        draw = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
        self.xor, self.times = draw(functions), draw(functions) * np.uint64(2) + np.uint64(1)

    def shingles(self, texts: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct 64-bit shingle hashes of each text."""
        split = [words_of(t) for t in texts]
        flat = np.empty(sum(map(len, split)), object)
        flat[:] = list(itertools.chain.from_iterable(split))
        h = pd.util.hash_array(flat) if len(flat) else np.empty(0, np.uint64)
        joined, n = np.zeros(max(len(h) - self.width + 1, 0), np.uint64), len(h) - self.width + 1
        for i in range(self.width):
            joined = joined * np.uint64(0x9E3779B97F4A7C15) + (h[i:i + n] if n > 0 else joined)
        joined, out, at = stirred(joined), [], 0
        for words in split:
            m = len(words)
            if m >= self.width:
                out.append(np.unique(joined[at:at + m - self.width + 1]))
            else:
                whole = np.zeros(1, np.uint64)
                for x in h[at:at + m]:
                    whole = stirred(whole * np.uint64(31) + x + np.uint64(1))
                out.append(whole if m else whole[:0])
            at += m
        return out

    def bands(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of band keys per (non-empty) set: bands of minima, then bands of maxima."""
        starts = np.cumsum([0, *map(len, sets[:-1])])
        every = np.concatenate(sets)
        low, high = [], []
        for a, b in zip(self.xor, self.times):
            x = (every ^ a) * b
            low.append(np.minimum.reduceat(x, starts))
            high.append(np.maximum.reduceat(x, starts))
        values, keys = low + high, []
        for band in range(len(values) // self.rows):
            key = np.full(len(sets), band + 1, np.uint64)
            for v in values[band * self.rows:(band + 1) * self.rows]:
                key = stirred(key * np.uint64(0x9E3779B97F4A7C15) + v)
            keys.append(key)
        return np.stack(keys, 1).view(np.int64)


def signatures(docs: DataFrame, width: int, functions: int, rows: int, seed: int = SEED, compressed: bool = False) -> DataFrame:
    """(doc_id, th, n, digest, bands) of (doc_id, th, text as binary, ``compressed`` or not); digest and bands are null for empty sets."""
    make = lambda: MinMax(width, functions, rows, seed)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, unpack = make(), zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "text", 1 << 18 if compressed else 1 << 20):
            texts = batch.column("text").to_pylist()
            sets = hashed.shingles([unpack(t) for t in texts] if compressed else texts)
            full = [s for s in sets if len(s)]
            keys = iter(hashed.bands(full).tolist() if full else [])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("th"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64()))], names=["doc_id", "th", "n", "digest", "bands"])

    return docs.mapInArrow(sign, "doc_id long, th long, n long, digest binary, bands array<long>")


def packed(docs: DataFrame) -> DataFrame:
    """The texts' words, compressed, for the shuffles of the verification."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array([press(b" ".join(words_of(t))) for t in batch.column("text").to_pylist()], pa.binary())], names=["doc_id", "th", "words"])

    return docs.mapInArrow(pack, "doc_id long, th long, words binary")


def verified(pairs: DataFrame, texts: DataFrame, width: int, similarity: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity; ``texts``: (cls, words)."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack, last, mine = zstandard.ZstdDecompressor().decompress, None, set()
        for batch in batches:
            keep = []
            for a, words_a, words_b in zip(batch["a"], batch["words_a"], batch["words_b"]):
                if a != last:
                    last, mine = a, shingle_set(unpack(words_a).split(), width)
                other = shingle_set(unpack(words_b).split(), width)
                both = len(mine & other)
                keep.append(100 * both >= similarity * (len(mine) + len(other) - both))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]
        del mine
        give_back()

    left = texts.select(F.col("cls").alias("a"), F.col("words").alias("words_a"))
    right = texts.select(F.col("cls").alias("b"), F.col("words").alias("words_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "words_a", "words_b").mapInPandas(compare, "a long, b long")


def crowded(large: DataFrame, texts: DataFrame, width: int, similarity: int) -> DataFrame:
    """Links (a, b) across components inside buckets, found without emitting a pair.

    A bucket is cut into blocks of about ``BLOCK`` classes; each pair of blocks is a unit of work
    that builds each set once and skips what a link found in it already joins.
    """

    def unit(rows: pd.DataFrame) -> list[tuple[int, int]]:
        unpack, links, parent = zstandard.ZstdDecompressor().decompress, [], {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        numbers: dict[tuple, int] = {}  # one small integer per distinct shingle of the unit
        sets = [{numbers.setdefault(x, len(numbers)) for x in shingle_set(unpack(w).split(), width)} for w in rows["words"]]
        cls, comp, block = rows["cls"].tolist(), rows["comp"].tolist(), rows["c"].tolist()
        one = rows["c1"].iloc[0] == rows["c2"].iloc[0]
        groups: dict[int, list[int]] = {}  # members of each component joined so far
        for i, mine in enumerate(sets):
            own = root(comp[i])
            groups.setdefault(own, [])
            for key in sorted(groups, key=lambda k: -len(groups[k])):
                if key == own or key not in groups:
                    continue
                for j in groups[key]:
                    a, b = len(mine), len(sets[j])
                    if not one and block[i] == block[j] or 100 * min(a, b) < similarity * max(a, b):
                        continue
                    both = len(mine & sets[j])
                    if 100 * both >= similarity * (a + b - both):
                        links.append((cls[j], cls[i]))
                        groups[key] += groups.pop(own)
                        parent[own], own = key, key
                        break
            groups[own].append(i)
        return links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["bucket", "c1", "c2"]):
            for _, rows in table.to_pandas().groupby(["bucket", "c1", "c2"], sort=False):
                if links := unit(rows):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], names=["a", "b"])

    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    placed = (large.withColumn("blocks", blocks).withColumn("c", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
              .select("bucket", "cls", "comp", "c", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
              .select("bucket", "cls", "comp", "c", F.least("c", "o").alias("c1"), F.greatest("c", "o").alias("c2")))
    work = placed.join(texts, "cls").repartition("bucket", "c1", "c2").sortWithinPartitions("bucket", "c1", "c2", "cls")
    return work.select("bucket", "c1", "c2", "c", "cls", "comp", "words").mapInArrow(run, "a long, b long")


def shared_buckets(entries: DataFrame) -> DataFrame:
    """(bucket, cls, n, comp) with ``m``, the bucket's entries, of buckets that hold two components or more."""
    open_ = entries.groupBy("bucket").agg(F.count("*").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return written(entries.join(open_.select("bucket", "m"), "bucket"), "buckets")


def renamed(entries: DataFrame, components: DataFrame) -> DataFrame:
    """Entries with the component that the links so far give their class."""
    return (entries.drop("comp").join(components.withColumnRenamed("v", "cls"), "cls", "left")
            .select("bucket", "cls", "n", F.coalesce("component", "cls").alias("comp")))


def class_links(entries: DataFrame, texts: DataFrame, width: int, similarity: int, levels, rounds: int, small: int, seed: int,
                links: DataFrame | None = None) -> DataFrame:
    """(v, component) of the linked classes; ``entries``: (bucket, cls, n, comp), ``texts``: (cls, words), ``links``: (a, b) known before."""
    near = (100 * F.least("n", "n_a") >= similarity * F.greatest("n", "n_a")) & (F.col("comp") != F.col("comp_a"))

    def compared(pairs: DataFrame) -> DataFrame:
        found = written(verified(pairs.withColumnRenamed("cls", "b").distinct(), texts, width, similarity), "links")
        return found if links is None else links.unionByName(found)

    def all_pairs(some: DataFrame) -> DataFrame:
        other = some.select("bucket", F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("comp").alias("comp_a"))
        return some.join(other, "bucket").where((F.col("a") < F.col("cls")) & near)

    for depth in range(len(levels)):
        entries = shared_buckets(entries)
        links = compared(all_pairs(entries.where(F.col("m") <= small)).select("a", "cls"))
        large = entries.where(F.col("m") > small)
        if large.isEmpty():
            return connected_components(links)
        if depth + 1 < len(levels):  # sharper bands for the classes of large buckets
            dense = texts.join(large.select("cls").distinct(), "cls", "left_semi")
            sharper = signatures(dense.select(F.col("cls").alias("doc_id"), F.lit(0).cast("long").alias("th"), F.col("words").alias("text")), width, *levels[depth + 1], seed + depth + 1, compressed=True)
            entries = sharper.select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("cls"), "n", F.col("doc_id").alias("comp"))
    for turn in range(rounds):
        huge = large.where(F.col("m") > BLOCK)
        if huge.isEmpty():
            break
        # Two pivots per huge bucket, by a hash of the class that differs from turn to turn: buckets agree on pivots.
        order = F.struct(F.xxhash64("cls", F.lit(turn)).alias("o"), "cls", "n", "comp")
        pivots = (huge.groupBy("bucket").agg(F.array_distinct(F.array(F.min(order), F.max(order))).alias("p")).select("bucket", F.explode("p").alias("p"))
                  .select("bucket", F.col("p.cls").alias("a"), F.col("p.n").alias("n_a"), F.col("p.comp").alias("comp_a")))
        links = compared(huge.join(pivots, "bucket").where(near).select("a", "cls"))
        large = shared_buckets(renamed(large, written(connected_components(links), "components")))
    links = links.unionByName(written(crowded(large, texts, width, similarity), "links"))
    return connected_components(links)


def class_names(real: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``classes`` (digest, doc_id, th) with ``cls``, and links (a, b) of classes by a common doc_id, if any.

    A class is named by its smallest doc_id. Where that id stands for several sets, each gets a
    number above all ids instead and is linked with the id, so that no name of a component changes.
    """
    h = F.xxhash64("digest")
    several = real.groupBy("doc_id").agg(F.min(h).alias("lo"), F.max(h).alias("hi")).where("lo <> hi")
    several = written(several.select("doc_id"), "several")
    if several.isEmpty():
        return written(classes.withColumn("cls", F.col("doc_id")), "classes"), None
    above = real.agg(F.max("doc_id")).first()[0] + 1
    own = classes.join(several, "doc_id", "left_anti").withColumn("cls", F.col("doc_id"))
    new = classes.join(several, "doc_id", "left_semi").withColumn("cls", F.lit(above) + F.monotonically_increasing_id())
    classes = written(own.unionByName(new), "classes")
    links = real.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("b"), "digest").join(classes.select("digest", "cls"), "digest")
    return classes, written(links.select(F.col("cls").alias("a"), "b").where("a <> b").distinct(), "links")


def near_duplicates(docs: DataFrame, width: int = 5, similarity: int = SIMILARITY, levels=LEVELS,
                    rounds: int = ROUNDS, small: int = SMALL, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    docs = small_batches(docs).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(f"`{text_col}`").cast("binary").alias("text"))
    docs = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    signed = written(signatures(docs, width, *levels[0], seed), "signatures")
    real = signed.where("doc_id is not null and digest is not null")
    # A class is a set; ``doc_id`` and ``th`` name the text that stands for it.
    classes = real.groupBy("digest").agg(F.min(F.struct("doc_id", "th")).alias("first")).select("digest", "first.*")
    classes, same = class_names(real, classes)
    heads = real.join(classes, ["digest", "doc_id", "th"])
    entries = heads.select(F.explode("bands").alias("bucket"), "cls", "n", F.col("cls").alias("comp")).distinct()
    entries = shared_buckets(entries).drop("m")
    wanted = classes.join(entries.select("cls").distinct(), "cls", "left_semi").select("doc_id", "th", "cls")
    texts = written(packed(docs).join(wanted, ["doc_id", "th"]).groupBy("cls").agg(F.max("words").alias("words")), "words")
    linked = class_links(entries, texts, width, similarity, levels, rounds, small, seed, same)
    named = classes.join(linked.withColumnRenamed("v", "cls"), "cls", "left").select("digest", F.coalesce("component", "cls").alias("component_id"))
    placed = real.select("doc_id", "n", "digest").join(named, "digest").select("doc_id", "n", "component_id")
    alone = signed.where("doc_id is null or digest is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return placed.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the first document of each component, all columns kept."""
    kept = near_duplicates(docs, **options).where("kept").select(F.col("doc_id").alias("_near_id")).distinct()
    return nested(docs).join(kept, F.col("_row.doc_id").cast("long").eqNullSafe(F.col("_near_id")), "left_semi").select("_row.*")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)
