"""Removal of long repeated byte strings by interval expansion on Burrows-Wheeler transforms.

A *window* is a string of ``least`` (400) bytes of one document. Every byte covered by a
window that also starts anywhere else is removed.

The corpus is cut so that equal windows meet. A window's key is the smallest hash among its
k-byte strings, a function of its content alone; consecutive windows with one key
form a *segment* (about 185 windows at k = 32). Keys seen once are dropped. Segments with
equal bytes form a class: windows of a class of two or more members all repeat, with no text
looked at. What is left are classes of one member whose key other classes share, where
repeats end: their bytes, read once from the documents, are dealt by key into texts of about
a megabyte.

Each text gets a suffix array (seven bytes at once, then prefix doubling of what is still
equal, up to ``least``) and its BWT. Breadth-first
backward extension starts from the intervals of single symbols; round l extends each
interval by the symbols before it and marks the boundaries of those whose common prefix with
the next suffix is l. Common prefixes are derived by increasing value, and the search stops
at ``least``: boundaries unmarked by then are between suffixes that share a window.

A key with more than ``heavy`` bytes of classes (the edges of a passage that a third of the
documents hold) is not one task: its segments are cut again with longer strings, at last of
a whole window each, which spreads windows by all of their content.

Defined cases: a null text is empty; texts shorter than a window keep everything; rows
repeated with doc_id and text repeat each other; ties do not arise (all copies of a window
are removed alike); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.byte_bpe import slices
from ledgerline.llm.common import table, text_or_empty, written

LEAST = 400
#: Lengths of the strings whose smallest hash is a window's key, level by level; None: the window itself.
STRINGS = (32, 256, None)
TEXT_BYTES = 1 << 20
HEAVY_BYTES = 4 << 20
BASE = 0x9E3779B97F4A7C15 | 1


class Cutter:
    """Cuts a text into segments: runs of windows with one key."""

    def __init__(self, least: int, string: int):
        self.least, self.k, self.w = least, string, least - string + 1
        self.powers = self.inverse = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = 1 << (n - 1).bit_length()
            for name, base in (("powers", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p))

    def cut(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(key, start, windows, whether the key's string occurs twice) of each segment."""
        n = len(raw)
        if n < self.least:
            return (np.empty(0, np.int64),) * 4
        self.grow(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
        h = (sums[self.k:] - sums[:-self.k]) * self.inverse[:n - self.k + 1]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        w, m = self.w, n - self.least + 1
        rows = np.full(-(-len(h) // w) * w, np.iinfo(np.uint64).max, np.uint64)
        rows[:len(h)] = h
        rows = rows.reshape(-1, w)
        left = np.minimum.accumulate(rows, 1).ravel()
        right = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
        low = np.minimum(right[:m], left[w - 1:w - 1 + m])
        change = low[1:] != low[:-1]
        if w == 1:  # whole windows: consecutive ones are equal in runs of one character only
            x = np.frombuffer(raw, np.uint8)
            equal = np.r_[0, np.cumsum(x[1:] == x[:-1])]
            change = equal[self.least:] - equal[:m - 1] < self.least
        starts = np.flatnonzero(np.r_[True, change])
        windows = np.diff(np.r_[starts, m])
        key = low[starts]
        twice = np.fromiter((np.count_nonzero(h[s:s + c + w - 1] == x) > 1 for s, c, x in zip(starts.tolist(), windows.tolist(), key)), bool, len(starts))
        return key.view(np.int64), starts, windows, twice


def segments(pieces: DataFrame, least: int, string: int, first: bool = False) -> DataFrame:
    """Segments of (id, th, text, weight): key, d1, d2 (digest of the bytes, or of the ``first`` window's), n (windows), id, th, start, twice, weight."""
    make, name = (lambda: Cutter(least, string)), ["key", "d1", "d2", "n", "id", "th", "start", "twice", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = make()
        for batch in slices(batches, "text"):
            out: list[list] = [[] for _ in name]
            for id_, th, raw, weight in zip(*(batch.column(c).to_pylist() for c in ("id", "th", "text", "weight"))):
                key, start, windows, twice = cutter.cut(raw)
                if not len(key):
                    continue
                digest = np.frombuffer(b"".join(hashlib.blake2b(raw[s:s + c + least - 1], digest_size=16).digest() for s, c in zip(start.tolist(), [1] * len(start) if first else windows.tolist())), "<i8").reshape(-1, 2)
                for column, values in zip(out, (key, digest[:, 0], digest[:, 1], windows, np.full(len(key), id_), np.full(len(key), th), start, twice, np.full(len(key), weight))):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=name)

    return pieces.mapInArrow(run, "key long, d1 long, d2 long, n long, id long, th long, start long, twice boolean, weight long")


def packed(pieces: DataFrame) -> DataFrame:
    """(id, th, text) with the text compressed for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches, "text"):
            packs = pa.array([press(t) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([packs if c == "text" else batch.column(c) for c in batch.schema.names], names=batch.schema.names)

    return pieces.mapInArrow(run, pieces.schema)


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols or more.

    Symbols are 0 (a separator, unlike any other, at the end too) or from 1 to 256. The first
    sort is by seven symbols packed in one number; prefix doubling then sorts again only the
    suffixes that still equal others. Those equal to the end, and the separators, keep any order.
    """
    n, step = len(symbols), 7
    packed, whole = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(step):
        after = np.zeros(n, np.int64)
        after[:max(n - j, 0)] = symbols[j:]
        whole &= after > 0
        packed = packed << 9 | np.where(whole, after, 0)
    order = np.argsort(packed)
    head = np.r_[True, packed[order[1:]] != packed[order[:-1]]] | ~whole[order]  # suffixes up to a separator equal no other
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    slots = np.arange(n)
    while True:
        alone = head[slots] & np.r_[head[slots[1:]], True]
        slots = slots[~alone]
        if step >= depth or not len(slots):
            return order
        at = order[slots]
        key = rank[at] * n + rank[at + step]
        by = np.argsort(key)
        order[slots], key = at[by], key[by]
        head[slots[1:][key[1:] != key[:-1]]] = True
        rank[order[slots]] = np.maximum.accumulate(np.where(head[slots], slots, 0))
        step *= 2


def repeated_windows(texts: list[bytes], least: int) -> list[np.ndarray]:
    """For each text the starts of its windows that occur again in any of the texts."""
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1)
    n, m = int(ends[-1]), len(texts)
    symbols = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.uint16) + np.uint16(1)
    begins = ends - sizes - 1
    symbols[ends - 1] = 0  # separators before bytes
    sa = suffix_array(symbols, least)
    bwt = symbols[sa - 1]
    lf = np.empty(n, np.int64)
    lf[np.argsort(bwt, kind="stable")] = np.arange(n)
    marked = np.zeros(n + 1, bool)  # marked[r]: the prefix that suffixes r - 1 and r share is shorter than the round
    marked[[0, n]] = True
    firsts = symbols[sa]
    low = np.flatnonzero(np.r_[True, firsts[1:] != firsts[:-1]] | (firsts == 0))
    high = np.r_[low[1:], n] - 1
    for _ in range(least):
        new = ~marked[high + 1]
        marked[high + 1] = True
        low, high = low[new], high[new]
        if not len(low):
            break
        # The symbols before each interval: its first and last row with a symbol bound the extended
        # interval. Rows extended by one symbol keep their order, so sorting where they go finds both.
        width = high - low + 1
        at = np.repeat(np.arange(len(low)), width)
        rows = np.arange(len(at)) - np.repeat(np.cumsum(width) - width, width) + low[at]
        inner = bwt[rows] > 0
        goes = np.sort(at[inner] * n + lf[rows[inner]])
        at, goes = goes // n, goes % n
        by = firsts[goes]
        head = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (by[1:] != by[:-1])]) if len(goes) else np.empty(0, int)
        low, high = goes[head], goes[np.r_[head[1:], len(goes)] - 1] if len(goes) else np.empty(0, int)
    share = np.flatnonzero(~marked)  # suffixes share[i] - 1 and share[i] have a window in common
    hits = np.unique(np.r_[sa[share], sa[share - 1]])
    of = np.searchsorted(ends, hits, "right")
    inside = hits + least <= begins[of] + sizes[of]
    hits, of = hits[inside], of[inside]
    cuts = np.searchsorted(of, np.arange(m + 1))
    return [hits[a:b] - begin for a, b, begin in zip(cuts[:-1], cuts[1:], begins)]


def runs_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs (start, count) of consecutive numbers."""
    head = np.flatnonzero(np.r_[True, starts[1:] != starts[:-1] + 1]) if len(starts) else np.empty(0, int)
    return starts[head], np.diff(np.r_[head, len(starts)])


def expanded(parts: DataFrame, least: int) -> DataFrame:
    """Repeated windows (cid, start, n) of (bucket, cid, text), bucket by bucket."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("cid")
        out = []
        for cid, starts in zip(group["cid"], repeated_windows(group["text"].tolist(), least)):
            out += [(cid, s, c) for s, c in zip(*runs_of(starts))]
        return pd.DataFrame(out, columns=["cid", "start", "n"]).astype("int64")

    return parts.groupBy("bucket").applyInPandas(run, "cid long, start long, n long")


def class_texts(pieces: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """(cid, key, text) of classes (cid, key, id, th, start, n): their first member's bytes."""
    wanted = classes.groupBy("id", "th").agg(F.collect_list(F.struct("cid", "key", "start", "n")).alias("parts"))  # of one text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for raw, parts in zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist()):
                raw = unpack(raw)
                yield pa.RecordBatch.from_arrays([
                    pa.array([p["cid"] for p in parts], pa.int64()), pa.array([p["key"] for p in parts], pa.int64()),
                    pa.array([raw[p["start"]:p["start"] + p["n"] + least - 1] for p in parts], pa.binary())], names=["cid", "key", "text"])

    joined = packed(pieces.select("id", "th", "text")).join(wanted, ["id", "th"]).select("text", "parts")
    return joined.mapInArrow(run, "cid long, key long, text binary").dropDuplicates(["cid"])


def repeats(pieces: DataFrame, least: int = LEAST, strings: tuple = STRINGS, text_bytes: int = TEXT_BYTES, heavy: int = HEAVY_BYTES) -> DataFrame:
    """Runs of repeated windows (id, th, start, n) of the pieces (id, th, text, weight)."""
    last = len(strings) == 1
    string = min(strings[0] or least, least)
    windows = last and string == least
    cut = written(segments(pieces, least, string, windows), "segments")
    keys = cut.groupBy("key").agg(F.sum("weight").alias("w"), F.max("twice").alias("t")).where("w > 1 or t").select("key")
    met = written(cut.join(keys, "key", "left_semi"), "met")
    if windows:
        # All windows of a segment are equal, so counting digests decides each; no text is expanded, however long a run is.
        same = ["key", "d1", "d2"]
        often = met.groupBy(*same).agg(F.sum(F.col("weight") * F.col("n")).alias("w")).where("w > 1").select(*same)
        return written(met.join(often, same, "left_semi").select("id", "th", "start", "n"), "repeats")
    same = ["key", "d1", "d2", "n"]
    classes = met.groupBy(*same).agg(F.sum("weight").alias("members"), F.min(F.struct("id", "th", "start")).alias("first"), F.max("twice").alias("twice"))
    classes = written(classes.select(*same, "members", "first.*", "twice", F.monotonically_increasing_id().alias("cid")), "segment-classes")
    whole = met.join(classes.where("members > 1").select(*same), same, "left_semi").select("id", "th", "start", "n")
    # Bytes are needed where a class of one member shares its key with another class, or may repeat within itself.
    mixed = (classes.groupBy("key").agg(F.count("*").alias("c"), F.min("members").alias("least"), F.max("twice").alias("t"),
                                        F.sum(F.col("n") + least - 1).alias("bytes"))
             .where("least = 1 and (c > 1 or t)").select("key", "bytes"))
    needed = written(classes.join(mixed, "key"), "needed")
    total = needed.where(F.col("bytes") <= heavy).agg(F.sum(F.col("n") + least - 1)).first()[0] or 0
    texts = written(class_texts(pieces, needed.select("cid", "key", "id", "th", "start", "n"), least)
                    .join(needed.select("cid", "bytes", "members"), "cid"), "class-texts")
    buckets = F.pmod(F.xxhash64("key"), F.lit(int(total // text_bytes) + 1))
    found = expanded((texts if last else texts.where(F.col("bytes") <= heavy)).select(buckets.alias("bucket"), "cid", "text"), least)
    if not last:
        dense = texts.where(F.col("bytes") > heavy)
        if not dense.isEmpty():
            again = repeats(dense.select(F.col("cid").alias("id"), F.lit(0).cast("long").alias("th"), "text", F.col("members").alias("weight")), least, strings[1:], text_bytes, heavy)
            found = found.unionByName(again.select(F.col("id").alias("cid"), "start", "n"))
    part = (found.withColumnsRenamed({"start": "from", "n": "count"}).join(needed.where("members = 1").select("cid", "id", "th", "start"), "cid")
            .select("id", "th", (F.col("start") + F.col("from")).alias("start"), F.col("count").alias("n")))
    return written(whole.unionByName(part), "repeats")


def remove_repeats(docs: DataFrame, least: int = LEAST, strings: tuple = STRINGS, text_bytes: int = TEXT_BYTES, heavy: int = HEAVY_BYTES,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, spans (removed byte ranges), kept (bytes left)."""
    text = text_or_empty(f"`{text_col}`").cast("binary")
    pieces = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    pieces = pieces.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64("text").alias("th"), "text", F.lit(1).cast("long").alias("weight"))
    spans = (repeats(pieces.select("id", "th", "text", "weight"), least, strings, text_bytes, heavy)
             .groupBy("id", "th").agg(F.collect_set(F.struct("start", "n")).alias("runs")))  # of one text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            raws, kept, ranges = [unpack(t) for t in batch.column("text").to_pylist()], [], []
            for raw, runs in zip(raws, batch.column("runs").to_pylist()):
                spans, left, at = [], [], 0
                for r in sorted(runs or [], key=lambda r: r["start"]):
                    start, end = r["start"], r["start"] + r["n"] + least - 1
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([start, end])
                for start, end in spans:
                    left.append(raw[at:start])
                    at = end
                kept.append(b"".join([*left, raw[at:]]))
                ranges.append([{"start": s, "end": e} for s, e in spans])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(r) for r in raws], pa.int64()),
                                              pa.array(ranges, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                                             names=["doc_id", "n_bytes", "spans", "kept"])

    joined = packed(pieces.select("doc_id", "id", "th", "text")).join(spans, ["id", "th"], "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
