"""Prefix trie of conversations: ternary search trees per range shard, merged at their edges.

1. Turns (role, text) are numbered through a dictionary of their digests, so a conversation
   is a short array of numbers; texts stay behind with their lengths.
2. Conversations, with the head of another one put before them where asked for, are range-sorted
   by their arrays and ids into shards of bounded size. Equal conversations are kept apart by
   their ids, so copies of one conversation are dealt over as many shards as they need.
3. Each shard builds a ternary search tree: its distinct arrays are inserted medians first, so
   the binary trees of a node's children are balanced. A pass over the nodes from the last made
   to the first (children come after parents) sums members, leaves and savings upwards.
4. A node spans two shards only if it lies on the common prefix of one's last array and the
   next one's first. Those *boundary nodes* are merged by the digest of their path. What a
   shard adds to them is chosen so that plain sums are right: the first shard that holds a node
   counts it as a child and takes off its one unsaved copy, the last one says whether it is
   a leaf (a node's own conversations sort before those that go on).

Defined cases: rows without a conv_id are left out; a null turn sorts first, equal turns by
a hash of role and text; null roles and texts are empty; repeated rows are turns of their own; a
conversation without turns belongs to the root; an empty table has no nodes, not even a root;
long texts are read whole, and only their digests and lengths go on; other columns are ignored.
A conversation's own turns meet in one row, as a document's text does; conversations as such
never do: the members that end at a boundary node are hashed as a stream, in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import give_back, small_batches, table, written

#: Turns and conversations in a shard: about the first number, at most about the second where
#: the session has too few shuffle partitions for that.
SHARD, LARGEST_SHARD = 20_000, 1_000_000
#: The base of a conversation is the one at the next lower multiple, of whose turns it may take up to five.
GROUP, HEADS = 100, 6

NODES = ("key binary, parent_key binary, shard int, conv_id long, depth long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends binary")


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, ids (a number for each turn's role and text, in order) and sizes (code points)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    plain = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(role, text).alias("tie"), F.char_length(text).cast("long").alias("size"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).cast("binary").alias("digest"))
    plain = written(plain, "turns")
    numbers = written(plain.select("digest").distinct().select("digest", F.monotonically_increasing_id().alias("id")), "turn-ids")
    order = F.sort_array(F.collect_list(F.struct(F.col("turn").isNotNull().alias("set"), "turn", "tie", "id", "size")))
    return (plain.join(numbers, "digest").groupBy("conv_id").agg(order.alias("t"))
            .select("conv_id", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes")))


def rebuilt(own: DataFrame) -> DataFrame:
    """Every conversation with the first h turns of its group's first one in place of its own first h."""
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = own.where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), *[F.slice(c, 1, HEADS - 1).alias(f"head_{c}") for c in ("ids", "sizes")])
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    none = F.array().cast("array<long>")
    return (own.withColumn("base", base).join(heads, "base", "left")
            .select("conv_id", *[F.concat(F.coalesce(F.slice(f"head_{c}", F.lit(1), h), none), F.slice(c, h + 1, F.greatest(F.size(c), F.lit(1)))).alias(c)
                                 for c in ("ids", "sizes")]))


def common_prefix(a: Column, b: Column) -> Column:
    """How many elements two arrays share at their start."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs == 0, F.size(a)).otherwise(differs - 1).cast("int")


class Tree:
    """A ternary search tree over arrays of numbers. Node 0 is the root; children come after parents."""

    def __init__(self):
        self.key, self.size, self.parent, self.depth = [0], [0], [-1], [0]
        self.low, self.equal, self.high = [-1], [-1], [-1]

    def add(self, parent: int, key: int, size: int) -> int:
        node = len(self.key)
        for column, value in ((self.key, key), (self.size, size), (self.parent, parent), (self.depth, self.depth[parent] + 1),
                              (self.low, -1), (self.equal, -1), (self.high, -1)):
            column.append(value)
        return node

    def insert(self, keys: list[int], sizes: list[int]) -> int:
        """The node at the end of the path ``keys``, made where it is missing."""
        at, names, low, equal, high = 0, self.key, self.low, self.equal, self.high
        for key, size in zip(keys, sizes):
            node, link, side = equal[at], equal, at
            while node >= 0 and names[node] != key:
                link, side = (low if key < names[node] else high), node
                node = link[side]
            if node < 0:
                node = self.add(at, key, size)
                link[side] = node
            at = node
        return at

    def path(self, node: int) -> list[int]:
        """The nodes from the root to ``node``."""
        out = [node]
        while node:
            node = self.parent[node]
            out.append(node)
        return out[::-1]


def median_first(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of a range before its halves."""
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            todo += [(a, middle), (middle + 1, b)]


def shard_nodes(rows: list[tuple[list[int], int, list[int]]], before: int, after: int) -> Iterator[tuple]:
    """Nodes of a shard's (ids, conv_id, sizes), sorted; ``before`` and ``after`` are the depths down to
    which its first and last path belong to the shards beside it too, -1 for none."""
    starts = [k for k in range(len(rows)) if not k or rows[k][0] != rows[k - 1][0]]
    ends = [*starts[1:], len(rows)]
    tree, end_at, first, last = Tree(), {}, 0, 0
    for k in median_first(len(starts)):
        ids, _, sizes = rows[starts[k]]
        node = tree.insert(ids, sizes)
        end_at[node] = (starts[k], ends[k])
        first, last = (node if k == 0 else first), (node if k == len(starts) - 1 else last)
    n = len(tree.key)
    earlier = set(tree.path(first)[:before + 1])  # also in a shard before: not counted anew here
    later = set(tree.path(last)[:after + 1])  # also in a shard behind, which decides whether it is a leaf
    members, children, leaves, saved, named = [0] * n, [0] * n, [0] * n, [0] * n, [1 << 63] * n
    heirs = [False] * n
    for node in range(n - 1, -1, -1):
        if node in end_at:
            a, b = end_at[node]
            members[node] += b - a
            named[node] = min(named[node], rows[a][1])
        leaves[node] += not heirs[node] and node not in later
        saved[node] += (members[node] - (node not in earlier)) * tree.size[node]
        up = tree.parent[node]
        if up >= 0:
            heirs[up] = True
            members[up] += members[node]
            children[up] += node not in earlier
            leaves[up] += leaves[node]
            saved[up] += saved[node]
            named[up] = min(named[up], named[node])
    digests: dict[int, bytes] = {}
    for node in sorted(earlier | later):  # parents first
        up = tree.parent[node]
        digests[node] = hashlib.sha256(digests[up] + tree.key[node].to_bytes(8, "big", signed=True) if up >= 0 else b"").digest()
    for node in range(n):
        a, b = end_at.get(node, (0, 0))
        text = ",".join(str(rows[k][1]) for k in range(a, b)).encode()
        up, key = tree.parent[node], digests.get(node)
        yield (key, digests.get(up), named[node], tree.depth[node], named[up] if up >= 0 and up not in digests else None, members[node],
               children[node], leaves[node], saved[node], None if key else hashlib.sha256(text).hexdigest(), text if key and text else None)


def stream_digests(chunks: DataFrame) -> DataFrame:
    """key, ends_sha256: the chunks of each key in shard order, joined by commas and hashed as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key, state):
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

        now, state = None, None
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if key != now:
                    if now is not None:
                        yield row(now, state)
                    now, state = key, hashlib.sha256(text)
                else:
                    state.update(b"," + text)
        if now is not None:
            yield row(now, state)

    return (small_batches(chunks).select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")
            .mapInArrow(run, "key binary, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, shard: int = SHARD) -> DataFrame:
    """The trie of ``conversations`` (conv_id, ids, sizes): a row per node.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = conversations.sparkSession
    conversations = written(conversations, "conversations")
    total = conversations.agg(F.coalesce(F.sum(F.size("ids") + 1), F.lit(0))).first()[0]
    n = max(1, min(-(-total // shard), max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // LARGEST_SHARD))))
    dealt = written(conversations.repartitionByRange(n, "ids", "conv_id").withColumn("shard", F.spark_partition_id()), "shards")
    in_order = Window.orderBy("shard")  # a row per shard
    bounds = (dealt.groupBy("shard").agg(F.min("ids").alias("first"), F.max("ids").alias("last"))
              .select("shard", F.coalesce(common_prefix(F.lag("last").over(in_order), F.col("first")), F.lit(-1)).alias("before"),
                      F.coalesce(common_prefix(F.col("last"), F.lead("first").over(in_order)), F.lit(-1)).alias("after")))

    def build(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("ids").to_pylist(), group.column("conv_id").to_pylist(), group.column("sizes").to_pylist()))
        shard, before, after = (group.column(c)[0].as_py() for c in ("shard", "before", "after"))
        columns = list(zip(*shard_nodes(rows, before, after)))
        columns.insert(2, [shard] * len(columns[0]))
        kinds = [pa.binary(), pa.binary(), pa.int32(), *[pa.int64()] * 7, pa.string(), pa.binary()]
        names = [c.split()[0] for c in NODES.split(", ")]
        out = pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)
        give_back()
        return out

    nodes = written(dealt.join(bounds, "shard").groupBy("shard").applyInArrow(build, NODES), "trie-nodes")
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    edge = nodes.where("key is not null")
    merged = (edge.groupBy("key").agg(F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
                                      *[F.sum(c).alias(c) for c in sums])
              .join(stream_digests(edge.where("ends is not null")), "key", "left")
              .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))))
    merged = written(merged, "trie-edges")
    columns = ["parent_key", "conv_id", "depth", "parent_conv_id", *sums, "ends_sha256"]
    every = nodes.where("key is null").select(columns).unionByName(merged.withColumn("parent_conv_id", F.lit(None).cast("long")).select(columns))
    below = every.where("parent_key is not null").drop("parent_conv_id")
    named = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return (every.where("parent_key is null").select(columns[1:])
            .unionByName(below.join(named, "parent_key", "left").select(columns[1:])))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(written(sequences(table(spark, sf_dir, "conversations")), "own-turns")))


OP13_SQL = """
WITH crc_table AS (
    SELECT list(v ORDER BY i) AS t
    FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
own AS (SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
numbered AS (SELECT conv_id, turns,
                    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                                    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 6 AS h
             FROM own, crc_table),
rebuilt AS (SELECT n.conv_id, list_concat(coalesce(b.turns[1:n.h], []), n.turns[n.h + 1:]) AS turns
            FROM numbered n LEFT JOIN own b ON b.conv_id = n.conv_id - n.conv_id % 100),
paths AS (SELECT conv_id, len(turns) AS own_depth, d, turns[1:d] AS path FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (own_depth = d), '') AS ends
          FROM paths GROUP BY path, d),
families AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * CASE WHEN d = 0 THEN 0 ELSE length(n.path[d].t) END AS saved
               FROM nodes n LEFT JOIN families f ON f.path = n.path),
above AS (SELECT path[1:up] AS path, up AS d, n_children, saved FROM (SELECT *, unnest(range(d + 1)) AS up FROM full_nodes)),
subtrees AS (SELECT path, d, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY path, d)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN subtrees s ON s.path = n.path AND s.d = n.d
LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.path = n.path[1:n.d - 1]
"""
