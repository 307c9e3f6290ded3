"""Operator 13 against a plain dictionary of paths, with shards small enough to cut every node."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import tries


def brute(rows):
    """rows: (conv_id, turn, role, text) without equal turns in a conversation."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = own.get(c - c % 100, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members, ends = paths.setdefault(tuple(whole[:d]), ([], []))
            members.append(c)
            if d == len(whole):
                ends.append(c)
    out = []
    for path, (members, ends) in paths.items():
        below = [p for p in paths if p[:len(path)] == path]
        leaves = sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in paths) for p in below)
        out.append((min(members), len(path), min(paths[path[:-1]][0]) if path else None, len(members),
                    sum(len(p) == len(path) + 1 for p in below), leaves, sum((len(paths[p][0]) - 1) * len(p[-1][1]) for p in below if p),
                    hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations():
    rng = random.Random(7)
    rows = []
    texts = ["", "hello", "naïve 日本", "a" * 50, None]
    for c in list(range(0, 40)) + [100, 105, 250, 251, 399, 10**12 + 7]:
        n = rng.choice([1, 1, 2, 3, 4, 6, 8])
        for turn in range(n):
            rows.append((c, None if turn == 0 and c % 3 else turn, rng.choice(["user", "assistant", None]), rng.choice(texts[:3] if turn < 2 else texts)))
    for c in range(300, 360):  # copies of one conversation: a third of all
        rows += [(c, t, "user", f"copy {t}") for t in range(7)]
    rows += [(400, t, "user", "deep") for t in range(300)]  # one deep path of one turn
    rows += [(None, 0, "user", "no conversation")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return conversations()


@pytest.mark.parametrize("shard", [1, 15, 200, 10**6])
def test_equals_the_paths_themselves(spark, rows, shard):
    extra = [(*r, 1, "x") for r in rows]
    df = spark.createDataFrame(extra, "conv_id long, turn long, role string, text string, depth int, ids string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")  # bounds the number of shards
    try:
        got = tries.prefix_trie(tries.rebuilt(tries.sequences(df)), shard)
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_turnless_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    c = next(c for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6 >= 2)  # its group's first one is absent
    rows = [(c, 0, "user", "gone"), (c, 1, "user", "gone too")]
    got = tries.prefix_trie(tries.rebuilt(tries.sequences(spark.createDataFrame(rows, schema))))
    assert [tuple(r) for r in got.collect()] == brute(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    none = tries.prefix_trie(tries.rebuilt(tries.sequences(spark.createDataFrame([], schema))))
    assert none.collect() == [] and none.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_repeated_rows_and_equal_turns(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(7, 1, "user", "a"), (7, 1, "user", "a"), (7, 1, "user", "b"), (8, 0, "user", "x" * 2_000_000)]
    runs = []
    for parts in (1, 3):
        own = tries.sequences(spark.createDataFrame(rows, schema).repartition(parts)).collect()
        sizes = {r["conv_id"]: r["sizes"] for r in own}
        assert sizes == {7: [1, 1, 1], 8: [2_000_000]}  # a repeated row is a turn of its own
        runs.append(sorted(r["ends_sha256"] for r in tries.prefix_trie(tries.rebuilt(tries.sequences(spark.createDataFrame(rows, schema).repartition(parts)))).collect()))
    assert runs[0] == runs[1]


def test_common_prefix(spark):
    cases = [([], [], 0), ([1], [], 0), ([1, 2], [1, 2], 2), ([1, 2], [1, 2, 3], 2), ([1, 2, 4], [1, 3, 4], 1)]
    df = spark.createDataFrame(cases, "a array<long>, b array<long>, n int")
    assert all(r["n"] == r["got"] for r in df.withColumn("got", tries.common_prefix(F.col("a"), F.col("b"))).collect())


def test_tree_is_balanced_and_finds_paths():
    tree = tries.Tree()
    for k in tries.median_first(1023):
        tree.insert([k, 5], [1, 2])

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.low[node]), height(tree.high[node]))

    assert height(tree.equal[0]) == 10
    assert len(tree.key) == 1 + 2 * 1023
    assert tree.insert([77, 5], [1, 2]) < len(tree.key) and len(tree.key) == 1 + 2 * 1023
    assert sorted(tries.median_first(100)) == list(range(100))
