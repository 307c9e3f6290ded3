"""Embedding near-duplicates by E8 lattice hashing.

In each of several tables a vector, scaled to unit length, is projected to eight random
directions and decoded to the nearest point of the E8 lattice; it is also entered
under the ``probes`` next nearest of the 240 neighbouring points. Vectors that meet in a
cell of any table are compared by cosine in double precision.

Cells are the same for tables of any size (`PLAN`), so whether two vectors are linked follows
from the two alone. A fine cell is several lattice points side by side (8 directions each),
probed by the nearest of all combinations of their neighbours; in a coarse one the unrelated
vectors, and all work, would grow with the square of the table. `PLANS` holds, from coarse to
fine, how often two unrelated vectors meet: in `PLAN` one meets about 300 in 77 million. In each
plan a pair at cosine 0.95 meets with probability 0.9999 or more (measured in the tests).

* Equal vectors form one class first, found by grouping; only classes are hashed.
* Cells are grouped as (cell, class) ids. A cell of more than ``block`` classes is cut
  into blocks, and each pair of blocks is its own unit of work, so no cell is one task.
* A pair that meets in several cells counts in the smallest of them only. Every task
  can tell, since cells follow from the vectors alone in integer arithmetic. So no
  pair is ever emitted: a unit returns a count per vector and a spanning forest.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite
components link with nothing (n_links 0, a component of their own); vectors of different
length never meet; rows repeated with a vec_id are vectors of their own; a null vec_id
names a component only if no other id is in it, and is kept then; an empty table gives an
empty result; other columns (labels too) are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from ledgerline.llm.common import connected_components, table, whole_groups, written

COSINE = 0.95


class Plan(NamedTuple):
    """How cells are made; the standard deviation of a unit vector's projections, in lattice units, is 1 / scale."""

    tables: int
    blocks: int
    probes: int
    scale: float
    meet: float = 0.0  #: chance that two unrelated vectors meet in a table, summed over tables


#: From coarse to fine; measured on random vectors of 64 components.
PLANS = [Plan(4, 1, 4, 1.3, 2e-2), Plan(7, 1, 4, 1.0, 5.2e-3), Plan(6, 2, 9, 1.6, 6e-4), Plan(7, 2, 14, 1.3, 1e-4),
         Plan(10, 3, 14, 1.6, 4e-6), Plan(11, 4, 24, 1.8, 5e-7), Plan(16, 4, 24, 1.6, 2.7e-8)]
#: The plan of every table, unless the caller names another.
PLAN = PLANS[4]
#: Unrelated vectors that a vector may meet; comparing them costs about as much as entering it in its cells.
MEETINGS = 512


def plan_for(rows: int) -> Plan:
    """The coarsest plan that keeps cells small, for a caller who names one; links of different plans may differ."""
    return next((p for p in PLANS if p.meet * rows <= MEETINGS), PLANS[-1])


BLOCK = 2048
SEED = 8
#: Projections are exact integers: unit vectors times 2^20 by directions times 2^10; half a lattice unit is HALF.
HALF = 1 << 29


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8, times 2."""
    pairs = [np.eye(8, dtype=np.int64)[i] * 2 * a + np.eye(8, dtype=np.int64)[j] * 2 * b
             for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
    halves = [np.array(s) for s in itertools.product((1, -1), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(pairs + halves, np.int64)


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Twice the nearest point of D8 (integers of even sum); x in units of 1 / (2 HALF)."""
    unit = 2 * HALF
    f = (x + HALF) // unit
    odd = np.flatnonzero(f.sum(1) & 1)
    rest = x - f * unit
    worst = np.abs(rest).argmax(1)[odd]
    f[odd, worst] += np.where(rest[odd, worst] >= 0, 1, -1)
    return 2 * f


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Twice the nearest point of E8, the union of D8 and D8 shifted by one half."""
    a, b = nearest_d8(x), nearest_d8(x - HALF) + 1
    far = lambda y: (np.abs(x - y * HALF) >> 8) ** 2  # noqa: E731  squares stay within 64 bits
    return np.where((far(a).sum(1) <= far(b).sum(1))[:, None], a, b)


class Lattice:
    """Cell keys of unit vectors of one length: cells of ``blocks`` lattice points side by side."""

    def __init__(self, length: int, plan: Plan = PLANS[0], seed: int = SEED):
        rng = np.random.default_rng([seed, length])
        self.plan, self.roots = plan, roots()
        # Projections are sums of integers below 2^53, so that floats hold them exactly in any order.
        self.directions = np.rint(rng.normal(size=(length, 8 * plan.blocks * plan.tables)) / plan.scale * 1024)
        self.times = rng.integers(1, 1 << 62, size=(plan.tables, plan.blocks, 8), dtype=np.int64) * 2 + 1
        self.plus = rng.integers(-(1 << 62), 1 << 62, size=plan.tables, dtype=np.int64)

    def near(self, part: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Costs and hash sums (rows, 1 + probes) of the home point and its nearest neighbours, ties by the root's place."""
        home = nearest_e8(part)
        own = (home * times).sum(1)[:, None]
        cost = np.zeros((len(part), 1), np.int64)
        if not self.plan.probes:
            return cost, own
        gain = ((part - home * HALF).astype(float) @ self.roots.T.astype(float)).astype(np.int64)
        ranked = ((4 * HALF - gain) << 8) + np.arange(len(self.roots))
        first = np.sort(np.partition(ranked, self.plan.probes - 1, axis=1)[:, :self.plan.probes], axis=1)
        return np.hstack([cost, first >> 8]), np.hstack([own, own + (self.roots @ times)[first & 255]])

    def keys(self, units: np.ndarray) -> np.ndarray:
        """(rows, tables, 1 + probes) cell keys."""
        x = (np.rint(units * (1 << 20)) @ self.directions).astype(np.int64).reshape(len(units), self.plan.tables, self.plan.blocks, 8)
        keep = 1 + self.plan.probes
        # Of two ascending lists, the sum of places i and j has (i + 1)(j + 1) - 1 sums before it.
        i, j = np.nonzero(np.outer(np.arange(1, keep + 1), np.arange(1, keep + 1)) <= keep)
        out = np.empty((len(units), self.plan.tables, keep), np.int64)
        for t in range(self.plan.tables):
            cost, sums = self.near(x[:, t, 0], self.times[t, 0])
            for b in range(1, self.plan.blocks):  # the nearest of all combinations of the blocks' points
                more, other = self.near(x[:, t, b], self.times[t, b])
                pairs = cost[:, i] + more[:, j]
                best = np.argsort(pairs, axis=1, kind="stable")[:, :keep]
                cost, sums = np.take_along_axis(pairs, best, 1), np.take_along_axis(sums[:, i] + other[:, j], best, 1)
            k = sums + self.plus[t]
            out[:, t] = (k ^ (k >> 31)) * np.int64(0x5851F42D4C957F2D)
        return out


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def component_type(vectors: DataFrame) -> str:
    """Single precision holds the components of an array<float> exactly."""
    return "<f4" if isinstance(vectors.schema["vector"].dataType.elementType, FloatType) else "<f8"


def cells(classes: DataFrame, plan: Plan, seed: int) -> DataFrame:
    """(cls, copies, vector) with ``vec`` (components as binary) and ``cells``."""
    make, kind = (lambda n: Lattice(n, plan, seed)), component_type(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Lattice] = {}
        for batch in batches:
            flat, ends = batch.column("vector").flatten().to_numpy(zero_copy_only=False), batch.column("vector").value_lengths().to_numpy().cumsum()
            vectors = np.split(flat.astype(kind), ends[:-1])
            keys: list = [None] * len(vectors)
            for n in {len(v) for v in vectors}:
                at = [i for i, v in enumerate(vectors) if len(v) == n]
                lattice = known.setdefault(n, make(n))
                for i, k in zip(at, lattice.keys(unit_rows(np.stack([vectors[i] for i in at]).astype(float))).reshape(len(at), -1)):
                    keys[i] = np.unique(k).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("copies"), pa.array([v.tobytes() for v in vectors], pa.binary()),
                                              pa.array(keys, pa.list_(pa.int64()))], names=["cls", "copies", "vec", "cells"])

    return classes.select("cls", "copies", "vector").mapInArrow(run, "cls long, copies long, vec binary, cells array<long>")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star (vertex, smallest vertex) for each component of the edges."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    inner = label != np.arange(len(names))
    return names[inner], names[label[inner]]


def distinct_keys(lattice: Lattice, units: np.ndarray) -> np.ndarray:
    """(rows, tables * (1 + probes)) ascending cell keys, those repeated in a row replaced by the largest number."""
    keys = np.concatenate([np.sort(lattice.keys(u).reshape(len(u), -1), axis=1) for u in np.array_split(units, len(units) // 4096 + 1)])
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = np.iinfo(np.int64).max
    return np.sort(keys, axis=1)


def smallest_shared(keys: np.ndarray, a: np.ndarray, b: np.ndarray, cell: np.ndarray, step: int = 20_000) -> np.ndarray:
    """Whether ``cell`` is the smallest key that rows a and b share; it is one of both.

    Pairs that meet in many cells mostly share one of their smallest keys, which settles all their other cells.
    """
    first = np.zeros(len(a), bool)
    for s in range(0, len(a), step):
        at = np.arange(s, min(s + step, len(a)))
        for few in (4, 16):
            x, y = keys[a[at], :few, None], keys[b[at], None, :few]
            at = at[~((x == y) & (x < cell[at, None, None])).any((1, 2))]
        both = np.sort(np.hstack([keys[a[at]], keys[b[at]]]), axis=1)
        least = both[np.arange(len(at)), (both[:, 1:] == both[:, :-1]).argmax(1)]
        first[at] = least == cell[at]
    return first


def unit_of_work(make, cosine: float, kind: str):
    """Over rows sorted by (cell, c1, c2): for each such unit the counts and forest of its links."""

    def units(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cell, c1, c2, c, cls, copies = (table.column(n).to_numpy() for n in ("cell", "c1", "c2", "c", "cls", "copies"))
        lengths = pa.compute.binary_length(table.column("vec")).to_numpy() // int(kind[2:])
        starts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])])
        sizes = np.diff(np.r_[starts, len(cell)])
        raw = table.column("vec").to_pylist()
        for n in np.unique(lengths).tolist():  # a cell holds vectors of one length
            own = np.flatnonzero(lengths == n)
            place = np.full(len(cell), -1)
            place[own] = np.arange(len(own))
            unit = unit_rows(np.frombuffer(b"".join(raw[i] for i in own.tolist()), kind).astype(float).reshape(len(own), n))
            firsts, seconds = [], []
            for size in np.unique(sizes[lengths[starts] == n]).tolist():
                if size < 2:
                    continue
                groups = starts[(sizes == size) & (lengths[starts] == n)]
                upper = np.triu(np.ones((size, size), bool), 1)
                for part in np.array_split(groups, max(1, len(groups) * size * size // 4_000_000)):
                    rows = part[:, None] + np.arange(size)
                    x = unit[place[rows]]
                    near = (x @ x.transpose(0, 2, 1) >= cosine) & upper
                    cross = (c[rows][:, :, None] != c[rows][:, None, :]) | (c1[part] == c2[part])[:, None, None]
                    g, i, j = np.nonzero(near & cross)
                    firsts.append(rows[g, i])
                    seconds.append(rows[g, j])
            i, j = (np.concatenate(x) if x else np.empty(0, int) for x in (firsts, seconds))
            if not len(i):
                continue
            v, root = forest(cls[i], cls[j])
            yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(root), pa.nulls(len(v), pa.int64())], names=["a", "b", "n"])
            _, used, at = np.unique(cls[np.concatenate([i, j])], return_index=True, return_inverse=True)
            keys = distinct_keys(make(n), unit[place[np.concatenate([i, j])[used]]])
            first = smallest_shared(keys, at[:len(i)], at[len(i):], cell[i])
            i, j = i[first], j[first]
            links = np.zeros(len(cell), np.int64)
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            some = np.flatnonzero(links)
            names, inverse = np.unique(cls[some], return_inverse=True)
            total = np.zeros(len(names), np.int64)
            np.add.at(total, inverse, links[some])
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.nulls(len(names), pa.int64()), pa.array(total)], names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["cell", "c1", "c2"]):
            yield from units(table)

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, plan: Plan | None = None, block: int = BLOCK, seed: int = SEED,
                 id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector")).withColumn("ok", usable(F.col("vector")))
    good = rows.where("ok")
    classes = written(good.groupBy("vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
                      .withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    plan = plan or PLAN
    hashed = written(cells(classes, plan, seed), "vector-cells")
    entries = hashed.select("cls", F.explode("cells").alias("cell"))
    crowded = entries.withColumn("m", F.count("*").over(Window.partitionBy("cell"))).where("m > 1")  # entries are shuffled once
    blocks = F.ceil(F.col("m") / block).cast("int")
    placed = (crowded.withColumn("blocks", blocks)
              .withColumn("c", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
              .select("cell", "cls", "c", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
              .select("cell", "cls", "c", F.least("c", "o").alias("c1"), F.greatest("c", "o").alias("c2")))
    work = placed.join(hashed.select("cls", "copies", "vec"), "cls").repartition("cell", "c1", "c2").sortWithinPartitions("cell", "c1", "c2", "cls")
    make = lambda n: Lattice(n, plan, seed)
    found = written(work.select("cell", "c1", "c2", "c", "cls", "copies", "vec").mapInArrow(unit_of_work(make, cosine, component_type(classes)), "a long, b long, n long"), "vector-links")
    links = found.where("n is not null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("others"))
    parts = connected_components(found.where("n is null").select("a", "b"))
    named = (classes.select("cls", "vector", "least", "copies").join(parts.withColumnRenamed("v", "cls"), "cls", "left")
             .withColumn("component", F.coalesce("component", "cls")).join(links, "cls", "left"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = named.join(least, "component").select("vector", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    linked = good.join(of_class, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
