"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

* Each whole text becomes a fixed vector of statistics (shares of character classes,
  word and line shapes, repetition). Nothing else enters a score.
* The statistics are standardised, and ``features`` random Fourier features
  (cosines of seeded Gaussian projections) approximate a Gaussian kernel.
* Each partition of the training rows adds up its part of the normal equations
  Z'Z and Z'y; the driver adds one small matrix per partition (a fixed number of
  partitions) and solves for the ridge weights.
* An isotonic fit (pool adjacent violators) on training rows that the ridge did not
  see maps raw values to shares of label 1, linearly between block centres, which
  keeps the order and leaves few ties.

The fit uses a bounded sample: at most about ``sample`` labelled rows, drawn by a hash
of the doc_id (all rows while there are fewer). It is the only side that is broadcast.
Texts of labelled rows are read where they lie; no text is shuffled.

Defined cases: null and empty texts have a vector of zeros and are scored like others;
several labels of a document are averaged; labels other than numbers are skipped;
without any training row every score is 0.5; with one class only, its share; repeated
rows give a row each; an empty table gives an empty result; other columns pass through
``score`` untouched (the score takes another name where a column has its own); very long texts are
measured whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import free_name, give_back, nested, small_batches, table, text_or_empty, written

FEATURES = 192
SAMPLE = 100_000
RIDGE = 1.0
PARTS = 16
#: Sums of normal equations that reach the driver.
SUMS = 4
ACCEPT = 0.3
SEED = 20240229


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the doc_id as text, modulo 5; fold 0 is held out, 4 calibrates, 1 to 3 fit."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def statistics(text: str) -> list[float]:
    """The statistics of one whole text."""
    raw = text.encode("utf-8", "replace")
    if not raw:
        return [0.0] * N_STATISTICS
    h = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    n = float(len(raw))
    upper, lower, digits = h[65:91].sum(), h[97:123].sum(), h[48:58].sum()
    wide, space = h[128:].sum(), h[32] + h[9:14].sum()
    marks = n - upper - lower - digits - wide - space
    plain = h[44] + h[46]  # commas and full stops
    p = h[h > 0] / n
    words = text.split()
    m = max(len(words), 1)
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x]
    alpha = sum(w.isalpha() for w in words)
    capital = sum(w[0].isupper() for w in words)
    shout = sum(w.isupper() for w in words)
    return [
        np.log1p(n), upper / n, digits / n, wide / n, space / n, marks / n, (marks - plain) / n, plain / n,
        *[h[ord(c)] / n for c in "#$%&*|!@\\/<{=_-:"], -(p * np.log(p)).sum(),
        np.log1p(m), lengths.mean(), lengths.std(), min(lengths.max(), 200.0), distinct / m, pairs / m, alpha / m,
        capital / m, shout / m, np.log1p(len(lines)), len(set(lines)) / max(len(lines), 1), np.log1p(m / max(len(lines), 1)),
    ]


N_STATISTICS = 0
N_STATISTICS = len(statistics("a"))


def matrix(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(len(texts), N_STATISTICS)


class Model:
    """Standardisation, projection, ridge weights and calibration points; a few hundred kilobytes."""

    def __init__(self, mean, scale, weights, at, share, features: int = FEATURES, seed: int = SEED):
        self.mean, self.scale, self.weights, self.at, self.share = mean, scale, weights, at, share
        rng = np.random.default_rng(seed)
        self.projection = rng.normal(size=(N_STATISTICS, features)) / np.sqrt(N_STATISTICS)
        self.phase = rng.uniform(0, 2 * np.pi, features)

    def features(self, x: np.ndarray) -> np.ndarray:
        """Cosine features, the standardised statistics themselves (clipped) and a constant."""
        s = np.clip((x - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2 / len(self.phase)) * np.cos(s @ self.projection + self.phase)
        return np.hstack([z, 0.1 * s, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.at, self.share), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: block centres and their means, ascending."""
    order = np.lexsort((y, x))
    blocks: list[list[float]] = []  # sum of y, count, sum of x
    for a, b in zip(x[order], y[order]):
        blocks.append([b, 1.0, a])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, t = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + t]
    out = np.array(blocks)
    return out[:, 2] / out[:, 1], out[:, 0] / out[:, 1]


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(key, fold, y, x): statistics of the sampled labelled documents outside fold 0, written."""
    known = (labels.select(F.col("doc_id").alias("_id"), F.col("quality").try_cast("double").alias("_y"))
             .where("_id is not null and _y is not null").groupBy("_id").agg(F.avg("_y").alias("_y")))
    known = known.where(fold("_id") != 0)
    n = known.count()
    parts = 1 << 20
    if n > sample:
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(parts)) < int(sample / n * parts))
    known = written(known, "labels")  # about `sample` rows of 16 bytes

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "fold": b["fold"], "y": b["y"], "x": list(matrix(b["text"]))})

    joined = (docs.select(F.col("doc_id").alias("_id"), text_or_empty().alias("text"))
              .join(F.broadcast(known), "_id")
              .select(F.col("_id").alias("key"), fold("_id").alias("fold"), F.col("_y").alias("y"), "text"))
    return written(joined.mapInPandas(measure, "key long, fold long, y double, x array<double>"), "statistics")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES, ridge: float = RIDGE,
        seed: int = SEED) -> Model:
    rows = training_rows(small_batches(docs), labels, sample)
    wide = rows.select("y", *[F.col("x")[i].alias(f"x{i}") for i in range(N_STATISTICS)])
    names = [f"x{i}" for i in range(N_STATISTICS)]
    s = wide.agg(F.count("*").alias("n"), F.avg("y").alias("y"), *[F.avg(c).alias(f"m_{c}") for c in names],
                 *[F.stddev_pop(c).alias(f"s_{c}") for c in names]).first()
    if not s["n"]:
        return Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS), np.zeros(features + N_STATISTICS + 1), np.array([0.0]), np.array([0.5]), features, seed)
    mean = np.array([s[f"m_{c}"] for c in names])
    scale = np.array([max(s[f"s_{c}"], 1e-9) for c in names])
    size = features + N_STATISTICS + 1
    model = Model(mean, scale, np.zeros(size), np.array([0.0]), np.array([s["y"]]), features, seed)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        zz, zy, n = np.zeros((size, size)), np.zeros(size), 0
        for b in batches:
            z = model.features(np.array(b["x"].tolist(), float).reshape(len(b), N_STATISTICS))
            zz, zy, n = zz + z.T @ z, zy + z.T @ b["y"].to_numpy(), n + len(b)
        if n:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "n": [n], "zz": [zz.tobytes()], "zy": [zy.tobytes()]})

    def total(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values("part")  # the same sum in every run
        zz, zy = (sum(np.frombuffer(x) for x in some[c]).tobytes() for c in ("zz", "zy"))
        return pd.DataFrame({"part": [some["part"].iloc[0]], "n": [some["n"].sum()], "zz": [zz], "zy": [zy]})

    ridge_rows = rows.where("fold <> 4").repartition(PARTS, "key").sortWithinPartitions("key", "y")
    kind = "part int, n long, zz binary, zy binary"
    partial = ridge_rows.select("y", "x").mapInPandas(add_up, kind)
    # A matrix is hundreds of kilobytes: the tasks' matrices are added up on executors, whatever their
    # number is, and SUMS of them reach the driver.
    sums = sorted(partial.groupBy(F.col("part") % SUMS).applyInPandas(total, kind).collect(), key=lambda r: r["part"])
    zz = sum(np.frombuffer(r["zz"]).reshape(size, size) for r in sums)
    zy = sum(np.frombuffer(r["zy"]) for r in sums)
    if not sum(r["n"] for r in sums):
        return model
    penalty = np.full(size, ridge)
    penalty[-1] = 1e-6
    model.weights = np.linalg.solve(zz + np.diag(penalty), zy)

    def raw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"y": b["y"], "raw": model.raw(np.array(b["x"].tolist(), float).reshape(len(b), N_STATISTICS))})

    seen = rows.where("fold = 4").select("y", "x").mapInPandas(raw, "y double, raw double").toPandas()  # within the sample bound
    if len(seen) and seen["y"].nunique() > 1:
        model.at, model.share = isotonic(seen["raw"].to_numpy(), seen["y"].to_numpy())
    else:  # nothing to calibrate on: the ridge value itself
        model.at, model.share = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score in [0, 1] appended as ``out``, with underscores before it where ``docs`` has such a column."""
    out = free_name(docs, out)
    parts = (model.mean, model.scale, model.weights, model.at, model.share, len(model.phase))
    shared = docs.sparkSession.sparkContext.broadcast(parts)  # a few kilobytes
    model_of, measure = Model, matrix

    @F.pandas_udf(T.DoubleType())
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = model_of(*shared.value)
        for t in texts:
            yield pd.Series(own.score(measure(t)) if len(t) else [], dtype="float64")
        give_back()

    return small_batches(docs).withColumn(out, scored(text_or_empty(f"`{text_col}`")))


def accepted(docs: DataFrame, model: Model, least: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, all columns as they are."""
    rows = nested(docs).withColumn("text", F.col("_row.text"))
    return score(rows, model, out="_score").where(F.col("_score") >= least).select("_row.*")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", (fold() == 0).alias("held_out"), "score",
                                     (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
