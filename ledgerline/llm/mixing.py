"""Mixing sources to target weights along a curriculum, with DataFrame functions only.

Each source has a target (words the mix takes from it) and a weight schedule
over training time t in [0, 1]. A source's demand rate is
``target * (1 + a * (2 t - 1))`` with slope ``a`` in (-1, 1): ``a < 0`` is heavier
early, ``a > 0`` late, and the integral over [0, 1] is the target. Cumulative
demand ``target * (t + a (t^2 - t))`` is inverted in closed form at the word offset
of each document copy; that t is the copy's training position.

Order within a source is by a seeded hash of the doc_id. A source is passed
over ``floor(target / source size)`` times whole, and once more up to the
remainder: the document across the cut is taken when at least half of it lies
before the cut, so a source misses its target by at most half a document.

Running offsets are two-level sums. Words are summed per (source, hash bucket)
with partial aggregation; only the small bucket table is summed along a source.
Documents are ordered inside a (source, bucket), so a source with a third of all
rows is spread over 4096 groups.

Defined cases: a null or blank text has size 0 and taken 0; a null source is a
source of its own, last in order; repeated rows and ties are ordered by
(hash, doc_id, size), equal rows being interchangeable; an empty table gives an
empty result; extra columns, of any name, pass through ``mix`` untouched (its own
result column takes another name where the input has a ``_mix``: ``result_name``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import table, text_or_empty, written

WEIGHTS = (1, 2, 3)
SLOPES = (-0.5, 0.0, 0.5)
CAP = 3
#: Names of the plan's own columns; the input's travel in the struct ROW, where none of them can clash.
ROW, KEY, ORDER, BUCKET, SIZE = "_mix_row", "_mix_source", "_mix_order", "_mix_bucket", "_mix_size"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def keyed(docs: DataFrame, seed: int = 0, size: Column | None = None) -> DataFrame:
    """``docs`` as a struct, with the source key, size, order and hash bucket of each row."""
    order = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"|{seed}")))
    source = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW), source.alias(KEY),
        (word_count(text_or_empty()) if size is None else size).alias(SIZE),
        order.alias(ORDER), F.substring(order, 1, 3).alias(BUCKET))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, slopes: Sequence[float] = SLOPES,
                   cap: int = CAP) -> DataFrame:
    """Targets from (key, source size), one row per source.

    The shares fill up to ``cap`` times each size: in order of cap / weight, a
    source is capped when all from it on, at its level, would take at most the
    total. The rest share what remains by weight: the fixed point of resharing
    the excess until nothing is above its cap. The windows here run over one row
    per source.
    """
    by_name = W.orderBy((F.col(KEY) == "").asc(), KEY)
    r = sizes.withColumn("r", F.row_number().over(by_name) - 1)
    pick = lambda values, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), (F.col("r") % len(values) + 1).cast("int"))
    r = r.withColumns({"weight": pick(weights, "long"), "slope": pick(slopes, "double"),
                       "cap": F.col("source_size") * cap})
    level = W.orderBy(F.col("cap") / F.col("weight"), "r")
    before = level.rowsBetween(W.unboundedPreceding, -1)
    after = level.rowsBetween(W.currentRow, W.unboundedFollowing)
    everyone = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    r = r.withColumns({"total": F.sum("source_size").over(everyone),
                       "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
                       "weight_after": F.sum("weight").over(after)})
    r = r.withColumn("capped", F.col("cap") * F.col("weight_after") <= (F.col("total") - F.col("cap_before")) * F.col("weight"))
    r = r.withColumns({"cap_used": F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everyone),
                       "weight_free": F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everyone)})
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (F.col("total") - F.col("cap_used")) * F.col("weight") / F.when(F.col("weight_free") > 0, F.col("weight_free")))
    return r.select(KEY, "source_size", "slope", target.alias("target"))


def result_name(docs: DataFrame) -> str:
    """``_mix``, with as many more underscores before it as no column of ``docs`` has that name."""
    name, used = "_mix", {c.lower() for c in docs.columns}
    while name in used:
        name = "_" + name
    return name


def planned(docs: DataFrame, seed: int = 0, size: Column | None = None, weights: Sequence[int] = WEIGHTS,
            slopes: Sequence[float] = SLOPES, cap: int = CAP) -> DataFrame:
    """The rows of ``docs`` as the struct ROW, with the struct ``_mix`` of ``mix``."""
    rows = keyed(docs, seed, size)
    buckets = written(rows.groupBy(KEY, BUCKET).agg(F.sum(SIZE).alias("words")), "mix-buckets")
    targets = source_targets(buckets.groupBy(KEY).agg(F.sum("words").alias("source_size")), weights, slopes, cap)
    along = W.partitionBy(KEY).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, W.currentRow)
    starts = (buckets.withColumn("start", F.sum("words").over(along) - F.col("words"))
              .join(targets, KEY)
              .select(KEY, BUCKET, F.struct("start", "source_size", "target", "slope").alias("_mix_at")))
    inside = W.partitionBy(KEY, BUCKET).orderBy(ORDER, f"{ROW}.doc_id", SIZE).rowsBetween(W.unboundedPreceding, W.currentRow)
    at, n, words = F.col("_mix_at"), F.col(SIZE), F.col("_mix_at.source_size")
    start = at["start"] + F.col("_mix_run") - n
    whole = F.when(words > 0, F.least(F.floor(at["target"] / words), F.lit(cap))).otherwise(F.lit(0)).cast("int")
    rest = at["target"] - whole * words
    copies = whole + ((rest > 0) & (whole < cap) & (start * 2 + n <= rest * 2)).cast("int")
    share = lambda i: F.least((i * words + F.col("_mix_start") + n / 2) / at["target"], F.lit(1.0))
    flat = lambda u: 2 * u / ((1 - at["slope"]) + F.sqrt((1 - at["slope"]) * (1 - at["slope"]) + 4 * at["slope"] * u))
    positions = F.when(F.col("_mix_copies") > 0, F.transform(F.sequence(F.lit(0), F.col("_mix_copies") - 1), lambda i: flat(share(i)))) \
        .otherwise(F.array().cast("array<double>"))
    placed = (rows.withColumn("_mix_run", F.sum(SIZE).over(inside)).join(starts, [KEY, BUCKET])
              .withColumns({"_mix_start": start, "_mix_copies": copies}))
    return placed.select(ROW, F.struct(
        n.alias("size"), words.alias("source_size"), at["target"].alias("target"), F.col("_mix_copies").alias("copies"),
        (n * F.col("_mix_copies")).alias("taken"), positions.alias("positions")).alias("_mix"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, source, text or ``size``, any other columns) with a struct ``_mix`` (see ``result_name``):
    size, source_size, target, copies, taken, positions (one per copy, ascending)."""
    return planned(docs, **options).select(f"{ROW}.*", F.col("_mix").alias(result_name(docs)))


def curriculum(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: one row per copy, range-sorted by training position."""
    copies = planned(docs, **options).select(ROW, F.explode("_mix.positions").alias("_mix_position"))
    return copies.orderBy("_mix_position", f"{ROW}.doc_id").select(f"{ROW}.*")


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(text_or_empty()).alias("size"))
    docs = written(docs, "mix-sizes")
    return (mix(docs, size=F.col("size"))
            .select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", "_mix.taken",
                    F.try_element_at("_mix.positions", F.lit(1)).alias("first_position"))
            .orderBy(F.col("first_position").asc_nulls_last(), "doc_id"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|0') AS o
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS r FROM s),
w AS (SELECT *, (r % 3 + 1)::BIGINT AS weight, ((r % 3) - 1) / 2.0::DOUBLE AS slope, source_size * 3 AS cap FROM r),
l AS (SELECT *, sum(source_size) OVER () AS total,
        coalesce(sum(cap) OVER (ORDER BY cap / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
        sum(weight) OVER (ORDER BY cap / weight, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_after
      FROM w),
c AS (SELECT *, cap * weight_after <= (total - cap_before) * weight AS capped FROM l),
f AS (SELECT *, sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS cap_used,
        sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS weight_free FROM c),
t AS (SELECT source, source_size, slope,
        CASE WHEN capped THEN cap::DOUBLE ELSE ((total - cap_used) * weight)::DOUBLE / nullif(weight_free, 0)::DOUBLE END AS target
      FROM f),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.slope,
        (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start,
        CASE WHEN t.source_size > 0 THEN least(floor(t.target / t.source_size), 3) ELSE 0 END AS whole
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, (whole + CASE WHEN target - whole * source_size > 0 AND whole < 3
                             AND start * 2 + size <= (target - whole * source_size) * 2 THEN 1 ELSE 0 END)::BIGINT AS copies,
        least((start + size / 2.0::DOUBLE) / target, 1.0::DOUBLE) AS u FROM p)
SELECT doc_id, size, source_size, target, size * copies AS taken,
       CASE WHEN copies > 0 THEN 2 * u / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * u)) END AS first_position
FROM k
"""
