"""Stages on documents with private names of the operators, null columns, repeated rows and no rows at all."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from ledgerline.llm import exact_dedup, minhash, quality
from ledgerline.llm.common import table, written

SF = "/root/testdata/sf0.001"
NAMES = ["_exact_id", "_exact_digest", "_id", "_digest", "_near_id", "_row", "score", "_score", "_quality_score", "kept", "digest", "component_id",
         "_mix", "_mix_position", "size", "words", "n_tokens", "ids", "decoded", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = table(spark, SF, "documents").limit(60)
    rows = rows.unionByName(rows.limit(5))  # repeated rows
    odd = rows.limit(3).withColumns({"doc_id": F.col("doc_id") + 10_000, "text": F.lit(None).cast("string"), "source": F.lit(None).cast("string"),
                                     "lang": F.lit(None).cast("string")})
    return written(rows.unionByName(odd).withColumns({n: F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")) for n in NAMES}), "clashes")


def untouched(df):
    return all(r[n] == f"{n} of {r['doc_id']}" for r in df.collect() for n in NAMES)


def test_columns_with_private_names_pass_untouched(spark, docs):
    for kept in (exact_dedup.without_copies(docs), minhash.without_near_copies(docs)):
        assert kept.columns == docs.columns and untouched(kept) and kept.count() > 0
    model = quality.fit(docs, table(spark, SF, "labels"))
    scored = quality.score(docs, model)
    assert scored.columns == [*docs.columns, "__score"] and untouched(scored)
    assert untouched(quality.accepted(docs, model))


def test_every_stage_keeps_such_columns_and_takes_empty_tables(spark, docs):
    now = docs
    for name, stage in pipeline.STAGES[:-1]:
        now = written(stage(spark, now, SF), f"clashes-{name}")
        assert now.columns == docs.columns
    assert untouched(now)
    coded = pipeline.STAGES[-1][1](spark, now, SF)
    assert coded.where("not round_trip").count() == 0
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
