"""Columns of the input that bear the names of the mix's own."""

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing

OWN = ["_mix", "__MIX", "_mix_row", "_mix_source", "_mix_order", "_mix_bucket", "_mix_size", "_mix_run", "_mix_at", "_mix_start", "_mix_copies", "_mix_position", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "w " * (i % 7 + 1), "ab"[i % 2]) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_clashing_columns_pass_through(docs):
    clash = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in OWN})
    got = mixing.mix(clash)
    assert got.columns == [*clash.columns, "___mix"]
    want = {r["doc_id"]: r["_mix"] for r in mixing.mix(docs).collect()}
    for r in got.collect():
        assert [r[c] for c in OWN] == [f"{c}{r['doc_id']}" for c in OWN] and r["___mix"] == want[r["doc_id"]]
    copies = mixing.curriculum(clash)
    assert copies.columns == clash.columns
    rows = copies.collect()
    assert [r["doc_id"] for r in rows] == [r["doc_id"] for r in mixing.curriculum(docs).collect()]
    assert all([r[c] for c in OWN] == [f"{c}{r['doc_id']}" for c in OWN] for r in rows)


def test_empty_table_with_clashing_column(docs):
    empty = docs.limit(0).withColumn("_mix", F.lit(2))
    assert mixing.mix(empty).count() == 0 and mixing.curriculum(empty).columns == empty.columns
