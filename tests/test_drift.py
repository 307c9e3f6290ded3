"""JSON payloads of drifting shape: nothing is lost unseen."""

from __future__ import annotations

from pyspark.sql import types as T

from ledgerline.sources import drift

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("price", T.DoubleType())])
LINES = [
    '{"value": [{"id": 1, "name": "a", "price": 1.5}, {"id": 2, "name": null, "price": 2}]}',
    '{"value": [{"id": 3, "name": "c", "price": "dear", "tags": ["x"]}]}',
    '{"id": 4, "name": "d", "price": 4, "tags": []}',
    '{"id": "5", "name": 6, "price": "7.5"}',  # convert, as a schema read of text would
    '{"value": []}', "{}", '{"value": null}', "",
    '{"id": 8, "name"',
]


def report(df):
    return {(r.kind, r.field, r.seen_type): r.records for r in df.collect()}


def test_declared_fields_and_report(spark, tmp_path):
    (tmp_path / "p.json").write_text("\n".join(LINES))
    seen = drift.read_variants(spark, str(tmp_path / "p.json"))
    rows = sorted(map(tuple, drift.declared(seen, SCHEMA).collect()))
    assert rows == [(1, "a", 1.5), (2, None, 2.0), (3, "c", None), (4, "d", 4.0), (5, "6", 7.5)]
    got = report(drift.drift(seen, SCHEMA))
    assert got.pop(("added", "value", "VOID"), 0) <= 1  # a page without records
    assert got == {("added", "tags", "ARRAY<STRING>"): 1, ("added", "tags", "ARRAY<VOID>"): 1,
                   ("retyped", "price", "STRING"): 1, ("unreadable", None, None): 1}


def test_clean_payload_has_an_empty_report(spark, tmp_path):
    (tmp_path / "p.json").write_text(LINES[0])
    seen = drift.read_variants(spark, str(tmp_path / "p.json"))
    assert drift.drift(seen, SCHEMA).count() == 0 and drift.declared(seen, SCHEMA).count() == 2
