"""Readers: CSV (BOM, quotes, newlines, Latin-1), JSON, envelopes, suffix
dispatch, newest dataset, dataset loading, timestamp coercion, null tokens."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import types as T

from ledgerline.session import scratch_path, to_local_path
from ledgerline.sources import landing, readers

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("note", T.StringType()),
                       T.StructField("amount", T.DoubleType())])


def _write_text(spark, name: str, text: str, encoding: str = "utf-8") -> str:
    path = to_local_path(scratch_path(spark, name))
    os.makedirs(path, exist_ok=True)
    target = os.path.join(path, "data" + os.path.splitext(name)[1])
    with open(target, "w", encoding=encoding, newline="") as fh:
        fh.write(text)
    return target


def test_csv_bom_quotes_and_embedded_newlines(spark):
    text = '﻿id,note,amount\n1,"said ""hi""",1.5\n2,"two\nlines",2\n3,,\n'
    path = _write_text(spark, "reviews.csv", text)
    rows = readers.read_csv(spark, path, SCHEMA, multi_line=True).orderBy("id").collect()
    assert [r.id for r in rows] == ["1", "2", "3"]
    assert rows[0].note == 'said "hi"'
    assert rows[1].note == "two\nlines"
    assert rows[2].note is None and rows[2].amount is None


def test_csv_latin1(spark):
    path = _write_text(spark, "cities.csv", "id,note,amount\n1,São Paulo,1\n", encoding="latin-1")
    assert readers.read_csv_latin1(spark, path, SCHEMA).first().note == "São Paulo"


def test_json_array_and_lines(spark):
    arr = _write_text(spark, "a.json", '[{"id": "1", "note": "x", "amount": 1.0}, {"id": "2"}]')
    assert readers.read_json(spark, arr, SCHEMA, multi_line=True).count() == 2
    lines = _write_text(spark, "b.json", '{"id": "1"}\n{"id": "2", "amount": 3}\n')
    assert readers.read_json(spark, lines, SCHEMA).count() == 2


def test_envelope_and_plain_records(spark):
    env = _write_text(spark, "env.json",
                      '{"value": [{"id": "1"}, {"id": "2"}]}\n{"value": [{"id": "3"}]}\n')
    assert sorted(r.id for r in readers.read_json_envelope(spark, env, SCHEMA).collect()) == [
        "1", "2", "3"]
    plain = _write_text(spark, "plain.json", '{"id": "9", "note": "n"}\n')
    assert readers.read_json_envelope(spark, plain, SCHEMA).first().id == "9"
    whole = _write_text(spark, "whole.json", '{"value": [{"id": "1"}, {"id": "2"}]}')
    assert readers.read_json_envelope(spark, whole, SCHEMA, multi_line=True).count() == 2


def test_envelope_without_records(spark):
    path = _write_text(spark, "hollow.json", '{"value": null}\n{"value": []}\n{}\n{"note": "kept"}\n{"value": [{"id": "7"}]}\n')
    rows = readers.read_json_envelope(spark, path, SCHEMA).collect()
    assert sorted((r.id or "", r.note or "") for r in rows) == [("", "kept"), ("7", "")]


def test_envelope_pages_are_bounded(spark):
    df = spark.range(2500).selectExpr("cast(id as string) as id", "'n' as note", "1.0 as amount")
    path = scratch_path(spark, "pages")
    landing.write_json_envelopes(df, path, page_size=1000)
    sizes = spark.read.json(path).selectExpr("size(value) as n").collect()
    assert max(r.n for r in sizes) <= 1000
    assert readers.read_json_envelope(spark, path, SCHEMA).count() == 2500


def test_suffix_dispatch_and_errors(spark):
    path = _write_text(spark, "x.CSV", "id,note,amount\n1,a,1\n")
    assert readers.read_by_suffix(spark, path, SCHEMA).count() == 1
    with pytest.raises(ValueError):
        readers.read_by_suffix(spark, "/nowhere/file.txt")       # suffix checked first
    with pytest.raises(FileNotFoundError):
        readers.read_by_suffix(spark, "/nowhere/file.csv", SCHEMA)


def test_newest_entry_skips_ignored_and_other_suffixes(spark):
    root = scratch_path(spark, "landing")
    spark.range(3).write.parquet(f"{root}/old")
    time.sleep(0.05)
    spark.range(5).write.parquet(f"{root}/new")
    time.sleep(0.05)
    spark.range(7).write.parquet(f"{root}/archive/newest")
    spark.range(9).write.csv(f"{root}/text")
    newest = readers.newest_entry(spark, root, {".PARQUET"}, ignore_dirs=[f"{root}/archive"])
    assert newest.endswith("/new")
    assert spark.read.parquet(newest).count() == 5
    with pytest.raises(FileNotFoundError):
        readers.newest_entry(spark, root, {".json"})


def test_load_dataset_reports_all_missing(spark):
    base = scratch_path(spark, "dataset")
    spark.range(1).write.parquet(f"{base}/orders.parquet")
    with pytest.raises(FileNotFoundError) as err:
        readers.load_dataset(spark, base, {"orders": "orders.parquet", "customers": "c.parquet",
                                           "sellers": "s.parquet"})
    assert "c.parquet" in str(err.value) and "s.parquet" in str(err.value)


def test_coerce_timestamps(spark):
    df = spark.createDataFrame([("2022-01-01 10:00:00",), ("not a date",), ("",), (None,),
                                ("2022-01-05T14:45:00.000",)], "t string")
    out = [r.t for r in readers.coerce_timestamps(df, ["t"]).collect()]
    assert out == [dt.datetime(2022, 1, 1, 10), None, None, None, dt.datetime(2022, 1, 5, 14, 45)]


def test_null_tokens(spark):
    df = spark.createDataFrame([("NA", 1), ("null", 2), ("", 3), ("ok", 4), ("None", 5)],
                               "s string, n int")
    out = [r.s for r in readers.normalize_null_tokens(df).orderBy("n").collect()]
    assert out == [None, None, None, "ok", None]


def test_raw_schema_keeps_timestamps_as_text():
    from ledgerline import schemas

    raw = schemas.raw_schema("orders")
    assert dict((f.name, f.dataType) for f in raw.fields)["order_approved_at"] == T.StringType()
    assert dict((f.name, f.dataType) for f in schemas.raw_schema("order_items").fields)[
        "price"] == T.DoubleType()


def test_load_dataset_from_csv_restores_types(spark):
    base = scratch_path(spark, "csv_dataset")
    local = to_local_path(base)
    os.makedirs(local, exist_ok=True)
    with open(os.path.join(local, "sellers.csv"), "w", encoding="utf-8") as fh:
        fh.write("seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
                 "s1,1310.0,Sao Paulo,SP\ns2,,Rio,RJ\n")
    with open(os.path.join(local, "orders.csv"), "w", encoding="utf-8") as fh:
        fh.write("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
                 "order_delivered_carrier_date,order_delivered_customer_date,"
                 "order_estimated_delivery_date\n"
                 "o1,c1,delivered,2022-01-01 10:00:00,not a date,,2022-01-10 15:00:00,"
                 "2022-01-15 00:00:00\n")
    tables = readers.load_dataset(spark, base, {"sellers": "sellers.csv", "orders": "orders.csv"})
    sellers = {r.seller_id: r for r in tables["sellers"].collect()}
    assert sellers["s1"].seller_zip_code_prefix == 1310
    assert sellers["s2"].seller_zip_code_prefix is None
    assert dict(tables["sellers"].dtypes)["seller_zip_code_prefix"] == "bigint"  # the whole unsigned range
    order = tables["orders"].first()
    assert order.order_purchase_timestamp == dt.datetime(2022, 1, 1, 10)
    assert order.order_approved_at is None and order.order_delivered_carrier_date is None
    assert dict(tables["orders"].dtypes)["order_approved_at"] == "timestamp_ntz"


def test_newest_entry_picks_single_files_at_the_root(spark):
    root = scratch_path(spark, "flat_landing")
    local = to_local_path(root)
    os.makedirs(local, exist_ok=True)
    for i, name in enumerate(["old.csv", "new.CSV", "skip.txt"]):
        with open(os.path.join(local, name), "w", encoding="utf-8") as fh:
            fh.write("id,note,amount\n1,a,1\n")
        os.utime(os.path.join(local, name), (1_700_000_000 + i * 100,) * 2)
    newest = readers.newest_entry(spark, root, {".csv"})
    assert newest.endswith("/new.CSV")
    assert readers.read_by_suffix(spark, newest, SCHEMA).count() == 1


def test_newest_entry_finds_nested_files_and_partitioned_sets(spark, tmp_path):
    for i, name in enumerate(["2024/01/new.csv", "2024/02/old.csv"]):
        path = tmp_path / "land" / name
        path.parent.mkdir(parents=True)
        path.write_text("id,note,amount\n1,a,1\n")
        os.utime(path, (1_700_000_000 - i * 100,) * 2)
    newest = readers.newest_entry(spark, str(tmp_path / "land"), {".csv"})
    assert newest.endswith("/land/2024/01/new.csv")
    assert readers.read_by_suffix(spark, newest, SCHEMA).count() == 1
    spark.range(6).selectExpr("id", "id % 2 as p").write.partitionBy("p").parquet(f"{tmp_path}/sets/deep/numbers")
    assert readers.newest_entry(spark, f"{tmp_path}/sets", {".parquet"}).endswith("/sets/deep/numbers")


def test_load_dataset_quoted_newlines_null_tokens_and_wide_integers(spark, tmp_path):
    (tmp_path / "order_reviews.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,NA,"two\nlines",2024-01-01 00:00:00,2024-01-02 00:00:00\n'
        "r2,o2,4,null,plain,2024-01-01 00:00:00,2024-01-02 00:00:00\n")
    (tmp_path / "customers.csv").write_text(
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,3000000000,NA,None\n")
    from ledgerline.sources.readers import load_dataset

    got = load_dataset(spark, str(tmp_path), {"order_reviews": "order_reviews.csv", "customers": "customers.csv"})
    reviews = {r["review_id"]: r for r in got["order_reviews"].collect()}
    assert set(reviews) == {"r1", "r2"}
    assert reviews["r1"]["review_comment_message"] == "two\nlines"
    assert reviews["r1"]["review_comment_title"] is None and reviews["r2"]["review_comment_title"] is None
    customer = got["customers"].first()
    assert customer["customer_zip_code_prefix"] == 3_000_000_000
    assert customer["customer_city"] is None and customer["customer_state"] is None
