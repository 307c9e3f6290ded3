"""The reject channel and the parallel reader of quoted newlines."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.session import scratch_path
from ledgerline.sinks import runs, writers
from ledgerline.sources import quoted, readers, rejects

TEXT = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def random_rows(seed: int, n: int = 150) -> list[list[str]]:
    rng = random.Random(seed)
    parts = ["a", 'b"', '""', "\n", ",", " ", '"', "é", "\n\n", "x" * 30, "\r\n"]
    return [[str(i), *("".join(rng.choices(parts, k=rng.choice([0, 1, 3, 9, 40]))) for _ in range(2))] for i in range(n)]


@pytest.mark.parametrize("mark", ["", "﻿"], ids=["plain", "byte-order mark"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_newlines_equal_the_whole_file_reader(spark, tmp_path, small_splits, mark, end):
    rows = random_rows(3)
    rows[50][1] = "long\n" * 400  # one record over many splits
    text = io.StringIO()
    out = csv.writer(text, lineterminator=end)
    out.writerows([["a", "b", "c"], *rows])
    path = str(tmp_path / "t.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(mark + text.getvalue() + f'{end}7" x,5" y,z{end}')  # a blank line, and quotes inside unquoted fields
    assert quoted._lines(spark, path, "UTF-8").rdd.getNumPartitions() > 10
    got = sorted(map(tuple, quoted.read_csv_quoted(spark, path, TEXT).collect()), key=str)
    assert got == sorted(map(tuple, readers.read_csv(spark, path, TEXT, multi_line=True).collect()), key=str)
    assert len(got) == len(rows) + 1


def test_quoted_reader_takes_many_files_and_other_encodings(spark, tmp_path, small_splits):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_bytes(f'a,b,c\n{k},"São\n{"x" * 500}",é\n'.encode("latin-1"))
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "header.csv").write_bytes(b'"a","b\nb",c\n')
    got = sorted(map(tuple, quoted.read_csv_quoted(spark, str(tmp_path), TEXT, "ISO-8859-1").collect()))
    assert got == [(str(k), "São\n" + "x" * 500, "é") for k in range(3)]
    with pytest.raises(ValueError):
        quoted.read_csv_quoted(spark, str(tmp_path), TEXT, "UTF-16")


def test_line_functions():
    cases = {"": (0, 1), "a,b": (0, 1), '"a",b': (0, 0), '"a': (1, 0), 'a"': (0, 0), '"a""': (1, 0), '"a"",b': (1, 0), 'x,"y': (1, 0),
             '5" disk': (0, 0), '"",""': (0, 1), '""': (0, 1), '",': (1, 0), 'a","b': (1, 1)}
    for line, (outside, inside) in cases.items():
        assert quoted.end_state(line, quoted.OUTSIDE) == outside, line
        assert quoted.end_state(line, quoted.INSIDE) == inside, line


def land(tmp_path, **texts: str) -> dict[str, str]:
    files = {}
    for name in schemas.SOURCE_NAMES:
        body = texts.get(name, "")
        (tmp_path / f"{name}.csv").write_text(",".join(schemas.columns(f"bronze_{name}")) + "\n" + body, encoding="utf-8")
        files[name] = f"{name}.csv"
    return files


ORDERS = ("o1,c1,delivered,2022-01-01 10:00:00,not a date,,,\n"  # one bad timestamp
          "o2,c2,delivered,2022-01-01 10:00:00\n"                # too few fields
          "o3,c3,shipped,2022-01-01 10:00:00,NA,nan,,,extra\n"   # too many
          "o4,c4,shipped,2022-13-01 10:00:00,yesterday,,,\n")    # two bad timestamps
ITEMS = ("o1,1,p,s,2022-01-01 00:00:00,10.5,1\n"
         "o1,2.0,p,s,,free,1\n"                                  # 2.0 is an integer; a bad number
         "o1,2.5,p,s,,1,N/A\n"                                   # a fraction
         "o1,99999999999999999999,p,s,,1,1\n")                   # beyond 64 bits
REVIEWS = 'r1,o1,5,"two\nlines","a ""quoted"" word",2022-01-01 00:00:00,\nr2,o1,five,,,soon,\n'


def checked(spark, tmp_path, limits=None):
    return rejects.load_checked(spark, str(tmp_path), land(tmp_path, orders=ORDERS, order_items=ITEMS, order_reviews=REVIEWS), limits)


ALL = {r: 1.0 for r in rejects.DEFAULT_LIMITS}


def test_counts_come_with_the_write_and_lines_are_kept(spark, tmp_path):
    root = scratch_path(spark, "rejects")
    writers.full_refresh(spark, checked(spark, tmp_path, ALL), root, run_id="r", validate=False, stop_after="bronze")
    got = {(r.table_name, r.reason, r.column_name): (r.rejected, r.total) for r in writers.run_rejects(spark, root, "r").collect() if r.rejected}
    assert got == {
        ("orders", "broken_line", None): (2, 4), ("orders", "bad_timestamp", "order_approved_at"): (2, 4),
        ("orders", "bad_timestamp", "order_purchase_timestamp"): (1, 4),
        ("order_items", "bad_number", "price"): (1, 4), ("order_items", "bad_integer", "order_item_id"): (2, 4),
        ("order_reviews", "bad_integer", "review_score"): (1, 2), ("order_reviews", "bad_timestamp", "review_creation_date"): (1, 2)}
    lines = {(r.table_name, r.reason, r.column_name, r.value, r.line) for r in
             spark.read.schema(rejects.LINE_SCHEMA).parquet(runs.rejects_path(root, "r")).collect()}
    assert ("orders", "broken_line", None, None, "o2,c2,delivered,2022-01-01 10:00:00") in lines
    assert ("orders", "broken_line", None, None, "o3,c3,shipped,2022-01-01 10:00:00,NA,nan,,,extra") in lines
    assert ("orders", "bad_timestamp", "order_approved_at", "yesterday", "o4,c4,shipped,2022-13-01 10:00:00,yesterday,,,") in lines
    assert ("order_items", "bad_integer", "order_item_id", "99999999999999999999", "o1,99999999999999999999,p,s,,1,1") in lines
    assert len(lines) == 10
    orders = {r.order_id: r for r in writers.read_published(spark, root, "bronze_orders", "r").collect()}
    assert set(orders) == {"o1", "o4"} and orders["o1"].order_approved_at is None and orders["o4"].order_purchase_timestamp is None
    items = writers.read_published(spark, root, "bronze_order_items", "r")
    assert sorted((r.order_item_id or 0, r.price or 0) for r in items.collect()) == [(0, 1), (0, 1), (1, 10.5), (2, 0)]
    review = {r.review_id: r for r in writers.read_published(spark, root, "bronze_order_reviews", "r").collect()}
    assert review["r1"].review_comment_title == "two\nlines" and review["r1"].review_comment_message == 'a "quoted" word'


def test_limits_stop_the_run_and_name_every_case(spark, tmp_path):
    root = scratch_path(spark, "limits")
    with pytest.raises(rejects.RejectedInput) as error:
        writers.full_refresh(spark, checked(spark, tmp_path), root, run_id="r", validate=False)
    said = str(error.value)
    assert "orders: 2 of 4 lines broken_line" in said and "order_items: 2 of 4 lines bad_integer in order_item_id" in said
    assert "bad_timestamp" not in said  # they become NULL, as in the original job
    assert runs.latest_record(spark, root) is None
    with pytest.raises(rejects.RejectedInput, match="bad_timestamp"):
        rejects.enforce_limits([("orders", "bad_timestamp", "x", 1, 4)], {"bad_timestamp": 0.2})
    rejects.enforce_limits([("orders", "bad_timestamp", "x", 1, 4), ("sellers", "broken_line", None, 0, 0)])


def test_resumed_run_keeps_its_counts(spark, tmp_path):
    root = scratch_path(spark, "again")
    for _ in range(2):  # the second time nothing is written, so nothing is observed
        writers.full_refresh(spark, checked(spark, tmp_path, ALL), root, run_id="r", validate=False, stop_after="bronze",
                             versions={n: "1" for n in schemas.SOURCE_NAMES})
    assert sum(r.rejected for r in writers.run_rejects(spark, root, "r").collect()) == 10


def test_clean_dataset_equals_the_plain_loader(spark, raw_tables, tmp_path):
    files = {}
    for name, df in raw_tables.items():
        df.write.option("header", True).option("escape", '"').csv(str(tmp_path / f"{name}.csv"))
        files[name] = f"{name}.csv"
    plain = readers.load_dataset(spark, str(tmp_path), files)
    for name, df in rejects.load_checked(spark, str(tmp_path), files).items():
        assert df.dtypes == plain[name].dtypes
        assert sorted(df.collect(), key=str) == sorted(plain[name].collect(), key=str)


def test_missing_files_are_reported_together(spark, tmp_path):
    files = land(tmp_path)
    files.update(orders="gone.csv", sellers="lost.csv")
    with pytest.raises(FileNotFoundError, match="gone.csv.*lost.csv"):
        rejects.load_checked(spark, str(tmp_path), files)
