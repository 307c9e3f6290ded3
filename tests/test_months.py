"""The month-laid queries read what they stored, and neither compute the fact again nor read all of it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerline import queries
from ledgerline.operators.silver import build_silver
from ledgerline.sinks import writers


@pytest.fixture()
def in_1994(raw_tables, monkeypatch):
    """The fixture's orders with numbers as ids, bought in 1994-03 (three) and 1994-04 (one)."""
    tables = {n: df.withColumn("order_id", F.substring("order_id", 7, 3).cast("long")) if "order_id" in df.columns else df
              for n, df in raw_tables.items()}
    tables["orders"] = tables["orders"].withColumn("order_purchase_timestamp", F.expr("order_purchase_timestamp - INTERVAL 334 MONTHS"))
    monkeypatch.setattr(queries, "silver_tables", lambda spark, sf_dir: build_silver(tables, strip_prefix=True))


def test_replaced_months_are_made_from_the_stored_rows(spark, in_1994, monkeypatch):
    read, replace = [], writers.replace_months

    def noted(df, path, table):
        read.extend((path, f) for f in df.inputFiles())
        replace(df, path, table)

    monkeypatch.setattr(writers, "replace_months", noted)
    got = queries.QUERIES["month_pruned_read"](spark, "").collect()
    assert [(int(r["order_id"]), r["purchase_year_month"], r["order_status"]) for r in got] == [(3, "1994-04", "closed")]
    assert read and all(path.removeprefix("file:") in f for path, f in read)


def test_low_months_are_broadcast_whatever_their_estimate(spark, in_1994):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, "-1")  # as for tables of any size
        got = queries.QUERIES["month_dynamic_pruning"](spark, "")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "dynamicpruning" in plan
        assert got.count() == 5
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
