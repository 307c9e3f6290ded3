"""Published runs: manifests, resuming, compare-and-set publishing, retention, the month layout."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import quality as Q
from ledgerline.session import scratch_path
from ledgerline.sinks import runs, writers


def landed(spark, raw_tables, root):
    """The fixture tables as files, so that their versions can be told."""
    for name, df in raw_tables.items():
        df.write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in raw_tables}


def test_resumed_run_writes_only_what_is_missing(spark, raw_tables, monkeypatch):
    sources, root = landed(spark, raw_tables, scratch_path(spark, "sources")), scratch_path(spark, "resume")
    writes = []
    plain = writers._observed_write

    def broken(df, path, table, checks):
        if table == "gold_fct_order_items":
            raise RuntimeError("executors lost")
        writes.append(table)
        return plain(df, path, table, checks)

    monkeypatch.setattr(writers, "_observed_write", broken)
    with pytest.raises(RuntimeError, match="executors lost"):
        writers.full_refresh(spark, sources, root, min_rows=1, run_id="r")
    assert runs.latest_record(spark, root) is None
    assert set(writes) >= set(schemas.BRONZE_ORDER + schemas.SILVER_ORDER)
    first = set(writes)
    writes.clear()
    monkeypatch.setattr(writers, "_observed_write", lambda *a: (writes.append(a[2]), plain(*a))[1])
    writers.full_refresh(spark, sources, root, min_rows=1, run_id="r")
    assert set(writes) == set(schemas.LOAD_ORDER) - first and "gold_fct_order_items" in writes
    assert runs.current_run(spark, root) == "r" and writers.changed_tables(spark, root) == []

    whole = scratch_path(spark, "whole")
    writers.full_refresh(spark, sources, whole, min_rows=1)
    assert sorted(writers.published_fingerprints(spark, whole).collect()) == sorted(writers.published_fingerprints(spark, root).collect())


def test_changed_source_is_written_again(spark, raw_tables, monkeypatch):
    place, root = scratch_path(spark, "sources"), scratch_path(spark, "changed")
    sources = landed(spark, raw_tables, place)
    writers.full_refresh(spark, sources, root, min_rows=1, run_id="r", stop_after="silver")
    raw_tables["sellers"].limit(2).write.mode("overwrite").parquet(f"{place}/sellers")
    sources["sellers"] = spark.read.parquet(f"{place}/sellers")
    writes, plain = [], writers._observed_write
    monkeypatch.setattr(writers, "_observed_write", lambda *a: (writes.append(a[2]), plain(*a))[1])
    writers.full_refresh(spark, sources, root, min_rows=1, run_id="r")
    assert {"bronze_sellers", "silver_sellers", "gold_dim_sellers"} <= set(writes)
    assert not {"bronze_orders", "silver_orders", "silver_geolocations"} & set(writes)
    assert writers.read_published(spark, root, "gold_dim_sellers").count() == 2


def test_manifest_tells_a_table_that_changed_later(spark, raw_tables):
    root = scratch_path(spark, "tampered")
    writers.full_refresh(spark, raw_tables, root, min_rows=1, run_id="r")
    assert writers.changed_tables(spark, root) == []
    path = runs.table_path(root, "r", "silver_sellers")
    rows = spark.read.parquet(path).limit(2).collect()
    spark.createDataFrame(rows, schemas.TABLES["silver_sellers"]).write.mode("overwrite").parquet(path)
    assert writers.changed_tables(spark, root) == ["silver_sellers"]


def test_observed_checks_equal_the_scanned_ones(spark, raw_tables):
    root = scratch_path(spark, "observed")
    writers.full_refresh(spark, raw_tables, root, min_rows=1, run_id="r")
    tables = {t: writers.read_published(spark, root, t) for t in schemas.LOAD_ORDER}
    for table, checks in Q.checks_by_table(Q.suite_checks(1)).items():
        seen = runs.recorded_table(spark, root, "r", table).checks
        assert sorted(Q.observed_report(spark, checks, seen).collect(), key=str) == sorted(Q.table_report(tables[table], checks).collect(), key=str)


def test_concurrent_publishers_lose_no_record(spark):
    root = scratch_path(spark, "concurrent")
    threads = [threading.Thread(target=runs.publish, args=(spark, root, f"run-{k}")) for k in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    records = runs.publish_records(spark, root)
    assert [r.number for r in records] == list(range(1, 13))
    assert {r.run_id for r in records} == {f"run-{k}" for k in range(12)}


def test_publish_based_on_an_old_record_is_refused(spark):
    root = scratch_path(spark, "cas")
    first = runs.publish(spark, root, "a")
    second = runs.publish(spark, root, "b", based_on=first.number)
    with pytest.raises(runs.PublishConflict):
        runs.publish(spark, root, "c", based_on=first.number)
    assert runs.current_run(spark, root) == "b" and second.number == 2


def test_unfinished_record_is_not_read(spark):
    root = scratch_path(spark, "unfinished")
    runs.publish(spark, root, "a")
    runs._Store(spark, root).create_new("published/000000000002", "")  # a publisher that died between create and write
    assert runs.current_run(spark, root) == "a"
    assert runs.publish(spark, root, "b").number == 3 and runs.current_run(spark, root) == "b"


def test_expiry_keeps_named_and_young_runs(spark):
    root = scratch_path(spark, "expiry")
    store = runs._Store(spark, root)
    for k in range(5):
        store.create_new(f"runs/r{k}/_manifest/t", "{}")
        runs.publish(spark, root, f"r{k}")
    store.create_new("runs/unpublished/_manifest/t", "{}")
    assert runs.expire_runs(spark, root, keep=1) == []  # all are young
    assert runs.expire_runs(spark, root, keep=2, min_age_seconds=-60) == ["r0", "r1", "r2", "unpublished"]
    runs.publish(spark, root, "r3")  # back to an older run
    assert runs.expire_runs(spark, root, keep=1, min_age_seconds=-60) == ["r4"]
    assert [n for n, _ in store.list("runs")] == ["r3"] and runs.current_run(spark, root) == "r3"
    with pytest.raises(ValueError):
        runs.expire_runs(spark, root, keep=0)


def orders_by_month(gold_tables):
    fct = gold_tables["gold_fct_orders"]
    undated = fct.limit(1).withColumns({"order_id": F.lit("undated"), "purchase_year_month": F.lit(None).cast("string")})
    return fct.unionByName(undated)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_layout_prunes_and_keeps_rows_without_month(spark, gold_tables):
    path = scratch_path(spark, "months")
    writers.write_table(writers.laid_out(writers.conform_types(orders_by_month(gold_tables), "gold_fct_orders"), "gold_fct_orders"), path, "gold_fct_orders")
    two = writers.read_months(spark, path, "gold_fct_orders", ["2022-01", None])
    assert two.columns == schemas.columns("gold_fct_orders")
    assert {r["order_id"] for r in two.collect()} == {"order_001", "order_002", "order_004", "undated"}
    plan = plan_of(two)
    assert "PartitionFilters: [" in plan and "purchase_year_month" in plan.split("PartitionFilters:")[1].split("]")[0]
    read = two.select(F.input_file_name().alias("f")).distinct().collect()
    assert all("purchase_year_month=2022-01" in r["f"] or "__HIVE_DEFAULT_PARTITION__" in r["f"] for r in read)


def test_replacing_a_month_leaves_the_others(spark, gold_tables):
    path, table = scratch_path(spark, "replace"), "gold_fct_orders"
    fct = writers.conform_types(orders_by_month(gold_tables), table)
    writers.write_table(writers.laid_out(fct, table), path, table)
    changed = fct.where("purchase_year_month = '2022-02'").withColumn("order_status", F.lit("delivered"))
    writers.replace_months(changed, path, table)
    got = {r["order_id"]: r["order_status"] for r in spark.read.schema(schemas.TABLES[table]).parquet(path).collect()}
    assert len(got) == 5 and got["order_003"] == "delivered" and got["order_001"] == "delivered" and "undated" in got
    with pytest.raises(ValueError):
        writers.write_table(fct, path, "gold_dim_sellers", mode="months")
