"""Sinks: conform, catalog tables, published runs, JDBC options, views."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.session import SINK_CONF, scratch_path, shared_dir, sink_conf, to_local_path
from ledgerline.sinks import writers


def test_conform_columns_order_and_missing(raw_tables):
    orders = raw_tables["orders"]
    shuffled = orders.select(*reversed(orders.columns), F.lit(1).alias("extra"))
    assert writers.conform_columns(shuffled, "silver_orders").columns == schemas.columns(
        "silver_orders")
    with pytest.raises(ValueError):
        writers.conform_columns(orders.drop("order_status"), "silver_orders")


def test_conform_types(gold_tables):
    out = writers.conform_types(gold_tables["gold_fct_orders"], "gold_fct_orders")
    types = dict(out.dtypes)
    assert types["approve_hours"] == "decimal(12,4)"
    assert types["items_value"] == "decimal(38,2)"  # sums are wider than one value
    assert types["review_score_mean"] == "decimal(6,4)"
    r = {x.order_id: x for x in out.collect()}
    assert str(r["order_001"]["delivery_days"]) == "9.2083"


def test_create_layer_tables_is_idempotent(spark, gold_tables):
    root = scratch_path(spark, "catalog")
    first = writers.create_layer_tables(spark, root, "t_catalog")
    second = writers.create_layer_tables(spark, root, "t_catalog")
    assert first == second and len(first) == 24
    target = first["gold_agg_sales_monthly"]
    writers.insert_full_refresh(gold_tables["gold_agg_sales_monthly"], target,
                                "gold_agg_sales_monthly")
    writers.insert_full_refresh(gold_tables["gold_agg_sales_monthly"], target,
                                "gold_agg_sales_monthly")
    assert spark.table(target).count() == 2


def test_full_refresh_publishes_and_failed_run_keeps_previous(spark, raw_tables):
    root = scratch_path(spark, "published")
    gold = writers.full_refresh(spark, raw_tables, root, min_rows=1)
    first = writers.current_run(spark, root)
    assert gold["gold_fct_orders"].count() == 4
    counts = {r.table_name: r.row_count for r in writers.published_row_counts(spark, root).collect()}
    assert len(counts) == 24 and counts["silver_geolocations"] == 4
    assert counts["gold_agg_sales_monthly"] == 2
    with pytest.raises(ValueError):     # default floor of 1000 rows fails on 4 orders
        writers.full_refresh(spark, raw_tables, root)
    assert writers.current_run(spark, root) == first


def test_full_refresh_gold_matches_lazy_gold(spark, raw_tables, gold_tables):
    root = scratch_path(spark, "published_eq")
    gold = writers.full_refresh(spark, raw_tables, root, min_rows=1)
    lazy = writers.conform_types(gold_tables["gold_agg_sales_monthly"], "gold_agg_sales_monthly")
    assert sorted(gold["gold_agg_sales_monthly"].collect()) == sorted(lazy.collect())


def test_layer_subset_leaves_gold_empty(spark, raw_tables):
    root = scratch_path(spark, "subset")
    silver = writers.layer_subset_refresh(spark, raw_tables, root)
    assert set(silver) == {t.removeprefix("silver_") for t in schemas.SILVER_ORDER}
    counts = {r.table_name: r.row_count for r in writers.published_row_counts(spark, root).collect()}
    assert all(counts[t] == 0 for t in schemas.GOLD_ORDER)
    assert counts["bronze_orders"] == 4


def test_jdbc_options():
    opts = writers.jdbc_options("gold_fct_orders", batch_size=500, num_partitions=4)
    assert opts == {"dbtable": "gold_fct_orders", "batchsize": "500", "truncate": "true",
                    "numPartitions": "4"}


def test_register_views(spark, raw_tables):
    from ledgerline.operators.silver import build_silver

    names = writers.register_views(build_silver(raw_tables), strip="silver_")
    assert "orders" in names
    assert spark.sql("SELECT COUNT(*) AS n FROM orders").first().n == 4


def test_shuffle_partitions_sized_from_input(spark):
    from ledgerline.session import input_bytes, size_shuffle_partitions

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        size = input_bytes(spark, ["/root/testdata/sf0.01/lineitem.parquet"])
        assert size > 0
        cores = spark.sparkContext.defaultParallelism
        assert size_shuffle_partitions(spark, size) == cores * 2          # small input
        assert size_shuffle_partitions(spark, 100 << 40) == 100_000        # 100 TB, capped
        assert size_shuffle_partitions(spark, 10 << 30) == 40               # 10 GiB / 256 MiB
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_latest_publish_wins_and_old_runs_stay_readable(spark, raw_tables):
    root = scratch_path(spark, "republish")
    writers.layer_subset_refresh(spark, raw_tables, root, run_id="run_a")
    writers.layer_subset_refresh(spark, raw_tables, root, run_id="run_b")
    assert writers.current_run(spark, root) == "run_b"
    assert writers.read_published(spark, root, "silver_orders", "run_a").count() == 4
    with pytest.raises(FileNotFoundError):
        writers.current_run(spark, scratch_path(spark, "never_published"))


@pytest.mark.parametrize("column, value, said", [
    ("customer_state", "SPX", r"\[silver_customers\] customer_state is longer than 2: SPX"),
    ("customer_id", None, r"\[silver_customers\] customer_id is null"),
    ("customer_zip_code_prefix", -1, r"\[silver_customers\] customer_zip_code_prefix is negative: -1")])
def test_enforced_load_names_table_column_and_value(raw_tables, column, value, said):
    customers = raw_tables["customers"]
    assert writers.enforced(customers, "silver_customers").count() == 4
    bad = customers.withColumn(column, F.when(F.col("customer_id") == "cust_003", F.lit(value)).otherwise(F.col(column)))
    with pytest.raises(Exception, match=said):
        writers.enforced(bad, "silver_customers").collect()


def test_catalog_declares_lengths_and_refuses_bad_rows(spark, raw_tables):
    created = writers.create_layer_tables(spark, scratch_path(spark, "enforced"), "t_enforced")
    target = created["silver_customers"]
    assert "varchar(2)" in {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE {target}").collect()}["customer_state"]
    writers.insert_full_refresh(raw_tables["customers"], target, "silver_customers")
    with pytest.raises(Exception, match="customer_state is longer than 2"):
        writers.insert_full_refresh(raw_tables["customers"].withColumn("customer_state", F.lit("long")), target, "silver_customers")
    assert spark.table(target).count() == 4  # the earlier contents stay


def test_catalog_load_keeps_one_copy_of_the_rows(spark, raw_tables):
    root = scratch_path(spark, "one_copy")
    target = writers.create_layer_tables(spark, root, "t_one_copy")["silver_customers"]
    before = set(_files(f"{shared_dir(spark)}/ledgerline-scratch"))
    for state in ("SP", "RJ"):
        writers.insert_full_refresh(raw_tables["customers"].withColumn("customer_state", F.lit(state)), target, "silver_customers")
        assert {r.customer_state for r in spark.table(target).collect()} == {state}
    with pytest.raises(Exception, match="customer_state is longer than 2"):
        writers.insert_full_refresh(raw_tables["customers"].withColumn("customer_state", F.lit("long")), target, "silver_customers")
    assert {r.customer_state for r in spark.table(target).collect()} == {"RJ"}
    kept = set(spark.table(target).inputFiles())
    assert {to_local_path(k) for k in kept} == set(_files(f"{shared_dir(spark)}/ledgerline-scratch")) - before
    spark.sql(f"DROP TABLE {target}")
    assert not set(_files(f"{shared_dir(spark)}/ledgerline-scratch")) - before


def _files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(to_local_path(path)) for f in names if f.endswith(".parquet")]


def test_sinks_leave_no_shuffle_files_and_set_the_session_back(spark, raw_tables):
    before = {k: spark.conf.get(k, None) for k in SINK_CONF}
    with pytest.raises(ValueError):  # the floor of 1000 rows fails
        writers.full_refresh(spark, raw_tables, scratch_path(spark, "refused"))
    assert {k: spark.conf.get(k, None) for k in SINK_CONF} == before
    with sink_conf(spark):
        assert {k: spark.conf.get(k) for k in SINK_CONF} == SINK_CONF
        earlier = _shuffle_files(spark)
        spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count().write.parquet(scratch_path(spark, "no_shuffle_left"))
        for _ in range(50):  # they are deleted in the background
            if not _shuffle_files(spark) - earlier:
                break
            time.sleep(0.2)
        assert not _shuffle_files(spark) - earlier


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}
