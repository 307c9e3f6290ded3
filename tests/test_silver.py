"""Bronze/Silver layer and the deterministic mode on the small fixtures."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.modes import mode_per_group
from ledgerline.operators.silver import build_bronze, build_silver
from tests.conftest import rows_by


@pytest.mark.parametrize("parts", [1, 5])
def test_mode_per_group(spark, parts):
    groups = {"one": ["x"], "most": ["b", "a", "b", "c", "b"], "tie": ["n", "m", "m", "n", "z"],
              "gaps": [None, "q", None, None], "none": [None, None]}
    rows = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k string, v string").repartition(parts)
    assert {r["k"]: r["m"] for r in mode_per_group(df, "k", "v", "m").collect()} == {
        "one": "x", "most": "b", "tie": "m", "gaps": "q", "none": None}
    assert mode_per_group(df.limit(0), "k", "v", "m").count() == 0


def test_silver_table_names(raw_tables):
    assert set(build_silver(raw_tables)) == {
        "silver_geolocations", "silver_product_categories", "silver_customers",
        "silver_sellers", "silver_products", "silver_orders", "silver_order_items",
        "silver_order_payments", "silver_order_reviews"}
    assert set(build_silver(raw_tables, strip_prefix=True)) == {
        "geolocations", "product_categories", "customers", "sellers", "products", "orders",
        "order_items", "order_payments", "order_reviews"}


def test_bronze_is_identity(raw_tables):
    bronze = build_bronze(raw_tables)
    assert set(bronze) == {f"bronze_{n}" for n in raw_tables}
    assert bronze["bronze_orders"].count() == 4


def test_geolocation_one_row_per_zip_with_mean_and_mode(raw_tables):
    geo = rows_by(build_silver(raw_tables)["silver_geolocations"], "zip_code_prefix")
    assert len(geo) == 4
    z = geo[1310]
    assert z["latitude"] == Decimal("-23.5100000")
    assert z["longitude"] == Decimal("-46.6100000")
    assert (z["city"], z["state"]) == ("sao paulo", "SP")


def test_geolocation_drops_null_zip(spark, raw_tables):
    extra = spark.createDataFrame([(None, 1.0, 1.0, "x", "XX")], raw_tables["geolocation"].schema)
    geo = build_silver({**raw_tables, "geolocation": raw_tables["geolocation"].unionByName(extra)})
    assert geo["silver_geolocations"].where(F.col("zip_code_prefix").isNull()).count() == 0


def test_money_rounded_to_two_places(spark, raw_tables):
    items = spark.createDataFrame(
        [("o", 1, "p", "s", None, 10.123, 2.005)], raw_tables["order_items"].schema)
    r = build_silver({**raw_tables, "order_items": items})["silver_order_items"].first()
    assert r["price"] == Decimal("10.12")
    assert r["freight_value"] == Decimal("2.01")   # half-up on the decimal value
    pay = build_silver(raw_tables)["silver_order_payments"]
    assert dict(pay.dtypes)["payment_value"] == "decimal(14,2)"


def test_row_counts_kept(raw_tables):
    silver = build_silver(raw_tables)
    assert silver["silver_orders"].count() == 4
    assert silver["silver_product_categories"].count() == 3
