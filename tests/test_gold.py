"""Gold layer on the small fixtures: facts, monthly aggregate, dimensions."""

from __future__ import annotations

from decimal import Decimal

import pytest

from tests.conftest import rows_by


@pytest.fixture(scope="module")
def orders(gold_tables):
    return rows_by(gold_tables["gold_fct_orders"], "order_id")


@pytest.fixture(scope="module")
def monthly(gold_tables):
    return rows_by(gold_tables["gold_agg_sales_monthly"], "purchase_year_month")


def test_six_gold_tables(gold_tables):
    assert set(gold_tables) == {"gold_dim_customers", "gold_dim_products", "gold_dim_sellers",
                                "gold_fct_orders", "gold_fct_order_items",
                                "gold_agg_sales_monthly"}


def test_order_count(orders):
    assert len(orders) == 4


def test_late_flag_three_valued(orders):
    assert orders["order_001"]["is_delivered_late"] is False
    assert orders["order_002"]["is_delivered_late"] is True
    assert orders["order_003"]["is_delivered_late"] is None
    assert orders["order_004"]["is_delivered_late"] is False


def test_durations(orders):
    expected = {
        "order_001": (0.5, 9.208333, 7.291667, 13.583333, -4.375),
        "order_002": (0.75, 19.833333, 17.916667, 14.416667, 5.416667),
        "order_004": (0.25, 7.125, 5.166667, 9.541667, -2.416667),
    }
    for oid, (approve, delivery, carrier, estimated, delay) in expected.items():
        r = orders[oid]
        assert r["approve_hours"] == pytest.approx(approve, abs=1e-6)
        assert r["delivery_days"] == pytest.approx(delivery, abs=1e-6)
        assert r["carrier_to_customer_days"] == pytest.approx(carrier, abs=1e-6)
        assert r["estimated_delivery_days"] == pytest.approx(estimated, abs=1e-6)
        assert r["delivery_delay_days"] == pytest.approx(delay, abs=1e-6)
    open_order = orders["order_003"]
    assert open_order["delivery_days"] is None
    assert open_order["delivery_delay_days"] is None
    assert open_order["estimated_delivery_days"] == pytest.approx(18.625)
    assert open_order["approve_hours"] == pytest.approx(0.5)


def test_item_summary(orders):
    r = orders["order_001"]
    assert (r["items_count"], r["products_count"], r["sellers_count"]) == (2, 2, 2)
    assert r["items_value"] == Decimal("150.00")
    assert r["freight_value"] == Decimal("15.00")
    assert r["order_total_value"] == Decimal("165.00")
    assert orders["order_002"]["items_count"] == 1


def test_payment_summary(orders):
    r1, r2 = orders["order_001"], orders["order_002"]
    assert r1["payment_value_total"] == Decimal("115.00")
    assert r1["payment_installments_max"] == 3
    assert r1["payment_installments_mean"] == 3.0
    assert r1["payment_type_main"] == "credit_card"
    assert r2["payment_types_nunique"] == 2
    assert r2["payment_sequential_max"] == 2
    assert r2["payment_value_total"] == Decimal("220.00")
    # Tie of one payment each: the smallest type wins.
    assert r2["payment_type_main"] == "boleto"
    assert orders["order_004"]["payment_type_main"] == "debit_card"


def test_review_summary(orders):
    assert orders["order_001"]["review_score_mean"] == 5.0
    assert orders["order_001"]["has_review_comment"] is True
    assert orders["order_002"]["review_score_mean"] == 2.0
    assert orders["order_004"]["has_review_comment"] is False
    assert orders["order_003"]["review_score_mean"] is None
    assert orders["order_003"]["has_review_comment"] is None


def test_purchase_month(orders):
    for r in orders.values():
        assert len(r["purchase_year_month"]) == 7 and r["purchase_year_month"][4] == "-"
    assert orders["order_003"]["purchase_year_month"] == "2022-02"
    assert (orders["order_001"]["purchase_year"], orders["order_001"]["purchase_month"]) == (2022, 1)


def test_item_fact_shipping_accuracy(gold_tables):
    items = {(r["order_id"], r["order_item_id"]): r
             for r in gold_tables["gold_fct_order_items"].collect()}
    assert len(items) == 5
    assert items[("order_001", 1)]["shipping_accuracy_days"] == pytest.approx(0.666667, abs=1e-6)
    assert items[("order_002", 1)]["shipping_accuracy_days"] == pytest.approx(0.5)
    assert items[("order_003", 1)]["shipping_accuracy_days"] is None
    assert items[("order_004", 1)]["shipping_accuracy_days"] == pytest.approx(0.583333, abs=1e-6)
    assert items[("order_001", 2)]["item_total_value"] == Decimal("55.00")
    assert items[("order_001", 2)]["customer_id"] == "cust_001"


def test_monthly_january(monthly):
    jan = monthly["2022-01"]
    assert jan["orders_count"] == 3
    assert jan["customers_count"] == 3
    assert jan["revenue_total"] == Decimal("517.00")
    assert jan["payment_total"] == Decimal("467.00")
    assert jan["freight_total"] == Decimal("47.00")
    assert jan["avg_ticket"] == pytest.approx(172.333333, abs=1e-6)
    assert jan["avg_freight"] == pytest.approx(15.666667, abs=1e-6)
    assert jan["avg_delivery_days"] == pytest.approx(12.055556, abs=1e-6)
    assert jan["avg_review_score"] == pytest.approx(3.666667, abs=1e-6)
    assert (jan["delivered_orders"], jan["late_orders"]) == (3, 1)
    assert jan["otd_rate"] == pytest.approx(2 / 3)


def test_monthly_february_open_order(monthly):
    feb = monthly["2022-02"]
    assert feb["orders_count"] == 1
    assert feb["revenue_total"] == Decimal("95.00")
    assert feb["avg_delivery_days"] is None
    assert feb["avg_review_score"] is None
    assert (feb["delivered_orders"], feb["late_orders"]) == (0, 0)
    assert feb["otd_rate"] is None


def test_otd_in_unit_interval_and_revenue_positive(monthly):
    for r in monthly.values():
        assert r["otd_rate"] is None or 0 <= r["otd_rate"] <= 1
        assert r["revenue_total"] > 0


def test_dimensions(gold_tables):
    customers = rows_by(gold_tables["gold_dim_customers"], "customer_id")
    assert {"customer_lat", "customer_lng", "customer_geo_city", "customer_geo_state"} <= set(
        gold_tables["gold_dim_customers"].columns)
    assert customers["cust_001"]["customer_lat"] == Decimal("-23.5100000")
    assert customers["cust_001"]["customer_geo_city"] == "sao paulo"
    sellers = gold_tables["gold_dim_sellers"]
    assert {"seller_lat", "seller_lng"} <= set(sellers.columns)
    products = rows_by(gold_tables["gold_dim_products"], "product_id")
    assert products["prod_A"]["product_category_name_english"] == "electronics"
    assert products["prod_C"]["product_category_name_english"] == "electronics"


def test_column_order_matches_catalogue(gold_tables):
    from ledgerline import schemas

    for name, df in gold_tables.items():
        assert df.columns == schemas.columns(name)


def test_null_payment_type_can_win(spark):
    from ledgerline.operators import gold as G

    payments = spark.createDataFrame([
        ("o1", 1, None, 1, 10.0), ("o1", 2, "voucher", 1, 5.0),
        ("o2", 1, None, 1, 1.0), ("o2", 2, None, 1, 1.0), ("o2", 3, "boleto", 1, 1.0),
        ("o3", 1, "voucher", 2, 1.0), ("o3", 2, "boleto", 2, 1.0), ("o3", 3, "voucher", 2, 1.0),
    ], "order_id string, payment_sequential int, payment_type string, "
       "payment_installments int, payment_value double")
    main = rows_by(G.agg_payments(payments), "order_id")
    assert main["o1"]["payment_type_main"] is None      # tie 1-1: NULL sorts first
    assert main["o2"]["payment_type_main"] is None      # NULL has the higher count
    assert main["o3"]["payment_type_main"] == "voucher"  # highest count
    assert main["o1"]["payment_types_nunique"] == 1
    ranked = {(r["order_id"], r["payment_type"]): r["row_num"]
              for r in G.window_payment_rank(payments).collect()}
    assert ranked[("o1", None)] == 1 and ranked[("o1", "voucher")] == 2
    joined = G.join_ranked_condition(payments)
    assert joined.count() == payments.count()


def test_duplicate_category_fans_out(spark, raw_tables):
    from ledgerline.operators import gold as G

    dup = raw_tables["translation"].unionByName(spark.createDataFrame(
        [("livros", "books again")], raw_tables["translation"].schema))
    products = G.gold_dim_products({"products": raw_tables["products"],
                                    "product_categories": dup})
    assert products.count() == 5


def test_item_without_order_keeps_null_order_columns(spark, raw_tables):
    from ledgerline.operators import gold as G

    orphan = spark.createDataFrame(
        [("order_999", 1, "prod_A", "seller_1", None, 1.0, 1.0)], raw_tables["order_items"].schema)
    from ledgerline.operators.silver import silver_order_items

    items = silver_order_items(raw_tables["order_items"].unionByName(orphan))
    fact = rows_by(G.gold_fct_order_items({"order_items": items, "orders": raw_tables["orders"]}),
                   "order_id")
    assert fact["order_999"]["customer_id"] is None
    assert fact["order_999"]["purchase_year_month"] is None


def test_null_purchase_date_forms_its_own_month(spark, raw_tables):
    from ledgerline.operators import gold as G
    from ledgerline.plans.build import strip_layer
    from ledgerline.operators.silver import build_silver
    from pyspark.sql import functions as F

    tables = dict(raw_tables)
    tables["orders"] = raw_tables["orders"].withColumn(
        "order_purchase_timestamp",
        F.when(F.col("order_id") != "order_003", F.col("order_purchase_timestamp")))
    silver = strip_layer(build_silver(tables), "silver")
    monthly = G.gold_agg_sales_monthly(G.gold_fct_orders(silver)).collect()
    months = {r["purchase_year_month"] for r in monthly}
    assert months == {"2022-01", None}


def test_monthly_with_proven_unique_orders_matches_distinct(gold_tables):
    from ledgerline.operators import gold as G

    fct = gold_tables["gold_fct_orders"]
    a = sorted(G.gold_agg_sales_monthly(fct).collect())
    b = sorted(G.gold_agg_sales_monthly(fct, unique_order_ids=True).collect())
    assert a == b
