"""Shared Spark session and the small source fixtures (values in FIXTURES.md)."""

from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="ledgerline-test-ckpt-")
    session = get_session("local[4]", app_name="ledgerline-tests", shuffle_partitions=4,
                          extra_conf={"spark.checkpoint.dir": ckpt})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text: str | None) -> dt.datetime | None:
    if text is None:
        return None
    return dt.datetime.fromisoformat(text)


ORDERS_DDL = ("order_id string, customer_id string, order_status string, "
              "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
              "order_delivered_carrier_date timestamp_ntz, "
              "order_delivered_customer_date timestamp_ntz, "
              "order_estimated_delivery_date timestamp_ntz")


@pytest.fixture(scope="session")
def raw_tables(spark):
    orders = spark.createDataFrame([
        ("order_001", "cust_001", "delivered", ts("2022-01-01 10:00:00"), ts("2022-01-01 10:30:00"),
         ts("2022-01-03 08:00:00"), ts("2022-01-10 15:00:00"), ts("2022-01-15 00:00:00")),
        ("order_002", "cust_002", "delivered", ts("2022-01-05 14:00:00"), ts("2022-01-05 14:45:00"),
         ts("2022-01-07 12:00:00"), ts("2022-01-25 10:00:00"), ts("2022-01-20 00:00:00")),
        ("order_003", "cust_003", "shipped", ts("2022-02-01 09:00:00"), ts("2022-02-01 09:30:00"),
         None, None, ts("2022-02-20 00:00:00")),
        ("order_004", "cust_004", "delivered", ts("2022-01-15 11:00:00"), ts("2022-01-15 11:15:00"),
         ts("2022-01-17 10:00:00"), ts("2022-01-22 14:00:00"), ts("2022-01-25 00:00:00")),
    ], ORDERS_DDL)
    order_items = spark.createDataFrame([
        ("order_001", 1, "prod_A", "seller_1", ts("2022-01-04 00:00:00"), 100.0, 10.0),
        ("order_001", 2, "prod_B", "seller_2", ts("2022-01-04 00:00:00"), 50.0, 5.0),
        ("order_002", 1, "prod_C", "seller_1", ts("2022-01-08 00:00:00"), 200.0, 20.0),
        ("order_003", 1, "prod_D", "seller_3", ts("2022-02-05 00:00:00"), 80.0, 15.0),
        ("order_004", 1, "prod_A", "seller_2", ts("2022-01-18 00:00:00"), 120.0, 12.0),
    ], "order_id string, order_item_id int, product_id string, seller_id string, "
       "shipping_limit_date timestamp_ntz, price double, freight_value double")
    order_payments = spark.createDataFrame([
        ("order_001", 1, "credit_card", 3, 115.0),
        ("order_002", 1, "boleto", 1, 180.0),
        ("order_002", 2, "voucher", 1, 40.0),
        ("order_003", 1, "credit_card", 2, 95.0),
        ("order_004", 1, "debit_card", 1, 132.0),
    ], "order_id string, payment_sequential int, payment_type string, "
       "payment_installments int, payment_value double")
    order_reviews = spark.createDataFrame([
        ("rev_001", "order_001", 5, "Otimo!", "Chegou rapido", ts("2022-01-11 00:00:00"),
         ts("2022-01-12 00:00:00")),
        ("rev_002", "order_002", 2, None, "Atrasou muito", ts("2022-01-26 00:00:00"),
         ts("2022-01-27 00:00:00")),
        ("rev_004", "order_004", 4, None, None, ts("2022-01-23 00:00:00"),
         ts("2022-01-24 00:00:00")),
    ], "review_id string, order_id string, review_score int, review_comment_title string, "
       "review_comment_message string, review_creation_date timestamp_ntz, "
       "review_answer_timestamp timestamp_ntz")
    customers = spark.createDataFrame([
        ("cust_001", "uniq_001", 1310, "Sao Paulo", "SP"),
        ("cust_002", "uniq_002", 4520, "Sao Paulo", "SP"),
        ("cust_003", "uniq_003", 6700, "Rio de Janeiro", "RJ"),
        ("cust_004", "uniq_004", 9000, "Porto Alegre", "RS"),
    ], "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
       "customer_city string, customer_state string")
    sellers = spark.createDataFrame([
        ("seller_1", 1310, "Sao Paulo", "SP"),
        ("seller_2", 4520, "Sao Paulo", "SP"),
        ("seller_3", 6700, "Rio de Janeiro", "RJ"),
    ], "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string")
    products = spark.createDataFrame([
        ("prod_A", "eletronicos", 20, 100, 3, 500, 30, 10, 20),
        ("prod_B", "livros", 15, 80, 1, 200, 20, 5, 15),
        ("prod_C", "eletronicos", 18, 90, 2, 800, 35, 12, 25),
        ("prod_D", "esporte", 12, 60, 2, 300, 25, 8, 18),
    ], "product_id string, product_category_name string, product_name_lenght int, "
       "product_description_lenght int, product_photos_qty int, product_weight_g int, "
       "product_length_cm int, product_height_cm int, product_width_cm int")
    translation = spark.createDataFrame([
        ("eletronicos", "electronics"), ("livros", "books"), ("esporte", "sports"),
    ], "product_category_name string, product_category_name_english string")
    geolocation = spark.createDataFrame([
        (1310, -23.5, -46.6, "sao paulo", "SP"),
        (1310, -23.52, -46.62, "sao paulo", "SP"),
        (4520, -23.6, -46.7, "sao paulo", "SP"),
        (6700, -22.9, -43.2, "rio de janeiro", "RJ"),
        (9000, -30.0, -51.2, "porto alegre", "RS"),
    ], "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
       "geolocation_city string, geolocation_state string")
    return {
        "orders": orders, "order_items": order_items, "order_payments": order_payments,
        "order_reviews": order_reviews, "customers": customers, "sellers": sellers,
        "products": products, "translation": translation, "geolocation": geolocation,
    }


@pytest.fixture(scope="session")
def gold_tables(raw_tables):
    from ledgerline.plans.build import build_gold

    return build_gold(raw_tables)


def rows_by(df, key: str) -> dict:
    return {r[key]: r for r in df.collect()}
