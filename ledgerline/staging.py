"""Project the driver's test tables onto the nine source tables of the model.

The test data has another schema (TPC-H-like tables plus events, documents and
labels), so it is mapped once here and Bronze/Silver/Gold run unchanged on top.
Every source is a lazy projection of the parquet tables: only the columns used
are read and all filters reach the scan.

Mapping (source column = test expression):

* orders: order_id = o_orderkey, customer_id = o_custkey, status = o_orderstatus,
  purchase = o_orderdate, approved = o_orderdate + (o_orderkey % 48) hours,
  carrier = min(l_shipdate), delivered = max(l_shipdate) of the order's lines,
  estimated = o_orderdate + 30 days
* order_items: lineitem (order, line number, part, supplier, ship date,
  extended price as price, quantity as freight)
* order_payments: events, three per order (order = event_id div 3,
  sequential = event_id % 3 + 1), type = event_type, installments = props.k
* order_reviews: labels joined to documents, order = doc_id div 2
* customers / sellers / products: customer / supplier / part
* geolocation: one row per customer (zip = nation, coordinates from the
  account balance); nation 24 is left out and every 50th customer has no zip,
  so lookups can miss
* translation: the distinct part types except PROMO, English name lower-cased

Money stays double here (Silver rounds it) and keys stay 64-bit integers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.tables import LazyTables

# Fixed values of the mapping.
GEO_MISSING_NATION = 24          # nation whose zip has no geolocation rows
GEO_NULL_ZIP_EVERY = 50          # every n-th customer's geolocation row has no zip
UNTRANSLATED_CATEGORY = "PROMO"  # part type without a translation row
PAYMENTS_PER_ORDER = 3
NULL_PAYMENT_TYPE = "error"      # event type mapped to a NULL payment type in the NULL-tie variant


# Schemas of the test tables (fixed values; only the columns used are listed,
# so the reader never infers a schema and never touches other columns).
TEST_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_type string, p_size int",
    "events": "event_id bigint, event_type string, value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
    "documents": "doc_id bigint, lang string, source string",
}


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table read with its declared columns (no schema inference); the
    projections applied afterwards prune the scan further."""
    return spark.read.schema(TEST_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_test_table(spark, sf_dir, "orders")
    ship = (read_test_table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(F.min("l_shipdate").alias("carrier"), F.max("l_shipdate").alias("delivered")))
    joined = orders.join(ship, orders.o_orderkey == ship.l_orderkey, "left")
    return joined.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.timestamp_add("HOUR", F.col("o_orderkey") % 48, F.col("o_orderdate"))
        .alias("order_approved_at"),
        F.col("carrier").alias("order_delivered_carrier_date"),
        F.col("delivered").alias("order_delivered_customer_date"),
        F.timestamp_add("DAY", F.lit(30), F.col("o_orderdate"))
        .alias("order_estimated_delivery_date"),
    )


def stage_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_test_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
    )


def stage_order_payments(spark: SparkSession, sf_dir: str, null_type: bool = False) -> DataFrame:
    events = read_test_table(spark, sf_dir, "events")
    ptype = F.col("event_type")
    if null_type:
        ptype = F.when(ptype != F.lit(NULL_PAYMENT_TYPE), ptype)
    return events.select(
        F.expr(f"event_id div {PAYMENTS_PER_ORDER}").alias("order_id"),
        (F.col("event_id") % PAYMENTS_PER_ORDER + 1).cast("int").alias("payment_sequential"),
        ptype.alias("payment_type"),
        F.get_json_object("props", "$.k").cast("int").alias("payment_installments"),
        F.col("value").alias("payment_value"),
    )


def stage_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_test_table(spark, sf_dir, "labels")
    docs = read_test_table(spark, sf_dir, "documents")
    joined = labels.join(docs, "doc_id", "inner")
    return joined.select(
        F.col("doc_id").alias("review_id"),
        F.expr("doc_id div 2").alias("order_id"),
        (F.lit(1) + F.col("quality") * 4 - F.col("toxic") * F.col("quality"))
        .alias("review_score"),
        F.when(F.col("toxic") == 1, F.col("source")).alias("review_comment_title"),
        F.when(F.col("quality") == 1, F.col("lang")).alias("review_comment_message"),
        F.lit(None).cast("timestamp_ntz").alias("review_creation_date"),
        F.lit(None).cast("timestamp_ntz").alias("review_answer_timestamp"),
    )


def stage_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_test_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.lit(None).cast("string").alias("customer_state"),
    )


def stage_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_test_table(spark, sf_dir, "customer")
    return (customer
            .where(F.col("c_nationkey") != GEO_MISSING_NATION)
            .select(
                F.when(F.col("c_custkey") % GEO_NULL_ZIP_EVERY != 0, F.col("c_nationkey"))
                .alias("geolocation_zip_code_prefix"),
                (F.col("c_acctbal") / 100).alias("geolocation_lat"),
                (-F.col("c_acctbal") / 100).alias("geolocation_lng"),
                F.col("c_mktsegment").alias("geolocation_city"),
                F.substring("c_mktsegment", 1, 2).alias("geolocation_state"),
            ))


def stage_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return read_test_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        size.alias("product_name_lenght"),
        (size * 10).alias("product_description_lenght"),
        (size % 5 + 1).alias("product_photos_qty"),
        (size * 100).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (size + 1).alias("product_height_cm"),
        (size + 2).alias("product_width_cm"),
    )


def stage_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_test_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.lit(None).cast("string").alias("seller_state"),
    )


def stage_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read_test_table(spark, sf_dir, "part")
            .where(F.col("p_type") != UNTRANSLATED_CATEGORY)
            .select(F.col("p_type").alias("product_category_name"))
            .distinct()
            .select("product_category_name",
                    F.lower("product_category_name").alias("product_category_name_english")))


_STAGERS = {
    "customers": stage_customers,
    "geolocation": stage_geolocation,
    "orders": stage_orders,
    "order_items": stage_order_items,
    "order_payments": stage_order_payments,
    "order_reviews": stage_order_reviews,
    "products": stage_products,
    "sellers": stage_sellers,
    "translation": stage_translation,
}


def stage_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _STAGERS[name](spark, sf_dir)


def load_sources(spark: SparkSession, sf_dir: str) -> LazyTables:
    """The nine source tables, each built on first access (nothing is read
    until an action runs)."""
    return LazyTables({name: (lambda s=stager: s(spark, sf_dir)) for name, stager in _STAGERS.items()})
