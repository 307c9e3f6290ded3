"""Declarative catalogue of the layered model.

One place holds every table of the three layers: column names and order, Spark
types, NOT NULL, primary keys, foreign keys, UNSIGNED columns and string length
limits. Readers, writers and quality checks are all driven from here, so the
model is declared once.

Column metadata (a public ``StructField`` feature) carries the two SQL domain
rules Spark types cannot express: ``max_length`` (CHAR/VARCHAR) and
``unsigned``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column constructors
# ---------------------------------------------------------------------------


def _field(name: str, dtype: T.DataType, nullable: bool = True, max_length: int | None = None,
           unsigned: bool = False) -> T.StructField:
    meta: dict = {}
    if max_length is not None:
        meta["max_length"] = max_length
    if unsigned:
        meta["unsigned"] = True
    return T.StructField(name, dtype, nullable, meta)


def key(name: str, nullable: bool = False) -> T.StructField:
    """A CHAR(32) identifier."""
    return _field(name, T.StringType(), nullable, max_length=32)


def text(name: str, max_length: int | None = None, nullable: bool = True) -> T.StructField:
    return _field(name, T.StringType(), nullable, max_length=max_length)


def integer(name: str, unsigned: bool = False, nullable: bool = True) -> T.StructField:
    return _field(name, T.IntegerType(), nullable, unsigned=unsigned)


def count(name: str) -> T.StructField:
    """An aggregate count (INT UNSIGNED in the sink, 64-bit in Spark)."""
    return _field(name, T.LongType(), True, unsigned=True)


def decimal(name: str, precision: int, scale: int, nullable: bool = True,
            unsigned: bool = False) -> T.StructField:
    return _field(name, T.DecimalType(precision, scale), nullable, unsigned=unsigned)


def timestamp(name: str) -> T.StructField:
    return _field(name, T.TimestampNTZType(), True)


def boolean(name: str) -> T.StructField:
    return _field(name, T.BooleanType(), True)


def money(name: str, nullable: bool = True) -> T.StructField:
    return decimal(name, 14, 2, nullable)


def money_sum(name: str) -> T.StructField:
    """A sum of money: wider than one value, so that no total can overflow the sink type."""
    return decimal(name, 38, 2)


def days(name: str) -> T.StructField:
    return decimal(name, 12, 4)


def coordinate(name: str) -> T.StructField:
    return decimal(name, 10, 7)


# Working (pre-sink) numeric types used inside the Gold computation.
MONEY = T.DecimalType(14, 2)         # one price / freight / payment value
MONEY_SUM = T.DecimalType(18, 2)     # a sum of money; 18 digits keep it in a long
COORDINATE = T.DecimalType(10, 7)
MICROS_PER_DAY = 86_400_000_000.0

# ---------------------------------------------------------------------------
# Source and Bronze tables (fixed values from the source DDL)
# ---------------------------------------------------------------------------

ORDER_TIMESTAMPS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]

BRONZE = {
    "bronze_customers": T.StructType([
        key("customer_id"),
        key("customer_unique_id"),
        integer("customer_zip_code_prefix", unsigned=True),
        text("customer_city", 100),
        text("customer_state", 2),
    ]),
    "bronze_geolocation": T.StructType([
        integer("geolocation_zip_code_prefix", unsigned=True),
        coordinate("geolocation_lat"),
        coordinate("geolocation_lng"),
        text("geolocation_city", 100),
        text("geolocation_state", 2),
    ]),
    "bronze_orders": T.StructType([
        key("order_id"),
        key("customer_id"),
        text("order_status", 32),
        *[timestamp(c) for c in ORDER_TIMESTAMPS],
    ]),
    "bronze_order_items": T.StructType([
        key("order_id"),
        integer("order_item_id", unsigned=True, nullable=False),
        key("product_id"),
        key("seller_id"),
        timestamp("shipping_limit_date"),
        money("price", nullable=False),
        money("freight_value", nullable=False),
    ]),
    "bronze_order_payments": T.StructType([
        key("order_id"),
        integer("payment_sequential", unsigned=True, nullable=False),
        text("payment_type", 32),
        integer("payment_installments", unsigned=True),
        money("payment_value", nullable=False),
    ]),
    "bronze_order_reviews": T.StructType([
        key("review_id"),
        key("order_id"),
        integer("review_score", unsigned=True),
        text("review_comment_title", 255),
        text("review_comment_message"),
        timestamp("review_creation_date"),
        timestamp("review_answer_timestamp"),
    ]),
    "bronze_products": T.StructType([
        key("product_id"),
        text("product_category_name", 150),
        integer("product_name_lenght"),
        integer("product_description_lenght"),
        integer("product_photos_qty"),
        integer("product_weight_g"),
        integer("product_length_cm"),
        integer("product_height_cm"),
        integer("product_width_cm"),
    ]),
    "bronze_sellers": T.StructType([
        key("seller_id"),
        integer("seller_zip_code_prefix", unsigned=True),
        text("seller_city", 100),
        text("seller_state", 2),
    ]),
    "bronze_translation": T.StructType([
        text("product_category_name", 150, nullable=False),
        text("product_category_name_english", 150),
    ]),
}

SOURCE_NAMES = [name.removeprefix("bronze_") for name in BRONZE]

# Raw text schemas used when a source arrives as CSV/JSON: timestamps stay text
# until coerced (unparseable -> NULL), numbers are read as the loose types a
# text reader produces (money and coordinates as double). Integer columns are
# read as double too, because exports write integers with gaps as "12.0";
# ``restore_integers`` casts them back.
_RAW_OVERRIDES = {"price": T.DoubleType(), "freight_value": T.DoubleType(),
                  "payment_value": T.DoubleType(), "geolocation_lat": T.DoubleType(),
                  "geolocation_lng": T.DoubleType()}


def raw_schema(source: str) -> T.StructType:
    """Schema to read a landed source file with (no inference)."""
    fields = []
    for f in BRONZE[f"bronze_{source}"].fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            dtype: T.DataType = T.StringType()
        elif isinstance(f.dataType, T.IntegerType):
            dtype = T.DoubleType()
        else:
            dtype = _RAW_OVERRIDES.get(f.name, f.dataType)
        fields.append(T.StructField(f.name, dtype, True))
    return T.StructType(fields)


INTEGER_COLUMNS = {
    source: [f.name for f in BRONZE[f"bronze_{source}"].fields
             if isinstance(f.dataType, T.IntegerType)]
    for source in SOURCE_NAMES
}

TIMESTAMP_COLUMNS = {
    source: [f.name for f in BRONZE[f"bronze_{source}"].fields
             if isinstance(f.dataType, T.TimestampNTZType)]
    for source in SOURCE_NAMES
}

# ---------------------------------------------------------------------------
# Silver tables
# ---------------------------------------------------------------------------

SILVER = {
    "silver_geolocations": T.StructType([
        integer("zip_code_prefix", unsigned=True, nullable=False),
        text("city", 100),
        text("state", 2),
        coordinate("latitude"),
        coordinate("longitude"),
    ]),
    "silver_product_categories": BRONZE["bronze_translation"],
    "silver_customers": BRONZE["bronze_customers"],
    "silver_sellers": BRONZE["bronze_sellers"],
    "silver_products": BRONZE["bronze_products"],
    "silver_orders": BRONZE["bronze_orders"],
    "silver_order_items": BRONZE["bronze_order_items"],
    "silver_order_payments": BRONZE["bronze_order_payments"],
    "silver_order_reviews": BRONZE["bronze_order_reviews"],
}

# ---------------------------------------------------------------------------
# Gold tables
# ---------------------------------------------------------------------------


def _geo_columns(prefix: str) -> list[T.StructField]:
    return [coordinate(f"{prefix}_lat"), coordinate(f"{prefix}_lng"),
            text(f"{prefix}_geo_city", 100), text(f"{prefix}_geo_state", 2)]


GOLD = {
    "gold_dim_customers": T.StructType(
        SILVER["silver_customers"].fields + _geo_columns("customer")),
    "gold_dim_products": T.StructType(
        SILVER["silver_products"].fields + [text("product_category_name_english", 150)]),
    "gold_dim_sellers": T.StructType(
        SILVER["silver_sellers"].fields + _geo_columns("seller")),
    "gold_fct_orders": T.StructType([
        *SILVER["silver_orders"].fields,
        count("items_count"),
        count("products_count"),
        count("sellers_count"),
        money_sum("items_value"),
        money_sum("freight_value"),
        money_sum("order_total_value"),
        money_sum("payment_value_total"),
        integer("payment_sequential_max", unsigned=True),
        integer("payment_installments_max", unsigned=True),
        decimal("payment_installments_mean", 12, 4),
        count("payment_types_nunique"),
        text("payment_type_main", 32),
        count("review_count"),
        decimal("review_score_mean", 6, 4),
        integer("review_score_min", unsigned=True),
        integer("review_score_max", unsigned=True),
        boolean("has_review_comment"),
        days("approve_hours"),
        days("delivery_days"),
        days("carrier_to_customer_days"),
        days("estimated_delivery_days"),
        days("delivery_delay_days"),
        boolean("is_delivered_late"),
        integer("purchase_year", unsigned=True),
        integer("purchase_month", unsigned=True),
        text("purchase_year_month", 7),
    ]),
    "gold_fct_order_items": T.StructType([
        *SILVER["silver_order_items"].fields,
        money("item_total_value", nullable=False),
        key("customer_id"),
        text("order_status", 32),
        timestamp("order_purchase_timestamp"),
        timestamp("order_delivered_carrier_date"),
        timestamp("order_delivered_customer_date"),
        timestamp("order_estimated_delivery_date"),
        integer("purchase_year", unsigned=True),
        integer("purchase_month", unsigned=True),
        text("purchase_year_month", 7),
        days("delivery_days"),
        days("delivery_delay_days"),
        boolean("is_delivered_late"),
        days("shipping_accuracy_days"),
    ]),
    "gold_agg_sales_monthly": T.StructType([
        integer("purchase_year", unsigned=True, nullable=False),
        integer("purchase_month", unsigned=True, nullable=False),
        text("purchase_year_month", 7, nullable=False),
        count("orders_count"),
        count("customers_count"),
        money_sum("revenue_total"),
        money_sum("payment_total"),
        money_sum("freight_total"),
        money("avg_ticket"),
        money("avg_freight"),
        days("avg_delivery_days"),
        decimal("avg_review_score", 6, 4),
        count("delivered_orders"),
        count("late_orders"),
        decimal("otd_rate", 8, 6),
    ]),
}

LAYERS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}
TABLES = {**BRONZE, **SILVER, **GOLD}

# Dependency order for loading (and, reversed, for clearing).
BRONZE_ORDER = list(BRONZE)
SILVER_ORDER = list(SILVER)
GOLD_ORDER = ["gold_dim_customers", "gold_dim_products", "gold_dim_sellers",
              "gold_fct_orders", "gold_fct_order_items", "gold_agg_sales_monthly"]
LOAD_ORDER = BRONZE_ORDER + SILVER_ORDER + GOLD_ORDER

# Tables laid out by purchase month, so that reads of some months skip the others' files.
PARTITIONED = {"gold_fct_orders": "purchase_year_month", "gold_fct_order_items": "purchase_year_month"}

# The tables that a Silver or Gold table is made from.
INPUTS = {
    "silver_geolocations": ["bronze_geolocation"],
    "silver_product_categories": ["bronze_translation"],
    **{f"silver_{s}": [f"bronze_{s}"] for s in ("customers", "sellers", "products", "orders", "order_items",
                                               "order_payments", "order_reviews")},
    "gold_dim_customers": ["silver_customers", "silver_geolocations"],
    "gold_dim_products": ["silver_products", "silver_product_categories"],
    "gold_dim_sellers": ["silver_sellers", "silver_geolocations"],
    **{t: ["silver_orders", "silver_order_items", "silver_order_payments", "silver_order_reviews"]
       for t in ("gold_fct_orders", "gold_fct_order_items", "gold_agg_sales_monthly")},
}


def layer_of(table: str) -> str:
    return table.split("_", 1)[0]


# ---------------------------------------------------------------------------
# Keys (fixed values from the sink DDL)
# ---------------------------------------------------------------------------

_SOURCE_KEYS = {
    "customers": ["customer_id"],
    "geolocation": [],  # surrogate key only in the sink
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id", "order_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "translation": ["product_category_name"],
}

PRIMARY_KEYS: dict[str, list[str]] = {
    **{f"bronze_{s}": k for s, k in _SOURCE_KEYS.items() if k},
    "silver_geolocations": ["zip_code_prefix"],
    "silver_product_categories": ["product_category_name"],
    **{f"silver_{s}": k for s, k in _SOURCE_KEYS.items()
       if k and s not in ("geolocation", "translation")},
    "gold_dim_customers": ["customer_id"],
    "gold_dim_products": ["product_id"],
    "gold_dim_sellers": ["seller_id"],
    "gold_fct_orders": ["order_id"],
    "gold_fct_order_items": ["order_id", "order_item_id"],
    "gold_agg_sales_monthly": ["purchase_year_month"],
}

# (child table, child column, parent table, parent column): the 13 DDL constraints.
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("silver_customers", "customer_zip_code_prefix", "silver_geolocations", "zip_code_prefix"),
    ("silver_sellers", "seller_zip_code_prefix", "silver_geolocations", "zip_code_prefix"),
    ("silver_products", "product_category_name", "silver_product_categories", "product_category_name"),
    ("silver_orders", "customer_id", "silver_customers", "customer_id"),
    ("silver_order_items", "order_id", "silver_orders", "order_id"),
    ("silver_order_items", "product_id", "silver_products", "product_id"),
    ("silver_order_items", "seller_id", "silver_sellers", "seller_id"),
    ("silver_order_payments", "order_id", "silver_orders", "order_id"),
    ("silver_order_reviews", "order_id", "silver_orders", "order_id"),
    ("gold_fct_orders", "customer_id", "gold_dim_customers", "customer_id"),
    ("gold_fct_order_items", "customer_id", "gold_dim_customers", "customer_id"),
    ("gold_fct_order_items", "product_id", "gold_dim_products", "product_id"),
    ("gold_fct_order_items", "seller_id", "gold_dim_sellers", "seller_id"),
]

# Business relationships between the source tables (child -> parent), fixed values.
RELATIONSHIPS: dict[str, dict[str, tuple[str, str]]] = {
    "orders": {"customer_id": ("customers", "customer_id")},
    "order_items": {
        "order_id": ("orders", "order_id"),
        "product_id": ("products", "product_id"),
        "seller_id": ("sellers", "seller_id"),
    },
    "order_payments": {"order_id": ("orders", "order_id")},
    "order_reviews": {"order_id": ("orders", "order_id")},
    "products": {"product_category_name": ("translation", "product_category_name")},
    "customers": {"customer_zip_code_prefix": ("geolocation", "geolocation_zip_code_prefix")},
    "sellers": {"seller_zip_code_prefix": ("geolocation", "geolocation_zip_code_prefix")},
}


def not_null_columns(table: str) -> list[str]:
    return [f.name for f in TABLES[table].fields if not f.nullable]


def unsigned_columns(table: str) -> list[str]:
    return [f.name for f in TABLES[table].fields if f.metadata.get("unsigned")]


def length_limits(table: str) -> dict[str, int]:
    return {f.name: f.metadata["max_length"] for f in TABLES[table].fields
            if "max_length" in f.metadata}


def columns(table: str) -> list[str]:
    return TABLES[table].fieldNames()
