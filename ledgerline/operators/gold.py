"""Gold star schema: per-order summaries, the order and item facts, three
dimensions and the monthly sales aggregate.

Plan shape (what Catalyst gets to optimise as one plan):

* the three per-order summaries (items, payments, reviews) each aggregate
  partial-then-final on ``order_id``; each is unique per order, so joining them
  to ``orders`` cannot fan out, and their outputs are already hash-partitioned
  on ``order_id`` - the three left joins reuse that partitioning, so ``orders``
  is shuffled once;
* the main payment type needs no window and no join back: payments are first
  combined per (order, type) and the winner is picked with ``min_by`` over an
  ordering struct while the per-order totals are finished in the same step;
* dimensions join lookup tables (one row per zip / category); AQE broadcasts them
  when their measured size is below the threshold; where they are too large for that,
  the rows of a hot zip or category are dealt out over several tasks.

Every input is a Silver table without the ``silver_`` prefix.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import (
    any_not_null,
    avg_micros_as_days,
    avg_money,
    avg_score,
    day_diff,
    guarded_ratio,
    hour_diff,
    late_flag,
    micros_between,
    month_part,
    round_money,
    sum_money,
    sum_totals,
    year_month_label,
    year_part,
)
from ledgerline.operators.joins import left_join_split
from ledgerline.schemas import columns
from ledgerline.tables import LazyTables

# ---------------------------------------------------------------------------
# Per-order summaries
# ---------------------------------------------------------------------------


def with_item_total(order_items: DataFrame) -> DataFrame:
    """All item rows with ``item_total_value = price + freight_value``."""
    return order_items.withColumn(
        "item_total_value", round_money(F.col("price") + F.col("freight_value")))


def agg_items(order_items: DataFrame) -> DataFrame:
    """Items per order: line count, distinct products/sellers, money sums."""
    items = with_item_total(order_items)
    return items.groupBy("order_id").agg(
        F.count("order_item_id").alias("items_count"),
        F.countDistinct("product_id").alias("products_count"),
        F.countDistinct("seller_id").alias("sellers_count"),
        sum_money("price").alias("items_value"),
        sum_money("freight_value").alias("freight_value"),
        sum_money("item_total_value").alias("order_total_value"),
    )


def agg_payment_type_counts(order_payments: DataFrame) -> DataFrame:
    """COUNT(*) per (order, payment type); a NULL type is its own group."""
    return order_payments.groupBy("order_id", "payment_type").agg(
        F.count(F.lit(1)).alias("payment_type_count"))


def window_payment_rank(order_payments: DataFrame) -> DataFrame:
    """Rank of each payment type inside its order (ROW_NUMBER form).

    Ordered by count descending, then type ascending with NULL first. The
    window shuffles the grouped rows again, by order: one row per (order, type),
    so a hot order costs its distinct types only.
    """
    counts = agg_payment_type_counts(order_payments)
    w = Window.partitionBy("order_id").orderBy(
        F.col("payment_type_count").desc(), F.col("payment_type").asc_nulls_first())
    return counts.withColumn("row_num", F.row_number().over(w))


def _main_type_order() -> F.Column:
    # Smallest struct wins: highest count first, then type ascending (NULL first).
    return F.struct((-F.col("n")).alias("neg_count"), F.col("payment_type"))


def agg_payments(order_payments: DataFrame) -> DataFrame:
    """Payments per order, including the main payment type.

    Two aggregation levels: (order, type) then order. Level one combines rows
    map-side before any shuffle, so an order with very many payments is reduced
    to one row per type early; level two only sees those rows.
    """
    per_type = order_payments.groupBy("order_id", "payment_type").agg(
        F.count(F.lit(1)).alias("n"),
        sum_money("payment_value").alias("value_sum"),
        F.max("payment_sequential").alias("seq_max"),
        F.max("payment_installments").alias("inst_max"),
        F.sum("payment_installments").alias("inst_sum"),
        F.count("payment_installments").alias("inst_n"),
    )
    return per_type.groupBy("order_id").agg(
        sum_totals("value_sum").alias("payment_value_total"),
        F.max("seq_max").alias("payment_sequential_max"),
        F.max("inst_max").alias("payment_installments_max"),
        (F.sum("inst_sum").cast("double") / F.sum("inst_n")).alias("payment_installments_mean"),
        F.count("payment_type").alias("payment_types_nunique"),
        F.min_by("payment_type", _main_type_order()).alias("payment_type_main"),
    )


def join_ranked_condition(order_payments: DataFrame) -> DataFrame:
    """Every payment row with its order's rank-1 type (rank = 1 inside the join).

    The ranked side is unique per order after the filter, so the left join
    keeps the payment rows one-to-one.
    """
    top = (window_payment_rank(order_payments)
           .where(F.col("row_num") == 1)
           .select("order_id", F.col("payment_type").alias("payment_type_main")))
    return left_join_split(order_payments, top, "order_id")


def agg_reviews(order_reviews: DataFrame) -> DataFrame:
    """Reviews per order: distinct reviews, score mean/min/max, comment flag."""
    return order_reviews.groupBy("order_id").agg(
        F.countDistinct("review_id").alias("review_count"),
        F.avg("review_score").alias("review_score_mean"),
        F.min("review_score").alias("review_score_min"),
        F.max("review_score").alias("review_score_max"),
        F.bool_or(any_not_null("review_comment_title", "review_comment_message"))
        .alias("has_review_comment"),
    )


# ---------------------------------------------------------------------------
# Facts
# ---------------------------------------------------------------------------


def order_measures(orders: DataFrame) -> DataFrame:
    """Durations, the late flag and the purchase month of every order."""
    purchase = F.col("order_purchase_timestamp")
    carrier = F.col("order_delivered_carrier_date")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    return orders.withColumns({
        "approve_hours": hour_diff("order_approved_at", purchase),
        "delivery_days": day_diff(delivered, purchase),
        "carrier_to_customer_days": day_diff(delivered, carrier),
        "estimated_delivery_days": day_diff(estimated, purchase),
        "delivery_delay_days": day_diff(delivered, estimated),
        "is_delivered_late": late_flag(delivered, estimated),
        "purchase_year": year_part(purchase),
        "purchase_month": month_part(purchase),
        "purchase_year_month": year_month_label(purchase),
    })


def gold_fct_orders(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per order with item, payment and review summaries and measures."""
    orders = tables["orders"]
    fact = (orders
            .join(agg_items(tables["order_items"]), "order_id", "left")
            .join(agg_payments(tables["order_payments"]), "order_id", "left")
            .join(agg_reviews(tables["order_reviews"]), "order_id", "left"))
    return order_measures(fact).select(*columns("gold_fct_orders"))


_ORDER_COLUMNS_FOR_ITEMS = [
    "customer_id", "order_status", "order_purchase_timestamp",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date", "purchase_year", "purchase_month",
    "purchase_year_month", "delivery_days", "delivery_delay_days", "is_delivered_late",
]


def gold_fct_order_items(tables: Mapping[str, DataFrame], fct_orders: DataFrame | None = None) -> DataFrame:
    """Every item row with its order's attributes and shipping accuracy.

    Only the order-level columns needed are derived (the item fact does not
    need the payment or review summaries), so Catalyst prunes those branches.
    A left join: items whose order is missing keep NULL order columns. The
    items of a hot order are dealt out over several tasks.
    """
    if fct_orders is None:
        fct_orders = order_measures(tables["orders"])
    order_side = fct_orders.select("order_id", *_ORDER_COLUMNS_FOR_ITEMS)
    items = with_item_total(tables["order_items"])
    joined = left_join_split(items, order_side, "order_id")
    return joined.withColumn(
        "shipping_accuracy_days",
        day_diff("shipping_limit_date", "order_delivered_carrier_date"),
    ).select(*columns("gold_fct_order_items"))


def gold_agg_sales_monthly(fct_orders: DataFrame, unique_order_ids: bool = False) -> DataFrame:
    """Monthly sales, ticket, freight, delivery time, review score and OTD.

    The group key is a handful of months, so partial aggregation leaves one
    row per month and map task before the shuffle; a month with a third of
    all orders costs no more than any other. Distinct counts are exact. Pass
    ``unique_order_ids=True`` only when a check has proven ``order_id`` unique
    in the fact: the order count is then a plain count (NULLs are skipped by
    both forms), which removes one distinct-count branch and its shuffle.
    """
    late = F.col("is_delivered_late")
    delivered = F.count(late)
    late_n = F.count_if(late)
    orders_count = F.count("order_id") if unique_order_ids else F.countDistinct("order_id")
    return fct_orders.groupBy("purchase_year", "purchase_month", "purchase_year_month").agg(
        orders_count.alias("orders_count"),
        F.countDistinct("customer_id").alias("customers_count"),
        sum_totals("order_total_value").alias("revenue_total"),
        sum_totals("payment_value_total").alias("payment_total"),
        sum_totals("freight_value").alias("freight_total"),
        avg_money("order_total_value").alias("avg_ticket"),
        avg_money("freight_value").alias("avg_freight"),
        avg_micros_as_days(micros_between("order_purchase_timestamp",
                                          "order_delivered_customer_date"))
        .alias("avg_delivery_days"),
        avg_score("review_score_mean").alias("avg_review_score"),
        delivered.alias("delivered_orders"),
        late_n.alias("late_orders"),
        guarded_ratio(late_n, delivered).alias("otd_rate"),
    )


# ---------------------------------------------------------------------------
# Dimensions
# ---------------------------------------------------------------------------


def _with_geo(df: DataFrame, zip_col: str, geolocations: DataFrame, prefix: str) -> DataFrame:
    geo = geolocations.select(
        F.col("zip_code_prefix").alias(zip_col),
        F.col("latitude").alias(f"{prefix}_lat"),
        F.col("longitude").alias(f"{prefix}_lng"),
        F.col("city").alias(f"{prefix}_geo_city"),
        F.col("state").alias(f"{prefix}_geo_state"),
    )
    return left_join_split(df, geo, zip_col)


def gold_dim_customers(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _with_geo(tables["customers"], "customer_zip_code_prefix",
                     tables["geolocations"], "customer").select(*columns("gold_dim_customers"))


def gold_dim_sellers(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _with_geo(tables["sellers"], "seller_zip_code_prefix",
                     tables["geolocations"], "seller").select(*columns("gold_dim_sellers"))


def gold_dim_products(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Products with the English category; duplicate categories would fan out."""
    categories = tables["product_categories"].select(
        "product_category_name", "product_category_name_english")
    return left_join_split(tables["products"], categories, "product_category_name").select(*columns("gold_dim_products"))


def build_gold(tables: Mapping[str, DataFrame]) -> LazyTables:
    """The six Gold tables from un-prefixed Silver tables (built on access)."""
    fct: dict[str, DataFrame] = {}

    def fct_orders() -> DataFrame:
        if "f" not in fct:
            fct["f"] = gold_fct_orders(tables)
        return fct["f"]

    return LazyTables({
        "gold_dim_customers": lambda: gold_dim_customers(tables),
        "gold_dim_products": lambda: gold_dim_products(tables),
        "gold_dim_sellers": lambda: gold_dim_sellers(tables),
        "gold_fct_orders": fct_orders,
        "gold_fct_order_items": lambda: gold_fct_order_items(tables),
        "gold_agg_sales_monthly": lambda: gold_agg_sales_monthly(fct_orders()),
    })
