"""Operators of the exploratory notebook, with their orderings made explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import first_by_order, micros_between, sum_money
from ledgerline.operators.joins import left_join_split
from ledgerline.schemas import MONEY


def payments_summary(order_payments: DataFrame) -> DataFrame:
    """Per order, total value, first payment type, max sequence and
    installments. "First" is the first non-null type by payment sequence (the
    file order of the source); value is summed exactly as money."""
    return order_payments.groupBy("order_id").agg(
        sum_money(F.col("payment_value").cast(MONEY)).alias("payment_value"),
        first_by_order("payment_type", "payment_sequential").alias("payment_type"),
        F.max("payment_sequential").alias("payment_sequential"),
        F.max("payment_installments").alias("payment_installments"),
    )


def head_sorted(summary: DataFrame, n: int = 5) -> DataFrame:
    """L1: the first ``n`` orders (by order id), displayed by installments.

    ``orderBy + limit`` plans as a per-partition top-n, so only ``n`` rows per
    partition move to the final task.
    """
    head = summary.orderBy("order_id").limit(n)
    return head.orderBy("payment_installments", "order_id")


def shipping_join(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items with their order's carrier date; the shipping margin is
    ``shipping_limit_date - carrier date`` in microseconds."""
    carrier = orders.select("order_id", "order_delivered_carrier_date")
    joined = left_join_split(order_items, carrier, "order_id")
    return joined.select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
        "price", "freight_value",
        micros_between("order_delivered_carrier_date", "shipping_limit_date")
        .alias("shipping_accuracy_micros"),
    )


def order_intervals(orders: DataFrame) -> DataFrame:
    """The notebook's signed intervals (signs as written there), in
    microseconds: purchase - approved, carrier - delivered, approved - estimated."""
    return orders.select(
        micros_between("order_approved_at", "order_purchase_timestamp")
        .alias("approve_interval_micros"),
        micros_between("order_delivered_customer_date", "order_delivered_carrier_date")
        .alias("deliver_interval_micros"),
        micros_between("order_estimated_delivery_date", "order_approved_at")
        .alias("estimated_delivery_micros"),
        "order_id", "customer_id",
    )
