"""Bronze replica and Silver cleaning (narrow transforms plus one aggregation).

Bronze is the source tables as read (after timestamp coercion). Silver rounds
money, consolidates geolocation to one row per zip prefix and passes the other
tables through. Only the geolocation consolidation shuffles (on the zip).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import mean_coordinate, round_money
from ledgerline.operators.modes import mode_per_group
from ledgerline.tables import LazyTables, renamed


def build_bronze(sources: Mapping[str, DataFrame]) -> LazyTables:
    """Identity replica of the nine sources under ``bronze_`` names."""
    return renamed(sources, lambda name: f"bronze_{name}")


def silver_geolocations(geolocation: DataFrame) -> DataFrame:
    """One row per zip prefix: mean coordinates, modal city and state.

    Rows without a zip are dropped. Means and modes are aggregated apart, partial +
    final, so a zip holding a large share of the rows is pre-combined on the map
    side; each has one row per zip, and they are joined on it.
    """
    key = "zip_code_prefix"
    valid = (geolocation.where(F.col("geolocation_zip_code_prefix").isNotNull())
             .withColumnRenamed("geolocation_zip_code_prefix", key))
    means = valid.groupBy(key).agg(mean_coordinate("geolocation_lat").alias("latitude"),
                                   mean_coordinate("geolocation_lng").alias("longitude"))
    return (means.join(mode_per_group(valid, key, "geolocation_city", "city"), key)
            .join(mode_per_group(valid, key, "geolocation_state", "state"), key)
            .select(key, "city", "state", "latitude", "longitude"))


def silver_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.withColumns({
        "price": round_money("price"),
        "freight_value": round_money("freight_value"),
    })


def silver_order_payments(order_payments: DataFrame) -> DataFrame:
    return order_payments.withColumn("payment_value", round_money("payment_value"))


def build_silver(sources: Mapping[str, DataFrame], strip_prefix: bool = False) -> LazyTables:
    """The nine Silver tables (built on access); ``strip_prefix`` drops the
    ``silver_`` names."""
    builders = {
        "silver_geolocations": lambda: silver_geolocations(sources["geolocation"]),
        "silver_product_categories": lambda: sources["translation"],
        "silver_customers": lambda: sources["customers"],
        "silver_sellers": lambda: sources["sellers"],
        "silver_products": lambda: sources["products"],
        "silver_orders": lambda: sources["orders"],
        "silver_order_items": lambda: silver_order_items(sources["order_items"]),
        "silver_order_payments": lambda: silver_order_payments(sources["order_payments"]),
        "silver_order_reviews": lambda: sources["order_reviews"],
    }
    tables = LazyTables(builders)
    if strip_prefix:
        return renamed(tables, lambda name: name.removeprefix("silver_"))
    return tables
