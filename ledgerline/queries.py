"""Registry of named queries: each takes ``(spark, sf_dir)`` and returns a lazy
DataFrame computed from the test tables in ``sf_dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas, staging
from ledgerline.functions import guarded_ratio
from ledgerline.operators import gold as G
from ledgerline.operators import notebook as N
from ledgerline.operators import quality as Q
from ledgerline.operators import silver as S
from ledgerline.operators.fingerprint import fingerprints
from ledgerline.operators.modes import mode_per_group
from ledgerline.plans.build import build_all
from ledgerline.session import apply_sql_defaults, scratch_path
from ledgerline.sinks import runs, writers
from ledgerline.sinks.writers import conform_columns, conform_types, register_views
from ledgerline.sources import drift, landing, quoted, readers, rejects

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_sql_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return wrap


def silver_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """Un-prefixed Silver tables over the staged sources."""
    return S.build_silver(staging.load_sources(spark, sf_dir), strip_prefix=True)


# --- Gold -----------------------------------------------------------------------


@register("gold_fct_orders")
def q_gold_fct_orders(spark, sf_dir):
    return G.gold_fct_orders(silver_tables(spark, sf_dir))


@register("gold_fct_order_items")
def q_gold_fct_order_items(spark, sf_dir):
    return G.gold_fct_order_items(silver_tables(spark, sf_dir))


@register("gold_agg_sales_monthly")
def q_gold_agg_sales_monthly(spark, sf_dir):
    return G.gold_agg_sales_monthly(G.gold_fct_orders(silver_tables(spark, sf_dir)))


@register("gold_dim_customers")
def q_gold_dim_customers(spark, sf_dir):
    return G.gold_dim_customers(silver_tables(spark, sf_dir))


@register("gold_dim_sellers")
def q_gold_dim_sellers(spark, sf_dir):
    return G.gold_dim_sellers(silver_tables(spark, sf_dir))


@register("gold_dim_products")
def q_gold_dim_products(spark, sf_dir):
    return G.gold_dim_products(silver_tables(spark, sf_dir))


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return staging.stage_source(spark, sf_dir, name)


def payments_with_null_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver payments where one event type maps to a NULL payment type, so
    NULL groups and NULL-first ties are exercised."""
    return S.silver_order_payments(staging.stage_order_payments(spark, sf_dir, null_type=True))


def orders_with_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.order_measures(staged(spark, sf_dir, "orders"))


# --- Bronze / Silver ---------------------------------------------------------------


@register("bronze_replicate")
def q_bronze_replicate(spark, sf_dir):
    """V1: content fingerprint of each of the nine Bronze replicas."""
    return fingerprints(S.build_bronze(staging.load_sources(spark, sf_dir)))


@register("bronze_orders")
def q_bronze_orders(spark, sf_dir):
    """V1: the rows of the Bronze orders replica (timestamps derived per order)."""
    return S.build_bronze(staging.load_sources(spark, sf_dir))["bronze_orders"]


@register("silver_geolocations")
def q_silver_geolocations(spark, sf_dir):
    """V2/V6: one row per zip prefix."""
    return S.silver_geolocations(staged(spark, sf_dir, "geolocation"))


@register("agg_mode")
def q_agg_mode(spark, sf_dir):
    """V3: deterministic mode of the payment type per order (nulls skipped,
    ties to the smallest, all-null -> NULL)."""
    return mode_per_group(payments_with_null_type(spark, sf_dir), "order_id", "payment_type",
                          "payment_type_mode")


@register("round_coordinates")
def q_round_coordinates(spark, sf_dir):
    """V4: coordinates averaged at full precision, rounded to 7 places."""
    return S.silver_geolocations(staged(spark, sf_dir, "geolocation")).select(
        "zip_code_prefix", "latitude", "longitude")


@register("round_money")
def q_round_money(spark, sf_dir):
    """V5: money rounded to 2 places on items."""
    return S.silver_order_items(staged(spark, sf_dir, "order_items"))


@register("round_money_payments")
def q_round_money_payments(spark, sf_dir):
    """V5: money rounded to 2 places on payments."""
    return S.silver_order_payments(staged(spark, sf_dir, "order_payments"))


@register("silver_passthrough")
def q_silver_passthrough(spark, sf_dir):
    """Content fingerprint of each of the six pass-through Silver tables, without the prefix."""
    silver = S.build_silver(staging.load_sources(spark, sf_dir), strip_prefix=True)
    names = ("product_categories", "customers", "sellers", "products", "orders", "order_reviews")
    return fingerprints({n: silver[n] for n in names})


@register("silver_order_reviews")
def q_silver_order_reviews(spark, sf_dir):
    """The rows of one pass-through Silver table, without the prefix."""
    return S.build_silver(staging.load_sources(spark, sf_dir), strip_prefix=True)["order_reviews"]


# --- scalar expressions ----------------------------------------------------------


@register("item_total_value")
def q_item_total_value(spark, sf_dir):
    """Every item row with price + freight."""
    return G.with_item_total(S.silver_order_items(staged(spark, sf_dir, "order_items")))


@register("fn_day_diff")
def q_fn_day_diff(spark, sf_dir):
    """Fractional day differences, sign kept, NULL-propagating."""
    return orders_with_measures(spark, sf_dir).select(
        "order_id", "delivery_days", "carrier_to_customer_days", "estimated_delivery_days",
        "delivery_delay_days")


@register("fn_hour_diff")
def q_fn_hour_diff(spark, sf_dir):
    """P5: approval time in hours."""
    return orders_with_measures(spark, sf_dir).select("order_id", "approve_hours")


@register("fn_year_month_parts")
def q_fn_year_month_parts(spark, sf_dir):
    """Purchase year and month as integers."""
    return orders_with_measures(spark, sf_dir).select("order_id", "purchase_year", "purchase_month")


@register("fn_year_month_label")
def q_fn_year_month_label(spark, sf_dir):
    """Purchase month as yyyy-MM."""
    return orders_with_measures(spark, sf_dir).select("order_id", "purchase_year_month")


@register("fn_late_flag")
def q_fn_late_flag(spark, sf_dir):
    """Three-valued late flag."""
    return orders_with_measures(spark, sf_dir).select("order_id", "is_delivered_late")


@register("fn_guarded_ratio")
def q_fn_guarded_ratio(spark, sf_dir):
    """On-time rate per customer, NULL when nothing was delivered."""

    late = F.col("is_delivered_late")
    return orders_with_measures(spark, sf_dir).groupBy("customer_id").agg(
        F.count(late).alias("delivered_orders"),
        F.count_if(late).alias("late_orders"),
        guarded_ratio(F.count_if(late), F.count(late)).alias("otd_rate"))


@register("notebook_intervals")
def q_notebook_intervals(spark, sf_dir):
    """The notebook's signed order intervals, in microseconds."""
    return N.order_intervals(staged(spark, sf_dir, "orders"))


# --- joins -------------------------------------------------------------------------


@register("join_ranked_condition")
def q_join_ranked_condition(spark, sf_dir):
    """Payments joined to their order's rank-1 type (rank in the ON clause)."""
    return G.join_ranked_condition(payments_with_null_type(spark, sf_dir))


@register("notebook_shipping_join")
def q_notebook_shipping_join(spark, sf_dir):
    """Items with the order's carrier date and the shipping margin."""
    return N.shipping_join(staged(spark, sf_dir, "order_items"), staged(spark, sf_dir, "orders"))


# --- aggregations and windows -----------------------------------------------------


@register("agg_payments")
def q_agg_payments(spark, sf_dir):
    """A1: payments per order incl. the main type (NULL types included)."""
    return G.agg_payments(payments_with_null_type(spark, sf_dir))


@register("agg_reviews")
def q_agg_reviews(spark, sf_dir):
    """A2: reviews per order."""
    return G.agg_reviews(staged(spark, sf_dir, "order_reviews"))


@register("agg_items")
def q_agg_items(spark, sf_dir):
    """A3: items per order."""
    return G.agg_items(S.silver_order_items(staged(spark, sf_dir, "order_items")))


@register("agg_payment_type_counts")
def q_agg_payment_type_counts(spark, sf_dir):
    """A5: COUNT(*) per (order, payment type), NULL type a group of its own."""
    return G.agg_payment_type_counts(payments_with_null_type(spark, sf_dir))


@register("notebook_payments")
def q_notebook_payments(spark, sf_dir):
    """Notebook payment summary with the first non-null type by sequence."""
    return N.payments_summary(staging.stage_order_payments(spark, sf_dir, null_type=True))


@register("window_payment_rank")
def q_window_payment_rank(spark, sf_dir):
    """ROW_NUMBER of payment types per order (count desc, type asc, NULL first)."""
    return G.window_payment_rank(payments_with_null_type(spark, sf_dir))


@register("notebook_head_sort")
def q_notebook_head_sort(spark, sf_dir):
    """L1: first five orders of the payment summary, shown by installments."""
    return N.head_sorted(N.payments_summary(
        staging.stage_order_payments(spark, sf_dir, null_type=True)), 5)


# --- data quality -----------------------------------------------------------------


def all_layers(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return build_all(staging.load_sources(spark, sf_dir), validate=False)


@register("dq_no_nulls")
def q_dq_no_nulls(spark, sf_dir):
    """Q1: null counts per column of the order fact (incl. a missing column)."""
    fct = G.gold_fct_orders(silver_tables(spark, sf_dir))
    return Q.no_nulls(fct, ["order_id", "order_delivered_carrier_date", "payment_value_total",
                            "review_count", "no_such_column"], "gold_fct_orders")


@register("dq_row_count")
def q_dq_row_count(spark, sf_dir):
    """Q2: row floors (one passing, one failing)."""
    return Q.union_reports([
        Q.row_count(staged(spark, sf_dir, "order_items"), 1000, "bronze_order_items"),
        Q.row_count(S.silver_geolocations(staged(spark, sf_dir, "geolocation")), 1000,
                    "silver_geolocations"),
    ])


@register("dq_no_duplicates")
def q_dq_no_duplicates(spark, sf_dir):
    """Q3: excess rows per key; NULL keys equal; absent key columns."""
    return Q.union_reports([
        Q.no_duplicates(staged(spark, sf_dir, "order_items"), ["order_id", "order_item_id"],
                        "bronze_order_items"),
        Q.no_duplicates(staged(spark, sf_dir, "geolocation"), ["geolocation_zip_code_prefix"],
                        "bronze_geolocation"),
        Q.no_duplicates(staged(spark, sf_dir, "orders"), ["order_id", "not_a_column"],
                        "bronze_orders"),
        Q.no_duplicates(staged(spark, sf_dir, "customers"), ["not_a_column"], "bronze_customers"),
    ])


@register("dq_value_range")
def q_dq_value_range(spark, sf_dir):
    """Q4: inclusive ranges, open bounds, nulls ignored, missing column."""
    items = S.silver_order_items(staged(spark, sf_dir, "order_items"))
    orders = orders_with_measures(spark, sf_dir)
    payments = S.silver_order_payments(staged(spark, sf_dir, "order_payments"))
    return Q.union_reports([
        Q.value_range(items, "price", 0, None, "silver_order_items"),
        Q.value_range(orders, "delivery_delay_days", -10, 10, "gold_fct_orders"),
        Q.value_range(payments, "payment_installments", 1, 50, "silver_order_payments"),
        Q.value_range(payments, "no_such_column", 0, 1, "silver_order_payments"),
    ])


@register("dq_suite_bronze")
def q_dq_suite_bronze(spark, sf_dir):
    """Q5: Bronze suite."""
    return Q.suite_bronze(S.build_bronze(staging.load_sources(spark, sf_dir)))


@register("dq_suite_silver")
def q_dq_suite_silver(spark, sf_dir):
    """Q5: Silver suite."""
    return Q.suite_silver(S.build_silver(staging.load_sources(spark, sf_dir)))


@register("dq_suite_gold")
def q_dq_suite_gold(spark, sf_dir):
    """Q5: Gold suite."""
    return Q.suite_gold(G.build_gold(silver_tables(spark, sf_dir)))


@register("dq_primary_keys")
def q_dq_primary_keys(spark, sf_dir):
    """Q6: declared primary keys of all 24 tables."""
    return Q.primary_keys(all_layers(spark, sf_dir))


@register("dq_foreign_keys")
def q_dq_foreign_keys(spark, sf_dir):
    """Q7: the 13 declared foreign keys (orphan counts)."""
    return Q.foreign_keys(all_layers(spark, sf_dir))


@register("dq_relationships")
def q_dq_relationships(spark, sf_dir):
    """E5: orphan counts along the nine source relationships."""
    return Q.relationships(staging.load_sources(spark, sf_dir))


@register("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    """Q8: NOT NULL columns of all 24 tables."""
    return Q.not_null(all_layers(spark, sf_dir))


@register("dq_domain")
def q_dq_domain(spark, sf_dir):
    """Q9: UNSIGNED and text-length limits of all 24 tables."""
    return Q.domains(all_layers(spark, sf_dir))


@register("dq_one_pass")
def q_dq_one_pass(spark, sf_dir):
    """Q1, Q2, Q4, Q5, Q8, Q9: every row check of all 24 tables, one scan of each table."""
    return Q.one_pass(all_layers(spark, sf_dir))


@register("dq_all_keys")
def q_dq_all_keys(spark, sf_dir):
    """Q3, Q6, Q7, E5: all declared keys, constraints and source relationships from one shuffle."""
    return Q.all_keys(all_layers(spark, sf_dir))


@register("table_profile")
def q_table_profile(spark, sf_dir):
    """Q10: rows, columns and non-null counts of every column of all 24 tables."""
    return reduce(DataFrame.unionByName, [Q.table_profile(df, name) for name, df in all_layers(spark, sf_dir).items()])


def _fingerprints_by_layer(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Fingerprints of the 24 tables in their sink types."""
    return fingerprints({t: conform_types(tables[t], t) for t in schemas.LOAD_ORDER},
                        {t: {"layer": schemas.layer_of(t)} for t in schemas.LOAD_ORDER})


@register("layer_row_counts")
def q_layer_row_counts(spark, sf_dir):
    """The validated full build (24 tables); row count and content fingerprint per table."""
    return _fingerprints_by_layer(build_all(staging.load_sources(spark, sf_dir), validate=True))


# --- sources ------------------------------------------------------------------------


def _text_timestamps(df: DataFrame):
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(
        f.dataType, T.TimestampNTZType) else f.dataType, True) for f in df.schema.fields])


@register("scan_csv")
def q_scan_csv(spark, sf_dir):
    """S1 (+S9): orders landed as CSV text, read with a schema, timestamps coerced."""
    path = scratch_path(spark, "scan_csv")
    orders = staged(spark, sf_dir, "orders")
    landing.write_csv(orders, path)
    raw = readers.read_csv(spark, path, _text_timestamps(orders))
    return readers.coerce_timestamps(raw, schemas.TIMESTAMP_COLUMNS["orders"])


@register("scan_json")
def q_scan_json(spark, sf_dir):
    """Payments landed as JSON Lines and read with a schema."""
    path = scratch_path(spark, "scan_json")
    payments = staged(spark, sf_dir, "order_payments")
    landing.write_json_lines(payments, path)
    return readers.read_json(spark, path, payments.schema)


@register("scan_parquet")
def q_scan_parquet(spark, sf_dir):
    """S3: items landed as Parquet and read back."""
    path = scratch_path(spark, "scan_parquet")
    staged(spark, sf_dir, "order_items").write.mode("overwrite").parquet(path)
    return readers.read_parquet(spark, path)


@register("scan_json_envelope")
def q_scan_json_envelope(spark, sf_dir):
    """Payments landed as paged {"value": [...]} envelopes and unwrapped."""
    path = scratch_path(spark, "scan_json_envelope")
    payments = staged(spark, sf_dir, "order_payments")
    landing.write_json_envelopes(payments, path, page_size=1000)
    return readers.read_json_envelope(spark, path, payments.schema)


def _drifting_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments landed as JSON records of drifting shape: some with a field more, some with the
    installments as a word, some lines cut off."""
    path = scratch_path(spark, "drifting")
    payments = staged(spark, sf_dir, "order_payments")
    k = F.col("order_id") % 20
    plain = F.struct(*payments.columns)
    more = F.struct(*payments.columns, F.lit(True).alias("gift"), F.struct(F.lit("app").alias("name")).alias("channel"))
    words = F.struct(*[F.lit("three").alias(c) if c == "payment_installments" else F.col(c) for c in payments.columns])
    line = F.when(k == 0, F.to_json(more)).when(k == 1, F.to_json(words)).when(k == 2, F.substring(F.to_json(plain), 1, 20)).otherwise(F.to_json(plain))
    payments.select(line.alias("value")).write.text(path)
    return drift.read_variants(spark, path)


@register("scan_json_drift")
def q_scan_json_drift(spark, sf_dir):
    """Records of drifting shape, their declared fields."""
    schema = staged(spark, sf_dir, "order_payments").schema
    return drift.declared(_drifting_payments(spark, sf_dir), schema)


@register("json_drift_report")
def q_json_drift_report(spark, sf_dir):
    """What of the records did not fit the declared schema, per field and type seen."""
    schema = staged(spark, sf_dir, "order_payments").schema
    return drift.drift(_drifting_payments(spark, sf_dir), schema)


@register("scan_by_suffix")
def q_scan_by_suffix(spark, sf_dir):
    """The reader is chosen from the path suffix (.csv here)."""
    path = scratch_path(spark, "scan_by_suffix") + "/order_items.CSV"
    items = staged(spark, sf_dir, "order_items")
    landing.write_csv(items, path)
    return readers.read_by_suffix(spark, path, items.schema)


@register("scan_newest_file")
def q_scan_newest_file(spark, sf_dir):
    """The newest landed dataset wins; an ignored folder is skipped."""
    root = scratch_path(spark, "scan_newest")
    staged(spark, sf_dir, "sellers").write.parquet(f"{root}/v1")
    staged(spark, sf_dir, "orders").write.parquet(f"{root}/v2")
    staged(spark, sf_dir, "products").write.parquet(f"{root}/archive/v3")
    newest = readers.newest_entry(spark, root, {".parquet"}, ignore_dirs=[f"{root}/archive"])
    return readers.read_parquet(spark, newest)


@register("load_dataset")
def q_load_dataset(spark, sf_dir):
    """Nine landed CSV files checked for existence together, then read; fingerprint per table."""
    base = scratch_path(spark, "load_dataset")
    files = {name: f"{name}.csv" for name in schemas.SOURCE_NAMES}
    for name, df in staging.load_sources(spark, sf_dir).items():
        landing.write_csv(df, f"{base}/{files[name]}")
    return fingerprints(readers.load_dataset(spark, base, files))


# Bad input planted in the landed files: by a remainder of the order's number.
BROKEN_ORDERS, UNDATED_ORDERS = 101, 97
UNPRICED_ITEMS, SPLIT_ITEMS = 103, 107
SHORT_PAYMENTS, MANY_INSTALLMENTS = 83, 89
LONG_COMMENTS, UNSCORED_REVIEWS, SOON_REVIEWS = 7, 11, 13
COMMENT = 'two\nlines, "quoted"'


def _texts(df: DataFrame) -> DataFrame:
    """Every column as the text of an export: timestamps to the second, doubles with four places."""
    def text(f: T.StructField):
        if isinstance(f.dataType, T.TimestampNTZType):
            return F.date_format(f.name, "yyyy-MM-dd HH:mm:ss")
        return F.col(f.name).cast("decimal(20,4)" if isinstance(f.dataType, T.DoubleType) else f.dataType).cast("string")

    return df.select(*[text(f).alias(f.name) for f in df.schema.fields])


def land_with_rejects(spark: SparkSession, sf_dir: str, base: str) -> dict[str, str]:
    """The nine sources as CSV files, with bad lines and values planted in four of them."""
    every = lambda n: F.col("order_id").cast("long") % n == 0
    plants = {
        "orders": {"order_approved_at": (UNDATED_ORDERS, "not a date")},
        "order_items": {"price": (UNPRICED_ITEMS, "free"), "order_item_id": (SPLIT_ITEMS, "1.5")},
        "order_payments": {"payment_installments": (MANY_INSTALLMENTS, "many")},
        "order_reviews": {"review_score": (UNSCORED_REVIEWS, "x"), "review_creation_date": (SOON_REVIEWS, "soon"),
                          "review_comment_message": (LONG_COMMENTS, COMMENT)},
    }
    files = {}
    for name, df in staging.load_sources(spark, sf_dir).items():
        text = _texts(df)
        text = text.withColumns({c: F.when(every(n), F.lit(v)).otherwise(F.col(c)) for c, (n, v) in plants.get(name, {}).items()})
        line = F.to_csv(F.struct(*text.columns), {"quote": '"', "escape": '"'})
        if name == "orders":
            line = F.when(every(BROKEN_ORDERS), F.concat(line, F.lit(",one too many"))).otherwise(line)
        if name == "order_payments":
            line = F.when(every(SHORT_PAYMENTS), F.concat_ws(",", "order_id", "payment_sequential")).otherwise(line)
        files[name] = f"{name}.csv"
        landing.write_lines(text.select(line.alias("line")), ",".join(text.columns), f"{base}/{files[name]}")
    return files


def _checked_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Land, load with the reject channel and write Bronze as a run; returns the sink's root."""
    base, root = scratch_path(spark, "rejects-landed"), scratch_path(spark, "rejects")
    limits = {reason: 1.0 for reason in rejects.DEFAULT_LIMITS}
    sources = rejects.load_checked(spark, base, land_with_rejects(spark, sf_dir, base), limits)
    writers.full_refresh(spark, sources, root, run_id="checked", validate=False, stop_after="bronze")
    return root


@register("reject_counts")
def q_reject_counts(spark, sf_dir):
    """What the job that wrote Bronze counted as rejected, per table, reason and column."""
    return writers.run_rejects(spark, _checked_bronze(spark, sf_dir), "checked")


@register("rejected_lines")
def q_rejected_lines(spark, sf_dir):
    """The rejected lines that the run kept, a row per thing that is wrong with one."""
    return spark.read.schema(rejects.LINE_SCHEMA).parquet(runs.rejects_path(_checked_bronze(spark, sf_dir), "checked"))


@register("reject_bronze")
def q_reject_bronze(spark, sf_dir):
    """Fingerprints of the Bronze tables that the checked load wrote: broken lines left out, bad values NULL."""
    root = _checked_bronze(spark, sf_dir)
    return fingerprints({t: writers.read_published(spark, root, t, "checked") for t in schemas.BRONZE_ORDER})


@register("scan_csv_quoted")
def q_scan_csv_quoted(spark, sf_dir):
    """Reviews with quoted newlines in one CSV file, read by several tasks (small splits here)."""
    path, before = scratch_path(spark, "scan_quoted"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    reviews = staged(spark, sf_dir, "order_reviews").withColumn(
        "review_comment_message", F.when(F.col("order_id") % LONG_COMMENTS == 0, F.lit(COMMENT)).otherwise(F.col("review_comment_message")))
    landing.write_csv(reviews.coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        return quoted.read_csv_quoted(spark, path, reviews.schema)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@register("scan_csv_latin1")
def q_scan_csv_latin1(spark, sf_dir):
    """Customers landed as ISO-8859-1 CSV and decoded."""
    path = scratch_path(spark, "scan_csv_latin1")
    customers = staged(spark, sf_dir, "customers")
    landing.write_csv(customers, path, encoding="ISO-8859-1")
    return readers.read_csv_latin1(spark, path, customers.schema)


@register("coerce_timestamps")
def q_coerce_timestamps(spark, sf_dir):
    """Text timestamps parsed; unparseable or empty text becomes NULL."""

    orders = staged(spark, sf_dir, "orders")
    ts_cols = schemas.TIMESTAMP_COLUMNS["orders"]
    text = orders.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ts_cols})
    text = text.withColumns({
        "order_approved_at": F.when(F.col("order_id") % 97 == 0, F.lit("not a date"))
        .otherwise(F.col("order_approved_at")),
        "order_delivered_customer_date": F.when(F.col("order_id") % 89 == 0, F.lit(""))
        .otherwise(F.col("order_delivered_customer_date")),
    })
    return readers.coerce_timestamps(text, ts_cols)


@register("coerce_timestamps_items")
def q_coerce_timestamps_items(spark, sf_dir):
    """Shipping limits as text, some of them no dates."""
    items = staged(spark, sf_dir, "order_items")
    text = F.date_format("shipping_limit_date", "yyyy-MM-dd HH:mm:ss")
    items = items.withColumn("shipping_limit_date", F.when(F.col("order_id") % 97 == 0, F.lit("2021-02-30 00:00:00")).otherwise(text))
    return readers.coerce_timestamps(items, schemas.TIMESTAMP_COLUMNS["order_items"])


@register("coerce_timestamps_reviews")
def q_coerce_timestamps_reviews(spark, sf_dir):
    """Both review timestamps as text (a day for each review), some of them no dates."""
    day = lambda n: F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("review_id") % n).cast("int")), "yyyy-MM-dd 00:00:00")
    reviews = staged(spark, sf_dir, "order_reviews").withColumns({
        "review_creation_date": F.when(F.col("review_id") % 5 != 0, day(300)).otherwise("soon"),
        "review_answer_timestamp": F.when(F.col("review_id") % 3 != 0, day(400))})
    return readers.coerce_timestamps(reviews, schemas.TIMESTAMP_COLUMNS["order_reviews"])


@register("normalize_null_tokens")
def q_normalize_null_tokens(spark, sf_dir):
    """Missing-value tokens in text columns become NULL."""

    c = F.col("customer_id") % 10
    city = (F.when(c == 0, "NA").when(c == 1, "null").when(c == 2, "").when(c == 3, "None")
            .when(c == 4, "n/a").otherwise(F.col("customer_city")))
    customers = staged(spark, sf_dir, "customers").withColumn("customer_city", city)
    return readers.normalize_null_tokens(customers)


# --- sinks --------------------------------------------------------------------------


@register("conform_columns")
def q_conform_columns(spark, sf_dir):
    """K4: reordered orders with an extra column, projected to the declared list."""

    orders = staged(spark, sf_dir, "orders")
    shuffled = orders.select(*reversed(orders.columns), F.lit("x").alias("extra_column"))
    return conform_columns(shuffled, "silver_orders")


@register("conform_types")
def q_conform_types(spark, sf_dir):
    """K5: the order fact cast to its declared sink types."""
    return conform_types(G.gold_fct_orders(silver_tables(spark, sf_dir)), "gold_fct_orders")


@register("create_layer_tables")
def q_create_layer_tables(spark, sf_dir):
    """K6: layer databases and tables created (twice: idempotent), all 24 loaded in dependency order by
    full refresh and read back from the catalog; fingerprint per table."""
    root = scratch_path(spark, "catalog")
    prefix = f"ledgerline_{uuid.uuid4().hex[:8]}"
    writers.create_layer_tables(spark, root, prefix)
    created = writers.create_layer_tables(spark, root, prefix)
    tables = all_layers(spark, sf_dir)
    for name in schemas.LOAD_ORDER:
        writers.insert_full_refresh(tables[name], created[name], name)
    return fingerprints({t: spark.table(created[t]) for t in schemas.LOAD_ORDER},
                        {t: {"layer": schemas.layer_of(t)} for t in schemas.LOAD_ORDER})


@register("register_views")
def q_register_views(spark, sf_dir):
    """K7: Silver registered as SQL views, and a question asked over three of them: per order status,
    how much was ordered and how much of it was paid for."""
    register_views(S.build_silver(staging.load_sources(spark, sf_dir)), strip="silver_")
    return spark.sql("""
        WITH ordered AS (SELECT order_id, CAST(SUM(price) AS DECIMAL(18,2)) AS goods FROM order_items GROUP BY order_id),
             settled AS (SELECT order_id, CAST(SUM(payment_value) AS DECIMAL(18,2)) AS paid FROM order_payments GROUP BY order_id)
        SELECT o.order_status, COUNT(*) AS n_orders, COUNT(g.goods) AS n_with_items, COUNT(s.paid) AS n_paid,
               CAST(SUM(g.goods) AS DECIMAL(18,2)) AS goods, CAST(SUM(s.paid) AS DECIMAL(18,2)) AS paid
        FROM orders o LEFT JOIN ordered g ON g.order_id = o.order_id LEFT JOIN settled s ON s.order_id = o.order_id
        GROUP BY o.order_status""")


@register("sink_full_refresh")
def q_sink_full_refresh(spark, sf_dir):
    """K1: all 24 tables written, validated and published as one run; row
    counts and content fingerprints read back from the published run."""
    root = scratch_path(spark, "published")
    writers.full_refresh(spark, staging.load_sources(spark, sf_dir), root)
    return writers.published_fingerprints(spark, root)


@register("sink_layer_subset")
def q_sink_layer_subset(spark, sf_dir):
    """K2: Bronze and Silver published, Gold published empty; fingerprints read back."""
    root = scratch_path(spark, "published_subset")
    writers.layer_subset_refresh(spark, staging.load_sources(spark, sf_dir), root)
    return writers.published_fingerprints(spark, root)


@register("month_pruned_read")
def q_month_pruned_read(spark, sf_dir):
    """K1/K6: the order fact laid out by purchase month, two months of it replaced, and two months (and
    the rows without one) read back: only those months' files are touched. The rows that replace a month
    are made from its stored ones, so the fact is computed once."""
    path, table = scratch_path(spark, "months"), "gold_fct_orders"
    fct = G.gold_fct_orders(silver_tables(spark, sf_dir))
    month = F.when(F.col("order_id") % 50 != 0, F.col("purchase_year_month"))  # some orders without a month
    fct = conform_types(fct.withColumn("purchase_year_month", month), table)
    writers.write_table(writers.laid_out(fct, table), path, table)
    closed = writers.read_months(spark, path, table, ["1994-03", "1994-04"]).withColumn("order_status", F.lit("closed"))
    writers.replace_months(closed, path, table)
    return writers.read_months(spark, path, table, ["1994-04", "1994-05", None])


@register("month_dynamic_pruning")
def q_month_dynamic_pruning(spark, sf_dir):
    """K1/K6: items of the months with the lowest on-time rates: the months come from a join with the
    monthly table, so the fact's files are pruned while the query runs. The months, a row each, are broadcast:
    planned from the fact's size they would not be, and the whole stored fact would be read and shuffled."""
    path = scratch_path(spark, "month_items")
    silver = silver_tables(spark, sf_dir)
    items = conform_types(G.gold_fct_order_items(silver), "gold_fct_order_items")
    writers.write_table(writers.laid_out(items, "gold_fct_order_items"), path, "gold_fct_order_items")
    stored = spark.read.schema(schemas.TABLES["gold_fct_order_items"]).parquet(path)
    monthly = G.gold_agg_sales_monthly(G.gold_fct_orders(silver)).where("orders_count < 100").select("purchase_year_month")
    return stored.join(F.broadcast(monthly), "purchase_year_month").select(*schemas.columns("gold_fct_order_items"))


@register("sink_resume")
def q_sink_resume(spark, sf_dir):
    """A run that stopped after Silver, taken up again: Gold alone is written, then published."""
    root, run_id = scratch_path(spark, "resumed"), "resumed"
    sources = staging.load_sources(spark, sf_dir)
    writers.full_refresh(spark, sources, root, run_id=run_id, stop_after="silver")
    writers.full_refresh(spark, sources, root, run_id=run_id)
    return writers.published_fingerprints(spark, root)
