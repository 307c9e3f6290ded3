"""Data-quality checks as Spark aggregations.

Every check returns a small report DataFrame with one row per checked column
(or one per table):

    table_name, check_name, column_name, failing, total, failing_pct, passed, severity

``failing`` counts offending rows (for a row-count check, the shortfall) and
``failing_pct`` is its share of ``total`` in percent;
``failing`` is NULL when the checked column does not exist, which fails the
check.

Checks that look at one row at a time are data (``Check``): all of a table's checks compile to
one aggregate, so a table is scanned once however many checks it has, and the same aggregate can
be an observation of the job that writes the table (``check_metrics``, ``observed_report``), which
costs no scan at all. Key checks (duplicates, orphans) of any number of tables share one shuffle
(``key_report``). Only the few report rows ever reach the driver, in ``enforce`` / the
``validate_*`` wrappers.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas

logger = logging.getLogger(__name__)

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("failing", T.LongType()),
    T.StructField("total", T.LongType()),
    T.StructField("failing_pct", T.DoubleType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("severity", T.StringType()),
])

ERROR = "error"
WARN = "warn"


def _row(table: str, check: str, column: str | None, failing: Column, total: Column,
         severity: str, passed: Column | None = None) -> Column:
    failing = failing.cast("long")
    total = total.cast("long")
    if passed is None:
        passed = F.coalesce(failing == 0, F.lit(False))
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).cast("string").alias("column_name"),
        failing.alias("failing"),
        total.alias("total"),
        F.when(total > 0, failing.cast("double") * 100.0 / total).alias("failing_pct"),
        passed.alias("passed"),
        F.lit(severity).alias("severity"),
    )


def _report(agg: DataFrame, rows: list[Column]) -> DataFrame:
    """Turn one aggregated row into report rows (an unpivot, no shuffle)."""
    return agg.select(F.inline(F.array(*rows)))


def union_reports(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


# ---------------------------------------------------------------------------
# Row checks as data
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One check of one table. ``bad`` tells the offending rows of ``column``; a check with a
    ``floor`` compares the row count instead."""

    table: str
    name: str
    column: str | None
    bad: Column | None = None
    severity: str = WARN
    floor: int | None = None


def null_checks(columns: Iterable[str], table: str, severity: str = WARN) -> list[Check]:
    return [Check(table, "no_nulls", c, F.col(c).isNull(), severity) for c in columns]


def floor_check(min_rows: int, table: str, severity: str = ERROR) -> Check:
    return Check(table, "row_count", None, severity=severity, floor=min_rows)


def range_check(column: str, min_value: float | None, max_value: float | None, table: str,
                severity: str = WARN) -> Check:
    c, outside = F.col(column), F.lit(False)
    if min_value is not None:
        outside = outside | (c < F.lit(min_value))
    if max_value is not None:
        outside = outside | (c > F.lit(max_value))
    return Check(table, "value_range", column, outside, severity)


def domain_checks(table: str, severity: str = WARN) -> list[Check]:
    """UNSIGNED columns are >= 0 and text fits its declared length; a column of another type is measured as text."""
    unsigned = [Check(table, "unsigned", c, F.col(c) < 0, severity) for c in schemas.unsigned_columns(table)]
    return unsigned + [Check(table, f"max_length_{limit}", c, F.length(F.col(c).cast("string")) > limit, severity)
                       for c, limit in schemas.length_limits(table).items()]


def catalogue_checks(table: str) -> list[Check]:
    """Every row check that the declared schema of a table asks for."""
    return null_checks(schemas.not_null_columns(table), table) + domain_checks(table)


def check_metrics(checks: Sequence[Check], columns: Sequence[str]) -> list[Column]:
    """The checks of one table as aggregates: the row count and the offending rows of each check."""
    return [F.count(F.lit(1)).alias("_total"),
            *[F.count_if(c.bad).alias(f"_f{i}") for i, c in enumerate(checks) if c.floor is None and c.column in columns]]


def _check_rows(checks: Sequence[Check], present: set[str]) -> list[Column]:
    total, rows = F.col("_total"), []
    for i, c in enumerate(checks):
        if c.floor is not None:
            failing = F.greatest(F.lit(c.floor) - total, F.lit(0))
        else:
            failing = F.col(f"_f{i}") if f"_f{i}" in present else F.lit(None)
        rows.append(_row(c.table, c.name, c.column, failing, total, c.severity))
    return rows


def table_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table in one scan."""
    agg = df.agg(*check_metrics(checks, df.columns))
    return _report(agg, _check_rows(checks, set(agg.columns)))


def checks_by_table(checks: Iterable[Check]) -> dict[str, list[Check]]:
    out: dict[str, list[Check]] = {}
    for c in checks:
        out.setdefault(c.table, []).append(c)
    return out


def scan_report(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """All checks, one scan for each table that has any."""
    return union_reports([table_report(tables[t], some) for t, some in checks_by_table(checks).items()])


def observed_report(spark: SparkSession, checks: Sequence[Check], observed: Mapping[str, int]) -> DataFrame:
    """The same report from the metrics that a finished write observed; nothing is read."""
    fields = [f"_f{i}" for i in range(len(checks)) if f"_f{i}" in observed]
    schema = ", ".join(f"{n} long" for n in ["_total", *fields])
    row = spark.createDataFrame([tuple(observed[n] for n in ["_total", *fields])], schema)
    return _report(row, _check_rows(checks, set(fields)))


# ---------------------------------------------------------------------------
# Q1-Q4: generic checks
# ---------------------------------------------------------------------------


def no_nulls(df: DataFrame, columns: list[str], table: str, severity: str = WARN) -> DataFrame:
    """Q1: listed columns hold no NULL; a missing column fails."""
    return table_report(df, null_checks(columns, table, severity))


def row_count(df: DataFrame, min_rows: int, table: str, severity: str = ERROR) -> DataFrame:
    """Q2: at least ``min_rows`` rows (inclusive)."""
    return table_report(df, [floor_check(min_rows, table, severity)])


def no_duplicates(df: DataFrame, key_columns: list[str], table: str,
                  severity: str = WARN) -> DataFrame:
    """Q3: rows beyond the first per key; NULL keys compare equal.

    Absent key columns are ignored; if none is present the check fails.
    """
    present = [c for c in key_columns if c in df.columns]
    label = ",".join(present or key_columns)
    if not present:
        agg = df.agg(F.count(F.lit(1)).alias("_total"))
        return _report(agg, [_row(table, "no_duplicates", label, F.lit(None),
                                  F.col("_total"), severity)])
    per_key = df.groupBy(*present).agg(F.count(F.lit(1)).alias("_n"))
    agg = per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_dups"),
                      F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"))
    return _report(agg, [_row(table, "no_duplicates", label, F.col("_dups"),
                              F.col("_total"), severity)])


def value_range(df: DataFrame, column: str, min_value: float | None, max_value: float | None,
                table: str, severity: str = WARN) -> DataFrame:
    """Q4: non-null values inside the inclusive [min, max]; either bound optional."""
    return table_report(df, [range_check(column, min_value, max_value, table, severity)])


# ---------------------------------------------------------------------------
# Boolean / raising wrappers (the few report rows are collected)
# ---------------------------------------------------------------------------


def enforce(report: DataFrame, raise_on_error: bool | None = None) -> bool:
    """Log failures; raise ``ValueError`` for failing checks that must stop.

    With ``raise_on_error`` left as None a check's own severity decides.
    """
    ok = True
    for r in report.collect():
        if r.passed:
            continue
        ok = False
        message = (f"[{r.table_name}] check {r.check_name} on {r.column_name}: "
                   f"{r.failing} failing of {r.total}")
        must_raise = (r.severity == ERROR) if raise_on_error is None else raise_on_error
        if must_raise:
            raise ValueError(message)
        logger.warning(message)
    return ok


def validate_no_nulls(df: DataFrame, columns: list[str], table_name: str,
                      raise_on_error: bool = False) -> bool:
    return enforce(no_nulls(df, columns, table_name), raise_on_error)


def validate_row_count(df: DataFrame, min_rows: int, table_name: str,
                       raise_on_error: bool = True) -> bool:
    return enforce(row_count(df, min_rows, table_name), raise_on_error)


def validate_no_duplicates(df: DataFrame, key_columns: list[str], table_name: str,
                           raise_on_error: bool = False) -> bool:
    return enforce(no_duplicates(df, key_columns, table_name), raise_on_error)


def validate_value_range(df: DataFrame, column: str, min_value: float | None,
                         max_value: float | None, table_name: str,
                         raise_on_error: bool = False) -> bool:
    return enforce(value_range(df, column, min_value, max_value, table_name), raise_on_error)


# ---------------------------------------------------------------------------
# Q5: layer suites (fixed thresholds of the original job; the floor is a parameter)
# ---------------------------------------------------------------------------


def bronze_checks(min_rows: int = 1000) -> list[Check]:
    return [floor_check(min_rows, "bronze_orders"), floor_check(min_rows, "bronze_order_items")]


def silver_checks() -> list[Check]:
    return [*null_checks(["order_id", "customer_id", "order_purchase_timestamp"], "silver_orders"),
            *null_checks(["order_id", "product_id", "seller_id", "price"], "silver_order_items"),
            range_check("price", 0, None, "silver_order_items"),
            range_check("freight_value", 0, None, "silver_order_items")]


def gold_checks(min_rows: int = 1000) -> list[Check]:
    return [floor_check(min_rows, "gold_fct_orders"),
            range_check("order_total_value", 0, None, "gold_fct_orders"),
            range_check("otd_rate", 0, 1, "gold_agg_sales_monthly")]


#: The uniqueness checks of the Bronze and Gold suites.
BRONZE_KEYS = {"bronze_orders": ["order_id"], "bronze_customers": ["customer_id"]}
GOLD_KEYS = {"gold_fct_orders": ["order_id"]}


def suite_bronze(tables: Mapping[str, DataFrame], min_rows: int = 1000) -> DataFrame:
    return union_reports([scan_report(tables, bronze_checks(min_rows)), key_report(tables, BRONZE_KEYS)])


def suite_silver(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One scan of orders and one of items."""
    return scan_report(tables, silver_checks())


def suite_gold(tables: Mapping[str, DataFrame], min_rows: int = 1000,
               order_duplicates: DataFrame | None = None) -> DataFrame:
    """``order_duplicates`` may carry an already computed duplicate report of
    the order fact, so the suite does not shuffle the keys a second time."""
    if order_duplicates is None:
        order_duplicates = no_duplicates(tables["gold_fct_orders"], ["order_id"], "gold_fct_orders")
    return union_reports([scan_report(tables, gold_checks(min_rows)), order_duplicates])


# ---------------------------------------------------------------------------
# Q6, Q7, E5: keys of all tables in one shuffle
# ---------------------------------------------------------------------------


def key_report(tables: Mapping[str, DataFrame], unique: Mapping[str, Sequence[str]],
               references: Sequence[tuple[str, str, str, str]] = (), severity: str = WARN) -> DataFrame:
    """Duplicates of ``unique`` keys (table -> columns) and orphans of ``references``
    (child, column, parent, parent column), all from one shuffle.

    A *domain* is a key that is declared or referred to: a parent's column, or a table's key columns.
    Each table is scanned once and gives, per row, a tagged key for each role it plays: slot 0 of a
    domain holds the rows of its owner, the other slots those of its children. The tagged keys are
    counted per (domain, key) with map-side combining, so a hot value costs one row per task, and
    from the counts of a key all its checks follow: rows beyond the first are duplicates, child rows
    where the owner has none are orphans. NULL keys are equal to each other as declared keys and
    refer to nothing as children. A second, tiny aggregate adds the keys up.
    """
    domains: dict[tuple[str, tuple[str, ...]], int] = {}
    roles: dict[str, list[tuple[int, int, tuple[str, ...]]]] = {}
    slots: dict[int, int] = {}
    report: list[tuple[int, int, str, str, str]] = []  # domain, slot, table, check, column

    def owner(table: str, columns: tuple[str, ...]) -> int:
        if (table, columns) not in domains:
            domains[table, columns] = d = len(domains)
            slots[d] = 1
            roles.setdefault(table, []).append((d, 0, columns))
        return domains[table, columns]

    for table, columns in unique.items():
        report.append((owner(table, tuple(columns)), 0, table, "no_duplicates", ",".join(columns)))
    for child, column, parent, parent_column in references:
        d = owner(parent, (parent_column,))
        report.append((d, slots[d], child, f"foreign_key->{parent}.{parent_column}", column))
        roles.setdefault(child, []).append((d, slots[d], (column,)))
        slots[d] += 1
    width = max(slots.values())

    def tagged(table: str) -> DataFrame:
        tags = []
        for d, slot, columns in roles[table]:
            texts = [F.col(c).cast("string") for c in columns]
            # One column is its own text; several are told apart by their lengths.
            key = texts[0] if len(texts) == 1 else F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in texts])
            tag = F.struct(F.lit(d).alias("domain"), F.lit(slot).alias("slot"), key.alias("key"))
            tags.append(tag if slot == 0 else F.when(F.col(columns[0]).isNotNull(), tag))
        return tables[table].select(F.explode(F.array_compact(F.array(*tags))).alias("t")).select("t.*")

    keys = reduce(DataFrame.unionByName, [tagged(t) for t in roles])
    counts = keys.groupBy("domain", "key").agg(*[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(width)])
    sums = [F.sum(F.when(F.col("n0") > 0, F.col("n0") - 1).otherwise(0)).alias("bad0"), F.sum("n0").alias("total0")]
    for i in range(1, width):
        sums += [F.sum(F.when(F.col("n0") == 0, F.col(f"n{i}")).otherwise(0)).alias(f"bad{i}"), F.sum(f"n{i}").alias(f"total{i}")]
    per_domain = counts.groupBy("domain").agg(*sums)
    # A row per report line; a domain without any key (empty tables) has no counts.
    spark = per_domain.sparkSession
    lines = spark.createDataFrame([(n, *line) for n, line in enumerate(report)],
                                  "line int, domain int, slot int, table_name string, check_name string, column_name string")
    pick = lambda what: reduce(lambda rest, i: F.when(F.col("slot") == i, F.col(f"{what}{i}")).otherwise(rest), range(width), F.lit(None))
    failing, total = (F.coalesce(pick(w), F.lit(0)).cast("long") for w in ("bad", "total"))
    return lines.join(per_domain, "domain", "left").select(
        "table_name", "check_name", "column_name", failing.alias("failing"), total.alias("total"),
        F.when(total > 0, failing.cast("double") * 100.0 / total).alias("failing_pct"), (failing == 0).alias("passed"),
        F.lit(severity).alias("severity"))


def primary_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q6: uniqueness of every declared primary key among the given tables, in one shuffle."""
    return key_report(tables, {name: schemas.PRIMARY_KEYS[name] for name in tables if name in schemas.PRIMARY_KEYS})


def foreign_key(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
                child_table: str, parent_table: str, severity: str = WARN) -> DataFrame:
    """Q7: non-null child values that have no parent row (orphans).

    Both sides are reduced before the join: the child to one row per distinct
    value with its row count, the parent to its distinct keys (each combined
    map-side first). The join then sees unique keys on both sides, so a value
    referenced by a third of all child rows costs one row, and the two
    aggregate outputs are already partitioned on the key (no further shuffle).
    """
    probe = (child.where(F.col(child_col).isNotNull())
             .groupBy(F.col(child_col).alias("_fk"))
             .agg(F.count(F.lit(1)).alias("_n")))
    keys = parent.select(F.col(parent_col).alias("_pk")).distinct().withColumn("_hit", F.lit(True))
    joined = probe.join(keys, probe["_fk"] == keys["_pk"], "left")
    agg = joined.agg(
        F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0)).alias("_orphans"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"))
    return _report(agg, [_row(child_table, f"foreign_key->{parent_table}.{parent_col}",
                              child_col, F.col("_orphans"), F.col("_total"), severity)])


def declared_references(tables: Mapping[str, DataFrame]) -> list[tuple[str, str, str, str]]:
    return [fk for fk in schemas.FOREIGN_KEYS if fk[0] in tables and fk[2] in tables]


def foreign_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q7 over every declared constraint whose two tables are given, in one shuffle."""
    return key_report(tables, {}, declared_references(tables))


def source_references(sources: Mapping[str, DataFrame]) -> list[tuple[str, str, str, str]]:
    return [(child, ccol, parent, pcol) for child, edges in schemas.RELATIONSHIPS.items()
            for ccol, (parent, pcol) in edges.items() if child in sources and parent in sources]


def relationships(sources: Mapping[str, DataFrame]) -> DataFrame:
    """E5/Q7: the business relationships between the raw source tables, in one shuffle."""
    return key_report(sources, {}, source_references(sources))


def all_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q6, Q7 and E5 over the 24 tables: every declared key, constraint and source relationship,
    with one scan of each table and one shuffle of its keys."""
    unique = {name: schemas.PRIMARY_KEYS[name] for name in tables if name in schemas.PRIMARY_KEYS}
    sources = [(f"bronze_{c}", cc, f"bronze_{p}", pc) for c, cc, p, pc in
               source_references({s: None for s in schemas.SOURCE_NAMES if f"bronze_{s}" in tables})]
    return key_report(tables, unique, declared_references(tables) + sources)


def not_null(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q8: NOT NULL columns of the declared schema."""
    return scan_report(tables, [c for name in tables for c in null_checks(schemas.not_null_columns(name), name)])


def domain(df: DataFrame, table: str, severity: str = WARN) -> DataFrame:
    """Q9: UNSIGNED columns are >= 0 and text fits its declared length.

    Every declared check is reported; a missing column fails.
    """
    return table_report(df, domain_checks(table, severity))


def domains(tables: Mapping[str, DataFrame]) -> DataFrame:
    return scan_report(tables, [c for name in tables for c in domain_checks(name)])


def suite_checks(min_rows: int = 1000) -> list[Check]:
    """The row checks of the three layer suites."""
    return bronze_checks(min_rows) + silver_checks() + gold_checks(min_rows)


def one_pass(tables: Mapping[str, DataFrame], min_rows: int = 1000) -> DataFrame:
    """Q1, Q2, Q4, Q5, Q8 and Q9: every row check of every table, with one scan of each table."""
    return scan_report(tables, [c for name in tables for c in catalogue_checks(name)] + [c for c in suite_checks(min_rows) if c.table in tables])


# ---------------------------------------------------------------------------
# Q10: table profile
# ---------------------------------------------------------------------------


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """Rows, columns and per-column non-null counts, in one pass."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    rows = [F.struct(
        F.lit(table).alias("table_name"),
        F.lit(i + 1).alias("position"),
        F.lit(c).alias("column_name"),
        F.col(f"_c{i}").alias("non_null_count"),
        (F.col("_rows") - F.col(f"_c{i}")).alias("null_count"),
        F.col("_rows").alias("row_count"),
        F.lit(len(cols)).alias("column_count"),
    ) for i, c in enumerate(cols)]
    return agg.select(F.inline(F.array(*rows)))
