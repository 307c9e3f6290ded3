"""Sinks: conform to the declared schema, layered full refresh, JDBC, views.

Full refresh is published atomically per run: every table of the run is
written under ``<root>/runs/<run_id>/<layer>/<table>``, in dependency order,
and only then is the run published (``sinks.runs``). Readers resolve the latest
publish record, so they never see a half-written run, and a failed run (or a
lost executor that makes a job fail) leaves the previous run published. Tables
that depend on a written table read it back instead of recomputing it, which
also cuts the lineage. A restarted run goes on where the last one stopped.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.operators import fingerprint
from ledgerline.session import runs_sink, sink_conf
from ledgerline.sinks import runs
from ledgerline.sinks.runs import TableRecord, current_run
from ledgerline.sources.rejects import CheckedDataset, enforce_limits
from ledgerline.tables import LazyTables

#: Codec of the tables that sinks write: a quarter smaller than Parquet's default here, in the same time.
CODEC = "zstd"

# ---------------------------------------------------------------------------
# K4 / K5: conform
# ---------------------------------------------------------------------------


def conform_columns(df: DataFrame, table: str) -> DataFrame:
    """Project to the declared column list and order; a missing column raises."""
    wanted = schemas.columns(table)
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"[{table}] missing columns: {missing}")
    return df.select(*wanted)


def conform_types(df: DataFrame, table: str) -> DataFrame:
    """Cast every column to its declared sink type.

    Decimal casts round half-up; under ANSI mode an overflow raises rather
    than writing NULL.
    """
    fields = schemas.TABLES[table].fields
    return conform_columns(df, table).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in fields])


# ---------------------------------------------------------------------------
# K6: catalog tables
# ---------------------------------------------------------------------------


def ddl_of(schema: T.StructType) -> str:
    """Column definitions with their declared lengths (``VARCHAR(n)``) and NOT NULL."""
    def kind(f: T.StructField) -> str:
        limit = f.metadata.get("max_length")
        return f"VARCHAR({limit})" if limit and isinstance(f.dataType, T.StringType) else f.dataType.simpleString()

    return ", ".join(f"`{f.name}` {kind(f)}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)


def enforced(df: DataFrame, table: str) -> DataFrame:
    """The conformed frame whose rows must keep the declared NOT NULL, length and UNSIGNED rules.

    The first row that breaks one fails the job, with the table, the column and the value named.
    Data-source tables keep NOT NULL as a comment only, and Spark's own length check names no column.
    """
    def kept(f: T.StructField) -> Column:
        c, limit = F.col(f.name), f.metadata.get("max_length")
        fail = lambda what: F.raise_error(F.concat(F.lit(f"[{table}] {f.name} {what}"), F.coalesce(F.concat(F.lit(": "), c.cast("string")), F.lit("")))).cast(f.dataType)
        out = c
        if f.metadata.get("unsigned"):
            out = F.when(c < 0, fail("is negative")).otherwise(out)
        if limit and isinstance(f.dataType, T.StringType):
            out = F.when(F.length(c) > limit, fail(f"is longer than {limit}")).otherwise(out)
        if not f.nullable:
            out = F.when(c.isNull(), fail("is null")).otherwise(out)
        return out.alias(f.name, metadata=f.metadata)

    return conform_types(df, table).select(*[kept(f) for f in schemas.TABLES[table].fields])


def create_layer_tables(spark: SparkSession, root: str, database_prefix: str = "ledgerline",
                        layers: tuple[str, ...] = ("bronze", "silver", "gold")) -> dict[str, str]:
    """Create one database per layer and every declared table, idempotently.

    Returns ``{table: qualified name}``. Tables are Parquet data-source tables
    located under ``root``.
    """
    created = {}
    for layer in layers:
        db = f"{database_prefix}_{layer}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root.rstrip('/')}/{layer}'")
        for table, schema in schemas.LAYERS[layer].items():
            spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{table} ({ddl_of(schema)}) USING parquet")
            created[table] = f"{db}.{table}"
    return created


def table_location(spark: SparkSession, qualified_table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified_table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def insert_full_refresh(df: DataFrame, qualified_table: str, table: str) -> None:
    """Replace the contents of a catalog table with the conformed frame, whose rows must keep the declared rules.

    The rows are written and checked once, in a new folder beside the table's; then the table is pointed
    to it and the earlier folder deleted. A row that is refused leaves the earlier contents in place, and
    the new rows are written once.
    """
    spark = df.sparkSession
    earlier = table_location(spark, qualified_table)
    path = f"{earlier.rstrip('/').rpartition('/')[0]}/{table}-{uuid.uuid4().hex[:12]}"
    with sink_conf(spark):
        try:
            enforced(df, table).write.option("compression", CODEC).parquet(path)
        except Exception:
            _delete(spark, path)
            raise
    spark.sql(f"ALTER TABLE {qualified_table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(qualified_table)
    _delete(spark, earlier)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


# ---------------------------------------------------------------------------
# K1 / K2: published layered runs
# ---------------------------------------------------------------------------

# Sources whose Bronze copy is rounded by the sink types before Silver needs them.
FULL_PRECISION_SOURCES = {"geolocation"}


def read_published(spark: SparkSession, root: str, table: str, run_id: str | None = None) -> DataFrame:
    """A table of a run (the current one by default), with its declared columns in order."""
    run_id = run_id or current_run(spark, root)
    return spark.read.schema(schemas.TABLES[table]).parquet(runs.table_path(root, run_id, table)).select(*schemas.columns(table))


def laid_out(df: DataFrame, table: str) -> DataFrame:
    """Rows of a month-partitioned table gathered by month, so that a task does not write a file for
    each month; Spark splits the months that are large. Other tables stay as they are."""
    month = schemas.PARTITIONED.get(table)
    return df.hint("rebalance", F.col(month)) if month else df


def write_table(df: DataFrame, path: str, table: str, mode: str = "overwrite") -> None:
    """Write a conformed frame in its table's layout.

    ``mode="months"`` replaces only the months that ``df`` holds (dynamic partition overwrite)
    and needs a month-partitioned table.
    """
    month = schemas.PARTITIONED.get(table)
    if mode == "months" and not month:
        raise ValueError(f"{table} is not partitioned by month")
    writer = (df.write.mode("overwrite").option("compression", CODEC)
              .option("partitionOverwriteMode", "dynamic" if mode == "months" else "static"))
    (writer.partitionBy(month) if month else writer).parquet(path)


def replace_months(df: DataFrame, path: str, table: str) -> None:
    """Replace the months that ``df`` holds in a month-partitioned table; other months keep their files."""
    write_table(laid_out(conform_types(df, table), table), path, table, mode="months")


def read_months(spark: SparkSession, path: str, table: str, months: Sequence[str | None]) -> DataFrame:
    """Rows of the given months (None: rows without one). Only those months' files are listed and read."""
    month = F.col(schemas.PARTITIONED[table])
    wanted = month.isin([m for m in months if m is not None])
    if None in months:
        wanted = wanted | month.isNull()
    return spark.read.schema(schemas.TABLES[table]).parquet(path).where(wanted).select(*schemas.columns(table))


def _observed_write(df: DataFrame, path: str, table: str, checks: Sequence) -> dict[str, int | str]:
    """Write a table; its fingerprint and what its checks count are observed by the same job.

    The observation sits above the layout's shuffle, in the job's last stage, where a task that is
    run again counts once.
    """
    from ledgerline.operators.quality import check_metrics

    seen = Observation()
    plain = laid_out(conform_types(df, table), table)
    hashed = fingerprint.with_row_hash(plain)
    observed = hashed.observe(seen, *fingerprint.metrics(hashed.schema), *check_metrics(checks, plain.columns))
    write_table(observed.drop(fingerprint.ROW_HASH), path, table)
    return seen.get


def _digest(*parts: str) -> str:
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def source_version(spark: SparkSession, df: DataFrame) -> str:
    """What a source is made of: its files with their sizes and times, and how they are read.

    A source without files has no version and is read again by every run. Listing costs
    file-system metadata only."""
    files = sorted(df.inputFiles())
    if not files:
        return uuid.uuid4().hex
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    stats = []
    for name in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        status = path.getFileSystem(conf).getFileStatus(path)
        stats.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return _digest(df.schema.json(), *stats)


@runs_sink
def full_refresh(spark: SparkSession, sources: Mapping[str, DataFrame], root: str,
                 layers: tuple[str, ...] = ("bronze", "silver", "gold"),
                 validate: bool = True, min_rows: int = 1000,
                 run_id: str | None = None, parallel_writes: int = 4,
                 versions: Mapping[str, str] | None = None, based_on: int | None = None,
                 keep_runs: int | None = None, stop_after: str | None = None) -> dict[str, DataFrame]:
    """K1: build and write every table of ``layers`` as a run, then publish it.

    Order: Bronze is written and checked, then Silver (built from the written
    Bronze), then Gold (built from the written Silver). The jobs that write the
    tables observe their content fingerprints and everything the layer's checks
    count, so checking scans nothing; only uniqueness needs a job of its own. A failing row-count floor raises before
    anything is published, leaving the previous run current. Gold is built from the
    written Silver tables, and the order fact is kept once in working types so
    the item fact and the monthly aggregate read it instead of recomputing it.
    Tables of layers not requested are written empty (K2 clears Gold this way).
    The tables of a layer are written by up to ``parallel_writes`` concurrent
    jobs. Returns the Gold tables read back from the run.

    Resuming: each finished table leaves a record of what it was made from. Called
    again with the ``run_id`` of a run that stopped, tables whose inputs are unchanged are not
    written again. A source's version is taken from its files, or from ``versions`` (name -> any text
    that changes with the source); a Silver or Gold table's inputs are the fingerprints of the tables it reads.
    ``stop_after`` ends the run after that layer, unpublished, to be looked at and taken up later.

    ``based_on`` makes publishing conditional on that record being the last one
    (``runs.publish``); ``keep_runs`` expires older runs afterwards (``runs.expire_runs``).

    Sources read with a reject channel (``sources.rejects``) are held to its limits once Bronze is
    written; the lines of tables that have rejects are kept in the run.
    """
    from ledgerline.operators import gold as gold_ops
    from ledgerline.operators import quality
    from ledgerline.operators.silver import build_bronze, build_silver

    run_id = run_id or uuid.uuid4().hex
    records: dict[str, TableRecord] = {}
    checks = quality.checks_by_table(quality.suite_checks(min_rows)) if validate else {}

    def written(table: str) -> DataFrame:
        return read_published(spark, root, table, run_id)

    def written_layer(order: list[str], strip: str = "") -> LazyTables:
        return LazyTables({t.removeprefix(strip): (lambda t=t: written(t)) for t in order})

    def inputs_of(layer: str, table: str) -> str:
        if layer not in layers:
            return _digest(table, "empty")
        if layer == "bronze":
            name = table.removeprefix("bronze_")
            return _digest(table, (versions or {}).get(name) or source_version(spark, sources[name]))
        made_from = [t for t in schemas.INPUTS[table] if t in records]
        outside = [] if made_from else [uuid.uuid4().hex]  # Silver straight from sources that no record names
        full = [(versions or {}).get(n) or source_version(spark, sources[n]) for n in FULL_PRECISION_SOURCES if f"bronze_{n}" in made_from]
        return _digest(table, *[records[t].content_hash + str(records[t].row_count) for t in made_from], *full, *outside)

    def finished(layer: str, table: str) -> TableRecord | None:
        """The record of a table that an earlier attempt wrote from the same inputs, with all that is to be checked."""
        done = runs.recorded_table(spark, root, run_id, table)
        counted = {f"_f{i}" for i, c in enumerate(checks.get(table, [])) if c.floor is None}
        return done if done and done.inputs == inputs_of(layer, table) and set(done.checks) >= counted else None

    def write_one(layer: str, frames: Mapping[str, DataFrame], table: str) -> None:
        done = finished(layer, table)
        if done is None:
            frame = frames[table] if layer in layers else spark.createDataFrame([], schemas.TABLES[table])
            seen = _observed_write(frame, runs.table_path(root, run_id, table), table, checks.get(table, []))
            counts = {k: v for k, v in seen.items() if k not in ("row_count", "content_hash")}
            rejected = sources.table(table.removeprefix("bronze_")).counts() if layer == "bronze" and isinstance(sources, CheckedDataset) else ()
            done = TableRecord(table, inputs_of(layer, table), seen["row_count"], seen["content_hash"], counts, rejected)
            runs.record_table(spark, root, run_id, done)
        records[table] = done

    def write_layer(layer: str, frames: Mapping[str, DataFrame], order: list[str]) -> None:
        # Tables of one layer only depend on earlier layers, so their jobs are
        # submitted together; the first failure is raised after all finished.
        if parallel_writes <= 1:
            for table in order:
                write_one(layer, frames, table)
            return
        with ThreadPoolExecutor(max_workers=parallel_writes) as pool:
            futures = [pool.submit(write_one, layer, frames, t) for t in order]
        for f in futures:
            f.result()

    def enforce(layer: str) -> None:
        for table, some in checks.items():
            if schemas.layer_of(table) == layer:
                quality.enforce(quality.observed_report(spark, some, records[table].checks))

    write_layer("bronze", build_bronze(sources) if "bronze" in layers else {}, schemas.BRONZE_ORDER)
    if "bronze" in layers and isinstance(sources, CheckedDataset):
        counts = [tuple(row) for t in schemas.BRONZE_ORDER for row in records[t].rejects]
        if some := sorted({table for table, _, _, rejected, _ in counts if rejected}):
            sources.lines(spark, some).write.mode("overwrite").parquet(runs.rejects_path(root, run_id))
        enforce_limits(counts, sources.limits)
    if validate and "bronze" in layers:
        enforce("bronze")
        quality.enforce(quality.key_report(written_layer(schemas.BRONZE_ORDER), quality.BRONZE_KEYS))

    if stop_after == "bronze":
        return {}

    # Silver reads the written Bronze (parsed once, columnar, pruned), except
    # geolocation: Bronze keeps coordinates at 7 places and the per-zip mean
    # must use the full-precision inputs.
    if "bronze" in layers:
        silver_inputs: Mapping[str, DataFrame] = LazyTables({
            n: (lambda n=n: sources[n] if n in FULL_PRECISION_SOURCES
                else written(f"bronze_{n}"))
            for n in sources})
    else:
        silver_inputs = sources
    write_layer("silver", build_silver(silver_inputs) if "silver" in layers else {},
                schemas.SILVER_ORDER)
    if validate and "silver" in layers:
        enforce("silver")
    if stop_after == "silver":
        return {}

    gold: Mapping[str, DataFrame] = {}
    order_duplicates = None
    if "gold" in layers:
        work = runs.work_path(root, run_id, "gold_fct_orders")
        if "silver" in layers:
            silver = written_layer(schemas.SILVER_ORDER, "silver_")
        else:
            silver = build_silver(sources, strip_prefix=True)
        facts = ("gold_fct_orders", "gold_fct_order_items", "gold_agg_sales_monthly")
        if any(finished("gold", t) is None for t in facts):
            gold_ops.gold_fct_orders(silver).write.mode("overwrite").option("compression", CODEC).parquet(work)
            fct = spark.read.parquet(work)
            # The Gold suite checks order_id uniqueness anyway: do it once here (one
            # column read back) and let the monthly aggregate use the result.
            order_duplicates = spark.createDataFrame([quality.no_duplicates(fct, ["order_id"], "gold_fct_orders").first()], quality.REPORT_SCHEMA)
            unique_ids = order_duplicates.first()["failing"] == 0
        gold = LazyTables({
            "gold_dim_customers": lambda: gold_ops.gold_dim_customers(silver),
            "gold_dim_products": lambda: gold_ops.gold_dim_products(silver),
            "gold_dim_sellers": lambda: gold_ops.gold_dim_sellers(silver),
            "gold_fct_orders": lambda: fct,
            "gold_fct_order_items": lambda: gold_ops.gold_fct_order_items(silver, fct),
            "gold_agg_sales_monthly": lambda: gold_ops.gold_agg_sales_monthly(
                fct, unique_order_ids=unique_ids),
        })
    write_layer("gold", gold, schemas.GOLD_ORDER)
    if validate and "gold" in layers:
        enforce("gold")
        if order_duplicates is None:
            order_duplicates = quality.key_report(written_layer(schemas.GOLD_ORDER), quality.GOLD_KEYS)
        quality.enforce(order_duplicates)

    runs.publish(spark, root, run_id, based_on)
    runs.drop_work(spark, root, run_id)
    if keep_runs:
        runs.expire_runs(spark, root, keep_runs)
    return {t: written(t) for t in schemas.GOLD_ORDER}


def layer_subset_refresh(spark: SparkSession, sources: Mapping[str, DataFrame], root: str,
                         run_id: str | None = None) -> dict[str, DataFrame]:
    """K2: publish Bronze and Silver without checks; Gold is published empty.
    Returns Silver (un-prefixed) read back from the run."""
    run_id = run_id or uuid.uuid4().hex
    full_refresh(spark, sources, root, layers=("bronze", "silver"), validate=False, run_id=run_id)
    return {t.removeprefix("silver_"): read_published(spark, root, t, run_id)
            for t in schemas.SILVER_ORDER}


def published_fingerprints(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    """(table_name, layer, row_count, content_hash) of every table of a published run, read back."""
    run_id = run_id or current_run(spark, root)
    return fingerprint.fingerprints(LazyTables({t: (lambda t=t: read_published(spark, root, t, run_id)) for t in schemas.LOAD_ORDER}),
                                    {t: {"layer": schemas.layer_of(t)} for t in schemas.LOAD_ORDER})


def published_row_counts(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    """(table_name, layer, row_count) of every table of a published run."""
    return published_fingerprints(spark, root, run_id).drop("content_hash")


def run_rejects(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """(table_name, reason, column_name, rejected, total): what a run's Bronze writes counted, from its records."""
    from ledgerline.sources.rejects import COUNT_SCHEMA

    rows = [tuple(row) for t in schemas.BRONZE_ORDER if (r := runs.recorded_table(spark, root, run_id, t)) for row in r.rejects]
    return spark.createDataFrame(rows, COUNT_SCHEMA)


def changed_tables(spark: SparkSession, root: str, run_id: str | None = None) -> list[str]:
    """Tables of a run whose files no longer hold what their records say."""
    run_id = run_id or current_run(spark, root)
    out = []
    for r in published_fingerprints(spark, root, run_id).collect():
        record = runs.recorded_table(spark, root, run_id, r["table_name"])
        if record is None or (record.row_count, record.content_hash) != (r["row_count"], r["content_hash"]):
            out.append(r["table_name"])
    return out


# ---------------------------------------------------------------------------
# K3: JDBC
# ---------------------------------------------------------------------------


def jdbc_options(table: str, batch_size: int = 1000, num_partitions: int | None = None,
                 truncate: bool = True, **extra: str) -> dict[str, str]:
    opts = {"dbtable": table, "batchsize": str(batch_size), "truncate": str(truncate).lower()}
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    opts.update(extra)
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000,
               num_partitions: int | None = None, properties: dict[str, str] | None = None) -> None:
    """K3: replace a JDBC table's rows with the conformed frame, in batches.

    ``truncate`` keeps the existing table definition (keys, indexes);
    ``numPartitions`` bounds the number of concurrent connections.
    """
    opts = jdbc_options(table, batch_size, num_partitions, **(properties or {}))
    (conform_types(df, table).write.format("jdbc").option("url", url).options(**opts)
     .mode("overwrite").save())


# ---------------------------------------------------------------------------
# K7: SQL views
# ---------------------------------------------------------------------------


def register_views(tables: Mapping[str, DataFrame], strip: str = "") -> list[str]:
    """Register frames as temp views (replacing same-named ones)."""
    names = []
    for name, df in tables.items():
        view = name.removeprefix(strip) if strip else name
        df.createOrReplaceTempView(view)
        names.append(view)
    return names
