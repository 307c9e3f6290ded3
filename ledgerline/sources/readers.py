"""Readers for landed source files.

All readers take an explicit schema (no inference pass over the data) and are
lazy. Formats:

* CSV: header row, comma, RFC quotes with doubled quotes; ``multi_line`` for files
  whose quoted fields contain newlines, where they are small (it reads each
  file in one piece; ``sources.quoted`` splits them). A UTF-8 byte-order mark before the
  header is dropped by Spark's reader.
* JSON: JSON Lines by default (splittable); ``multi_line`` for files holding
  one JSON array or document.
* JSON envelope: payloads of the form ``{"value": [records...]}`` (one page per
  line or file) as well as plain records, read in one pass.
* Parquet.
"""

from __future__ import annotations

import posixpath
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas

# Text values read as missing, like a default pandas CSV read (fixed values).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Sources with free text in quotes.
MULTI_LINE = {"order_reviews"}

SUPPORTED_SUFFIXES = {".csv": "csv", ".json": "json", ".parquet": "parquet"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False,
             encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header, quoted fields and a given schema."""
    return (spark.read.schema(schema)
            .option("header", True)
            .option("sep", ",")
            .option("quote", '"')
            .option("escape", '"')
            .option("multiLine", multi_line)
            .option("encoding", encoding)
            .option("mode", "PERMISSIVE")
            .csv(path))


def read_csv_latin1(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV encoded as ISO-8859-1."""
    return read_csv(spark, path, schema, encoding="ISO-8859-1")


def read_json(spark: SparkSession, path: str, schema: T.StructType,
              multi_line: bool = False) -> DataFrame:
    """JSON records (JSON Lines, or one array per file with ``multi_line``)."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3."""
    return spark.read.parquet(path)


def read_json_envelope(spark: SparkSession, path: str, record_schema: T.StructType,
                       multi_line: bool = False) -> DataFrame:
    """Rows of ``{"value": [...]}`` envelopes, or the records themselves.

    The file is read once with a schema holding both shapes: a row's records are
    those of its envelope, or else the row itself. An object without any declared
    field (``{"value": null}``, ``{}``) holds no record. Each envelope is
    one page of a paged payload, so no single row carries the whole table.
    """
    both = T.StructType([T.StructField("value", T.ArrayType(record_schema)), *record_schema.fields])
    raw = spark.read.schema(both).option("multiLine", multi_line).json(path)
    names = record_schema.fieldNames()
    some = F.lit(False)
    for name in names:
        some = some | F.col(name).isNotNull()
    alone = F.when(some, F.array(F.struct(*names)))  # null: inline gives no row
    return raw.select(F.inline(F.coalesce("value", alone))).select(*names)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def suffix_of(path: str) -> str:
    return posixpath.splitext(path.rstrip("/"))[1].lower()


def read_by_suffix(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   **options) -> DataFrame:
    """Pick the reader from the lower-cased suffix.

    An unsupported suffix raises ``ValueError`` (checked first); a missing
    path raises ``FileNotFoundError``.
    """
    suffix = suffix_of(path)
    fmt = SUPPORTED_SUFFIXES.get(suffix)
    if fmt is None:
        raise ValueError(f"unsupported file format {suffix!r}: {path}")
    if not path_exists(spark, path):
        raise FileNotFoundError(f"file not found: {path}")
    if fmt == "parquet":
        df = read_parquet(spark, path)
        return df.select(*schema.fieldNames()) if schema is not None else df
    if schema is None:
        raise ValueError(f"a schema is required to read {fmt} without inference: {path}")
    if fmt == "csv":
        return read_csv(spark, path, schema, **options)
    return read_json(spark, path, schema, **options)


def newest_entry(spark: SparkSession, root: str, suffixes: set[str] | None = None,
                 ignore_dirs: list[str] | None = None) -> str:
    """The most recently modified dataset under ``root``.

    A dataset is a single landed file at any depth, or the directory of a set of
    ``part-`` files (above any ``key=value`` level; its time is that of its newest
    file). Files are found recursively; suffixes match case-insensitively; entries
    inside ``ignore_dirs`` are skipped. The listing runs as a Spark job over file
    metadata (``_metadata``), and only the winning path returns to the driver.
    """
    allowed = sorted({s.lower() for s in (suffixes or set(SUPPORTED_SUFFIXES))})
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", "true")
             .load(root)
             .select(F.col("path").alias("file_path"),
                     F.col("modificationTime").alias("mtime")))
    base = files.select(F.regexp_extract("file_path", r"^(.*?)/?$", 1).alias("p"), "mtime")
    root_uri = _qualified(spark, root).rstrip("/")
    rel = F.substring(F.col("p"), len(root_uri) + 2, 1 << 30)
    whole = F.regexp_replace("rel", r"(/[^/=]+=[^/]*)*/part-[^/]*$", "")
    candidates = base.withColumn("rel", rel).withColumn("top", whole)
    ok: Column = F.lit(False)
    name = F.lower(F.regexp_extract("rel", r"([^/]+)$", 1))
    for s in allowed:
        ok = ok | name.endswith(s) | F.lower(F.col("top")).endswith(s)
    for d in ignore_dirs or []:
        prefix = _qualified(spark, d).rstrip("/") + "/"
        ok = ok & ~F.col("p").startswith(prefix)
    ok = ok & ~F.col("rel").rlike(r"(^|/)[._][^/]*$")  # hidden / marker files
    best = (candidates.where(ok)
            .groupBy("top").agg(F.max("mtime").alias("mtime"))
            .agg(F.max_by("top", F.struct("mtime", "top")).alias("top"))
            .first())
    if best is None or best["top"] is None:
        raise FileNotFoundError(f"no supported file found under {root}")
    return f"{root_uri}/{best['top']}"


def _qualified(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return str(fs.makeQualified(hpath).toString())


def coerce_timestamps(df: DataFrame, cols: list[str]) -> DataFrame:
    """Parse text timestamps; unparseable text becomes NULL (no error)."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c).cast("string")) for c in cols
                           if c in df.columns})


def restore_integers(df: DataFrame, cols: list[str]) -> DataFrame:
    """Integer columns read as double (``"12.0"``) back to 64-bit integers, which hold the
    whole unsigned 32-bit range. A fraction, or a value beyond 64 bits, fails the job."""
    def whole(c: str) -> Column:
        bad = F.raise_error(F.concat(F.lit(f"{c} is not an integer: "), F.col(c).cast("string"))).cast("long")
        return F.when(F.col(c).isNull() | (F.col(c) == F.floor(c)), F.col(c).cast("long")).otherwise(bad)

    kinds = dict(df.dtypes)
    return df.withColumns({c: whole(c) for c in cols if kinds.get(c) in ("double", "float")})


def normalize_null_tokens(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Missing-value tokens in text columns become NULL (one projection)."""
    tokens = NULL_TOKENS if tokens is None else tokens
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(tokens), F.col(c)) for c in text_cols})


def require_files(spark: SparkSession, base: str, files: Mapping[str, str]) -> None:
    """Report all missing files of a dataset in one error."""
    base = base.rstrip("/")
    missing = [f for f in files.values() if not path_exists(spark, f"{base}/{f}")]
    if missing:
        raise FileNotFoundError(f"required files not found in {base}: {missing}")


def load_dataset(spark: SparkSession, base: str, files: dict[str, str],
                 schemas_by_table: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """The nine-table dataset. All missing files are reported in one error
    before anything is read. Text sources have their null tokens removed (S10) and
    text timestamps coerced (S9); ``MULTI_LINE`` sources, whose free text may hold quoted
    newlines, are split like the others (``sources.quoted``)."""
    require_files(spark, base, files)
    base = base.rstrip("/")
    tables = {}
    for name, fname in files.items():
        schema = (schemas_by_table or {}).get(name)
        if schema is None and suffix_of(fname) != ".parquet":
            schema = schemas.raw_schema(name)
        suffix = suffix_of(fname)
        if suffix == ".csv" and name in MULTI_LINE:
            from ledgerline.sources.quoted import read_csv_quoted

            df = read_csv_quoted(spark, f"{base}/{fname}", schema)
        else:
            df = read_by_suffix(spark, f"{base}/{fname}", schema)
        if suffix != ".parquet":
            df = normalize_null_tokens(df)
        df = restore_integers(df, schemas.INTEGER_COLUMNS.get(name, []))
        tables[name] = coerce_timestamps(df, schemas.TIMESTAMP_COLUMNS.get(name, []))
    return tables
