"""Content fingerprints: an order-free multiset hash of a table's rows.

A row's canonical text lists its columns in the table's order, each as ``length:text`` (so no
two rows share a text), ``~`` for NULL. The row's hash is the first 60 bits of that text's MD5; a
table's fingerprint is the exact sum of its rows' hashes beside their count. Sums do not
depend on the order of rows, files or tasks, count repeated rows, and add up over parts, so
a fingerprint is one map-side combined aggregate, or an observation of a job that
writes the table anyway (``metrics``). Any SQL engine with MD5 can compute the same value.

Canonical text of a value: text as it is; integers in decimal digits; booleans ``true`` or
``false``; timestamps as microseconds since 1970; decimals with all their places and no exponent
(ANSI mode, which the session sets); doubles as decimals of ``DOUBLE_PLACES`` places (NaN and
infinities by name).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Places kept of a double: the finest scale of the model (coordinates).
DOUBLE_PLACES = 7
HASH_DIGITS = 15
#: The column of a row's hash (``with_row_hash``).
ROW_HASH = "_row_hash"


def canonical(name: str, dtype: T.DataType) -> Column:
    """The value's text; NULL stays NULL."""
    c = F.col(f"`{name}`")
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "true").when(~c, "false")
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c.cast("timestamp_ntz")).cast("string")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        finite = ~F.isnan(c) & (F.abs(c) != float("inf"))
        return F.when(finite, c.cast(T.DecimalType(30, DOUBLE_PLACES)).cast("string")).otherwise(F.lower(c.cast("string")))
    return c.cast("string")


def _hash_of(texts: list[Column]) -> Column:
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in texts]
    digits = F.substring(F.md5(F.concat(*parts)), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("long")


def row_hash(schema: T.StructType) -> Column:
    """60 bits of the row's canonical text, as a long."""
    return _hash_of([canonical(f.name, f.dataType) for f in schema.fields])


def with_row_hash(df: DataFrame) -> DataFrame:
    """The frame with its rows' hashes as a last column, ``ROW_HASH``.

    Texts and hash are projections of their own, so each is computed once a row: inside an
    aggregate or an observation the text is made again for its length and the hash for each of
    the buffers that a decimal sum updates.
    """
    texts = {f"_text{i}": canonical(f.name, f.dataType) for i, f in enumerate(df.schema.fields)}
    return df.select("*", *[t.alias(n) for n, t in texts.items()]).select(
        *[f"`{c}`" for c in df.columns], _hash_of([F.col(n) for n in texts]).alias(ROW_HASH))


def metrics(schema: T.StructType) -> list[Column]:
    """``row_count`` and ``content_hash`` as aggregates, for ``agg`` or ``observe``; of a frame that
    has its ``ROW_HASH``, the hashes are summed as they are."""
    hashes = F.col(ROW_HASH) if ROW_HASH in schema.names else row_hash(schema)
    total = F.sum(hashes.cast("decimal(20,0)"))
    return [F.count(F.lit(1)).alias("row_count"), F.coalesce(total, F.lit(0)).cast("string").alias("content_hash")]


def fingerprint(df: DataFrame, table: str, **labels: str) -> DataFrame:
    """One row: table_name, the labels, row_count and content_hash."""
    hashed = with_row_hash(df)
    return hashed.agg(*metrics(hashed.schema)).select(
        F.lit(table).alias("table_name"), *[F.lit(v).alias(k) for k, v in labels.items()], "row_count", "content_hash")


def fingerprints(tables: Mapping[str, DataFrame], labels: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
    """The fingerprint of every table, one scan each."""
    return reduce(DataFrame.unionByName, [fingerprint(df, name, **(labels or {}).get(name, {})) for name, df in tables.items()])
