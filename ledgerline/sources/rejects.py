"""The reject channel: what a landed dataset holds that the model cannot take.

A table read through it keeps, beside its declared columns, what was wrong with each line:

* ``broken_line``: too few or too many fields. Such a line is not loaded.
* ``bad_timestamp``, ``bad_integer``, ``bad_number``: a text that is no missing-value token and
  does not parse (an integer with a fraction, or beyond 64 bits, too). The value becomes NULL, the row is loaded.

Counting costs no pass of its own: the counts are observed by whatever job reads the table first
and whole, which in the persisted run is the one that writes Bronze (no shuffle lies between, so
a task that is run again counts once). ``enforce_limits`` fails the run when a share of rejects
exceeds its limit, and only a table that has rejects is read again to write them down. The default limits
follow the original job: malformed lines and numbers stop it, unparseable timestamps become NULL.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.sources import readers
from ledgerline.sources.quoted import read_csv_quoted

BROKEN = "broken_line"
BAD = {"timestamp": "bad_timestamp", "integer": "bad_integer", "number": "bad_number"}
#: Largest accepted share of a table's lines per reason.
DEFAULT_LIMITS = {BROKEN: 0.0, "bad_timestamp": 1.0, "bad_integer": 0.0, "bad_number": 0.0}
#: (table, reason, column, rejected, total)
Count = tuple[str, str, str | None, int, int]
COUNT_SCHEMA = "table_name string, reason string, column_name string, rejected long, total long"
LINE_SCHEMA = "table_name string, reason string, column_name string, value string, line string"

_CORRUPT = "_corrupt_line"
_REJECTS = "_rejects"


class RejectedInput(ValueError):
    """More of a source was rejected than its limits allow."""


def _kind(name: str, dtype: T.DataType, source: str) -> str:
    if name in schemas.TIMESTAMP_COLUMNS[source]:
        return "timestamp"
    if name in schemas.INTEGER_COLUMNS[source]:
        return "integer"
    return "number" if isinstance(dtype, (T.DoubleType, T.DecimalType)) else "text"


def _parsed(text: Column, kind: str) -> Column:
    """The value of a text that is no missing-value token; NULL where it does not parse."""
    if kind == "timestamp":
        return F.try_to_timestamp(text)
    if kind == "number":
        return text.try_cast("double")
    if kind == "integer":
        # Exports write integers with gaps as 12.0; decimals hold the whole 64-bit range.
        exact = text.try_cast("decimal(38,10)")
        return F.when(exact == F.floor(exact), exact.try_cast("long"))
    return text


def read_text(spark: SparkSession, path: str, source: str) -> DataFrame:
    """A landed CSV source as text columns, with the text of lines of a wrong number of fields beside them."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in schemas.columns(f"bronze_{source}")])
    if source in readers.MULTI_LINE:
        return read_csv_quoted(spark, path, schema, corrupt=_CORRUPT)
    return (spark.read.schema(schema.add(_CORRUPT, T.StringType()))
            .options(header=True, sep=",", quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT)
            .csv(path))


def checked(raw: DataFrame, source: str, tokens: list[str] | None = None) -> DataFrame:
    """Typed columns and ``_rejects``: (reason, column, value, line) of everything wrong with a line."""
    tokens = readers.NULL_TOKENS if tokens is None else tokens
    wanted = schemas.raw_schema(source)
    names = wanted.fieldNames()
    line = F.to_csv(F.struct(*[F.col(c) for c in names]), {"quote": '"', "escape": '"'})
    broken = F.col(_CORRUPT).isNotNull()
    columns, bad = [], []
    for f in wanted.fields:
        kind = _kind(f.name, f.dataType, source)
        text = F.when(~F.col(f.name).isin(tokens), F.col(f.name))
        value = _parsed(text, kind)
        columns.append(F.when(~broken, value).alias(f.name))
        if kind != "text":
            bad.append(F.when(~broken & text.isNotNull() & value.isNull(),
                              F.struct(F.lit(BAD[kind]).alias("reason"), F.lit(f.name).alias("column_name"), F.col(f.name).alias("value"), line.alias("line"))))
    nothing = F.lit(None).cast("string")
    whole = F.when(broken, F.struct(F.lit(BROKEN).alias("reason"), nothing.alias("column_name"), nothing.alias("value"), F.col(_CORRUPT).alias("line")))
    return raw.select(*columns, F.array_compact(F.array(whole, *bad)).alias(_REJECTS))


def reasons_of(source: str) -> list[tuple[str, str | None]]:
    """Every (reason, column) that a source can be rejected for."""
    kinds = [(f.name, _kind(f.name, f.dataType, source)) for f in schemas.raw_schema(source).fields]
    return [(BROKEN, None), *[(BAD[k], c) for c, k in kinds if k != "text"]]


@dataclass
class CheckedTable:
    """One source: ``rows`` to load (observed when first read whole), and what was rejected."""

    source: str
    frame: DataFrame
    observation: Observation = field(default_factory=Observation)

    def __post_init__(self) -> None:
        has = lambda reason, column: F.exists(
            _REJECTS, lambda r: (r["reason"] == reason) & r["column_name"].eqNullSafe(F.lit(column).cast("string")))
        self.reasons = reasons_of(self.source)
        metrics = [F.count_if(has(*r)).alias(f"r{i}") for i, r in enumerate(self.reasons)]
        observed = self.frame.observe(self.observation, F.count(F.lit(1)).alias("total"), *metrics)
        broken = F.exists(_REJECTS, lambda r: r["reason"] == BROKEN)
        self.rows = observed.where(~broken).drop(_REJECTS)

    def counts(self) -> list[Count]:
        """(table, reason, column, rejected, total) from the job that read the table; waits for it."""
        seen = self.observation.get
        return [(self.source, reason, column, seen[f"r{i}"], seen["total"]) for i, (reason, column) in enumerate(self.reasons)]

    def lines(self) -> DataFrame:
        """The rejected lines, a row per thing that is wrong with one."""
        return self.frame.select(F.lit(self.source).alias("table_name"), F.inline(_REJECTS))


class CheckedDataset(Mapping[str, DataFrame]):
    """A dataset whose tables are read through the reject channel; a mapping of the rows to load.

    Tables are built on first access, as each observation belongs to one reading.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]], limits: Mapping[str, float] | None = None):
        self._builders = dict(builders)
        self._built: dict[str, CheckedTable] = {}
        self._lock = threading.RLock()
        self.limits = {**DEFAULT_LIMITS, **(limits or {})}

    def table(self, name: str) -> CheckedTable:
        with self._lock:  # the sink writes tables from several threads
            if name not in self._built:
                self._built[name] = CheckedTable(name, self._builders[name]())
            return self._built[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name).rows

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def counts(self, names: Iterable[str] | None = None) -> list[Count]:
        """Reject counts of the tables, once the jobs that read them have run."""
        return [row for name in (self if names is None else names) for row in self.table(name).counts()]

    def lines(self, spark: SparkSession, names: Iterable[str]) -> DataFrame:
        """Rejected lines of the named tables; the others are not read again."""
        return reduce(DataFrame.unionByName, [self.table(n).lines() for n in names], spark.createDataFrame([], LINE_SCHEMA))


def enforce_limits(counts: Iterable[Count], limits: Mapping[str, float] = DEFAULT_LIMITS) -> None:
    """Fail when a reason's share of a table's lines exceeds its limit; names every such case."""
    over = [f"{table}: {rejected} of {total} lines {reason}{f' in {column}' if column else ''}"
            for table, reason, column, rejected, total in counts if rejected > limits[reason] * total]
    if over:
        raise RejectedInput("; ".join(over))


def load_checked(spark: SparkSession, base: str, files: Mapping[str, str], limits: Mapping[str, float] | None = None) -> CheckedDataset:
    """S7 with a reject channel: CSV sources under ``base``; all missing files are reported together."""
    readers.require_files(spark, base, files)
    base = base.rstrip("/")
    return CheckedDataset({name: (lambda n=name, f=file: checked(read_text(spark, f"{base}/{f}", n), n)) for name, file in files.items()}, limits)
