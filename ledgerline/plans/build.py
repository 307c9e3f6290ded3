"""Layer builds (lazy) and the validated full build.

``build_gold`` and friends only declare plans; nothing runs until a sink or a
check triggers an action. ``build_all`` runs the quality suites between the
layers, like the persist path of the original job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import gold as gold_ops
from ledgerline.operators import quality
from ledgerline.operators.silver import build_bronze as _bronze
from ledgerline.operators.silver import build_silver as _silver
from ledgerline.session import input_bytes, size_shuffle_partitions
from ledgerline.tables import LazyTables, renamed


def strip_layer(tables: Mapping[str, DataFrame], layer: str) -> Mapping[str, DataFrame]:
    return renamed(tables, lambda name: name.removeprefix(f"{layer}_"))


def build_bronze(sources: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    return _bronze(sources)


def build_silver(sources: Mapping[str, DataFrame], strip_prefix: bool = False) -> Mapping[str, DataFrame]:
    return _silver(sources, strip_prefix=strip_prefix)


def build_gold_from_silver(silver: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    return gold_ops.build_gold(strip_layer(silver, "silver"))


def build_gold(sources: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    return build_gold_from_silver(_silver(sources))


def build_all(sources: Mapping[str, DataFrame], min_rows: int = 1000,
              validate: bool = True) -> Mapping[str, DataFrame]:
    """Bronze, Silver and Gold (24 tables), validating after each layer.

    Row-count floors raise; the other checks only report (as in the original
    job). Each suite is one small Spark job returning a few report rows.
    """
    bronze = _bronze(sources)
    if validate:
        quality.enforce(quality.suite_bronze(bronze, min_rows=min_rows))
    silver = _silver(sources)
    if validate:
        quality.enforce(quality.suite_silver(silver))
    gold = build_gold_from_silver(silver)
    if validate:
        quality.enforce(quality.suite_gold(gold, min_rows=min_rows))
    return LazyTables({**{n: (lambda n=n: bronze[n]) for n in bronze},
                       **{n: (lambda n=n: silver[n]) for n in silver},
                       **{n: (lambda n=n: gold[n]) for n in gold}})


def run(spark: SparkSession, sources: Mapping[str, DataFrame], persist_root: str | None = None,
        min_rows: int = 1000, size_partitions: bool = False) -> Mapping[str, DataFrame]:
    """Default entry: the six Gold tables (lazy). With ``persist_root`` all 24
    tables are written, validated and published as one run, and Gold is
    returned read back from it. ``size_partitions`` sets the shuffle partition
    count from the total size of the source files first."""
    if size_partitions:
        files = sorted({f for df in sources.values() for f in df.inputFiles()})
        size_shuffle_partitions(spark, input_bytes(spark, files))
    if persist_root is None:
        return build_gold(sources)
    from ledgerline.sinks.writers import full_refresh

    return full_refresh(spark, sources, persist_root, validate=True, min_rows=min_rows)
