"""Land DataFrames as source files (used to exercise the readers end to end)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    (df.write.mode("overwrite").option("header", True).option("quote", '"')
     .option("escape", '"').option("encoding", encoding).csv(path))


def write_lines(lines: DataFrame, header: str, path: str) -> None:
    """Write ready-made text lines (column ``line``), each file beginning with ``header``."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of its partition, so of its file
    lines.select(F.when(first, F.concat(F.lit(header + "\n"), "line")).otherwise(F.col("line"))).write.mode("overwrite").text(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_json_envelopes(df: DataFrame, path: str, page_size: int = 1000) -> None:
    """Write records as ``{"value": [...]}`` pages of at most ``page_size``.

    Page ids come from ``monotonically_increasing_id`` (contiguous within a
    partition), so a page never mixes partitions and never exceeds the size:
    no group grows with the data.
    """
    record = F.struct(*[F.col(c) for c in df.columns])
    pages = (df.select((F.monotonically_increasing_id() / F.lit(page_size)).cast("long")
                       .alias("_page"), record.alias("_rec"))
             .groupBy("_page").agg(F.collect_list("_rec").alias("value"))
             .select("value"))
    pages.write.mode("overwrite").json(path)
