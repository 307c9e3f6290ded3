"""JSON payloads whose shape drifts: declared fields as a table, everything else reported.

A payload with a declared schema drops fields that were added and turns fields of another type into
NULL, both unseen. Here each record is parsed once into a VARIANT: the declared fields are taken from it
by type, and whatever does not fit is told per field, with the type that was seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ADDED, RETYPED, UNREADABLE = "added", "retyped", "unreadable"


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """``record`` (VARIANT) of every record: the elements of ``{"value": [...]}`` pages, or plain records.

    One line holds one page or record. A line that is no JSON gives a row with a null ``record`` and
    the line beside it.
    """
    lines = spark.read.format("text").load(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.try_parse_json("value").alias("v"))
    page = F.try_variant_get("v", "$.value", "array<variant>")
    one = F.array(F.col("v"))
    records = F.when(F.col("v").isNull() | page.isNull(), one).otherwise(page)
    return parsed.select(F.explode(records).alias("record"), F.when(F.col("v").isNull(), F.col("value")).alias("line"))


def _get(name: str, dtype: T.DataType):
    return F.try_variant_get("record", f"$['{name}']", dtype.simpleString())


def declared(variants: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared fields of each record; a value of another type that does not convert is NULL.

    An object without any declared field holds no record.
    """
    fields = variants.where("line is null").select(*[_get(f.name, f.dataType).alias(f.name) for f in schema.fields])
    return fields.dropna("all")


def drift(variants: DataFrame, schema: T.StructType) -> DataFrame:
    """(kind, field, seen_type, records): fields that were added, values that do not convert to
    their declared type, and lines that are no JSON. Counted map-side before the shuffle."""
    names = F.array(*[F.lit(n) for n in schema.fieldNames()])
    entry = F.explode(F.map_entries(F.try_variant_get("record", "$", "map<string,variant>")))
    added = (variants.where("line is null").select(entry.alias("e")).where(~F.array_contains(names, F.col("e.key")))
             .select(F.lit(ADDED).alias("kind"), F.col("e.key").alias("field"), F.schema_of_variant("e.value").alias("seen_type")))
    lost = [F.when(raw.isNotNull() & ~F.is_variant_null(raw) & _get(f.name, f.dataType).isNull(),
                   F.struct(F.lit(RETYPED).alias("kind"), F.lit(f.name).alias("field"), F.schema_of_variant(raw).alias("seen_type")))
            for f in schema.fields for raw in [F.try_variant_get("record", f"$['{f.name}']", "variant")]]
    retyped = variants.where("line is null").select(F.inline(F.array_compact(F.array(*lost))))
    broken = variants.where("line is not null").select(F.lit(UNREADABLE).alias("kind"), F.lit(None).cast("string").alias("field"),
                                                      F.lit(None).cast("string").alias("seen_type"))
    return added.unionByName(retyped).unionByName(broken).groupBy("kind", "field", "seen_type").agg(F.count(F.lit(1)).alias("records"))
