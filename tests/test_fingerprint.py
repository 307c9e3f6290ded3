"""Content fingerprints: independent of order and layout, sensitive to every value."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerline.operators import fingerprint as fp

SCHEMA = "s string, i long, b boolean, t timestamp_ntz, d decimal(10,7), m decimal(38,2), f double"
ROWS = [
    ("é|~", 1, True, dt.datetime(1969, 1, 1, 0, 0, 0, 5), decimal.Decimal("0.0000000"), decimal.Decimal("-12345678901234567890.01"), 1.5),
    (None,) * 7,
    ("", -5, False, dt.datetime(2020, 1, 1), decimal.Decimal("0.0000001"), decimal.Decimal("0.05"), -0.1234567),
    ("", -5, False, dt.datetime(2020, 1, 1), decimal.Decimal("0.0000001"), decimal.Decimal("0.05"), -0.1234567),
]


def text(value, places=None):
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, dt.datetime):
        return str(round((value - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)))
    return f"{value:.{places}f}" if places is not None else str(value)


def by_hand(rows):
    total = 0
    for r in rows:
        texts = [text(v, {4: 7, 5: 2, 6: 7}.get(k)) for k, v in enumerate(r)]
        line = "".join("~" if x is None else f"{len(x)}:{x}" for x in texts)
        total += int(hashlib.md5(line.encode()).hexdigest()[:15], 16)
    return len(rows), str(total)


def of(df):
    r = fp.fingerprint(df, "t").first()
    return r["row_count"], r["content_hash"]


def test_equals_the_definition_in_any_order_and_layout(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert of(df) == by_hand(ROWS)
    assert of(df.repartition(3).orderBy(F.rand())) == by_hand(ROWS)
    assert of(df.limit(0)) == (0, "0")


@pytest.mark.parametrize("name, value", [("s", "' '"), ("i", "6L"), ("b", "cast(null as boolean)"), ("t", "timestamp_ntz'2020-01-01 00:00:00.000001'"),
                                         ("m", "cast(0.06 as decimal(38,2))"), ("f", "-0.1234568D")])
def test_every_value_counts(spark, name, value):
    df = spark.createDataFrame(ROWS[2:3], SCHEMA)
    assert of(df) != of(df.withColumn(name, F.expr(value)))


def test_repeated_rows_and_moved_borders_count(spark):
    one, two = spark.createDataFrame([("a", "b")], "x string, y string"), spark.createDataFrame([("a", "b"), ("a", "b")], "x string, y string")
    assert of(one)[1] != of(two)[1]
    assert of(spark.createDataFrame([("ab", "")], "x string, y string"))[1] != of(one)[1]
    assert of(spark.createDataFrame([("ab", None)], "x string, y string"))[1] != of(spark.createDataFrame([("ab", "")], "x string, y string"))[1]


def test_sums_over_parts(spark):
    parts = [of(spark.createDataFrame(ROWS[:1], SCHEMA)), of(spark.createDataFrame(ROWS[1:], SCHEMA))]
    assert str(sum(int(h) for _, h in parts)) == of(spark.createDataFrame(ROWS, SCHEMA))[1]


def test_as_an_observation_of_a_write(spark, tmp_path):
    df, seen = spark.createDataFrame(ROWS, SCHEMA), Observation()
    df.observe(seen, *fp.metrics(df.schema)).write.parquet(str(tmp_path / "t"))
    assert (seen.get["row_count"], seen.get["content_hash"]) == by_hand(ROWS) == of(spark.read.parquet(str(tmp_path / "t")))


def test_texts_and_hash_are_made_once_a_row(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    plan = fp.fingerprint(df, "t")._jdf.queryExecution().optimizedPlan().toString()
    aggregate, rest = plan.split("\n", 1)
    assert "Aggregate" in aggregate and "md5" not in aggregate
    assert rest.count("timestampdiff(") == 1 and rest.count("md5(") == 1
    hashed, seen = fp.with_row_hash(df), Observation()
    hashed.observe(seen, *fp.metrics(hashed.schema)).drop(fp.ROW_HASH).write.parquet(str(tmp_path / "t"))
    assert (seen.get["row_count"], seen.get["content_hash"]) == by_hand(ROWS)
    assert spark.read.parquet(str(tmp_path / "t")).columns == df.columns
