"""Property tests: Spark operators against brute-force Python on random input."""

from __future__ import annotations

import collections
import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.functions import day_diff, sum_money
from ledgerline.operators.modes import mode_per_group
from ledgerline.operators import gold as G
from ledgerline.operators import quality as Q

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

payment_rows = st.lists(
    st.tuples(st.sampled_from(["o1", "o2", "o3"]),
              st.sampled_from([None, "boleto", "credit_card", "voucher"]),
              st.integers(0, 12),
              st.decimals(min_value=0, max_value=10_000, places=2, allow_nan=False)),
    min_size=1, max_size=25)


def _payments(spark, rows):
    data = [(o, i + 1, t, n, float(v)) for i, (o, t, n, v) in enumerate(rows)]
    return spark.createDataFrame(data, "order_id string, payment_sequential int, "
                                       "payment_type string, payment_installments int, "
                                       "payment_value double")


def _brute_main_type(types):
    counts = collections.Counter(types)
    # Highest count, then type ascending with NULL first.
    return sorted(counts.items(), key=lambda kv: (-kv[1], kv[0] is not None, kv[0] or ""))[0][0]


@SETTINGS
@given(rows=payment_rows)
def test_payment_summary_matches_brute_force(spark, rows):
    out = {r.order_id: r for r in G.agg_payments(_payments(spark, rows)).collect()}
    by_order = collections.defaultdict(list)
    for i, (o, t, n, v) in enumerate(rows):
        by_order[o].append((i + 1, t, n, Decimal(str(float(v))).quantize(Decimal("0.01"))))
    assert set(out) == set(by_order)
    for o, items in by_order.items():
        r = out[o]
        assert r.payment_type_main == _brute_main_type([t for _, t, _, _ in items])
        assert r.payment_types_nunique == len({t for _, t, _, _ in items if t is not None})
        assert r.payment_value_total == sum(v for *_, v in items)
        assert r.payment_sequential_max == max(s for s, *_ in items)
        assert r.payment_installments_max == max(n for _, _, n, _ in items)
        assert r.payment_installments_mean == sum(n for _, _, n, _ in items) / len(items)


@SETTINGS
@given(rows=payment_rows)
def test_window_rank_agrees_with_min_by(spark, rows):
    df = _payments(spark, rows)
    ranked = {r.order_id: r.payment_type for r in
              G.window_payment_rank(df).where("row_num = 1").collect()}
    main = {r.order_id: r.payment_type_main for r in G.agg_payments(df).collect()}
    assert ranked == main


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"])),
                       min_size=1, max_size=30))
def test_mode_matches_brute_force(spark, values):
    df = spark.createDataFrame([(1, v) for v in values], "k int, v string")
    got = mode_per_group(df, "k", "v", "m").first().m
    present = [v for v in values if v is not None]
    if not present:
        assert got is None
    else:
        counts = collections.Counter(present)
        best = max(counts.values())
        assert got == min(v for v, c in counts.items() if c == best)


@SETTINGS
@given(values=st.lists(st.decimals(min_value=-10**9, max_value=10**9, places=2,
                                   allow_nan=False), min_size=1, max_size=40))
def test_money_sum_is_exact(spark, values):
    df = spark.createDataFrame([(1, v) for v in values], "k int, v decimal(14,2)")
    assert df.groupBy("k").agg(sum_money("v").alias("s")).first().s == sum(values)


@SETTINGS
@given(a=st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2040, 1, 1)),
       b=st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2040, 1, 1)))
def test_day_diff_matches_python(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    got = df.select(day_diff("a", "b").alias("d")).first().d
    delta = a - b
    micros = (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
    assert got == micros / 86_400_000_000.0


keys = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)),
                          st.one_of(st.none(), st.sampled_from(["x", "y"]))),
                min_size=0, max_size=30)


@SETTINGS
@given(rows=keys)
def test_no_duplicates_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string")
    r = Q.no_duplicates(df, ["a", "b"], "t").first()
    counts = collections.Counter(rows)
    assert r.failing == sum(c - 1 for c in counts.values())
    assert r.total == len(rows)
    assert r.passed == (r.failing == 0)


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)), max_size=30),
       lo=st.one_of(st.none(), st.integers(-3, 0)), hi=st.one_of(st.none(), st.integers(0, 3)))
def test_value_range_matches_brute_force(spark, values, lo, hi):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    r = Q.value_range(df, "v", lo, hi, "t").first()
    bad = sum(1 for v in values if v is not None and
              ((lo is not None and v < lo) or (hi is not None and v > hi)))
    assert (r.failing, r.total) == (bad, len(values))


@SETTINGS
@given(child=st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=30),
       parent=st.lists(st.integers(0, 6), max_size=10))
def test_foreign_key_orphans_match_brute_force(spark, child, parent):
    c = spark.createDataFrame([(v,) for v in child], "k int")
    p = spark.createDataFrame([(v,) for v in parent], "k int")
    r = Q.foreign_key(c, "k", p, "k", "c", "p").first()
    present = [v for v in child if v is not None]
    assert r.failing == sum(1 for v in present if v not in set(parent))
    assert r.total == len(present)
