"""Order statistics by sketch brackets, distinct counts without expansion, observed writes."""

import contextlib
import io
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.operators import distinct, selection
from tillroll.operators.selection import Ordering, linear_quantiles, order_statistics
from tillroll.session import materialize, observed


def _every_rank(n):
    return set(range(n))


def _fifths(n):
    return {k * (n - 1) // 5 for k in range(6)}


def _sorted(values, keys):
    return sorted((v, k) for v, k in zip(values, keys) if v is not None)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-20, 20)), min_size=1, max_size=60), st.sampled_from(["int", "decimal(18,4)", "double"]))
def test_every_rank_of_small_tables(spark, values, dtype):
    keys = [7 * i % 61 - 30 for i in range(len(values))]
    df = spark.createDataFrame(list(zip(values, keys)), "v int, k long").select(F.col("v").cast(dtype).alias("v"), "k")
    (n, by_key), (m, alone) = order_statistics(
        df, [Ordering("v", "k", _every_rank, (0.0, 0.5, 1.0)), Ordering("v", None, _every_rank, (0.5,))]
    )
    want = _sorted(values, keys)
    assert n == m == len(want)
    assert [(float(by_key[r][0]), by_key[r][1]) for r in range(n)] == [(float(v), k) for v, k in want]
    assert [float(alone[r][0]) for r in range(n)] == [float(v) for v, _ in want]


@pytest.mark.parametrize("key", ["long", "string"])
def test_hot_ties_in_a_large_table_and_few_rows_counted(spark, key, monkeypatch):
    n = 60_000  # more rows than a sketch holds; a third share one value
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.xxhash64("id"), F.lit(40))).cast("int").alias("v"),
        (F.col("id") * 31 % n if key == "long" else F.format_string("%06d", F.col("id") * 31 % n)).alias("k"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**9)).cast("decimal(18,4)") / 7).cast("decimal(18,4)").alias("m"),
    )
    df = materialize(df.repartition(7), "selection")
    rows = df.collect()
    by_key = sorted((r.v, r.k) for r in rows)
    money = sorted(r.m for r in rows if r.m is not None)
    got = order_statistics(df, [Ordering("v", "k", _fifths, (0.2, 0.4, 0.6, 0.8, 0.0, 1.0)), Ordering("m", None, _fifths, (0.0, 0.2, 0.4, 0.6, 0.8, 1.0))])
    assert got[0][0] == n and got[1][0] == len(money)
    assert all((int(v), k) == by_key[r] for r, (v, k) in got[0][1].items()) and set(got[0][1]) == _fifths(n)
    assert all(v == money[r] for r, (v, _) in got[1][1].items()) and set(got[1][1]) == _fifths(len(money))
    # the rows inside the brackets are few, ties or not
    inside = selection._apart([selection._bracket(r, n, g := selection._grid((0.2,)), _sketch(df, key, g)) for r in (n // 5,)])
    (low, high), = inside
    x = selection._follows(Ordering("v", "k", _fifths, ()), dict(df.dtypes))
    assert df.selectExpr(f"count_if({x} >= {low!r}D AND {x} <= {high!r}D)").first()[0] < n * 16 / selection.ACCURACY


def _sketch(df, key, grid):
    x = selection._follows(Ordering("v", "k", _fifths, ()), dict(df.dtypes))
    return df.selectExpr(f"percentile_approx({x}, array({', '.join(f'{p!r}D' for p in grid)}), {selection.ACCURACY})").first()[0]


def test_a_sketch_that_breaks_its_bound_costs_a_pass_only(spark, monkeypatch):
    monkeypatch.setattr(selection, "_bracket", lambda rank, n, grid, values: (values[0], values[0]))  # wrong on purpose
    values = list(range(50))
    df = spark.createDataFrame([(v, v) for v in values], "v int, k long")
    assert {r: v for r, (v, _) in order_statistics(df, [Ordering("v", "k", _every_rank, (0.5,))])[0][1].items()} == dict(enumerate(values))


def test_whole_order_follows_even_at_the_limits(spark):
    rows = [(v, k) for v in (-(2**31), -1, 0, 1, 2**31 - 1) for k in (-(2**63), -(2**40), -1, 0, 1, 2**40, 2**63 - 1)]
    df = spark.createDataFrame(rows, "v int, k long")
    x = selection._follows(Ordering("v", "k", _fifths, ()), dict(df.dtypes))
    got = [r[0] for r in df.orderBy("v", "k").selectExpr(x).collect()]
    assert got == sorted(got)
    words = spark.createDataFrame([(1, w) for w in ["", "a", "a\x00", "ab", "abcdefgh", "abcdefgi", "b", "é", "日本", "\U0001f642"]], "v int, k string")
    got = [r[0] for r in words.orderBy("k").selectExpr(selection._follows(Ordering("v", "k", _fifths, ()), dict(words.dtypes))).collect()]
    assert got == sorted(got)


def test_linear_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 30, 3000), rng.normal(0, 50, 3000)
    df = spark.createDataFrame([(int(x), float(y), None) for x, y in zip(a, b)], "a int, b double, c double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    (n, qa), (_, qb), (none, qc) = linear_quantiles(df, ["a", "b", "c"], probs)
    assert n == 3000 and none == 0 and qc is None
    assert np.allclose(qa, np.quantile(a, probs)) and np.allclose(qb, np.quantile(b, probs), atol=1e-12)


def test_two_actions_and_no_write(spark, monkeypatch):
    df = materialize(spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 9).alias("v")), "selection")
    group = "selection-actions"
    spark.sparkContext.setJobGroup(group, group)
    try:
        order_statistics(df, [Ordering("v", "k", _fifths, (0.2, 0.4, 0.6, 0.8))])
        tracker = spark.sparkContext.statusTracker()
        jobs = tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 2 <= len(jobs) <= 6  # two actions; adaptive execution may run a stage as a job of its own


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1), st.integers(-3, 3)), max_size=60))
def test_distinct_counts_of_ids_and_values(spark, ids):
    df = spark.createDataFrame([(i, None if i is None else str(i % 7)) for i in ids], "i int, s string").repartition(3)
    counts = distinct.side_by_side(distinct.distinct_count(df, "i", "a"), distinct.distinct_count(df, "s", "b"))
    held = [i for i in ids if i is not None]
    assert tuple(counts.first()) == (len(set(held)), len({i % 7 for i in held}))
    assert "Expand" not in _plan(counts)


def test_observed_writes(spark):
    df = spark.range(0, 1000, 1, 8).select("id", (F.col("id") * 2).alias("x"))
    table = materialize(df.where("id % 3 = 0"), "observed", {"top": F.max("x"), "least": F.min("id")})
    assert observed(table) == {"rows": 334, "top": 1998, "least": 0}
    none = materialize(df.where("id < 0"), "observed", {"top": F.max("x")})
    assert observed(none)["rows"] == 0 and observed(none)["top"] is None
    assert observed(materialize(df, "unobserved")) is None


def test_brackets_meet_or_stay_apart():
    assert selection._apart([(5.0, 6.0), (1.0, 2.0), (2.0, 3.0), (-math.inf, 0.0)]) == [(-math.inf, 0.0), (1.0, 3.0), (5.0, 6.0)]
