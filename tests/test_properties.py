import datetime as dt

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions import dates
from tillroll.sources.upsert import upsert

stamps = st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2030, 12, 31))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(stamps, stamps), min_size=1, max_size=40))
def test_whole_days_equals_pandas_days(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = [r.d for r in df.select(dates.whole_days("a", "b").alias("d")).collect()]
    want = [(pd.Timestamp(b) - pd.Timestamp(a)).days for a, b in pairs]
    assert got == want


keys = st.integers(min_value=1, max_value=30)
rows = st.lists(st.tuples(keys, st.sampled_from(["a", "b", "c"])), max_size=20, unique_by=lambda r: r[0])


@settings(max_examples=10, deadline=None)
@given(rows, rows)
def test_upsert_properties(spark, old, new):
    t0, t1, t2 = (F.lit(dt.datetime(2024, m, 1)).cast("timestamp") for m in (1, 2, 3))
    schema = "customer_id long, segment string"
    existing = upsert(None, spark.createDataFrame(old, schema), "customer_id", t0)
    upd = spark.createDataFrame(new, schema)
    once = upsert(existing, upd, "customer_id", t1)
    twice = upsert(once, upd, "customer_id", t2)
    merged = {r.customer_id: r.segment for r in once.collect()}
    assert merged == {**dict(old), **dict(new)}  # update wins, nothing deleted
    assert {(r.customer_id, r.segment, r.created_at) for r in once.collect()} == {
        (r.customer_id, r.segment, r.created_at) for r in twice.collect()
    }


@settings(max_examples=10, deadline=None)
@given(
    st.lists(st.integers(min_value=-500, max_value=5000), min_size=2, max_size=300),
    st.sampled_from([7, 30, 50]),
)
def test_histogram_matches_numpy(spark, values, bins):
    import numpy as np

    from tillroll.operators import stats

    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = {r.bin: r["count"] for r in stats.histogram(df, "x", bins).collect()}
    counts, _ = np.histogram(np.array(values, dtype=float), bins=bins)
    if min(values) == max(values):
        assert got == {0: len(values)}
    else:
        assert got == {i: int(c) for i, c in enumerate(counts) if c}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=1000), min_size=4, max_size=200))
def test_box_summary_matches_numpy(spark, values):
    import numpy as np

    from tillroll.operators import stats

    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    r = stats.box_summary(df, "x").first()
    x = np.array(values, dtype=float)
    q1, med, q3 = np.quantile(x, [0.25, 0.5, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert r.n == len(values)
    assert np.allclose([r.q1, r.median, r.q3], [q1, med, q3], atol=1e-9, rtol=0)
    assert r.whisker_low == x[x >= lo].min() and r.whisker_high == x[x <= hi].max()
    assert r.outliers == int(((x < lo) | (x > hi)).sum())


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=500), min_size=2, max_size=150))
def test_describe_matches_pandas(spark, values):
    from tillroll.operators import stats

    df = spark.createDataFrame([(v,) for v in values], "q int")
    r = stats.describe_numeric(df, ["q"]).first()
    d = pd.Series(values, dtype=float).describe()
    assert r["count"] == d["count"]
    for mine, theirs in (("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%")):
        assert abs(r[mine] - d[theirs]) <= 1e-6, mine
    assert (r["min"], r["max"]) == (d["min"], d["max"])
