import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.operators import binning, quantiles
from tillroll.operators.cutpoints import Score, add_scores
from tillroll.session import materialize


def _qcut_rank(values, keys):
    s = pd.Series(values, index=keys).sort_index()
    return pd.qcut(s.rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)


def _scores(spark, values, keys, kind, policy="raise", dtype="int"):
    df = spark.createDataFrame([(int(k), v) for k, v in zip(keys, values)], f"k long, v {dtype}")
    out = add_scores(df, [Score(kind, "v", "k", "b", binning.DIRECT)], policy)
    return {r.k: r.b for r in out.collect()}


def test_rank_bins_match_pandas_with_ties(spark):
    rng = np.random.default_rng(7)
    n = 503
    vals = rng.integers(1, 6, size=n)  # heavy ties
    keys = rng.permutation(n) + 1000
    assert _scores(spark, [int(v) for v in vals], keys, "rank") == _qcut_rank(vals, keys).to_dict()


@pytest.mark.parametrize("n", [2, 3, 5, 7, 11, 64, 100, 1001])
def test_rank_bins_of_any_size(spark, n):
    got = [b for _, b in sorted(_scores(spark, list(range(n)), range(n), "rank").items())]
    assert got == [max(1, -(-5 * r // (n - 1))) for r in range(n)]
    if n == 7:
        assert got == [1, 1, 2, 3, 4, 5, 5]


def test_hot_value_and_several_scores_in_one_pass(spark):
    # a third of the rows share one value
    df = spark.range(0, 3000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"),
        (F.col("id") * 1.5).cast("double").alias("w"),
    ).repartition(13)
    out = add_scores(df, [Score("rank", "v", "k", "a", binning.DIRECT), Score("value", "w", "k", "b", binning.INVERTED)])
    pdf = out.toPandas().sort_values("k")
    want = pd.qcut(pdf.sort_values(["v", "k"]).assign(r=range(3000)).set_index("k").r.sort_index(), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert (pdf.a.to_numpy() == want.to_numpy()).all()
    assert (pdf.b.to_numpy() == pd.qcut(pdf.w, 5, labels=[5, 4, 3, 2, 1]).astype(int).to_numpy()).all()


def test_no_ordering_is_in_one_task(spark):
    df = materialize(spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v")))
    plan = add_scores(df, [Score("rank", "v", "k", "b", binning.DIRECT)])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan  # the scores are literals over the scan


def test_single_row_fails(spark):
    with pytest.raises(ValueError, match="fewer than two rows"):
        _scores(spark, [1], [1], "rank")


def _value_bins(spark, values, policy="raise"):
    got = _scores(spark, [float(v) for v in values], range(len(values)), "value", policy, "double")
    return [b for _, b in sorted(got.items())]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=10_000), min_size=12, max_size=80, unique=True))
def test_value_bins_match_pandas_qcut(spark, values):
    got = _value_bins(spark, values)
    want = pd.qcut(pd.Series(values, dtype=float), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    assert got == want


def test_duplicate_edges_raise_or_collapse(spark):
    values = [1] * 10 + [2, 3, 4]  # 13 values, 10 equal
    with pytest.raises(Exception, match="not unique"):
        _value_bins(spark, values)
    got = _value_bins(spark, values, "collapse")
    assert got[:10] == [1] * 10  # ties share the lowest bin
    assert got[10:] == sorted(got[10:]) and max(got) == 5


def test_value_count_edges_exact_with_hot_value(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.integers(0, 50, 3000), np.full(2000, 7), rng.normal(0, 100, 1000).round(2)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    probs = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]
    got = quantiles.value_count_edges(df, "v", probs).first().edges
    assert np.allclose(got, np.quantile(vals, probs), atol=1e-9, rtol=0)


def test_value_count_edges_per_group(spark):
    rng = np.random.default_rng(5)
    g = rng.choice(["a", "b", "c"], size=4000, p=[0.7, 0.2, 0.1])  # one hot group
    v = rng.integers(0, 400, size=4000).astype(float)
    df = spark.createDataFrame([(str(a), float(b)) for a, b in zip(g, v)], "g string, v double")
    probs = [0.25, 0.5, 0.75]
    got = {r.g: r.edges for r in quantiles.value_count_edges(df, "v", probs, by="g").collect()}
    want = pd.DataFrame({"g": g, "v": v}).groupby("g")["v"].quantile(probs).unstack()
    for k in "abc":
        assert np.allclose(got[k], want.loc[k].to_numpy(), atol=1e-9, rtol=0)
