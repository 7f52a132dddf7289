"""Full-row counts by digest: exact whatever the digests, rows not exchanged."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from tillroll.operators.distinct import distinct_row_counts
from tillroll.operators.stats import duplicate_report

SCHEMA = "a string, b string, n double"
ROWS = [("x", None, 1.0), (None, "x", 1.0), ("x", None, 1.0), ("y", "z", 0.0), ("y", "z", -0.0), ("y", "z", None), (None, None, None)]


def counts(df, digests=None):
    (row,) = distinct_row_counts(df, {"has_a": F.col("a").isNotNull()}, digests).collect()
    return row.asDict()


@pytest.mark.parametrize("collide", [False, True])
def test_counts_are_exact_even_where_all_digests_collide(spark, collide):
    digests = [F.lit(1), F.lit(2)] if collide else None
    df = spark.createDataFrame(ROWS * 3 + [("once", "", 2.0)], SCHEMA)
    assert counts(df, digests) == {"rows": 22, "distinct_rows": 6, "has_a": 4}
    assert counts(df.distinct(), digests) == {"rows": 6, "distinct_rows": 6, "has_a": 4}


def test_empty_frame(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert counts(empty) == {"rows": 0, "distinct_rows": 0, "has_a": 0}
    (row,) = duplicate_report(empty).collect()
    assert (row.rows, row.duplicates, row.duplicate_pct) == (0, 0, None)


def test_rows_are_not_exchanged(spark, monkeypatch):
    from tillroll.operators import distinct

    plans, real = [], distinct.materialize

    def spy(df, *args, **kwargs):
        with contextlib.redirect_stdout(io.StringIO()) as out:
            df.explain(mode="simple")
        plans.append(out.getvalue())
        return real(df, *args, **kwargs)

    monkeypatch.setattr(distinct, "materialize", spy)
    counts(spark.createDataFrame(ROWS, SCHEMA))
    (plan,) = plans
    assert "Exchange hashpartitioning(_digest1" in plan and plan.count("Exchange") == 1 and "partial_count" in plan
