"""Physical-plan properties of the line-level passes (the plans of the tables
written once by materialize) and of the final plans of the headline queries."""

import contextlib
import io
import os
import re

import pytest

from tests.conftest import SF_SMALL, line
from tillroll import registry, session
from tillroll.operators import ranking
from tillroll.plans import customers, geo, product

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")

HEADLINE = ["customer_rfm", "product_rfm", "churn_risk", "geographic_analysis", "clv_forecast", "rfm_exploration"]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    captured = {}
    orig = session.materialize

    def recording(df, name="table", observe=None):
        captured.setdefault(name, _plan(df))
        return orig(df, name, observe)

    mods = (customers, product, geo, ranking)
    for m in mods:
        m.materialize = recording
    try:
        finals = {n: _plan(registry.QUERIES[n](spark, SF_SMALL)) for n in HEADLINE}
    finally:
        for m in mods:
            m.materialize = orig
    return captured, finals


def _line_schemas(text: str) -> list[str]:
    """Read schemas of scans over order lines (the raw source or the ingested
    bronze table; explain truncates paths, so match on the schema)."""
    return [s for s in re.findall(r"ReadSchema: struct<([^>\n]*)", text) if "l_quantity" in s or "quantity:int" in s]


def _reads_lines(text: str) -> bool:
    return bool(_line_schemas(text))


def test_line_passes_are_hash_aggregates_with_partial_step(plans):
    written, _ = plans
    line_passes = {k: v for k, v in written.items() if _reads_lines(v)}
    assert {"customers", "products", "country_invoices"} <= set(line_passes)
    for name, text in line_passes.items():
        assert "SortAggregate" not in text, name
        assert "partial_" in text, name
        # every exchange above the scan feeds on a partial aggregate or the input spread
        assert "CartesianProduct" not in text, name
        assert "Expand" not in text and "Generate" not in text, name  # no line is emitted twice


def test_scans_read_only_needed_columns(plans):
    written, _ = plans
    assert all("stock_code" not in s for s in _line_schemas(written["customers"]))
    assert all("country" not in s for s in _line_schemas(written["products"]))
    for name, text in written.items():
        for schema in re.findall(r"lineitem\.parquet.*?ReadSchema: struct<([^>]*)>", text):
            assert "l_extendedprice" not in schema and "l_tax" not in schema and "l_shipdate" not in schema, name


def test_final_plans_read_only_written_tables(plans):
    _, finals = plans
    for name, text in finals.items():
        if name == "product_rfm":  # the names: three columns, a row for each (product, description) of a task
            assert all(set(re.findall(r"(\w+):", x)) <= {"stock_code", "description", "invoice_date", "customer_id", "quantity", "price"} for x in _line_schemas(text))
            assert "Expand" not in text and "Generate" not in text
        else:
            assert not _reads_lines(text), name  # scoring never rescans the lines
        assert "CartesianProduct" not in text, name


def test_no_ordering_of_a_grain_table_is_sorted_or_in_one_task(plans):
    written, finals = plans
    assert "cut_points" not in written
    for name, text in finals.items():
        if name == "geographic_analysis":  # its ranks are over the countries
            continue
        assert "rangepartitioning" not in text and "Window" not in text, name
        lines = text.splitlines()
        for here, below in zip(lines, lines[1:]):
            if "SinglePartition" in here:  # one-row aggregates only
                assert "HashAggregate(keys=[]" in below, name


@pytest.mark.parametrize("name", ["kpis", "distinct_counts"])
def test_distinct_counts_do_not_expand_the_lines(spark, name):
    text = _plan(registry.QUERIES[name](spark, SF_SMALL))
    assert "Expand" not in text and "Generate" not in text


def test_product_lines_travel_without_sums(make_orders, monkeypatch):
    """No aggregate of the lines before their exchange: it would hold a row for each."""
    plans = []
    monkeypatch.setattr(product, "materialize", lambda df, *a: plans.append(df) or df)
    product.product_table(make_orders([line("1", "a", 1, "2020-01-01 10:00", 2, 7)]))
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    exchanged = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "Exchange hashpartitioning(stock_code" in exchanged and "Aggregate" not in exchanged
