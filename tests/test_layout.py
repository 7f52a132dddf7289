"""Order lines laid out by customer: no exchange, hot customers apart, same customer table."""

import contextlib
import io
import random

from tests.conftest import line
from tillroll.plans import customers
from tillroll.sources import layout


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def _lines(n=3000):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        who = 7 if i % 3 == 0 else rng.randint(100, 400)  # a third of all lines is one customer's
        rows.append(line(f"I{rng.randint(0, n // 4)}", f"S{i % 50}", rng.randint(-2, 9), f"2024-0{rng.randint(1, 9)}-11 10:30", rng.randint(0, 90) / 10, who))
    return rows + [line("I1", "S1", 1, "2024-01-01 00:00", 1, None)] * 5


def test_customer_table_of_the_layout_equals_that_of_the_lines(spark, make_orders):
    orders = make_orders(_lines())
    held = layout.lay_out(orders, 8)
    want, n = customers.customer_base(orders)
    got, m = customers.base_of_layout(held)
    assert m == n and sorted(got.collect()) == sorted(want.select(got.columns).collect())
    assert {r.customer_id for r in held.heavy().select("customer_id").distinct().collect()} == {7}
    assert held.lines().count() == orders.count()
    layout.forget(held)


def test_no_line_moves_for_the_customer_key(spark, make_orders):
    held = layout.lay_out(make_orders(_lines()), 8)
    plan = _plan(customers.customer_grain(held.usual()))
    assert "Exchange" not in plan and "HashAggregate" in plan  # distinct invoices included
    assert "Exchange" in _plan(customers.customer_grain(held.heavy()))  # partial sums of the hot ones move
    layout.forget(held)


def test_buckets_are_bounded_by_the_hot_share(spark, make_orders):
    held = layout.lay_out(make_orders(_lines()), 8)
    files = [r.n for r in held.usual().selectExpr("input_file_name() AS f").groupBy("f").count().withColumnRenamed("count", "n").collect()]
    assert len(files) <= 8 and max(files) <= 2.5 * 2000 / 8
    layout.forget(held)


def test_without_hot_customers_and_without_lines(spark, make_orders):
    rows = [line(f"I{i}", "S", 1, "2024-01-01 00:00", 1, i) for i in range(400)]
    for given in (rows, []):
        orders = make_orders(given)
        held = layout.lay_out(orders, 4)
        assert held.heavy().count() == 0
        assert customers.base_of_layout(held)[1] == len(given)
        layout.forget(held)
