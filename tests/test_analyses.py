"""Hand-made order lines exercising the edge rules of each analysis."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import line
from tillroll.plans import churn, cleaning, clv, customers, geo, library, product, rfm


def _rfm_rows(n=12):
    """n customers with distinct activity; customer 99 has returns only."""
    rows = []
    for c in range(1, n + 1):
        for k in range(c % 4 + 1):
            rows.append(line(f"{c}{k}", f"S{c % 5}", 2 + k, f"2010-0{1 + c % 9}-1{k} 10:00", 1.5 * c, c,
                             "UK" if c % 2 else "France"))
    rows.append(line("9901", "S1", 5, "2010-03-01 10:00", 2.0, 99))
    rows.append(line("C9902", "S1", -9, "2010-03-02 10:00", 2.0, 99))
    return rows


def test_customer_rfm_edge_rules(make_orders):
    orders = make_orders(_rfm_rows())
    out = {r.customer_id: r for r in rfm.customer_rfm(orders).collect()}
    assert 99 not in out  # net monetary <= 0 -> not scored
    assert len(out) == 12
    assert all(1 <= r.r_score <= 5 and 1 <= r.f_score <= 5 and 1 <= r.m_score <= 5 for r in out.values())
    assert all(r.rfm_score == f"{r.r_score}{r.f_score}{r.m_score}" for r in out.values())


def test_partitionings_agree(spark, make_orders):
    orders = make_orders(_rfm_rows(40))
    a = sorted(rfm.customer_rfm(orders).collect())
    b = sorted(rfm.customer_rfm(orders.repartition(16)).collect())
    c = sorted(rfm.customer_rfm(orders.coalesce(1)).collect())
    assert a == b == c


def test_cancellation_counts_in_frequency_but_not_in_exploration(make_orders):
    rows = _rfm_rows()
    rows.append(line("C77", "S1", -1, "2010-01-05 10:00", 1.0, 1))
    orders = make_orders(rows)
    base = {r.customer_id: r for r in rfm.customer_rfm(orders).collect()}
    clean = {r.customer_id: r for r in rfm.rfm_exploration(orders).collect()}
    assert base[1].frequency == clean[1].frequency + 1


def test_tied_frequencies_rank_by_customer(make_orders):
    # 7 customers, equal frequency: f scores 1,1,2,3,4,5,5 by customer id
    rows = [line(f"i{c}", "S", 1, f"2010-01-{10 + c} 10:00", 10.0 * c, c) for c in range(1, 8)]
    out = rfm.customer_rfm(make_orders(rows)).orderBy("customer_id").collect()
    assert [r.f_score for r in out] == [1, 1, 2, 3, 4, 5, 5]


def test_single_customer_fails(make_orders):
    with pytest.raises(Exception):
        rfm.customer_rfm(make_orders([line("1", "S", 1, "2010-01-01 10:00", 1.0, 1)])).collect()


def test_churn_keeps_returns_only_customer_and_counts_lines(make_orders):
    orders = make_orders(_rfm_rows())
    out = {r.customer_id: r for r in churn.churn_risk(orders).collect()}
    assert 99 in out and out[99].frequency == 2
    assert all(r.churn_score in {14.0 + k for k in range(0, 80)} for r in out.values())
    latest_first = max(r.days_since_first_purchase for r in out.values())
    assert min(r.days_since_first_purchase for r in out.values()) == 0 and latest_first > 0


def test_geo_customer_in_two_countries_counts_in_both(make_orders):
    rows = _rfm_rows()
    rows.append(line("x1", "S1", 1, "2010-02-02 10:00", 3.0, 1, "France"))  # customer 1 is UK otherwise
    g = {r.country: r for r in geo.geographic_analysis(make_orders(rows)).collect()}
    uk = make_orders(rows).where((F.col("country") == "UK") & (F.col("price") > 0) & (F.col("quantity") > 0))
    assert g["UK"].total_customers == uk.select("customer_id").distinct().count()
    assert g["France"].total_customers == 7
    assert sorted(r.priority_rank for r in g.values()) == [1, 2]


def test_geo_revenue_tie_breaks_by_name(make_orders):
    rows = [line("a", "S", 1, "2010-01-01 10:00", 5.0, 1, "Beta"), line("b", "S", 1, "2010-01-02 10:00", 5.0, 2, "Alpha")]
    g = {r.country: r.priority_rank for r in geo.geographic_analysis(make_orders(rows)).collect()}
    assert g == {"Alpha": 1, "Beta": 2}


def test_clv_lifetime_guards(make_orders):
    rows = _rfm_rows()
    rows.append(line("z", "S", 1, "2010-01-01 23:00", 500.0, 1))
    orders = make_orders(rows)
    r = rfm.customer_rfm(orders)
    a = {x.customer_id: x for x in clv.clv_forecast(r, orders).collect()}
    base = customers.customer_base(orders)
    b = {x.customer_id: x for x in clv.clv_from_base(rfm.customer_rfm(orders, base=base), base).collect()}
    assert a == b
    for x in a.values():
        assert x.clv_24months == pytest.approx(2 * x.clv_12months)
        assert x.avg_monthly_value <= float(x.historical_value) + 1e-9  # months >= 1


def test_product_frequency_is_customer_count_and_orphans_count_sales(make_orders):
    orders = make_orders(_rfm_rows())
    p = product.product_rfm(orders)
    assert p.where(F.col("frequency") != F.col("total_customers")).count() == 0
    lib = library.orphan_products(p, orders).collect()
    for r in lib:
        assert r.total_sales == orders.where(F.col("stock_code") == r.stock_code).count()


def test_orphan_without_sales_counts_zero(spark, make_orders):
    orders = make_orders(_rfm_rows())
    p = product.product_rfm(orders)
    extra = p.limit(1).withColumn("stock_code", F.lit("NOSALE")).withColumn("performance", F.lit("Orphan")).withColumn("total_customers", F.lit(0))
    out = {r.stock_code: r.total_sales for r in library.orphan_products(p.unionByName(extra), orders).collect()}
    assert out["NOSALE"] == 0


def test_cleaning_report_steps(make_orders):
    rows = _rfm_rows()
    rows += [rows[0], line("n1", "S", 1, "2010-01-01 10:00", 1.0, None), line("p1", "S", 0, "2010-01-01 10:00", 1.0, 5)]
    rep = {r.step: (r.removed, r.remaining) for r in cleaning.cleaning_report(make_orders(rows)).collect()}
    assert rep["duplicates"][0] == 1
    assert rep["missing_customer"][0] == 1
    assert rep["cancellations"][0] == 1
    assert rep["non_positive"][0] == 1


def test_hot_customer_product_and_country(spark, make_orders):
    """A third of all lines on one customer / product / country: results do not
    depend on the partitioning."""
    rows = _rfm_rows(60)
    hot = [line(f"h{i}", "S1", 1 + i % 3, f"2010-0{1 + i % 9}-0{1 + i % 9} 10:00", 2.5, 7, "UK") for i in range(len(rows) // 2)]
    orders = make_orders(rows + hot).repartition(12)
    for fn in (rfm.customer_rfm, product.product_rfm, churn.churn_risk):
        assert sorted(fn(orders).collect()) == sorted(fn(orders.coalesce(1)).collect())
    g = {r.country: r for r in geo.geographic_analysis(orders).collect()}
    assert g["UK"].total_orders == orders.where((F.col("country") == "UK") & (F.col("quantity") > 0)).select("invoice").distinct().count()


def test_customer_without_valid_dates_is_left_out(make_orders):
    rows = _rfm_rows()
    rows.append(line("nd1", "S2", 4, "2010-01-01 10:00", 9.0, 500))
    rows[-1] = rows[-1][:4] + (None,) + rows[-1][5:]  # its only date is missing
    orders = make_orders(rows)
    assert 500 not in {r.customer_id for r in rfm.customer_rfm(orders).collect()}
    assert 500 not in {r.customer_id for r in churn.churn_risk(orders).collect()}
    assert len(rfm.customer_rfm(orders).collect()) == 12


def test_first_non_null_description(make_orders):
    rows = _rfm_rows()
    rows += [
        line("d1", "NEWP", 1, "2010-01-02 10:00", 3.0, 1, desc=None),
        line("d2", "NEWP", 1, "2010-01-03 10:00", 3.0, 2, desc="LATER NAME"),
        line("d3", "NEWP", 1, "2010-01-03 10:00", 3.0, 3, desc="A NAME SAME DAY"),
        line("d4", "NEWP", 1, "2010-05-03 10:00", 3.0, 4, desc="LAST"),
    ]
    names = {r.stock_code: r.product_name for r in product.product_rfm(make_orders(rows)).collect()}
    assert names["NEWP"] == "A NAME SAME DAY"  # earliest dated non-null, ties by text


def test_zero_and_one_day_lifetimes(make_orders):
    rows = _rfm_rows()
    rows += [
        line("z1", "S1", 2, "2010-09-20 08:00", 60.0, 300),  # single purchase: zero-day lifetime
        line("o1", "S1", 1, "2010-09-20 08:00", 50.0, 301),
        line("o2", "S1", 1, "2010-09-21 09:00", 50.0, 301),  # one-day lifetime
        line("q1", "S1", 1, "2010-09-19 08:00", 5.0, 302),  # first purchase 1 day before the latest first
    ]
    orders = make_orders(rows)
    ch = {r.customer_id: r for r in churn.churn_risk(orders).collect()}
    latest_first = max(r.days_since_first_purchase for r in ch.values())
    assert latest_first > 0
    zero = [r for r in ch.values() if r.days_since_first_purchase == 0]
    one = [r for r in ch.values() if r.days_since_first_purchase == 1]
    assert zero and one
    assert all(r.purchase_frequency_per_month == float(r.frequency) for r in zero)  # 0 -> 1
    assert all(r.purchase_frequency_per_month == r.frequency / (1 / 30) for r in one)  # 1 day stays 1/30
    base = customers.customer_base(orders)
    fc = {r.customer_id: r for r in clv.clv_from_base(rfm.customer_rfm(orders, base=base), base).collect()}
    for cid in (300, 301):  # months clipped to 1: monthly value = whole history
        assert fc[cid].avg_monthly_value == float(fc[cid].historical_value)


@pytest.mark.parametrize("analysis", [rfm.customer_rfm, product.product_rfm, churn.churn_risk, geo.geographic_analysis])
def test_empty_input_fails(make_orders, analysis):
    with pytest.raises(ValueError, match="no rows"):
        analysis(make_orders([]))


def test_clv_keeps_null_for_undated_sales(make_orders):
    """A customer whose positive lines have no date: history, no forecast; both paths agree."""
    rows = _rfm_rows()
    rows += [line("u1", "S1", 3, None, 100.0, 777), line("u2", "S1", -1, "2010-02-02 10:00", 1.0, 777)]
    orders = make_orders(rows)
    base = customers.customer_base(orders)
    r = rfm.customer_rfm(orders, base=base)
    for out in (clv.clv_forecast(r, orders), clv.clv_from_base(r, base)):
        (u,) = out.where("customer_id = 777").collect()
        assert float(u.historical_value) == 300.0
        assert u.avg_monthly_value is None and u.clv_12months is None and u.clv_24months is None
