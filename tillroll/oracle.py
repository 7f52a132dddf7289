"""Reference SQL (DuckDB dialect) for every registered query.

Written independently of the Spark code, over the same pre-registered parquet
views, as the correctness oracle: same column names and types, values equal
row for row (conditional counts are written count(CASE WHEN c THEN 1 END),
BIGINT like Spark's count_if). Conventions shared with the Spark side: money exact as
DECIMAL(18,4)/DECIMAL(38,4); ratios as double from exact operands; rounding
half away from zero on decimals
(ROUND) or half to even on scaled doubles (data frames); whole days via date_sub('day', a, b); quintile
edges via quantile_cont (position (n-1)p, linear).
"""

from __future__ import annotations

ORDERS_V = """
orders_v AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS invoice,
         CAST(l.l_partkey AS VARCHAR) AS stock_code,
         p.p_name AS description,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS INTEGER) AS quantity,
         o.o_orderdate AS invoice_date,
         CAST(CAST(p.p_retailprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS price,
         o.o_custkey AS customer_id,
         n.n_name AS country
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

Q5 = "[0.0, 0.2, 0.4, 0.6, 0.8, 1.0]::DOUBLE[]"


def _bucket(value: str, edges: str) -> str:
    """1 + number of interior edges strictly below value."""
    parts = " + ".join(f"(CASE WHEN CAST({value} AS DOUBLE) > {edges}[{k}] THEN 1 ELSE 0 END)" for k in range(2, 6))
    return f"(1 + {parts})"


def _dup_check(edges: str, name: str) -> str:
    cond = " OR ".join(f"{edges}[{k}] = {edges}[{k + 1}]" for k in range(1, 6))
    return f"CASE WHEN {cond} THEN error('duplicate edges {name}') ELSE 0 END"


def _rank_bucket(rn: str, n: str) -> str:
    return f"CAST(greatest(1, (5 * ({rn} - 1) + {n} - 2) // ({n} - 1)) AS INTEGER)"


def _rank_bucket_sum() -> str:
    return (
        f"(6 - {_rank_bucket('rn_r', 'n')} + {_rank_bucket('rn_f', 'n')} + {_rank_bucket('rn_m', 'n')})"
    )


# --- customer RFM ----------------------------------------------------------

def _rfm_ctes(clean: bool = False, p: str = "rfm") -> str:
    if clean:
        src = f"""
{p}_lines AS (
  SELECT *, price * quantity AS amount FROM (SELECT DISTINCT * FROM orders_v) d
  WHERE customer_id IS NOT NULL AND NOT coalesce(starts_with(invoice, 'C'), false)
    AND quantity > 0 AND price > 0
),"""
        shift = " + INTERVAL 1 DAY"
    else:
        src = f"""
{p}_lines AS (SELECT *, price * quantity AS amount FROM orders_v WHERE customer_id IS NOT NULL),"""
        shift = ""
    return f"""{src}
{p}_pc AS (
  SELECT customer_id, max(invoice_date) AS last_d,
         CAST(count(DISTINCT invoice) AS INTEGER) AS frequency,
         CAST(sum(amount) AS DECIMAL(38,4)) AS monetary
  FROM {p}_lines GROUP BY customer_id
),
{p}_ref AS (SELECT max(last_d){shift} AS ref_d FROM {p}_pc),
{p}_m AS (
  SELECT customer_id, CAST(date_sub('day', last_d, ref_d) AS INTEGER) AS recency, frequency, monetary
  FROM {p}_pc, {p}_ref WHERE monetary > 0 AND last_d IS NOT NULL
),
{p}_rk AS (
  SELECT *, row_number() OVER (ORDER BY frequency, customer_id) AS rn, count(*) OVER () AS n FROM {p}_m
),
{p}_e AS (
  SELECT quantile_cont(CAST(recency AS DOUBLE), {Q5}) AS re,
         quantile_cont(CAST(monetary AS DOUBLE), {Q5}) AS me
  FROM {p}_m
),
{p}_s AS (
  SELECT customer_id, recency, frequency, monetary,
         CAST(6 - {_bucket('recency', 're')} + {_dup_check('re', 'recency')} AS INTEGER) AS r_score,
         {_rank_bucket('rn', 'n')} AS f_score,
         CAST({_bucket('monetary', 'me')} + {_dup_check('me', 'monetary')} AS INTEGER) AS m_score
  FROM {p}_rk, {p}_e
)"""


RFM_SEGMENT = """CASE
    WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
    WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Clients Fidèles'
    WHEN r_score >= 4 AND f_score <= 2 THEN 'Nouveaux Clients'
    WHEN r_score >= 3 AND f_score >= 1 AND m_score >= 2 THEN 'Clients Potentiels'
    WHEN r_score <= 2 AND f_score >= 3 THEN 'À Risque'
    WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Perdus'
    WHEN r_score <= 2 AND f_score <= 2 AND m_score >= 3 THEN 'À Réactiver'
    ELSE 'Moyens' END"""

EXPLORATION_SEGMENT = """CASE
    WHEN r_score >= 4 AND f_score >= 4 THEN 'Champions'
    WHEN r_score >= 3 AND f_score >= 3 THEN 'Clients fidèles'
    WHEN r_score >= 4 AND f_score <= 2 THEN 'Potentiels fidèles'
    WHEN r_score <= 2 AND f_score >= 3 THEN 'À risque'
    WHEN r_score <= 2 AND f_score <= 2 THEN 'En hibernation'
    WHEN r_score = 1 AND f_score = 1 THEN 'Perdus'
    ELSE 'Autres' END"""


def rfm_cte(name: str = "rfm", clean: bool = False) -> str:
    seg = EXPLORATION_SEGMENT if clean else RFM_SEGMENT
    return f"""{_rfm_ctes(clean, name)},
{name} AS (
  SELECT customer_id, recency, frequency, monetary, r_score, f_score, m_score,
         CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_score,
         {seg} AS segment
  FROM {name}_s
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes)


def q(ctes: list[str], body: str) -> str:
    return with_ctes(ORDERS_V, *ctes) + "\n" + body


SQL: dict[str, str] = {}

SQL["customer_rfm"] = q([rfm_cte()], "SELECT * FROM rfm")
SQL["rfm_exploration"] = q([rfm_cte(clean=True)], "SELECT * FROM rfm")


# --- product RFM -----------------------------------------------------------

PRODUCT_CTE = f"""
pr_lines AS (
  SELECT *, price * quantity AS amount FROM orders_v
  WHERE customer_id IS NOT NULL AND quantity > 0 AND price > 0
),
pr_desc AS (
  SELECT stock_code, arg_min(description, (first_d, description)) AS product_name
  FROM (SELECT stock_code, description, min(invoice_date) AS first_d
        FROM pr_lines WHERE description IS NOT NULL GROUP BY stock_code, description) d
  GROUP BY stock_code
),
pr_agg AS (
  SELECT stock_code, max(invoice_date) AS last_d,
         CAST(count(DISTINCT customer_id) AS INTEGER) AS total_customers,
         CAST(sum(amount) AS DECIMAL(38,4)) AS monetary,
         CAST(sum(price) AS DOUBLE) / CAST(count(price) AS DOUBLE) AS avg_price,
         CAST(sum(quantity) AS BIGINT) AS total_quantity
  FROM pr_lines GROUP BY stock_code
),
pr_m AS (
  SELECT a.*, d.product_name,
         CAST(date_sub('day', last_d, (SELECT max(last_d) FROM pr_agg)) AS INTEGER) AS recency
  FROM pr_agg a LEFT JOIN pr_desc d USING (stock_code) WHERE a.last_d IS NOT NULL
),
pr_rk AS (
  SELECT *,
         row_number() OVER (ORDER BY recency, stock_code) AS rn_r,
         row_number() OVER (ORDER BY total_customers, stock_code) AS rn_f,
         row_number() OVER (ORDER BY monetary, stock_code) AS rn_m,
         count(*) OVER () AS n
  FROM pr_m
),
products AS (
  SELECT stock_code, product_name, recency, total_customers AS frequency, monetary,
         6 - {_rank_bucket('rn_r', 'n')} AS r_score,
         {_rank_bucket('rn_f', 'n')} AS f_score,
         {_rank_bucket('rn_m', 'n')} AS m_score,
         total_customers, avg_price, total_quantity,
         CASE WHEN {_rank_bucket_sum()} >= 12 THEN 'Star'
              WHEN {_rank_bucket_sum()} >= 9 THEN 'Strong'
              WHEN {_rank_bucket_sum()} >= 6 THEN 'Stable'
              ELSE 'Orphan' END AS performance
  FROM pr_rk
)"""

# --- churn -----------------------------------------------------------------

CHURN_CTE = f"""
ch_pc AS (
  SELECT customer_id, max(invoice_date) AS last_d,
         CAST(count(invoice_date) AS INTEGER) AS frequency, min(invoice_date) AS first_d
  FROM orders_v WHERE customer_id IS NOT NULL GROUP BY customer_id
),
ch_m AS (
  SELECT customer_id,
         CAST(date_sub('day', last_d, (SELECT max(last_d) FROM ch_pc)) AS INTEGER) AS recency,
         frequency,
         CAST(date_sub('day', first_d, (SELECT max(first_d) FROM ch_pc)) AS INTEGER) AS days_since_first_purchase
  FROM ch_pc WHERE last_d IS NOT NULL
),
ch_m2 AS (
  SELECT *, CAST(floor(days_since_first_purchase / 30.0) AS INTEGER) AS months_active,
         CAST(frequency AS DOUBLE) / (CASE WHEN days_since_first_purchase = 0 THEN 1.0
              ELSE CAST(days_since_first_purchase AS DOUBLE) / 30.0 END) AS purchase_frequency_per_month
  FROM ch_m
),
ch_e AS (
  SELECT quantile_cont(CAST(recency AS DOUBLE), {Q5}) AS re,
         quantile_cont(purchase_frequency_per_month, {Q5}) AS fe
  FROM ch_m2
),
ch_w AS (
  SELECT m.*,
         [20, 40, 60, 80, 95][{_bucket('recency', 're')} + {_dup_check('re', 'recency')}] AS rw,
         [80, 60, 40, 20, 5][{_bucket('purchase_frequency_per_month', 'fe')} + {_dup_check('fe', 'rate')}] AS fw
  FROM ch_m2 m, ch_e
),
churn AS (
  SELECT customer_id, recency, frequency, days_since_first_purchase, purchase_frequency_per_month,
         months_active, CAST((6 * rw + 4 * fw) / 10 AS DOUBLE) AS churn_score,
         CASE WHEN (6 * rw + 4 * fw) / 10 >= 80 THEN '🔴 High'
              WHEN (6 * rw + 4 * fw) / 10 >= 60 THEN '🟠 Medium'
              WHEN (6 * rw + 4 * fw) / 10 >= 40 THEN '🟡 Low'
              ELSE '🟢 Very Low' END AS churn_risk,
         CASE WHEN (6 * rw + 4 * fw) / 10 >= 80 THEN '🎯 Win-back campaign + special offer'
              WHEN (6 * rw + 4 * fw) / 10 >= 60 THEN '📧 Engagement email + coupon'
              WHEN (6 * rw + 4 * fw) / 10 >= 40 THEN '💌 Regular newsletter'
              ELSE '🎉 VIP loyalty program' END AS recommendation
  FROM ch_w
)"""

# --- geography -------------------------------------------------------------

GEO_CTE = """
ge_lines AS (
  SELECT *, price * quantity AS amount FROM orders_v
  WHERE customer_id IS NOT NULL AND quantity > 0 AND price > 0
),
ge_ref AS (SELECT max(invoice_date) AS ref_d FROM ge_lines),
ge_cc AS (
  SELECT country, customer_id,
         CAST(date_sub('day', max(invoice_date), (SELECT ref_d FROM ge_ref)) AS INTEGER) AS rec,
         count(DISTINCT invoice) AS freq, CAST(sum(amount) AS DECIMAL(38,4)) AS mon
  FROM ge_lines WHERE country IS NOT NULL GROUP BY country, customer_id
),
ge_c AS (
  SELECT country, count(*) AS total_customers, CAST(sum(mon) AS DECIMAL(38,4)) AS total_revenue,
         CAST(trunc(CAST(sum(rec) AS DOUBLE) / CAST(count(rec) AS DOUBLE)) AS INTEGER) AS recency_avg,
         CAST(sum(freq) AS DOUBLE) / CAST(count(freq) AS DOUBLE) AS frequency_avg,
         CAST(sum(mon) AS DOUBLE) / CAST(count(mon) AS DOUBLE) AS monetary_avg
  FROM ge_cc GROUP BY country
),
ge_o AS (
  SELECT country, count(DISTINCT invoice) AS total_orders FROM ge_lines
  WHERE country IS NOT NULL GROUP BY country
),
ge_j AS (
  SELECT c.*, o.total_orders,
         CAST(c.total_revenue AS DOUBLE) / CAST(o.total_orders AS DOUBLE) AS avg_order_value,
         CAST(c.total_revenue AS DOUBLE) / CAST(c.total_customers AS DOUBLE) AS avg_customer_value
  FROM ge_c c JOIN ge_o o USING (country)
),
ge_q AS (
  SELECT quantile_cont(CAST(total_revenue AS DOUBLE), 0.75) AS rev75,
         quantile_cont(CAST(recency_avg AS DOUBLE), 0.25) AS rec25,
         quantile_cont(CAST(recency_avg AS DOUBLE), 0.5) AS rec50
  FROM ge_j
),
geo AS (
  SELECT country, total_customers, total_orders, total_revenue, avg_order_value, avg_customer_value,
         recency_avg, frequency_avg, monetary_avg,
         CASE WHEN CAST(total_revenue AS DOUBLE) >= rev75 AND recency_avg <= rec25 THEN '🟢 Established Leader'
              WHEN CAST(total_revenue AS DOUBLE) >= rev75 THEN '🟠 Declining'
              WHEN recency_avg <= rec50 THEN '🟡 Growing Opportunity'
              ELSE '🔴 Emerging Market' END AS market_growth_potential,
         CAST(row_number() OVER (ORDER BY total_revenue DESC, country) AS INTEGER) AS priority_rank
  FROM ge_j, ge_q
)"""

# --- lifetime value --------------------------------------------------------

CLV_CTE = """
cl_pc AS (
  SELECT customer_id, CAST(sum(price * quantity) AS DECIMAL(38,4)) AS historical_value,
         min(invoice_date) AS first_d, max(invoice_date) AS last_d
  FROM orders_v WHERE customer_id IS NOT NULL AND quantity > 0 AND price > 0
  GROUP BY customer_id
),
cl_j AS (
  SELECT r.customer_id, r.segment, p.historical_value,
         greatest(1.0, CAST(date_sub('day', p.first_d, p.last_d) AS DOUBLE) / 30.0) AS months,
         coalesce(CASE r.segment
            WHEN 'Champions' THEN 1.15 WHEN 'Clients Fidèles' THEN 1.10
            WHEN 'Nouveaux Clients' THEN 1.20 WHEN 'Clients Potentiels' THEN 1.08
            WHEN 'À Risque' THEN 0.85 WHEN 'Perdus' THEN 0.50
            WHEN 'À Réactiver' THEN 1.05 WHEN 'Moyens' THEN 1.00 END::DOUBLE, 1.0::DOUBLE) AS growth_rate
  FROM rfm r JOIN cl_pc p USING (customer_id)
),
clv AS (
  SELECT customer_id, segment, historical_value,
         CAST(historical_value AS DOUBLE) / months AS avg_monthly_value,
         CAST(historical_value AS DOUBLE) / months * 12.0 * growth_rate AS clv_12months,
         CAST(historical_value AS DOUBLE) / months * 24.0 * growth_rate AS clv_24months,
         growth_rate,
         CASE WHEN historical_value < 100 THEN '🟡 Low'
              WHEN months < 3 THEN '🟡 Medium'
              WHEN months >= 12 THEN '🟢 High'
              ELSE '🟡 Medium' END AS forecast_confidence
  FROM cl_j
)"""

SQL["product_rfm"] = q([PRODUCT_CTE], "SELECT * FROM products")
SQL["churn_risk"] = q([CHURN_CTE], "SELECT * FROM churn")
SQL["geographic_analysis"] = q([GEO_CTE], "SELECT * FROM geo")
SQL["clv_forecast"] = q([rfm_cte(), CLV_CTE], "SELECT * FROM clv")


# --- dashboard datasets ------------------------------------------------------

def _r(expr: str, d: int) -> str:
    """ROUND of a numeric value (half away from zero), as a double."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,8)), {d}) AS DOUBLE)"


def _re(expr: str, d: int) -> str:
    """Rounding of a data frame: half to even on the scaled double."""
    s = f"{10 ** d}.0"
    return f"(round_even(CAST({expr} AS DOUBLE) * {s}, 0) / {s})"


def _sum6(expr: str) -> str:
    return f"sum(CAST({expr} AS DECIMAL(28,6)))"


def _avg6(expr: str) -> str:
    return f"CAST({_sum6(expr)} AS DOUBLE) / count({expr})"


def _mean(expr: str) -> str:
    return f"(CAST(sum({expr}) AS DOUBLE) / CAST(count({expr}) AS DOUBLE))"


def _hist(src: str, value: str, bins: int, by: str | None, out: str) -> str:
    byc = f"{by}, " if by else ""
    return f"""
SELECT {byc}bin, lo + bin * (hi - lo) / {bins}.0 AS bin_start, lo + (bin + 1) * (hi - lo) / {bins}.0 AS bin_end,
       count(*) AS {out}
FROM (
  SELECT {byc}lo, hi,
         CASE WHEN hi - lo = 0 THEN 0
              ELSE least({bins - 1}, CAST(floor((CAST({value} AS DOUBLE) - lo) * {bins}.0 / (hi - lo)) AS INTEGER)) END AS bin
  FROM {src}, (SELECT min(CAST({value} AS DOUBLE)) AS lo, max(CAST({value} AS DOUBLE)) AS hi FROM {src} WHERE {value} IS NOT NULL) b
  WHERE {value} IS NOT NULL
) x
GROUP BY {byc}bin, lo, hi"""


RFM = [rfm_cte()]
PRODUCTS = [PRODUCT_CTE]
CHURN = [CHURN_CTE]
GEO = [GEO_CTE]
CLV = [rfm_cte(), CLV_CTE]

SQL["kpis"] = q([], """SELECT count(DISTINCT invoice) AS total_orders, count(DISTINCT customer_id) AS total_customers,
  CAST(sum(CASE WHEN quantity > 0 THEN price * quantity END) AS DECIMAL(38,4)) AS total_revenue,
  count(DISTINCT stock_code) AS total_products FROM orders_v""")
SQL["top_countries"] = q([], """SELECT country, count(DISTINCT customer_id) AS nb_clients FROM orders_v
  WHERE customer_id IS NOT NULL GROUP BY country ORDER BY nb_clients DESC, country NULLS LAST LIMIT 10""")
SQL["monthly_revenue"] = q([], """SELECT CAST(date_trunc('month', invoice_date) AS TIMESTAMP) AS mois,
  CAST(sum(price * quantity) AS DECIMAL(38,4)) AS revenue FROM orders_v WHERE quantity > 0 GROUP BY 1 ORDER BY 1""")
SQL["rfm_filtered"] = q(RFM, """SELECT * FROM rfm WHERE segment IN ('Champions', 'Clients Fidèles', 'À Risque')
  AND recency BETWEEN 30 AND 400 AND monetary BETWEEN 1000 AND 200000""")
SQL["segment_kpis"] = q(RFM, """SELECT count(CASE WHEN segment = 'Champions' THEN 1 END) AS champions, count(CASE WHEN segment = 'À Risque' THEN 1 END) AS at_risk,
  count(CASE WHEN segment = 'Perdus' THEN 1 END) AS lost FROM rfm""")
SQL["segment_distribution"] = q(RFM, """SELECT segment, count(*) AS customers,
  CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM rfm GROUP BY segment""")
SQL["segment_stats"] = q(RFM, f"""SELECT segment, count(*) AS clients, {_re(_mean('recency'), 1)} AS recence_moy,
  {_re(_mean('frequency'), 1)} AS frequence_moy, {_re(_mean('monetary'), 1)} AS montant_moy,
  {_re('sum(monetary)', 1)} AS montant_total FROM rfm GROUP BY segment""")
SQL["rfm_points"] = q(RFM, "SELECT customer_id, recency, frequency, monetary, segment FROM rfm")
SQL["recency_histogram"] = q(RFM, _hist("rfm", "recency", 50, "segment", "customers"))
SQL["monetary_histogram"] = q(RFM, _hist("rfm", "monetary", 50, "segment", "customers"))
SQL["rf_heatmap"] = q(RFM, """SELECT g.r_score, """ + ", ".join(f"coalesce(c.f_{v}, 0) AS f_{v}" for v in range(1, 6)) + """
  FROM (SELECT * FROM (VALUES (5), (4), (3), (2), (1)) t(r_score)) g
  LEFT JOIN (SELECT r_score, """ + ", ".join(f"count(CASE WHEN f_score = {v} THEN 1 END) AS f_{v}" for v in range(1, 6)) + """
             FROM rfm GROUP BY r_score) c USING (r_score)""")
SQL["rfm_detail"] = q(RFM, """SELECT customer_id AS "ID", recency AS "Récence (j)", frequency AS "Fréquence",
  monetary AS "Montant (€)", r_score AS "R", f_score AS "F", m_score AS "M", rfm_score AS "RFM", segment AS "Segment"
  FROM rfm""")
SQL["product_kpis"] = q(PRODUCTS, """SELECT count(CASE WHEN performance = 'Star' THEN 1 END) AS stars, count(CASE WHEN performance = 'Orphan' THEN 1 END) AS orphans,
  count(*) AS total_products FROM products""")
SQL["performance_distribution"] = q(PRODUCTS, "SELECT performance, count(*) AS products FROM products GROUP BY performance")
SQL["top_products"] = q(PRODUCTS, """SELECT stock_code, product_name, performance, monetary, total_customers FROM products
  ORDER BY monetary DESC, stock_code LIMIT 10""")
SQL["product_listing"] = q(PRODUCTS, """SELECT stock_code, product_name, performance, recency, total_customers, monetary,
  avg_price, total_quantity, r_score, f_score, m_score FROM products""")
SQL["churn_bands"] = q(CHURN, """SELECT count(CASE WHEN churn_score >= 80 THEN 1 END) AS high, count(CASE WHEN churn_score >= 60 AND churn_score < 80 THEN 1 END) AS medium,
  count(CASE WHEN churn_score >= 40 AND churn_score < 60 THEN 1 END) AS low, count(CASE WHEN churn_score < 40 THEN 1 END) AS very_low FROM churn""")
SQL["churn_histogram"] = q(CHURN, _hist("churn", "churn_score", 30, None, "customers"))
SQL["churn_high_risk"] = q(CHURN, "SELECT * FROM churn WHERE churn_score >= 80 ORDER BY churn_score DESC, customer_id LIMIT 50")
SQL["market_class_counts"] = q(GEO, """SELECT count(CASE WHEN contains(market_growth_potential, 'Established') THEN 1 END) AS established,
  count(CASE WHEN contains(market_growth_potential, 'Growing') THEN 1 END) AS growing,
  count(CASE WHEN contains(market_growth_potential, 'Emerging') THEN 1 END) AS emerging FROM geo""")
SQL["top_markets"] = q(GEO, "SELECT * FROM geo ORDER BY priority_rank LIMIT 10")
SQL["market_listing"] = q(GEO, "SELECT * FROM geo")
SQL["clv_totals"] = q(CLV, f"""SELECT {_r(_sum6('clv_12months'), 2)} AS total_clv_12, {_r(_sum6('clv_24months'), 2)} AS total_clv_24,
  {_r(_avg6('clv_12months'), 2)} AS avg_clv_12, count(CASE WHEN forecast_confidence = '🟢 High' THEN 1 END) AS high_confidence FROM clv""")
SQL["clv_by_segment"] = q(CLV, f"""SELECT segment, count(*) AS customers, {_r(_sum6('clv_12months'), 2)} AS clv_12_total,
  {_r(_sum6('clv_24months'), 2)} AS clv_24_total FROM clv GROUP BY segment""")
SQL["clv_top"] = q(CLV, "SELECT * FROM clv ORDER BY clv_24months DESC, customer_id LIMIT 30")
SQL["churn_summary"] = q(CHURN, "SELECT count(CASE WHEN churn_risk = '🔴 High' THEN 1 END) AS high_risk_customers FROM churn")
SQL["geo_top3"] = q(GEO, "SELECT priority_rank, country, total_revenue FROM geo ORDER BY priority_rank LIMIT 3")
SQL["clv_summary"] = q(CLV, f"""SELECT {_r(_sum6('clv_24months'), 2)} AS total_clv_24, {_r(_avg6('clv_12months'), 2)} AS avg_clv_12 FROM clv""")

# --- query library -------------------------------------------------------------

SQL["lib_star_products"] = q(PRODUCTS, """SELECT stock_code, product_name, performance, total_customers, total_quantity,
  monetary, r_score, f_score, m_score FROM products WHERE performance = 'Star' ORDER BY monetary DESC, stock_code LIMIT 10""")
SQL["lib_orphan_products"] = q(PRODUCTS, """SELECT p.stock_code, p.product_name, p.performance, p.total_customers, p.monetary,
  CAST((SELECT count(*) FROM orders_v o WHERE o.stock_code = p.stock_code) AS BIGINT) AS total_sales
  FROM products p WHERE p.performance = 'Orphan' ORDER BY p.total_customers ASC, p.stock_code LIMIT 20""")
SQL["lib_performance_summary"] = q(PRODUCTS, f"""SELECT performance, count(*) AS product_count, {_mean('monetary')} AS avg_revenue,
  CAST(sum(monetary) AS DECIMAL(38,4)) AS total_revenue, {_mean('total_customers')} AS avg_customers
  FROM products GROUP BY performance""")
SQL["lib_revenue_rank"] = q(PRODUCTS, """SELECT * FROM (SELECT CAST(rank() OVER (ORDER BY monetary DESC) AS INTEGER) AS rank,
  stock_code, product_name, monetary, total_customers, performance FROM products) r ORDER BY rank, stock_code LIMIT 20""")
SQL["lib_high_risk_customers"] = q(CHURN, """SELECT customer_id, churn_score, churn_risk, recency, frequency, recommendation
  FROM churn WHERE churn_score >= 80 ORDER BY churn_score DESC, customer_id LIMIT 50""")
SQL["lib_churn_distribution"] = q(CHURN, f"""SELECT churn_risk, count(*) AS customer_count, {_r(_avg6('churn_score'), 1)} AS avg_score,
  min(churn_score) AS min_score, max(churn_score) AS max_score FROM churn GROUP BY churn_risk""")
SQL["lib_recommendation_breakdown"] = q(CHURN, f"""SELECT recommendation, count(*) AS customer_count,
  {_r(_avg6('churn_score'), 1)} AS avg_score FROM churn GROUP BY recommendation""")
SQL["lib_long_inactive"] = q(CHURN, """SELECT customer_id, recency, frequency, months_active, purchase_frequency_per_month, churn_score
  FROM churn WHERE recency > 180 AND frequency < 5 ORDER BY recency DESC, customer_id LIMIT 30""")
SQL["lib_medium_risk_targets"] = q(CHURN, """SELECT customer_id, churn_score, recency, frequency, recommendation FROM churn
  WHERE churn_score BETWEEN 60 AND 79 ORDER BY churn_score DESC, customer_id LIMIT 100""")
SQL["lib_top_countries"] = q(GEO, """SELECT priority_rank, country, total_customers, total_orders, total_revenue, avg_order_value,
  avg_customer_value, market_growth_potential FROM geo ORDER BY priority_rank LIMIT 5""")
SQL["lib_growth_opportunities"] = q(GEO, """SELECT priority_rank, country, total_customers, total_revenue, market_growth_potential,
  recency_avg, frequency_avg, monetary_avg FROM geo
  WHERE market_growth_potential IN ('🟡 Growing Opportunity', '🔴 Emerging Market')""")
SQL["lib_declining_markets"] = q(GEO, """SELECT country, total_customers, total_revenue, market_growth_potential,
  recency_avg AS days_since_last_order FROM geo WHERE market_growth_potential = '🟠 Declining'""")
SQL["lib_countries_ranked"] = q(GEO, f"""SELECT priority_rank, country, total_customers AS cust_count, total_orders AS orders,
  CAST(round(total_revenue, 2) AS DECIMAL(38,2)) AS revenue, {_r('avg_customer_value', 2)} AS avg_cust_value,
  market_growth_potential FROM geo""")
SQL["lib_market_benchmark"] = q(GEO, f"""SELECT market_growth_potential, count(*) AS country_count,
  {_r(_mean('total_customers'), 0)} AS avg_customers, {_r(_mean('total_revenue'), 0)} AS avg_revenue,
  {_r(_avg6('avg_customer_value'), 2)} AS avg_customer_value FROM geo GROUP BY market_growth_potential""")
SQL["lib_top_clv"] = q(CLV, "SELECT * FROM clv ORDER BY clv_24months DESC, customer_id LIMIT 20")
SQL["lib_clv_segment_summary"] = q(CLV, f"""SELECT segment, count(*) AS customer_count, {_r(_mean('historical_value'), 2)} AS avg_historical,
  {_r(_avg6('clv_12months'), 2)} AS avg_12m, {_r(_avg6('clv_24months'), 2)} AS avg_24m,
  {_r(_sum6('clv_24months'), 0)} AS total_24m_forecast, {_r(_avg6('growth_rate'), 2)} AS avg_growth
  FROM clv GROUP BY segment""")
SQL["lib_best_bets"] = q(CLV, """SELECT customer_id, segment, clv_24months, forecast_confidence, growth_rate FROM clv
  WHERE forecast_confidence = '🟢 High' ORDER BY clv_24months DESC, customer_id LIMIT 50""")
SQL["lib_forecast_vs_actual"] = q(CLV, f"""SELECT * FROM (SELECT c.customer_id, c.segment, r.monetary AS historical_actual,
  c.clv_12months AS forecast_12m, c.clv_24months AS forecast_24m,
  {_r('c.clv_12months / nullif(CAST(r.monetary AS DOUBLE), 0.0)', 2)} AS growth_multiplier
  FROM clv c JOIN rfm r ON c.customer_id = r.customer_id WHERE r.monetary > 0) x
  ORDER BY growth_multiplier DESC, customer_id LIMIT 30""")
SQL["lib_champions_premium"] = q(CLV, """SELECT customer_id, clv_24months, growth_rate, forecast_confidence FROM clv
  WHERE segment = 'Champions' AND forecast_confidence = '🟢 High' ORDER BY clv_24months DESC, customer_id LIMIT 30""")
SQL["lib_total_forecast"] = q(CLV, """SELECT CAST(sum(clv_12months) AS DECIMAL(15,2)) AS total_revenue_12m,
  CAST(sum(clv_24months) AS DECIMAL(15,2)) AS total_revenue_24m, count(*) AS total_customers,
  CAST(sum(clv_24months) / count(*) AS DECIMAL(10,2)) AS avg_clv_per_customer FROM clv""")

# --- profiling ---------------------------------------------------------------

_COLS = ["invoice", "stock_code", "description", "quantity", "invoice_date", "price", "customer_id", "country"]
_TYPES = ["string", "string", "string", "int", "timestamp_ntz", "decimal(18,4)", "bigint", "string"]

SQL["profile_columns"] = q([], "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT (SELECT count(*) FROM orders_v) AS rows, {i} AS position, '{c}' AS col_name, '{t}' AS dtype, "
    f"(SELECT count({c}) FROM orders_v) AS non_null"
    for i, (c, t) in enumerate(zip(_COLS, _TYPES))) + ") x")


def _describe_num(i: int, c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (
        f"SELECT {i} AS position, '{c}' AS col_name, count({c}) AS count, {_r(_mean(c), 6)} AS mean, "
        f"{_r(f'stddev_samp({x})', 6)} AS std, min({x}) AS min, {_r(f'quantile_cont({x}, 0.25)', 6)} AS p25, "
        f"{_r(f'quantile_cont({x}, 0.5)', 6)} AS p50, {_r(f'quantile_cont({x}, 0.75)', 6)} AS p75, max({x}) AS max "
        f"FROM orders_v"
    )


def _describe_txt(i: int, c: str) -> str:
    return (
        f"SELECT {i} AS position, '{c}' AS col_name, CAST(sum(f) AS BIGINT) AS count, count(*) AS unique, "
        f"arg_min(v, (-f, v)) AS top, max(f) AS freq "
        f"FROM (SELECT {c} AS v, count(*) AS f FROM orders_v WHERE {c} IS NOT NULL GROUP BY {c}) g"
    )


SQL["describe_numeric"] = q([], " UNION ALL ".join(_describe_num(i, c) for i, c in enumerate(["quantity", "price", "customer_id"])))
SQL["describe_text"] = q([], " UNION ALL ".join(_describe_txt(i, c) for i, c in enumerate(["invoice", "stock_code", "description", "country"])))
SQL["missing_values"] = q([], " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS col_name, count(CASE WHEN {c} IS NULL THEN 1 END) AS missing, "
    f"{_re(f'CAST(count(CASE WHEN {c} IS NULL THEN 1 END) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE)', 2)} AS missing_pct FROM orders_v"
    for i, c in enumerate(_COLS)))
SQL["duplicates"] = q([], f"""SELECT rows, rows - d AS duplicates, {_re('CAST(rows - d AS DOUBLE) * 100.0 / CAST(rows AS DOUBLE)', 2)} AS duplicate_pct
  FROM (SELECT count(*) AS rows FROM orders_v), (SELECT count(*) AS d FROM (SELECT DISTINCT * FROM orders_v))""")
SQL["distinct_counts"] = q([], """SELECT count(DISTINCT customer_id) AS customers, count(CASE WHEN customer_id IS NULL THEN 1 END) AS rows_without_customer,
  count(DISTINCT invoice) AS invoices, count(DISTINCT country) AS countries FROM orders_v""")
SQL["top_countries_by_rows"] = q([], """SELECT country, count(*) AS rows FROM orders_v WHERE country IS NOT NULL
  GROUP BY country ORDER BY rows DESC, country LIMIT 10""")
SQL["price_histogram"] = q([], _hist("(SELECT * FROM orders_v WHERE price BETWEEN 0 AND 50)", "price", 50, None, "lines"))
SQL["quantity_histogram"] = q([], _hist("(SELECT * FROM orders_v WHERE quantity BETWEEN 0 AND 100)", "quantity", 50, None, "lines"))


def _box(src: str, value: str) -> str:
    x = f"CAST({value} AS DOUBLE)"
    return f"""
SELECT n, {_r('q1', 6)} AS q1, {_r('median', 6)} AS median, {_r('q3', 6)} AS q3, {_r('q3 - q1', 6)} AS iqr,
       min(CASE WHEN {x} >= q1 - 1.5 * (q3 - q1) THEN {x} END) AS whisker_low,
       max(CASE WHEN {x} <= q3 + 1.5 * (q3 - q1) THEN {x} END) AS whisker_high,
       count(CASE WHEN {x} < q1 - 1.5 * (q3 - q1) OR {x} > q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
FROM {src} s, (SELECT count(*) AS n, quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS median,
                      quantile_cont({x}, 0.75) AS q3 FROM {src} t WHERE {value} IS NOT NULL) b
WHERE {value} IS NOT NULL
GROUP BY n, q1, median, q3"""


SQL["price_box"] = q([], _box("(SELECT * FROM orders_v WHERE price BETWEEN 0 AND 50)", "price"))
SQL["quantity_box"] = q([], _box("(SELECT * FROM orders_v WHERE quantity BETWEEN 0 AND 100)", "quantity"))
SQL["anomaly_counts"] = q([], """SELECT count(CASE WHEN quantity < 0 THEN 1 END) AS negative_quantity, count(CASE WHEN price <= 0 THEN 1 END) AS non_positive_price,
  count(CASE WHEN customer_id IS NULL THEN 1 END) AS missing_customer, count(CASE WHEN description IS NULL OR trim(description) = '' THEN 1 END) AS empty_description
  FROM orders_v""")
SQL["amount_stats"] = q([], f"""SELECT CAST(min(price * quantity) AS DECIMAL(38,4)) AS min_amount,
  CAST(max(price * quantity) AS DECIMAL(38,4)) AS max_amount, {_mean('price * quantity')} AS mean_amount,
  CAST(sum(price * quantity) AS DECIMAL(38,4)) AS total_amount FROM orders_v""")
SQL["date_range"] = q([], """SELECT min(invoice_date) AS first_date, max(invoice_date) AS last_date,
  CAST(date_sub('day', min(invoice_date), max(invoice_date)) AS INTEGER) AS span_days FROM orders_v""")
SQL["lines_per_customer"] = q([], f"""SELECT min(n) AS min_lines, max(n) AS max_lines, {_mean('n')} AS mean_lines
  FROM (SELECT customer_id, count(*) AS n FROM orders_v WHERE customer_id IS NOT NULL GROUP BY customer_id) c""")
SQL["exploration_segment_summary"] = q([rfm_cte(clean=True)], f"""SELECT segment, count(*) AS customers,
  {_re(_mean('recency'), 1)} AS recency, {_re(_mean('frequency'), 1)} AS frequency, {_re(_mean('monetary'), 1)} AS monetary
  FROM rfm GROUP BY segment""")
SQL["cleaning_report"] = q([], """SELECT * FROM (
  SELECT 1 AS step_no, 'duplicates' AS step, total - d0 AS removed, d0 AS remaining FROM s UNION ALL
  SELECT 2, 'missing_customer', d0 - d1, d1 FROM s UNION ALL
  SELECT 3, 'cancellations', d1 - d2, d2 FROM s UNION ALL
  SELECT 4, 'non_positive', d2 - d3, d3 FROM s) x""".replace("FROM s", """FROM (SELECT (SELECT count(*) FROM orders_v) AS total,
    count(*) AS d0, count(CASE WHEN customer_id IS NOT NULL THEN 1 END) AS d1,
    count(CASE WHEN customer_id IS NOT NULL AND NOT coalesce(starts_with(invoice, 'C'), false) THEN 1 END) AS d2,
    count(CASE WHEN customer_id IS NOT NULL AND NOT coalesce(starts_with(invoice, 'C'), false) AND coalesce(quantity > 0 AND price > 0, false) THEN 1 END) AS d3
    FROM (SELECT DISTINCT * FROM orders_v) u) s"""))

# --- sources -------------------------------------------------------------------

AWKWARD = """SELECT * REPLACE (CASE CAST(stock_code AS BIGINT) % 5
    WHEN 1 THEN '"' || description || '"; x' WHEN 2 THEN description || chr(10) || description WHEN 3 THEN ''
    ELSE description END AS description) FROM orders_v"""
SQL["csv_roundtrip"] = q([], AWKWARD)
SQL["stream_ingest"] = q([], AWKWARD)
SQL["csv_reject_report"] = q([], """SELECT r.reason, (SELECT count(*) FROM orders_v WHERE CAST(stock_code AS BIGINT) % 7 = r.n) AS rows
  FROM (VALUES ('wrong_fields', -1), ('bad_price', 1), ('bad_quantity', 3), ('bad_customer', 5), ('bad_date', 6)) r(reason, n)""")
SQL["publish_rfm"] = q([rfm_cte("rfm"), rfm_cte("prev", clean=True)], """SELECT
  coalesce(n.customer_id, o.customer_id) AS customer_id,
  CASE WHEN n.customer_id IS NOT NULL THEN n.recency ELSE o.recency END AS recency,
  CASE WHEN n.customer_id IS NOT NULL THEN n.frequency ELSE o.frequency END AS frequency,
  CAST(CASE WHEN n.customer_id IS NOT NULL THEN n.monetary ELSE o.monetary END AS DECIMAL(10,2)) AS monetary,
  CASE WHEN n.customer_id IS NOT NULL THEN n.r_score ELSE o.r_score END AS r_score,
  CASE WHEN n.customer_id IS NOT NULL THEN n.f_score ELSE o.f_score END AS f_score,
  CASE WHEN n.customer_id IS NOT NULL THEN n.m_score ELSE o.m_score END AS m_score,
  CASE WHEN n.customer_id IS NOT NULL THEN n.rfm_score ELSE o.rfm_score END AS rfm_score,
  CASE WHEN n.customer_id IS NOT NULL THEN n.segment ELSE o.segment END AS segment,
  n.customer_id IS NOT NULL AS updated_in_run
FROM prev o FULL OUTER JOIN rfm n ON o.customer_id = n.customer_id""")
SQL["price_histogram_full"] = q([], _hist("orders_v", "price", 50, None, "lines"))
SQL["price_box_full"] = q([], _box("orders_v", "price"))

# --- cancellation invoices and remaining datasets ---------------------------------

ORDERS_V_C = ORDERS_V.replace(
    "SELECT CAST(o.o_orderkey AS VARCHAR) AS invoice,",
    "SELECT CASE WHEN l.l_returnflag = 'R' THEN 'C' || CAST(o.o_orderkey AS VARCHAR) ELSE CAST(o.o_orderkey AS VARCHAR) END AS invoice,",
)


def q_c(ctes: list[str], body: str) -> str:
    return with_ctes(ORDERS_V_C, *ctes) + "\n" + body


SQL["customer_rfm_cancellations"] = q_c([rfm_cte()], "SELECT * FROM rfm")
SQL["cleaning_report_cancellations"] = SQL["cleaning_report"].replace(ORDERS_V.strip(), ORDERS_V_C.strip())
SQL["rfm_detail_counts"] = q(RFM, """SELECT (SELECT count(*) FROM rfm WHERE segment IN ('Champions', 'Clients Fidèles', 'À Risque')
  AND recency BETWEEN 30 AND 400 AND monetary BETWEEN 1000 AND 200000) AS shown, (SELECT count(*) FROM rfm) AS total""")


def _box_by(src: str, value: str, by: str) -> str:
    x = f"CAST({value} AS DOUBLE)"
    return f"""
SELECT s.{by}, n, q1, median, q3, q3 - q1 AS iqr,
       min(CASE WHEN {x} >= q1 - 1.5 * (q3 - q1) THEN {x} END) AS whisker_low,
       max(CASE WHEN {x} <= q3 + 1.5 * (q3 - q1) THEN {x} END) AS whisker_high,
       count(CASE WHEN {x} < q1 - 1.5 * (q3 - q1) OR {x} > q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
FROM {src} s JOIN (SELECT {by}, count(*) AS n, quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS median,
                          quantile_cont({x}, 0.75) AS q3 FROM {src} WHERE {value} IS NOT NULL GROUP BY {by}) b USING ({by})
WHERE {value} IS NOT NULL
GROUP BY s.{by}, n, q1, median, q3"""


SQL["exploration_recency_box"] = q([rfm_cte(clean=True)], _box_by("rfm", "recency", "segment"))


SQL["customer_rfm_incremental"] = SQL["customer_rfm"]

# --- ordered marts, values to choose from, exploration datasets ----------------

SQL["churn_mart"] = SQL["churn_risk"]
SQL["clv_mart"] = SQL["clv_forecast"]
SQL["churn_risk_incremental"] = SQL["churn_risk"]
SQL["clv_forecast_incremental"] = SQL["clv_forecast"]
SQL["segment_values"] = q(RFM, "SELECT DISTINCT segment FROM rfm")
SQL["country_values"] = q([], "SELECT DISTINCT country FROM orders_v WHERE country IS NOT NULL")
EXPLORATION = [rfm_cte(clean=True)]
for _name, _limit in (("recency", None), ("frequency", 50), ("monetary", 5000)):
    _src = "rfm" if _limit is None else f"(SELECT * FROM rfm WHERE {_name} <= {_limit})"
    SQL[f"exploration_{_name}_histogram"] = q(EXPLORATION, _hist(_src, _name, 50, None, "customers"))
SQL["exploration_describe"] = q(EXPLORATION, " UNION ALL ".join(
    _describe_num(i, c).replace("FROM orders_v", "FROM rfm") for i, c in enumerate(["recency", "frequency", "monetary"])))
SQL["exploration_segment_shares"] = q(EXPLORATION, """SELECT segment, count(*) AS customers,
  round_even(CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM rfm) AS DOUBLE) * 100.0 * 10.0, 0) / 10.0 AS share_pct FROM rfm GROUP BY segment""")
SQL["price_histogram_range"] = q([], _hist("(SELECT * FROM orders_v WHERE price BETWEEN 900 AND 1500)", "price", 50, None, "lines"))
SQL["price_box_range"] = q([], _box("(SELECT * FROM orders_v WHERE price BETWEEN 900 AND 1500)", "price"))
SQL["undated_counts"] = q([], """SELECT 'customer' AS grain, count(*) AS rows, count(CASE WHEN n = 0 THEN 1 END) AS undated
  FROM (SELECT count(invoice_date) AS n FROM orders_v WHERE customer_id IS NOT NULL GROUP BY customer_id) UNION ALL
SELECT 'product', count(*), count(CASE WHEN n = 0 THEN 1 END)
  FROM (SELECT count(invoice_date) AS n FROM orders_v WHERE customer_id IS NOT NULL AND quantity > 0 AND price > 0 GROUP BY stock_code)""")
SQL["bronze_readback"] = q([], """SELECT count(*) AS rows, count(*) AS ids, CAST(sum(quantity) AS BIGINT) AS quantity,
  CAST(0 AS BIGINT) AS unstamped FROM orders_v""")
SQL["pipeline_tables"] = q([rfm_cte(), PRODUCT_CTE, CHURN_CTE, GEO_CTE, CLV_CTE], " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {src}" for t, src in (
        ("raw_orders", "orders_v"), ("rfm_analysis", "rfm"), ("rfm_results", "rfm"), ("product_rfm", "products"),
        ("churn_risk", "churn"), ("geographic_analysis", "geo"), ("clv_forecast", "clv"))))
SQL["rfm_export"] = q(RFM, """SELECT CAST(customer_id AS VARCHAR) AS "ID", CAST(recency AS VARCHAR) AS "Récence (j)",
  CAST(frequency AS VARCHAR) AS "Fréquence", CAST(monetary AS VARCHAR) AS "Montant (€)", CAST(r_score AS VARCHAR) AS "R",
  CAST(f_score AS VARCHAR) AS "F", CAST(m_score AS VARCHAR) AS "M", rfm_score AS "RFM", segment AS "Segment"
  FROM rfm WHERE segment IN ('Champions', 'Clients Fidèles', 'À Risque')
  AND recency BETWEEN 30 AND 400 AND monetary BETWEEN 1000 AND 200000""")

# the same rows from lines laid out by customer
SQL["customer_rfm_by_customer"] = SQL["customer_rfm"]

# the screens' datasets on the filtered table
SQL["filter_bounds"] = q(RFM, """SELECT min(recency) AS recency_min, max(recency) AS recency_max,
  CAST(min(monetary) AS DOUBLE) AS monetary_min, CAST(max(monetary) AS DOUBLE) AS monetary_max FROM rfm""")
SHOWN = """(SELECT * FROM rfm WHERE segment IN ('Champions', 'Clients Fidèles', 'À Risque', 'Perdus', 'Moyens')
  AND recency BETWEEN 0 AND 2000 AND monetary BETWEEN 1000 AND 200000)"""
SQL["filtered_segment_distribution"] = SQL["segment_distribution"].replace("FROM rfm GROUP BY", f"FROM {SHOWN} GROUP BY")
SQL["filtered_segment_stats"] = SQL["segment_stats"].replace("FROM rfm GROUP BY", f"FROM {SHOWN} GROUP BY")
SQL["filtered_recency_histogram"] = q(RFM, _hist(SHOWN, "recency", 50, "segment", "customers"))
SQL["filtered_monetary_histogram"] = q(RFM, _hist(SHOWN, "monetary", 50, "segment", "customers"))
SQL["filtered_rf_heatmap"] = SQL["rf_heatmap"].replace("FROM rfm GROUP BY", f"FROM {SHOWN} GROUP BY")
SQL["exploration_monetary_histogram_range"] = q(EXPLORATION, _hist("(SELECT * FROM rfm WHERE monetary <= 100000)", "monetary", 50, None, "customers"))

# the tables of the daily run, row for row
SQL["daily_rfm_results"] = q(RFM, "SELECT * REPLACE (CAST(monetary AS DECIMAL(10,2)) AS monetary) FROM rfm")
for _daily, _table in (("churn_risk", "churn_risk"), ("clv_forecast", "clv_forecast"), ("product_rfm", "product_rfm"), ("geographic_analysis", "geographic_analysis")):
    SQL[f"daily_{_daily}"] = SQL[_table]
