"""Fixed values that must equal the original pipeline's output, and the ordered
rule lists that assign them. Labels are part of the output and keep their
original spelling (French, accents, emoji).

Every rule list is an ordered list of (condition, label); the first matching
condition wins and ``default`` applies otherwise. :func:`first_match` turns one
into a chained CASE expression evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original pipeline's output exactly)
# ---------------------------------------------------------------------------

# Customer segments (customer RFM), in rule order.
SEG_CHAMPIONS = "Champions"
SEG_LOYAL = "Clients Fidèles"
SEG_NEW = "Nouveaux Clients"
SEG_POTENTIAL = "Clients Potentiels"
SEG_AT_RISK = "À Risque"
SEG_LOST = "Perdus"
SEG_REACTIVATE = "À Réactiver"
SEG_AVERAGE = "Moyens"

# Growth factor per customer segment for the lifetime-value forecast;
# unknown segments get 1.0.
SEGMENT_GROWTH = {
    "Champions": 1.15,
    "Clients Fidèles": 1.10,
    "Nouveaux Clients": 1.20,
    "Clients Potentiels": 1.08,
    "À Risque": 0.85,
    "Perdus": 0.50,
    "À Réactiver": 1.05,
    "Moyens": 1.00,
}
DEFAULT_GROWTH = 1.0

# Segments of the stricter exploration variant (scores R and F only), in rule order.
EXP_CHAMPIONS = "Champions"
EXP_LOYAL = "Clients fidèles"
EXP_POTENTIAL = "Potentiels fidèles"
EXP_AT_RISK = "À risque"
EXP_HIBERNATING = "En hibernation"
EXP_LOST = "Perdus"
EXP_OTHER = "Autres"

# Product performance classes by mean score.
PERF_STAR = "Star"
PERF_STRONG = "Strong"
PERF_STABLE = "Stable"
PERF_ORPHAN = "Orphan"

# Churn: recency quintile weights, purchase-frequency quintile weights,
# score thresholds, classes and recommendations.
CHURN_RECENCY_WEIGHTS = [20, 40, 60, 80, 95]
CHURN_FREQUENCY_WEIGHTS = [80, 60, 40, 20, 5]
CHURN_RECENCY_SHARE = 6  # tenths: score = 0.6 * recency weight + 0.4 * frequency weight
CHURN_FREQUENCY_SHARE = 4
CHURN_HIGH = "🔴 High"
CHURN_MEDIUM = "🟠 Medium"
CHURN_LOW = "🟡 Low"
CHURN_VERY_LOW = "🟢 Very Low"
REC_HIGH = "🎯 Win-back campaign + special offer"
REC_MEDIUM = "📧 Engagement email + coupon"
REC_LOW = "💌 Regular newsletter"
REC_VERY_LOW = "🎉 VIP loyalty program"
CHURN_THRESHOLDS = (80, 60, 40)

# Market classes of the geographic analysis.
MARKET_LEADER = "🟢 Established Leader"
MARKET_DECLINING = "🟠 Declining"
MARKET_GROWING = "🟡 Growing Opportunity"
MARKET_EMERGING = "🔴 Emerging Market"

# Forecast confidence of the lifetime-value forecast.
CONF_LOW = "🟡 Low"
CONF_MEDIUM = "🟡 Medium"
CONF_HIGH = "🟢 High"
CLV_MIN_HISTORY = 100  # historical value below this -> low confidence
CLV_SHORT_MONTHS = 3
CLV_LONG_MONTHS = 12
DAYS_PER_MONTH = 30

# ---------------------------------------------------------------------------


def first_match(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Ordered rule list -> CASE WHEN c1 THEN l1 WHEN c2 THEN l2 ... ELSE default."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def customer_segment(r: Column, f: Column, m: Column) -> Column:
    """Eight-way segment from R, F and M scores (1..5)."""
    return first_match(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), SEG_CHAMPIONS),
            ((r >= 3) & (f >= 3) & (m >= 3), SEG_LOYAL),
            ((r >= 4) & (f <= 2), SEG_NEW),
            ((r >= 3) & (f >= 1) & (m >= 2), SEG_POTENTIAL),
            ((r <= 2) & (f >= 3), SEG_AT_RISK),
            ((r <= 2) & (f <= 2) & (m <= 2), SEG_LOST),
            ((r <= 2) & (f <= 2) & (m >= 3), SEG_REACTIVATE),
        ],
        SEG_AVERAGE,
    )


def exploration_segment(r: Column, f: Column) -> Column:
    """Seven-way segment on R and F only (the 'lost' branch is unreachable,
    kept so the rule list reads as specified)."""
    return first_match(
        [
            ((r >= 4) & (f >= 4), EXP_CHAMPIONS),
            ((r >= 3) & (f >= 3), EXP_LOYAL),
            ((r >= 4) & (f <= 2), EXP_POTENTIAL),
            ((r <= 2) & (f >= 3), EXP_AT_RISK),
            ((r <= 2) & (f <= 2), EXP_HIBERNATING),
            ((r == 1) & (f == 1), EXP_LOST),
        ],
        EXP_OTHER,
    )


def product_performance(r: Column, f: Column, m: Column) -> Column:
    """Mean of the three scores >= 4 / 3 / 2, compared in integers (sum >= 12 / 9 / 6)."""
    s = r + f + m
    return first_match(
        [(s >= 12, PERF_STAR), (s >= 9, PERF_STRONG), (s >= 6, PERF_STABLE)], PERF_ORPHAN
    )


def churn_class(score: Column) -> Column:
    hi, med, lo = CHURN_THRESHOLDS
    return first_match(
        [(score >= hi, CHURN_HIGH), (score >= med, CHURN_MEDIUM), (score >= lo, CHURN_LOW)],
        CHURN_VERY_LOW,
    )


def churn_recommendation(score: Column) -> Column:
    hi, med, lo = CHURN_THRESHOLDS
    return first_match(
        [(score >= hi, REC_HIGH), (score >= med, REC_MEDIUM), (score >= lo, REC_LOW)],
        REC_VERY_LOW,
    )


def market_class(
    revenue: Column, recency: Column, rev_q75: Column, rec_q25: Column, rec_q50: Column
) -> Column:
    return first_match(
        [
            ((revenue >= rev_q75) & (recency <= rec_q25), MARKET_LEADER),
            (revenue >= rev_q75, MARKET_DECLINING),
            (recency <= rec_q50, MARKET_GROWING),
        ],
        MARKET_EMERGING,
    )


def forecast_confidence(months_active: Column, historical_value: Column) -> Column:
    return first_match(
        [
            (historical_value < CLV_MIN_HISTORY, CONF_LOW),
            (months_active < CLV_SHORT_MONTHS, CONF_MEDIUM),
            (months_active >= CLV_LONG_MONTHS, CONF_HIGH),
        ],
        CONF_MEDIUM,
    )


def growth_rate(segment: Column) -> Column:
    """Dictionary lookup with default, as a literal map (no join, no UDF)."""
    pairs = []
    for k, v in SEGMENT_GROWTH.items():
        pairs += [F.lit(k), F.lit(float(v))]
    return F.coalesce(F.create_map(*pairs)[segment], F.lit(DEFAULT_GROWTH))
