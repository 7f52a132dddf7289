import datetime as dt
import itertools

from pyspark.sql import functions as F

from tillroll.functions import dates, labels


def test_whole_days_is_floor_of_24h_periods(spark):
    rows = [
        (dt.datetime(2010, 1, 1, 23, 0), dt.datetime(2010, 1, 3, 1, 0), 1),  # two dates later, 26 h
        (dt.datetime(2010, 1, 1, 0, 0), dt.datetime(2010, 1, 1, 23, 59), 0),
        (dt.datetime(2010, 1, 1, 12, 0), dt.datetime(2010, 1, 2, 12, 0), 1),
        (dt.datetime(2010, 1, 2, 1, 0), dt.datetime(2010, 1, 1, 23, 0), -1),  # negative: floor
        (dt.datetime(2009, 12, 1, 7, 45), dt.datetime(2010, 12, 1, 7, 45), 365),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, want int")
    got = df.select(dates.whole_days("a", "b").alias("d"), "want").collect()
    assert [r.d for r in got] == [r.want for r in got]


def test_month_start_keeps_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2010, 3, 17, 13, 5),)], "t timestamp_ntz")
    out = df.select(dates.month_start("t").alias("m"))
    assert out.schema["m"].dataType.simpleString() == "timestamp_ntz"
    assert out.first().m == dt.datetime(2010, 3, 1)


def test_segment_truth_table(spark):
    grid = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(grid, "r int, f int, m int")
    seg = df.select(labels.customer_segment(F.col("r"), F.col("f"), F.col("m")).alias("s"))
    counts = {r.s: r["count"] for r in seg.groupBy("s").count().collect()}
    assert counts == {
        "Champions": 8,
        "Clients Fidèles": 19,
        "Nouveaux Clients": 20,
        "Clients Potentiels": 17,
        "À Risque": 30,
        "Perdus": 8,
        "À Réactiver": 12,
        "Moyens": 11,
    }


def test_exploration_segments_lost_unreachable(spark):
    grid = list(itertools.product(range(1, 6), repeat=2))
    df = spark.createDataFrame(grid, "r int, f int")
    segs = {r.s for r in df.select(labels.exploration_segment(F.col("r"), F.col("f")).alias("s")).collect()}
    assert "Perdus" not in segs
    assert segs == {"Champions", "Clients fidèles", "Potentiels fidèles", "À risque", "En hibernation", "Autres"}


def test_churn_classes_at_exact_boundaries(spark):
    pairs = list(itertools.product(labels.CHURN_RECENCY_WEIGHTS, labels.CHURN_FREQUENCY_WEIGHTS))
    df = spark.createDataFrame(pairs, "a int, b int").withColumn(
        "score", ((F.lit(6) * F.col("a") + F.lit(4) * F.col("b")) / F.lit(10)).cast("double")
    )
    got = df.select("a", "b", "score", labels.churn_class(F.col("score")).alias("c")).collect()
    for r in got:
        float_score = r.a * 0.6 + r.b * 0.4  # the original float formula
        assert r.score == float_score
        want = (
            labels.CHURN_HIGH if float_score >= 80 else labels.CHURN_MEDIUM if float_score >= 60
            else labels.CHURN_LOW if float_score >= 40 else labels.CHURN_VERY_LOW
        )
        assert r.c == want
    assert len({r.score for r in got}) == 23
    assert {r.score for r in got} >= {80.0, 60.0}


def test_growth_rate_default_for_unknown_segment(spark):
    df = spark.createDataFrame([("Champions",), ("Inconnu",), (None,)], "s string")
    got = [r.g for r in df.select(labels.growth_rate(F.col("s")).alias("g")).collect()]
    assert got == [1.15, 1.0, 1.0]


def test_performance_thresholds_in_integers(spark):
    df = spark.createDataFrame([(4, 4, 4), (4, 4, 3), (3, 3, 3), (2, 2, 2), (2, 2, 1)], "r int, f int, m int")
    got = [r.p for r in df.select(labels.product_performance(F.col("r"), F.col("f"), F.col("m")).alias("p")).collect()]
    assert got == ["Star", "Strong", "Strong", "Stable", "Orphan"]
