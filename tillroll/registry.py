"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the given tables through the order-line adapter
(``sources/testdata.orders_view``) — or files Spark writes from them, for the
CSV and streaming queries — and runs over all of their rows. Each has the
DuckDB SQL of the same name in :mod:`tillroll.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import oracle as _oracle
from tillroll.plans import (
    churn, cleaning, clv, common, customers, dashboard, geo, library, marts, pipeline, product, profiling, publish, rfm,
)
from tillroll.session import materialize, release, scratch_path
from tillroll.sources import csv_orders, export, layout, tables, testdata
from tillroll.streaming import customer_state, folder_ingest

_BRONZE: dict[tuple[int, str, bool], tuple[tuple, DataFrame]] = {}


def _sources_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, size and modification time of every file of the source tables."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for name in sorted(testdata.SCHEMAS):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(conf)
        for s in fs.listStatus(path):
            out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return tuple(sorted(out))


def orders_view(spark: SparkSession, sf_dir: str, cancel_prefix: bool = False) -> DataFrame:
    """The order lines of ``sf_dir`` as a bronze table: the adapter join is
    written once per session and source folder (to the shared checkpoint
    folder) and every query reads that table — as the original analyses read
    the ingested ``raw_orders`` table instead of re-joining the sources. It is
    written anew when a source file has changed; the old table is then deleted."""
    key = (id(spark), sf_dir.rstrip("/"), cancel_prefix)
    state = _sources_state(spark, sf_dir)
    held = _BRONZE.get(key)
    if held is not None and held[1].sparkSession is spark:
        if held[0] == state:
            return held[1]
        release(held[1])
    bronze = materialize(testdata.orders_view(spark, sf_dir, cancel_prefix), "bronze_orders")
    _BRONZE[key] = (state, bronze)
    return bronze


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


@register("customer_rfm")
def _customer_rfm(spark, sf_dir):
    return rfm.customer_rfm(orders_view(spark, sf_dir))


@register("rfm_exploration")
def _rfm_exploration(spark, sf_dir):
    return rfm.rfm_exploration(orders_view(spark, sf_dir))


@register("product_rfm")
def _product_rfm(spark, sf_dir):
    return product.product_rfm(orders_view(spark, sf_dir))


@register("churn_risk")
def _churn_risk(spark, sf_dir):
    return churn.churn_risk(orders_view(spark, sf_dir))


@register("geographic_analysis")
def _geographic_analysis(spark, sf_dir):
    return geo.geographic_analysis(orders_view(spark, sf_dir))


@register("clv_forecast")
def _clv_forecast(spark, sf_dir):
    return _clv(spark, sf_dir)


# --- marts ------------------------------------------------------------------


def _rfm(spark, sf_dir):
    return rfm.customer_rfm(orders_view(spark, sf_dir))


def _products(spark, sf_dir):
    return product.product_rfm(orders_view(spark, sf_dir))


def _churn(spark, sf_dir):
    return churn.churn_risk(orders_view(spark, sf_dir))


def _geo(spark, sf_dir):
    return geo.geographic_analysis(orders_view(spark, sf_dir))


def _clv(spark, sf_dir):
    orders = orders_view(spark, sf_dir)
    base = customers.customer_base(orders)
    return clv.clv_from_base(rfm.customer_rfm(orders, base=base), base)


def _on(mart, fn):
    return lambda spark, sf_dir: fn(mart(spark, sf_dir))


def _on_orders(fn):
    return lambda spark, sf_dir: fn(orders_view(spark, sf_dir))


# --- dashboard datasets --------------------------------------------------------

FILTER_SEGMENTS = ["Champions", "Clients Fidèles", "À Risque"]
FILTER_RECENCY = (30, 400)
FILTER_MONETARY = (1000, 200000)

QUERIES.update(
    {
        "kpis": _on_orders(dashboard.kpis),
        "top_countries": _on_orders(dashboard.top_countries),
        "monthly_revenue": _on_orders(dashboard.monthly_revenue),
        "rfm_filtered": _on(
            _rfm,
            lambda r: dashboard.filter_rfm(r, FILTER_SEGMENTS, FILTER_RECENCY, FILTER_MONETARY),
        ),
        "segment_kpis": _on(_rfm, dashboard.segment_kpis),
        "segment_distribution": _on(_rfm, dashboard.segment_distribution),
        "segment_stats": _on(_rfm, dashboard.segment_stats),
        "rfm_points": _on(_rfm, dashboard.rfm_points),
        "recency_histogram": _on(_rfm, lambda r: dashboard.segment_histogram(r, "recency")),
        "monetary_histogram": _on(_rfm, lambda r: dashboard.segment_histogram(r, "monetary")),
        "rf_heatmap": _on(_rfm, dashboard.rf_heatmap),
        "rfm_detail": _on(_rfm, dashboard.rfm_detail),
        "product_kpis": _on(_products, dashboard.product_kpis),
        "performance_distribution": _on(_products, dashboard.performance_distribution),
        "top_products": _on(_products, dashboard.top_products),
        "product_listing": _on(_products, dashboard.product_listing),
        "churn_bands": _on(_churn, dashboard.churn_bands),
        "churn_histogram": _on(_churn, dashboard.churn_histogram),
        "churn_high_risk": _on(_churn, dashboard.churn_high_risk),
        "market_class_counts": _on(_geo, dashboard.market_class_counts),
        "top_markets": _on(_geo, dashboard.top_markets),
        "market_listing": _on(_geo, dashboard.market_listing),
        "clv_totals": _on(_clv, dashboard.clv_totals),
        "clv_by_segment": _on(_clv, dashboard.clv_by_segment),
        "clv_top": _on(_clv, dashboard.clv_top),
        "churn_summary": _on(_churn, dashboard.churn_summary),
        "geo_top3": _on(_geo, dashboard.geo_top3),
        "clv_summary": _on(_clv, dashboard.clv_summary),
    }
)


# --- query library ---------------------------------------------------------------


@register("lib_orphan_products")
def _lib_orphans(spark, sf_dir):
    orders = orders_view(spark, sf_dir)
    return library.orphan_products(product.product_rfm(orders), orders)


@register("lib_forecast_vs_actual")
def _lib_forecast_vs_actual(spark, sf_dir):
    orders = orders_view(spark, sf_dir)
    base = customers.customer_base(orders)
    r = rfm.customer_rfm(orders, base=base)
    return library.forecast_vs_actual(clv.clv_from_base(r, base), r)


QUERIES.update(
    {
        "lib_star_products": _on(_products, library.star_products),
        "lib_performance_summary": _on(_products, library.performance_summary),
        "lib_revenue_rank": _on(_products, library.revenue_rank),
        "lib_high_risk_customers": _on(_churn, library.high_risk_customers),
        "lib_churn_distribution": _on(_churn, library.churn_distribution),
        "lib_recommendation_breakdown": _on(_churn, library.recommendation_breakdown),
        "lib_long_inactive": _on(_churn, library.long_inactive),
        "lib_medium_risk_targets": _on(_churn, library.medium_risk_targets),
        "lib_top_countries": _on(_geo, library.top_countries_by_revenue),
        "lib_growth_opportunities": _on(_geo, library.growth_opportunities),
        "lib_declining_markets": _on(_geo, library.declining_markets),
        "lib_countries_ranked": _on(_geo, library.countries_ranked),
        "lib_market_benchmark": _on(_geo, library.market_benchmark),
        "lib_top_clv": _on(_clv, library.top_clv),
        "lib_clv_segment_summary": _on(_clv, library.clv_segment_summary),
        "lib_best_bets": _on(_clv, library.best_bets),
        "lib_champions_premium": _on(_clv, library.champions_premium),
        "lib_total_forecast": _on(_clv, library.total_forecast),
    }
)


# --- profiling ---------------------------------------------------------------------

QUERIES.update(
    {
        "profile_columns": _on_orders(profiling.column_profile),
        "describe_numeric": _on_orders(profiling.describe_numeric),
        "describe_text": _on_orders(profiling.describe_text),
        "missing_values": _on_orders(profiling.missing_values),
        "duplicates": _on_orders(profiling.duplicates),
        "distinct_counts": _on_orders(profiling.distinct_counts),
        "top_countries_by_rows": _on_orders(profiling.top_countries_by_rows),
        "price_histogram": _on_orders(profiling.price_histogram),
        "quantity_histogram": _on_orders(profiling.quantity_histogram),
        "price_box": _on_orders(profiling.price_box),
        "price_histogram_full": _on_orders(profiling.price_histogram_full),
        "price_box_full": _on_orders(profiling.price_box_full),
        "quantity_box": _on_orders(profiling.quantity_box),
        "anomaly_counts": _on_orders(profiling.anomaly_counts),
        "amount_stats": _on_orders(profiling.amount_stats),
        "date_range": _on_orders(profiling.date_range),
        "lines_per_customer": _on_orders(profiling.lines_per_customer),
        "cleaning_report": _on_orders(cleaning.cleaning_report),
        "exploration_segment_summary": lambda spark, sf_dir: profiling.segment_summary(
            rfm.rfm_exploration(orders_view(spark, sf_dir))
        ),
    }
)


# --- sources ---------------------------------------------------------------------------


def _awkward(orders):
    """Order lines whose descriptions hold quotes, separators, line breaks and
    empty texts, by line key."""
    d, n = F.col("description"), F.col("stock_code").cast("long") % 5
    text = (
        F.when(n == 1, F.concat(F.lit('"'), d, F.lit('"; x')))
        .when(n == 2, F.concat(d, F.lit("\n"), d))
        .when(n == 3, F.lit(""))
        .otherwise(d)
    )
    return orders.withColumn("description", text)


@register("csv_roundtrip")
def _csv_roundtrip(spark, sf_dir):
    """Order lines written in the raw CSV layout (decimal comma, day-first dates,
    quoted descriptions), then ingested back by the CSV reader."""
    path = scratch_path(spark, "csv_orders")
    export.export_raw_orders(_awkward(orders_view(spark, sf_dir)), path)
    return csv_orders.read_orders(spark, path)


@register("csv_reject_report")
def _csv_reject_report(spark, sf_dir):
    """Rejects by reason of a delivery of two layouts with spoilt fields."""
    path = scratch_path(spark, "csv_spoilt")
    raw = export.to_raw_layout(orders_view(spark, sf_dir))
    n, odd = F.col("StockCode").cast("long") % 7, F.col("Quantity").cast("int") % 2 == 0
    spoilt = (
        raw.withColumn("_odd", odd)
        .withColumn("Price", F.when(n == 1, "abc").when(n == 2, F.regexp_replace("Price", ",", ".")).otherwise(F.col("Price")))
        .withColumn("Quantity", F.when(n == 3, "two").otherwise(F.col("Quantity")))
        .withColumn("Customer ID", F.when(n == 4, F.concat("Customer ID", F.lit(".0"))).when(n == 5, "x1").otherwise(F.col("Customer ID")))
        .withColumn("InvoiceDate", F.when(n == 6, "32/1/1998 9:00").otherwise(F.col("InvoiceDate")))
    )
    export.write_raw(spoilt.where("_odd").drop("_odd"), path)
    export.write_raw(spoilt.where("NOT _odd").select("Country", "Price", *[c for c in raw.columns if c not in ("Country", "Price")]), path, "append")
    return csv_orders.reject_report(csv_orders.read_raw(spark, path))


@register("stream_ingest")
def _stream_ingest(spark, sf_dir):
    """The same CSV files converted by the streaming folder ingest."""
    landing = scratch_path(spark, "landing")
    export.export_raw_orders(_awkward(orders_view(spark, sf_dir)), landing)
    return folder_ingest.ingest_available(
        spark, landing, scratch_path(spark, "bronze"), scratch_path(spark, "stream_ckpt")
    )


@register("customer_rfm_incremental")
def _customer_rfm_incremental(spark, sf_dir):
    """Customer RFM from the customer table kept up to date by the streaming
    ingest: the order lines arrive as files in two deliveries, each folded in
    by micro-batches; the scores equal the batch computation."""
    landing, state, ckpt = (scratch_path(spark, n) for n in ("landing", "customer_state", "state_ckpt"))
    orders = orders_view(spark, sf_dir)
    first = F.xxhash64("invoice", "stock_code") % 2 == 0
    export.export_raw_orders(orders.where(first), landing)
    customer_state.update_customers(spark, landing, state, ckpt)
    export.export_raw_orders(orders.where(~first), landing, "append")
    base = customer_state.update_customers(spark, landing, state, ckpt)
    return rfm.customer_rfm(orders, base=base)


def _delivered_mart(spark, sf_dir, name):
    """A customer mart after a second delivery: the refresh folds its files into the
    customer table and reads no line of the first again."""
    landing, state, ckpt = (scratch_path(spark, n) for n in ("landing", "mart_state", "mart_ckpt"))
    orders = orders_view(spark, sf_dir)
    first = F.xxhash64("invoice", "stock_code") % 2 == 0
    export.export_raw_orders(orders.where(first), landing)
    held = marts.DeliveredMarts(spark, landing, state, ckpt, ttl_seconds=0)
    held.get(name)
    export.export_raw_orders(orders.where(~first), landing, "append")
    return held.get(name)


@register("churn_risk_incremental")
def _churn_risk_incremental(spark, sf_dir):
    return _delivered_mart(spark, sf_dir, "churn")


@register("clv_forecast_incremental")
def _clv_forecast_incremental(spark, sf_dir):
    return _delivered_mart(spark, sf_dir, "clv")


@register("customer_rfm_by_customer")
def _customer_rfm_by_customer(spark, sf_dir):
    """Customer RFM of lines laid out by customer: equal to ``customer_rfm``, no
    exchange of the lines for the customer key."""
    orders = orders_view(spark, sf_dir)
    held = layout.lay_out(orders, int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = customers.base_of_layout(held)
    layout.forget(held)
    return rfm.customer_rfm(orders, base=base)


@register("publish_rfm")
def _publish_rfm(spark, sf_dir):
    """Exploration scores published first, then this run's customer RFM merged
    on top: updated keys take the new values, the others keep theirs."""
    orders = orders_view(spark, sf_dir)
    base = scratch_path(spark, "rfm_results")
    publish.publish_results(spark, rfm.rfm_exploration(orders), base)
    publish.publish_results(spark, rfm.customer_rfm(orders), base)
    current = publish.read_results(spark, base)
    return current.select(
        *[c for c in rfm.RFM_COLUMNS],
        (current.updated_at > current.created_at).alias("updated_in_run"),
    )


# --- cancellation invoices and remaining datasets ---------------------------------


def _orders_c(spark, sf_dir):
    """Order lines whose returned lines carry cancellation invoices ('C' + key)."""
    return orders_view(spark, sf_dir, cancel_prefix=True)


QUERIES.update(
    {
        "customer_rfm_cancellations": lambda spark, sf_dir: rfm.customer_rfm(_orders_c(spark, sf_dir)),
        "cleaning_report_cancellations": lambda spark, sf_dir: cleaning.cleaning_report(_orders_c(spark, sf_dir)),
        "rfm_detail_counts": _on(
            _rfm,
            lambda r: dashboard.detail_counts(
                dashboard.filter_rfm(r, FILTER_SEGMENTS, FILTER_RECENCY, FILTER_MONETARY), r
            ),
        ),
        "exploration_recency_box": lambda spark, sf_dir: profiling.segment_recency_box(
            rfm.rfm_exploration(orders_view(spark, sf_dir))
        ),
    }
)


# --- ordered marts, values to choose from, exploration datasets ----------------------


def _exploration(spark, sf_dir):
    return rfm.rfm_exploration(orders_view(spark, sf_dir))


WIDE_PRICES = (900, 1500)  # a display range in which the test tables have prices

QUERIES.update(
    {
        "churn_mart": _on(_churn, lambda d: tables.in_mart_order(d, "churn_risk")),
        "clv_mart": _on(_clv, lambda d: tables.in_mart_order(d, "clv_forecast")),
        "segment_values": _on(_rfm, lambda r: dashboard.distinct_values(r, "segment")),
        "country_values": _on_orders(lambda o: dashboard.distinct_values(o, "country")),
        "exploration_recency_histogram": _on(_exploration, lambda r: profiling.exploration_histogram(r, "recency")),
        "exploration_frequency_histogram": _on(_exploration, lambda r: profiling.exploration_histogram(r, "frequency")),
        "exploration_monetary_histogram": _on(_exploration, lambda r: profiling.exploration_histogram(r, "monetary")),
        "exploration_describe": _on(_exploration, profiling.exploration_describe),
        "exploration_segment_shares": _on(_exploration, profiling.exploration_shares),
        "price_histogram_range": _on_orders(lambda o: profiling.price_histogram(o, rng=WIDE_PRICES)),
        "price_box_range": _on_orders(lambda o: profiling.price_box(o, WIDE_PRICES)),
    }
)


def _on_filtered(fn):
    """On the RFM table as the screens' filters leave it."""
    return _on(_rfm, lambda r: fn(dashboard.filter_rfm(r, SHOWN_SEGMENTS, SHOWN_RECENCY, SHOWN_MONETARY)))


SHOWN_SEGMENTS = ["Champions", "Clients Fidèles", "À Risque", "Perdus", "Moyens"]
SHOWN_RECENCY = (0, 2000)
SHOWN_MONETARY = (1000, 200000)
WIDE_MONETARY = (0, 100_000)  # a display limit under which the test tables have customers

QUERIES.update(
    {
        "filter_bounds": _on(_rfm, dashboard.filter_bounds),
        "filtered_segment_distribution": _on_filtered(dashboard.segment_distribution),
        "filtered_segment_stats": _on_filtered(dashboard.segment_stats),
        "filtered_recency_histogram": _on_filtered(lambda r: dashboard.segment_histogram(r, "recency")),
        "filtered_monetary_histogram": _on_filtered(lambda r: dashboard.segment_histogram(r, "monetary")),
        "filtered_rf_heatmap": _on_filtered(dashboard.rf_heatmap),
        "exploration_monetary_histogram_range": _on(_exploration, lambda r: profiling.exploration_histogram(r, "monetary", limit=WIDE_MONETARY[1])),
    }
)


_DAILY: dict[tuple[int, str], tuple[DataFrame, dict[str, str]]] = {}


def _daily_table(name, *columns):
    """A table of the daily run, as written (one run a session and state of the lines)."""

    def run(spark, sf_dir):
        orders, key = orders_view(spark, sf_dir), (id(spark), sf_dir.rstrip("/"))
        if key not in _DAILY or _DAILY[key][0] is not orders:
            _DAILY[key] = (orders, pipeline.run_pipeline(spark, orders, scratch_path(spark, "daily_run")))
        table = pipeline.read_table(spark, name, _DAILY[key][1][name])
        return table.select(*columns) if columns else table

    return run


QUERIES.update(
    {
        "daily_rfm_results": _daily_table("rfm_results", *rfm.RFM_COLUMNS),
        "daily_churn_risk": _daily_table("churn_risk"),
        "daily_clv_forecast": _daily_table("clv_forecast"),
        "daily_product_rfm": _daily_table("product_rfm"),
        "daily_geographic_analysis": _daily_table("geographic_analysis"),
    }
)


@register("undated_counts")
def _undated_counts(spark, sf_dir):
    """Customers and products without any valid date, which the scores leave out."""
    orders = orders_view(spark, sf_dir)
    grains = (
        ("customer", common.valid_customer(orders), "customer_id"),
        ("product", common.positive_sales(orders), "stock_code"),
    )
    out = None
    for name, rows, key in grains:
        dated = rows.groupBy(key).agg(F.count("invoice_date").alias("n"))
        part = dated.agg(F.lit(name).alias("grain"), F.count("*").alias("rows"), F.count_if(F.col("n") == 0).alias("undated"))
        out = part if out is None else out.unionByName(part)
    return out


@register("bronze_readback")
def _bronze_readback(spark, sf_dir):
    """The bronze table written as a version and read back, with its surrogate id checked."""
    path = tables.write_version(tables.bronze(orders_view(spark, sf_dir)), scratch_path(spark, "bronze_table"))
    return spark.read.parquet(path).agg(
        F.count("*").alias("rows"),
        F.count_distinct("transaction_id").alias("ids"),
        F.sum("quantity").alias("quantity"),
        F.count_if(F.col("created_at").isNull() | F.col("updated_at").isNull()).alias("unstamped"),
    )


@register("rfm_export")
def _rfm_export(spark, sf_dir):
    """The filtered RFM detail exported as CSV, read back."""
    shown = dashboard.filter_rfm(_rfm(spark, sf_dir), FILTER_SEGMENTS, FILTER_RECENCY, FILTER_MONETARY)
    path = export.export_csv(dashboard.rfm_detail(shown), scratch_path(spark, "rfm_export"))
    return spark.read.option("header", True).option("escape", '"').csv(path)


@register("pipeline_tables")
def _pipeline_tables(spark, sf_dir):
    """Rows of every table that the whole daily run writes."""
    paths = pipeline.run_pipeline(spark, orders_view(spark, sf_dir), scratch_path(spark, "daily_run"))
    parts = [
        pipeline.read_table(spark, name, path).agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")) for name, path in paths.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def oracle() -> dict[str, str]:
    return {k: v for k, v in _oracle.SQL.items() if k in QUERIES}
