"""The daily run as one Spark application: order lines -> bronze table ->
customer RFM -> published results -> product, churn, market and lifetime
value marts. Scheduling and retries belong to the scheduler that calls it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.plans import churn, clv, customers, dashboard, geo, product, publish, rfm
from tillroll.schemas import ORDER_COLUMNS
from tillroll.session import release
from tillroll.sources import export, tables


def run_pipeline(
    spark: SparkSession, orders: DataFrame, out_dir: str, exports: bool = False, rfm_filter: dict | None = None
) -> dict[str, str]:
    """Returns the path of every table written (and of the CSV exports). Every
    table is a new version; the one before stays readable until it is expired.
    Three passes over the bronze lines: customers, products, countries."""
    out = out_dir.rstrip("/")

    def write(name: str, df: DataFrame) -> str:
        path = tables.write_version(df, f"{out}/{name}")
        tables.expire(spark, f"{out}/{name}")
        return path

    paths = {"raw_orders": write("raw_orders", tables.bronze(orders))}
    bronze = spark.read.parquet(paths["raw_orders"]).select(*ORDER_COLUMNS)  # every analysis reads the bronze table
    base = customers.customer_base(bronze)
    paths["rfm_analysis"] = write("rfm_analysis", rfm.customer_rfm(bronze, base=base))
    silver = spark.read.parquet(paths["rfm_analysis"])
    paths["rfm_results"] = publish.publish_results(spark, silver, f"{out}/rfm_results")
    paths["product_rfm"] = write("product_rfm", product.product_rfm(bronze))
    paths["churn_risk"] = write("churn_risk", churn.churn_risk(bronze, base=base))
    paths["geographic_analysis"] = write("geographic_analysis", geo.geographic_analysis(bronze))
    paths["clv_forecast"] = write("clv_forecast", clv.clv_from_base(silver, base))
    release(base[0])
    if exports:
        paths.update(export_reports(spark, paths, f"{out}/exports", rfm_filter))
    return paths


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A table of :func:`run_pipeline` by its name and path."""
    return publish.read_results(spark, path) if name == "rfm_results" else spark.read.parquet(path)


def export_reports(spark: SparkSession, paths: dict[str, str], out_dir: str, rfm_filter: dict | None = None) -> dict[str, str]:
    """The three downloadable reports: the RFM detail table as filtered
    (``rfm_filter``: arguments of ``dashboard.filter_rfm``; None keeps all), the
    high-risk churn list (top 50) and the CLV top 30."""
    rfm_mart = spark.read.parquet(paths["rfm_analysis"])
    shown = dashboard.filter_rfm(rfm_mart, **rfm_filter) if rfm_filter else rfm_mart
    churn_mart = spark.read.parquet(paths["churn_risk"])
    clv_mart = spark.read.parquet(paths["clv_forecast"])
    return {
        "export_rfm": export.export_csv(dashboard.rfm_detail(shown), f"{out_dir}/rfm_detail"),
        "export_churn": export.export_csv(dashboard.churn_high_risk(churn_mart), f"{out_dir}/churn_high_risk"),
        "export_clv": export.export_csv(dashboard.clv_top(clv_mart), f"{out_dir}/clv_top30"),
    }
