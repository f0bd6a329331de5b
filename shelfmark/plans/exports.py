"""Dashboard documents (S6-S14) as DataFrames, and the writer of all nine.

Whole tables (products, scenarios, recommendations) are written as their own
JSON datasets; only bounded pieces (one-row summaries, the category list,
the discount grid) are gathered into a single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import config
from shelfmark.operators import kpi, optimize
from shelfmark.sources.files import save_json


def overview_doc(txn: DataFrame) -> DataFrame:
    """Overview KPIs with the discount-effectiveness block nested.

    The nested block is a one-row aggregate used as a scalar subquery
    returning a struct (no join)."""
    eff = kpi.discount_effectiveness(txn)
    nested = eff.select(F.struct(*eff.columns)).scalar()
    return kpi.overview(txn).select("*", nested.alias("discount_effectiveness"))


def recommendations_summary(recs: DataFrame) -> DataFrame:
    """Totals over recommendations; zeros when there are none."""
    return optimize.run_summary(recs)


def whatif_params(products: DataFrame) -> DataFrame:
    """Discount slider range, sorted distinct categories and the
    simulated discounts in percent.  The product list is its own dataset."""
    return products.agg(F.sort_array(F.collect_set("category")).alias("categories")).select(
        F.struct(F.lit(config.OPT_DISCOUNT_MIN * 100).alias("min"),
                 F.lit(config.OPT_DISCOUNT_MAX * 100).alias("max"),
                 F.lit(config.WHATIF_DISCOUNT_RANGE[2]).alias("step")).alias("discount_range"),
        "categories",
        F.array(*[F.lit(d) * 100 for d in config.SIMULATION_DISCOUNTS]).alias("simulation_discounts"))


# The documents a reader expects, and the datasets that make them up: tables
# that grow with the catalogue are datasets of their own, never one row.
DOCUMENTS = {
    "overview_kpis": ["overview_kpis"],
    "product_analytics": ["product_analytics", "top_bottom_sellers"],
    "category_analytics": ["category_analytics"],
    "monthly_trends": ["monthly_trends"],
    "forecast_data": ["forecast_data"],
    "elasticity_data": ["elasticity_category", "elasticity_product", "elasticity_multifeature"],
    "simulation_results": ["simulation_results"],
    "recommendations": ["recommendations", "recommendations_summary"],
    "whatif_params": ["whatif_params", "whatif_products"],
}


def manifest(spark: SparkSession, written: list[str], cleaning: dict[str, int]) -> DataFrame:
    """One row per document with the datasets that hold its parts, and how many
    sales the run checked and removed before it made them."""
    counts = (cleaning["rows_in"], cleaning["rows_removed"] or 0)  # a sum over no rows is null
    rows = [(doc, parts, *counts) for doc, parts in DOCUMENTS.items() if set(parts) <= set(written)]
    return spark.createDataFrame(rows, "document string, datasets array<string>, rows_checked bigint, rows_removed bigint")


def write_all(out_dir: str, results: dict[str, DataFrame]) -> None:
    """Write every document; keys follow the dashboard's file names."""
    for name, df in results.items():
        save_json(df, f"{out_dir.rstrip('/')}/{name}")
