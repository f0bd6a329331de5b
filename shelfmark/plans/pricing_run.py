"""The whole pricing run as one Spark application (main entry point).

extract -> clean (written once) -> KPIs -> forecast -> elasticity ->
scenarios -> optimisation -> documents.  Every phase is a DataFrame function
over the cleaned table, or over one aggregate of it (per product, month and
promotion flag), which is written once and feeds all KPIs and the forecast.

usage: python -m shelfmark.plans.pricing_run <input> <out_dir> [elasticities.json]

``input`` is a folder of CSV files (products, stores, transactions, inventory)
or of the parquet test tables; the JSON file maps categories to their
configured elasticity.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from shelfmark.operators import elasticity, forecast, kpi, markdown, optimize
from shelfmark.plans import exports
from shelfmark.sources import canonical, files
from shelfmark.sources.model import load_model
from shelfmark.sources.shared import write_shared


def open_input(spark: SparkSession, path: str):
    """The star schema of a folder: its CSV files, or the parquet test tables."""
    return canonical.read_folder(spark, path) if files.csv_files(spark, path) else load_model(spark, path)


def build(spark: SparkSession, path: str, configured: dict[str, float] | None = None) -> dict[str, DataFrame]:
    """All dashboard documents as lazy DataFrames over shared intermediates.

    ``configured`` holds category elasticities (default: the test tables')."""
    m = open_input(spark, path)
    txn, products, inventory = m.clean_transactions, m.products, m.inventory
    cube = write_shared(kpi.sales_cube(txn), "cube")
    pk = write_shared(kpi.product_kpis(cube, products, inventory), "products")
    series = forecast.pack_series(forecast.month_spine(forecast.monthly_demand(cube, products)))
    el = elasticity.run(txn, products, configured=configured)
    prod_e = write_shared(el["product_elasticity"], "product-elasticity")
    cat_e = write_shared(el["category_elasticity"], "category-elasticity")
    # The 90-day demand is computed once, unrounded, for both the scenarios
    # (which round it to 2 dp) and the optimiser (which does not).
    recent = write_shared(markdown.recent_quantity(txn), "recent")
    opt = optimize.optimise(optimize.inputs(products, inventory, txn, prod_e, cat_e, recent=recent, configured=configured))
    recs = write_shared(optimize.recommend(opt), "recommendations")
    multi = el["multifeature_model"]
    docs = {
        "overview_kpis": exports.overview_doc(cube),
        "product_analytics": pk,
        "top_bottom_sellers": kpi.top_bottom_sellers(pk),
        "category_analytics": kpi.category_kpis(cube, products),
        "monthly_trends": kpi.monthly_trends(cube),
        "forecast_data": forecast.forecast_all(series),
        "elasticity_category": cat_e,
        "elasticity_product": prod_e,
        "elasticity_multifeature": multi,
        "simulation_results": markdown.simulate(products, inventory, txn, prod_e, cat_e,
                                                recent=recent, configured=configured),
        "recommendations": recs,
        "recommendations_summary": exports.recommendations_summary(recs),
        "whatif_params": exports.whatif_params(products),
        "whatif_products": products.select("product_id", "product_name", "category",
                                           "base_price", "cost"),
    }
    return docs | {"manifest": exports.manifest(spark, list(docs), m.cleaning)}


def run(spark: SparkSession, path: str, out_dir: str, parallel_writes: int = 4,
        configured: dict[str, float] | None = None) -> dict[str, float]:
    """Build and write every document; returns seconds per document.

    The documents are independent actions, so they are submitted from a few
    threads at once: Spark interleaves their stages and small jobs no longer
    leave executors idle."""
    from concurrent.futures import ThreadPoolExecutor

    docs = build(spark, path, configured)

    def write(item):
        name, df = item
        t0 = time.perf_counter()
        exports.write_all(out_dir, {name: df})
        return name, round(time.perf_counter() - t0, 3)

    with ThreadPoolExecutor(max_workers=max(1, parallel_writes)) as pool:
        return dict(pool.map(write, docs.items()))


def main(argv: list[str]) -> None:
    from shelfmark.session import get_session
    configured = None
    if len(argv) > 3:
        with open(argv[3]) as f:
            configured = json.load(f)
    print(run(get_session(), argv[1], argv[2], configured=configured))


if __name__ == "__main__":
    main(sys.argv)
