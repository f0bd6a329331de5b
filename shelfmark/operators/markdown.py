"""Markdown scenario simulation (M1-M5).

Per product: recent daily demand, stock and a resolved elasticity are three
keyed aggregates joined on product_id; the nine discount scenarios are an
``explode`` of a literal array (narrow, no shuffle), and every scenario
measure is a column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import config
from shelfmark.functions.exact import MONEY, PRICE, cents, div_half_up, from_cents
from shelfmark.operators.clean import recent_window
from shelfmark.sources.model import category_elasticity


def recent_quantity(txn: DataFrame, days: int = config.RECENT_DAYS) -> DataFrame:
    """Units sold per product in the last ``days`` + 1 calendar days."""
    return (recent_window(txn, days).groupBy("product_id")
            .agg(F.sum("quantity").alias("recent_qty")))


def stock_per_product(inventory: DataFrame) -> DataFrame:
    """M3: current stock summed over stores."""
    return inventory.groupBy("product_id").agg(F.sum("current_stock").alias("stock_sum"))


def with_base_demand(products: DataFrame) -> DataFrame:
    """The catalogue with a base demand, 10 a day where it has none."""
    known = F.col("base_demand").cast("double") if "base_demand" in products.columns else F.lit(None).cast("double")
    return products.withColumn("base_demand", F.coalesce(known, F.lit(config.DEFAULT_DAILY_DEMAND)))


def resolve_elasticity(products: DataFrame, product_elasticity: DataFrame,
                       category_frame: DataFrame | None = None,
                       configured: dict[str, float] | None = None) -> DataFrame:
    """M4 / O5 (J8): product's own estimate -> the elasticity of the first
    product (by product_id) of its category in the estimate frame -> the
    category frame when the product frame is empty -> configured category
    value -> -1.0.  One row per product."""
    own = product_elasticity.select("product_id", F.col("elasticity").alias("_own"))
    first = (product_elasticity.groupBy("category")
             .agg(F.min_by("elasticity", "product_id").alias("_first")))
    p = products.select("product_id", "category")
    j = p.join(own, "product_id", "left").join(first, "category", "left")
    fallback = F.col("_first")
    if category_frame is not None:
        n_prod = product_elasticity.agg(F.count(F.lit(1))).scalar()
        cat = category_frame.groupBy("category").agg(
            F.first("elasticity").alias("_cat"))
        j = j.join(cat, "category", "left")
        fallback = F.coalesce(fallback, F.when(n_prod == 0, F.col("_cat")))
    e = F.coalesce(F.col("_own"), fallback, category_elasticity(F.col("category"), configured))
    return j.select("product_id", e.alias("elasticity"))


def _half_even_ratio(num: Column, den: Column) -> Column:
    """round(num / den) half to even for integers num >= 0, den > 0."""
    r = F.pmod(num, den)
    q = ((num - r) / den).cast("bigint")
    twice = r * 2
    return (F.when(twice > den, q + 1).when(twice < den, q)
            .otherwise(q + F.pmod(q, F.lit(2))))


def simulate(products: DataFrame, inventory: DataFrame, txn: DataFrame,
             product_elasticity: DataFrame, category_frame: DataFrame | None = None,
             discounts=config.SIMULATION_DISCOUNTS, recent: DataFrame | None = None,
             configured: dict[str, float] | None = None) -> DataFrame:
    """M1 + M5: every product x every discount scenario (13 columns).

    ``recent`` may pass a shared, unrounded ``recent_quantity`` frame."""
    recent = recent if recent is not None else recent_quantity(txn)
    demand = recent.select(
        "product_id",
        (div_half_up(F.col("recent_qty") * 100, F.lit(config.RECENT_DAYS)).cast("double")
         / F.lit(100.0)).alias("_recent_daily"))
    stock = stock_per_product(inventory)
    elas = resolve_elasticity(products, product_elasticity, category_frame, configured)
    products = with_base_demand(products)
    base = (products.select("product_id", "product_name", "category", "base_price", "cost",
                            "base_demand")
            .join(demand, "product_id", "left")
            .join(stock, "product_id", "left")
            .join(elas, "product_id", "left")
            .select("product_id", "product_name", "category", "base_price", "cost",
                    F.coalesce(F.col("_recent_daily"), F.col("base_demand")).alias("_demand"),
                    F.coalesce(F.col("stock_sum"), F.lit(0)).cast("bigint").alias("_stock"),
                    "elasticity"))
    # Discounts in basis points, so that price, demand and label agree on fractions of a percent.
    points = F.array(*[F.lit(int(round(d * 10_000))) for d in discounts])
    fracs = F.array(*[F.lit(float(d)) for d in discounts])
    s = base.select("*", F.posexplode(points).alias("_i", "_bp")).withColumn(
        "_d", F.element_at(fracs, F.col("_i") + 1))
    price_c = div_half_up(cents(F.col("base_price")) * (F.lit(10_000) - F.col("_bp")), F.lit(10_000))
    ratio = F.lit(1.0) - F.col("_d")
    daily = F.when((ratio > 0) & (F.col("_d") > 0),
                   F.greatest(F.lit(0.0), F.col("_demand") * F.pow(ratio, F.col("elasticity")))
                   ).otherwise(F.col("_demand"))
    s = s.select("*", price_c.alias("_price_c"), daily.alias("_daily"))
    s = s.select("*", F.bround(F.col("_daily") * 30, 0).cast("bigint").alias("_monthly"))
    margin_c = F.col("_price_c") - cents(F.col("cost"))
    clearance_bp = F.when(F.col("_stock") > 0,
                          _half_even_ratio(F.col("_monthly") * 10000, F.col("_stock"))) \
        .otherwise(F.lit(0).cast("bigint"))
    return s.select(
        "product_id", "product_name", "category",
        (F.col("_bp") / F.lit(100.0)).alias("discount_pct"),
        from_cents(F.col("_price_c"), PRICE).cast("double").alias("new_price"),
        F.col("cost").cast("double").alias("cost"),
        from_cents(margin_c, PRICE).cast("double").alias("margin_per_unit"),
        (F.rint(F.col("_daily") * 10) / 10).alias("expected_daily_demand"),
        F.col("_monthly").alias("expected_monthly_demand"),
        from_cents(F.col("_price_c") * F.col("_monthly"), MONEY).cast("double").alias("expected_revenue"),
        from_cents(margin_c * F.col("_monthly"), MONEY).cast("double").alias("expected_profit"),
        F.col("_stock").alias("current_stock"),
        (clearance_bp.cast("double") / F.lit(100.0)).alias("inventory_clearance_pct"),
    )
