"""Business KPIs (K1-K13) over the cleaned transactions.

All of them are single-pass hash aggregates (partial on the map side, final
after one shuffle on the group key) plus narrow post-projections.  Dimension
lookups are plain joins: AQE turns them into broadcast joins when the
dimension's runtime size is under the threshold and keeps a sort-merge join
otherwise, so nothing is broadcast on trust.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark import config
from shelfmark.functions.calendar import month_label
from shelfmark.functions.exact import dec_div, dec_div_wide

D4 = "decimal(9,4)"


def _dbl(c: Column, digits: int = 2) -> Column:
    return F.round(c, digits).cast("double")


def _parts() -> dict[str, Column]:
    """Mergeable sums and counts of a group of sales."""
    return {
        "_rev": F.sum("revenue"), "_profit": F.sum("profit"), "_qty": F.sum("quantity"),
        "_orders": F.count("transaction_id"), "_rows": F.count(F.lit(1)),
        "_price": F.sum("selling_price"), "_price_n": F.count("selling_price"),
        "_disc": F.sum(F.col("discount_pct").cast(D4)), "_disc_n": F.count("discount_pct"),
        "_cogs": F.sum(F.col("cost") * F.col("quantity")),
    }


def sums(sales: DataFrame, *keys: str | Column) -> DataFrame:
    """Parts per group, from transactions or from a finer frame of parts."""
    merged = "_rev" in sales.columns
    return sales.groupBy(*keys).agg(*[(F.sum(n) if merged else c).alias(n) for n, c in _parts().items()])


def sales_cube(txn: DataFrame) -> DataFrame:
    """Parts per product, month (``date``: its first day) and promotion flag:
    every KPI below can be taken from this much smaller frame as well."""
    return sums(txn, "product_id", F.trunc("date", "month").cast("date").alias("date"), "is_promotion")


def _mean(part: str, digits: int, scale: int = 1) -> Column:
    n = F.col(f"{part}_n")
    return dec_div(F.col(part) * scale, F.when(n != 0, n), digits)


def overview(txn: DataFrame) -> DataFrame:
    """K1: one-row overview.  Ratios divide the rounded totals, as the
    pricing engine does; zero totals give 0."""
    a = sums(txn).select(
        F.coalesce(F.col("_rev"), F.lit(0)).alias("_rev"),
        F.coalesce(F.col("_profit"), F.lit(0)).alias("_profit"),
        F.coalesce(F.col("_rows"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.col("_qty"), F.lit(0)).cast("bigint").alias("total_quantity"),
        _mean("_price", 2).alias("avg_selling_price"),
        _mean("_disc", 2, 100).alias("avg_discount_pct"),
        F.coalesce(F.col("_cogs"), F.lit(0)).alias("_cogs"),
    )
    rev = F.round(F.col("_rev"), 2)
    return a.select(
        rev.cast("double").alias("total_revenue"),
        _dbl(F.col("_profit")).alias("total_profit"),
        "total_orders",
        "total_quantity",
        F.when(F.col("total_orders") > 0, dec_div(rev, F.col("total_orders"), 2))
         .otherwise(F.lit(0.0)).alias("avg_order_value"),
        "avg_selling_price",
        "avg_discount_pct",
        F.when(rev != 0, dec_div((rev - F.col("_cogs")) * 100, rev, 2))
         .otherwise(F.lit(0.0)).alias("overall_gross_margin"),
        F.lit(config.CURRENCY_SYMBOL).alias("currency"),
    )


def _sales_columns() -> list[Column]:
    return [
        F.col("_qty").alias("total_quantity"), F.col("_orders").alias("total_orders"),
        _mean("_price", 6).alias("avg_selling_price"), _mean("_disc", 2, 100).alias("avg_discount_pct"),
    ]


def _margin_pct(rev: Column, profit: Column) -> Column:
    # Scale before dividing: decimal division keeps a limited number of
    # fractional digits, and rounding twice must not move a value across a tie.
    return F.when(rev > 0, dec_div(profit * 100, rev, 2)).otherwise(F.lit(0.0))


def product_kpis(txn: DataFrame, products: DataFrame, inventory: DataFrame) -> DataFrame:
    """K2-K9: per-product sales, metadata, stock and the derived rates.

    Sales and stock are each aggregated to one row per product before they
    meet, so the joins are product-grain (no fan-out)."""
    sales = sums(txn, "product_id")
    meta = products.select("product_id", "product_name", "category", "base_price", "cost")
    stock = inventory.groupBy("product_id").agg(
        F.sum("initial_stock").alias("total_initial_stock"),
        F.sum("current_stock").alias("total_current_stock"),
        F.sum("total_sold").alias("total_sold_inv"))
    j = sales.join(meta, "product_id", "left").join(stock, "product_id", "left")
    return j.select(
        "product_id",
        F.col("_rev").cast("double").alias("total_revenue"),
        F.col("_profit").cast("double").alias("total_profit"),
        *_sales_columns(),
        "product_name", "category",
        F.col("base_price").cast("double").alias("base_price"),
        F.col("cost").cast("double").alias("cost"),
        "total_initial_stock", "total_current_stock", "total_sold_inv",
        *product_rates(F.col("total_initial_stock"), F.col("total_current_stock"),
                       F.col("total_sold_inv"), F.col("_rev"), F.col("_profit")),
    )


def product_rates(initial: Column, current: Column, sold: Column, revenue: Column,
                  profit: Column) -> list[Column]:
    """K7, K8, K5: sell-through (sold / initial x 100), turnover (sold /
    mean of initial and current stock) and gross margin (profit / revenue x
    100); 0 when the divisor is not positive or missing."""
    avg_stock2 = initial + current  # twice the average stock, kept integral
    return [
        F.when(initial > 0, dec_div(sold * 100, initial, 2)).otherwise(F.lit(0.0))
        .alias("sell_through_rate"),
        F.when(avg_stock2 > 0, dec_div(sold * 2, avg_stock2, 2)).otherwise(F.lit(0.0))
        .alias("inventory_turnover"),
        _margin_pct(revenue, profit).alias("gross_margin_pct"),
    ]


def category_kpis(txn: DataFrame, products: DataFrame) -> DataFrame:
    """Per category; transactions whose product is unknown have no
    category and are dropped (as a pandas group-by drops NaN keys)."""
    return category_sums(txn, products).select(
        "category",
        F.col("_rev").cast("double").alias("total_revenue"),
        F.col("_profit").cast("double").alias("total_profit"),
        *_sales_columns(),
        _margin_pct(F.col("_rev"), F.col("_profit")).alias("gross_margin_pct"),
    )


def category_sums(txn: DataFrame, products: DataFrame) -> DataFrame:
    """Parts per category: reduced to products first, so that only one row per
    product meets the product table."""
    known = sums(txn, "product_id").join(products.select("product_id", "category"), "product_id")
    return sums(known.filter(F.col("category").isNotNull()), "category")


def discount_effectiveness(txn: DataFrame) -> DataFrame:
    """Promoted vs regular sales in one conditional aggregate (A5).

    The mean promo discount and the revenue per discount point are formed
    from exact sums and counts, never by dividing by a rounded mean."""
    promo, regular = F.col("is_promotion") == 1, F.col("is_promotion") == 0
    zero = F.lit(0)
    a = sums(txn, "is_promotion").agg(
        F.coalesce(F.sum(F.when(promo, F.col("_rows"))), zero).cast("bigint").alias("promo_orders"),
        F.coalesce(F.sum(F.when(regular, F.col("_rows"))), zero).cast("bigint").alias("non_promo_orders"),
        F.coalesce(F.sum(F.when(promo, F.col("_rev"))), zero).alias("_prev"),
        F.coalesce(F.sum(F.when(regular, F.col("_rev"))), zero).alias("_nrev"),
        F.sum(F.when(promo, F.col("_disc"))).alias("_psum"),
        F.coalesce(F.sum(F.when(promo, F.col("_disc_n"))), zero).alias("_pn"),
    )
    prev = F.round(F.col("_prev"), 2)
    mean_pct = dec_div(F.col("_psum") * 100, F.when(F.col("_pn") != 0, F.col("_pn")), 2)
    return a.select(
        "promo_orders", "non_promo_orders",
        prev.cast("double").alias("promo_revenue"),
        _dbl(F.col("_nrev")).alias("non_promo_revenue"),
        F.when(F.col("promo_orders") > 0, mean_pct).otherwise(F.lit(0.0))
         .alias("avg_promo_discount_pct"),
        F.when((F.col("promo_orders") > 0) & (F.col("_psum") > 0),
               dec_div_wide(prev * F.col("_pn"), F.col("_psum") * 100, 2))
         .otherwise(F.lit(0.0)).alias("revenue_per_discount_pct"),
    )


def monthly_trends(txn: DataFrame) -> DataFrame:
    """Revenue, profit, quantity and orders per YYYY-MM (gaps not filled)."""
    return sums(txn, month_label(F.col("date")).alias("date")).select(
        "date", _dbl(F.col("_rev")).alias("revenue"), _dbl(F.col("_profit")).alias("profit"),
        F.col("_qty").alias("quantity"), F.col("_orders").alias("orders"))


def top_bottom_sellers(product_kpis_df: DataFrame, n: int = 10) -> DataFrame:
    """Top-n and bottom-n products by total revenue.

    Both ends are TakeOrderedAndProject (per-partition top-n, then merge), so
    the product table is never fully sorted.  The bottom block lists the
    tail of the descending order, worst last; with fewer than 2n products
    the blocks overlap, as a head/tail split does."""
    cols = ["product_id", "product_name", "category", "total_revenue", "total_quantity"]
    base = product_kpis_df.select(*cols)
    top = base.orderBy(F.col("total_revenue").desc(), F.col("product_id").asc()).limit(n)
    bottom = base.orderBy(F.col("total_revenue").asc(), F.col("product_id").desc()).limit(n)
    top = top.withColumn("section", F.lit("top")).withColumn(
        "position", F.row_number().over(Window.partitionBy("section").orderBy(
            F.col("total_revenue").desc(), F.col("product_id").asc())))
    bottom = bottom.withColumn("section", F.lit("bottom")).withColumn(
        "position", F.row_number().over(Window.partitionBy("section").orderBy(
            F.col("total_revenue").desc(), F.col("product_id").asc())))
    return top.unionByName(bottom)
