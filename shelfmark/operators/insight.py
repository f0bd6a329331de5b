"""Dashboard analytics (D1-D12, W1/W3-W5, L4, T16, C5, C6) as DataFrame plans.

Windows without a partition key here only ever run over inputs whose size
is bounded by the calendar or by the number of categories (monthly trends,
category totals), never over transactions or products.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark import config
from shelfmark.functions.exact import dec_div, round_half_up_double as r2d
from shelfmark.functions.labels import (discount_level, elasticity_badge,
                                        elasticity_colour_band, elasticity_display,
                                        margin_level)
from shelfmark.operators.kpi import category_sums
from shelfmark.functions.ranking import non_null_count, with_average_rank2


def _trend(cur: Column, prev: Column) -> tuple[Column, Column]:
    pct = (cur - prev) / prev * 100
    direction = (F.when(pct > 0, F.lit("up")).when(pct < 0, F.lit("down"))
                 .when(pct.isNotNull(), F.lit("flat")))
    return r2d(pct, 2), direction


def month_over_month(monthly: DataFrame) -> DataFrame:
    """D1 + D2 (W3): change vs the previous month for revenue, profit,
    orders and average order value; up / down / flat."""
    w = Window.orderBy("date")
    aov = F.col("revenue") / F.col("orders")
    m = monthly.select("date", "revenue", "profit", "orders", aov.alias("_aov"))
    cols = [F.col("date"), F.col("revenue"), F.col("profit"), F.col("orders"),
            r2d(F.col("_aov"), 2).alias("aov")]
    for name, c in (("revenue", F.col("revenue")), ("profit", F.col("profit")),
                    ("orders", F.col("orders").cast("double")), ("aov", F.col("_aov"))):
        pct, direction = _trend(c, F.lag(c).over(w))
        cols += [pct.alias(f"{name}_change_pct"), direction.alias(f"{name}_trend")]
    return m.select(*cols)


def last_months(monthly: DataFrame, k: int = 12) -> DataFrame:
    """D3 (W4): the last ``k`` months (TakeOrderedAndProject, no full sort)."""
    return monthly.orderBy(F.col("date").desc()).limit(k)


def category_share(txn: DataFrame, products: DataFrame) -> DataFrame:
    """D4 (W5): revenue per category and its share of all categories."""
    g = category_sums(txn, products)
    total = F.sum("_rev").over(Window.partitionBy())
    return g.select("category", F.col("_rev").cast("double").alias("revenue"),
                    dec_div(F.col("_rev") * 100, total, 2).alias("share_pct"))


def category_performance(txn: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, profit and units per category."""
    return category_sums(txn, products).select(
        "category", F.col("_rev").cast("double").alias("revenue"),
        F.col("_profit").cast("double").alias("profit"), F.col("_qty").alias("units"))


def history_and_forecast(spine: DataFrame, fc: DataFrame) -> DataFrame:
    """D6 (U2): history and forecast in one series per category and for all
    categories together, with a ``kind`` column and the forecast band."""
    hist = spine.select("category", F.date_format("month", "yyyy-MM").alias("month"),
                        F.col("quantity").alias("value"), F.lit("historical").alias("kind"),
                        F.lit(None).cast("bigint").alias("lower"),
                        F.lit(None).cast("bigint").alias("upper"))
    fut = fc.select("category", "month", F.col("forecast").alias("value"),
                    F.lit("forecast").alias("kind"),
                    F.col("confidence_lower").alias("lower"),
                    F.col("confidence_upper").alias("upper"))
    both = hist.unionByName(fut).withColumn("category", F.explode(F.array("category", F.lit("all"))))
    return both.groupBy("category", "month", "kind").agg(
        F.sum("value").alias("value"), F.sum("lower").alias("lower"), F.sum("upper").alias("upper"))


def price_demand_curve(category_elasticity: DataFrame, base_price: float = 1000.0,
                       base_units: float = 500.0) -> DataFrame:
    """Demand at -40 % .. +60 % of a reference price, per category
    elasticity: q = round(max(0, 500 * (p / 1000) ^ e)), half up."""
    pts = category_elasticity.select(
        "category", "elasticity", F.explode(F.sequence(F.lit(-40), F.lit(60), F.lit(5))).alias("dp"))
    price = F.lit(base_price) * (F.lit(1.0) + F.col("dp") / F.lit(100.0))
    q = F.greatest(F.lit(0.0), F.lit(base_units) * F.pow(price / F.lit(base_price),
                                                          F.col("elasticity")))
    return pts.select("category", "dp", price.alias("price"),
                      F.floor(q + 0.5).cast("bigint").alias("demand"))


def elasticity_cards(category_elasticity: DataFrame) -> DataFrame:
    """Badge, colour band and description per category."""
    e = F.col("elasticity")
    return category_elasticity.select(
        "category", "elasticity", "classification",
        elasticity_badge(e).alias("badge"), elasticity_colour_band(e).alias("band"),
        elasticity_display(e).alias("description"))


def base_units(recs: DataFrame) -> Column:
    """Baseline monthly units of a recommendation: round(daily demand x 30)."""
    return F.floor(F.col("current_daily_demand") * config.PROJECTION_DAYS + 0.5).cast("double")


def recommendation_totals(recs: DataFrame) -> DataFrame:
    """Products with a discount, their mean discount and the revenue
    uplift versus selling the baseline units at the current price."""
    disc = F.col("optimal_discount_pct") > 0
    uplift = F.col("expected_revenue") - F.col("base_price") * base_units(recs)
    return recs.agg(
        F.count_if(disc).alias("discounted_products"),
        r2d(F.coalesce(F.avg(F.when(disc, F.col("optimal_discount_pct"))), F.lit(0.0)), 1)
        .alias("avg_discount_pct"),
        r2d(F.coalesce(F.sum(F.when(disc, uplift)), F.lit(0.0)), 2).alias("revenue_uplift"))


# Fixed what-if scenario grid (percent shocks): demand, competitor, inventory.
WHATIF_DEMAND = (-30, 0, 50)
WHATIF_COMPETITOR = (-30, 0, 50)
WHATIF_INVENTORY = (-20, 0, 20)


def whatif_scenarios() -> list[tuple[int, int, int]]:
    """The default scenarios: all combinations of three shocks each."""
    return [(d, c, i) for d in WHATIF_DEMAND for c in WHATIF_COMPETITOR for i in WHATIF_INVENTORY]


def whatif(recs: DataFrame, category_elasticity: DataFrame, products: DataFrame,
           scenarios: list[tuple[float, float, float]] | None = None) -> DataFrame:
    """Recompute every recommendation under every scenario, given as
    (demand, competitor, inventory) shocks in percent.

    The scenarios are a small literal array exploded per row (narrow).  Discount
    shifts by 0.3 x competitor shock and 0.15 x inventory shock (points),
    clamped to 0..50; demand lift is linear: 1 + discount x |elasticity|
    (elasticity 1 when unknown); cost falls back to 0.6 x price."""
    grid = F.array(*[F.struct(F.lit(d).alias("demand_shock"), F.lit(c).alias("competitor_shock"),
                              F.lit(i).alias("inventory_shock"))
                     for d, c, i in (whatif_scenarios() if scenarios is None else scenarios)])
    e = category_elasticity.select("category", F.col("elasticity").alias("_ce"))
    cost = products.select("product_id", F.col("cost").cast("double").alias("_pc"))
    r = (recs.join(e, "category", "left").join(cost, "product_id", "left")
         .select("product_id", "product_name", "category", "base_price", "optimal_discount_pct",
                 base_units(recs).alias("_bu"), F.col("optimal_discount_pct").alias("_od"),
                 F.coalesce(F.when(F.col("_ce") != 0, F.abs("_ce")), F.lit(1.0)).alias("_e"),
                 F.coalesce(F.col("_pc"), F.col("base_price") * 0.6).alias("_cost"),
                 F.explode(grid).alias("s")))
    adj = (F.col("optimal_discount_pct") + F.col("s.competitor_shock") * 0.3
           + F.col("s.inventory_shock") * 0.15)
    adj = F.greatest(F.lit(0.0), F.least(F.lit(50.0), adj))
    r = r.select("*", adj.alias("_adj"))
    new_demand = F.col("_bu") * (F.lit(1.0) + F.col("s.demand_shock") / F.lit(100.0))
    price = F.floor(F.col("base_price") * (F.lit(1.0) - F.col("_adj") / 100) + 0.5).cast("double")
    units = F.floor(new_demand * (F.lit(1.0) + F.col("_adj") / 100 * F.col("_e")) + 0.5)
    return r.select(
        "s.demand_shock", "s.competitor_shock", "s.inventory_shock",
        "product_id", "product_name", "category", "base_price",
        F.col("_bu").alias("base_units"), F.col("_cost").alias("cost"),
        F.col("_od").alias("base_discount_pct"),
        (F.floor(F.col("_adj") * 10 + 0.5) / 10).alias("adj_discount_pct"),
        price.alias("adj_price"), units.cast("bigint").alias("adj_units"),
        (price * units).alias("adj_revenue"), ((price - F.col("_cost")) * units).alias("adj_profit"),
        discount_level(F.floor(F.col("_adj") * 10 + 0.5) / 10).alias("discount_level"))


def whatif_totals(wi: DataFrame) -> DataFrame:
    """Totals per scenario and their change vs the unshocked base
    (within +-0.5 % counts as flat)."""
    keys = ["demand_shock", "competitor_shock", "inventory_shock"]
    a = wi.groupBy(*keys).agg(
        F.sum("adj_revenue").alias("revenue"), F.sum("adj_profit").alias("profit"),
        F.sum("adj_units").alias("units"), F.avg("adj_discount_pct").alias("_disc"),
        F.sum(F.col("base_price") * F.col("base_units")).alias("_brev"),
        F.sum((F.col("base_price") - F.col("cost")) * F.col("base_units")).alias("_bprof"),
        F.sum("base_units").alias("_bunits"), F.avg("base_discount_pct").alias("_bdisc"))

    def trend(cur, base, name):
        b = F.when(base != 0, base).otherwise(F.lit(1.0))
        pct = (cur - base) / b * 100
        lab = F.when(pct > 0.5, F.lit("up")).when(pct < -0.5, F.lit("down")).otherwise(F.lit("flat"))
        return [r2d(pct, 2).alias(f"{name}_change_pct"), lab.alias(f"{name}_trend")]

    return a.select(*keys, r2d(F.col("revenue"), 2).alias("revenue"),
                    r2d(F.col("profit"), 2).alias("profit"), "units",
                    r2d(F.col("_disc"), 2).alias("avg_discount_pct"),
                    *trend(F.col("revenue"), F.col("_brev"), "revenue"),
                    *trend(F.col("profit"), F.col("_bprof"), "profit"),
                    *trend(F.col("units").cast("double"), F.col("_bunits").cast("double"), "units"),
                    *trend(F.col("_disc"), F.col("_bdisc"), "discount"))


def margin_levels(product_kpis: DataFrame) -> DataFrame:
    """Margin colour level per product."""
    return product_kpis.select("product_id", "gross_margin_pct",
                               margin_level(F.col("gross_margin_pct")).alias("margin_level"))


def discount_levels(recs: DataFrame) -> DataFrame:
    """Discount badge level per recommendation."""
    return recs.select("product_id", "optimal_discount_pct",
                       discount_level(F.col("optimal_discount_pct")).alias("discount_level"))


def search_and_sort(table: DataFrame, query: str, sort_col: str, ascending: bool = True) -> DataFrame:
    """T16 + L4: case-insensitive substring match on name or category, then a
    sort on one column (strings compared lower-cased)."""
    q = F.lit(query.lower())
    hit = F.contains(F.lower("product_name"), q) | F.contains(F.lower("category"), q)
    key = F.col(sort_col)
    if dict(table.dtypes)[sort_col] == "string":
        key = F.lower(key)
    key = key.asc() if ascending else key.desc()
    return table.filter(hit).orderBy(key, F.col("product_id").asc())


def truncate_text(c: Column, length: int) -> Column:
    """Longer than ``length`` -> first length-1 characters and an ellipsis."""
    return F.when(F.length(c) > length, F.concat(F.substring(c, 1, length - 1), F.lit("…"))) \
        .otherwise(c)


def money_text(n: Column, compact: bool = False) -> Column:
    """Indian money text: groups of three then two (12,34,567), sign after
    the symbol, compact 'Cr' from 1e7 and 'L' from 1e5, null as a dash."""
    sym = F.lit(config.CURRENCY_SYMBOL)
    digits = F.round(F.abs(n), 0).cast("decimal(38,0)").cast("string")
    sign = F.when(F.round(n, 0) < 0, F.lit("-")).otherwise(F.lit(""))
    tail = digits.substr(F.length(digits) - 2, F.lit(3))
    # The digits before the last three in pairs; an odd one stands alone in front.
    head = F.lpad(digits.substr(F.lit(1), F.length(digits) - 3), 36, " ")
    pairs = F.transform(F.sequence(F.lit(0), F.lit(17)), lambda k: F.trim(F.substring(head, 2 * k + 1, F.lit(2))))
    body = F.when(F.length(digits) > 3, F.concat(
        F.array_join(F.array_remove(pairs, ""), ","), F.lit(","), tail)).otherwise(digits)
    full = F.concat(sym, sign, body)
    if not compact:
        return F.when(n.isNull() | F.isnan(n), F.lit("—")).otherwise(full)
    a = F.abs(n)
    return (F.when(n.isNull() | F.isnan(n), F.lit("—"))
            .when(a >= 1e7, F.concat(sym, F.format_string("%.2f", n / 1e7), F.lit(" Cr")))
            .when(a >= 1e5, F.concat(sym, F.format_string("%.2f", n / 1e5), F.lit(" L")))
            .otherwise(full))


def pct_rank(df: DataFrame, col: str, out: str = "pct_rank", key: str | None = None) -> DataFrame:
    """Average-tie percentile rank of ``col`` (rank / N), distributed;
    ``key`` (default: the first column) is unique."""
    r = with_average_rank2(df, key or df.columns[0], {col: "_r2"})
    n = non_null_count(df, col)
    return r.withColumn(out, F.col("_r2") / (n * 2.0)).drop("_r2")
