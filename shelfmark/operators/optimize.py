"""Per-product discount optimisation and recommendations.

Each product's candidate discounts are arrays beside its row, so the search is
a projection.  The coarse grid is 0..50 % in 1 % steps; the
refinement searches +-2 % around the coarse winner in 0.01 % steps (the
4-decimal grid the result is rounded to).  Ties go to the smallest discount.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import config
from shelfmark.functions.exact import div_half_up, round_half_up_double as r2d
from shelfmark.functions.labels import recommendation_label
from shelfmark.functions.ranking import non_null_count, with_average_rank2
from shelfmark.sources.shared import write_shared
from shelfmark.operators.markdown import recent_quantity, resolve_elasticity, stock_per_product, with_base_demand


def inputs(products: DataFrame, inventory: DataFrame, txn: DataFrame,
           product_elasticity: DataFrame, category_frame: DataFrame | None = None,
           recent: DataFrame | None = None, configured: dict[str, float] | None = None) -> DataFrame:
    """Unrounded recent daily demand (default base_demand), stock =
    3 x current stock truncated (1.0 when the product has no stock row), and
    the resolved elasticity.  ``recent`` may pass a shared ``recent_quantity``
    frame (the scenarios round the same unrounded sums differently)."""
    recent = recent if recent is not None else recent_quantity(txn)
    demand = recent.select(
        "product_id", (F.col("recent_qty") / F.lit(float(config.RECENT_DAYS))).alias("_rd"))
    stock = stock_per_product(inventory).select(
        "product_id",
        (F.col("stock_sum") * config.STOCK_PRESSURE_FACTOR).cast("double").alias("_st"))
    elas = resolve_elasticity(products, product_elasticity, category_frame, configured)
    products = with_base_demand(products)
    return (products.select("product_id", "product_name", "category", "base_price", "cost",
                            "base_demand")
            .join(demand, "product_id", "left")
            .join(stock, "product_id", "left")
            .join(elas, "product_id", "left")
            .select("product_id", "product_name", "category",
                    F.col("base_price").cast("double").alias("base_price"),
                    F.col("cost").cast("double").alias("cost"),
                    F.coalesce(F.col("_rd"), F.col("base_demand")).alias("demand"),
                    F.coalesce(F.col("_st"), F.lit(1.0)).alias("stock"),
                    "elasticity"))


def _monthly(ratio: Column, e: Column, demand: Column, days: int) -> tuple[Column, Column]:
    """Daily and monthly demand at a price ratio."""
    mult = F.when(ratio > 0, F.pow(ratio, e)).otherwise(F.lit(0.0))
    daily = F.greatest(F.lit(0.0), demand * mult)
    return daily, daily * days


def _profit(ratio: Column, monthly: Column, base: Column, cost: Column, stock: Column) -> Column:
    """Margin on the month's demand less the holding cost of what stays."""
    unsold = F.greatest(F.lit(0.0), stock - monthly)
    return (base * ratio - cost) * monthly - unsold * base * config.HOLDING_COST_RATE


def _clearance(monthly: Column, stock: Column) -> Column:
    return F.when(stock > 0, monthly / stock * 100).otherwise(F.lit(0.0))


def metrics(d: Column, base: Column, cost: Column, e: Column, demand: Column,
            stock: Column, days: int = config.PROJECTION_DAYS) -> dict[str, Column]:
    """O1: unrounded measures at discount fraction ``d``."""
    ratio = F.lit(1.0) - d
    price = base * ratio
    daily, monthly = _monthly(ratio, e, demand, days)
    return {"price": price, "daily": daily, "monthly": monthly, "revenue": price * monthly,
            "profit": _profit(ratio, monthly, base, cost, stock), "clearance": _clearance(monthly, stock)}


def _penalised(p: Column, clearance: Column, min_clearance: float = config.OPT_MIN_CLEARANCE) -> Column:
    """O2: two-decimal profit, less 10 % of its size when clearance (2dp) misses the target."""
    return F.when(r2d(clearance, 2) < min_clearance * 100, p - F.abs(p) * 0.1).otherwise(p)


def objective(m: dict[str, Column], min_clearance: float = config.OPT_MIN_CLEARANCE) -> Column:
    """O2 on the measures of a discount.  Doubles are rounded half up as floor(x*100 + 0.5)/100."""
    return _penalised(r2d(m["profit"], 2), m["clearance"], min_clearance)


_BOUNDS = tuple(round(d * 10000) for d in (config.OPT_DISCOUNT_MIN, config.OPT_DISCOUNT_MAX))
_FOUND = T.StructType([T.StructField("_coarse", T.LongType()), T.StructField("_opt", T.LongType())])
_BLOCK = 32  # products searched at once: some 401 candidates each, 100 kB a measure, so that measures stay in the cache


def _cents_np(x: np.ndarray) -> np.ndarray:
    """``r2d(x, 2)`` as Spark computes it: its FLOOR is a 64-bit integer (NaN is 0, larger values stop at the bounds)."""
    cents = np.floor(x * 100.0 + 0.5)
    return np.clip(np.where(np.isnan(cents), 0.0, cents), -2.0 ** 63, 2.0 ** 63) / 100.0


def _values_np(bp: np.ndarray, base, cost, e, demand, stock) -> np.ndarray:
    """O2 for an array of candidates (basis points) per product: the operations of ``objective``, in its order."""
    ratio = 1.0 - bp / 10000.0
    monthly = np.maximum(0.0, demand * np.power(ratio, e)) * config.PROJECTION_DAYS
    unsold = np.maximum(0.0, stock - monthly)
    profit = _cents_np((base * ratio - cost) * monthly - unsold * base * config.HOLDING_COST_RATE)
    clearance = _cents_np(np.where(stock > 0, monthly / np.where(stock > 0, stock, 1.0) * 100, 0.0))
    return np.where(clearance < config.OPT_MIN_CLEARANCE * 100, profit - np.abs(profit) * 0.1, profit)


def _best_np(lo: np.ndarray, hi: np.ndarray, step: int, width: int, *row: np.ndarray) -> np.ndarray:
    """Per product the candidate from lo to hi with the highest objective, the smallest on ties."""
    bp = lo[:, None] + step * np.arange(width)
    with np.errstate(all="ignore"):
        value = np.where(bp <= hi[:, None], _values_np(bp, *(c[:, None] for c in row)), -np.inf)
    return lo + step * np.argmax(value, axis=1)


def _search_rows(base: pa.Array, cost: pa.Array, e: pa.Array, demand: pa.Array, stock: pa.Array) -> pa.Array:
    """Both searches for a batch of products, block by block; without a price or a cost there is no optimum."""
    def numbers(a: pa.Array) -> np.ndarray:
        return a.fill_null(0.0).to_numpy(zero_copy_only=False).astype(float)

    unknown = base.is_null().to_numpy(zero_copy_only=False) | cost.is_null().to_numpy(zero_copy_only=False)
    # Without an elasticity there is no demand, as without a demand.
    known_e = ~e.is_null().to_numpy(zero_copy_only=False)
    row = (numbers(base), numbers(cost), numbers(e), np.where(known_e, numbers(demand), 0.0), numbers(stock))
    first, last = _BOUNDS
    coarse, fine = np.empty(len(base), np.int64), np.empty(len(base), np.int64)
    for at in range(0, len(base), _BLOCK):
        part = [c[at:at + _BLOCK] for c in row]
        ends = np.full(len(part[0]), first), np.full(len(part[0]), last)
        found = _best_np(*ends, 100, (last - first) // 100 + 1, *part)
        coarse[at:at + _BLOCK] = found
        fine[at:at + _BLOCK] = _best_np(np.maximum(first, found - 200), np.minimum(last, found + 200), 1, 401, *part)
    return pa.StructArray.from_arrays([pa.array(x, pa.int64(), mask=unknown) for x in (coarse, fine)], ["_coarse", "_opt"])


def search(inp: DataFrame) -> DataFrame:
    """O3 + O4: the coarse-grid winner ``_coarse`` and the refined optimum
    ``_opt`` (both in basis points) per product, a projection of one row per product.

    The rows are dealt out first: a search is much work for few bytes, which
    sizes in bytes would pack into few tasks.  Each measure is one numpy array of a block
    of products and their candidates, so nothing is exploded or shuffled."""
    found = F.arrow_udf(_search_rows, _FOUND)("base_price", "cost", "elasticity", "demand", "stock")
    dealt = inp.repartition("product_id").withColumn("_found", found)
    return dealt.select(*inp.columns, "_found._coarse", "_found._opt")


def optimise(inp: DataFrame) -> DataFrame:
    """O3 + O4 + O6: optimal discount per product with its metrics, the
    zero-discount baseline and the uplift (16 columns)."""
    row = {"base": F.col("base_price"), "cost": F.col("cost"), "e": F.col("elasticity"),
           "demand": F.col("demand"), "stock": F.col("stock")}
    s = search(inp)
    d = F.col("_opt") / F.lit(10000.0)
    opt = metrics(d, **row)
    base = metrics(F.lit(0.0), **row)
    opt_profit = r2d(opt["profit"], 2)
    base_profit = r2d(base["profit"], 2)
    return s.select(
        "product_id", "product_name", "category", "base_price", "cost",
        (F.col("_opt").cast("double") / F.lit(100.0)).alias("optimal_discount_pct"),
        r2d(opt["price"], 2).alias("new_price"),
        r2d(F.col("elasticity"), 4).alias("elasticity"),
        r2d(F.col("demand"), 2).alias("current_daily_demand"),
        F.bround(opt["monthly"], 0).cast("bigint").alias("expected_monthly_demand"),
        r2d(opt["revenue"], 2).alias("expected_revenue"),
        opt_profit.alias("expected_profit"),
        base_profit.alias("baseline_profit"),
        r2d(opt_profit - base_profit, 2).alias("profit_uplift"),
        F.col("stock").cast("bigint").alias("current_stock"),
        r2d(opt["clearance"], 2).alias("inventory_clearance_pct"),
    )


def recommend(opt: DataFrame) -> DataFrame:
    """O7 + O8: label and priority score, sorted by priority (desc).

    priority = 0.4 pr(uplift) + 0.3 pr(profit) + 0.3 pr(clearance) with pr the
    average-tie percentile rank; computed exactly from integer ranks,
    (4 A + 3 B + 3 C) / (20 N), and rounded half up to 3 decimals."""
    opt = write_shared(opt, "discounts")  # one row per product, read by the ranks and the join
    r = with_average_rank2(opt, "product_id", {"profit_uplift": "_ra", "expected_profit": "_rb",
                                               "inventory_clearance_pct": "_rc"})
    n = non_null_count(opt, "product_id")
    num = F.col("_ra") * 4 + F.col("_rb") * 3 + F.col("_rc") * 3
    score = div_half_up(num * 1000, n * 20).cast("double") / F.lit(1000.0)
    return (r.withColumn("recommendation", recommendation_label(F.col("optimal_discount_pct")))
            .withColumn("priority_score", score)
            .drop("_ra", "_rb", "_rc")
            .orderBy(F.col("priority_score").desc(), F.col("product_id").asc()))


def label_breakdown(recs: DataFrame) -> DataFrame:
    """Products per recommendation label, most frequent first."""
    return recs.groupBy("recommendation").agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.col("count").desc(), F.col("recommendation").asc())


def run_summary(recs: DataFrame) -> DataFrame:
    """One-row summary; zeros when there are no products."""
    return recs.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.coalesce(F.round(F.avg("optimal_discount_pct"), 2), F.lit(0.0)).alias("avg_optimal_discount_pct"),
        F.coalesce(F.round(F.sum("expected_profit"), 2), F.lit(0.0)).alias("total_expected_profit"),
        F.coalesce(F.round(F.sum("expected_revenue"), 2), F.lit(0.0)).alias("total_expected_revenue"),
    )
