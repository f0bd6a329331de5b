"""Price elasticity (E1-E9): log-log regressions as distributed aggregates.

Per product the fact table becomes one row of counts, means and centred co-moments
(``product_moments``), combined map-side, so a product with a third of all rows costs
one partial aggregate per task.  Rows of moments merge to any coarser key by the
pairwise update, so the category fits start from the product rows and the product
table meets nothing larger.  The pooled model has five variables: its moments are taken
over all rows at once (``pooled_moments``), one row per task, as five variables per
product would shuffle several times the bytes of the two that the other fits need.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import config
from shelfmark.functions.labels import classify_elasticity
from shelfmark.sources.shared import write_shared

FEATURES = ("ln_price", "is_promotion", "month", "ln_comp_price")


def safe_ln(c: Column) -> Column:
    """Natural log, null for x <= 0 or null."""
    return F.when(c > 0, F.ln(c.cast("double")))


def _observations(txn: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """Quantity > 0 and both logs defined; with more features, `_full` marks rows that have them all."""
    named = {"ln_price": safe_ln(F.col("selling_price"))}
    if len(features) > 1:
        named |= {"is_promotion": F.col("is_promotion").cast("double"), "month": F.col("month").cast("double"),
                  "ln_comp_price": safe_ln(F.col("competitor_price"))}
    rows = (txn.filter(F.col("quantity") > 0)
            .select("product_id", safe_ln(F.col("quantity")).alias("y"), *[named[f].alias(f"x{i}") for i, f in enumerate(features)])
            .dropna(subset=["y", "x0"]))
    full = F.lit(True)
    for i in range(len(features)):
        full &= F.col(f"x{i}").isNotNull()
    return rows.withColumn("_full", full)


def _variables(k: int) -> list[str]:
    return ["y", *(f"x{i}" for i in range(k))]


def _pairs(k: int) -> list[tuple[str, str]]:
    v = _variables(k)
    return [(a, b) for i, a in enumerate(v) for b in v[i:]]


def _moments(k: int, prefix: str, seen: Column) -> list[Column]:
    """Count, means and centred co-moments of y, x0 .. x(k-1) over the rows `seen`."""
    v = {c: F.when(seen, F.col(c)) for c in _variables(k)}
    n = F.count(F.when(seen, F.lit(1)))
    return [n.alias(f"{prefix}n"), *(F.avg(v[c]).alias(f"{prefix}m_{c}") for c in v),
            *((F.covar_pop(v[a], v[b]) * n).alias(f"{prefix}c_{a}_{b}") for a, b in _pairs(k))]


def product_moments(txn: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """One pass over the fact: per product the moments of (ln_qty, ln_price), and with more features
    (prefix ``f_``) those of all of them over the rows that have them all."""
    aggs = _moments(1, "", F.lit(True))
    if len(features) > 1:
        aggs += _moments(len(features), "f_", F.col("_full"))
    return _observations(txn, features).groupBy("product_id").agg(*aggs)


def pooled_moments(txn: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """One pass over the fact: the moments of all variables over the rows that have them all, in one row."""
    return _observations(txn, features).filter("_full").agg(*_moments(len(features), "", F.lit(True)))


def merge_moments(rows: DataFrame, keys: list[str], k: int, prefix: str = "") -> DataFrame:
    """Moments per coarser key: co-moments about the common mean are the parts' own plus n times the
    products of their means' distances from it (two sums over rows of moments, no cancellation)."""
    n, variables = F.col(f"{prefix}n"), _variables(k)
    rows = rows.filter(n > 0).withColumn("_all", F.lit(1))
    by = keys or ["_all"]
    means = rows.groupBy(*by).agg(F.sum(n).alias("_n"), *((F.sum(n * F.col(f"{prefix}m_{c}")) / F.sum(n)).alias(f"_m_{c}") for c in variables))
    off = {c: F.col(f"{prefix}m_{c}") - F.col(f"_m_{c}") for c in variables}
    out = rows.join(means, by).groupBy(*by).agg(
        F.first("_n").alias("n"), *(F.first(f"_m_{c}").alias(f"m_{c}") for c in variables),
        *(F.sum(F.col(f"{prefix}c_{a}_{b}") + n * off[a] * off[b]).alias(f"c_{a}_{b}") for a, b in _pairs(k)))
    return out if keys else out.drop("_all")


def _fit(moments: DataFrame, keys: list[str], min_obs: int) -> DataFrame:
    """Least squares ln_qty ~ ln_price per row of moments.

    A constant price (no spread beyond rounding) gives slope 0, intercept
    mean(y) and r2 0, or r2 1 when y is constant too, which is what ordinary
    least squares returns."""
    def spread(c: str) -> Column:
        v, m = F.col(f"c_{c}_{c}"), F.col(f"m_{c}")
        return F.when(v > F.lit(1e-24) * F.col("n") * (m * m + 1), v)

    x, y, xy = spread("x0"), spread("y"), F.col("c_y_x0")
    slope = F.coalesce(xy / x, F.lit(0.0))
    r2 = F.when(y.isNull(), F.lit(1.0)).when(x.isNull(), F.lit(0.0)).otherwise(xy * xy / (x * y))
    elasticity = F.round(slope, 4)
    return moments.filter(F.col("n") >= min_obs).select(
        *keys,
        elasticity.alias("elasticity"),
        F.round(F.col("m_y") - slope * F.col("m_x0"), 4).alias("intercept"),
        F.round(r2, 4).alias("r2"),
        F.col("n").cast("bigint").alias("n_obs"),
        classify_elasticity(elasticity).alias("classification"),
    )


def category_elasticity(txn: DataFrame | None, products: DataFrame, min_obs: int = config.MIN_OBSERVATIONS,
                        moments: DataFrame | None = None) -> DataFrame:
    """Per-category log-log fit; transactions without a category drop out.

    The products' moments (given, or taken from the transactions) meet the product table."""
    m = moments if moments is not None else product_moments(txn, FEATURES[:1])
    cat = products.select("product_id", "category").filter(F.col("category").isNotNull())
    return _fit(merge_moments(m.join(cat, "product_id"), ["category"], 1), ["category"], min_obs)


def product_elasticity(txn: DataFrame | None, products: DataFrame, min_obs: int = config.MIN_OBSERVATIONS,
                       moments: DataFrame | None = None) -> DataFrame:
    """Per-product fit with the product's name and category.

    The fit runs on transactions alone (one shuffle on product_id); the
    product attributes are joined to the fitted rows afterwards."""
    m = moments if moments is not None else product_moments(txn, FEATURES[:1])
    fits = _fit(m, ["product_id"], min_obs)
    meta = products.select("product_id", "product_name", "category")
    return fits.join(meta, "product_id", "left").select(
        "product_id", "product_name", "category", "elasticity", "intercept", "r2", "n_obs",
        "classification")


_MF_SCHEMA = T.StructType([
    T.StructField("coefficients", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("r2", T.DoubleType()),
    T.StructField("n_obs", T.LongType()),
    T.StructField("feature_names", T.ArrayType(T.StringType())),
])


def _solve_moments(batches):
    """Solve the centred normal equations from one row of moments."""
    k = len(FEATURES)
    for pdf in batches:
        rows = []
        for rec in pdf.to_dict("records"):
            n = int(rec["n"] or 0)
            if n < config.MIN_OBSERVATIONS:
                rows.append({"coefficients": {}, "r2": 0.0, "n_obs": 0,
                             "feature_names": list(FEATURES)})
                continue
            sxx = np.empty((k, k))
            sxy = np.empty(k)
            for i in range(k):
                sxy[i] = rec[f"c_{i}_y"]
                for j in range(k):
                    sxx[i, j] = rec[f"c_{min(i, j)}_{max(i, j)}"]
            beta, *_ = np.linalg.lstsq(sxx, sxy, rcond=None)
            means = np.array([rec[f"m_{i}"] for i in range(k)])
            intercept = rec["m_y"] - float(means @ beta)
            vy = rec["c_y_y"]
            r2 = float(beta @ sxy / vy) if vy > 0 else 1.0
            coefs = {f: round(float(b), 4) for f, b in zip(FEATURES, beta)}
            coefs["intercept"] = round(float(intercept), 4)
            rows.append({"coefficients": coefs, "r2": round(r2, 4), "n_obs": n,
                         "feature_names": list(FEATURES)})
        yield pd.DataFrame(rows, columns=["coefficients", "r2", "n_obs", "feature_names"])


def multifeature_elasticity(txn: DataFrame | None, moments: DataFrame | None = None) -> DataFrame:
    """E5: pooled OLS ln(q) ~ ln(p) + is_promotion + month + ln(comp) + 1.

    The pooled moments of the five variables (given, or taken from the transactions) are
    one row; the 4x4 centred system is then solved by numpy inside one task on that row."""
    k = len(FEATURES)
    pooled = moments if moments is not None else pooled_moments(txn)
    names = {"y": "y"} | {f"x{i}": str(i) for i in range(k)}
    n = F.when(F.col("n") != 0, F.col("n"))
    row = pooled.select("n", *(F.col(f"m_{v}").alias(f"m_{names[v]}") for v in names), *(
        (F.col(f"c_{a}_{b}") / n).alias("c_y_y" if b == "y" else f"c_{names[b]}_y" if a == "y" else f"c_{names[a]}_{names[b]}")
        for a, b in _pairs(k)))
    return row.coalesce(1).mapInPandas(_solve_moments, _MF_SCHEMA)


def resolve_category(cat: DataFrame, threshold: float = config.R2_THRESHOLD,
                     configured: dict[str, float] | None = None) -> DataFrame:
    """E6 + E7: weak category fits (r2 < threshold) take the configured
    elasticity; configured categories without a fit are appended with zeros."""
    conf = _config_frame(cat, configured)
    j = cat.join(conf, "category", "left")
    weak = (F.col("r2") < threshold) & F.col("_conf").isNotNull()
    e = F.when(weak, F.col("_conf")).otherwise(F.col("elasticity"))
    fitted = j.select("category", e.alias("elasticity"), "intercept", "r2", "n_obs",
                      classify_elasticity(e).alias("classification"))
    missing = conf.join(cat.select("category"), "category", "left_anti").select(
        "category", F.col("_conf").alias("elasticity"), F.lit(0.0).alias("intercept"),
        F.lit(0.0).alias("r2"), F.lit(0).cast("bigint").alias("n_obs"),
        classify_elasticity(F.col("_conf")).alias("classification"))
    return fitted.unionByName(missing)


def resolve_product(prod: DataFrame, resolved_cat: DataFrame,
                    threshold: float = config.R2_THRESHOLD) -> DataFrame:
    """Weak product fits take their category's (already resolved) value."""
    lookup = resolved_cat.select("category", F.col("elasticity").alias("_cat_e"))
    j = prod.join(lookup, "category", "left")
    weak = (F.col("r2") < threshold) & F.col("_cat_e").isNotNull()
    e = F.when(weak, F.col("_cat_e")).otherwise(F.col("elasticity"))
    return j.select("product_id", "product_name", "category", e.alias("elasticity"),
                    "intercept", "r2", "n_obs", classify_elasticity(e).alias("classification"))


def _config_frame(like: DataFrame, configured: dict[str, float] | None) -> DataFrame:
    """The configured category elasticities (default: the test tables') as an
    inline table of a few rows."""
    spark = like.sparkSession
    known = config.CATEGORY_ELASTICITY if configured is None else configured
    rows = [(k, float(v)) for k, v in known.items()]
    return spark.createDataFrame(rows, "category string, _conf double")


def run(txn: DataFrame, products: DataFrame, threshold: float = config.R2_THRESHOLD,
        configured: dict[str, float] | None = None) -> dict:
    """Three fits on moments that are written once, then E6 -> E7 -> E8."""
    moments = write_shared(product_moments(txn, FEATURES[:1]), "moments")  # one row per product
    pooled = write_shared(pooled_moments(txn), "pooled-moments")  # one row
    cat = category_elasticity(None, products, moments=moments)
    prod = product_elasticity(None, products, moments=moments)
    cat_resolved = resolve_category(cat, threshold, configured)
    return {
        "category_elasticity": cat_resolved,
        "product_elasticity": resolve_product(prod, cat_resolved, threshold),
        "multifeature_model": multifeature_elasticity(None, moments=pooled),
    }
