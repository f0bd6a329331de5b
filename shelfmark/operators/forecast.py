"""Monthly demand forecasting (F1-F10) for many series at once.

A series is one category's monthly units; its length is bounded by the
calendar (months), never by the number of transactions, so each series is
packed into one sorted array.  The additive Holt-Winters model (period 12)
is fitted per series by folds over that array (``seasonal.py``).
Series shorter than two seasons use the 3-month moving average.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import config
from shelfmark.operators import seasonal


def monthly_demand(txn: DataFrame, products: DataFrame, key: str = "category") -> DataFrame:
    """units per series and calendar month.  The series key is the
    product's category (unknown products dropped, as a group-by on a missing
    key drops them) or any product attribute, e.g. ``product_id`` for one
    series per product."""
    units = "_qty" if "_qty" in txn.columns else "quantity"
    src = txn.filter(F.col("product_id").isNotNull()) if key == "product_id" else txn
    src = src.groupBy("product_id", F.trunc("date", "month").alias("month")).agg(F.sum(units).alias("quantity"))
    if key == "product_id":
        return src
    # One row per product and month meets the product table, not every sale.
    known = src.join(products.select("product_id", key), "product_id").filter(F.col(key).isNotNull())
    return known.groupBy(key, "month").agg(F.sum("quantity").alias("quantity"))


def _key(df: DataFrame) -> str:
    """Series frames carry their key as the first column."""
    return df.columns[0]


def month_spine(monthly: DataFrame) -> DataFrame:
    """every month from each category's first to last month; gaps are 0."""
    k = _key(monthly)
    bounds = monthly.groupBy(k).agg(F.min("month").alias("_lo"), F.max("month").alias("_hi"))
    spine = bounds.select(k, F.explode(
        F.sequence("_lo", "_hi", F.expr("interval 1 month"))).alias("month"))
    return (spine.join(monthly, [k, "month"], "left")
            .select(k, "month",
                    F.coalesce(F.col("quantity"), F.lit(0)).cast("bigint").alias("quantity")))


def pack_series(spine: DataFrame) -> DataFrame:
    """One row per series: months and values as arrays sorted by month."""
    k = _key(spine)
    s = spine.groupBy(k).agg(
        F.sort_array(F.collect_list(F.struct("month", "quantity"))).alias("_pts"))
    return s.select(k,
                    F.transform("_pts", lambda p: p["month"]).alias("months"),
                    F.transform("_pts", lambda p: p["quantity"]).alias("values"))


def _future_labels(months: Column, horizon: int) -> Column:
    last = F.element_at(months, -1)
    return F.transform(F.sequence(F.lit(1), F.lit(horizon)),
                       lambda i: F.date_format(F.add_months(last, i), "yyyy-MM"))


def sma(series: DataFrame, horizon: int = config.FORECAST_MONTHS,
        window: int = config.SMA_WINDOW) -> DataFrame:
    """F4 + F5 (moving-average branch), long form: one row per future month.

    forecast = round(mean of the last ``window`` values) (half to even),
    band = forecast -+ 1.96 x sample std of the whole series (0 for one
    point), lower clamped at 0."""
    v = F.col("values").cast("array<double>")
    n = F.size("values")
    tail = F.slice(v, F.greatest(n - window + 1, F.lit(1)), window)
    mean_tail = F.aggregate(tail, F.lit(0.0), lambda a, x: a + x) / F.size(tail)
    mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n
    ss = F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    std = F.when(n > 1, F.sqrt(ss / (n - 1))).otherwise(F.lit(0.0))
    k = _key(series)
    base = series.select(k, "months", F.bround(mean_tail, 0).alias("_f"),
                         std.alias("_std"))
    labels = _future_labels(F.col("months"), horizon)
    out = base.select(k, "_f", "_std", F.posexplode(labels).alias("_h", "month"))
    z = F.lit(config.Z_95)
    return out.select(
        k, (F.col("_h") + 1).alias("h"), "month",
        F.col("_f").cast("bigint").alias("forecast"),
        F.greatest(F.lit(0.0), F.bround(F.col("_f") - z * F.col("_std"), 0)).cast("bigint")
        .alias("confidence_lower"),
        F.bround(F.col("_f") + z * F.col("_std"), 0).cast("bigint").alias("confidence_upper"),
    )


def holt_winters(series: DataFrame, horizon: int = config.FORECAST_MONTHS,
                 period: int = config.SEASONAL_PERIOD) -> DataFrame:
    """F3 + F5 + F6 (seasonal branch), long form, for series with at least two
    seasons.  forecast = max(0, round(pred)); band = pred -+ 1.96 x
    population std of the one-step errors, lower clamped at 0 (round half
    to even)."""
    k = _key(series)
    fits = seasonal.fit(series.filter(F.size("values") >= 2 * period), period)
    ahead = fits.select("*", F.posexplode(_future_labels(F.col("months"), horizon)).alias("_h", "month"))
    pred = (F.col("level") + (F.col("_h") + 1) * F.col("trend")
            + F.get("seasonals", F.col("_h") % period))
    spread = F.lit(config.Z_95) * F.col("deviation")

    def whole(x: Column) -> Column:
        return F.rint(x).cast("bigint")

    return ahead.select(
        k, (F.col("_h") + 1).alias("h"), "month",
        whole(F.greatest(F.lit(0.0), pred)).alias("forecast"),
        whole(F.greatest(F.lit(0.0), pred - spread)).alias("confidence_lower"),
        whole(pred + spread).alias("confidence_upper"), "alpha", "beta", "gamma")


def forecast_rows(series: DataFrame, horizon: int = config.FORECAST_MONTHS,
                  period: int = config.SEASONAL_PERIOD) -> DataFrame:
    """Every series' forecast in long form with the method used: the seasonal
    model, or the moving average for series shorter than two seasons."""
    hw = holt_winters(series, horizon, period).drop("alpha", "beta", "gamma") \
        .withColumn("method", F.lit("holt_winters"))
    short = series.filter(F.size("values") < 2 * period)
    ma = sma(short, horizon).withColumn("method", F.lit("simple_moving_average"))
    return hw.unionByName(ma)


def forecast_all(series: DataFrame, horizon: int = config.FORECAST_MONTHS,
                 period: int = config.SEASONAL_PERIOD) -> DataFrame:
    """F8 + F9: the packed result per category: historical values and labels,
    forecast, band, future labels and the method used."""
    fc = forecast_rows(series, horizon, period)
    k = _key(series)
    packed = fc.groupBy(k, "method").agg(
        F.sort_array(F.collect_list(F.struct("h", "forecast", "confidence_lower",
                                             "confidence_upper", "month"))).alias("_f"))
    return (series.join(packed, k)
            .select(k,
                    F.col("values").alias("historical"),
                    F.transform("_f", lambda x: x["forecast"]).alias("forecast"),
                    F.transform("_f", lambda x: x["confidence_lower"]).alias("confidence_lower"),
                    F.transform("_f", lambda x: x["confidence_upper"]).alias("confidence_upper"),
                    F.transform("months", lambda m: F.date_format(m, "yyyy-MM"))
                    .alias("dates_historical"),
                    F.transform("_f", lambda x: x["month"]).alias("dates_forecast"),
                    "method"))


def holdout(series: DataFrame, horizon: int = config.FORECAST_MONTHS) -> DataFrame:
    """Series without their last ``horizon`` points, plus those points."""
    n = F.size("values")
    return series.filter(n > horizon).select(
        _key(series),
        F.slice("months", 1, n - horizon).alias("months"),
        F.slice("values", 1, n - horizon).alias("values"),
        F.slice("values", n - horizon + 1, horizon).alias("actual"))


def backtest(series: DataFrame, method: str = "auto",
             horizon: int = config.FORECAST_MONTHS) -> DataFrame:
    """hold out the last ``horizon`` months, forecast them, and report
    MAPE (over months with actual > 0), RMSE and accuracy = 100 - MAPE."""
    ho = holdout(series, horizon)
    k = _key(series)
    train = ho.select(k, "months", "values")
    if method == "sma":
        fc = sma(train, horizon)
    elif method == "holt_winters":
        fc = holt_winters(train, horizon).drop("alpha", "beta", "gamma")
    else:
        fc = forecast_rows(train, horizon).drop("method")
    actual = ho.select(k, F.posexplode("actual").alias("_i", "actual")) \
        .select(k, (F.col("_i") + 1).alias("h"), "actual")
    j = fc.join(actual, [k, "h"])
    err = (F.col("actual") - F.col("forecast")).cast("double")
    ape = F.when(F.col("actual") > 0, F.abs(err) / F.col("actual"))
    r = j.groupBy(k).agg(
        (F.avg(ape) * 100).alias("_mape"),
        F.sqrt(F.avg(err * err)).alias("_rmse"),
        F.count(F.lit(1)).alias("n_months"))
    return r.select(k, F.round("_mape", 2).alias("mape"),
                    F.round("_rmse", 2).alias("rmse"),
                    F.round(F.lit(100.0) - F.col("_mape"), 2).alias("accuracy"), "n_months")
