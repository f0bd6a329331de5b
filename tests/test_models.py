import itertools
from datetime import date

import numpy as np
from pyspark.sql import functions as F

from pricing_rows import INVENTORY_SCHEMA, PRODUCT_SCHEMA, txn_row
from shelfmark.functions import exact
from shelfmark.operators import elasticity, forecast, kpi, markdown, optimize, sqlcorpus

SMOKE = "/root/testdata/sf0.001"


def _products(spark, rows):
    rows = [tuple(float(v) if i in (3, 4, 5, 6) else v for i, v in enumerate(r)) for r in rows]
    return spark.createDataFrame(rows, PRODUCT_SCHEMA.replace("decimal(12,2)", "double")) \
        .withColumn("base_price", F.col("base_price").cast("decimal(12,2)")) \
        .withColumn("cost", F.col("cost").cast("decimal(12,2)"))


def test_degenerate_and_min_observations(spark, make_txn):
    rows = [txn_row(i, pid=1, price=10, qty=1 + i % 3) for i in range(30)]        # constant price
    rows += [txn_row(100 + i, pid=2, price=10, qty=4) for i in range(30)]         # constant both
    rows += [txn_row(200 + i, pid=3, price=5 + i, qty=1 + i) for i in range(29)]  # 29 rows
    prods = _products(spark, [(1, "a", "A", 10, 5, 1.0, -1.0), (2, "b", "B", 10, 5, 1.0, -1.0),
                              (3, "c", "C", 10, 5, 1.0, -1.0)])
    out = {r.product_id: r for r in elasticity.product_elasticity(make_txn(rows), prods).collect()}
    assert set(out) == {1, 2}
    assert out[1].elasticity == 0.0 and out[1].r2 == 0.0
    assert out[2].r2 == 1.0 and abs(out[2].intercept - round(np.log(4), 4)) < 1e-9


def test_multifeature_matches_numpy(spark):
    from shelfmark.sources.model import load_model
    m = load_model(spark, SMOKE)
    txn = m.clean_transactions
    got = elasticity.multifeature_elasticity(txn).collect()[0]
    pdf = txn.filter("quantity > 0").select(
        F.ln(F.col("quantity").cast("double")).alias("y"),
        F.ln(F.col("selling_price").cast("double")).alias("x0"),
        F.col("is_promotion").cast("double").alias("x1"),
        F.col("month").cast("double").alias("x2"),
        F.ln(F.col("competitor_price").cast("double")).alias("x3")).dropna().toPandas()
    X = np.column_stack([pdf[c] for c in ("x0", "x1", "x2", "x3")] + [np.ones(len(pdf))])
    beta, *_ = np.linalg.lstsq(X, pdf["y"].to_numpy(), rcond=None)
    resid = pdf["y"].to_numpy() - X @ beta
    r2 = 1 - resid @ resid / ((pdf["y"] - pdf["y"].mean()) ** 2).sum()
    assert got.n_obs == len(pdf)
    for name, b in zip(elasticity.FEATURES + ("intercept",), beta):
        assert abs(got.coefficients[name] - round(b, 4)) <= 1e-4
    assert abs(got.r2 - round(r2, 4)) <= 1e-4


def _hw_run(y, a, b, g, state, period=12):
    """One-step errors and forecasts of the plain recursion from a start state."""
    level, trend, s = state[0], state[1], list(state[2:])
    errors = []
    for v in y:
        s0 = s.pop(0)
        errors.append(v - (level + trend + s0))
        old, level = level, a * (v - s0) + (1 - a) * (level + trend)
        trend = b * (level - old) + (1 - b) * trend
        s.append(g * (v - level) + (1 - g) * s0)
    return np.array(errors), [level + h * trend + s[h - 1] for h in (1, 2, 3)]


def _hw_least_squares(y, a, b, g, period=12):
    """Start state by least squares over the recursion's responses to unit states."""
    k = period + 2
    zero = _hw_run(y, a, b, g, np.zeros(k))[0]
    x = np.stack([zero - _hw_run(y, a, b, g, np.eye(k)[i])[0] for i in range(k)], axis=1)
    return _hw_run(y, a, b, g, np.linalg.lstsq(x, zero, rcond=1e-8)[0])


def test_holt_winters_matches_brute_force(spark):
    from shelfmark.sources.model import load_model
    m = load_model(spark, SMOKE)
    series = forecast.pack_series(forecast.month_spine(
        forecast.monthly_demand(m.clean_transactions, m.products)))
    fc = {(r.category, r.h): r for r in forecast.holt_winters(series).collect()}
    coarse = [p for p in itertools.product((0.0, 0.1, 0.3, 0.9), repeat=3)]
    for row in series.collect():
        y = np.array(row["values"], dtype=float)
        r = fc[(row["category"], 1)]
        errors, preds = _hw_least_squares(y, r.alpha, r.beta, r.gamma)
        # No point of the grid fits better, and forecast and band follow from the fit.
        assert (errors ** 2).sum() <= min((_hw_least_squares(y, *p)[0] ** 2).sum() for p in coarse) * (1 + 1e-6)
        for h, pred in enumerate(preds, start=1):
            r = fc[(row["category"], h)]
            assert abs(r.forecast - max(0, pred)) <= 0.6
            assert abs(r.confidence_upper - (pred + 1.96 * errors.std())) <= 0.6


def test_month_gap_and_short_series(spark, make_txn):
    rows = [txn_row(1, pid=1, qty=5, day=date(2024, 1, 5)), txn_row(2, pid=1, qty=7, day=date(2024, 3, 5))]
    prods = _products(spark, [(1, "a", "A", 10, 5, 1.0, -1.0)])
    spine = forecast.month_spine(forecast.monthly_demand(make_txn(rows), prods))
    assert [r.quantity for r in spine.orderBy("month").collect()] == [5, 0, 7]
    packed = forecast.forecast_all(forecast.pack_series(spine)).collect()[0]
    assert packed.method == "simple_moving_average"
    assert packed.forecast == [4, 4, 4] and packed.dates_forecast == ["2024-04", "2024-05", "2024-06"]
    assert packed.dates_historical == ["2024-01", "2024-02", "2024-03"]


def test_fallbacks_without_stock_or_sales(spark, make_txn):
    prods = _products(spark, [(1, "a", "A", 100, 50, 2.0, -1.5), (2, "b", "A", 100, 50, 3.0, -1.5)])
    inv = spark.createDataFrame([(1, 1, 5, 5, 4, 4, 0, 50)], INVENTORY_SCHEMA)
    txn = make_txn([txn_row(1, pid=1, qty=9, day=date(2024, 4, 1))])
    pe = spark.createDataFrame([], "product_id bigint, product_name string, category string, "
                                   "elasticity double, intercept double, r2 double, n_obs bigint, "
                                   "classification string")
    sim = {(r.product_id, r.discount_pct): r
           for r in markdown.simulate(prods, inv, txn, pe).collect()}
    assert sim[(2, 0.0)].current_stock == 0 and sim[(2, 0.0)].inventory_clearance_pct == 0.0
    assert sim[(2, 0.0)].expected_daily_demand == 3.0            # base_demand fallback
    assert sim[(1, 0.0)].expected_monthly_demand == round(0.1 * 30)
    inp = {r.product_id: r for r in optimize.inputs(prods, inv, txn, pe).collect()}
    assert inp[2].stock == 1.0 and inp[1].stock == 12.0 and inp[2].demand == 3.0
    assert inp[1].elasticity == -1.0                               # config fallback


def test_turnover_not_doubled_by_stores(spark, make_txn):
    prods = _products(spark, [(1, "a", "A", 10, 5, 1.0, -1.0)])
    inv = spark.createDataFrame([(1, 1, 5, 5, 4, 10, 0, 50), (1, 2, 5, 5, 4, 10, 0, 50)], INVENTORY_SCHEMA)
    from shelfmark.operators import clean
    txn = clean.transform(make_txn([txn_row(1, pid=1, price=10, qty=10)]))
    views = sqlcorpus.store_schema(txn, prods, inv)
    q7 = sqlcorpus.run(spark, "q07_turnover", views).collect()
    assert len(q7) == 1 and q7[0].total_sales == 100.0 and q7[0].inventory_turnover == 1.0
    q6 = sqlcorpus.run(spark, "q06_sell_through", views).collect()
    assert len(q6) == 2


def test_stock_rows_meet_products_that_have_their_sales(spark, make_txn):
    """q06_sell_through joins sales to products first, so that no stock row is shuffled with a product's names."""
    from shelfmark.operators import clean
    prods = _products(spark, [(1, "a", "A", 10, 5, 1.0, -1.0), (1, "b", "A", 10, 5, 1.0, -1.0), (2, "c", None, 10, 5, 1.0, -1.0),
                              (3, "no stock", "A", 10, 5, 1.0, -1.0), (None, "no key", "A", 10, 5, 1.0, -1.0)])
    stock = [(1, 1, 5, 5, 4, 10, 20, 50), (1, 2, 5, 5, 4, None, 0, 50), (2, 1, 5, 5, 4, 3, 0, 50), (2, 1, 5, 5, 4, 3, 0, 50),
             (9, 1, 5, 5, 4, 10, 0, 50), (None, 1, 5, 5, 4, 10, 0, 50)]
    inv = spark.createDataFrame(stock, INVENTORY_SCHEMA)
    txn = clean.transform(make_txn([txn_row(1, pid=1, qty=10), txn_row(2, pid=1, qty=5), txn_row(3, pid=9), txn_row(4, pid=None)]))
    q6 = sqlcorpus.run(spark, "q06_sell_through", sqlcorpus.store_schema(txn, prods, inv))
    text = q6._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < text.index("Join Inner") < text.index("Join LeftOuter")
    got = sorted(((r.product_id, r.name, r.total_units_sold, r.total_available, r.sell_through_rate) for r in q6.collect()), key=str)
    assert [(*r[:4], r[4] if r[4] is None else float(r[4])) for r in got] == [
        (1, "a", 15, 30, 33.33), (1, "a", 15, None, None), (1, "b", 15, 30, 33.33), (1, "b", 15, None, None), (2, "c", 0, 3, 0.0), (2, "c", 0, 3, 0.0)]


def test_entry_and_registry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


def test_per_product_series(spark):
    """The same forecasting code serves one series per product."""
    from shelfmark.sources.model import load_model
    m = load_model(spark, SMOKE)
    series = forecast.pack_series(forecast.month_spine(
        forecast.monthly_demand(m.clean_transactions, m.products, key="product_id")))
    assert series.columns[0] == "product_id"
    fc = forecast.forecast_all(series)
    rows = fc.collect()
    assert len(rows) == series.count() > 100
    assert all(len(r.forecast) == 3 and r.method in ("holt_winters", "simple_moving_average")
               for r in rows)
    bt = forecast.backtest(series, "sma")
    assert bt.columns[0] == "product_id" and bt.count() > 0


def test_seasonal_fit_needs_no_python_worker(spark):
    months = [date(2020 + m // 12, m % 12 + 1, 1) for m in range(24)]
    series = spark.createDataFrame([("flat", months, [7] * 24), (None, months, [0] * 24),
                                    ("short", months[:5], [1, 2, 3, 4, 5])],
                                   "category string, months array<date>, values array<bigint>")
    fc = forecast.holt_winters(series)
    plan = fc._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInPandas" not in plan
    # A constant or empty series fits exactly with the smallest parameters.
    assert {(r.category, r.h, r.month, r.forecast, r.confidence_lower, r.confidence_upper, r.alpha)
            for r in fc.collect()} == {(c, h, f"2022-{h:02d}", v, v, v, 0.0)
                                       for c, v in (("flat", 7), (None, 0)) for h in (1, 2, 3)}
    assert forecast.holt_winters(series.limit(0)).collect() == []


def test_ratios_of_large_sums_do_not_overflow(spark):
    """q08_discount_bands (and k11_promo_effect) multiply revenue by a count, together beyond 20 digits."""
    from fractions import Fraction
    n, cents = 3_000, 987_654_321_098_765_431
    sales = spark.range(n).select(
        F.col("id").alias("transaction_id"), F.lit("987654321.98").cast("decimal(12,2)").alias("selling_price"), F.lit(1).cast("bigint").alias("quantity"),
        F.lit("9876543210987654.31").cast("decimal(18,2)").alias("revenue"), F.lit("1.00").cast("decimal(18,2)").alias("profit"),
        F.lit("1.00").cast("decimal(12,2)").alias("cost"), F.lit("2.00").cast("decimal(12,2)").alias("competitor_price"), F.lit(1).alias("is_promotion"),
        (F.lit(1000) + F.col("id") % 7).alias("hundredths"))
    points = sum(1000 + i % 7 for i in range(n))  # hundredths of a percent
    want = float(Fraction(cents * n * n, points))  # no digits behind the point are left in a double
    t = sales.select("*", F.col("quantity").alias("quantity_sold"), (F.col("hundredths") / 100).cast("decimal(7,2)").alias("discount_pct"), F.lit(0.5).alias("gross_margin"))
    bands = {r.discount_band: r for r in sqlcorpus.q08_discount_bands({"t": t}).collect()}
    parts = [[1000 + i % 7 for i in range(n) if (i % 7 > 0) == late] for late in (False, True)]
    for band, part in zip(("1-10%", "11-20%"), parts, strict=True):
        assert bands[band].num_transactions == len(part)
        assert bands[band].revenue_per_pct_discount == float(Fraction(cents * len(part) ** 2, sum(part)))
    effect = kpi.discount_effectiveness(sales.withColumn("discount_pct", F.col("hundredths") / 10_000)).first()
    assert effect.promo_orders == n and effect.promo_revenue == float(Fraction(cents * n, 100)) and effect.revenue_per_discount_pct == want
    # Where both fit, the two divisions agree: ties, signs and a missing divisor too.
    pairs = [("1.00", "8.00"), ("-1.00", "8.00"), ("10.05", "3.00"), ("-2.01", "0.40"), ("0.00", "5.00"), ("7.00", None), (None, "2.00"), ("2.675", "1.00")]
    got = spark.createDataFrame(pairs, "a string, b string").select(*[
        f(F.col("a").cast("decimal(20,4)"), F.col("b").cast("decimal(20,4)"), 2) for f in (exact.dec_div, exact.dec_div_wide)]).collect()
    assert all(r[0] == r[1] for r in got) and got[0][0] == 0.13 and got[1][0] == -0.13
