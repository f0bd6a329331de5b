"""Invariants over whole-table results (sf0.01)."""

from pyspark.sql import functions as F

from shelfmark.registry import QUERIES

DATA = "/root/testdata/sf0.01"


def test_category_shares_sum_to_100(spark):
    rows = QUERIES["d04_share"](spark, DATA).collect()
    assert abs(sum(r.share_pct for r in rows) - 100.0) < 0.05
    q3 = QUERIES["q03_category_revenue"](spark, DATA).collect()
    assert abs(sum(r.revenue_share_pct for r in q3) - 100.0) < 0.05


def test_revenue_reconciles_across_grains(spark):
    total = QUERIES["k01_overview"](spark, DATA).collect()[0].total_revenue
    by_cat = sum(r.total_revenue for r in QUERIES["k10_category"](spark, DATA).collect())
    by_month = sum(r.revenue for r in QUERIES["k12_monthly"](spark, DATA).collect())
    promo = QUERIES["k11_promo_effect"](spark, DATA).collect()[0]
    for v in (by_cat, by_month, promo.promo_revenue + promo.non_promo_revenue):
        assert abs(v - total) < 0.01 * 100


def test_units_monotone_in_discount(spark):
    sim = QUERIES["m1_scenarios"](spark, DATA)
    bad = (sim.groupBy("product_id")
           .agg(F.sort_array(F.collect_list(F.struct("discount_pct", "expected_daily_demand")))
                .alias("s"))
           .filter(F.exists(F.sequence(F.lit(1), F.size("s") - 1),
                            lambda i: F.element_at("s", i + 1)["expected_daily_demand"]
                            < F.element_at("s", i)["expected_daily_demand"])))
    assert bad.count() == 0          # every resolved elasticity here is negative


def test_forecast_band_ordering(spark):
    for name in ("f3_holt_winters", "f4_sma"):
        rows = QUERIES[name](spark, DATA).collect()
        assert rows and all(r.confidence_lower <= r.forecast <= r.confidence_upper for r in rows)


def test_ledger_law_holds(spark):
    assert QUERIES["g5_ledger"](spark, DATA).filter(~F.col("ledger_ok")).count() == 0


def test_recommendations_cover_every_product_once(spark):
    recs = QUERIES["o8_recommendations"](spark, DATA)
    assert recs.count() == recs.select("product_id").distinct().count() == 2000
    assert recs.filter((F.col("priority_score") < 0) | (F.col("priority_score") > 1)).count() == 0
