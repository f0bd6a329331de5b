"""Registrations of the store layer: quality pass, campaigns, catalog tables, SQL entry, fractional scenarios."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import oracle as O
from shelfmark.operators import campaigns, markdown, quality
from shelfmark.registry import ORACLE, register
from shelfmark.registry_ops import (CLEAN, _DOMAIN_INPUTS, _M1_BODY, _domain, _sql, campaign_ctes, money_as_double, scenario_ctes)
from shelfmark.sources import catalog, sqlentry
from shelfmark.sources.faults import FAULTS_SQL, with_faults
from shelfmark.sources.model import load_model

# ------------------------------------------------------- observed quality pass
# (rule, condition) in rule order; a condition that is NULL is broken.
_SALE_RULES = [
    ("not_null(date)", "date IS NOT NULL"),
    ("check(quantity_sold >= 0)", "quantity >= 0"),
    ("check(selling_price > 0)", "selling_price > 0"),
    ("check(base_price > 0)", "base_price > 0"),
    ("check(cost > 0)", "cost > 0"),
    ("check(discount_pct between 0 and 100)", "discount_pct * 100 >= 0 AND discount_pct * 100 <= 100"),
    ("check(is_promotion in (0,1))", "is_promotion IN (0, 1)"),
    ("not_null(product_id)", "product_id IS NOT NULL"),
    ("not_null(store_id)", "store_id IS NOT NULL"),
    ("foreign_key(product_id)", "product_id IS NULL OR product_id IN (SELECT product_id FROM products)"),
    ("foreign_key(store_id)", "store_id IS NULL OR store_id IN (SELECT store_id FROM stores)"),
]
_BROKEN = ", ".join(f"CASE WHEN COALESCE({c}, FALSE) THEN NULL ELSE '{n}' END" for n, c in _SALE_RULES)
_CHECKED = f"checked AS (SELECT *, CONCAT_WS('; ', {_BROKEN}) AS broken_rules FROM faulty)"


def _checked(spark: SparkSession, d: str) -> quality.Split:
    m = load_model(spark, d)
    return quality.split(with_faults(m.transactions), "transactions",
                         [("product_id", m.products, "product_id"), ("store_id", m.stores, "store_id")])


@register("t9_quarantine", _sql("""
SELECT transaction_id, date, product_id, store_id, quantity, CAST(selling_price AS DOUBLE) AS selling_price, broken_rules
FROM checked WHERE broken_rules <> ''""", FAULTS_SQL, _CHECKED))
def t9_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """The rows that break a rule, with the rules they break."""
    return money_as_double(_checked(spark, d).quarantine.select(
        "transaction_id", "date", "product_id", "store_id", "quantity", "selling_price", "broken_rules"))


@register("t3_observed", _sql("""
SELECT 'rows' AS rule, COUNT(*) AS rows FROM faulty
UNION ALL """ + "\nUNION ALL ".join(
    f"SELECT '{n}', CAST(COALESCE(SUM(CASE WHEN COALESCE({c}, FALSE) THEN 0 ELSE 1 END), 0) AS BIGINT) FROM faulty"
    for n, c in _SALE_RULES), FAULTS_SQL))
def t3_observed(spark: SparkSession, d: str) -> DataFrame:
    """What the write of the checked table counted on its way."""
    counts = _checked(spark, d).counts
    return spark.createDataFrame(list(counts.items()), "rule string, rows bigint")


# ------------------------------------------------------------------ campaigns
@register("g4_campaigns", _sql("SELECT * FROM campaigns", campaign_ctes("product_id, store_id, promo_type")))
def g4_campaigns(spark: SparkSession, d: str) -> DataFrame:
    return campaigns.campaigns(load_model(spark, d).promotions)


@register("g4_campaign_sales", _sql("""
SELECT c.product_id, c.campaign_type, c.start_date, c.end_date, COUNT(*) AS sales, CAST(SUM(t.quantity) AS BIGINT) AS units,
       CAST(SUM(t.revenue) AS DOUBLE) AS revenue, COUNT(*) FILTER (WHERE t.is_promotion = 1) AS promoted_sales
FROM campaigns c JOIN clean t ON t.product_id = c.product_id AND t.date BETWEEN c.start_date AND c.end_date
GROUP BY ALL""", CLEAN, campaign_ctes("product_id, promo_type")))
def g4_campaign_sales(spark: SparkSession, d: str) -> DataFrame:
    m = load_model(spark, d)
    found = campaigns.campaigns(m.promotions, campaigns.BY_PRODUCT)
    return money_as_double(campaigns.campaign_sales(found, m.clean_transactions))


# -------------------------------------------------------------- catalog tables
@register("s3_changed_partitions", _sql("""
SELECT year, month, COUNT(*) AS sales, CAST(SUM(quantity + CASE WHEN late THEN 1 ELSE 0 END) AS BIGINT) AS units,
       BOOL_OR(late) AS rewritten
FROM (SELECT *, date >= DATE_TRUNC('month', (SELECT MAX(date) FROM clean)) AS late FROM clean) GROUP BY year, month""", CLEAN))
def s3_changed_partitions(spark: SparkSession, d: str) -> DataFrame:
    """The fact as a catalog table whose last month is corrected (one unit more a sale): only that partition is written."""
    sales = load_model(spark, d).clean_transactions
    table = catalog.create(sales, f"sales_{uuid.uuid4().hex}")
    first = F.trunc(sales.agg(F.max("date")).scalar(), "month")
    corrected = sales.withColumn("quantity", F.col("quantity") + F.when(F.col("date") >= first, 1).otherwise(0))
    written = table.replace_changed(corrected)
    months = table.read().groupBy("year", "month").agg(F.count(F.lit(1)).alias("sales"), F.sum("quantity").alias("units"))
    flags = written.withColumn("rewritten", F.lit(True))
    return months.join(flags, ["year", "month"], "left").withColumn("rewritten", F.coalesce("rewritten", F.lit(False)))


@register("s3_bucketed_join", _sql("""
SELECT i.product_id, i.store_id, i.current_stock, COALESCE(s.units, 0) AS units
FROM inventory i LEFT JOIN (SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS units FROM clean GROUP BY product_id) s
  ON i.product_id = s.product_id""", CLEAN))
def s3_bucketed_join(spark: SparkSession, d: str) -> DataFrame:
    """Stock with the product's units sold, over two tables bucketed alike: the aggregate and the join need no shuffle."""
    m = load_model(spark, d)
    sales = catalog.create(m.clean_transactions, f"sales_{uuid.uuid4().hex}").read()
    stock = catalog.create(m.inventory, f"stock_{uuid.uuid4().hex}", keys=()).read()
    sold = sales.groupBy("product_id").agg(F.sum("quantity").alias("units"))
    return (stock.join(sold, "product_id", "left")
            .select("product_id", "store_id", "current_stock", F.coalesce("units", F.lit(0)).alias("units")))


# ------------------------------------------------------------------- SQL entry
# Own statements in the dialect of the store's original database.
STATEMENTS = {
    "q01_overall": """
        SELECT COUNT(DISTINCT transaction_id) AS total_orders, SUM(quantity_sold) AS total_units_sold,
               ROUND(SUM(revenue), 2) AS total_revenue, ROUND(SUM(profit), 2) AS total_profit,
               ROUND(AVG(revenue), 2) AS avg_order_value,
               ROUND(CAST(SUM(profit) AS REAL) / SUM(revenue) * 100, 2) AS overall_margin_pct
        FROM transactions;""",
    "q02_monthly": """
        SELECT strftime('%Y-%m', transaction_date) AS month, ROUND(SUM(revenue), 2) AS monthly_revenue,
               ROUND(SUM(profit), 2) AS monthly_profit, SUM(quantity_sold) AS monthly_units,
               COUNT(DISTINCT transaction_id) AS monthly_orders
        FROM transactions GROUP BY strftime('%Y-%m', transaction_date) ORDER BY month""",
    "q08_discount_bands": """
        SELECT CASE WHEN discount_pct = 0 THEN 'No Discount' WHEN discount_pct <= 10 THEN '1-10%' WHEN discount_pct <= 20 THEN '11-20%'
                    WHEN discount_pct <= 30 THEN '21-30%' ELSE '31%+' END AS discount_band,
               COUNT(*) AS num_transactions, ROUND(CAST(SUM(quantity_sold) AS REAL) / COUNT(quantity_sold), 2) AS avg_units_per_txn,
               ROUND(SUM(revenue), 2) AS total_revenue, ROUND(SUM(profit), 2) AS total_profit, ROUND(AVG(gross_margin), 2) AS avg_margin_pct,
               ROUND(SUM(revenue) / NULLIF(CAST(SUM(discount_pct) AS REAL) / COUNT(discount_pct), 0), 2) AS revenue_per_pct_discount
        FROM transactions GROUP BY discount_band ORDER BY discount_band""",
    "q11_quarterly": """
        SELECT quarter, strftime('%Y', transaction_date) AS year, COUNT(*) AS num_transactions, ROUND(SUM(revenue), 2) AS total_revenue,
               ROUND(SUM(profit), 2) AS total_profit, ROUND(AVG(discount_pct), 2) AS avg_discount
        FROM transactions GROUP BY year, quarter ORDER BY year, quarter""",
}


def _register_statement(name: str, text: str) -> None:
    @register(f"sql_{name}", ORACLE[name])
    def run(spark: SparkSession, d: str) -> DataFrame:
        return money_as_double(sqlentry.sql(spark, load_model(spark, d), text))


for _name, _text in STATEMENTS.items():
    _register_statement(_name, _text)


@register("sql_stores", O.with_model("""
SELECT s.region, strftime(t.transaction_date, '%Y') AS year, t.product_id % 10 AS shelf, COUNT(*) AS sales,
       CAST(SUM(CASE WHEN pr.transaction_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS promoted
FROM t JOIN stores s ON t.store_id = s.store_id
LEFT JOIN (SELECT DISTINCT transaction_id FROM txn WHERE is_promotion = 1) pr ON t.transaction_id = pr.transaction_id
GROUP BY ALL""", store=True))
def sql_stores(spark: SparkSession, d: str) -> DataFrame:
    """Stores and promotions as tables of a user's statement, grouped by bare aliases."""
    return sqlentry.sql(spark, load_model(spark, d), """
        SELECT s.region, strftime('%Y', t.transaction_date) AS year, t.product_id % 10 AS shelf, COUNT(*) AS sales,
               SUM(CASE WHEN pr.transaction_id IS NOT NULL THEN 1 ELSE 0 END) AS promoted
        FROM transactions t JOIN stores s ON t.store_id = s.store_id
        LEFT JOIN (SELECT DISTINCT transaction_id FROM promotions) pr ON t.transaction_id = pr.transaction_id
        GROUP BY region, year, shelf""")


# -------------------------------------------------- scenarios in basis points
_FRACTIONAL = (0.0, 0.125, 0.333, 0.4875)


@register("m1_scenarios_fractional", _sql(_M1_BODY, CLEAN, _DOMAIN_INPUTS, scenario_ctes(_FRACTIONAL)))
def m1_scenarios_fractional(spark: SparkSession, d: str) -> DataFrame:
    m, own = _domain(spark, d)
    return markdown.simulate(m.products, m.inventory, m.clean_transactions, own, discounts=_FRACTIONAL)
