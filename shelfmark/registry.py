"""Name -> (Spark query, DuckDB oracle SQL) for every implemented operator.

``QUERIES[name](spark, sf_dir)`` returns a lazy DataFrame over the full test
tables in ``sf_dir``; ``ORACLE[name]`` is the same result stated in DuckDB
SQL over the raw tables.  Entries without an oracle are checked against a
brute-force reference on fixtures in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark import oracle as O
from shelfmark.functions.sqltext import half_up_ratio as hr
from shelfmark.operators import sqlcorpus
from shelfmark.sources.model import load_model

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    m = load_model(spark, sf_dir)
    return sqlcorpus.store_schema(m.clean_transactions, m.products, m.inventory)


def _c(x: str) -> str:
    """Exact two-decimal money as BIGINT cents (DuckDB)."""
    return f"CAST(({x}) * 100 AS BIGINT)"


def _pct_avg(x: str) -> str:
    """AVG of a two-decimal percent column, exact half-up 2dp (DuckDB)."""
    return hr(f"SUM(CAST(({x}) * 100 AS BIGINT))", f"(COUNT({x}) * 100)", 2)


m2, avg_money, avg_int = O.m2, O.avg_money, O.avg_int

# ---------------------------------------------------------------- SQL corpus
_CORPUS_ORACLE = {
    "q01_overall": f"""
SELECT COUNT(DISTINCT transaction_id) AS total_orders, CAST(SUM(quantity_sold) AS BIGINT) AS total_units_sold,
       {m2('SUM(revenue)')} AS total_revenue, {m2('SUM(profit)')} AS total_profit,
       {avg_money('revenue')} AS avg_order_value,
       CASE WHEN SUM(revenue) <> 0 THEN {hr(_c('SUM(profit)') + ' * 100', _c('SUM(revenue)'), 2)} END
         AS overall_margin_pct
FROM t""",
    "q02_monthly": f"""
SELECT strftime(transaction_date, '%Y-%m') AS month, {m2('SUM(revenue)')} AS monthly_revenue,
       {m2('SUM(profit)')} AS monthly_profit, CAST(SUM(quantity_sold) AS BIGINT) AS monthly_units,
       COUNT(DISTINCT transaction_id) AS monthly_orders
FROM t GROUP BY 1""",
    "q03_category_revenue": f"""
SELECT p.category, {m2('SUM(t.revenue)')} AS category_revenue, {m2('SUM(t.profit)')} AS category_profit,
       {hr(_c('SUM(t.revenue)') + ' * 100', 'NULLIF(' + _c('(SELECT SUM(revenue) FROM t)') + ', 0)', 2)}
         AS revenue_share_pct
FROM t JOIN p ON t.product_id = p.product_id GROUP BY p.category""",
    "q06_sell_through": f"""
SELECT p.product_id, p.name, p.category, COALESCE(s.total_sold, 0) AS total_units_sold,
       i.current_stock + i.warehouse_stock AS total_available,
       {hr('COALESCE(s.total_sold, 0) * 100', 'NULLIF(COALESCE(s.total_sold, 0) + i.current_stock + i.warehouse_stock, 0)', 2)}
         AS sell_through_rate
FROM p JOIN i ON p.product_id = i.product_id
LEFT JOIN (SELECT product_id, CAST(SUM(quantity_sold) AS BIGINT) AS total_sold FROM t GROUP BY product_id) s
  ON p.product_id = s.product_id""",
    "q07_turnover": f"""
SELECT p.product_id, p.name, p.category, {m2('r.total_sales')} AS total_sales,
       s.stock AS avg_inventory_value,
       {hr(_c('r.total_sales'), 'NULLIF(s.stock * ' + _c('p.cost') + ', 0)', 2)} AS inventory_turnover
FROM (SELECT product_id, SUM(revenue) AS total_sales FROM t GROUP BY product_id) r
JOIN p ON r.product_id = p.product_id
JOIN (SELECT product_id, CAST(SUM(current_stock + warehouse_stock) AS BIGINT) AS stock FROM i GROUP BY product_id) s
  ON p.product_id = s.product_id""",
    "q08_discount_bands": f"""
SELECT CASE WHEN discount_pct = 0 THEN 'No Discount' WHEN discount_pct <= 10 THEN '1-10%'
            WHEN discount_pct <= 20 THEN '11-20%' WHEN discount_pct <= 30 THEN '21-30%'
            ELSE '31%+' END AS discount_band,
       COUNT(*) AS num_transactions, {avg_int('quantity_sold')} AS avg_units_per_txn,
       {m2('SUM(revenue)')} AS total_revenue, {m2('SUM(profit)')} AS total_profit,
       ROUND(AVG(gross_margin), 2) AS avg_margin_pct,
       {hr(_c('SUM(revenue)') + ' * COUNT(discount_pct)', 'NULLIF(SUM(CAST(discount_pct * 100 AS BIGINT)), 0)', 2)}
         AS revenue_per_pct_discount
FROM t GROUP BY 1""",
    "q09_promo_vs_regular": f"""
SELECT CASE WHEN is_promotion = 1 THEN 'Promotion' ELSE 'Regular' END AS sale_type,
       COUNT(*) AS num_transactions, CAST(SUM(quantity_sold) AS BIGINT) AS total_units,
       {m2('SUM(revenue)')} AS total_revenue, {m2('SUM(profit)')} AS total_profit,
       {avg_int('quantity_sold')} AS avg_units_per_txn, {_pct_avg('discount_pct')} AS avg_discount
FROM t GROUP BY is_promotion""",
    "q10_day_of_week": f"""
SELECT day_of_week,
       ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][day_of_week + 1] AS day_name,
       COUNT(*) AS num_transactions, {avg_money('revenue')} AS avg_revenue_per_txn,
       {m2('SUM(revenue)')} AS total_revenue
FROM t GROUP BY day_of_week""",
    "q11_quarterly": f"""
SELECT quarter, strftime(transaction_date, '%Y') AS year, COUNT(*) AS num_transactions,
       {m2('SUM(revenue)')} AS total_revenue, {m2('SUM(profit)')} AS total_profit,
       {_pct_avg('discount_pct')} AS avg_discount
FROM t GROUP BY 2, quarter""",
    "q12_price_quantity": f"""
SELECT p.category, {avg_money('t.selling_price')} AS avg_price,
       {avg_int('t.quantity_sold')} AS avg_quantity, {_pct_avg('t.discount_pct')} AS avg_discount,
       COUNT(*) AS sample_size
FROM t JOIN p ON t.product_id = p.product_id GROUP BY p.category""",
    "q13_competitor_gap": f"""
SELECT p.product_id, p.name, p.category, CAST(p.base_price AS DOUBLE) AS our_base_price,
       {avg_money('t.selling_price')} AS our_avg_selling_price,
       {avg_money('t.competitor_price')} AS avg_competitor_price,
       {hr('(' + _c('SUM(t.selling_price)') + ' - ' + _c('SUM(t.competitor_price)') + ') * 100', 'NULLIF(' + _c('SUM(t.competitor_price)') + ', 0)', 2)}
         AS price_diff_pct
FROM t JOIN p ON t.product_id = p.product_id
WHERE t.competitor_price IS NOT NULL
GROUP BY p.product_id, p.name, p.category, p.base_price""",
    "q14_needs_markdown": f"""
SELECT p.product_id, p.name, p.category, CAST(p.base_price AS DOUBLE) AS base_price,
       i.current_stock + i.warehouse_stock AS total_stock, COALESCE(s.total_sold, 0) AS total_sold,
       {hr('COALESCE(s.total_sold, 0) * 100', 'NULLIF(COALESCE(s.total_sold, 0) + i.current_stock + i.warehouse_stock, 0)', 2)}
         AS sell_through_rate,
       COALESCE({hr('s.sum_disc', 's.n_disc * 100', 2)}, 0.0) AS current_avg_discount
FROM p JOIN i ON p.product_id = i.product_id
LEFT JOIN (SELECT product_id, CAST(SUM(quantity_sold) AS BIGINT) AS total_sold,
                  SUM(CAST(discount_pct * 100 AS BIGINT)) AS sum_disc, COUNT(discount_pct) AS n_disc
           FROM t GROUP BY product_id) s ON p.product_id = s.product_id
WHERE (i.current_stock + i.warehouse_stock) > 100
ORDER BY sell_through_rate ASC NULLS FIRST, p.product_id ASC, i.store_id ASC
LIMIT 20""",
    "v1_product": f"""
SELECT p.product_id, p.name AS product_name, p.category, CAST(p.base_price AS DOUBLE) AS base_price,
       CAST(p.cost AS DOUBLE) AS cost, COUNT(t.transaction_id) AS total_transactions,
       CAST(SUM(t.quantity_sold) AS BIGINT) AS total_units_sold, {m2('SUM(t.revenue)')} AS total_revenue,
       {m2('SUM(t.profit)')} AS total_profit, {avg_money('t.selling_price')} AS avg_selling_price,
       {_pct_avg('t.discount_pct')} AS avg_discount, ROUND(AVG(t.gross_margin), 2) AS avg_margin_pct
FROM p LEFT JOIN t ON p.product_id = t.product_id
GROUP BY p.product_id, p.name, p.category, p.base_price, p.cost""",
    "v2_category": f"""
SELECT p.category, COUNT(DISTINCT p.product_id) AS product_count,
       COUNT(t.transaction_id) AS total_transactions, CAST(SUM(t.quantity_sold) AS BIGINT) AS total_units_sold,
       {m2('SUM(t.revenue)')} AS total_revenue, {m2('SUM(t.profit)')} AS total_profit,
       {_pct_avg('t.discount_pct')} AS avg_discount, ROUND(AVG(t.gross_margin), 2) AS avg_margin_pct
FROM p LEFT JOIN t ON p.product_id = t.product_id GROUP BY p.category""",
    "v3_monthly": f"""
SELECT strftime(transaction_date, '%Y-%m') AS month, COUNT(transaction_id) AS total_orders,
       CAST(SUM(quantity_sold) AS BIGINT) AS total_units, {m2('SUM(revenue)')} AS total_revenue,
       {m2('SUM(profit)')} AS total_profit, {_pct_avg('discount_pct')} AS avg_discount,
       ROUND(AVG(gross_margin), 2) AS avg_margin
FROM t GROUP BY 1""",
    "v4_inventory": f"""
SELECT p.product_id, p.name AS product_name, p.category, i.current_stock, i.warehouse_stock,
       i.current_stock + i.warehouse_stock AS total_stock, COALESCE(sold.total_sold, 0) AS total_sold,
       CASE WHEN i.current_stock + i.warehouse_stock > 0
            THEN {hr('COALESCE(sold.total_sold, 0) * 100', 'i.current_stock + i.warehouse_stock + COALESCE(sold.total_sold, 0)', 2)}
            ELSE 0.0 END AS sell_through_rate
FROM p JOIN i ON p.product_id = i.product_id
LEFT JOIN (SELECT product_id, CAST(SUM(quantity_sold) AS BIGINT) AS total_sold FROM t GROUP BY product_id) sold
  ON p.product_id = sold.product_id""",
}

_PRODUCT_PERF_ORACLE = f"""
SELECT p.product_id, p.name, p.category, CAST(SUM(t.quantity_sold) AS BIGINT) AS total_units,
       {m2('SUM(t.revenue)')} AS total_revenue, {m2('SUM(t.profit)')} AS total_profit,
       ROUND(AVG(t.gross_margin), 2) AS avg_margin
FROM t JOIN p ON t.product_id = p.product_id
GROUP BY p.product_id, p.name, p.category
"""
_CORPUS_ORACLE["q04_top10"] = _PRODUCT_PERF_ORACLE + "ORDER BY total_revenue DESC, product_id ASC LIMIT 10"
_CORPUS_ORACLE["q05_bottom10"] = _PRODUCT_PERF_ORACLE + "ORDER BY total_revenue ASC, product_id ASC LIMIT 10"


def _corpus_query(name: str) -> QueryFn:
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return sqlcorpus.run(spark, name, _views(spark, sf_dir))
    fn.__name__ = name
    return fn


for _name in sqlcorpus.Q:
    register(_name, O.with_model(_CORPUS_ORACLE[_name], store=True))(_corpus_query(_name))


def _load_rest() -> None:
    # Registration side effects of the other query groups.
    from shelfmark import registry_ops, registry_store  # noqa: F401


_load_rest()


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
