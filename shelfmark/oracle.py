"""DuckDB oracle SQL for the registered queries.

Each statement rebuilds the canonical model from the raw test tables with the
same deterministic expressions as ``sources.model`` and then states the
operator in plain SQL.  DuckDB divides decimals in DOUBLE, so every rounded
ratio here is computed with exact integer half-up rounding (``hr``).
"""

from __future__ import annotations

from shelfmark import config
from shelfmark.functions.sqltext import half_up_ratio as hr

_ELAS = " ".join(f"WHEN '{k}' THEN {v}" for k, v in config.CATEGORY_ELASTICITY.items())
_HOL = ", ".join(f"'{d}'" for d in config.HOLIDAYS)


def _cents(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DOUBLE) * 100) AS BIGINT)"


def _dhu(num: str, den: str) -> str:
    """round(num / den) half away from zero, integer result (as DOUBLE)."""
    return f"(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END * FLOOR((ABS({num}) * 2 + ({den})) / (({den}) * 2)))"


MODEL = f"""
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(12,2)) AS base_price,
         CAST(ROUND(CAST(p_retailprice AS DECIMAL(12,2)) * (0.35 + 0.05 * (p_partkey % 7)), 2) AS DECIMAL(12,2)) AS cost,
         (p_size + 10) / CAST(90 AS DOUBLE) AS base_demand,
         CAST(COALESCE(CASE p_type {_ELAS} END, {config.DEFAULT_ELASTICITY}) AS DOUBLE) AS elasticity
  FROM part),
stores AS (
  SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS city, r_name AS region,
         CAST(s_suppkey % 2 + 1 AS INTEGER) AS tier
  FROM supplier LEFT JOIN (nation LEFT JOIN region ON n_regionkey = r_regionkey)
       ON s_nationkey = n_nationkey),
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount, l_shipdate,
         CAST(l_quantity AS BIGINT) AS qty,
         CASE WHEN CAST(l_quantity AS BIGINT) > 0 THEN
           CAST(CAST({_dhu(_cents('l_extendedprice'), 'CAST(l_quantity AS BIGINT)')} AS DECIMAL(18,0)) * 0.01
                AS DECIMAL(12,2)) END AS base_price
  FROM lineitem),
raw_txn AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS transaction_id,
         CAST(l.l_shipdate AS DATE) AS date,
         l.l_partkey AS product_id, l.l_suppkey AS store_id, l.qty AS quantity,
         CAST(ROUND(l.base_price * (1 - CAST(l.l_discount AS DECIMAL(3,2))), 2) AS DECIMAL(12,2)) AS selling_price,
         l.base_price, p.cost,
         CAST(ROUND(p.base_price * (0.85 + 0.03 * (l.l_suppkey % 11)), 2) AS DECIMAL(12,2)) AS competitor_price,
         CAST(l.l_discount > 0 AS INTEGER) AS is_promotion,
         l.l_discount AS discount_pct
  FROM lines l LEFT JOIN products p ON l.l_partkey = p.product_id),
txn AS (
  SELECT transaction_id, date, product_id, store_id, quantity, selling_price, base_price, cost,
         competitor_price, is_promotion, discount_pct,
         CAST(selling_price * quantity AS DECIMAL(18,2)) AS revenue,
         CAST((selling_price - cost) * quantity AS DECIMAL(18,2)) AS profit
  FROM raw_txn),
inventory AS (
  SELECT s.product_id, s.store_id,
         CAST((s.product_id + s.store_id) % 4 + 1 AS BIGINT) AS initial_stock,
         s.total_sold,
         CAST(FLOOR(s.total_sold * 95 / CAST(100 AS DOUBLE)) AS BIGINT) AS replenishment,
         CAST(GREATEST(0, (s.product_id + s.store_id) % 4 + 1 - s.total_sold
                          + FLOOR(s.total_sold * 95 / CAST(100 AS DOUBLE))) AS BIGINT) AS current_stock,
         CAST(pt.p_size * 10 AS BIGINT) AS warehouse_stock,
         CAST(50 AS BIGINT) AS reorder_level
  FROM (SELECT l_partkey AS product_id, l_suppkey AS store_id,
               CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_sold
        FROM lineitem GROUP BY l_partkey, l_suppkey) s
  LEFT JOIN part pt ON s.product_id = pt.p_partkey)
"""


def clean_sql(source: str) -> str:
    """T1 -> T5 over the CTE ``source``; defines CTE ``clean``."""
    return f"""
dedup AS (SELECT DISTINCT * FROM {source}),
imputed AS (
  SELECT * REPLACE (COALESCE(selling_price,
           CAST(CAST(FLOOR(MEDIAN(CAST(selling_price * 100 AS BIGINT)) OVER (PARTITION BY product_id) + 0.5)
                     AS DECIMAL(18,0)) * 0.01 AS DECIMAL(12,2)))
         AS selling_price)
  FROM dedup),
valid AS (SELECT * FROM imputed WHERE selling_price > 0 AND quantity >= 0),
c1 AS (
  SELECT *, CAST(ROUND(selling_price * quantity, 2) AS DECIMAL(18,2)) AS revenue2,
         CAST(ROUND((selling_price - cost) * quantity, 2) AS DECIMAL(18,2)) AS profit2,
         {_cents('base_price')} AS bc, {_cents('selling_price')} AS sc, {_cents('cost')} AS cc
  FROM valid),
c2 AS (SELECT *, {_cents('revenue2')} AS rc FROM c1),
clean AS (
  SELECT transaction_id, date, product_id, store_id, quantity, selling_price, base_price, cost,
         competitor_price, is_promotion,
         CASE WHEN bc > 0 THEN {hr('GREATEST(bc - sc, 0)', 'bc', 4)} END AS discount_pct,
         revenue2 AS revenue, profit2 AS profit,
         CASE WHEN revenue2 > 0 THEN {hr('rc - cc * quantity', 'rc', 4)}
              WHEN revenue2 IS NOT NULL THEN 0.0 END AS gross_margin,
         CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter,
         CAST(year(date) AS INTEGER) AS year, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
         CAST(isodow(date) - 1 IN (5, 6) AS INTEGER) AS is_weekend,
         CAST(strftime(date, '%Y-%m-%d') IN ({_HOL}) AS INTEGER) AS is_holiday
  FROM c2)
"""


STORE = """
t AS (
  SELECT transaction_id, date AS transaction_date, product_id, store_id, quantity AS quantity_sold,
         selling_price, base_price, cost,
         CAST(ROUND(discount_pct * 100, 2) AS DECIMAL(7,2)) AS discount_pct,
         revenue, profit,
         CASE WHEN CAST(selling_price AS DOUBLE) > 0
              THEN (CAST(selling_price AS DOUBLE) - CAST(cost AS DOUBLE)) / CAST(selling_price AS DOUBLE) * 100
              ELSE 0.0 END AS gross_margin,
         is_promotion, is_holiday, is_weekend, day_of_week, month, quarter, competitor_price
  FROM clean),
p AS (SELECT product_id, product_name AS name, category, base_price, cost FROM products),
i AS (SELECT product_id, store_id, current_stock, warehouse_stock, reorder_level FROM inventory)
"""


def with_model(body: str, clean: bool = True, store: bool = False) -> str:
    ctes = MODEL.strip()
    if clean or store:
        ctes += ",\n" + clean_sql("txn").strip()
    if store:
        ctes += ",\n" + STORE.strip()
    return f"WITH\n{ctes}\n{body}"


def m2(x: str) -> str:
    """Exact money rounded to cents, as DOUBLE."""
    return f"CAST(ROUND({x}, 2) AS DOUBLE)"


def avg_money(x: str) -> str:
    """AVG of a two-decimal column, exact half-up to 2dp."""
    return hr(f"SUM({x} * 100)", f"(COUNT({x}) * 100)", 2)


def avg_int(x: str) -> str:
    return hr(f"SUM({x})", f"COUNT({x})", 2)
