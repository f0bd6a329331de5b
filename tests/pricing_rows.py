"""Schemas and row builders of the pricing tests."""

from datetime import date
from decimal import Decimal

TXN_SCHEMA = ("transaction_id bigint, date date, product_id bigint, store_id bigint, "
              "quantity bigint, selling_price decimal(12,2), base_price decimal(12,2), "
              "cost decimal(12,2), competitor_price decimal(12,2), is_promotion int, "
              "discount_pct double, revenue decimal(18,2), profit decimal(18,2)")
PRODUCT_SCHEMA = ("product_id bigint, product_name string, category string, "
                  "base_price decimal(12,2), cost decimal(12,2), base_demand double, "
                  "elasticity double")
INVENTORY_SCHEMA = ("product_id bigint, store_id bigint, initial_stock bigint, total_sold bigint, "
                    "replenishment bigint, current_stock bigint, warehouse_stock bigint, "
                    "reorder_level bigint")


def D(x):
    return None if x is None else Decimal(str(x))


def txn_row(tid, pid=1, price=10, qty=1, base=10, cost=5, day=date(2024, 1, 1), store=1,
            disc=0.0, comp=None):
    p = D(price)
    rev = None if p is None else D(price) * qty
    prof = None if p is None or cost is None else (D(price) - D(cost)) * qty
    return (tid, day, pid, store, qty, p, D(base), D(cost), D(comp), int(disc > 0), disc, rev, prof)
