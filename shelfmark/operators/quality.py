"""The store's constraints as one observed pass per table.

``mark`` gives each row a bitmask of the rules it breaks: value rules are
expressions, foreign keys are left joins with the distinct keys of the small
side.  From there

* ``violations`` counts them: one scan of the table, one aggregate by its key
  (which also finds repeated keys), one row out;
* ``split`` writes the rows once, sound ones and broken ones (with their mask)
  in two partitions of one table, and observes all counts during that write.

A rule on a column that the table doesn't have is left out.  A condition that is
NULL counts as broken, except where the rule itself allows NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfmark.sources.shared import write_shared

# Table -> (rule, column, condition as a SQL expression).
RULES = {
    "products": [
        ("not_null(name)", "product_name", "product_name IS NOT NULL"),
        ("not_null(category)", "category", "category IS NOT NULL"),
        ("check(base_price > 0)", "base_price", "base_price > 0"),
        ("check(cost > 0)", "cost", "cost > 0"),
    ],
    "stores": [
        ("not_null(name)", "store_name", "store_name IS NOT NULL"),
        ("not_null(city)", "city", "city IS NOT NULL"),
        ("not_null(region)", "region", "region IS NOT NULL"),
        ("not_null(tier)", "tier", "tier IS NOT NULL"),
    ],
    "transactions": [
        ("not_null(date)", "date", "date IS NOT NULL"),
        ("check(quantity_sold >= 0)", "quantity", "quantity >= 0"),
        ("check(selling_price > 0)", "selling_price", "selling_price > 0"),
        ("check(base_price > 0)", "base_price", "base_price > 0"),
        ("check(cost > 0)", "cost", "cost > 0"),
        ("check(discount_pct between 0 and 100)", "discount_pct", "discount_pct * 100 >= 0 AND discount_pct * 100 <= 100"),
        ("check(is_promotion in (0,1))", "is_promotion", "is_promotion IN (0, 1)"),
        ("check(is_holiday in (0,1))", "is_holiday", "is_holiday IS NULL OR is_holiday IN (0, 1)"),
        ("check(is_weekend in (0,1))", "is_weekend", "is_weekend IS NULL OR is_weekend IN (0, 1)"),
        ("not_null(product_id)", "product_id", "product_id IS NOT NULL"),
        ("not_null(store_id)", "store_id", "store_id IS NOT NULL"),
    ],
    "inventory": [
        ("check(current_stock >= 0)", "current_stock", "current_stock >= 0"),
        ("check(warehouse_stock >= 0)", "warehouse_stock", "coalesce(warehouse_stock, 0) >= 0"),
        ("not_null(product_id)", "product_id", "product_id IS NOT NULL"),
        ("not_null(store_id)", "store_id", "store_id IS NOT NULL"),
    ],
    "promotions": [
        ("not_null(date)", "date", "date IS NOT NULL"),
        ("check(0 < discount_pct <= 100)", "discount_pct", "discount_pct * 100 > 0 AND discount_pct * 100 <= 100"),
    ],
    "campaigns": [
        ("not_null(product_id)", "product_id", "product_id IS NOT NULL"),
        ("not_null(campaign_type)", "campaign_type", "campaign_type IS NOT NULL"),
        ("check(0 < discount_pct <= 100)", "discount_pct", "discount_pct * 100 > 0 AND discount_pct * 100 <= 100"),
        ("not_null(start_date)", "start_date", "start_date IS NOT NULL"),
        ("not_null(end_date)", "end_date", "end_date IS NOT NULL"),
    ],
}

# (column, dimension, its key)
Foreign = Sequence[tuple[str, DataFrame, str]]


def mark(df: DataFrame, table: str, foreign: Foreign = ()) -> tuple[DataFrame, list[str]]:
    """``df`` with a column ``_broken`` (bit i: rule i is broken) and the names of the rules."""
    checks: list[tuple[str, Column]] = [(name, F.expr(cond)) for name, column, cond in RULES[table] if column in df.columns]
    joined = df
    for i, (column, dim, key) in enumerate(foreign):
        known = dim.select(F.col(key).alias(f"_known{i}")).distinct()
        joined = joined.join(known, F.col(column) == F.col(f"_known{i}"), "left")
        checks.append((f"foreign_key({column})", F.col(column).isNull() | F.col(f"_known{i}").isNotNull()))
    bits = [F.when(F.coalesce(ok, F.lit(False)), F.lit(0)).otherwise(F.lit(1 << i)).cast("bigint") for i, (_, ok) in enumerate(checks)]
    mask = reduce(Column.__add__, bits)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], mask.alias("_broken")), [n for n, _ in checks]


def _bit(i: int) -> Column:
    return F.sum(F.getbit(F.col("_broken"), F.lit(i)).cast("bigint"))


def violations(df: DataFrame, table: str, key: str | None = None, foreign: Foreign = ()) -> DataFrame:
    """(table_name, rule, violations) of one table."""
    marked, names = mark(df, table, foreign)
    counts = [_bit(i).alias(f"_r{i}") for i in range(len(names))]
    if key:
        # Rows of equal keys meet in one group of sums, never as rows.
        groups = marked.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *counts)
        counts = [F.sum(F.when(F.col("_n") > 1, F.col("_n"))).alias("_key"), *[F.sum(f"_r{i}").alias(f"_r{i}") for i in range(len(names))]]
        marked = groups
    rows = ([("_key", f"primary_key({key})")] if key else []) + [(f"_r{i}", n) for i, n in enumerate(names)]
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("violations")) for c, n in rows])
    return (marked.agg(*counts).select(F.inline(pairs))
            .select(F.lit(table).alias("table_name"), "rule", "violations"))


def broken_rules(names: Sequence[str]) -> Column:
    """The names behind ``_broken``, in rule order, joined by ``; ``."""
    return F.array_join(F.filter(F.array(*[F.when(F.getbit(F.col("_broken"), F.lit(i)) == 1, F.lit(n)) for i, n in enumerate(names)]),
                                 lambda x: x.isNotNull()), "; ")


@dataclass
class Split:
    """Sound and broken rows of one write, with what was counted during it."""

    good: DataFrame
    quarantine: DataFrame
    counts: dict[str, int]


def split(df: DataFrame, table: str, foreign: Foreign = ()) -> Split:
    """Write ``df`` once, sound rows apart from broken ones; ``quarantine`` names the rules
    each row breaks, ``counts`` holds ``rows`` and the number of rows per rule."""
    marked, names = mark(df, table, foreign)
    seen = Observation()
    watched = marked.observe(seen, F.count(F.lit(1)).alias("rows"), *[_bit(i).alias(f"r{i}") for i in range(len(names))])
    written = write_shared(watched.withColumn("_sound", F.col("_broken") == 0), f"checked-{table}", ["_sound"])
    counted = seen.get
    return Split(written.filter("_sound").select(*df.columns),
                 written.filter("not _sound").select(*df.columns, broken_rules(names).alias("broken_rules")),
                 {"rows": counted["rows"]} | {n: counted[f"r{i}"] or 0 for i, n in enumerate(names)})
