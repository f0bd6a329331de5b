"""Canonical retail star schema derived from the TPC-H-like test tables.

Mapping (all expressions deterministic, so the DuckDB oracle can rebuild them):

* products     <- part: product_id=p_partkey, product_name=p_name,
                  category=p_type, base_price=p_retailprice,
                  cost=round(base_price * (0.35 + 0.05 * (p_partkey % 7)), 2),
                  base_demand=(10 + p_size) / 90, elasticity by category.
* stores       <- supplier x nation x region (city, region, tier).
* transactions <- lineitem x part: one line item is one sale; unit list price
                  is extendedprice / quantity rounded to cents, the selling
                  price applies l_discount and is rounded to cents; cost and
                  competitor price come from the part.
* inventory    <- one row per (product, store) seen in lineitem, with the
                  ledger law current = max(0, initial - sold + replenishment).
* promotions   <- the discounted transactions.

Money columns are DECIMAL (exact sums); everything else keeps the pricing
engine's names and meaning (discount_pct is a fraction 0..1).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import config
from shelfmark.functions.exact import MONEY, cents, div_half_up, from_cents
from shelfmark.session import bound_tasks
from shelfmark.sources.shared import keep, stored_bytes
from shelfmark.sources.tables import read_table, table_path

TRANSACTION_COLUMNS = (
    "transaction_id", "date", "product_id", "store_id", "quantity", "selling_price",
    "base_price", "cost", "competitor_price", "is_promotion", "discount_pct",
    "revenue", "profit",
)


def category_elasticity(category: Column, configured: dict[str, float] | None = None) -> Column:
    """Configured elasticity for a category, default -1.0 when unknown."""
    known = config.CATEGORY_ELASTICITY if configured is None else configured
    if not known:
        return F.lit(config.DEFAULT_ELASTICITY)
    lookup = F.create_map(*[x for k, v in known.items() for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(lookup[category], F.lit(config.DEFAULT_ELASTICITY))


def _cost_cents(list_c: Column, partkey: Column) -> Column:
    """round(list * (0.35 + 0.05 * (partkey % 7)), 2) in integer cents."""
    return div_half_up(list_c * (F.lit(35) + F.lit(5) * (partkey % 7)), F.lit(100))


def products_from_part(part: DataFrame) -> DataFrame:
    list_c = cents(F.col("p_retailprice"))
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        from_cents(list_c).alias("base_price"),
        from_cents(_cost_cents(list_c, F.col("p_partkey"))).alias("cost"),
        ((F.col("p_size") + 10) / F.lit(90.0)).alias("base_demand"),
        category_elasticity(F.col("p_type")).alias("elasticity"),
    )


def stores_from_suppliers(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return (supplier.join(geo, supplier.s_nationkey == geo.n_nationkey, "left")
            .select(F.col("s_suppkey").alias("store_id"),
                    F.col("s_name").alias("store_name"),
                    F.col("n_name").alias("city"),
                    F.col("r_name").alias("region"),
                    (F.col("s_suppkey") % 2 + 1).cast("int").alias("tier")))


def sale_lines(lineitem: DataFrame) -> DataFrame:
    """The independent columns of a sale; price, cost and profit columns follow
    from these and the part, so two sales are equal where these are equal."""
    qty = F.col("l_quantity").cast("bigint")
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        qty.alias("quantity"),
        F.when(qty > 0, div_half_up(cents(F.col("l_extendedprice")), qty)).alias("base_c"),
        F.col("l_discount").alias("discount_pct"),
    )


def transactions_from_lines(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """One sale per line item (see ``sales``)."""
    return sales(sale_lines(lineitem), part)


def sales(lines: DataFrame, part: DataFrame) -> DataFrame:
    """Sales with all derived columns from ``sale_lines``.

    Joins part once for cost and competitor price; AQE broadcasts part when
    its runtime size is under the threshold and sort-merges otherwise.  Prices
    are derived in integer cents in small staged projections (long arithmetic
    inside whole-stage codegen) and become DECIMAL once at the end.
    """
    list_c = cents(F.col("p_retailprice"))
    p = part.select(F.col("p_partkey"), list_c.alias("list_c"),
                    _cost_cents(list_c, F.col("p_partkey")).alias("cost_c"))
    stage1 = lines.join(p, lines.product_id == p.p_partkey, "left").select(
        *lines.columns, "list_c", "cost_c",
        cents(F.col("discount_pct")).alias("disc_pp"),
        (F.col("discount_pct") > 0).cast("int").alias("is_promotion"),
    )
    sell_c = div_half_up(F.col("base_c") * (F.lit(100) - F.col("disc_pp")), F.lit(100))
    comp_c = div_half_up(F.col("list_c") * (F.lit(85) + F.lit(3) * (F.col("store_id") % 11)),
                         F.lit(100))
    stage2 = stage1.select("*", sell_c.alias("sell_c"), comp_c.alias("comp_c"))
    return stage2.select(
        "transaction_id", "date", "product_id", "store_id", "quantity",
        from_cents(F.col("sell_c")).alias("selling_price"),
        from_cents(F.col("base_c")).alias("base_price"),
        from_cents(F.col("cost_c")).alias("cost"),
        from_cents(F.col("comp_c")).alias("competitor_price"),
        "is_promotion", "discount_pct",
        from_cents(F.col("sell_c") * F.col("quantity"), MONEY).alias("revenue"),
        from_cents((F.col("sell_c") - F.col("cost_c")) * F.col("quantity"), MONEY).alias("profit"),
    )


def inventory_from_lines(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Stock ledger per (product, store): partial aggregation map-side, one
    shuffle on the pair key, then a join to part for the warehouse size."""
    sold = (lineitem.groupBy("l_partkey", "l_suppkey")
            .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total_sold")))
    initial = ((F.col("l_partkey") + F.col("l_suppkey")) % 4 + 1).cast("bigint")
    repl = F.floor(F.col("total_sold") * 95 / F.lit(100.0)).cast("bigint")
    current = F.greatest(F.lit(0).cast("bigint"), initial - F.col("total_sold") + repl)
    sizes = part.select("p_partkey", "p_size")
    return (sold.join(sizes, sold.l_partkey == sizes.p_partkey, "left")
            .select(F.col("l_partkey").alias("product_id"),
                    F.col("l_suppkey").alias("store_id"),
                    initial.alias("initial_stock"),
                    F.col("total_sold"),
                    repl.alias("replenishment"),
                    current.alias("current_stock"),
                    (F.col("p_size") * 10).cast("bigint").alias("warehouse_stock"),
                    F.lit(50).cast("bigint").alias("reorder_level")))


def promotions_from_transactions(txn: DataFrame) -> DataFrame:
    types = F.array(*[F.lit(t) for t in config.PROMO_TYPES])
    orderkey = F.floor(F.col("transaction_id") / 10).cast("bigint")
    return (txn.filter(F.col("is_promotion") == 1)
            .select(F.col("transaction_id").alias("promo_id"), "transaction_id",
                    "product_id", "store_id", "date", "discount_pct",
                    F.element_at(types, (F.pmod(orderkey, F.lit(4)) + 1).cast("int"))
                    .alias("promo_type")))


@dataclass
class RetailModel:
    """Lazy bundle of the canonical tables for one data directory."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict, repr=False)

    def _get(self, key, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    def _read(self, name, cols):
        return read_table(self.spark, self.sf_dir, name, cols)

    @property
    def lineitem(self) -> DataFrame:
        return self._read("lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                       "l_quantity", "l_extendedprice", "l_discount",
                                       "l_shipdate"])

    @property
    def part(self) -> DataFrame:
        return self._read("part", ["p_partkey", "p_name", "p_type", "p_size", "p_retailprice"])

    @property
    def products(self) -> DataFrame:
        return self._get("products", lambda: products_from_part(self.part))

    @property
    def stores(self) -> DataFrame:
        return self._get("stores", lambda: stores_from_suppliers(
            self._read("supplier", ["s_suppkey", "s_name", "s_nationkey"]),
            self._read("nation", ["n_nationkey", "n_name", "n_regionkey"]),
            self._read("region", ["r_regionkey", "r_name"])))

    @property
    def transactions(self) -> DataFrame:
        return self._get("transactions", lambda: transactions_from_lines(self.lineitem, self.part))

    @property
    def inventory(self) -> DataFrame:
        return self._get("inventory", lambda: inventory_from_lines(self.lineitem, self.part))

    @property
    def promotions(self) -> DataFrame:
        return self._get("promotions", lambda: promotions_from_transactions(self.transactions))

    @property
    def clean_transactions(self) -> DataFrame:
        """The cleaned fact table, written once per application to the shared
        folder (by year, so that date windows prune) and read by every query;
        it is rebuilt from all rows when an input file changes."""
        from shelfmark.operators import clean

        def build() -> DataFrame:
            # Duplicates are found on the seven independent columns, before the
            # part join widens the rows.  A product's sales then go to the same
            # files (a hot product's to several), so that sums per product
            # shrink before they are shuffled.
            lines = clean.deduplicate(sale_lines(self.lineitem)).hint("rebalance", "product_id")
            return clean.write_clean(sales(lines, self.part))

        paths = [table_path(self.sf_dir, t) for t in ("lineitem", "part")]
        return self._get("clean", lambda: keep(self.spark, f"clean {self.sf_dir}", paths, build))

    @property
    def cleaning(self) -> dict[str, int]:
        """Rows checked and removed (T3), as observed while the cleaned table was written."""
        return self.clean_transactions._cleaning


def load_model(spark: SparkSession, sf_dir: str) -> RetailModel:
    bound_tasks(spark, stored_bytes(spark, table_path(sf_dir, "lineitem")))
    return RetailModel(spark, sf_dir)
