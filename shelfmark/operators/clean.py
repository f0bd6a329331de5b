"""Cleaning and enrichment of the transaction fact table.

The chain is dedup -> impute -> validate -> computed columns -> time features,
the same order the pricing engine applies.  Every step is a DataFrame
transformation; none of them collects data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfmark import config
from shelfmark.functions.calendar import add_time_features
from shelfmark.functions.exact import MONEY, cents, from_cents, ratio_round
from shelfmark.sources.shared import SHARED_CODEC, write_shared

#: The columns of T4 (``add_computed_columns``).
COMPUTED = ("revenue", "profit", "discount_pct", "gross_margin")


def deduplicate(df: DataFrame) -> DataFrame:
    """Drop rows identical in every column.

    ``dropDuplicates()`` is a hash aggregate on all columns with a map-side
    partial step, so a block of identical copies (however hot) collapses to one
    row per map task before the shuffle.
    """
    return df.dropDuplicates()


def exact_median(df: DataFrame, key: str, value: str, out: str = "median") -> DataFrame:
    """Exact per-key median of non-null ``value``.

    Counts per (key, value) first (partial aggregation), then finds the two
    middle positions from counts of smaller values.  Those counts come from a
    range partitioning on (key, value), so a key holding a third of all rows,
    with however many distinct values, is spread over several tasks."""
    from shelfmark.functions.ranking import counts_below
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(key, value).agg(F.count(F.lit(1)).alias("_c")))
    walked = counts_below(counts, key, value)
    hi = F.col("_less") + F.col("_c")
    # 1-based positions of the two middle elements.
    p1 = F.floor((F.col("_tot") + 1) / 2)
    p2 = F.ceil((F.col("_tot") + 1) / 2)
    hit1 = (F.col("_less") < p1) & (p1 <= hi)
    hit2 = (F.col("_less") < p2) & (p2 <= hi)
    picked = walked.filter(hit1 | hit2).select(
        key,
        F.when(hit1, F.col(value)).alias("_v1"),
        F.when(hit2, F.col(value)).alias("_v2"))
    # Decimal inputs stay exact (the mean of two cents values has 3 decimals).
    return picked.groupBy(key).agg(((F.max("_v1") + F.max("_v2")) / 2).alias(out))


def fill_missing_prices(txn: DataFrame) -> DataFrame:
    """A null selling_price takes its product's exact median price.

    Only rows with a null price are joined to the medians, and medians are only
    computed for products that have a null price; rows with a price pass
    through without a shuffle.  A product with no price at all stays null.
    """
    has_price = txn.filter(F.col("selling_price").isNotNull())
    missing = txn.filter(F.col("selling_price").isNull())
    return has_price.unionByName(with_medians(missing, has_price))


def with_medians(missing: DataFrame, has_price: DataFrame) -> DataFrame:
    """Rows without a price with their product's median (T2) over the rows with one."""
    price_type = missing.schema["selling_price"].dataType.simpleString()
    needing = missing.select("product_id").distinct()
    medians = exact_median(has_price.join(needing, "product_id", "left_semi"),
                           "product_id", "selling_price", "_median")
    return (missing.join(medians, "product_id", "left")
            .withColumn("selling_price",
                        F.round(F.col("_median"), 2).cast(price_type))
            .drop("_median")
            .select(*missing.columns))


def _valid() -> Column:
    return F.coalesce((F.col("selling_price") > 0) & (F.col("quantity") >= 0), F.lit(False))


def validate(txn: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Keep price > 0 and quantity >= 0 (a null price fails).

    Pass an ``Observation`` to get kept/removed counts after the first action
    without a second pass over the data.
    """
    ok = _valid()
    if observation is not None:
        txn = txn.observe(observation,
                          F.count(F.lit(1)).alias("rows_in"),
                          F.sum(F.when(ok, 0).otherwise(1)).alias("rows_removed"))
    return txn.filter(ok)


def add_computed_columns(txn: DataFrame) -> DataFrame:
    """T4: revenue, profit, discount_pct (fraction, clipped at 0, 4dp) and
    gross_margin ((revenue - cost*qty) / revenue, 4dp, 0 when revenue <= 0).

    Computed on integer cents: products of two-decimal prices and integer
    units are exact, and the two ratios round half up from exact integers,
    so ties round the same on every engine.
    """
    qty = F.col("quantity")
    staged = txn.select("*", cents(F.col("selling_price")).alias("_sc"),
                        cents(F.col("base_price")).alias("_bc"),
                        cents(F.col("cost")).alias("_cc"))
    staged = staged.select("*", (F.col("_sc") * qty).alias("_rc"))
    discount = F.when(F.col("_bc") > 0, ratio_round(
        F.greatest(F.col("_bc") - F.col("_sc"), F.lit(0).cast("bigint")), F.col("_bc"), 4))
    gross_margin = (F.when(F.col("_rc") > 0,
                           ratio_round(F.col("_rc") - F.col("_cc") * qty, F.col("_rc"), 4))
                    .when(F.col("_rc").isNotNull(), F.lit(0.0)))
    return (staged.withColumns({
        "revenue": from_cents(F.col("_rc"), MONEY),
        "profit": from_cents((F.col("_sc") - F.col("_cc")) * qty, MONEY),
        "discount_pct": discount,
        "gross_margin": gross_margin,
    }).drop("_sc", "_bc", "_cc", "_rc"))


def after_dedup(distinct: DataFrame, observation: Observation | None = None) -> DataFrame:
    """T2 -> T5 over deduplicated rows, best a written table: T2 reads it in
    several branches, and those on rows without a price prune by the files'
    null counts."""
    return (fill_missing_prices(distinct).transform(lambda x: validate(x, observation))
            .transform(add_computed_columns)
            .transform(add_time_features))


def transform(txn: DataFrame, observation: Observation | None = None) -> DataFrame:
    """The fixed cleaning chain T1 -> T2 -> T3 -> T4 -> T5; the deduplicated
    rows are written once to the shared folder."""
    return after_dedup(write_shared(deduplicate(txn), "dedup"), observation)


clean_transactions = transform


def write_clean(distinct: DataFrame) -> DataFrame:
    """T2 -> T5 over deduplicated rows, as a table by year that is written once.

    One pass writes all rows, apart by state: ``sound``, ``broken`` (T3 removes
    them) and ``unpriced``.  Only where there are rows without a price are the
    medians taken, from all rows with one, and the filled rows that pass T3 are
    added to the sound ones.  The columns of T4 follow from others of the row and
    were a third of its bytes: they are not stored, but computed where the table is read.
    ``_cleaning`` of the result holds ``rows_in`` and ``rows_removed``."""
    spark, seen, state = distinct.sparkSession, Observation(), F.col("_state")
    marked = distinct.withColumn("_state", F.when(F.col("selling_price").isNull(), "unpriced")
                                 .when(_valid(), "sound").otherwise("broken"))
    full = marked.transform(add_computed_columns).transform(add_time_features)
    made = (marked.drop(*COMPUTED).transform(add_time_features)
            .observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(state == "broken").alias("broken"),
                     F.count_if(state == "unpriced").alias("unpriced")))
    table = write_shared(made, "clean", ["_state", "year"])
    path, counts = table._shared_path, seen.get
    removed = counts["broken"]
    if counts["unpriced"]:
        added = Observation()
        filled = with_medians(table.filter(state == "unpriced"), table.filter(state != "unpriced"))
        (filled.transform(lambda x: validate(x, added)).transform(add_time_features)
         .withColumn("_state", F.lit("sound")).select(*made.columns)
         .write.mode("append").option("compression", SHARED_CODEC).partitionBy("_state", "year").parquet(path))
        removed += added.get["rows_removed"]
    out = (spark.read.schema(made.schema).parquet(path).filter(state == "sound")
           .transform(add_computed_columns).select(*[c for c in full.columns if c != "_state"]))
    out._shared_path, out._cleaning = path, {"rows_in": counts["rows_in"], "rows_removed": removed}
    return out


def generated_columns(txn: DataFrame) -> DataFrame:
    """The store-schema generated columns: revenue, profit and
    gross_margin as a percent of selling price (0 when price <= 0)."""
    sell = F.col("selling_price").cast("double")
    cost = F.col("cost").cast("double")
    return (txn.withColumn("revenue", (F.col("selling_price") * F.col("quantity")).cast(MONEY))
            .withColumn("profit", ((F.col("selling_price") - F.col("cost")) * F.col("quantity")).cast(MONEY))
            .withColumn("gross_margin",
                        F.when(sell > 0, (sell - cost) / sell * 100).otherwise(F.lit(0.0))))


def constraint_violations(transactions: DataFrame, products: DataFrame, stores: DataFrame, inventory: DataFrame,
                          promotions: DataFrame | None = None, campaigns: DataFrame | None = None) -> DataFrame:
    """One row per (table, rule) with the number of violating rows; one scan per
    table, with its value rules, foreign keys and repeated keys in one aggregate."""
    from shelfmark.operators.quality import violations
    product, store = ("product_id", products, "product_id"), ("store_id", stores, "store_id")
    parts = [
        violations(products, "products", "product_id"),
        violations(stores, "stores", "store_id"),
        violations(transactions, "transactions", "transaction_id", [product, store]),
        violations(inventory, "inventory", None, [product, store]),
    ]
    if promotions is not None:
        parts.append(violations(promotions, "promotions", "promo_id", [product]))
    if campaigns is not None:
        parts.append(violations(campaigns, "campaigns", None, [product]))
    return reduce(DataFrame.unionByName, parts)


def positive_complete(df: DataFrame, features: list[str]) -> DataFrame:
    """Quantity > 0, then drop rows with a null in any feature."""
    return df.filter(F.col("quantity") > 0).dropna(subset=features)


def recent_window(txn: DataFrame, days: int = config.RECENT_DAYS) -> DataFrame:
    """Rows on or after max(date) - days (inclusive: days + 1 calendar days).

    The max is an uncorrelated scalar subquery, evaluated once and inlined as
    a literal.  A table partitioned by year is also filtered on that column,
    so that earlier years are not listed or read.
    """
    first = F.date_sub(txn.agg(F.max("date")).scalar(), days)
    recent = txn.filter(F.col("date") >= first)
    return recent.filter(F.col("year") >= F.year(first)) if "year" in txn.columns else recent
