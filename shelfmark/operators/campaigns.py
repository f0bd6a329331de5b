"""Promotions as campaigns with a start and an end (G4), and the sales made while they run.

A campaign is a run of promoted sales of one key (product, store, type or
product, type) in which no two neighbouring days are more than ``gap_days``
apart.  Promoted sales are reduced to one row per key and day before any window,
so that a window holds at most one row per calendar day, however hot its key.

Sales meet campaigns by an interval join: a campaign is listed once for every
date bucket it touches, sales are summed per product, store and day first and
carry the bucket of their day, and the join is an equality on (key, bucket) plus
the two date bounds.  Nothing is paired that does not share a key and a bucket.

Defined results: sales without a date belong to no campaign; null keys group like
any value in campaigns and match no sale; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BY_STORE = ("product_id", "store_id", "promo_type")
BY_PRODUCT = ("product_id", "promo_type")


def campaigns(promotions: DataFrame, keys: Sequence[str] = BY_STORE, gap_days: int = 30) -> DataFrame:
    """One row per campaign: its keys, start_date, end_date, n_sales, n_days and the largest discount_pct."""
    daily = (promotions.filter(F.col("date").isNotNull()).groupBy(*keys, "date")
             .agg(F.count(F.lit(1)).alias("_n"), F.max("discount_pct").alias("_d")))
    order = Window.partitionBy(*keys).orderBy("date")
    before = F.lag("date").over(order)
    opens = F.when(before.isNull() | (F.datediff("date", before) > gap_days), 1).otherwise(0)
    islands = daily.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(order))
    return (islands.groupBy(*keys, "_island")
            .agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"), F.sum("_n").alias("n_sales"),
                 F.count(F.lit(1)).alias("n_days"), F.max("_d").alias("discount_pct"))
            .drop("_island").withColumnRenamed("promo_type", "campaign_type"))


def active_on(found: DataFrame, day: Column) -> DataFrame:
    """The campaigns that run on a date."""
    return found.filter((F.col("start_date") <= day) & (F.col("end_date") >= day))


def _bucket(day: Column, bucket_days: int) -> Column:
    return F.floor(F.unix_date(day) / bucket_days).cast("int")


def campaign_sales(found: DataFrame, txn: DataFrame, bucket_days: int = 32) -> DataFrame:
    """Every campaign with all sales of its product (and store, where it has one) while it ran:
    ``sales``, ``units``, ``revenue`` and how many of the sales were promoted."""
    join = [k for k in ("product_id", "store_id") if k in found.columns]
    daily = (txn.filter(F.col("date").isNotNull()).groupBy(*join, "date")
             .agg(F.count(F.lit(1)).alias("sales"), F.sum("quantity").alias("units"), F.sum("revenue").alias("revenue"),
                  F.count_if(F.col("is_promotion") == 1).alias("promoted_sales"))
             .withColumn("_bucket", _bucket(F.col("date"), bucket_days)))
    spans = F.sequence(_bucket(F.col("start_date"), bucket_days), _bucket(F.col("end_date"), bucket_days))
    listed = found.select(*join, "campaign_type", "start_date", "end_date", F.explode(spans).alias("_bucket"))
    inside = F.col("date").between(F.col("start_date"), F.col("end_date"))
    matched = listed.join(daily, [*join, "_bucket"]).filter(inside)
    return (matched.groupBy(*join, "campaign_type", "start_date", "end_date")
            .agg(*[F.sum(c).alias(c) for c in ("sales", "units", "revenue", "promoted_sales")]))
