"""Stock ledger (G5): the stored stock against sales counted anew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ledger(inventory: DataFrame, txn: DataFrame) -> DataFrame:
    """Stored stock per product and store, reconciled with the sales: units
    sold are summed from the transactions, and the stock that should be left,
    max(0, initial - sold + replenishment), follows from that sum."""
    sold = txn.groupBy("product_id", "store_id").agg(F.sum("quantity").alias("units"))
    counted = F.coalesce(F.col("units"), F.lit(0).cast("bigint"))
    law = F.greatest(F.lit(0).cast("bigint"), F.col("initial_stock") - counted + F.col("replenishment"))
    return inventory.join(sold, ["product_id", "store_id"], "left").select(
        "product_id", "store_id", "initial_stock", "total_sold", "replenishment", "current_stock",
        counted.alias("counted_sold"),
        ((F.col("total_sold") == counted) & (F.col("current_stock") == law)).alias("ledger_ok"))
