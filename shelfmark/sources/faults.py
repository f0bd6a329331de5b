"""Dirty copies derived from a whole transaction table.

The test tables are clean, so the cleaning operators are exercised on the
full table plus derived faulty rows: exact duplicates, rows with a missing
price, rows with a negative quantity and rows with a zero price.  A simple
id rule picks which rows get a faulty copy; every original row is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.exact import PRICE


def with_faults(txn: DataFrame) -> DataFrame:
    """Every row plus its faulty copies, from one pass over the rows."""
    tid = F.col("transaction_id")
    kinds = F.filter(F.array(F.lit("row"), F.when(tid % 50 == 0, "copy"), F.when(tid % 53 == 1, "no price"),
                             F.when(tid % 70 == 2, "negative"), F.when(tid % 90 == 3, "zero price")),
                     lambda k: k.isNotNull())
    kind = F.col("_kind")
    made = txn.withColumn("_kind", F.explode(kinds))
    return made.withColumns({
        "transaction_id": F.when(kind == "no price", -tid).when(kind == "negative", -tid - 1)
                           .when(kind == "zero price", -tid - 2).otherwise(tid),
        "selling_price": F.when(kind == "no price", F.lit(None).cast(PRICE))
                          .when(kind == "zero price", F.lit(0).cast(PRICE)).otherwise(F.col("selling_price")),
        "quantity": F.when(kind == "negative", -F.col("quantity")).otherwise(F.col("quantity")),
    }).drop("_kind")


FAULTS_SQL = """
faulty AS (
  SELECT * FROM txn
  UNION ALL SELECT * FROM txn WHERE transaction_id % 50 = 0
  UNION ALL SELECT * REPLACE (-transaction_id AS transaction_id,
                              CAST(NULL AS DECIMAL(12,2)) AS selling_price)
            FROM txn WHERE transaction_id % 53 = 1
  UNION ALL SELECT * REPLACE (-transaction_id - 1 AS transaction_id, -quantity AS quantity)
            FROM txn WHERE transaction_id % 70 = 2
  UNION ALL SELECT * REPLACE (-transaction_id - 2 AS transaction_id,
                              CAST(0 AS DECIMAL(12,2)) AS selling_price)
            FROM txn WHERE transaction_id % 90 = 3)
"""
