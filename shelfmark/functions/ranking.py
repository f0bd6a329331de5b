"""Average-tie percentile rank (W1) without a single-partition window.

pandas' ``rank(pct=True)`` gives tied values the mean of their positions and
divides by the number of non-null values.  A plain ``rank() over (order by
v)`` would pull the whole table into one task, so instead:

1. count rows per distinct value (map-side combine: a value held by a third
   of all rows collapses to one row per task before the shuffle);
2. range-partition the distinct values and freeze that partitioning with a
   written table (range bounds come from sampling, so they must not be
   recomputed differently for the two uses below);
3. prefix sums inside each range partition (window per partition id), plus
   per-partition offsets computed over one row per partition;
4. bring the ranks back to the rows by (value, range), never by a value alone,
   and to the table by its unique key.

Everything is exact: the result carries ``2 * average rank`` as an integer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.sources.shared import write_shared


def counts_below(dv: DataFrame, key: str, value: str, partitions: int | None = None) -> DataFrame:
    """For rows (key, value, _c) with distinct (key, value), add ``_less``:
    the number of rows of the same key with a smaller value, and ``_tot``:
    the number of rows of the key.

    The pairs are range-partitioned on (key, value), so even a key with an
    unbounded number of distinct values is spread over several tasks; the
    partitioning is frozen in a written table (range bounds come from sampling
    and must not differ between the two uses below).  Prefix sums run inside
    each range partition; per-(key, partition) totals give the offsets."""
    spark = dv.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = write_shared(dv.repartitionByRange(partitions, key, value)
                          .withColumn("_part", F.spark_partition_id()), "ranges")
    part_tot = ranged.groupBy(key, "_part").agg(F.sum("_c").alias("_pt"))
    offsets = part_tot.select(
        key, "_part",
        F.coalesce(F.sum("_pt").over(Window.partitionBy(key).orderBy("_part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_pt").over(Window.partitionBy(key)).alias("_tot"))
    local = (Window.partitionBy("_part", key).orderBy(value)
             .rowsBetween(Window.unboundedPreceding, -1))
    less = F.coalesce(F.sum("_c").over(local), F.lit(0)) + F.col("_off")
    # offsets: one row per (key, range partition) touched, joined on both.
    return (ranged.join(offsets, [key, "_part"])
            .select(key, value, "_c", less.alias("_less"), "_tot"))


def with_average_rank2(df: DataFrame, key: str, cols: dict[str, str]) -> DataFrame:
    """Add, for each ``col -> out`` in ``cols``, ``out`` = 2 * average rank
    of ``col`` among non-null values (null for null values); ``key`` is unique.

    All measures go through one pass: the rows (measure, value, key) are
    range-partitioned and written once, so a value that most rows share is
    spread over several ranges.  Each range's (measure, value) counts are
    summed to the positions of the values, these go back to the ranges that
    hold the value, and only then to the rows, so a join key never has more
    rows than one range.  The ranks of a row return to it by ``key``."""
    pairs = df.select(F.col(key).alias("key"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
        for c in cols])).alias("p")).select("p.measure", "p.value", "key").filter(F.col("value").isNotNull())
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = write_shared(pairs.repartitionByRange(n, "measure", "value", "key").withColumn("_range", F.spark_partition_id()), "ranks")
    held = rows.groupBy("measure", "value", "_range").agg(F.count(F.lit(1)).alias("_n"))
    counts = held.groupBy("measure", "value").agg(F.sum("_n").alias("_c"))
    below = counts_below(counts, "measure", "value").select(
        "measure", "value", (F.col("_less") * 2 + F.col("_c") + 1).cast("bigint").alias("_r2"))
    local = held.select("measure", "value", "_range").join(below, ["measure", "value"])
    ranked = rows.join(local, ["measure", "value", "_range"])
    wide = ranked.groupBy("key").agg(*[
        F.max(F.when(F.col("measure") == c, F.col("_r2"))).alias(out) for c, out in cols.items()])
    return df.join(wide.withColumnRenamed("key", key), key, "left")


def non_null_count(df: DataFrame, col: str) -> Column:
    """Scalar subquery: number of non-null values of ``col``."""
    return df.agg(F.count(col)).scalar()
