"""Catalog tables that replace only what changed (S3).

A table is partitioned (e.g. by year and month) and bucketed on a join key.
Next to it lies a small digest table: row count and a 128-bit order-free hash
sum of every partition.  ``replace_changed`` takes the new content of the whole
table, compares digests and overwrites just the partitions that differ (dynamic
partition overwrite: Spark stages them and moves them in at the commit).

Order of the steps: the digests of the partitions to be written are removed
first and put back last.  A run that dies between leaves partitions without a
digest, and the next run writes these again.

Rows reach their files by an adaptive rebalance on (partition, bucket): small
groups share a task, a group too large for one task is split over several, so
neither a hot key nor a large month makes one task long.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.sources.files import shared_folder
from shelfmark.sources.shared import drop_shared, write_shared


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [a[k].eqNullSafe(b[k]) for k in keys])


class CatalogTable:
    """One partitioned, bucketed catalog table and the digests of its partitions."""

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], bucket: str, buckets: int, folder: str) -> None:
        self.spark, self.name, self.keys, self.bucket, self.buckets, self.folder = spark, name, list(keys), bucket, buckets, folder

    @property
    def _digest_folder(self) -> str:
        return f"{self.folder}-digests"

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def digests(self, rows: DataFrame) -> DataFrame:
        """Per partition: number of rows and two independent hash sums over all columns."""
        columns = [F.col(c) for c in sorted(rows.columns)]
        wide = lambda seed: F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)"))
        return rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"), wide(1).alias("h1"), wide(2).alias("h2"))

    def _held(self, like: DataFrame) -> DataFrame:
        if not _exists(self.spark, f"{self._digest_folder}/_SUCCESS"):
            return self.spark.createDataFrame([], like.schema)
        return self.spark.read.schema(like.schema).parquet(self._digest_folder)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows of one partition and bucket together, as far as one task can hold them."""
        if not self.buckets:
            return rows.hint("rebalance", *[F.col(k) for k in self.keys]) if self.keys else rows
        at = F.pmod(F.hash(F.col(self.bucket)), F.lit(self.buckets))
        return rows.withColumn("_at", at).hint("rebalance", *[F.col(k) for k in self.keys], F.col("_at")).drop("_at")

    def _remove(self, gone: DataFrame) -> None:
        """Partitions the new content no longer has (their key values only come to the driver)."""
        utils = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        for row in gone.select(*[F.col(k).cast("string") for k in self.keys]).collect():
            spec = ", ".join(f"{k} = {'NULL' if v is None else repr(v)}" for k, v in row.asDict().items())
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({spec})")
            _delete(self.spark, self.folder + "/" + "/".join(utils.getPartitionPathString(k, v) for k, v in row.asDict().items()))

    def replace_changed(self, rows: DataFrame) -> DataFrame:
        """Make ``rows`` the table's content; returns the keys of the partitions that were written."""
        layout = self.read().columns
        now = write_shared(self.digests(rows.select(*layout)), "digests")
        held = write_shared(self._held(now), "digests-held")
        equal = _same(now, held, self.keys) & _same(now, held, ["n", "h1", "h2"])
        changed = write_shared(now.join(held, equal, "left_anti"), "changed")
        gone = held.join(now, _same(held, now, self.keys), "left_anti")
        held.join(changed, _same(held, changed, self.keys), "left_anti").write.mode("overwrite").parquet(self._digest_folder)
        part = rows.select(*layout)
        part = part.join(changed.select(*self.keys), _same(part, changed, self.keys), "left_semi")
        if not changed.isEmpty():
            self._dealt(part).write.mode("overwrite").insertInto(self.name)
        self._remove(gone)
        now.write.mode("overwrite").parquet(self._digest_folder)
        self.spark.catalog.refreshTable(self.name)
        drop_shared(held)
        return changed.select(*self.keys)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        for folder in (self.folder, self._digest_folder):
            _delete(self.spark, folder)


def create(rows: DataFrame, name: str, keys: Sequence[str] = ("year", "month"), bucket: str = "product_id",
           buckets: int = 8, folder: str | None = None) -> CatalogTable:
    """A new catalog table with the content of ``rows``.

    ``keys`` partition it, ``bucket`` is the column it is bucketed and sorted
    on; two tables with equal ``buckets`` join on that column without a shuffle.
    Without ``keys`` the table is one partition and is only bucketed."""
    spark = rows.sparkSession
    table = CatalogTable(spark, name, keys, bucket, buckets, folder or shared_folder(spark, f"table-{name}"))
    layout = [c for c in rows.columns if c not in table.keys] + table.keys
    rows = rows.select(*layout)
    # The mode is a property of the table, so that every later insert overwrites only the partitions it holds.
    writer = table._dealt(rows).write.format("parquet").option("path", table.folder).option("partitionOverwriteMode", "dynamic")
    if table.keys:
        writer = writer.partitionBy(*table.keys)
    if buckets:
        writer = writer.bucketBy(buckets, bucket).sortBy(bucket)
    writer.saveAsTable(name)
    if table.keys:
        table.digests(table.read()).write.mode("overwrite").parquet(table._digest_folder)
    return table
