"""Incremental monthly trends (K12) with Structured Streaming.

New line-item files arrive in a folder.  Every micro-batch is a bounded
DataFrame and handled in ``foreachBatch``:

1. its rows are reduced to the independent columns of a sale and made distinct;
2. rows that earlier batches brought already are dropped by comparing whole
   rows with the stored ones of the same months (``EXCEPT``; no event-time
   watermark, so late and old rows count like any others);
3. the new rows are stored by month under the batch's number; those with a
   price are cleaned (the checks and computed columns look at one row only) and
   summed per month; these sums are stored under the batch's number as well.

Both writes replace what an earlier attempt of the same batch left, so a
restarted driver repeats a batch without counting it twice.  The answer is the
sum of the batches' sums: months x batches rows, whatever the history's length.
Sales without a price take the median price of their product (T2), which any
batch can move.  They are added when the answer is taken, from the stored rows;
where every sale has a price, the files' null counts tell so.

All state lies in one folder of the shared checkpoint location, together with
the list of input files it stands for.  If one of these files was rewritten or
removed, the state no longer describes the input and a new one is started.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.calendar import add_time_features, month_label
from shelfmark.operators import clean
from shelfmark.session import bound_tasks, checkpoint_dir
from shelfmark.sources.model import sale_lines, sales
from shelfmark.sources.shared import fingerprint
from shelfmark.sources.tables import read_table, table_path

LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                "l_extendedprice", "l_discount", "l_shipdate"]
PART_COLUMNS = ["p_partkey", "p_name", "p_type", "p_size", "p_retailprice"]


def line_stream(spark: SparkSession, lines_path: str, max_files_per_trigger: int) -> DataFrame:
    """A streaming frame over the parquet files of a folder, or over one file."""
    schema = spark.read.parquet(lines_path).select(*LINE_COLUMNS).schema
    path = spark._jvm.org.apache.hadoop.fs.Path(lines_path)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isFile():
        # The source watches folders and patterns: a pattern that only this name fits.
        lines_path = f"{lines_path[:-1]}[{lines_path[-1]}]"
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(lines_path))


def monthly_sums(txn: DataFrame) -> DataFrame:
    """Mergeable monthly sums of a whole history of distinct sales."""
    return _sums(clean.fill_missing_prices(txn))


def _sums(filled: DataFrame) -> DataFrame:
    """T3 to T5 and the sums per month; a sale without a price fails the checks."""
    t = filled.transform(clean.validate).transform(clean.add_computed_columns).transform(add_time_features)
    return (t.groupBy(month_label(F.col("date")).alias("date"))
            .agg(F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"),
                 F.sum("quantity").alias("quantity"), F.count("transaction_id").alias("orders")))


def _stored(spark: SparkSession, state: str, columns: T.StructType, *batches: int) -> DataFrame:
    """Distinct rows that these batches, or all, have stored."""
    shape = T.StructType([*columns.fields, T.StructField("batch", T.IntegerType())])
    store = f"{state}/rows"
    return (spark.read.schema(shape).option("basePath", store)
            .parquet(*([f"{store}/batch={i}" for i in batches] or [store])).select(*columns.names))


def _late_sums(rows: DataFrame, part: DataFrame) -> DataFrame | None:
    """Sums of the stored sales without a price (T2); None where there are none."""
    unpriced = F.col("base_c").isNull() | F.col("discount_pct").isNull()  # stored columns, so files without nulls are not read
    missing = rows.filter(unpriced)
    if missing.isEmpty():
        return None
    return _sums(clean.with_medians(sales(missing, part), sales(rows.filter(~unpriced), part)))


def merged(sums: DataFrame) -> DataFrame:
    """K12 from the sums of all batches."""
    return (sums.groupBy("date")
            .agg(F.round(F.sum("revenue"), 2).cast("double").alias("revenue"),
                 F.round(F.sum("profit"), 2).cast("double").alias("profit"),
                 F.sum("quantity").cast("bigint").alias("quantity"), F.sum("orders").cast("bigint").alias("orders")))


def _files(spark: SparkSession, lines_path: str) -> set[str]:
    return set(filter(None, fingerprint(spark, lines_path).split("\n")))


def _state(spark: SparkSession, lines_path: str) -> str:
    """Folder of the state that fits the input: the latest one, or a new one
    where a file it was made from has changed."""
    tag = hashlib.sha256(lines_path.encode()).hexdigest()[:12]
    root = f"{checkpoint_dir(spark).rstrip('/')}/stream-monthly-{tag}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    held = [int(s.getPath().getName()) for s in fs.listStatus(path)] if fs.exists(path) else []
    if held:
        latest = f"{root}/{max(held)}"
        if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{latest}/files")):
            return latest  # an unfinished first run goes on
        seen = {r.value for r in spark.read.text(f"{latest}/files").collect()}  # file names and times only
        if seen <= _files(spark, lines_path):
            return latest
    return f"{root}/{max(held, default=0) + 1}"


def run_available(spark: SparkSession, lines_path: str, part: DataFrame,
                  max_files_per_trigger: int = 1000) -> DataFrame:
    """Process every file that is new since the last call and return the
    monthly trends over all files so far."""
    state = _state(spark, lines_path)

    def dated(lines: DataFrame) -> DataFrame:
        return sale_lines(lines).withColumn("month", F.trunc("date", "month"))

    def handle(batch: DataFrame, number: int) -> None:
        new = dated(batch).distinct()
        # Bounded by the calendar; taken from the dates alone, not from the distinct rows.
        days = sale_lines(batch).select(F.trunc("date", "month").alias("month"))
        months = [r.month for r in days.distinct().collect()]
        store = f"{state}/rows"
        earlier = None
        if number:
            earlier = (_stored(spark, state, new.schema, *range(number))
                       .filter(F.col("month").isin([m for m in months if m is not None]) | F.col("month").isNull()))
        fresh = new
        if earlier is not None:  # EXCEPT, of rows that are distinct already
            known = earlier.toDF(*(f"_{c}" for c in earlier.columns))
            same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in new.columns])
            fresh = new.join(known, same, "left_anti")
        fresh.write.mode("overwrite").partitionBy("month").parquet(f"{store}/batch={number}")
        rows = spark.read.schema(new.schema).option("basePath", f"{store}/batch={number}").parquet(f"{store}/batch={number}")
        _sums(sales(rows.drop("month"), part)).write.mode("overwrite").parquet(f"{state}/sums/batch={number}")

    files = _files(spark, lines_path)
    query = (line_stream(spark, lines_path, max_files_per_trigger).writeStream.foreachBatch(handle)
             .option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    spark.createDataFrame([(x,) for x in sorted(files)], "value string").write.mode("overwrite").text(f"{state}/files")
    rows = _stored(spark, state, dated(spark.read.parquet(lines_path)).schema).drop("month")
    sums, late = spark.read.parquet(f"{state}/sums/batch=*"), _late_sums(rows, part)
    return merged(sums if late is None else sums.unionByName(late))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K12 over the line items arriving in eight files, two per micro-batch, in
    no order of dates."""
    bound_tasks(spark)
    lines = read_table(spark, sf_dir, "lineitem", LINE_COLUMNS)
    tag = hashlib.sha256(fingerprint(spark, table_path(sf_dir, "lineitem")).encode()).hexdigest()[:12]
    arrived = f"{checkpoint_dir(spark).rstrip('/')}/stream-lines-{tag}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{arrived}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        lines.repartition(8, F.xxhash64("l_orderkey", "l_linenumber")).write.mode("overwrite").parquet(arrived)
    return run_available(spark, arrived, read_table(spark, sf_dir, "part", PART_COLUMNS), 2)
