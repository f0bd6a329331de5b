"""File sources and sinks (S1-S5): CSV extract with explicit schemas,
processed CSV / Parquet table sinks, JSON record sinks and the SQL views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfmark.session import checkpoint_dir

# Canonical input schemas (Spark DDL) of the pricing engine's CSV files.
SCHEMAS = {
    "products": "product_id STRING, product_name STRING, category STRING, base_price DOUBLE, "
                "cost DOUBLE, base_demand INT, elasticity DOUBLE",
    "stores": "store_id STRING, city STRING, region STRING, tier INT",
    "transactions": "transaction_id STRING, date DATE, product_id STRING, store_id STRING, "
                    "quantity BIGINT, selling_price DOUBLE, base_price DOUBLE, cost DOUBLE, "
                    "competitor_price DOUBLE, is_promotion INT, discount_pct DOUBLE, "
                    "revenue DOUBLE, profit DOUBLE",
    "promotions": "promo_id STRING, transaction_id STRING, product_id STRING, store_id STRING, "
                  "date DATE, discount_pct DOUBLE, promo_type STRING",
    "inventory": "product_id STRING, store_id STRING, initial_stock BIGINT, total_sold BIGINT, "
                 "replenishment BIGINT, current_stock BIGINT",
}


def csv_files(spark: SparkSession, raw_dir: str) -> list[str]:
    """CSV file paths under ``raw_dir`` through the Hadoop file system, so
    local, HDFS and object-store paths work alike (metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(raw_dir.rstrip("/") + "/*.csv")
    statuses = path.getFileSystem(conf).globStatus(path) or []
    return sorted(str(s.getPath().toString()) for s in statuses)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder at the shared location, for files that are read back."""
    return f"{checkpoint_dir(spark).rstrip('/')}/shelfmark-{name}-{uuid.uuid4().hex}"


def read_csv(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """CSV with a header; the schema of a known table is given (FAILFAST),
    others are inferred."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("dateFormat", "yyyy-MM-dd")
    reader = reader.schema(SCHEMAS[table]) if table in SCHEMAS else reader.option("inferSchema", True)
    return reader.csv(path)


def extract(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """Every ``*.csv`` in ``raw_dir`` keyed by file stem; header row,
    explicit schema for known stems (FAILFAST), inferred otherwise."""
    files = csv_files(spark, raw_dir)
    if not files:
        raise FileNotFoundError(f"No CSV files found in {raw_dir}")
    out = {}
    for f in files:
        stem = f.rsplit("/", 1)[-1][:-4]
        out[stem] = read_csv(spark, f, stem)
    return out


def save_csv(datasets: dict[str, DataFrame], out_dir: str) -> None:
    """One CSV directory per table, overwritten."""
    for name, df in datasets.items():
        df.write.mode("overwrite").option("header", True).csv(f"{out_dir.rstrip('/')}/{name}")


def save_tables(datasets: dict[str, DataFrame], out_dir: str,
                partition_by: dict[str, list[str]] | None = None) -> None:
    """S3: Parquet tables replacing earlier ones; the fact table is
    partitioned (e.g. by year and month) so date filters prune files."""
    partition_by = partition_by or {"transactions": ["year", "month"]}
    for name, df in datasets.items():
        w = df.write.mode("overwrite")
        cols = [c for c in partition_by.get(name, []) if c in df.columns]
        if cols:
            w = w.partitionBy(*cols)
        w.parquet(f"{out_dir.rstrip('/')}/{name}")


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """The SQL layer's tables and its four reporting views as temp views."""
    from shelfmark.operators import sqlcorpus
    for name, df in views.items():
        df.createOrReplaceTempView({"t": "transactions", "p": "products", "i": "inventory"}.get(name, name))
    for v, q in (("v_product_performance", "v1_product"), ("v_category_performance", "v2_category"),
                 ("v_monthly_trends", "v3_monthly"), ("v_inventory_status", "v4_inventory")):
        sqlcorpus.run(spark, q, views).createOrReplaceTempView(v)


def save_json(df: DataFrame, path: str) -> None:
    """Rows as JSON records (ISO dates, nulls kept)."""
    (df.write.mode("overwrite").option("ignoreNullFields", False)
     .option("dateFormat", "yyyy-MM-dd").json(path))
