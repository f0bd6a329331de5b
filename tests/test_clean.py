from datetime import date


from pricing_rows import txn_row
from shelfmark.operators import clean


def test_exact_duplicates_dropped(make_txn):
    df = make_txn([txn_row(1), txn_row(1), txn_row(1, qty=2)])
    assert clean.deduplicate(df).count() == 2


def test_median_imputation(make_txn):
    rows = [txn_row(i, pid=1, price=p) for i, p in enumerate([1, 2, 4, 10])]
    rows += [txn_row(10, pid=1, price=None), txn_row(11, pid=2, price=None)]
    out = {r.transaction_id: r.selling_price
           for r in clean.fill_missing_prices(make_txn(rows)).collect()}
    assert float(out[10]) == 3.0          # exact median of 1, 2, 4, 10
    assert out[11] is None                # product without any price stays null
    assert float(out[0]) == 1.0


def test_validate_keeps_only_valid(make_txn):
    rows = [txn_row(1, price=0), txn_row(2, price=-1), txn_row(3, qty=-1), txn_row(4, qty=0),
            txn_row(5, price=None)]
    kept = [r.transaction_id for r in clean.validate(make_txn(rows)).collect()]
    assert kept == [4]


def test_computed_columns_edges(make_txn):
    rows = [txn_row(1, price=110, base=100),          # price above base -> discount 0
            txn_row(2, qty=0),                        # zero revenue -> margin 0
            txn_row(3, base=None),                    # null base -> discount null
            txn_row(4, price=95, base=100, cost=50, qty=2)]
    out = {r.transaction_id: r for r in clean.add_computed_columns(make_txn(rows)).collect()}
    assert out[1].discount_pct == 0.0
    assert out[2].gross_margin == 0.0
    assert out[3].discount_pct is None
    assert out[4].discount_pct == 0.05
    assert float(out[4].revenue) == 190.0 and float(out[4].profit) == 90.0
    assert out[4].gross_margin == round(90 / 190, 4)


def test_time_features(make_txn):
    rows = [txn_row(1, day=date(2024, 8, 15)), txn_row(2, day=date(2024, 8, 17))]
    out = {r.transaction_id: r for r in clean.transform(make_txn(rows)).collect()}
    assert out[1].is_holiday == 1 and out[1].day_of_week == 3 and out[1].quarter == 3
    assert out[2].is_weekend == 1 and out[2].is_holiday == 0


def test_recent_window_is_inclusive(make_txn):
    rows = [txn_row(1, day=date(2024, 4, 10)), txn_row(2, day=date(2024, 1, 11)),
            txn_row(3, day=date(2024, 1, 10))]
    kept = sorted(r.transaction_id for r in clean.recent_window(make_txn(rows), 90).collect())
    assert kept == [1, 2]


def test_constraint_report_counts(spark, make_txn):
    from pricing_rows import INVENTORY_SCHEMA, PRODUCT_SCHEMA
    products = spark.createDataFrame([(1, "a", "X", 10, 5, 1.0, -1.0)],
                                     PRODUCT_SCHEMA.replace("decimal(12,2)", "int"))
    stores = spark.createDataFrame([(1, "s", "c", "r", 1)],
                                   "store_id bigint, store_name string, city string, region string, tier int")
    inv = spark.createDataFrame([(1, 1, 1, 1, 1, 1, 0, 50), (9, 1, 1, 1, 1, -1, 0, 50)], INVENTORY_SCHEMA)
    txn = make_txn([txn_row(1), txn_row(2, pid=7), txn_row(3, qty=-2)])
    rep = {(r.table_name, r.rule): r.violations
           for r in clean.constraint_violations(txn, products, stores, inv).collect()}
    assert rep[("transactions", "foreign_key(product_id)")] == 1
    assert rep[("transactions", "check(quantity_sold >= 0)")] == 1
    assert rep[("inventory", "foreign_key(product_id)")] == 1
    assert rep[("inventory", "check(current_stock >= 0)")] == 1
    assert rep[("products", "primary_key(product_id)")] == 0


def test_clean_table_is_written_once_with_filled_and_removed_rows(spark, make_txn, monkeypatch):
    rows = [txn_row(i, pid=1, price=p) for i, p in enumerate([1, 2, 4, 10, -3])]   # -3 counts for the median
    rows += [txn_row(10, pid=1, price=None), txn_row(11, pid=2, price=None), txn_row(12, price=7, qty=-1),
             txn_row(13, pid=1, price=None, qty=-2), txn_row(14, price=5, day=None)]
    written = []
    monkeypatch.setattr(clean, "write_shared", lambda df, name, by=(), w=clean.write_shared: written.append(name) or w(df, name, by))
    out = clean.write_clean(make_txn(rows))
    assert written[0] == "clean" and "dedup" not in written
    prices = {r.transaction_id: float(r.selling_price) for r in out.collect()}
    assert prices == {0: 1.0, 1: 2.0, 2: 4.0, 3: 10.0, 10: 4.0, 14: 5.0}
    assert out._cleaning == {"rows_in": 10, "rows_removed": 4}
    expected = clean.after_dedup(make_txn(rows))
    assert out.exceptAll(expected.select(*out.columns)).isEmpty() and expected.select(*out.columns).exceptAll(out).isEmpty()
    empty = clean.write_clean(make_txn([]))
    assert empty.count() == 0 and empty._cleaning == {"rows_in": 0, "rows_removed": 0}


def test_clean_table_stores_no_column_that_follows_from_its_row(spark, make_txn):
    """The written bytes of o8_recommendations, o3_coarse and all queries on the cleaned sales."""
    import glob
    import pyarrow.parquet as pq
    rows = [txn_row(1, price=7, qty=3, base=9), txn_row(2, price=None), txn_row(3, price=8, qty=0), txn_row(4, qty=-1),
            txn_row(5, cost=None, base=None), txn_row(6, pid=None, day=None), txn_row(7, price=20, base=0)]
    out = clean.write_clean(make_txn(rows))
    files = glob.glob(out._shared_path.removeprefix("file:") + "/**/*.parquet", recursive=True)
    assert files
    for f in files:
        held = pq.read_metadata(f)
        assert not set(held.schema.names) & {"revenue", "profit", "discount_pct", "gross_margin"}
        assert held.row_group(0).column(0).compression == "ZSTD"
    full = clean.after_dedup(make_txn(rows)).select(*out.columns)
    assert out.dtypes == full.dtypes and out.count() == full.count() == 6
    assert out.exceptAll(full).isEmpty() and full.exceptAll(out).isEmpty()
    assert {r.transaction_id: r.revenue and float(r.revenue) for r in out.collect()}[1] == 21.0
    assert out.columns == [c for c in clean.add_computed_columns(make_txn(rows)).columns if c != "year"] + [
        c for c in out.columns if c not in clean.add_computed_columns(make_txn(rows)).columns]


def test_pricing_queries_bound_what_a_task_reads(spark):
    from shelfmark.session import bound_tasks
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "128MB")
        spark.conf.set(keys[1], "64k")
        bound_tasks(spark)
        assert spark.conf.get(keys[0]) == str(16 << 20) and spark.conf.get(keys[1]) == "64k"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_shuffles_start_with_partitions_for_the_input(spark, tmp_path):
    """A task of an aggregate or window stays the same size while the input grows."""
    from shelfmark.session import bound_tasks
    from shelfmark.sources.shared import stored_bytes
    (tmp_path / "t.parquet").mkdir()
    (tmp_path / "t.parquet" / "a").write_bytes(b"x" * 1000)
    (tmp_path / "t.parquet" / "b").write_bytes(b"x" * 500)
    assert stored_bytes(spark, str(tmp_path / "t.parquet"), str(tmp_path / "none")) == 1500
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.unset(key)
    try:
        bound_tasks(spark, own * (4 << 20))
        assert spark.conf.get(key, None) is None  # enough as it is
        bound_tasks(spark, 100 * (4 << 20) - 1)
        assert spark.conf.get(key) == "100"
        assert spark.range(1000).groupBy("id").count().rdd.getNumPartitions() <= 100
        bound_tasks(spark, 50 * (4 << 20))
        assert spark.conf.get(key) == "100"
        bound_tasks(spark, 1 << 50)
        assert spark.conf.get(key) == "10000"
    finally:
        spark.conf.unset(key)
