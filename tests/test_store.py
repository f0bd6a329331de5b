"""Campaigns, the quality pass, catalog tables, the SQL entry and scenarios of fractional percents."""

import glob
import os
import uuid
from datetime import date, timedelta

import pytest
from pricing_rows import INVENTORY_SCHEMA, PRODUCT_SCHEMA, txn_row

from shelfmark.operators import campaigns, markdown, quality
from shelfmark.sources import catalog, sqlentry
from shelfmark.sources.model import load_model

SMOKE = "/root/testdata/sf0.001"
DAY = date(2024, 1, 1)


def _promos(spark, rows):
    return spark.createDataFrame(rows, "product_id bigint, store_id bigint, promo_type string, date date, discount_pct double")


def _islands(rows, gap):
    """Campaigns by a plain walk over the sorted days."""
    found = {}
    for key in {r[:3] for r in rows}:
        mine = sorted((r[3], r[4]) for r in rows if r[:3] == key and r[3] is not None)
        for day, disc in mine:
            runs = found.setdefault(key, [])
            if runs and (day - runs[-1][1]).days <= gap:
                start, _, n, days, top = runs[-1]
                runs[-1] = (start, day, n + 1, days | {day}, max(top, disc))
            else:
                runs.append((day, day, 1, {day}, disc))
    return {(*key, s, e, n, len(days), top) for key, runs in found.items() for s, e, n, days, top in runs}


def test_campaigns_equal_a_plain_walk(spark):
    rows = [(p, s, t, DAY + timedelta(days=(i * i * 7 + p * 3 + s) % 160), 0.05 * (1 + i % 4))
            for i in range(60) for p, s, t in ((1, 1, "A"), (1, 1, "B"), (1, 2, "A"), (2, 1, "A"))]
    rows += [(3, 1, "A", DAY, 0.1), (3, 1, "A", DAY + timedelta(days=10), 0.2), (3, 1, "A", DAY + timedelta(days=21), 0.1), (4, 1, "A", None, 0.1)]
    for gap in (1, 5, 10):
        got = {(r.product_id, r.store_id, r.campaign_type, r.start_date, r.end_date, r.n_sales, r.n_days, r.discount_pct)
               for r in campaigns.campaigns(_promos(spark, rows), gap_days=gap).collect()}
        assert got == _islands(rows, gap)
    assert campaigns.campaigns(_promos(spark, [])).count() == 0


def test_sales_while_a_campaign_runs(spark, make_txn):
    found = spark.createDataFrame([(1, "A", DAY, DAY + timedelta(days=70)), (1, "B", DAY + timedelta(days=31), DAY + timedelta(days=32)),
                                   (2, "A", DAY, DAY)], "product_id bigint, campaign_type string, start_date date, end_date date")
    days = [0, 0, 31, 32, 33, 70, 71]
    txn = make_txn([txn_row(i, pid=1, qty=i + 1, day=DAY + timedelta(days=d), disc=0.1 * (i % 2)) for i, d in enumerate(days)]
                   + [txn_row(50, pid=2, day=None), txn_row(51, pid=None, day=DAY)])
    for bucket in (1, 32, 1000):
        got = {(r.product_id, r.campaign_type): (r.sales, r.units, float(r.revenue), r.promoted_sales)
               for r in campaigns.campaign_sales(found, txn, bucket).collect()}
        assert got == {(1, "A"): (6, 21, 210.0, 3), (1, "B"): (2, 7, 70.0, 1)}
    assert {r.campaign_type for r in campaigns.active_on(found.filter("product_id = 1"), campaigns.F.lit(DAY)).collect()} == {"A"}


def test_split_counts_and_names_what_is_broken(spark, make_txn):
    products = spark.createDataFrame([(1, "a", "X", 10, 5, 1.0, -1.0)], PRODUCT_SCHEMA.replace("decimal(12,2)", "int"))
    txn = make_txn([txn_row(1), txn_row(2, price=0, qty=-1), txn_row(3, pid=9), txn_row(4, price=None), txn_row(5, day=None), txn_row(6, pid=None)])
    got = quality.split(txn, "transactions", [("product_id", products, "product_id")])
    assert [r.transaction_id for r in got.good.collect()] == [1] and got.good.columns == txn.columns
    named = {r.transaction_id: r.broken_rules for r in got.quarantine.collect()}
    assert named == {2: "check(quantity_sold >= 0); check(selling_price > 0)", 3: "foreign_key(product_id)", 4: "check(selling_price > 0)",
                     5: "not_null(date)", 6: "not_null(product_id)"}
    assert got.counts["rows"] == 6 and got.counts["check(selling_price > 0)"] == 2 and got.counts["foreign_key(product_id)"] == 1
    empty = quality.split(make_txn([]), "transactions")
    assert empty.good.count() == 0 and empty.quarantine.count() == 0 and empty.counts["rows"] == 0


def test_each_table_is_scanned_once(spark):
    m = load_model(spark, SMOKE)
    plan = quality.violations(m.inventory, "inventory", None, [("product_id", m.products, "product_id")])
    assert plan._jdf.queryExecution().executedPlan().toString().count("lineitem") == \
        m.inventory._jdf.queryExecution().executedPlan().toString().count("lineitem")


def _files(table):
    return {p: os.path.getmtime(p) for p in glob.glob(f"{table.folder.removeprefix('file:')}/year=*/month=*/*.parquet")}


def test_only_changed_partitions_are_rewritten(spark):
    rows = spark.range(2000).selectExpr("id", "id % 37 as product_id", "id * 2 as qty", "cast(2023 + id % 2 as int) as year",
                                        "cast(1 + id % 12 as int) as month")
    table = catalog.create(rows, f"t_{uuid.uuid4().hex}", buckets=4)
    try:
        before = _files(table)
        assert table.replace_changed(rows).count() == 0 and _files(table) == before
        changed = rows.selectExpr("id", "product_id", "if(year = 2024 and month = 2, qty + 1, qty) as qty", "year", "month").filter("month <> 3")
        late = changed.unionByName(spark.sql("select 9999L id, 1L product_id, 1L qty, 2025 year, 1 month"))
        written = {(r.year, r.month) for r in table.replace_changed(late).collect()}
        assert written == {(2024, 2), (2025, 1)}
        after = _files(table)
        kept = [p for p in before if "month=3/" not in p and not p.endswith("-") and "year=2024/month=2/" not in p]
        assert all(after.get(p) == before[p] for p in kept) and not any("month=3/" in p for p in after)
        assert sorted(map(tuple, table.read().select(*late.columns).collect())) == sorted(map(tuple, late.collect()))
        # A run that died after it removed the digests: the next one writes these partitions again.
        table.digests(late).filter("month <> 5").write.mode("overwrite").parquet(table._digest_folder)
        assert {r.month for r in table.replace_changed(late).collect()} == {5}
        assert table.read().count() == late.count()
    finally:
        table.drop()


def test_bucketed_tables_join_without_a_shuffle(spark):
    a = catalog.create(spark.range(500).selectExpr("id % 50 as product_id", "id as x"), f"a_{uuid.uuid4().hex}", keys=(), buckets=4)
    b = catalog.create(spark.range(50).selectExpr("id as product_id", "id * 3 as y"), f"b_{uuid.uuid4().hex}", keys=(), buckets=4)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.read().groupBy("product_id").count().join(b.read(), "product_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
        a.drop()
        b.drop()


@pytest.mark.parametrize("text, same", [
    ("select cast(a as real) from t;", "select cast(a as DOUBLE) from t"),
    ("select 'real', \"real\", `real`, really -- real\nfrom t", "select 'real', \"real\", `real`, really -- real\nfrom t"),
    ("select 'it''s real', CAST(1 AS REAL)", "select 'it''s real', CAST(1 AS DOUBLE)"),
])
def test_real_means_eight_bytes(text, same):
    assert sqlentry.statement(text) == same


def test_sql_entry_functions_tables_and_views(spark):
    m = load_model(spark, SMOKE)
    row = sqlentry.sql(spark, m, """
        SELECT strftime('%Y-%m', DATE '2024-03-09') AS a, strftime('%d.%m.%Y 100%% day %j', DATE '2024-03-09') AS b,
               strftime('%H:%M:%S', TIMESTAMP '2024-03-09 04:05:06') AS c, julianday(DATE '2000-01-01') AS d, strftime('%Y', NULL) AS e""").first()
    assert tuple(row) == ("2024-03", "09.03.2024 100% day 069", "04:05:06", 2451544.5, None)
    for name in ("transactions", "products", "stores", "inventory", "promotions", "v_product_performance", "v_category_performance",
                 "v_monthly_trends", "v_inventory_status"):
        assert spark.sql(f"SELECT COUNT(*) AS n FROM {name}").first().n > 0


def test_a_fraction_of_a_percent_is_the_same_for_price_demand_and_label(spark, make_txn):
    products = spark.createDataFrame([(1, "a", "X", 100, 40, 9.0, -1.0)], PRODUCT_SCHEMA.replace("decimal(12,2)", "int"))
    stock = spark.createDataFrame([(1, 1, 10, 0, 0, 10, 0, 50)], INVENTORY_SCHEMA)
    own = spark.createDataFrame([(1, "X", -1.0)], "product_id bigint, category string, elasticity double")
    row = markdown.simulate(products, stock, make_txn([]), own, discounts=(0.125,)).first()
    assert (row.discount_pct, row.new_price) == (12.5, 87.5) and abs(row.expected_daily_demand - round(9 / 0.875, 1)) < 1e-9
