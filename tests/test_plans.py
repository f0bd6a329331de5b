"""Plan shapes and the shared cleaned table."""

import os
import shutil

from pyspark.sql import functions as F

from shelfmark.operators import clean, elasticity, optimize
from shelfmark.sources.model import load_model

SMOKE = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _candidates(spark, scale=1.0):
    rows = [(i, f"n{i}", "c", (100.0 + i) * scale, (60.0 + i % 30) * scale, 0.5 + i % 7, float(i % 200), -0.2 - (i % 30) / 10) for i in range(300)]
    return spark.createDataFrame(rows, "product_id long, product_name string, category string, base_price double, cost double, "
                                       "demand double, stock double, elasticity double")


def test_search_stays_inside_the_row(spark):
    text = plan(optimize.search(_candidates(spark)))
    assert "Generate" not in text and "Aggregate" not in text and "Join" not in text
    assert text.count("Exchange") == 1  # the rows are dealt out once


def test_search_equals_max_by(spark):
    """Also for objectives beyond 64 bits of thousandths."""
    row = {"base": F.col("base_price"), "cost": F.col("cost"), "e": F.col("elasticity"), "demand": F.col("demand"), "stock": F.col("stock")}
    for scale in (1.0, 1e10):
        inp = _candidates(spark, scale)
        found = {r.product_id: (r._coarse, r._opt) for r in optimize.search(inp).collect()}
        obj = optimize.objective(optimize.metrics(F.col("_k") / F.lit(10000.0), **row))

        def best(lo, hi, step):
            each = inp.join(starts, "product_id").withColumn("_k", F.explode(F.sequence(lo, hi, F.lit(step).cast("bigint"))))
            return each.groupBy("product_id").agg(F.max_by("_k", F.struct(obj, -F.col("_k"))).alias("k"))

        starts = inp.select("product_id", F.lit(0).cast("bigint").alias("k0"))
        coarse = best(F.lit(0).cast("bigint"), F.lit(5000).cast("bigint"), 100)
        starts = coarse.withColumnRenamed("k", "k0")
        fine = {r.product_id: r.k for r in best(F.greatest(F.lit(0).cast("bigint"), F.col("k0") - 200), F.least(F.lit(5000).cast("bigint"), F.col("k0") + 200), 1).collect()}
        assert found == {r.product_id: (r.k, fine[r.product_id]) for r in coarse.collect()}


def test_elasticity_fits_read_the_fact_once(spark):
    m = load_model(spark, SMOKE)
    fits = elasticity.run(m.clean_transactions, m.products)
    for df in fits.values():
        assert "selling_price" not in plan(df)  # moments only
    one_pass = plan(elasticity.product_moments(m.clean_transactions))
    assert one_pass.count("Exchange") == 1 and "Join" not in one_pass


def test_search_runs_on_blocks_and_keeps_the_rules_for_missing_values(spark):
    """also without a price, a cost, a demand, an elasticity or a stock, and beyond 64 bits of cents."""
    row = {"base": F.col("base_price"), "cost": F.col("cost"), "e": F.col("elasticity"), "demand": F.col("demand"), "stock": F.col("stock")}
    odd = [(i, "n", "c", *x) for i, x in enumerate([
        (None, 5.0, 2.0, 10.0, -1.5), (100.0, None, 2.0, 10.0, -1.5), (100.0, 50.0, None, 10.0, -1.5), (100.0, 50.0, 2.0, None, -1.5),
        (100.0, 50.0, 2.0, 10.0, None), (100.0, 50.0, -2.0, 10.0, -3.0), (100.0, 50.0, 2.0, 0.0, -3.0), (0.0, 0.0, 0.0, 0.0, 0.0),
        (1e20, 1e19, 2.0, 10.0, -3.0), (100.0, 20.0, 2.0, 100.0, 1.5), (100.0, 20.0, 2.0, 10.0, -8.0)])]
    inp = _candidates(spark).unionByName(spark.createDataFrame(odd, _candidates(spark).schema).withColumn("product_id", F.col("product_id") + 1000))
    found = optimize.search(inp)
    text = plan(found)
    assert "ArrowEvalPython" in text and "transform(" not in text  # measures of a block, no expression per candidate
    got = {r.product_id: (r._coarse, r._opt) for r in found.collect()}
    value = optimize.objective(optimize.metrics(F.col("_k") / F.lit(10000.0), **row))

    def best(rows, lo, hi, step):
        each = rows.withColumn("_k", F.explode(F.sequence(lo, hi, F.lit(step)))).withColumn("_v", value).filter("_v is not null")
        return {r.product_id: r.k for r in each.groupBy("product_id").agg(F.max_by("_k", F.struct("_v", -F.col("_k"))).alias("k")).collect()}

    coarse = best(inp, F.lit(0), F.lit(5000), 100)
    starts = spark.createDataFrame(list(coarse.items()), "product_id long, k0 int")
    fine = best(inp.join(starts, "product_id"), F.greatest(F.lit(0), F.col("k0") - 200), F.least(F.lit(5000), F.col("k0") + 200), 1)
    assert got == {i: (coarse.get(i), fine.get(i)) for i in got} and len(got) == 311
    assert got[1000] == got[1001] == (None, None)


def test_products_shuffle_two_variables_and_the_pool_none(spark, monkeypatch):
    """Five variables are pooled over all rows, not kept per product."""
    txn = load_model(spark, SMOKE).clean_transactions
    some = F.when(F.col("store_id") % 3 != 0, F.col("competitor_price"))
    txn = txn.withColumn("competitor_price", some)
    written = {}
    monkeypatch.setattr(elasticity, "write_shared", lambda df, name, w=elasticity.write_shared: written.setdefault(name, w(df, name)))
    fits = elasticity.run(txn, load_model(spark, SMOKE).products)
    assert len(written["moments"].columns) == 7 and written["pooled-moments"].count() == 1
    k = len(elasticity.FEATURES)
    merged = elasticity.merge_moments(elasticity.product_moments(txn), [], k, "f_").collect()[0].asDict()
    pooled = elasticity.pooled_moments(txn).collect()[0].asDict()
    assert pooled.keys() == merged.keys() and 0 < pooled["n"] < txn.count()
    assert all(abs(pooled[c] - merged[c]) <= 1e-9 * max(1.0, abs(merged[c])) for c in merged)
    assert plan(elasticity.multifeature_elasticity(txn)).count("Scan parquet") == 1
    assert fits["multifeature_model"].collect() == elasticity.multifeature_elasticity(txn).collect()
    none = elasticity.multifeature_elasticity(txn.limit(0)).collect()
    assert len(none) == 1 and none[0].n_obs == 0 and none[0].coefficients == {}


def test_recent_window_prunes_years(spark):
    txn = load_model(spark, SMOKE).clean_transactions
    text = plan(clean.recent_window(txn).select("product_id", "quantity"))
    assert any("year" in part[:200] for part in text.split("PartitionFilters: ")[1:])


def test_cleaned_table_follows_its_input(spark, tmp_path):
    folder = str(tmp_path / "tables")
    shutil.copytree(SMOKE, folder)
    first = load_model(spark, folder).clean_transactions
    n = first.count()
    assert load_model(spark, folder).clean_transactions is first  # shared within the application
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    lines.filter("l_orderkey % 2 = 0").coalesce(1).write.parquet(str(tmp_path / "half"))
    piece = next(x for x in os.listdir(tmp_path / "half") if x.endswith(".parquet"))
    os.chmod(folder, 0o755)
    os.chmod(f"{folder}/lineitem.parquet", 0o644)
    shutil.copyfile(tmp_path / "half" / piece, f"{folder}/lineitem.parquet")
    again = load_model(spark, folder).clean_transactions
    assert 0 < again.count() < n
    assert not os.path.exists(first._shared_path.removeprefix("file:"))  # the stale copy is gone


def test_cleaned_sales_of_a_product_lie_together(spark, tmp_path):
    folder = str(tmp_path / "tables")
    shutil.copytree(SMOKE, folder)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")  # several files a year
    try:
        txn = load_model(spark, folder).clean_transactions
    finally:
        spark.conf.set(setting, before)
    held = txn.select("product_id", "year", F.input_file_name().alias("file")).distinct()
    assert held.select("file").distinct().count() > held.select("year").distinct().count()
    assert held.groupBy("product_id", "year").count().filter("count > 1").isEmpty()
