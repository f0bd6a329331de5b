import os
import tempfile

from shelfmark.plans import pricing_run
from shelfmark.sources import files
from shelfmark.sources.model import load_model

SMOKE = "/root/testdata/sf0.001"


def test_csv_roundtrip_and_views(spark):
    out = tempfile.mkdtemp(prefix="shelfmark-csv-")
    m = load_model(spark, SMOKE)
    stores = m.stores.select("store_id", "city", "region", "tier")
    stores.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out}/tmp_stores")
    part = [f for f in os.listdir(f"{out}/tmp_stores") if f.endswith(".csv")][0]
    raw = f"{out}/raw"
    os.makedirs(raw)
    os.rename(f"{out}/tmp_stores/{part}", f"{raw}/stores.csv")
    got = files.extract(spark, raw)
    assert set(got) == {"stores"}
    assert got["stores"].schema.simpleString() == \
        "struct<store_id:string,city:string,region:string,tier:int>"
    assert got["stores"].count() == stores.count()
    files.save_tables({"transactions": m.clean_transactions}, f"{out}/tables")
    assert any(d.startswith("year=") for d in os.listdir(f"{out}/tables/transactions"))


def test_extract_requires_csv(spark):
    empty = tempfile.mkdtemp(prefix="shelfmark-empty-")
    try:
        files.extract(spark, empty)
    except FileNotFoundError:
        return
    raise AssertionError("expected FileNotFoundError")


def test_full_run_writes_all_documents(spark):
    out = tempfile.mkdtemp(prefix="shelfmark-pipe-")
    times = pricing_run.run(spark, SMOKE, out)
    assert set(times) == set(os.listdir(out))
    recs = spark.read.json(f"{out}/recommendations")
    assert recs.count() == load_model(spark, SMOKE).products.count()
    summary = spark.read.json(f"{out}/recommendations_summary").collect()[0]
    assert summary.total_products == recs.count()


def test_run_on_a_folder_of_csv_files(spark, tmp_path):
    """Own categories and elasticities, from CSV files to documents."""
    raw = tmp_path / "raw"
    raw.mkdir()
    cats = ["Tea", "Mugs", "Spoons"]
    products = [f"P{i},item {i},{cats[i % 3]},{100 + i}.00,{60 + i}.00,{5 + i},-1.{i}" for i in range(6)]
    (raw / "products.csv").write_text("product_id,product_name,category,base_price,cost,base_demand,elasticity\n" + "\n".join(products) + "\n")
    (raw / "stores.csv").write_text("store_id,city,region,tier\nS1,X,North,1\nS2,Y,South,2\n")
    sales, n = [], 0
    for day in range(1, 29):
        for month in range(1, 13):
            for p in range(6):
                n += 1
                price = round((100 + p) * (1 - 0.05 * ((day + p) % 4)), 2)
                qty = 3 + (day * 7 + month * 3 + p) % 9
                sales.append(f"T{n},2024-{month:02d}-{day:02d},P{p},S{1 + n % 2},{qty},{price},{100 + p}.00,{60 + p}.00,{98 + p}.50,"
                             f"{int((day + p) % 4 > 0)},{0.05 * ((day + p) % 4):.2f},{price * qty:.2f},{(price - 60 - p) * qty:.2f}")
    sales.append(sales[0])  # an exact duplicate
    sales.append(f"T{n + 1},2024-05-05,P1,S1,4,,101.00,61.00,99.50,0,0.00,,")  # a missing price
    (raw / "transactions.csv").write_text(
        "transaction_id,date,product_id,store_id,quantity,selling_price,base_price,cost,competitor_price,is_promotion,discount_pct,"
        "revenue,profit\n" + "\n".join(sales) + "\n")
    (raw / "inventory.csv").write_text("product_id,store_id,initial_stock,total_sold,replenishment,current_stock\n" + "".join(
        f"P{p},S{s},500,300,100,300\n" for p in range(6) for s in (1, 2)))
    configured = {"Tea": -1.5, "Mugs": -0.7, "Plates": -2.0}
    out = str(tmp_path / "out")
    times = pricing_run.run(spark, str(raw), out, configured=configured)
    assert set(times) == set(os.listdir(out))
    doc = spark.read.json(f"{out}/overview_kpis").first()
    assert doc.total_orders == n + 1  # the duplicate is gone, the imputed sale counts
    got = {r.category: r for r in spark.read.json(f"{out}/elasticity_category").collect()}
    assert set(got) == {"Tea", "Mugs", "Spoons", "Plates"} and got["Plates"].elasticity == -2.0 and got["Plates"].n_obs == 0
    recs = spark.read.json(f"{out}/recommendations")
    assert recs.count() == 6 and {r.category for r in recs.collect()} == set(cats)
    assert spark.read.json(f"{out}/simulation_results").count() == 54
    manifest = {r.document: r.datasets for r in spark.read.json(f"{out}/manifest").collect()}
    assert len(manifest) == 9 and all(os.path.isdir(f"{out}/{p}") for ps in manifest.values() for p in ps)
    assert "PROMO" not in {r.category for r in spark.read.json(f"{out}/elasticity_category").collect()}
