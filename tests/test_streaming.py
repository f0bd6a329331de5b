"""The incremental monthly trends: many batches, late and repeated rows, changed inputs."""

import os
import random
import shutil

from pyspark.sql import functions as F

from shelfmark.sources.tables import read_table
from shelfmark.streaming import monthly

SMOKE = "/root/testdata/sf0.001"


def batch_answer(lines, part):
    from shelfmark.sources.model import sale_lines, sales
    t = monthly.monthly_sums(sales(sale_lines(lines).distinct(), part))
    return sorted((r.date, float(r.revenue), float(r.profit), r.quantity, r.orders) for r in t.collect())


def rows(df):
    return sorted((r.date, r.revenue, r.profit, r.quantity, r.orders) for r in df.collect())


def test_many_batches_with_late_and_repeated_rows(spark, tmp_path):
    lines = read_table(spark, SMOKE, "lineitem", monthly.LINE_COLUMNS)
    part = read_table(spark, SMOKE, "part", monthly.PART_COLUMNS)
    folder = str(tmp_path / "lines")
    again = lines.filter("l_orderkey % 3 = 0")
    for i, piece in enumerate([lines.filter("l_orderkey % 4 = 0"), lines.filter("l_orderkey % 4 = 1").unionByName(again),
                               lines.filter("l_orderkey % 4 = 2"), again, lines.filter("l_orderkey % 4 = 3")]):
        piece.coalesce(1).write.mode("append").parquet(folder)
    want = batch_answer(lines, part)
    assert sum(w[-1] for w in want) > 5000
    assert rows(monthly.run_available(spark, folder, part, max_files_per_trigger=1)) == want
    # Nothing new: same answer.  New late rows and a repeat: only the new ones count.
    assert rows(monthly.run_available(spark, folder, part, 1)) == want
    late = lines.limit(20).withColumn("l_orderkey", F.col("l_orderkey") + 10_000_000).withColumn(
        "l_shipdate", F.to_date(F.lit("1990-01-15")).cast(lines.schema["l_shipdate"].dataType))
    late = spark.createDataFrame(late.collect(), late.schema)
    late.unionByName(lines.limit(50)).coalesce(1).write.mode("append").parquet(folder)
    want = batch_answer(lines.unionByName(late), part)
    assert rows(monthly.run_available(spark, folder, part, 1)) == want and want[0][0] == "1990-01"


def test_sibling_table_and_rewritten_table(spark, tmp_path):
    part = read_table(spark, SMOKE, "part", monthly.PART_COLUMNS)
    lines = read_table(spark, SMOKE, "lineitem", monthly.LINE_COLUMNS)
    half = lines.filter("l_orderkey % 2 = 0")
    half.coalesce(1).write.parquet(str(tmp_path / "out"))
    one = str(tmp_path / "lineitem.parquet")
    piece = next(x for x in os.listdir(tmp_path / "out") if x.endswith(".parquet"))
    shutil.copy(f"{SMOKE}/lineitem.parquet", one)
    shutil.copy(f"{SMOKE}/lineitem.parquet", str(tmp_path / "lineitem_old.parquet"))
    assert rows(monthly.run_available(spark, one, part)) == batch_answer(lines, part)
    os.chmod(one, 0o644)
    shutil.copy(str(tmp_path / "out" / piece), one)
    os.utime(one, (2_000_000_000, 2_000_000_000 + random.randint(1, 9)))
    assert rows(monthly.run_available(spark, one, part)) == batch_answer(half, part)


def test_registered_query_uses_several_batches(spark):
    from shelfmark.registry import QUERIES
    got = QUERIES["x1_stream_monthly"](spark, SMOKE)
    want = QUERIES["k12_monthly"](spark, SMOKE)
    key = lambda df: sorted(map(repr, (tuple(r[c] for c in ("date", "revenue", "profit", "quantity", "orders")) for r in df.collect())))
    assert key(got) == key(want)


def test_repeated_rows_are_dropped_by_a_join_alone(spark, tmp_path, monkeypatch):
    from shelfmark.sources.model import sale_lines, sales
    lines = read_table(spark, SMOKE, "lineitem", monthly.LINE_COLUMNS)
    part = read_table(spark, SMOKE, "part", monthly.PART_COLUMNS)
    undated = lines.limit(5).withColumn("l_shipdate", F.lit(None).cast(lines.schema["l_shipdate"].dataType))
    pieces = spark.createDataFrame(lines.limit(40).unionByName(undated).collect(), lines.schema)
    folder = str(tmp_path / "lines")
    for _ in range(2):
        pieces.coalesce(1).write.mode("append").parquet(folder)

    def refused(*_):
        raise AssertionError("a second distinct over the batch")

    t = monthly.monthly_sums(sales(sale_lines(pieces).distinct(), part)).collect()
    want = [(r.date, float(r.revenue), float(r.profit), r.quantity, r.orders) for r in t]
    monkeypatch.setattr(type(lines), "subtract", refused)
    key = lambda x: sorted(map(repr, x))  # noqa: E731  (a null month)
    got = monthly.run_available(spark, folder, part, 1).collect()
    assert key((r.date, r.revenue, r.profit, r.quantity, r.orders) for r in got) == key(want)


def test_sales_without_a_price_take_the_median_of_the_whole_history(spark, tmp_path):
    """x1_stream_monthly fills missing prices (T2) like K12, also when later batches move the median."""
    import datetime
    from statistics import median
    day, late = datetime.date(2024, 1, 5), datetime.date(2024, 2, 5)
    schema = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
              "l_extendedprice double, l_discount double, l_shipdate date")
    part = spark.createDataFrame([(p, "n", "PROMO", 1, 10.0) for p in (7, 8, 9)],
                                 "p_partkey long, p_name string, p_type string, p_size int, p_retailprice double")
    batches = [
        # No price: the list price or the discount is missing, or nothing was sold (counts as an order without revenue).
        [(1, 1, 7, 1, 2.0, None, 0.0, day), (2, 1, 7, 1, 3.0, 60.0, None, late), (3, 1, 7, 1, 0.0, 0.0, 0.0, day), (4, 1, 7, 1, 1.0, 10.0, 0.0, day)],
        [(1, 1, 7, 1, 2.0, None, 0.0, day), (5, 1, 7, 1, 1.0, 30.0, 0.0, day), (6, 1, 8, 1, 5.0, 100.0, 0.1, late),
         (7, 1, 9, 1, 4.0, None, 0.0, day), (8, 1, 7, 1, None, 5.0, 0.0, day), (9, 1, None, 1, 1.0, None, 0.0, day)],  # never a price; no quantity; no product
        [(10, 1, 7, 1, 2.0, 100.0, 0.0, late), (10, 1, 7, 1, 2.0, 100.0, 0.0, late), (11, 1, 7, 1, 1.0, 99.99, 0.5, late), (12, 1, 8, 1, 1.0, None, 0.0, None)],
    ]

    def want(lines):
        known, out = {}, {}
        rows = list(dict.fromkeys(lines))
        price = {r: round(r[5] / r[4] * (1 - r[6]) + 1e-9, 2) if r[4] and r[5] is not None and r[6] is not None else None for r in rows}
        for r in rows:
            if price[r] is not None:
                known.setdefault(r[2], []).append(price[r])
        for r in rows:
            p = price[r] if price[r] is not None else round(median(known[r[2]]) + 1e-9, 2) if r[2] in known else None
            if p is None or r[4] is None:
                continue
            cost = {0: 3.5, 1: 4.0, 2: 4.5}[r[2] % 7]
            o = out.setdefault(r[7] and r[7].strftime("%Y-%m"), [0.0, 0.0, 0, 0])
            for i, x in enumerate((p * r[4], (p - cost) * r[4], int(r[4]), 1)):
                o[i] += x
        return sorted((repr((k, round(a, 2), round(b, 2), q, n)) for k, (a, b, q, n) in out.items()))

    folder, seen, answers = str(tmp_path / "lines"), [], []
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(folder)
        seen += b
        got = sorted(repr(tuple(r)) for r in monthly.run_available(spark, folder, part, 1).collect())
        assert got == want(seen)
        answers.append(got)
    assert len({*map(str, answers)}) == len(batches)
    # All in one go: the same answer, and that of the sums over the whole history.
    again = str(tmp_path / "again")
    for b in reversed(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(again)
    assert sorted(repr(tuple(r)) for r in monthly.run_available(spark, again, part, 1).collect()) == want(seen)
    from shelfmark.sources.model import sale_lines, sales
    whole = monthly.monthly_sums(sales(sale_lines(spark.createDataFrame(seen, schema)).distinct(), part)).collect()
    assert sorted(repr((r.date, float(r.revenue), float(r.profit), r.quantity, r.orders)) for r in whole) == want(seen)
