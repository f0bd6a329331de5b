import random

import pandas as pd
from pyspark.sql import functions as F

from shelfmark.functions import labels
from shelfmark.operators import insight


def test_recommendation_labels(spark):
    df = spark.createDataFrame([(v,) for v in [1.99, 2.0, 9.99, 10.0, 25.0, 40.0]], "d double")
    got = [r[0] for r in df.select(labels.recommendation_label(F.col("d"))).collect()]
    assert got == ["No Change", "Mild Markdown", "Mild Markdown", "Moderate Markdown",
                   "Deep Markdown", "Clearance Sale"]


def test_discount_bands(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 0.5, 10.0, 10.5, 30.0, 31.0, None]], "d double")
    got = [r[0] for r in df.select(labels.discount_band(F.col("d"))).collect()]
    assert got == ["No Discount", "1-10%", "1-10%", "11-20%", "21-30%", "31%+", "31%+"]


def test_classification_limits(spark):
    df = spark.createDataFrame([(v,) for v in [-0.8, -1.2, -1.2001, -0.7999]], "e double")
    got = [r[0] for r in df.select(labels.classify_elasticity(F.col("e"))).collect()]
    assert got == ["unit_elastic", "unit_elastic", "elastic", "inelastic"]


def test_average_tie_rank(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 1, 1, 2, 2])], "id int, v double")
    got = {r.id: r.pct_rank for r in insight.pct_rank(df, "v").collect()}
    assert [got[i] for i in range(5)] == [0.4, 0.4, 0.4, 0.9, 0.9]


def test_rank_matches_pandas(spark):
    rnd = random.Random(7)
    vals = [float(rnd.randint(0, 40)) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(vals)), "id int, v double")
    got = {r.id: r.pct_rank for r in insight.pct_rank(df, "v").collect()}
    want = pd.Series(vals).rank(pct=True)
    assert all(abs(got[i] - want[i]) < 1e-12 for i in range(len(vals)))


def test_money_text(spark):
    df = spark.createDataFrame([(1234567.0,), (-999.4,), (123.0,), (25000000.0,), (None,)], "n double")
    rows = df.select(insight.money_text(F.col("n")).alias("a"),
                     insight.money_text(F.col("n"), compact=True).alias("b")).collect()
    assert rows[0].a == "₹12,34,567" and rows[0].b == "₹12.35 L"
    assert rows[1].a == "₹-999"
    assert rows[2].a == "₹123"
    assert rows[3].b == "₹2.50 Cr"
    assert rows[4].a == "—"


def test_truncate(spark):
    df = spark.createDataFrame([("abcdefghij",), ("abc",)], "s string")
    got = [r[0] for r in df.select(insight.truncate_text(F.col("s"), 5)).collect()]
    assert got == ["abcd…", "abc"]
