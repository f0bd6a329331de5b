import numpy as np
import pytest
from corpus_fixtures import SCHEMA, rows_of
from pyspark.sql import functions as F

from shelfmark.llm import language_id, quality_model
from shelfmark.llm.common import crc_fold, fold

SF = "/root/testdata/sf0.01"


def test_fold(spark):
    ids = [None, 0, 1, 7, -3, 123456789012]
    got = spark.createDataFrame([(i,) for i in ids], "x long").select("x", fold(F.col("x")).alias("f")).collect()
    assert {r.x: r.f for r in got} == {i: crc_fold(i) for i in ids}


def test_quality_held_out(spark):
    out = quality_model.query(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = out.join(labels, "doc_id").filter("held_out").toPandas()
    assert len(got) > 50 and (got.predicted == got.quality).mean() >= 0.95
    good, bad = got.score[got.quality == 1].to_numpy(), got.score[got.quality == 0].to_numpy()
    assert (good[:, None] > bad[None]).mean() >= 0.98
    rows = out.collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (crc_fold(r.doc_id) == 0) for r in rows)
    assert rows_of(out) == rows_of(quality_model.query(spark, SF))  # reruns agree


def test_quality_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_model.train(docs, x) for x in (labels, flipped))
    assert np.array_equal(a["w"], b["w"]) and a["cut"] == b["cut"]


def test_bradley_terry_orders_pairs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    label = (x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=400) > 0).astype(int)
    m = quality_model.fit(x, label)
    assert m["w"][0] > 0 > m["w"][1] and abs(m["w"][2]) < 0.3 * m["w"][0]
    s = quality_model.scores(m, x)
    assert ((s >= 0.3).mean() - label.mean()) == pytest.approx(0, abs=0.01)  # the cut is a quantile of the scores
    assert quality_model.fit(x, np.ones(400)) is None


def test_quality_edges(spark, edge_docs, clash_docs, empty_docs, edge_rows):
    labels = spark.createDataFrame([(100, 1, 0), (103, 0, 0), (111, 0, None), (None, 1, 0), (112, None, 0), (103, 0, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")
    for model in (None, quality_model.train(edge_docs, labels), quality_model.train(edge_docs, labels.limit(0))):
        got = rows_of(quality_model.quality_scores(clash_docs, model))
        assert got == rows_of(quality_model.quality_scores(edge_docs, model)) and len(got) == len(edge_rows)
        assert all(0 <= r[2] <= 1 for r in got)
    assert quality_model.train(empty_docs, labels) is None and quality_model.quality_scores(empty_docs, None).count() == 0
    assert quality_model.features(None) == quality_model.features("") == [0.0] * len(quality_model.FEATURES)


def test_language_held_out(spark):
    out = language_id.query(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    got = out.join(docs, "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == 1000 and (held.lang == held.lang_pred).mean() >= 0.97
    assert got.score.between(0, 1).all() and set(got.lang_pred) <= {"de", "en", "es", "fr", "und"}


def test_language_ignores_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.withColumn("lang", F.when(fold(F.col("doc_id")) == 0, "xx").otherwise(F.col("lang"))).withColumn(
        "text", F.when(fold(F.col("doc_id")) == 0, "zzz").otherwise(F.col("text")))
    a, b = language_id.train(docs), language_id.train(changed)
    assert a["langs"] == b["langs"] and np.array_equal(a["w"], b["w"]) and np.array_equal(a["idf"], b["idf"])


def test_language_document_frequencies_cover_all_learnable_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r for r in docs.collect() if crc_fold(r.doc_id) != 0]
    seen = np.zeros(language_id.CELLS)
    for r in rows:
        seen[language_id.ngrams(r.text)[0]] += 1
    model = language_id.train(docs, max_rows=20)
    assert model["idf"] == pytest.approx(np.log((1 + len(rows)) / (1 + seen)) + 1)


def test_ftrl_is_sparse_and_separates():
    rng = np.random.default_rng(3)
    rows, label = [], []
    for i in range(300):
        y = i % 3
        cells = np.unique(np.concatenate([rng.integers(100 * y, 100 * y + 40, 12), rng.integers(5000, 9000, 5)]))
        rows.append((cells, np.full(len(cells), 1 / np.sqrt(len(cells)))))
        label.append(y)
    w = language_id.ftrl(rows, np.array(label), 3)
    assert np.mean([np.argmax(v @ w[c]) == y for (c, v), y in zip(rows, label, strict=True)]) > 0.99
    assert (w == 0).mean() > 0.5 and not w[20_000:].any()


def test_temperature_minimises_loss():
    rng = np.random.default_rng(4)
    logits = 6 * rng.normal(size=(500, 4))
    p = np.exp(logits / 3) / np.exp(logits / 3).sum(1, keepdims=True)
    label = np.array([rng.choice(4, p=q) for q in p])
    assert language_id.temperature(logits, label) == pytest.approx(3, rel=0.15)
    assert language_id.temperature(np.zeros((0, 4)), np.zeros(0, int)) == 1.0


def test_language_edges(spark, edge_docs, clash_docs, empty_docs, edge_rows):
    model = language_id.train(edge_docs)
    got = rows_of(language_id.language(clash_docs, model))
    assert got == rows_of(language_id.language(edge_docs, model)) and len(got) == len(edge_rows)
    none = {r[0] for r in got if r[2] == "und"}
    assert none == {r[0] for r in edge_rows if not any(c.isalpha() for c in r[1] or "")} - {None} | {None}
    assert language_id.train(empty_docs) is None
    assert {r[2] for r in rows_of(language_id.language(edge_docs, None))} == {"und"}
    assert language_id.language(empty_docs, model).count() == 0
    twins = spark.createDataFrame([(i, "same text", "en" if i % 2 else "de", None, None) for i in range(40)], SCHEMA)
    tied = rows_of(language_id.language(twins, language_id.train(twins)))
    assert len({r[2:] for r in tied}) == 1


def test_repeated_ids_do_not_widen_the_fitted_sample(spark, monkeypatch):
    seen = []
    real = quality_model.fit
    monkeypatch.setattr(quality_model, "fit", lambda x, y, *a, **k: (seen.append(len(y)), real(x, y, *a, **k))[1])
    docs = spark.createDataFrame([(i, f"words of text {i} and copy {c}") for i in range(100) for c in range(20)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    first, again = (quality_model.train(docs.repartition(n), labels, max_rows=50) for n in (3, 7))
    assert seen == [50, 50] and np.array_equal(first["w"], again["w"])


def every_pair(x, label, ridge=quality_model.RIDGE):
    """Weights and cut by making all pairs."""
    x, label = np.array(x, float), np.array(label)
    z = (x - x.mean(0)) / (x.std(0) + 1e-9)
    d = (z[label == 1][:, None] - z[label == 0][None]).reshape(-1, x.shape[1])
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(np.clip(d @ w, -700, 700)))
        move = np.linalg.solve(ridge * np.eye(len(w)) + (d * (p * (1 - p))[:, None]).T @ d / len(d), ridge * w - d.T @ p / len(d))
        w = w - move
    return w, np.quantile(z @ w, (label == 0).mean())


def test_quality_fit_counts_every_preference_pair():
    """op7 learns from all pairs, not from twenty opponents a row; also with far apart, tied and constant values."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 4))
    x[:, 3] = 2.5
    label = (x[:, 0] - x[:, 1] + rng.normal(size=500) > 1).astype(int)
    wild = np.round(rng.standard_cauchy((300, 3)), 1)
    for a, y, ridge in ((x, label, quality_model.RIDGE), (wild, (wild[:, 0] + wild[:, 1] > 0).astype(int), 1e-5), (x[:7], np.array([0, 1, 0, 1, 1, 0, 1]), 1e-2)):
        w, cut = every_pair(a, y, ridge)
        m = quality_model.fit(a, y, ridge)
        assert m["w"] == pytest.approx(w, abs=1e-9 * max(1, np.abs(w).max())) and m["cut"] == pytest.approx(cut, rel=1e-7, abs=1e-9)
        order = rng.permutation(len(y))
        again = quality_model.fit(a[order], y[order], ridge)
        assert all(np.array_equal(m[k], again[k]) for k in m)  # no order of rows changes a digit


def test_quality_learns_from_every_labelled_row(spark, monkeypatch):
    """op7 leaves out no row; the sums taken in tasks give the weights of all rows and all pairs."""
    rng = np.random.default_rng(6)
    n = 26_000  # four fifths of them may be learnt from, more than the twenty thousand that were fitted
    x = np.concatenate([rng.normal(size=(n, 3)).round(3), np.zeros((n, len(quality_model.FEATURES) - 3))], 1)
    y = (x[:, 0] + 0.5 * rng.normal(size=n) > 1).astype(int)
    rows = spark.createDataFrame([(i, 1, [float(v) for v in x[i]]) for i in range(n)], "_id long, _fold long, x array<double>")
    ids = [i for i in range(n) if crc_fold(i) != 0]
    labels = spark.createDataFrame([(i, int(y[i])) for i in range(n)], "doc_id long, quality int")
    seen = []
    real = quality_model._newton
    monkeypatch.setattr(quality_model, "_newton", lambda totals, mean, scale, n, ridge: (seen.append(n), real(totals, mean, scale, n, ridge))[1])
    m = quality_model.learnt(rows.repartition(3), labels)
    here = quality_model.fit(x[ids], y[ids])
    assert seen == [(len(ids) - y[ids].sum(), y[ids].sum())] * 2
    assert all(np.array_equal(m[k], here[k]) for k in here)
    everything = quality_model.train(spark.createDataFrame([(i, "ab " * (i % 9)) for i in range(200)], "doc_id long, text string"), labels)
    assert sum(seen[-1]) == sum(crc_fold(i) != 0 for i in range(200)) and everything is not None
