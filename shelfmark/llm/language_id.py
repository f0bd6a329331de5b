"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are counts of character 1- to 3-grams of the lower-cased text, hashed
to 2^15 cells, damped by log(1 + n), weighted by inverse document frequency and
scaled to unit length.  Document frequencies count every document the model may
learn from.  Weights are learnt by follow-the-regularised-leader (FTRL-proximal)
with elastic net: the L1 part keeps cells without evidence at exactly zero.  A
part of the sample that FTRL never sees fixes one temperature by its likelihood,
so that scores are calibrated probabilities.

Only rows with a language and outside the held-out fold are learnt from.  The
gradient steps see a bounded sample of them, at most `max_rows` (smallest
hashes of the id, 4,000 by default); document frequencies cover all.  Every
document is predicted from its whole text.

Defined results: null texts and texts without a letter give `und` with score 0;
without any row to learn from every text gives `und`; ties go to the smaller
language; repeated rows get equal predictions (and weigh as often in the
frequencies); null ids are held out; an empty table gives an empty result.
Only id, text and language are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import bounded_batches, documents, fold

CELLS = 1 << 15
MAX_ROWS = 4_000
CALIBRATION_PART = 5  # every fifth sampled row
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
UNKNOWN = "und"
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the 1- to 3-grams of a text and their counts."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    h, found = np.zeros(len(c), np.uint32), []
    for n in range(3):
        if len(c) <= n:
            break
        h = (h[: len(c) - n] ^ c[n:]) * _MIX[n]
        h ^= h >> np.uint32(15)
        found.append((h * _MIX[0]) >> np.uint32(32 - CELLS.bit_length() + 1))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    counts = np.bincount(np.concatenate(found), minlength=CELLS) if len(c) > 200 else None
    if counts is None:
        return np.unique(np.concatenate(found).astype(np.int64), return_counts=True)
    cells = np.flatnonzero(counts)
    return cells, counts[cells]


def weighted(cells: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of unit length."""
    v = np.log1p(counts) * idf[cells]
    return v / max(1e-12, float(np.sqrt(v @ v)))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (cells x classes) by FTRL-proximal with elastic net."""
    z, n = np.zeros((CELLS, classes)), np.zeros((CELLS, classes))

    def weights(at) -> np.ndarray:
        zi = z[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(epochs):
        for (cells, v), y in zip(rows, label, strict=True):
            w = weights(cells)
            p = _softmax(v @ w)
            p[y] -= 1
            g = v[:, None] * p
            sigma = (np.sqrt(n[cells] + g * g) - np.sqrt(n[cells])) / ALPHA
            z[cells] += g - sigma * w
            n[cells] += g * g
    return weights(slice(None))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, label: np.ndarray) -> float:
    """Temperature of the greatest likelihood, by golden section on its logarithm."""
    if not len(label):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))
        return float(-np.log(np.maximum(p[np.arange(len(label)), label], 1e-12)).mean())

    a, b, r = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        x, y = b - r * (b - a), a + r * (b - a)
        a, b = (a, y) if loss(x) <= loss(y) else (x, b)
    return float(np.exp((a + b) / 2))


def _learnable(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.filter((fold(F.col(id_col)) != 0) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: documents per cell, and all documents in cell -1."""
    seen, total = np.zeros(CELLS, np.int64), 0
    for b in batches:
        for t in b["_text"].to_pylist():
            seen[ngrams(t)[0]] += 1
            total += 1
    cells = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(cells, -1)), pa.array(np.append(seen[cells], total))], names=["cell", "n"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [ngrams(t) for t in b["_text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b["_lang"], pa.array([c for c, _ in found], pa.list_(pa.int32())), pa.array([n for _, n in found], pa.list_(pa.int32()))],
            names=["lang", "cells", "counts"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS) -> dict | None:
    """Model from the learnable rows; None where there are none."""
    bounded_batches(docs.sparkSession)
    rows = _learnable(docs, id_col, text_col, lang_col)
    text = F.col(text_col).alias("_text")
    df = rows.select(text).mapInArrow(_frequencies, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(CELLS)
    real = df["cell"] >= 0
    seen[df["cell"][real]] = df["n"][real]
    total = int(df["n"][~real].sum())
    if not total:
        return None
    idf = np.log((1 + total) / (1 + seen)) + 1
    # Ids are few bytes, so the sample is chosen among ids before any text is moved.
    chosen = rows.select(F.col(id_col).alias("_id")).distinct().orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    sample = (rows.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), text).join(F.broadcast(chosen), "_id")
              .orderBy(F.xxhash64("_id"), "_id", "_lang", F.xxhash64("_text")).limit(max_rows).select("_lang", "_text")
              .mapInArrow(_vectors, "lang string, cells array<int>, counts array<int>").toPandas())
    langs = sorted(sample["lang"].unique())
    label = sample["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
    x = [(np.asarray(c, np.int64), weighted(np.asarray(c, np.int64), np.asarray(n), idf)) for c, n in zip(sample["cells"], sample["counts"], strict=True)]
    held = np.arange(len(x)) % CALIBRATION_PART == CALIBRATION_PART - 1
    w = ftrl([r for r, h in zip(x, held, strict=True) if not h], label[~held], len(langs))
    logits = np.array([v @ w[c] for (c, v), h in zip(x, held, strict=True) if h]).reshape(-1, len(langs))
    return {"langs": langs, "idf": idf, "w": w, "t": temperature(logits, label[held])}


def predict(model: dict | None, text: str | None) -> tuple[str, float]:
    """Language and calibrated probability of one text."""
    if model is None or not has_letter(text):
        return UNKNOWN, 0.0
    cells, counts = ngrams(text)
    p = _softmax(weighted(cells, counts, model["idf"]) @ model["w"][cells] / model["t"])
    best = int(p.argmax())
    return model["langs"][best], float(p[best])


def language(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    spark = docs.sparkSession
    bounded_batches(spark)
    # Bounded by the number of cells and languages (some MB).
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("_id"), fold(F.col(id_col)).alias("_fold"), F.col(text_col).alias("_text"))
    out = T.StructType([T.StructField("doc_id", rows.schema["_id"].dataType), T.StructField("held_out", T.BooleanType()),
                        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [predict(shared.value, t) for t in b["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["_id"], pa.array(b["_fold"].to_numpy() == 0), pa.array([x for x, _ in found], pa.string()),
                                              pa.array([s for _, s in found], pa.float64())], names=out.names)

    return rows.mapInArrow(run, out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: language of every document, learnt from the rows outside the held-out fold."""
    docs = documents(spark, sf_dir)
    return language(docs, train(docs))
