"""Quality classifier by Bradley-Terry ranking of labelled documents.

A document is a vector of surface features of its whole text (shares of
symbols, capitals, digits, marks and bars; repetition of words, word pairs and
lines; lengths).  Training pairs are preferences: a document labelled 1 is
preferred to one labelled 0.  The probability of a preference is the logistic
function of the difference of two scores, scores are linear in the features, so
the fit is a logistic regression on feature differences without intercept
(Newton steps to convergence, ridge penalty).  The raw scores are then cut at the
quantile of the training scores that corresponds to the share of label 0, shifted
so that this cut has score 0.3 after the logistic function.

All rows with a label and outside the held-out fold are learnt from, and every pair
of a row labelled 1 and a row labelled 0 counts.  The pairs are not made: scores lie in
boxes of width 1, and there the logistic function of a difference is a sum of products
of Chebyshev polynomials of the two scores, exact to rounding (about 1e-15).  So sums over
pairs follow from each box's sums over rows: a Newton step costs two passes over the
rows, whose vectors are written once, and the driver sees the boxes' sums only.  Sums are
taken in integers (values times a power of two), so no order of rows changes a digit.
Every document is scored.

Defined results: null text counts as empty; an empty text is scored by its
(zero) features; without both labels in the training rows every score is 0.5;
repeated rows get equal scores; null ids are held out and scored; a repeated
label row counts once with the smallest label; raw scores equal to the cut are
predicted 1; very long texts are read whole, one at a time; an empty table gives
an empty result.  Only id and text are read, of the labels id and quality.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import bounded_batches, documents, drop_table, fold, materialise
from shelfmark.sources.tables import read_table

RIDGE = 1e-3
CUT_SCORE = 0.3
MAX_STEPS = 100  # far beyond what Newton steps need (about ten)
TERMS = 14  # Chebyshev polynomials per box
FAR = 45  # boxes apart: the logistic function is 0 or 1 to the last digit
BLOCK = 8_192  # rows whose products a task holds at once

# Rows (features, label) of a block -> keys and values, whose sums and maxima over all blocks are wanted.
BlockFn = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
# Such a function -> sorted keys, sums, maxima.
Totals = Callable[[BlockFn], tuple[np.ndarray, np.ndarray, np.ndarray]]

FEATURES = ("log_words", "symbols", "bars", "marks", "shouts", "digits", "capitals", "capital_words", "word_length", "long_words",
            "distinct_words", "distinct_pairs", "twins", "top_word", "lines", "repeated_lines", "any_symbols", "any_bars", "any_shouts", "any_twins")


def features(text: str | None) -> list[float]:
    """Feature vector of one text."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    digits = counts[48:58].sum()
    bars = counts[124]
    symbols = sum(int(counts[c]) for c in b"#*$%&<>")
    shouts = counts[33]
    marks = sum(int(counts[c]) for c in b".,;:?\"'()-")
    code: dict[bytes, int] = {}
    ids = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, n)
    twins = int((ids[1:] == ids[:-1]).sum())
    pairs = len(np.unique(ids[1:] * len(code) + ids[:-1]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    top = int(np.bincount(ids).max())
    # Words that are all capitals and longer than two bytes.
    capital_words = sum(w.isupper() for w in words if len(w) > 2)
    return [
        np.log1p(n), symbols / n, bars / n, marks / n, shouts / n, digits / n, upper / max(1, upper + lower), capital_words / n,
        float(lengths.mean()), float((lengths > 20).mean()), len(code) / n ** 0.8, pairs / max(1, n - 1), twins / n, top / n,
        len(lines) / n, 1 - len(set(lines)) / len(lines),
        float(symbols > 0.02 * n), float(bars > 0.02 * n), float(shouts > 0.02 * n), float(twins > 0.02 * n),
    ]


def _totals_here(x: np.ndarray, label: np.ndarray) -> Totals:
    """Sums over rows in memory."""
    def totals(of: BlockFn) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = [of(x[i: i + BLOCK], label[i: i + BLOCK]) for i in range(0, len(x), BLOCK)]
        keys, at = np.unique(np.concatenate([k for k, _ in parts] or [np.zeros(0, np.int64)]), return_inverse=True)
        values = np.concatenate([v for _, v in parts] or [np.zeros(0, np.int64)])
        sums, most = np.zeros(len(keys), np.int64), np.full(len(keys), np.iinfo(np.int64).min)
        np.add.at(sums, at, values)
        np.maximum.at(most, at, values)
        return keys, sums, most
    return totals


def _totals_in_tasks(rows: DataFrame) -> Totals:
    """Sums over the rows (label, x) of a table; one row per key reaches the driver."""
    def totals(of: BlockFn) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x, label in _blocks(batches):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in of(x, label)], names=["k", "v"])

        got = rows.mapInArrow(run, "k long, v long").groupBy("k").agg(F.sum("v").alias("s"), F.max("v").alias("m")).toArrow()
        keys, sums, most = (got[c].to_numpy() for c in ("k", "s", "m"))
        order = np.argsort(keys)
        return keys[order], sums[order], most[order]
    return totals


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of some `BLOCK` rows at a time."""
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append((b["x"].flatten().to_numpy().reshape(-1, len(FEATURES)), b["label"].to_numpy()))
            n += b.num_rows
        if n >= BLOCK:
            yield np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])
            held, n = [], 0
    if held:
        yield np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])


def _whole(values: np.ndarray, bits: int) -> np.ndarray:
    """Values as integers, in units of 2^-bits."""
    return np.rint(values * 2.0 ** bits).astype(np.int64)


def _raw(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    return ((x - mean) / scale * w).sum(1)  # row by row, so that batches don't matter


def _polynomials(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Box of each score and the Chebyshev polynomials of its place in the box."""
    box = np.floor(raw)
    t = 2 * (raw - box) - 1
    out = np.empty((len(raw), TERMS))
    out[:, 0], out[:, 1] = 1, t
    for k in range(2, TERMS):
        out[:, k] = 2 * t * out[:, k - 1] - out[:, k - 2]
    return box.astype(np.int64), out


def _expansions() -> tuple[np.ndarray, np.ndarray]:
    """Coefficients [boxes apart + FAR, k, l] of the logistic function of a score minus another
    and of its derivative, for polynomial k of the other score and l of the first one."""
    angle = (np.arange(TERMS) + 0.5) * np.pi / TERMS
    place = (np.cos(angle) + 1) / 2
    change = 2 / TERMS * np.cos(np.arange(TERMS)[:, None] * angle)
    change[0] /= 2
    t = np.arange(-FAR, FAR + 1)[:, None, None] + place[None, None, :] - place[None, :, None]
    p, rest = 1 / (1 + np.exp(-t)), 1 / (1 + np.exp(t))
    return tuple(change @ f @ change.T for f in (p, p * rest))


def _newton(totals: Totals, mean: np.ndarray, scale: np.ndarray, n: tuple[int, int], ridge: float) -> np.ndarray:
    """Weights that minimise the mean loss over all n[0] x n[1] pairs (label 0, label 1) plus the ridge penalty."""
    d, bits = len(mean), 61 - sum(n).bit_length()
    step_at, slope_at = _expansions()
    cells = TERMS * (1 + d)
    upper = np.triu_indices(d)

    def moments(w: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per label: boxes, and their sums [box, polynomial, 1 and the standardised features]."""
        def of(x: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            box, poly = _polynomials(_raw(x, mean, scale, w))
            wide = np.concatenate([np.ones((len(x), 1)), (x - mean) / scale], 1)
            group = 2 * box + (label == 1)
            order = np.argsort(group, kind="stable")
            first, at = np.unique(group[order], return_index=True)
            made = _whole((poly[:, :, None] * wide[:, None, :]).reshape(len(x), cells)[order], bits)
            return (first[:, None] * cells + np.arange(cells)).ravel(), np.add.reduceat(made, at, axis=0).ravel()

        keys, sums, _ = totals(of)
        group, value = keys[::cells] // cells, (sums / 2.0 ** bits).reshape(-1, TERMS, 1 + d)
        return [(group[group % 2 == y] // 2, value[group % 2 == y]) for y in (0, 1)]

    def hessian_parts(w: np.ndarray, boxes: list[np.ndarray], slopes: list[np.ndarray]) -> np.ndarray:
        """Sum over rows of features x features, times the row's mean slope over the rows of the other label."""
        def of(x: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            box, poly = _polynomials(_raw(x, mean, scale, w))
            z = (x - mean) / scale
            pairs = z[:, upper[0]] * z[:, upper[1]]
            keys, values = [], []
            for y in (0, 1):
                mine = label == y
                if mine.any():
                    slope = (poly[mine] * slopes[y][np.searchsorted(boxes[y], box[mine])]).sum(1)
                    keys.append(np.arange(len(upper[0])) + y * len(upper[0]))
                    values.append(_whole(slope[:, None] * pairs[mine], bits).sum(0))
            return np.concatenate(keys), np.concatenate(values)

        sums = (totals(of)[1] / 2.0 ** bits).reshape(2, -1)
        out = np.zeros((d, d))
        out[upper] = sums[0] / n[0] + sums[1] / n[1]
        return out + np.triu(out, 1).T

    def gradient(w: np.ndarray) -> tuple[np.ndarray, Callable[[], np.ndarray]]:
        """Gradient at w, and a function that gives the second derivatives there."""
        (low, bad), (high, good) = moments(w)
        # Per box: sums over the other label of the logistic function and of its slope, as coefficients.
        step = [np.zeros((len(low), TERMS)), np.zeros((len(high), TERMS))]
        slope = [np.zeros((len(low), TERMS)), np.zeros((len(high), TERMS))]
        cross = np.zeros((d, d))
        for i, at in enumerate(high):
            apart = low - at
            near = np.abs(apart) <= FAR
            step[1][i] = np.einsum("bkl,bl->k", step_at[apart[near] + FAR], bad[near, :, 0])
            step[1][i, 0] += bad[apart > FAR, 0, 0].sum()
            wide = np.einsum("bkl,bla->ka", slope_at[apart[near] + FAR], bad[near])
            slope[1][i] = wide[:, 0]
            cross += good[i, :, 1:].T @ wide[:, 1:]
        for j, at in enumerate(low):
            apart = at - high
            near = np.abs(apart) <= FAR
            step[0][j] = np.einsum("bkl,bk->l", step_at[apart[near] + FAR], good[near, :, 0])
            step[0][j, 0] += good[apart > FAR, 0, 0].sum()
            slope[0][j] = np.einsum("bkl,bk->l", slope_at[apart[near] + FAR], good[near, :, 0])
        pairs = n[0] * n[1]
        grad = ridge * w - (np.einsum("bk,bka->a", step[1], good[:, :, 1:]) - np.einsum("bk,bka->a", step[0], bad[:, :, 1:])) / pairs

        def hessian() -> np.ndarray:
            both = hessian_parts(w, [low, high], [slope[0] / n[1], slope[1] / n[0]])
            return ridge * np.eye(d) + both - (cross + cross.T) / pairs

        return grad, hessian

    w = np.zeros(d)
    grad, hessian = gradient(w)
    for _ in range(MAX_STEPS):
        move = np.linalg.solve(hessian(), grad)
        if np.abs(move).max() < 1e-6:
            return w - move
        ahead, hessian = gradient(w - move)
        while ahead @ move < -0.9 * (grad @ move) and np.abs(move).max() >= 1e-6:  # far beyond the lowest point on the way
            move = move / 2
            ahead, hessian = gradient(w - move)
        w, grad = w - move, ahead
    return w


def _at_positions(totals: Totals, raw: Callable[[np.ndarray], np.ndarray], positions: list[int]) -> list[float]:
    """The values at these places (from 0) of the sorted raw scores, found digit by digit of 16 bits."""
    def ordered(x: np.ndarray) -> np.ndarray:
        bits = (raw(x) + 0.0).view(np.int64)
        return bits ^ ((bits >> 63) & np.int64(2 ** 63 - 1))  # integers in the order of the numbers

    left, prefix = list(positions), [0] * len(positions)
    for shift in (48, 32, 16, 0):
        def of(x: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            v = ordered(x)
            if shift < 48:
                v = v[np.isin(v >> (shift + 16), prefix)]
            return np.unique(v >> shift, return_counts=True)

        keys, counts, _ = totals(of)
        for i in range(len(left)):
            mine = keys >> 16 == prefix[i] if shift < 48 else np.ones(len(keys), bool)
            up_to = np.cumsum(counts[mine])
            k = int(np.searchsorted(up_to, left[i], side="right"))
            left[i] -= int(up_to[k - 1]) if k else 0
            prefix[i] = int(keys[mine][k])
    bits = np.array(prefix, np.int64)
    return [*(bits ^ ((bits >> 63) & np.int64(2 ** 63 - 1))).view(np.float64)]


def _fit(totals: Totals, d: int, ridge: float) -> dict | None:
    """Model from sums over the training rows; None without both labels."""
    def sizes(x: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.arange(d + 2), np.concatenate([np.frexp(np.abs(x).max(0))[1], [(label == 0).sum(), (label == 1).sum()]]).astype(np.int64)

    _, sums, most = totals(sizes)
    n = tuple(int(c) for c in sums[d:])
    if not n or not all(n):
        return None
    bits, unit = 61 - sum(n).bit_length(), 2.0 ** most[:d]  # no feature exceeds its unit

    def mean_of(value: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        return totals(lambda x, label: (np.arange(d), _whole(value(x), bits).sum(0)))[1] / 2.0 ** bits / sum(n)

    mean = unit * mean_of(lambda x: x / unit)
    scale = 2 * unit * np.sqrt(mean_of(lambda x: ((x - mean) / (2 * unit)) ** 2)) + 1e-9
    w = _newton(totals, mean, scale, n, ridge)
    place = (sum(n) - 1) * (n[0] / sum(n))
    around = _at_positions(totals, lambda x: _raw(x, mean, scale, w), [int(np.floor(place)), int(np.ceil(place))])
    return {"mean": mean, "scale": scale, "w": w, "cut": float(np.quantile(around, place % 1))}


def fit(x: np.ndarray, label: np.ndarray, ridge: float = RIDGE) -> dict | None:
    """Weights by Bradley-Terry on all preference pairs, and the cut; None without both labels."""
    return _fit(_totals_here(x, label), x.shape[1], ridge)


def scores(model: dict | None, x: np.ndarray) -> np.ndarray:
    """Score in (0, 1); the cut has CUT_SCORE."""
    if model is None:
        return np.full(len(x), 0.5)
    raw = _raw(x, model["mean"], model["scale"], model["w"]) - model["cut"]
    return 1 / (1 + np.exp(-np.clip(raw + np.log(CUT_SCORE / (1 - CUT_SCORE)), -30, 30)))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [features(t) for t in b["_text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["_id"], b["_fold"], pa.array(x, pa.list_(pa.float64()))], names=["_id", "_fold", "x"])


def vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, fold and features of every document."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), fold(F.col(id_col)).alias("_fold"), F.col(text_col).alias("_text"))
    kind = T.StructType([rows.schema["_id"], T.StructField("_fold", T.LongType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(_feature_batches, kind)


def learnt(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_rows: int | None = None) -> dict | None:
    """Model from the `vectors` with a label and outside the held-out fold."""
    known = (labels.filter(F.col(label_col).isin(0, 1) & (fold(F.col(id_col)) != 0))
             .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("label")))
    # Vectors are short, so labels of any number may be joined by a shuffle.
    found = rows.filter(F.col("_fold") != 0).join(known, "_id")
    if max_rows is not None:
        got = found.orderBy(F.xxhash64("_id"), "_id", "x").limit(max_rows).select("label", "x").toPandas()
        return fit(np.array(got["x"].tolist(), float), got["label"].to_numpy()) if len(got) else None
    table = materialise(found.select("label", "x"), "quality-rows")
    try:
        return _fit(_totals_in_tasks(table), len(FEATURES), RIDGE)
    finally:
        drop_table(table)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_rows: int | None = None) -> dict | None:
    """Model from all labelled documents outside the held-out fold (or the `max_rows` with the smallest hashes of the id, if given)."""
    return learnt(vectors(docs.filter(fold(F.col(id_col)) != 0), id_col, text_col), labels, id_col, label_col, max_rows)


def quality_scores(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    return scored(vectors(docs, id_col, text_col), model)


def scored(rows: DataFrame, model: dict | None) -> DataFrame:
    """`quality_scores` of documents whose `vectors` these are."""
    out = T.StructType([T.StructField("doc_id", rows.schema["_id"].dataType), T.StructField("held_out", T.BooleanType()),
                        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = scores(model, b["x"].flatten().to_numpy().reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([b["_id"], pa.array(b["_fold"].to_numpy() == 0), pa.array(s), pa.array((s >= CUT_SCORE).astype(np.int32))], names=out.names)

    return rows.mapInArrow(run, out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: quality scores of the whole documents table, learnt from the labels table; features are taken once, for both."""
    rows = materialise(vectors(documents(spark, sf_dir)), "quality-vectors")
    return scored(rows, learnt(rows, read_table(spark, sf_dir, "labels")))
