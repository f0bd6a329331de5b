"""Periodic run detection: online dyadic square catching over the words of a text.

Words are appended one by one.  For every level m, each completed block of 2^m
words leaves a catcher at the first word behind it (its anchor e, a multiple of
2^m).  The catcher looks for squares whose left root covers e and whose root
length q lies in [2^m, 2^(m+1)): every root that long covers such an anchor,
and a word k can meet the anchor at offset q of one block per level only.

1. When the appended word equals the word of a level's anchor, a comparison with
   offset q = k - e starts: the suffixes that end before e and before k give how
   far it reaches back; what is missing to q words must follow.
2. A comparison advances when the text has grown by twice as much as before, or by
   exactly what is missing: the new words are compared with those q earlier.
   A mismatch ends it; when back + forward = q, a square has been caught.
3. A caught square opens a stretch of period q, which each further word with the
   same word q before it extends; squares that follow merge into this one run.
   An offset that is a multiple of an open stretch's period, inside that stretch,
   finds nothing new and isn't compared (the maximal stretch of both is the same).

So every maximal stretch of at least two periods is found once, with its smallest
period, when its first square is complete.  The comparisons of a level live for
at most two of its blocks.  The operator reports the stretches with
length >= max(min_length, min_exponent * period).

Defined results: null, empty and blank texts have no words and no runs, their
collapsed text is empty; a null id is kept; repeated rows are treated like any
other, each with its own row; an empty table gives an empty result; extra columns
are not read.  Texts are processed whole whatever their length, one row at a time.
Ties in exponent go to the smaller start, then to the smaller period.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfmark.llm.common import bounded_batches, documents

MIN_LENGTH = 24
MIN_EXPONENT = 3

Run = tuple[int, int, int]  # start, length, period
Rewrite = Callable[[list[bytes], int | None], list[bytes]]


class SquareCatcher:
    """Maximal stretches with at least `min_exponent` periods and `min_length` words; `append` words, then `finish`."""

    def __init__(self, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> None:
        self.min_length, self.min_exponent = min_length, min_exponent
        self.codes: dict[bytes, int] = {}
        self.words = array("I")
        self.anchors: list[int] = []  # word code at the anchor of each level
        self.watch: dict[int, list[int]] = {}  # word code -> levels whose anchor holds it
        self.open: dict[int, int] = {}  # period -> start of the stretch that reaches the last word
        self.due: dict[int, list[tuple[int, int, int, int]]] = {}  # position -> (start, offset, matched end, goal)
        self.runs: list[Run] = []

    def append(self, word: bytes) -> None:
        w, k = self.words, len(self.words)
        code = self.codes.setdefault(word, len(self.codes))
        w.append(code)
        if self.open:
            for q in [q for q in self.open if w[k - q] != code]:
                self._close(q, k)
        if k in self.due:
            for start, q, done, goal in self.due.pop(k):
                if w[done:k + 1] == w[done - q:k + 1 - q]:
                    self._advance(start, q, k, goal)
        if k:
            self._move_anchors(k)
            for level in self.watch.get(code, ()):
                self._compare(((k >> level) - 1) << level, k)

    def finish(self) -> list[Run]:
        """All runs, by start and then by period."""
        for q in list(self.open):
            self._close(q, len(self.words))
        return sorted(self.runs, key=lambda r: (r[0], r[2]))

    def _move_anchors(self, k: int) -> None:
        """Word k opens a new block on every level whose block length divides k: the anchors there move on."""
        level = 0
        while k >> level and k & ((1 << level) - 1) == 0:
            code = self.words[((k >> level) - 1) << level]
            if level == len(self.anchors):
                self.anchors.append(code)
            else:
                old = self.anchors[level]
                if old == code:
                    level += 1
                    continue
                levels = self.watch[old]
                levels.remove(level)
                if not levels:
                    del self.watch[old]
                self.anchors[level] = code
            levels = self.watch.setdefault(code, [])
            levels.append(level)
            levels.sort()
            level += 1

    def _compare(self, e: int, k: int) -> None:
        """Start the comparison of the suffixes at anchor e and at word k."""
        q = k - e
        for period, start in self.open.items():
            if q % period == 0 and start <= e:
                return
        start = e - self._back(e, k, q - 1)
        self._advance(start, q, k, start + 2 * q - 1)

    def _back(self, e: int, k: int, most: int) -> int:
        """Equal words directly before e and before k, at most `most` (more would have been a square before)."""
        w, most = self.words, min(most, e)
        same, step = 0, 1
        while same < most:
            step = min(step, most - same)
            if w[e - same - step:e - same] == w[k - same - step:k - same]:
                same += step
                step *= 2
            elif step == 1:
                break
            else:
                step = max(1, step // 4)
        return same

    def _advance(self, start: int, q: int, k: int, goal: int) -> None:
        """Everything from `start` to k equals the word q later; a square of offset q is complete at word `goal`."""
        if q in self.open:
            return
        if k >= goal:
            self.open[q] = start
        else:
            at = min(goal, k + max(1, k - start - q + 1))
            self.due.setdefault(at, []).append((start, q, k + 1, goal))

    def _close(self, q: int, end: int) -> None:
        start = self.open.pop(q)
        length = end - start
        if length >= self.min_length and length >= self.min_exponent * q:
            self.runs.append((start, length, q))


def runs_of(words: list[bytes], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[Run]:
    """All runs of a word sequence: (start, length, smallest period), by start and period."""
    catcher = SquareCatcher(min_length, min_exponent)
    for w in words:
        catcher.append(w)
    return catcher.finish()


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by one space, without those that repeat the first period of a run."""
    if not runs:
        return b" ".join(words)
    keep, at = [], 0
    for a, b in sorted((s + q, s + n) for s, n, q in runs):
        keep += words[at:a]
        at = max(at, b)
    return b" ".join(keep + words[at:])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT, rewrite: Rewrite | None = None) -> DataFrame:
    """One row per document: id, `runs` (start, length, period), `collapsed` text.

    `rewrite` may change the words before the search (it gets the words and the id).
    """
    bounded_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    run_type = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    out = T.StructType([T.StructField(id_col, id_type), T.StructField("runs", T.ArrayType(run_type)), T.StructField("collapsed", T.BinaryType())])

    schema = to_arrow_schema(out)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts = [], []
            for i, text in zip(batch[0], batch[1]):
                words = (text.as_py() or b"").split()  # at 0x20 and 0x09-0x0D
                if rewrite:
                    words = rewrite(words, i.as_py())
                runs = runs_of(words, min_length, min_exponent)
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                texts.append(collapse(words, runs))
            yield pa.record_batch([batch[0], pa.array(found, schema.field(1).type), pa.array(texts, schema.field(2).type)], schema=schema)

    rows = docs.select(id_col, F.col(text_col).cast("binary").alias("_text")).mapInArrow(search, out)
    return rows.withColumn("collapsed", F.col("collapsed").cast("string"))


def repeat_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Of documents chosen by the crc32 of their id, the words from a place on repeat with a period (none for a null id)."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _text_of(runs: Column) -> Column:
    lines = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return F.array_join(lines, "")


def _strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; the first one (by start, then period) on ties."""
    return F.aggregate(runs, F.get(runs, F.lit(0)),
                       lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, strongest run and hashes of `find_runs`' rows."""
    best = F.when(F.size("runs") > 0, _strongest(F.col("runs")))
    return found.withColumn("_best", best).select(
        id_col, F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(_text_of(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: runs of every document of the table, some with repeated tails, as the contract states."""
    return digests(find_runs(documents(spark, sf_dir), rewrite=repeat_tail))
