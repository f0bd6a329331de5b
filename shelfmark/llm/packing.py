"""Best-fit packing of token sequences: configuration linear program, multiplicative weights, rounding.

1. Every text is encoded, closed with an end id and, where longer than a
   sequence, cut into pieces.  Each task numbers its pieces per length.
2. Only the histogram of lengths decides the packing, so the program has at most
   `capacity` sizes whatever the number of documents.  Its columns are
   configurations: multisets of lengths that fit one sequence.  The covering
   program  min sum(x)  with  sum(x_c * count_c(s)) >= n_s  is solved by
   multiplicative weights: a size's price is its length (slightly more per place for
   long sizes), lowered exponentially by the share of its pieces covered so far; a knapsack dynamic program over the
   capacity finds the configuration of the highest price; it is used until one of
   its sizes has gained the share `step`.  Prices divided by the best
   configuration's price are feasible for the dual, so every round also gives a
   lower bound on the number of sequences.
3. Rounding: configurations are taken whole times, fullest use first, if they waste
   no more than the bound allows.  What they leave is packed by best fit
   decreasing, on counts as well: one group of equal sequences at a time.
4. The packing is a list of slots (length, first rank, how many a sequence, first
   sequence, offset), at most a few per size and round.  A piece finds its
   place from its rank among the pieces of its length: its number in its task plus
   the pieces of the tasks before.

The driver holds the histogram (at most `capacity` rows) and the slots, tables of
a size that doesn't grow with the documents; pieces never pass through it, and
no task holds more than a batch of them.

Defined results: null and empty texts are one piece, the end id alone; a null id
is kept; repeated rows are packed each for itself; an empty table gives an empty
result; extra columns are not read.  Very long texts are encoded whole; only
documents longer than a sequence are cut.  Equal lengths are placed in the order of
their tasks' input.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfmark.llm.common import bounded_batches, documents, materialise

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
ROUNDS = 400
STEP = 0.5  # share of a size that one round may cover
LEARNING = 0.3  # how fast prices fall with that share
PREMIUM = 0.2  # first prices per place, of the longest size beyond the shortest: long pieces find their fillers early
SLACK = 5e-4  # a configuration may waste this share beyond the dual bound
CACHE = 700_000  # words whose ids a worker keeps
_RANK_BITS = 40

Configuration = tuple[tuple[int, int], ...]  # (length, pieces of it), longest first


class Slot(NamedTuple):
    """Where the pieces of one length with ranks from `first_rank` on go, until the length's next slot."""

    length: int
    first_rank: int
    per_sequence: int
    first_sequence: int
    offset: int


# --- the packing, from the histogram alone ---------------------------------------------


def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best price for every capacity, and the size to take first there (0: leave one place free)."""
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for c in range(int(sizes[0]), capacity + 1):
        k = fitting[c]
        total = best[c - sizes[:k]] + prices[:k]
        i = int(total.argmax())
        best[c] = best[c - 1]
        if total[i] > best[c]:
            best[c], take[c] = total[i], sizes[i]
    return best, take


def _taken(take: np.ndarray, capacity: int) -> Configuration:
    """The configuration that the dynamic program chose."""
    counts: dict[int, int] = {}
    while capacity > 0:
        s = int(take[capacity])
        if s:
            counts[s] = counts.get(s, 0) + 1
        capacity -= s or 1
    return tuple(sorted(counts.items(), reverse=True))


def fractional_cover(histogram: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[dict[Configuration, float], float]:
    """Approximate solution of the configuration program, and a lower bound on its value."""
    sizes = np.flatnonzero(histogram)
    need, covered = histogram.astype(float), np.zeros(len(histogram))
    use: dict[Configuration, float] = {}
    bound = float(histogram @ np.arange(len(histogram))) / capacity  # the dual value of prices in proportion to length
    for _ in range(rounds):
        live = sizes[covered[sizes] < 1 - 1e-9]
        if not len(live):
            break
        prices = live * (1 + PREMIUM * live / capacity) * np.exp(-LEARNING * covered[live])
        best, take = knapsack(live, prices, capacity)
        bound = max(bound, float(prices @ need[live]) / best[capacity])
        chosen = _taken(take, capacity)
        times = min(need[s] * min(STEP, 1 - covered[s]) / k for s, k in chosen)
        for s, k in chosen:
            covered[s] += k * times / need[s]
        use[chosen] = use.get(chosen, 0.0) + times
    return use, bound


def whole_configurations(histogram: np.ndarray, use: dict[Configuration, float], bound: float) -> tuple[list[tuple[Configuration, int]], np.ndarray]:
    """The fractional solution rounded down, and the pieces that it leaves."""
    left = histogram.copy()
    if not use:
        return [], left
    fill = (1 - SLACK) * float(histogram @ np.arange(len(histogram))) / bound
    out = []
    for chosen, times in sorted(use.items(), key=lambda c: (-c[1], c[0])):
        n = min([int(times + 1e-6)] + [int(left[s]) // k for s, k in chosen])
        if n and sum(s * k for s, k in chosen) >= fill:
            out.append((chosen, n))
            for s, k in chosen:
                left[s] -= n * k
    return out, left


def best_fit(histogram: np.ndarray, capacity: int) -> list[tuple[Configuration, int]]:
    """Best fit decreasing on counts: groups of equal sequences take the longest pieces first, the tightest gap first."""
    groups: dict[int, list[tuple[Configuration, int]]] = {}  # free places -> sequences filled alike
    for size in np.flatnonzero(histogram)[::-1].tolist():
        left = int(histogram[size])
        for free in [*sorted(f for f in groups if f >= size), capacity]:
            fresh = free == capacity
            while left and (fresh or groups.get(free)):
                filled, n = ((), left) if fresh else groups[free].pop()
                k = min(free // size, left)
                used = min(n, left // k)
                if used < n and not fresh:
                    groups[free].append((filled, n - used))
                groups.setdefault(free - k * size, []).append(((*filled, (size, k)), used))
                left -= k * used
    return [g for alike in groups.values() for g in alike]


def solve(histogram: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> tuple[list[tuple[Configuration, int]], float]:
    """(configuration, times) for all pieces of a histogram by length, and the lower bound on the sequences."""
    full = int(histogram[capacity])
    rest = histogram.copy()
    rest[capacity] = 0
    use, bound = fractional_cover(rest, capacity, rounds)
    whole, left = whole_configurations(rest, use, bound)
    return ([(((capacity, 1),), full)] if full else []) + whole + best_fit(left, capacity), full + bound


def slots(packing: list[tuple[Configuration, int]]) -> list[Slot]:
    """Places of all ranks, by length and first rank."""
    out, ranks, sequence = [], {}, 0
    for chosen, times in packing:
        offset = 0
        for s, k in chosen:
            out.append(Slot(s, ranks.get(s, 0), k, sequence, offset))
            ranks[s] = ranks.get(s, 0) + k * times
            offset += k * s
        sequence += times
    return sorted(out)


# --- the documents ---------------------------------------------------------------------


def _byte_characters() -> list[str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones themselves, the others from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class WordEncoder:
    """Token ids of a text as little-endian bytes.

    The tokenizer drops white space and looks at nothing across it, so a text's ids
    are those of its words one after the other; words seen are kept, up to a bound.
    A word of Latin letters is one pre-token, so its merges are asked of the model
    directly, and a comma or full stop behind it is the next pre-token; all other
    words go through the whole tokenizer.
    """

    _LATIN = "\u0250"  # letters below it are the same in every Unicode version

    def __init__(self, model: str, limit: int = CACHE) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        self.tokenizer = Tokenizer.from_str(model)
        self.model = self.tokenizer.model
        self.characters = _byte_characters()
        self.known: dict[bytes, bytes] = {}
        self.recent: set[bytes] = set()
        self.limit = limit
        self.marks = {mark: self._whole([mark])[0] for mark in (b".", b",")}

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        words = [t.split() for t in texts]
        if len(self.known) > self.limit:  # words of the last batch stay
            self.known = {w: self.known[w] for w in self.recent}
        self.recent = set().union(*words)
        rest = []
        for w in self.recent.difference(self.known):
            coded = self._letters(w)
            if coded is None:
                rest.append(w)
            else:
                self.known[w] = coded
        self.known.update(zip(rest, self._whole(rest)))
        return [b"".join(map(self.known.__getitem__, w)) for w in words]

    def _whole(self, words: list[bytes]) -> list[bytes]:
        codes = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return [array("I", c.ids).tobytes() for c in codes]

    def _letters(self, word: bytes) -> bytes | None:
        """Ids of a word of Latin letters and perhaps a mark, None for any other word."""
        mark = self.marks.get(word[-1:])
        stem = word if mark is None else word[:-1]
        if stem.isalpha():  # ASCII letters
            piece = stem.lower().decode()
        else:
            text = normalize("NFC", stem.decode("utf-8", "replace")).lower()
            if not text.isalpha() or max(text) >= self._LATIN:
                return None
            piece = "".join(self.characters[b] for b in text.encode())
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes() + (mark or b"")


@lru_cache(1)
def _encoder(model: str) -> WordEncoder:
    """One encoder per worker process, so that its words serve the tasks that follow."""
    return WordEncoder(model)


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, capacity: int, end_id: int, keep_ids: bool) -> DataFrame:
    """Written table of all pieces: id, piece, start, length, ids_crc32[, ids]; `_part` and `_nth` number those of a length."""
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())  # one vocabulary file, whatever the documents
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
              *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")),
              T.StructField("_part", T.IntegerType()), T.StructField("_nth", T.LongType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    out = T.StructType(fields)

    schema = to_arrow_schema(out)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, end, seen = _encoder(model.value), np.array([end_id], "<u4").tobytes(), [0] * (capacity + 1)
        for batch in batches:
            cols: list[list] = [[] for _ in fields]
            for i, coded in zip(batch[0].to_pylist(), encode([t or b"" for t in batch[1].to_pylist()])):
                coded += end
                for piece, at in enumerate(range(0, len(coded), 4 * capacity)):
                    ids = coded[at:at + 4 * capacity]
                    n = len(ids) // 4
                    row = (i, piece, at // 4, n, zlib.crc32(ids), part, seen[n], ids)
                    seen[n] += 1
                    for col, value in zip(cols, row):
                        col.append(value)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return materialise(docs.select(id_col, F.col(text_col).cast("binary")).mapInArrow(cut, out), "pieces", "snappy")


def _placed(ranked: DataFrame, places: list[Slot]) -> DataFrame:
    """Adds `sequence_id` and `offset` to rows with `length` and `_rank`."""
    table = np.array(places, np.int64).reshape(-1, len(Slot._fields)).T
    keys = (table[0] << _RANK_BITS) + table[1]
    out = T.StructType([*(f for f in ranked.schema.fields if f.name != "_rank"), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    schema = to_arrow_schema(out)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch[c].to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            slot = np.searchsorted(keys, (length << _RANK_BITS) + rank, "right") - 1
            _, first_rank, per_sequence, first_sequence, offset = table[:, slot]
            more, place = np.divmod(rank - first_rank, per_sequence)
            found = [pa.array(first_sequence + more), pa.array(offset + place * length)]
            yield pa.record_batch([*(batch[c] for c in out.names[:-2]), *found], schema=schema)

    return ranked.mapInArrow(find, out)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY,
         end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, [ids,] sequence_id, offset."""
    rows = pieces(docs, id_col, text_col, tokenizer, capacity, end_id, keep_ids)
    counts = materialise(rows.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # at most `capacity` rows
        histogram[length] = n
    packing, _ = solve(histogram, capacity)
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    ranked = rows.join(offsets, ["_part", "length"]).withColumn("_rank", F.col("_before") + F.col("_nth"))
    names = [c for c in rows.columns if not c.startswith("_")]
    return _placed(ranked.select(*names, "_rank"), slots(packing))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: the whole documents table packed into sequences of 2,048 tokens."""
    return pack(documents(spark, sf_dir))
