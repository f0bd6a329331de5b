"""Edit-aware token counts: segment trees over pre-tokens, re-encoding only where texts change.

A byte-pair tokenizer first cuts a text into pre-tokens with a pattern that
never looks back, then encodes each pre-token alone.  A document keeps its
pre-tokens (length, tokens) in the leaves of a segment tree whose nodes sum
characters and tokens.  An edit descends by characters to the first pre-token
that could have seen the changed text (the pattern looks at most two
characters past a pre-token), re-cuts from there, and stops at the first
boundary behind the edit that the old text has as well; from there on both
texts are cut alike.  Only the pre-tokens between are encoded again, and the
sums on the paths from their leaves to the root are renewed.

The state is two integer arrays per document, so counts can be kept in a table
and edits applied later.  Encoded pre-tokens are kept in a bounded cache.

Defined results: null text counts as empty (0 tokens); a null edit field is 0
or '', positions beyond the text mean its end, deletions stop at the end; edits
of a document apply one after the other; null or empty edit lists change
nothing; repeated rows are counted like any other; an empty table gives an
empty result.  Very long texts are counted whole.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import bounded_batches, documents

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that goes with the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LOOKAHEAD = 2  # characters past a pre-token that the pattern may look at
LEAF = 64
CACHE = 200_000
_CUT = regex.compile(PATTERN)


class Counter:
    """Tokens of pre-tokens, with a bounded cache."""

    def __init__(self, ranks: bytes) -> None:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.cache: dict[str, int] = {}

    def __call__(self, pieces: list[str]) -> list[int]:
        known = self.cache
        if len(known) > CACHE:
            known.clear()
        for p in set(pieces).difference(known):
            known[p] = len(self.encoding.encode_ordinary(p))
        return [known[p] for p in pieces]


class TokenTree:
    """Segment tree over leaves of pre-tokens; every node sums characters and tokens."""

    def __init__(self, lengths: list[int], tokens: list[int]) -> None:
        self._build(lengths, tokens)

    def _build(self, lengths: list[int], tokens: list[int]) -> None:
        self.leaves = [(lengths[i: i + LEAF], tokens[i: i + LEAF]) for i in range(0, max(1, len(lengths)), LEAF)]
        self.base = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.base), [0] * (2 * self.base)
        for i, (a, b) in enumerate(self.leaves):
            self.chars[self.base + i], self.tokens[self.base + i] = sum(a), sum(b)
        for node in range(self.base - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def find(self, at: int) -> tuple[int, int, int]:
        """(leaf, place in the leaf, first character) of the pre-token that holds character `at`, or of the end."""
        node, first = 1, 0
        if at >= self.n_chars:
            leaf = len(self.leaves) - 1
            return leaf, len(self.leaves[leaf][0]), self.n_chars
        while node < self.base:
            node *= 2
            if at >= first + self.chars[node]:
                first += self.chars[node]
                node += 1
        leaf = node - self.base
        ends = list(accumulate(self.leaves[leaf][0], initial=first))
        place = bisect_right(ends, at) - 1
        return leaf, place, ends[place]

    def after(self, leaf: int, place: int) -> Iterator[int]:
        """Lengths of the pre-tokens from a place on."""
        for i in range(leaf, len(self.leaves)):
            yield from self.leaves[i][0][place if i == leaf else 0:]

    def replace(self, leaf: int, place: int, gone: int, lengths: list[int], tokens: list[int]) -> None:
        """Exchange `gone` pre-tokens from a place on, renewing the sums above."""
        a, b = self.leaves[leaf]
        head, last = (a[:place], b[:place]), leaf
        gone += place
        while gone > len(self.leaves[last][0]):
            gone -= len(self.leaves[last][0])
            last += 1
        tail = self.leaves[last]
        self.leaves[leaf] = ([*head[0], *lengths, *tail[0][gone:]], [*head[1], *tokens, *tail[1][gone:]])
        for i in range(leaf + 1, last + 1):
            self.leaves[i] = ([], [])
        if len(self.leaves[leaf][0]) > 4 * LEAF:
            self._build(*self.flat())
            return
        nodes = range(self.base + leaf, self.base + last + 1)
        for node in nodes:
            self.chars[node], self.tokens[node] = sum(self.leaves[node - self.base][0]), sum(self.leaves[node - self.base][1])
        while nodes[0] > 1:
            nodes = range(nodes[0] // 2, nodes[-1] // 2 + 1)
            for node in nodes:
                self._sum(node)

    def flat(self) -> tuple[list[int], list[int]]:
        return [x for a, _ in self.leaves for x in a], [x for _, b in self.leaves for x in b]


def count(text: str, counter: Counter) -> TokenTree:
    """Tree of a whole text."""
    pieces = _CUT.findall(text)
    return TokenTree(list(map(len, pieces)), counter(pieces))


def edit(tree: TokenTree, text: str, at: int, delete: int, insert: str, counter: Counter) -> tuple[str, int]:
    """Apply one edit to text and tree; returns the new text and how many pre-tokens were encoded again."""
    at = min(max(at, 0), len(text))
    delete = min(max(delete, 0), len(text) - at)
    new = text[:at] + insert + text[at + delete:]
    leaf, place, start = tree.find(max(0, at - LOOKAHEAD))
    shift, old_end = len(insert) - delete, start
    old, gone, pieces = tree.after(leaf, place), 0, []
    here = start
    for m in _CUT.finditer(new, start):
        if here >= at + len(insert):
            while old_end + shift < here:
                old_end += next(old)
                gone += 1
            if old_end + shift == here and old_end >= at + delete:
                break
        pieces.append(m[0])
        here = m.end()
    else:  # no common boundary before the end
        gone += sum(1 for _ in old)
    tree.replace(leaf, place, gone, list(map(len, pieces)), counter(pieces))
    return new, len(pieces)


@lru_cache(maxsize=2)
def _counter(ranks: bytes) -> Counter:
    return Counter(ranks)


def token_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """State of every document: doc_id, n_tokens, piece_chars, piece_tokens."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = _shared(spark, ranks)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for b in batches:
            trees = [count(t, counter) for t in b["_text"].to_pylist()]
            flat = [t.flat() for t in trees]
            yield pa.RecordBatch.from_arrays(
                [b["_id"], pa.array([t.n_tokens for t in trees], pa.int64()), *(pa.array([f[i] for f in flat], pa.list_(pa.int32())) for i in (0, 1))],
                names=["doc_id", "n_tokens", "piece_chars", "piece_tokens"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, piece_chars array<int>, piece_tokens array<int>")


def edited_counts(docs: DataFrame, edits: Column, id_col: str = "doc_id", text_col: str = "text", state: tuple[Column, Column] | None = None,
                  ranks: str = RANKS) -> DataFrame:
    """Counts before and after a list of edits per document.

    `edits` is array<struct<at int, del int, ins string>>; `state` are the piece
    columns of `token_trees` where the rows carry them (else texts are cut and
    counted here first).  Columns: doc_id, n_pieces, tokens_before, tokens_after,
    n_reencoded (pre-tokens encoded again), text_after.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = _shared(spark, ranks)
    kept = state or (F.lit(None).cast("array<int>"), F.lit(None).cast("array<int>"))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
                       edits.cast("array<struct<at: int, del: int, ins: string>>").alias("_edits"), kept[0].alias("_chars"), kept[1].alias("_tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for b in batches:
            out: list[tuple] = []
            for text, changes, chars, tokens in zip(*(b[c].to_pylist() for c in ("_text", "_edits", "_chars", "_tokens")), strict=True):
                tree = count(text, counter) if chars is None or tokens is None else TokenTree(chars, tokens)
                before, again = tree.n_tokens, 0
                for x in changes or ():
                    if x is not None:
                        text, n = edit(tree, text, x["at"] or 0, x["del"] or 0, x["ins"] or "", counter)
                        again += n
                out.append((sum(len(a) for a, _ in tree.leaves), before, tree.n_tokens, again, text))
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b["_id"], *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string())],
                                             names=["doc_id", "n_pieces", "tokens_before", "tokens_after", "n_reencoded", "text_after"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_pieces long, tokens_before long, tokens_after long, n_reencoded long, text_after string")


def _shared(spark: SparkSession, ranks: str):
    """The rank file (one file of bounded size), broadcast."""
    with open(ranks, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def sample_edits(text: Column, source: Column, lang: Column) -> Column:
    """Edits that follow from a document itself: its language in front, its source in the middle for
    seven characters there, its last third's first 40 characters gone."""
    n = F.length(text)
    one = lambda at, gone, ins: F.struct(at.cast("int").alias("at"), F.lit(gone).alias("del"), ins.alias("ins"))
    return F.array(one(F.lit(0), 0, F.concat(lang, F.lit(": "))), one(n / 2, 7, source), one(2 * n / 3, 40, F.lit("")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: token counts of every document before and after edits derived from its own columns."""
    edits = sample_edits(F.coalesce("text", F.lit("")), F.col("source"), F.col("lang"))
    return edited_counts(documents(spark, sf_dir), edits).select("doc_id", "n_pieces", "tokens_before", "tokens_after", "n_reencoded",
                                                                F.sha2("text_after", 256).alias("text_sha256"))
