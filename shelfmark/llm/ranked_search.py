"""Ranked lexical search: item bundles pass the owners of their terms, one stage each.

1. Index: every task cuts its documents into blocks (at most `BLOCK_DOCS`) and
   writes, per block, the postings of the terms that some item may hold (a filter
   of fixed size, built from the items' terms, drops nearly all others).  The
   documents of a block are numbered by id.
2. Corpus counts (documents, terms, documents per term) come from the index.
   Terms go to `STAGES` owners by falling weight, so that each owns about as many
   postings; the postings are written per owner with their integer contribution
   per unit of weight, and each term's largest one is known.
3. Items travel as bundles: per block, the sparse accumulators (documents and
   sums) of each item.  Stage s cogroups the bundles with the postings of owner s
   by block, adds the contributions, and hands the bundles on.
4. Between stages, the 20th best sum so far of each item is a lower bound on its
   final 20th score.  What the owners still to come can add at most is known, so
   accumulators that can't reach that bound are dropped, and an item takes in no
   new documents once a document met for the first time couldn't reach it.  Both
   are exact: no document of the result, ties included, is ever lost.
5. After the last owner each block gives its best `k` documents per item; these
   few get their ids and are ranked.

Items are taken in groups of about `GROUP_ITEMS` (or `GROUP_TERMS` terms), so what
a task holds for the items, and the bounds collected on the driver, don't grow.
A group's block holds at most BLOCK_DOCS accumulators an item.

Defined results: null and empty texts have no term and are in no list, nor counted;
items without terms, or whose terms no document holds, give no row; every row of the
items table is an item of its own, repeated rows give repeated lists; documents with equal
rows are documents of their own; a null document id sorts last; ties beyond the id
go by place in the table; empty tables give an empty result; extra columns are not
read.  Very long texts are indexed whole.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shelfmark.llm.common import bounded_batches, documents, drop_table, materialise
from shelfmark.sources.tables import read_table

TOP = 20
STAGES = 4
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1 << 20
GROUP_ITEMS = 256
GROUP_TERMS = 1 << 16
FILTER_BITS = 1 << 23
FILTER_HASHES = 4
VOCABULARY = 500_000  # terms a task remembers

# What separates terms; A-Z are lower-cased.
_BREAKS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes(0x20 if b in _BREAKS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

_INDEX = "block long, ids array<long>, sizes array<long>, terms array<binary>, starts array<int>, docs array<int>, counts array<int>"
_POSTINGS = "owner int, block long, terms array<int>, starts array<int>, docs array<int>, impacts array<int>, tops array<int>"
_BUNDLE = "block long, item int, docs array<int>, sums array<long>, best array<long>"


def terms_of(text: bytes | None) -> list[bytes]:
    """Lower-cased terms of a text."""
    return (text or b"").translate(_FOLD).split()


def _schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


# --- items -----------------------------------------------------------------------------


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Written table (item, item_id, term, times); `item` numbers the rows."""
    id_type = items.schema[id_col].dataType.simpleString()
    ddl = f"item long, item_id {id_type}, term binary, times long"
    schema = _schema(ddl)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = []
            for i, text in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                rows += [(n, i, t, c) for t, c in Counter(terms_of(text)).items()]
                n += 1
            yield _rows(schema, rows)

    return materialise(items.select(id_col, F.col(text_col).cast("binary")).mapInArrow(split, ddl), "item-terms")


def _places(term: bytes) -> list[int]:
    """Bits of a term in the filter."""
    a = zlib.crc32(term)
    b = zlib.crc32(term, 0x9E3779B9) | 1
    return [(a + i * b) % FILTER_BITS for i in range(FILTER_HASHES)]


def term_filter(terms: DataFrame) -> bytes:
    """A Bloom filter of all items' terms: FILTER_BITS bits, whatever their number."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.array([p for t in batch[0].to_pylist() for p in _places(t)], np.int64)
            yield pa.record_batch([pa.array((at >> 6).astype(np.int32)), pa.array(np.left_shift(np.int64(1), at & 63))], names=["word", "bits"])

    words = terms.select("term").distinct().mapInArrow(bits, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for word, value in words.collect():
        out[word] = value
    return out.astype("<i8").tobytes()


# --- the index -------------------------------------------------------------------------


class _Block:
    """Postings of the documents of one block, gathered in the order of the table."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.codes: list[int] = []
        self.lengths: list[int] = []  # postings of each document
        self.counts: list[int] = []

    def row(self, number: int, names: list[bytes]) -> tuple:
        """The block as an index row; documents numbered by id, postings by term and document."""
        n = len(self.ids)
        order = sorted(range(n), key=lambda i: (self.ids[i] is None, self.ids[i] or 0, i))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        codes, docs = np.array(self.codes, np.int64), np.repeat(place, self.lengths)
        by_term = np.lexsort((docs, codes))
        present, starts = np.unique(codes[by_term], return_index=True)
        return (number, [self.ids[i] for i in order], [self.sizes[i] for i in order], [names[c] for c in present],
                np.append(starts, len(codes)).astype(np.int32), docs[by_term].astype(np.int32), np.array(self.counts, np.int32)[by_term])


def index(docs: DataFrame, id_col: str, text_col: str, wanted: bytes) -> DataFrame:
    """Written index, one row a block: postings of the terms that pass the filter."""
    bounded_batches(docs.sparkSession)
    schema = _schema(_INDEX)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        block, codes, names = _Block(), {}, []

        def passes(term: bytes) -> bool:
            return all(wanted[p >> 3] >> (p & 7) & 1 for p in _places(term))

        for batch in batches:
            for i, text in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                terms = terms_of(text)
                if not terms:
                    continue
                before = len(block.codes)
                for term, times in Counter(terms).items():
                    code = codes.get(term)
                    if code is None:
                        code = -1
                        if passes(term):
                            code = len(names)
                            names.append(term)
                        codes[term] = code
                    if code >= 0:
                        block.codes.append(code)
                        block.counts.append(times)
                block.ids.append(i)
                block.sizes.append(len(terms))
                block.lengths.append(len(block.codes) - before)
                if len(block.ids) == BLOCK_DOCS or len(block.codes) >= BLOCK_POSTINGS:
                    yield _rows(schema, [block.row(number, names)])
                    block, number = _Block(), number + 1
                    if len(codes) > VOCABULARY:
                        codes, names = {}, []
        if block.ids:
            yield _rows(schema, [block.row(number, names)])

    return materialise(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(build, _INDEX), "search-index", "zstd")


def document_counts(indexed: DataFrame) -> DataFrame:
    """Written table (term, df)."""
    held = F.transform(F.sequence(F.lit(1), F.size("terms")), lambda i: F.struct(
        F.element_at("terms", i).alias("term"), (F.element_at("starts", i + 1) - F.element_at("starts", i)).alias("n")))
    each = indexed.filter(F.size("terms") > 0).select(F.explode(held).alias("t"))
    return materialise(each.groupBy("t.term").agg(F.sum("t.n").alias("df")), "search-df")


# --- one group of items ----------------------------------------------------------------


class Group:
    """Terms, weights and owners of a group of items; bounded, so it goes to every task."""

    def __init__(self, pairs: list[tuple], n_docs: int, n_terms: int) -> None:
        self.items = sorted({p[0] for p in pairs})
        self.item_ids = {p[0]: p[1] for p in pairs}
        self.n_docs, self.n_terms = n_docs, n_terms
        df = {p[2]: p[4] for p in pairs}
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
        ranked = sorted((t for t in df if weights[t] > 0), key=lambda t: (-weights[t], t))
        self.terms = {t: i for i, t in enumerate(ranked)}
        share, total = np.cumsum([df[t] for t in ranked]), sum(df[t] for t in ranked)
        self.owner = np.minimum(STAGES - 1, (share - 1) * STAGES // max(1, total)) if ranked else np.zeros(0, np.int64)
        number = {item: i for i, item in enumerate(self.items)}
        #: per item, per owner: (term, weight times repeats)
        self.plan: list[list[list[tuple[int, int]]]] = [[[] for _ in range(STAGES)] for _ in self.items]
        for item, _, term, times, _ in pairs:
            if term in self.terms:
                t = self.terms[term]
                self.plan[number[item]][self.owner[t]].append((t, weights[term] * times))

    def most_after(self, tops: dict[int, int]) -> np.ndarray:
        """Items x (stages + 1): the most that owners s, s + 1, ... can add."""
        own = [[sum(w * tops.get(t, 0) for t, w in part) for part in parts] for parts in self.plan]
        out = np.zeros((len(self.items), STAGES + 1), np.int64)
        for s in range(STAGES - 1, -1, -1):
            out[:, s] = out[:, s + 1] + [row[s] for row in own]
        return out


def owned_postings(indexed: DataFrame, group: Group) -> DataFrame:
    """Written postings of a group's terms, partitioned by owner, with contributions per unit of weight."""
    n_docs, n_terms, terms, owner = group.n_docs, group.n_terms, group.terms, group.owner
    schema = _schema(_POSTINGS)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, sizes, names, starts, docs, counts in zip(*(batch[c] for c in ("block", "sizes", "terms", "starts", "docs", "counts"))):
                starts, docs, tf = (x.values.to_numpy() for x in (starts, docs, counts))
                m = 100 - 25 + 25 * sizes.values.to_numpy() * n_docs // n_terms
                tf = tf.astype(np.int64)
                impact = (1_000_000_000 * tf // (1000 * tf + 12 * m[docs])).astype(np.int32)
                parts: dict[int, list[tuple[int, int]]] = {}
                for i, name in enumerate(names.as_py()):
                    if name in terms:
                        parts.setdefault(int(owner[terms[name]]), []).append((terms[name], i))
                rows = []
                for s, held in sorted(parts.items()):
                    spans = [(starts[i], starts[i + 1]) for _, i in held]
                    pick = np.concatenate([np.arange(a, b) for a, b in spans])
                    ends = np.cumsum([0, *(b - a for a, b in spans)]).astype(np.int32)
                    rows.append((s, block.as_py(), [t for t, _ in held], ends, docs[pick], impact[pick], np.maximum.reduceat(impact[pick], ends[:-1])))
                if rows:
                    yield _rows(schema, rows)

    return materialise(indexed.drop("ids").mapInArrow(score, _POSTINGS), "search-postings", "zstd", by=("owner",))


def stage(postings: DataFrame, bundles: DataFrame, group: Group, s: int, least: np.ndarray, most: np.ndarray, k: int) -> DataFrame:
    """Bundles after owner s: contributions added, hopeless accumulators left behind."""
    plan = [parts[s] for parts in group.plan]
    ahead, schema = most[:, s], _schema(_BUNDLE)

    def visit(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for row in left.select(["terms", "starts", "docs", "impacts"]).to_batches():
            for terms, starts, docs, impacts in zip(*row.columns):
                at, docs, impacts = starts.values.to_numpy(), docs.values.to_numpy(), impacts.values.to_numpy()
                for i, t in enumerate(terms.as_py()):
                    lists[t] = docs[at[i]:at[i + 1]], impacts[at[i]:at[i + 1]]
        carried: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for row in right.select(["item", "docs", "sums"]).to_batches():
            for item, docs, sums in zip(*row.columns):
                docs, sums = docs.values.to_numpy(), sums.values.to_numpy()
                alive = sums + ahead[item.as_py()] >= least[item.as_py()]
                carried[item.as_py()] = docs[alive], sums[alive]
        block, total, rows = key[0].as_py(), np.zeros(BLOCK_DOCS, np.int64), []
        for item, part in enumerate(plan):
            docs, sums = carried.get(item, (None, None))
            added = [(*lists[t], w) for t, w in part if t in lists]
            if docs is None and not added:
                continue
            total[:] = 0
            if docs is not None:
                total[docs] = sums
            for at, impact, w in added:
                total[at] += w * impact.astype(np.int64)
            if ahead[item] >= least[item]:  # a document met for the first time may still get there
                docs = np.flatnonzero(total)
            if docs is not None and len(docs):
                sums = total[docs]
                rows.append((block, item, docs.astype(np.int32), sums, np.sort(sums)[::-1][:k]))
        return pa.Table.from_batches([_rows(schema, rows)], schema)

    return postings.groupBy("block").cogroup(bundles.groupBy("block")).applyInArrow(visit, _BUNDLE)


def kth_best(bundles: DataFrame, n_items: int, k: int) -> np.ndarray:
    """Per item the k-th best sum so far, 0 where there are fewer (n_items rows at most)."""
    each = bundles.select("item", F.explode("best").alias("sum"))
    first = each.withColumn("n", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("sum")))).filter(F.col("n") <= k)
    out = np.zeros(n_items, np.int64)
    for item, low, n in first.groupBy("item").agg(F.min("sum"), F.count(F.lit(1))).collect():
        out[item] = low if n == k else 0
    return out


def _winners(bundles: DataFrame, least: np.ndarray, k: int) -> DataFrame:
    """Per block and item the best k documents that reach the item's k-th score: item, block, doc, score."""
    ddl = "item int, block long, doc int, score long"
    schema = _schema(ddl)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block, item, docs, sums in zip(*(batch[c] for c in ("block", "item", "docs", "sums"))):
                i, docs, sums = item.as_py(), docs.values.to_numpy(), sums.values.to_numpy()
                alive = sums >= max(1, least[i])
                docs, sums = docs[alive], sums[alive]
                for at in np.lexsort((docs, -sums))[:k]:
                    rows.append((i, block.as_py(), docs[at], sums[at]))
            yield _rows(schema, rows)

    return bundles.mapInArrow(choose, ddl)


def search_group(indexed: DataFrame, group: Group, k: int) -> DataFrame:
    """Written rows item, rank, doc_id, score of one group; the scratch tables are gone afterwards."""
    spark = indexed.sparkSession
    postings = owned_postings(indexed, group)
    each = postings.select(F.explode(F.arrays_zip("terms", "tops")).alias("t"))
    most = group.most_after(dict(map(tuple, each.groupBy("t.terms").agg(F.max("t.tops")).collect())))  # a row per term of the group
    least, bundles = np.zeros(len(group.items), np.int64), None
    for s in range(STAGES):
        owned = postings.filter(F.col("owner") == s).drop("owner", "tops")
        now = materialise(stage(owned, spark.createDataFrame([], _BUNDLE) if bundles is None else bundles, group, s, least, most, k), "search-bundles", "zstd")
        if bundles is not None:
            drop_table(bundles)
        bundles, least = now, kth_best(now, len(group.items), k)
    best = _winners(bundles, least, k).join(indexed.select("block", "ids"), "block")
    named = best.select("item", "score", F.element_at("ids", F.col("doc") + 1).alias("doc_id"), "block", "doc")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "block", "doc")
    ranked = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    out = materialise(ranked.select("item", "rank", "doc_id", "score"), "search-ranked")
    drop_table(bundles)
    drop_table(postings)
    return out


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    spark = docs.sparkSession
    wanted = item_terms(items, item_col, item_text_col)
    indexed = index(docs, id_col, text_col, term_filter(wanted))
    n_docs, n_terms = indexed.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)),
                                  F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()
    found = document_counts(indexed)
    pairs = materialise(wanted.join(found, "term"), "search-pairs")
    n_items, n_pairs = pairs.agg(F.count_distinct("item"), F.count(F.lit(1))).first()
    groups = max(-(-n_items // GROUP_ITEMS), -(-n_pairs // GROUP_TERMS))
    id_type = items.schema[item_col].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    for g in range(groups):
        mine = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == g)
        group = Group([tuple(r) for r in mine.select("item", "item_id", "term", "times", "df").collect()], n_docs, n_terms)
        if not group.terms:
            continue
        names = spark.createDataFrame([(i, group.item_ids[item]) for i, item in enumerate(group.items)], f"item int, item_id {id_type}")
        out = out.unionByName(search_group(indexed, group, k).join(names, "item").drop("item"))
    for scratch in (wanted, found, pairs, indexed):
        drop_table(scratch)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the 20 best documents for every benchmark item."""
    return search(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
tf AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY doc_id, t),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
c AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM n),
w AS (SELECT t, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY t, big_n),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
qt AS (SELECT item_id, t, count(*) AS times FROM q GROUP BY item_id, t),
m AS (SELECT doc_id, 75 + (25 * n * big_n) // big_l AS m FROM n, c),
s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM qt JOIN tf USING (t) JOIN w USING (t) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 20"""
