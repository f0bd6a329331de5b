"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts.

1. Every document gets a hash-random key from its id.  Rows (id, source, size)
   are range-partitioned on (source, key), so a hot source is spread over many
   tasks in key order; each task sums sizes as it goes.
2. Totals per (source, range) give each range its offset, hence every document
   its place in the source's running total of words.
3. Weights go to the sources in code point order (nulls last) and repeat.  The
   corpus total is shared by weight; a target stops at `max_epochs` times its
   source's size and the excess is shared again among the others (solved in
   closed form: sources sorted by cap / weight, exact integers).
4. A source takes floor(target / size) whole epochs, and of one more epoch all
   documents up to the cut: the place where the running total is nearest to the
   budget.  The cut is a single position in key order per source, so it can be
   applied to the rows anywhere with a join on the source.

Defined results: null text has size 0 and is never taken; a null source is a
source of its own, the last one; rows that repeat id and text share one place
in the order and one decision; sources without words get target 0; an empty
table gives an empty result.  Extra columns are never read.  The table of
sources is one row per source; only this table is ranked in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import WORD, bounded_batches, documents, materialise

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix"
_EXACT = "decimal(38,0)"


def place(id_col: str, text_col: str, seed: str = SEED) -> Column:
    """Position of a row in its source's order: hash-random key, id, hash of the text."""
    i = F.col(id_col)
    return F.struct(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(i.cast("string"), F.lit(""))).cast("binary")).alias("key"),
                    i.alias("id"), F.xxhash64(F.col(text_col)).alias("tie"))


def _running(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Adds `_before`: the words of the same source earlier in this range (rows come in order)."""
    source, total = object(), 0
    for b in batches:
        sizes, sources = b["_size"].to_numpy(), b["_source"]
        code = sources.dictionary_encode().indices.fill_null(-1).to_numpy()
        if not len(code):
            continue
        before = np.cumsum(sizes) - sizes
        starts = np.concatenate([[0], np.flatnonzero(code[1:] != code[:-1]) + 1])
        run = np.searchsorted(starts, np.arange(len(code)), "right") - 1
        before = before - before[starts][run]
        if sources[0].as_py() == source:
            before[run == 0] += total
        source = sources[len(code) - 1].as_py()
        total = int(before[-1] + sizes[-1])
        yield pa.record_batch([*b.columns, pa.array(before, pa.int64())], schema=out)


def measured(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: str) -> DataFrame:
    """Written table in (source, place) ranges: `_source _place _size _range _before`."""
    from pyspark.sql.pandas.types import to_arrow_schema

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(source_col).alias("_source"), place(id_col, text_col, seed).alias("_place"),
                       F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("_size"))
    ranged = rows.repartitionByRange("_source", "_place").sortWithinPartitions("_source", "_place").withColumn("_range", F.spark_partition_id())
    out = T.StructType([*ranged.schema.fields, T.StructField("_before", T.LongType())])
    arrow = to_arrow_schema(out)
    return materialise(ranged.mapInArrow(lambda x: _running(x, arrow), out), "mix")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(_source, source_size) -> plus `target`, the words each source gives to the mix."""
    by_name = Window.orderBy(F.asc_nulls_last("_source"))
    lcm = math.lcm(*weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ranked = sizes.withColumn("w", weight).withColumn("cap", max_epochs * F.col("source_size").cast(_EXACT))
    by_level = Window.orderBy(F.col("cap") * (F.lit(lcm) / F.col("w")).cast("int"), F.asc_nulls_last("_source"))
    before, after = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    level = ranked.withColumns({
        "n": F.row_number().over(by_level),
        "left": (F.sum(F.col("source_size").cast(_EXACT)).over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast(_EXACT),
        "rest": F.sum("w").over(after).cast("long"),
    }).withColumn("open", F.col("left") * F.col("w") <= F.col("cap") * F.col("rest"))
    # The first open source in this order fixes the common level of all later ones.
    fixed = F.min_by(F.struct("left", "rest"), F.when(F.col("open"), F.col("n"))).over(Window.partitionBy())
    solved = level.withColumn("fixed", fixed).withColumn("first", F.min(F.when(F.col("open"), F.col("n"))).over(Window.partitionBy()))
    share = (F.col("fixed.left") * F.col("w")).cast("double") / F.col("fixed.rest")
    return solved.select("_source", "source_size", F.when(F.col("n") >= F.col("first"), share).otherwise(F.col("cap").cast("double")).alias("target"))


def cuts(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: `source_size target _epochs _cut` (last place of the partial epoch, or null)."""
    ranges = rows.groupBy("_source", "_range").agg(F.sum("_size").alias("s"))
    ahead = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # Written, so that both joins below know these tables' sizes before they deal out the rows.
    offsets = materialise(ranges.select("_source", "_range", F.coalesce(F.sum("s").over(ahead), F.lit(0)).alias("_offset")), "mix-offsets")
    goal = targets(rows.groupBy("_source").agg(F.sum("_size").alias("source_size")), weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = materialise(goal.withColumn("_epochs", epochs.cast("long"))
                       .withColumn("_budget", F.col("target") - F.col("_epochs") * F.col("source_size")), "mix-goals")
    placed = _on_source(_on_source(rows, offsets, "_range"), goal.select("_source", "_budget"))
    start = F.col("_offset") + F.col("_before")
    taken = (2 * start + F.col("_size") <= 2 * F.col("_budget")) & (F.col("_size") > 0)
    last = placed.filter(taken).groupBy("_source").agg(F.max("_place").alias("_cut"))
    return materialise(_on_source(goal.drop("_budget"), last, how="left"), "mix-cuts")


def _on_source(left: DataFrame, right: DataFrame, *more: str, how: str = "inner") -> DataFrame:
    """Null-safe join on `_source` (and plain on `more`)."""
    on = left["_source"].eqNullSafe(right["_source"])
    for c in more:
        on &= left[c] == right[c]
    out = left.join(right, on, how)
    for c in ("_source", *more):
        out = out.drop(right[c])
    return out


def _copies(at: Column) -> Column:
    return F.col("_epochs") + F.coalesce((at <= F.col("_cut")).cast("long"), F.lit(0))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words the mix takes)."""
    rows = measured(docs, id_col, source_col, text_col, seed)
    return (_on_source(rows, cuts(rows, weights, max_epochs))
            .select(F.col("_place.id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target",
                    (F.col("_size") * _copies(F.col("_place"))).alias("taken")))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
               weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: each row as often as it is taken, with its own columns; rows without words never."""
    plan = cuts(measured(docs, id_col, source_col, text_col, seed), weights, max_epochs)
    row = docs.select(F.col(source_col).alias("_source"), place(id_col, text_col, seed).alias("_place"),
                      F.coalesce(F.col(text_col), F.lit("")).rlike(WORD).alias("_words"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    taken = _on_source(row.filter("_words"), plan.select("_source", "_epochs", "_cut"))
    times = taken.select("_row", _copies(F.col("_place")).alias("_n")).filter("_n > 0")
    return times.select(F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"), "_row").select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: the mix of the whole documents table."""
    return mix(documents(spark, sf_dir))


#: CTEs from `docs` (any relation with doc_id, text, source) to `mixed` (its rows, size, ..., copies).
MIXED_SQL = r"""
m0 AS (SELECT *, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM {docs}),
m1 AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY md5('mix:' || doc_id), doc_id) - size AS before FROM m0),
ms AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM m0 GROUP BY source),
mw AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 3 * source_size::HUGEINT AS cap FROM ms),
ml AS (SELECT *, row_number() OVER l AS n, w AS ww,
         (SELECT sum(source_size) FROM ms) - coalesce(sum(cap) OVER (l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rem,
         sum(w) OVER (l ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
       FROM mw WINDOW l AS (ORDER BY cap * (10 // w), source NULLS LAST)),
mf AS (SELECT n AS n1, rem AS rem1, rest AS rest1 FROM ml WHERE rem * w <= cap * rest ORDER BY n LIMIT 1),
mt AS (SELECT source, source_size, CASE WHEN n >= n1 THEN CAST(rem1 * w AS DOUBLE) / rest1 ELSE CAST(cap AS DOUBLE) END AS target FROM ml, mf),
mg AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM mt),
mixed AS (SELECT m1.*, source_size, target,
            CASE WHEN size = 0 THEN 0 ELSE epochs + (2 * before + size <= 2 * (target - epochs * source_size))::INT END AS copies
          FROM m1 JOIN mg ON m1.source IS NOT DISTINCT FROM mg.source)"""

ORACLE = "WITH " + MIXED_SQL.replace("{docs}", "documents") + """
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken FROM mixed"""
