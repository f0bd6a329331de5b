"""Exact dedup by an extendible-hash index on shared files.

1. Texts get a 64-bit key.  One scan counts bytes per 16-bit key prefix (at
   most 65,536 counts, the only thing the driver sees).  From these counts the
   directory is grown: it starts with one bucket; while a bucket is overfull
   it is split on its next key bit, and the directory doubles whenever the
   bucket was as deep as the directory.
2. Map tasks sort their rows by key and collapse copies, so that a group of
   copies that holds a third of the corpus sends one entry per task, not its rows.
3. Every bucket is a contiguous key range with one owner task.  The owner gets
   its entries in key order, chains the entries of one key and compares the
   texts byte by byte, so colliding keys never merge different texts.  It
   writes its pages to the shared folder; rows that only point to an
   entry travel without their text, spread evenly over all owners.
4. Each row finds its verdict by joining its entry with the pages.

Defined results: null text counts as empty, and empty texts are copies of each
other; of equal texts the row with the largest id stays (null ids rank lowest),
among rows of one id the first one read; repeated rows are copies like any
other; an empty table gives an empty result.  Only id and text are read by
name, extra columns of any name ride along in a struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfmark.llm.common import bounded_batches, documents, scratch_folder

CELL_BITS = 16
BUCKET_BYTES = 16 << 20


def key_of(text: Column) -> Column:
    """64-bit key of a text; different texts may share one."""
    return F.xxhash64(text)


def grow_directory(cells: dict[int, int], capacity: int, cell_bits: int = CELL_BITS) -> list[int]:
    """Extendible-hash directory over key prefixes: entry i is the bucket of prefix i.

    `cells` holds bytes per `cell_bits`-bit prefix.  Buckets are numbered in key
    order.  A bucket that cannot be split further (one prefix) may stay overfull.
    """
    start = np.zeros((1 << cell_bits) + 1, np.int64)
    for cell, size in cells.items():
        start[cell + 1] = size
    start = np.cumsum(start)
    depth, buckets, todo = 0, [], [(0, 0)]  # (local depth, prefix)
    while todo:
        local, prefix = todo.pop()
        shift = cell_bits - local
        size = start[(prefix + 1) << shift] - start[prefix << shift]
        if size > capacity and local < cell_bits:
            depth = max(depth, local + 1)  # the directory doubles
            todo += [(local + 1, 2 * prefix), (local + 1, 2 * prefix + 1)]
        else:
            buckets.append((prefix << shift, local))
    directory = np.zeros(1 << depth, np.int64)
    for n, (first, local) in enumerate(sorted(buckets)):
        at = first >> (cell_bits - depth)
        directory[at: at + (1 << (depth - local))] = n
    return directory.tolist()


def _lone(t: pa.Table, key: int | None) -> np.ndarray:
    """Which rows of a key-ordered batch are certainly the only ones of their key in the task."""
    keys = t["_key"].to_numpy()
    alone = np.ones(len(keys), bool)
    same = keys[1:] == keys[:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    if key is not None:
        alone[0] &= keys[0] != key
    alone[-1] = False  # may go on in the next batch
    return alone


def _fill(out: pa.Schema, n: int, cols: dict) -> Iterator[pa.RecordBatch]:
    """Batches of `out`; missing columns are null."""
    if n:
        yield from pa.table([(cols[f.name] if isinstance(cols[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(cols[f.name], f.type))
                             if f.name in cols else pa.nulls(n, f.type) for f in out], schema=out).to_batches()


def _collapse(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Map side: rows in key order, best row of a key first; one entry per distinct text of the task.

    Other copies only point to the entry (`_rep`) and lose key, text and payload.
    """

    def entries(t: pa.Table, sizes) -> Iterator[pa.RecordBatch]:
        yield from _fill(out, t.num_rows, {c: t[c] for c in t.column_names} | {"_rep": t["_rid"], "_size": sizes})

    key, held = None, {}
    for b in batches:
        t = pa.Table.from_batches([b])
        if not t.num_rows:
            continue
        alone = _lone(t, key)
        quick = t.filter(pa.array(alone))
        yield from entries(quick, np.ones(quick.num_rows, np.int64))
        slow = t.filter(pa.array(~alone)).combine_chunks()
        copies: dict[str, list] = {"_rid": [], "_id": [], "_sha": [], "_rep": []}
        rows = zip(*(slow[c].to_pylist() for c in ("_key", "_text", "_rid", "_id", "_sha")), strict=True)
        for i, (k, text, rid, doc_id, sha) in enumerate(rows):
            if k != key:
                for row, n in held.values():
                    yield from entries(row, [n])
                key, held = k, {}
            if text in held:
                held[text][1] += 1
                for c, v in zip(copies, (rid, doc_id, sha, held[text][0]["_rid"][0].as_py()), strict=True):
                    copies[c].append(v)
            else:
                held[text] = [slow.take([i]), 1]
        yield from _fill(out, len(copies["_rid"]), copies)
    for row, n in held.values():
        yield from entries(row, [n])


def _own(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Owner task: rows without key first, then entries in key order, best row of a key first."""

    def pages(t: pa.Table, sizes) -> Iterator[pa.RecordBatch]:
        yield from _fill(out, t.num_rows, {c: t[c] for c in t.column_names if c in out.names} | {"_keep_rid": t["_rid"], "_keep_id": t["_id"], "_group": sizes})

    def flush(chain: list[dict]) -> Iterator[pa.RecordBatch]:
        for s in chain:
            yield from pages(s["row"], [s["size"]])
            n, first = len(s["rids"]), {c: s["row"][c][0].as_py() for c in ("_rid", "_id", "_sha")}
            yield from _fill(out, n, {"_rid": s["rids"], "_id": s["ids"], "_rep": s["rids"], "_sha": [first["_sha"]] * n,
                                      "_keep_rid": [first["_rid"]] * n, "_keep_id": [first["_id"]] * n, "_group": [s["size"]] * n})

    key, chain = None, []  # the chain has a slot for each distinct text of the key
    for b in batches:
        t = pa.Table.from_batches([b])
        bare = pc.is_null(t["_key"])
        m = t.filter(bare)
        yield from _fill(out, m.num_rows, {c: m[c] for c in ("_rid", "_id", "_rep", "_sha")})
        t = t.filter(pc.invert(bare))
        if not t.num_rows:
            continue
        alone = _lone(t, key)
        quick = t.filter(pa.array(alone))
        yield from pages(quick, quick["_size"])
        slow = t.filter(pa.array(~alone)).combine_chunks()
        rows = zip(*(slow[c].to_pylist() for c in ("_key", "_text", "_rid", "_id", "_size")), strict=True)
        for i, (k, text, rid, doc_id, size) in enumerate(rows):
            if k != key:
                yield from flush(chain)
                key, chain = k, []
            slot = next((s for s in chain if s["text"] == text), None)  # whole texts are compared, keys never decide
            if slot is None:
                chain.append({"text": text, "row": slow.take([i]), "size": size, "rids": [], "ids": []})
            else:
                slot["size"] += size
                slot["rids"].append(rid)
                slot["ids"].append(doc_id)
    yield from flush(chain)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES,
                keep_rows: bool = False) -> DataFrame:
    """Write the index pages and return them, one row per document row.

    `_rid` row, `_id`, `_rep` its entry, `_sha`; entries also have
    `_keep_rid`, `_keep_id` (who stays) and `_group` (copies in all).  With
    `keep_rows` the rows that stay carry their `_text` and all columns (`_row`).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    cell = F.shiftrightunsigned(key_of(text), 64 - CELL_BITS).cast("int")
    counts = docs.select(cell.alias("cell"), F.octet_length(text).alias("b")).groupBy("cell").agg(F.sum("b").alias("b")).collect()
    directory = grow_directory({r["cell"]: r["b"] for r in counts}, bucket_bytes)
    n = max(directory) + 1
    depth = (len(directory) - 1).bit_length()
    cols = [F.col(id_col).alias("_id"), text.alias("_text")]
    if keep_rows:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col], F.col(text_col).isNull().alias("_null_text")).alias("_row"))
    rows = docs.select(*cols).withColumns({"_rid": F.monotonically_increasing_id(), "_key": key_of(F.col("_text")), "_sha": F.sha2("_text", 256)})
    kinds = {f.name: f.dataType for f in rows.schema.fields} | {"_rep": T.LongType(), "_size": T.LongType()}
    shape = lambda names: T.StructType([T.StructField(c, kinds[c]) for c in names])
    collapsed = shape(kinds)
    collapsed_arrow = to_arrow_schema(collapsed)
    order = ["_key", F.desc_nulls_last("_id"), "_rid"]
    entries = rows.sortWithinPartitions(*order).mapInArrow(lambda x: _collapse(x, collapsed_arrow), collapsed)
    # The directory has at most 2^16 entries, so this array literal is bounded.
    table = F.lit(np.array(directory, dtype=np.int32)) if n > 1 else None
    if table is None:
        bucket = F.lit(0)
    else:
        at = F.shiftrightunsigned(F.col("_key"), 64 - depth).cast("int")
        bucket = F.element_at(table, at + 1)
    to = F.when(F.col("_key").isNotNull(), bucket).otherwise(F.pmod(F.xxhash64("_rid"), F.lit(n)).cast("int"))
    kinds |= {"_keep_rid": T.LongType(), "_keep_id": kinds["_id"], "_group": T.LongType()}
    out = shape(["_rid", "_id", "_rep", "_sha", "_keep_rid", "_keep_id", "_group", *(["_text", "_row"] if keep_rows else [])])
    arrow = to_arrow_schema(out)
    owned = (entries.withColumn("_to", to).repartitionById(n, "_to").drop("_to")
             .sortWithinPartitions(*order).mapInArrow(lambda x: _own(x, arrow), out))
    path = scratch_folder(spark, "exact-index")
    owned.write.option("compression", "snappy").parquet(path)
    return spark.read.schema(out).parquet(path)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    index = build_index(docs, id_col, text_col, bucket_bytes)
    verdict = index.filter(F.col("_group").isNotNull()).select("_rep", "_keep_rid", "_keep_id", "_group")
    return (index.select("_rid", "_id", "_rep", "_sha").join(verdict, "_rep")
            .select(F.col("_id").alias("doc_id"), F.col("_keep_id").alias("keep_id"), F.col("_group").alias("group_size"),
                    (F.col("_rid") == F.col("_keep_rid")).alias("kept"), F.col("_sha").alias("text_sha256")))


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows that stay, with all their columns in their order; read straight from the index pages."""
    index = build_index(docs, id_col, text_col, bucket_bytes, keep_rows=True)
    text = F.when(~F.col("_row._null_text"), F.col("_text"))
    return index.filter(F.col("_rid") == F.col("_keep_rid")).select(
        *[(text if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: exact dedup of the whole documents table."""
    return exact_dedup(documents(spark, sf_dir))


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, CAST(count(*) OVER w AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))"""
