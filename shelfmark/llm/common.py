"""What the corpus operators share: reading documents, shared scratch tables, text helpers."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import checkpoint_dir
from shelfmark.sources.tables import read_table

#: Whitespace-separated words, as every contract of this package states them.
WORD = r"[^\x20\x09-\x0D]+"

# Where scratch folders made in this context are noted.
_MADE: ContextVar[list[str] | None] = ContextVar("scratch folders", default=None)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table."""
    return read_table(spark, sf_dir, "documents")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: texts can be long, and Python workers share the executor's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/shelfmark-{name}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_made() -> Iterator[list[str]]:
    """Notes the scratch folders that this thread makes inside the block, and no other run's."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)


def materialise(df: DataFrame, name: str, compression: str = "none", by: tuple[str, ...] = ()) -> DataFrame:
    """Write `df` once to the shared folder, partitioned `by` columns, and read it back: cuts lineage, survives lost executors.

    Ids and hashes don't compress; tables with texts name a codec.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.partitionBy(*by).option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete the files of a `materialise`d table that nothing will read any more."""
    _delete(df.sparkSession, df._folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete scratch folders whose readers have all been written out."""
    for folder in folders:
        _delete(spark, folder)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 marks the held-out rows (null id: held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def ascii_lower(text: str) -> bytes:
    """UTF-8 bytes with A-Z, and nothing else, lower-cased (unpaired surrogates become '?')."""
    return text.encode("utf-8", "replace").lower()


def crc_fold(doc_id: int | None) -> int:
    """`fold` for tests and brute-force versions."""
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a text as UTF-8 bytes; null has none."""
    return [] if text is None else ascii_lower(text).split()  # splits bytes at 0x20 and 0x09-0x0D
