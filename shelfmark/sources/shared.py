"""Tables that are written once to the shared folder and read many times."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfmark.session import checkpoint_dir

# Codec of tables by partitions, the large ones.  Small tables keep the default: planners broadcast
# tables by the size of their files, however many rows those hold.
SHARED_CODEC = "zstd"

# (application, key) -> (fingerprint of the inputs, table) of `keep`.
_KEPT: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def write_shared(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: lineage is
    cut, and a lost executor costs a file re-read."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/shelfmark-{name}-{uuid.uuid4().hex}"
    if partition_by:
        # A task keeps a file open for each of its partitions, up to this many, instead of sorting its rows.
        setting = "spark.sql.maxConcurrentOutputFileWriters"
        before = spark.conf.get(setting)
        spark.conf.set(setting, before if int(before) else "64")
        try:
            df.write.option("compression", SHARED_CODEC).partitionBy(*partition_by).parquet(path)
        finally:
            spark.conf.set(setting, before)
    else:
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def drop_shared(df: DataFrame) -> None:
    """Delete the files of a ``write_shared`` table that has no readers left."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._shared_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of all files below the paths (metadata only)."""
    conf, total = spark._jsc.hadoopConfiguration(), 0
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        total += fs.getContentSummary(path).getLength() if fs.exists(path) else 0
    return total


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Names, sizes and times of all files below the paths (metadata only)."""
    conf, found = spark._jsc.hadoopConfiguration(), []
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            continue
        files = fs.listFiles(path, True)
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return "\n".join(sorted(found))


def keep(spark: SparkSession, key: str, paths: Sequence[str], build: Callable[[], DataFrame]) -> DataFrame:
    """The table of ``build`` for these input files, built once per application
    and again when an input file changes (the stale copy is deleted)."""
    at, now = (spark.sparkContext.applicationId, key), fingerprint(spark, *paths)
    held = _KEPT.get(at)
    if held is None or held[0] != now:
        if held is not None:
            drop_shared(held[1])
        _KEPT[at] = (now, build())
    return _KEPT[at][1]


def drop_kept(spark: SparkSession) -> None:
    """Delete every table that ``keep`` holds for this application."""
    for at in [x for x in _KEPT if x[0] == spark.sparkContext.applicationId]:
        drop_shared(_KEPT.pop(at)[1])
