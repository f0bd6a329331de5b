"""Spark session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that every session gets, on a cluster too, whatever its defaults say.
_SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partial-aggregate and broadcast decisions are taken by AQE from runtime
    # sizes; this threshold is the size check behind every automatic broadcast.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Upper limits of what one task reads.  The defaults (128 MB of a compressed file,
# 64 MB of a shuffle) are many million narrow sales, whose hash maps and sorts
# then outgrow a task's share of the memory and spill.
_TASK_LIMITS = {
    "spark.sql.files.maxPartitionBytes": 16 * 1024 * 1024,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 * 1024 * 1024,
}
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def _bytes(text: str) -> int:
    """Bytes of a Spark size setting such as ``64MB``, ``16k`` or ``134217728b``."""
    number = text.strip().lower().rstrip("b").rstrip("kmgtpi")
    return int(number) * _UNITS[text.strip().lower()[len(number):][:1]]


# AQE joins small partitions of a shuffle but splits none that an aggregate or a window needs
# whole, so a shuffle starts with a partition for this much input (rows of a sale take some
# two to three times their compressed column bytes).  The upper end keeps the map side's lists short.
_INPUT_PER_PARTITION = 4 * 1024 * 1024
_MAX_PARTITIONS = 10_000
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def bound_tasks(spark: SparkSession, input_bytes: int = 0) -> None:
    """Lower the session's task sizes to ``_TASK_LIMITS``, smaller ones stay; start shuffles
    with enough partitions for an input of this size, more stay."""
    for k, limit in _TASK_LIMITS.items():
        if _bytes(spark.conf.get(k)) > limit:
            spark.conf.set(k, str(limit))
    wanted = min(-(-input_bytes // _INPUT_PER_PARTITION), _MAX_PARTITIONS)
    if wanted > int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_INITIAL, str(wanted))


def get_session(master: str | None = None, app: str = "shelfmark",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with the engine's semantic settings.

    ``master`` is only used for local runs and tests; on a cluster leave it
    ``None`` so the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("SHELFMARK_DRIVER_MEM", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in _SEMANTIC_CONF.items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in _SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant
    location and is used as is; a cluster run without it is an error (a
    machine-local folder would not survive the loss of that machine).  Only a
    local-mode session (tests, laptops) with the setting unset gets a fresh
    private folder.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store)")
        path = tempfile.mkdtemp(prefix="shelfmark-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    return path
