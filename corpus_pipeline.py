"""The training-data pipeline: rules, exact dedup, near dedup, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage
before kept; its result is written as Parquet and read again as the next one's
`docs`.  All stages but the last return the columns of their input.

A stage's result names the scratch tables in the shared folder that it still
reads (`scratch_of`).  Whoever has written the result may delete them
(`finished`); `run` does, and deletes each stage's table once the next is written.

Defined results, stage by stage: rows with a null or empty text fail the rules
and go; what is left has words.  Rows with a null id are kept like others.  Of
equal texts (repeated rows among them) and of near-duplicates one row stays, the
largest and the smallest id; repeated rows that stay can't be told apart, so both
are in.  The mix may repeat rows.  Texts are processed whole, however long.  Empty
tables pass every stage as empty tables; columns beyond those of documents are
carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import exact_dedup, mixing, near_dedup, pieces, quality_rules
from shelfmark.llm.common import documents, drop_folders, drop_table, materialise, scratch_made

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def scratch_of(result: DataFrame) -> list[str]:
    """Folders that a stage's unwritten result reads."""
    return getattr(result, "_scratch", [])


def finished(result: DataFrame) -> None:
    """Delete a stage's scratch tables, its result having been written."""
    drop_folders(result.sparkSession, scratch_of(result))


def _stage(body: Stage) -> Stage:
    @wraps(body)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with scratch_made() as made:
            out = body(spark, docs, sf_dir)
        out._scratch = made
        return out
    return run_stage


@_stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules and their host's verdict keep."""
    return quality_rules.keep_good(docs)


@_stage
def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts, the row with the largest doc_id."""
    return exact_dedup.keep_distinct(docs)


@_stage
def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8), the smallest doc_id."""
    return near_dedup.keep_one(docs, size=5, percent=80)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mixed_rows(docs)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return pieces.piece_ids(docs, keep=False)  # leaves the workers' memory to the other stages


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("exact_dedup", keep_distinct),
    ("near_dedup", keep_one_of_near),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Near-duplicate groups and token ids are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs, written = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        docs = materialise(result, f"stage-{name}", "snappy")
        finished(result)
        if written is not None:
            drop_table(written)
        written = docs
    return STAGES[-1][1](spark, docs, sf_dir)
