import hashlib
import os

import corpus_pipeline
from shelfmark.session import checkpoint_dir
import pytest
import sentencepiece
from test_dedup import brute_groups
from test_rules_mix import brute_judge, brute_mix

from shelfmark.llm import pieces, registry

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_pipeline(rows):
    """Document rows after each stage, then (doc_id, ids)."""
    out = []
    kept = {x[0] for x in brute_judge(rows) if x[-1]}
    rows = [r for r in rows if r[0] in kept]
    out.append(rows)
    last = {}
    for r in rows:
        if r[1] not in last or r[0] > last[r[1]]:
            last[r[1]] = r[0]
    rows = [r for r in rows if last[r[1]] == r[0]]
    out.append(rows)
    groups = brute_groups(rows, 5)
    rows = [r for r in rows if groups[r[0], r[1]][1] in (r[0], None)]
    out.append(rows)
    size, _, _, order = brute_mix(rows)
    mixed = []
    for _, full, budget, places in order:
        before = 0
        for place in sorted(places, key=lambda p: (p[0], p[1])):
            for i in places[place]:
                n = full + (2 * before + size[i] <= 2 * budget) if size[i] else 0
                mixed += [rows[i]] * n
                before += size[i]
    out.append(mixed)
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    out.append([(r[0], model.encode(r[1])) for r in mixed])
    return out


@pytest.fixture(scope="module")
def expected(spark):
    return brute_pipeline([tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS).collect()])


def test_every_stage_against_brute_force(spark, expected, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if n < 4:
            assert docs.columns == COLUMNS
            assert sorted(tuple(r) for r in docs.collect()) == sorted(expected[n]), name
        else:
            assert sorted((r.doc_id, r.ids) for r in docs.collect()) == sorted(expected[n])


def test_run(spark, expected):
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.ids) for r in got.collect()) == sorted(expected[-1])


def test_stages_on_awkward_tables(spark, clash_docs, empty_docs, tmp_path):
    for k, docs in enumerate((clash_docs, empty_docs)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            out.write.parquet(str(tmp_path / f"{k}-{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{k}-{name}"))
            if name != "sentencepiece":
                assert docs.columns == columns


def test_chained_stages_without_writes_and_two_runs_at_once(spark, expected):
    """No stage deletes what another's unwritten result still reads."""
    docs, other = corpus_pipeline.documents(spark, SF), corpus_pipeline.documents(spark, SF)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if other is not None:
            other = stage(spark, other, SF)
            corpus_pipeline.finished(other)  # deletes the other run's tables only
            other = None
    assert sorted((r.doc_id, r.ids) for r in docs.collect()) == sorted(expected[-1])


def test_a_run_leaves_one_stage_table(spark, expected):
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    corpus_pipeline.run(spark, SF)
    left = {x.split("-")[1] for x in set(os.listdir(folder)) - before}
    assert left == {"stage"}


def test_registry():
    assert [n.split("_")[0] for n in registry.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(registry.ORACLE) <= set(registry.QUERIES)
    import __spark_entry__
    assert "pipeline" in __spark_entry__.queries() and set(registry.QUERIES) <= set(__spark_entry__.queries())


def test_no_tokenizer_file_in_the_repository():
    model = hashlib.sha256(open(pieces.MODEL, "rb").read()).hexdigest()
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for d, _, names in os.walk(root):
        if ".git" not in d:
            for n in names:
                if n.endswith((".model", ".tiktoken")):
                    assert hashlib.sha256(open(os.path.join(d, n), "rb").read()).hexdigest() != model
