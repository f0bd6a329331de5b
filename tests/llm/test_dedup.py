import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import exact_dedup, near_dedup
from shelfmark.llm.common import words_of
from shelfmark.llm import graph
from shelfmark.llm.graph import components
from corpus_fixtures import SCHEMA, prose, rows_of, word


def test_directory_doubles_until_buckets_fit():
    rng = random.Random(1)
    cells = {c: rng.randint(1, 50) for c in rng.sample(range(256), 120)}
    for capacity in (1, 60, 300, 10_000):
        d = exact_dedup.grow_directory(cells, capacity, cell_bits=8)
        assert len(d) & (len(d) - 1) == 0 and d == sorted(d) and set(d) == set(range(max(d) + 1))
        depth = len(d).bit_length() - 1
        load, width = defaultdict(int), defaultdict(int)
        for c, n in cells.items():
            load[d[c >> (8 - depth)]] += n
            width[d[c >> (8 - depth)]] = d.count(d[c >> (8 - depth)]) << (8 - depth)
        assert all(n <= capacity or width[b] == 1 for b, n in load.items())
    assert exact_dedup.grow_directory({}, 10) == [0]


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = max(known) if known else None
        n_best = 0
        for i in ids:
            kept = i == best and not n_best
            n_best += kept
            out.append((i, best, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_bytes", [1, 2_000, 16 << 20])
def test_exact_dedup_brute_force(edge_docs, edge_rows, bucket_bytes):
    assert rows_of(exact_dedup.exact_dedup(edge_docs, bucket_bytes=bucket_bytes)) == brute_exact(edge_rows)


def test_exact_dedup_colliding_keys(spark, monkeypatch, edge_docs, edge_rows):
    # All texts under a few keys: only the comparison of texts tells them apart.
    monkeypatch.setattr(exact_dedup, "key_of", lambda t: (F.length(t) % 3).cast("long"))
    got = exact_dedup.exact_dedup(edge_docs, bucket_bytes=500)
    assert rows_of(got) == brute_exact(edge_rows)


def test_exact_dedup_clash_and_empty(clash_docs, empty_docs, edge_rows):
    assert rows_of(exact_dedup.exact_dedup(clash_docs)) == brute_exact(edge_rows)
    kept = exact_dedup.keep_distinct(clash_docs)
    assert kept.columns == clash_docs.columns
    got = kept.collect()
    assert len(got) == len({t or "" for _, t, *_ in edge_rows}) == len({r.text or "" for r in got})
    assert {r.doc_id for r in got} == {x[0] for x in brute_exact(edge_rows) if x[3]}
    assert exact_dedup.exact_dedup(empty_docs).count() == 0 and exact_dedup.keep_distinct(empty_docs).columns == empty_docs.columns


def test_exact_dedup_hot_group(spark):
    rows = [(i, "hot copy" if i % 3 == 0 else f"text {i}", None, None, None) for i in range(6_000)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA).repartition(7), bucket_bytes=4_000)
    hot = got.filter("group_size > 1")
    assert hot.count() == 2_000 and hot.filter("kept").collect()[0].doc_id == 5_997
    assert got.filter("kept").count() == 4_001


def sets_of(rows, size):
    out = {}
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out[i, t] = frozenset(zip(*(w[k:] for k in range(size)), strict=False)) if len(w) >= size else frozenset([tuple(w)]) if w else frozenset()
    return out


def brute_groups(rows, size, percent=80):
    """(id, text) -> (shingles, smallest id reachable)."""
    sets = sets_of(rows, size)
    nodes = list(sets)
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(nodes):
        for y in nodes[i + 1:]:
            both = len(sets[x] & sets[y])
            if both and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                root[find(x)] = find(y)
    ids = defaultdict(list)
    for x in nodes:
        ids[find(x)].append(x[0])
    return {x: (len(sets[x]), min((i for i in ids[find(x)] if i is not None), default=None)) for x in nodes}


@pytest.mark.parametrize("size", [2, 5])
def test_near_dedup_brute_force(edge_docs, edge_rows, size):
    expected = brute_groups(edge_rows, size)
    got = near_dedup.near_dedup(edge_docs, size=size).join(
        edge_docs.select(F.col("doc_id").alias("d"), "text", F.xxhash64("text").alias("t")).distinct(), F.expr("_tie = t and _id <=> d"))
    n = 0
    for r in got.collect():
        assert (r._n, r._best.id) == expected[r._id, r.text], (r._id, r.text)
        n += 1
    assert n == len(edge_rows)


def test_near_dedup_blocks_and_chunks(spark, monkeypatch):
    """Tiny chunks and blocks: long lists meet in rounds, components are worked off in pairs of blocks."""
    rng = random.Random(3)
    base = [prose(rng, 80).split() for _ in range(3)]
    rows = []
    for i in range(150):
        w = list(base[i % 3])
        for _ in range(rng.choice([0, 1, 2, 4, 6, 9])):
            w[rng.randrange(len(w))] = word(rng)
        rows.append((i, " ".join(w), None, None, None))
    docs = spark.createDataFrame(rows, SCHEMA)
    expected = {x[0]: v[1] for x, v in brute_groups(rows, 2).items()}
    for chunk, block in ((4096, 1024), (8, 5)):
        monkeypatch.setattr(near_dedup, "CHUNK", chunk)
        monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
        got = {r._id: r._best.id for r in near_dedup.near_dedup(docs).collect()}
        assert got == expected


def test_near_dedup_keeps_columns(clash_docs, empty_docs, edge_rows):
    kept = near_dedup.keep_one(clash_docs, size=5)
    assert kept.columns == clash_docs.columns
    groups = brute_groups(edge_rows, 5)
    best = {v[1] for v in groups.values() if v[0]}
    ids = {r.doc_id for r in kept.collect()}
    assert best - {None} <= ids and {1, 2, 3} <= ids
    assert not any(x[0] in ids for x, v in groups.items() if v[0] and x[0] is not None and x[0] != v[1])
    assert near_dedup.keep_one(empty_docs).count() == 0 and near_dedup.near_dedup(empty_docs).count() == 0


def test_near_dedup_on_sf001_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = {x[0]: v for x, v in brute_groups(rows, 2).items()}
    got = near_dedup.query(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_match_threshold_is_far_below_links():
    """Pairs at the similarity limit agree in far more bytes than the threshold, and meet in some coordinate."""
    rng = np.random.default_rng(1)
    for n in (9, 45, 450):
        for _ in range(40):
            x = rng.integers(0, 1 << 63, n + n // 8, dtype=np.uint64) * np.uint64(2)
            a, b = np.unique(x[:n]), np.unique(x[n // 8:])  # J = (n - n/8) / (n + n/8), about 0.78
            s = np.stack([near_dedup.signature(a), near_dedup.signature(b)])
            low = s[:, near_dedup.MINIMA:] >> np.uint32(24)
            assert (low[0] == low[1]).sum() >= near_dedup.MATCHES
            k = near_dedup.coordinates(s[:, :near_dedup.MINIMA])
            assert (k[0] == k[1]).any()


def test_words():
    assert words_of("A\x0bÉb\x85c d") == ["a".encode(), "Éb\x85c d".encode()] and words_of(None) == []


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "t").collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_components_over_several_tasks(spark):
    """Long chains, cycles and a hub whose links lie in different tasks and contracted blocks."""
    rng = np.random.default_rng(5)
    names = rng.permutation(600).astype(np.int64) - 300
    pairs = [(i, i + 1) for i in range(0, 199)] + [(200 + i, 200 + (i + 1) % 50) for i in range(50)] + [(300, j) for j in range(301, 600)]
    links = [(int(names[a]), int(names[b])) for a, b in pairs] + [(int(names[7]), int(names[7])), (int(names[3]), int(names[4]))]
    expected = {}
    for part in (range(0, 200), range(200, 250), range(300, 600)):
        low = int(min(names[i] for i in part))
        expected |= {int(names[i]): low for i in part}
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [(r.node, r.root) for r in components(spark.createDataFrame(links, "a long, b long").repartition(7), "t").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)
    assert len(got) == len(expected) and dict(got) == expected


def test_contraction_keeps_components():
    rng = np.random.default_rng(6)
    for n, m in ((10, 3), (200, 150), (200, 400)):
        u, v = rng.integers(-n, n, (2, m))
        got = graph._stars_of([pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])])
        label = {int(x): int(x) for x in (*u, *v)}
        for _ in label:
            for a, b in zip(u.tolist(), v.tolist(), strict=True):
                label[a] = label[b] = min(label[a], label[b])
        assert dict(zip(got["u"].to_pylist(), got["v"].to_pylist(), strict=True)) == {x: r for x, r in label.items() if x != r}
