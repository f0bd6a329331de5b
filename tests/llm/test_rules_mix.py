import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from corpus_fixtures import SCHEMA, rows_of

from shelfmark.llm import mixing, quality_rules
from shelfmark.llm.common import WORD

W = re.compile(WORD)


def brute_counts(text):
    t = text or ""
    words = W.findall(t)
    lines = [x for x in t.split("\n") if W.search(x)]
    windows = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines)) if len(lines) < 3000 else len(lines) - len(set(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(covered), len(lines)


def brute_judge(rows):
    """Rows as `judge` gives them, by id: counts, base_failed, kept."""
    counts = [brute_counts(r[1]) for r in rows]
    base = [n < 10 or 100 * rep > 20 * n for n, _, _, _, rep, _ in counts]
    soft = [[10 * p * s > n or 100 * p * d > 50 * ln for n, _, s, d, _, ln in counts] for p in (1, 2)]
    hosts = defaultdict(list)
    for i, r in enumerate(rows):
        hosts[r[3]].append(i)
    n_all, h = len(rows), len(hosts)
    k = {x: sum(base[i] or soft[0][i] for i in ids) for x, ids in hosts.items()}
    m = sum(k.values()) / n_all
    ss = sum(len(ids) * (k[x] / len(ids) - m) ** 2 for x, ids in hosts.items())
    noise = (h - 1) / n_all
    rho = (ss / n_all / (m * (1 - m)) - noise) / (1 - noise) if 0 < m < 1 and noise < 1 else 0.0
    c = 1 / max(1e-6, min(0.999, rho)) - 1
    rate = {x: (k[x] + c * m) / (len(ids) + c) for x, ids in hosts.items()}
    out = []
    for i, r in enumerate(rows):
        q = rate[r[3]]
        limit = False if q <= 0.02 else soft[1][i] if q > 0.5 else soft[0][i]
        out.append((r[0], *counts[i][:5], base[i], not base[i] and not limit))
    return sorted(out, key=repr)


def judged(docs):
    out = quality_rules.judge(docs, carry=["doc_id"])
    return rows_of(out.select("_row.doc_id", "_n_words", "_word_chars", "_n_symbols", "_n_dup_lines", "_n_repeat_words", "_base_failed", "_kept"))


def test_rules_brute_force(edge_docs, clash_docs, empty_docs, edge_rows):
    expected = brute_judge(edge_rows)
    assert judged(edge_docs) == expected == judged(clash_docs)
    assert judged(empty_docs) == []
    kept = quality_rules.keep_good(clash_docs)
    assert kept.columns == clash_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((x[0] for x in expected if x[-1]), key=repr)


def test_rules_on_hosts(spark):
    """A clean host tolerates a symbol-heavy page, others don't; clean pages stay on the worst host."""
    clean = " ".join(f"word{i}" for i in range(40))
    symbols, light = clean + " #" * 6, clean + " #" * 3
    rows = [(i, clean, None, "clean", None) for i in range(200)] + [(300, symbols, None, "clean", None)]
    rows += [(400 + i, symbols if i % 4 else clean, None, "bad", None) for i in range(200)] + [(700, light, None, "bad", None)]
    rows += [(800 + i, symbols if i % 5 == 0 else light, None, "mixed", None) for i in range(100)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert judged(docs) == brute_judge(rows)
    got = {r._row.doc_id: (r._host_verdict, r._kept) for r in quality_rules.judge(docs, carry=["doc_id"]).collect()}
    assert got[300] == ("trusted", True) and got[401] == ("bad", False) and got[400] == ("bad", True)
    assert got[700] == ("bad", False) and got[801] == ("ordinary", True) and got[800] == ("ordinary", False)


def test_rules_plan_is_native(spark):
    plan = quality_rules.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def brute_mix(rows, weights=(5, 2, 1), epochs=3):
    size = [len(W.findall(r[1] or "")) for r in rows]
    by = defaultdict(list)
    for i, r in enumerate(rows):
        by[r[3]].append(i)
    names = sorted((x for x in by if x is not None), key=lambda x: [ord(c) for c in x]) + ([None] if None in by else [])
    w = {x: weights[i % len(weights)] for i, x in enumerate(names)}
    s = {x: sum(size[i] for i in by[x]) for x in names}
    target, free, rest = {}, set(names), Fraction(sum(s.values()))
    while free:  # share by weight; cap what is above, and share the excess again
        total = sum(w[x] for x in free)
        above = {x for x in free if rest * w[x] / total > epochs * s[x]}
        if not above:
            target |= {x: rest * w[x] / total for x in free}
            break
        target |= {x: Fraction(epochs * s[x]) for x in above}
        rest -= sum(epochs * s[x] for x in above)
        free -= above
    out = []
    for x in names:
        places = defaultdict(list)
        for i in by[x]:
            places[hashlib.md5(f"mix:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest(), rows[i][0], rows[i][1]].append(i)
        full = int(target[x] // s[x]) if s[x] else 0
        out += [(x, full, target[x] - full * s[x], places)]
    return size, s, target, out


def test_mix_against_plain_loop(edge_docs, clash_docs, empty_docs, edge_rows):
    size, s, target, _ = brute_mix(edge_rows)
    got = rows_of(mixing.mix(edge_docs))
    assert got == rows_of(mixing.mix(clash_docs)) == rows_of(mixing.mix(edge_docs))  # reruns agree
    expected = sorted((r[0], n, s[r[3]], float(target[r[3]])) for r, n in zip(edge_rows, size, strict=True) if r[0] is not None)
    known = sorted(x[:4] for x in got if x[0] is not None)
    assert [x[:3] for x in known] == [x[:3] for x in expected] and [x[3] for x in known] == pytest.approx([x[3] for x in expected])
    assert all(t <= 3 * n and t % max(n, 1) == 0 for _, n, _, _, t in got)
    assert mixing.mix(empty_docs).count() == 0 and mixing.mixed_rows(empty_docs).count() == 0


def test_mix_budgets(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), None, "s0" if i % 3 == 0 else f"s{i % 11}", None) for i in range(3_000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    size, s, target, order = brute_mix(rows)
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    taken = defaultdict(int)
    for r in rows:
        taken[r[3]] += got[r[0]].taken
    assert sum(float(x) for x in target.values()) == pytest.approx(sum(size))
    for x, t in target.items():
        assert abs(taken[x] - t) <= 7 and got[next(r[0] for r in rows if r[3] == x)].target == pytest.approx(float(t))
    for x, full, budget, places in order:
        before = 0
        for place in sorted(places, key=lambda p: (p[0], p[1])):
            for i in places[place]:
                more = 2 * before + size[i] <= 2 * budget
                assert got[rows[i][0]].taken == size[i] * (full + more)
                before += size[i]
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert all(times[i] * size[i] == r.taken for i, r in got.items())


def test_mix_caps_all_small_sources(spark):
    """One source holds nearly everything, all others stop at three times their size."""
    rows = [(i, "a b c", None, "z", None) for i in range(500)] + [(1000 + i, "a b", None, f"a{i}", None) for i in range(4)] + [(2000, None, None, "none", None)]
    got = {(r.source_size, r.target) for r in mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1500, 1500.0 + 8 - 24), (2, 6.0), (0, 0.0)}
