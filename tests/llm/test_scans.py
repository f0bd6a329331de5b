import hashlib
import math
import random
import re
from collections import Counter

import pytest
from corpus_fixtures import SCHEMA, rows_of

from shelfmark.llm import licenses, secrets

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute_licence(text):
    words = WORDS.findall(lower(text))
    starts, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i: i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


LICENCE_TEXTS = [
    "Released under the MIT License.", "mit license mit\nlicense MIT-LICENSE apache_license the general   public license",
    "Licensed under the Apache License, Version 2.0.", "GNU Lesser General Public License, version 3", "permit license; mit licenses",
    "éMIT License", "mit é license", "CC BY-NC 4.0 all rights reserved", "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND BSD-3-Clause\nint x;",
]


@pytest.mark.parametrize("text", [*LICENCE_TEXTS, None, "", " ", "mit license " * 3000])
def test_licence_base_places(text):
    got = licenses.scan(text)
    assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == brute_licence(text)
    assert set(filter(None, got["base_labels"].split(","))) <= set(got["labels"].split(",")) and 0 <= got["score"] <= 1


def test_licence_expressions():
    assert licenses.to_postfix("a or b and c with d") == ["a", "b", "c", "d", "with", "and", "or"]
    assert licenses.to_postfix("(a or b) and c") == ["a", "b", "or", "c", "and"]
    for bad in ("", "(a", "a)", "a or", "and a", "a b", "()"):
        assert licenses.to_postfix(bad) is None
    assert licenses.evaluate("MIT OR GPL-3.0-only") == ({"mit", "gpl-3.0-only"}, 0.1)
    assert licenses.evaluate("MIT AND GPL-3.0-only")[1] == 0.6
    named, score = licenses.evaluate("GPL-2.0+ WITH Classpath-exception-2.0")
    assert named == {"gpl-2.0"} and 0.1 < score < 0.6
    assert licenses.evaluate("(MIT OR")[0] == {"mit"}
    got = licenses.scan(LICENCE_TEXTS[-1])
    assert got["labels"] == "bsd-3-clause,gpl-2.0-only,mit" and got["score"] == 0.1
    long = "SPDX-License-Identifier: " + " AND ".join(["MIT"] * 400 + ["GPL-3.0-only"])
    assert "gpl-3.0-only" in licenses.scan(long)["labels"]


def test_licence_table(edge_docs, clash_docs, empty_docs, edge_rows):
    expected = sorted(((r[0], *brute_licence(r[1])) for r in edge_rows), key=repr)
    for docs in (edge_docs, clash_docs):
        assert rows_of(licenses.license_scan(docs), "labels", "score", "unknown_ids") == expected
    assert licenses.license_scan(empty_docs).count() == 0


def test_licence_query_whole_table(spark):
    got = licenses.query(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(got, "labels", "score", "unknown_ids") == sorted(((r.doc_id, *brute_licence(r.text)) for r in docs), key=repr)


def brute_base_spans(text):
    text, out = text or "", []
    name = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    out += [(m.start(), 0, m.end()) for m in re.finditer(name + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def base_row(text):
    spans = brute_base_spans(text)
    n = Counter(k for _, k, _ in spans)
    said = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
    return n[0], n[1], n[2], hashlib.sha256(said.encode()).hexdigest()


def random_secret_text(rng):
    parts = ["token", "PassWD", "api_key", "apikey", "secret", "= ", ":", " ", "  ", "'", '"', "AKIA", "ABCDEF0123456789", "deadbeef" * 3, "x", "ſecret", "Kelvin toKen=", "é",
             "abcdef", "=", "0123456789abcdef01234567", "\n", "aB3dE5gH7jK9mN1pQ3sT5vW7", "AKIAAKIA", "-_/+."]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))


def test_secret_base_spans_brute_force():
    rng = random.Random(4)
    for _ in range(3_000):
        text = random_secret_text(rng)
        got = secrets.digest(text)
        assert got[:4] == base_row(text), text
        spans = [x.rsplit(":", 2) for x in got[4].split(",") if x]
        assert all(0 <= int(a) < int(b) <= len(text) for _, a, b in spans)
        assert [f"{k}:{a}:{b}" for k, a, b in spans if k in secrets.KINDS[:3]] == [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in brute_base_spans(text)]


def test_entropy_windows_equal_direct_computation():
    rng = random.Random(6)
    for _ in range(200):
        s = "".join(rng.choice("abcXYZ0123456789defGHI+/" if rng.random() < 0.7 else "aA1") for _ in range(rng.randint(20, 60)))
        hot = set()
        for i in range(len(s) - secrets.WINDOW + 1):
            w = s[i: i + secrets.WINDOW]
            bits = -sum(c / 20 * math.log2(c / 20) for c in Counter(w).values())
            upper, low, digit = (any(f(c) for c in w) for f in (str.isupper, str.islower, str.isdigit))
            kind = "entropy_hex" if set(w) <= set("0123456789abcdefABCDEF") and digit and not (upper and low) else "entropy_key" if upper and low and digit else None
            if kind and bits >= secrets.LIMITS[kind] + 1e-9:
                hot |= set(range(i, i + secrets.WINDOW))
        spans = secrets.entropy_spans(s)
        assert hot <= {p for _, a, b in spans for p in range(a, b)}
        assert all(b - a >= secrets.WINDOW for _, a, b in spans)


def test_entropy_finds_keys_and_allow_list_suppresses():
    key = "9fJ2kLq0ZxW8vB3nM5rT7yU1"
    assert secrets.scan(f"see {key} here") == [("entropy_key", 4, 28)]
    for known in ("123e4567-e89b-12d3-a456-426614174000", "2024-01-01_10-20-30-000001", "YOUR_KEY_9fJ2kLq0ZxW8vB3nM5rT", "sha256-9fJ2kLq0ZxW8vB3nM5rT7yU1"):
        assert not [x for x in secrets.scan(f"id {known}.") if x[0].startswith("entropy")]
    assert [x[0] for x in secrets.scan(f'token = "{key}"')] == ["assign"]  # an overlapped span is not added
    assert secrets.scan("thehandofreorethblendionerertheron" * 5) == []
    assert secrets.scan(None) == [] and secrets.digest(None)[4] == ""
    assert len(secrets.scan((key + " ") * 20_000)) == 20_000


def test_secret_table(edge_docs, clash_docs, empty_docs, edge_rows, spark):
    expected = sorted(((r[0], *base_row(r[1])) for r in edge_rows), key=repr)
    for docs in (edge_docs, clash_docs):
        assert rows_of(secrets.secret_scan(docs), "spans") == expected
    assert secrets.secret_scan(empty_docs).count() == 0
    rng = random.Random(8)
    rows = [(i, random_secret_text(rng), None, None, None) for i in range(200)]
    assert rows_of(secrets.secret_scan(spark.createDataFrame(rows, SCHEMA)), "spans") == sorted(((r[0], *base_row(r[1])) for r in rows), key=repr)


def test_secret_query_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(secrets.query(spark, "/root/testdata/sf0.001"), "spans") == sorted(((r.doc_id, *base_row(r.text)) for r in docs), key=repr)


def test_licence_labels_come_from_the_list_only():
    def labels(text, known=None):
        got = licenses.scan(text, known)
        return got["labels"], got["unknown_ids"], got["score"]

    tag = "SPDX-License-Identifier"
    for prose in ("the spdx license identifier is a good idea", f"{tag}:", f"{tag}:\nMIT", f"{tag}: see LICENSE file", f"{tag} MIT", f"{tag}: and then"):
        assert labels(prose) == ("", "", 0.0), prose
    assert labels(f"{tag}: MIT.") == ("mit", "", 0.1)
    assert labels(f"{tag}: (MIT OR GPL-2.0+) is used here") == ("gpl-2.0,mit", "", 0.1)
    assert labels(f"{tag}: GPL-2.0-only WITH Classpath-exception-2.0 AND MIT */") == ("gpl-2.0-only,mit", "", 0.4)
    assert labels(f"{tag}: LicenseRef-Own OR MIT or later") == ("licenseref-own,mit", "", 0.1)
    assert labels(f"{tag}: Frob-2.7 OR MIT") == ("", "frob-2.7", 0.0)
    assert labels(f"{tag}: MIT AND Frob-2.7") == ("mit", "frob-2.7", 0.1)
    assert labels(f"{tag}: (MIT AND (ISC") == ("isc,mit", "", 0.1)
    assert labels(f"{tag}: Frob-2.7 WITH odd", licenses.LicenceList(["Frob-2.7", "exception odd"])) == ("frob-2.7", "", 0.35)


def direct_spans(text):
    """All spans of a text, every window judged anew."""
    text = text or ""
    base = [(secrets.KINDS[k], a, b) for a, k, b in brute_base_spans(text)]
    out = list(base)
    for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
        s = m[0]
        if len(s) < 20 or secrets.allowed(s):
            continue
        spans = []
        for i in range(len(s) - 19):
            w = s[i: i + 20]
            n = Counter(w)
            bits = math.log2(20) - sum(c * math.log2(c) for c in n.values()) / 20
            upper, low, digit = (bool(re.search(p, w)) for p in ("[A-Z]", "[a-z]", "[0-9]"))
            kind = "entropy_hex" if re.fullmatch("[0-9a-fA-F]+", w) and digit and not (upper and low) else "entropy_key" if upper and low and digit else None
            if kind is None or bits < secrets.LIMITS[kind] - 1e-12:
                continue
            if spans and spans[-1][0] == kind and spans[-1][2] >= i:
                spans[-1][2] = i + 20
            else:
                spans.append([kind, i, i + 20])
        for kind, a, b in spans:
            covered = sum(len(x) for x in re.findall(secrets._PLACEHOLDER.pattern, s[a:b], re.I))
            a, b = a + m.start(), b + m.start()
            if 2 * covered < b - a and not secrets.allowed(text[a:b]) and not any(x < b and y > a for _, x, y in base):
                out.append((kind, a, b))
    return secrets.joined(out)


def test_all_secret_spans_equal_direct_ones(spark, edge_rows):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
    marks = ["xxxx", "1234567", "example", "0000000", "abcdefghijkl", " ", "\n", "=", "your_key"]
    texts = ["".join(rng.choice(marks) if rng.random() < .2 else "".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(rng.randint(0, 8))) for _ in range(1500)]
    texts += [r[1] for r in edge_rows] + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for text in texts:
        assert secrets.joined(secrets.scan(text)) == direct_spans(text), text


def test_a_placeholder_inside_a_key_hides_nothing_else():
    rng = random.Random(1)
    blob = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=2000))
    covered = lambda t: sum(b - a for _, a, b in secrets.scan(t))
    assert covered(blob) == 2000 and covered(blob[:1000] + "xxxx" + blob[1000:]) >= 1990
    assert covered(blob[:17] + "1234567" + blob[17:33]) >= 30  # windows with too many equal characters at its ends aside
    assert covered("ABCDEFG" + "abcdefghijklmnopqrstuvwxyz" + "1234567890") == 0
