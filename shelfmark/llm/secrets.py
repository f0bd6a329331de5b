"""Secret scan: fixed patterns plus sliding-window Shannon entropy with allow-list suppression.

Patterns (base): assignments to password-like names, access key ids, long
lower-case hex strings.  On top, every maximal run of 20 or more key-like
characters is a candidate.  A window of 20 characters slides over it; the counts
of its characters are updated by one leaving and one entering character, and
with them the sum of c*log2(c), so each step costs O(1).  Windows are judged by
their character class: hex digits only, or letters of both cases with digits;
runs of windows above the class's entropy limit become one span.

The allow-list suppresses a candidate only as a whole (an identifier of documents,
a plain number, a well-known hash value, an integrity attribute, a short name
that begins with a placeholder word), and a span only where placeholders (words,
repeated characters, counted-up digits or letters) cover at least half of it; a
placeholder inside a longer key hides nothing else.  A span that a base span
overlaps is not added.

Defined results: null text counts as empty (no spans); very long texts are
scanned whole, long candidates in one pass; repeated rows are scanned like any
other; an empty table gives an empty result.  Only id and text are read.
Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import ascii_lower, bounded_batches, documents

# The base patterns and the least length of what they find.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_key")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

WINDOW = 20
_CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}")
# Bits per character from which a window counts as random, by class.
LIMITS = {"entropy_hex": 3.0, "entropy_key": 3.7}
_HEX_DIGITS = frozenset("0123456789abcdefABCDEF")
_ALLOWED = [
    re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", re.I),  # UUID
    re.compile(r"[0-9_=+/-]+"),  # numbers, dates
    re.compile(r"(example|sample|dummy|placeholder|your[_-]?key)[_=+/-].{0,48}", re.I),
    re.compile(r"sha(1|256|384|512)-[A-Za-z0-9+/=_-]{1,96}", re.I),  # integrity attributes
]


def _counted_up(characters: str, least: int) -> str:
    """Pattern of the first `least` characters and as many of the next as follow."""
    more = ""
    for c in reversed(characters[least:]):
        more = f"(?:{c}{more})?"
    return characters[:least] + more


_PLACEHOLDER = re.compile("|".join([
    "example", "sample", "dummy", "placeholder", "your[_-]?key", "x{4,}", "0{7,}",
    _counted_up("0123456789abcdef", 8), _counted_up("1234567890", 7), _counted_up("abcdefghijklmnopqrstuvwxyz", 7)]), re.I)
# Hashes of the empty input, common in manifests.
_KNOWN = {hashlib.new(a, b"").hexdigest() for a in ("md5", "sha1", "sha224", "sha256", "sha384", "sha512")}

# Candidate characters become 'a', all others a space: a quick look for any candidate at all.
_CLASS = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
_MARK = bytes(97 if c in _CLASS else 32 for c in range(256))
_RUN = b"a" * WINDOW
_COST = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def allowed(s: str) -> bool:
    """Whether the allow-list knows a candidate as a whole."""
    return s.lower() in _KNOWN or any(p.fullmatch(s) for p in _ALLOWED)


def placeholder(s: str) -> bool:
    """Whether placeholders cover at least half of a span."""
    return 2 * sum(m.end() - m.start() for m in _PLACEHOLDER.finditer(s)) >= len(s)


def entropy_spans(s: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the high-entropy parts of one candidate, merged over overlapping windows."""
    counts: dict[str, int] = {}
    cost, kinds = 0.0, [0, 0, 0, 0]  # digits, upper, lower, characters beyond hex
    spans: list[list] = []

    def move(ch: str, by: int) -> None:
        nonlocal cost
        n = counts.get(ch, 0)
        cost += _COST[n + by] - _COST[n]
        counts[ch] = n + by
        kinds[0] += by * ("0" <= ch <= "9")
        kinds[1] += by * ("A" <= ch <= "Z")
        kinds[2] += by * ("a" <= ch <= "z")
        kinds[3] += by * (ch not in _HEX_DIGITS)

    for i, ch in enumerate(s):
        move(ch, 1)
        if i >= WINDOW:
            move(s[i - WINDOW], -1)
        if i < WINDOW - 1:
            continue
        bits = math.log2(WINDOW) - cost / WINDOW
        digits, upper, lower, other = kinds
        kind = "entropy_hex" if not other and digits and (upper == 0 or lower == 0) else "entropy_key" if digits and upper and lower else None
        if kind and bits >= LIMITS[kind]:
            start = i - WINDOW + 1
            if spans and spans[-1][0] == kind and spans[-1][2] >= start:
                spans[-1][2] = i + 1
            else:
                spans.append([kind, start, i + 1])
    return [tuple(x) for x in spans]


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of one text, base spans first by kind."""
    if not text:
        return []
    low = ascii_lower(text)
    spans = []
    if b"passw" in low or b"secret" in low or b"token" in low or b"api" in low:
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if _RUN not in low.translate(_MARK):
        return spans
    spans += [("hex", *m.span()) for m in _HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    base = sorted((a, b) for _, a, b in spans)
    at = 0
    for m in _CANDIDATE.finditer(text):
        if allowed(m[0]):
            continue
        for kind, a, b in entropy_spans(m[0]):
            a, b = a + m.start(), b + m.start()
            while at < len(base) and base[at][1] <= m.start():
                at += 1
            if allowed(text[a:b]) or placeholder(text[a:b]) or any(x < b and y > a for x, y in _until(base, at, b)):
                continue
            spans.append((kind, a, b))
    return spans


def _until(base: list[tuple[int, int]], at: int, end: int) -> Iterator[tuple[int, int]]:
    while at < len(base) and base[at][0] < end:
        yield base[at]
        at += 1


def joined(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))))


def digest(text: str | None) -> tuple:
    """n_assign, n_access, n_hex, base_sha256, spans of one text."""
    spans = scan(text)
    base = [x for x in spans if x[0] in KINDS[:3]]
    return (*(sum(x[0] == k for x in base) for k in KINDS[:3]), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))


_OUT = pa.schema([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = list(zip(*(digest(x) for x in b["_text"].to_pylist()), strict=True)) or [()] * len(_OUT)
        yield pa.RecordBatch.from_arrays([b["_id"], *(pa.array(x, f.type) for x, f in zip(found, _OUT, strict=True))], names=["doc_id", *_OUT.names])


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(_scan_batches, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: secret scan of the whole documents table."""
    return secret_scan(documents(spark, sf_dir))
