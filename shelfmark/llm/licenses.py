"""Licence scan: Aho-Corasick over notice phrases and identifier tags, expressions by shunting-yard.

A text is reduced to its words (lower-cased A-Z, digits and non-ASCII
characters; everything else separates), joined by single spaces.  One
automaton holds every phrase framed by spaces, so all places where a phrase's
words stand consecutively, overlapping ones included, come out of one pass.
Phrases of the base table give `n_base`, `first_word`, `last_word` and
`base_labels`.  Further notices give labels of the method.  Where the
identifier tag occurs with its colon, the longest licence expression behind it on
the same line is parsed by a shunting-yard (WITH binds tighter than AND, AND tighter than OR, parentheses,
`+` for later versions) and evaluated: every licence named gives a label, the
terms of the expression a restrictiveness (OR: the mildest choice, AND: the
strictest part, WITH: an exception halves the step above permissive terms).

An operand of an expression is an identifier of the licence list or a `LicenseRef-`;
behind WITH stands one of its exceptions.  The list is a parameter: a file with one
identifier a line, exceptions behind the word `exception`; without a file, a list
of common ones.  Any other word ends the expression; if it has the shape of an
identifier (a digit or hyphen inside), it goes to `unknown_ids` and is no label.

`score` is the restrictiveness of the document: the strictest of its notices
and expressions, 0 without any.  A malformed expression counts with all the
licences it names, as if joined by AND.

Defined results: null text counts as empty (no words, labels '', score 0);
very long texts are scanned whole; repeated rows are scanned like any other;
an empty table gives an empty result.  Only id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import ascii_lower, bounded_batches, documents

# Phrases of the base scan and their labels.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Notice phrases of the method, as words.
NOTICES = {
    "permission is hereby granted free of charge to any person": "mit",
    "apache license version 2 0": "apache-2.0",
    "licensed under the apache license": "apache",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc0 1 0": "cc0",
    "cc by 4 0": "cc-by",
    "cc by sa 4 0": "cc-by-sa",
    "cc by nc 4 0": "cc-by-nc",
    "cc by nd 4 0": "cc-by-nd",
    "cc by nc sa 4 0": "cc-by-nc-sa",
    "cc by nc nd 4 0": "cc-by-nc-nd",
    "free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
# Restrictiveness by the first matching prefix of a label; other labels count as UNKNOWN.
TERMS = {
    "cc0": 0.05, "unlicense": 0.05, "mit": 0.1, "isc": 0.1, "bsd": 0.1, "bsl": 0.1, "apache": 0.15,
    "cc-by-nc": 0.8, "cc-by-nd": 0.7, "cc-by-sa": 0.4, "cc-by": 0.2, "mpl": 0.4, "epl": 0.4,
    "lgpl": 0.5, "agpl": 0.8, "gpl": 0.6, "proprietary": 1.0,
}
UNKNOWN = 0.5
# Common licence identifiers and exceptions, used where no list is given.
COMMON = """
0bsd afl-3.0 agpl-1.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 artistic-1.0 artistic-2.0
bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 cc-by-3.0 cc-by-4.0
cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cpl-1.0
ecl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 gfdl-1.3 gfdl-1.3-only gfdl-1.3-or-later gpl-1.0 gpl-2.0 gpl-2.0-only
gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later ipl-1.0 isc lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1
lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later lppl-1.3c mit mit-0 mpl-1.1 mpl-2.0 ms-pl ms-rl
ncsa ofl-1.1 openssl osl-3.0 php-3.01 postgresql psf-2.0 python-2.0 ruby sissl sleepycat unicode-dfs-2016 unlicense
upl-1.0 w3c wtfpl x11 zlib zpl-2.1
"""
COMMON_EXCEPTIONS = """
autoconf-exception-3.0 bison-exception-2.2 classpath-exception-2.0 font-exception-2.0 gcc-exception-2.0
gcc-exception-3.1 linux-syscall-note llvm-exception ocaml-lgpl-linking-exception openjdk-assembly-exception-1.0
"""
PERMISSIVE = 0.2


def terms_of(label: str) -> float:
    """Restrictiveness of one licence, 0 to 1."""
    return next((v for k, v in TERMS.items() if label.startswith(k)), UNKNOWN)


_TOKEN = re.compile(r"\(|\)|[a-z0-9.+:-]+", re.I)
_RANK = {"or": 1, "and": 2, "with": 3}


def to_postfix(expression: str) -> list[str] | None:
    """Shunting-yard: operands and operators in postfix order; None where the expression is malformed."""
    out, stack, operand = [], [], True  # operand: one is expected next
    for token in _TOKEN.findall(expression.lower()):
        if token == "(":
            if not operand:
                return None
            stack.append(token)
        elif token == ")":
            if operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif token in _RANK:
            if operand:
                return None
            while stack and _RANK.get(stack[-1], 0) >= _RANK[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = True
        else:
            if not operand:
                return None
            out.append(token)
            operand = False
    if operand or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(expression: str) -> tuple[set[str], float]:
    """Licences named by an expression and the restrictiveness of its terms."""
    postfix = to_postfix(expression)
    if postfix is None:
        tokens = _TOKEN.findall(expression.lower())
        named = {x.rstrip("+") for i, x in enumerate(tokens)
                 if x not in _RANK and x not in "()" and not (i and tokens[i - 1] == "with")} - {""}
        return named, max(map(terms_of, named), default=0.0)
    named, stack = set(), []
    for token in postfix:
        if token in _RANK:
            b, a = stack.pop(), stack.pop()
            if token == "with":  # the right operand is an exception, not a licence
                named.discard(b[1])
                stack.append((max(min(a[0], PERMISSIVE), (a[0] + PERMISSIVE) / 2), a[1]))
            else:
                stack.append(((min if token == "or" else max)(a[0], b[0]), None))
        else:
            label = token.rstrip("+")
            named.add(label)
            stack.append((terms_of(label), label))
    return named - {""}, stack[0][0]


class LicenceList:
    """Known licence identifiers and exceptions, lower-cased."""

    def __init__(self, lines: list[str] | None = None) -> None:
        if lines is None:
            self.ids, self.exceptions = frozenset(COMMON.split()), frozenset(COMMON_EXCEPTIONS.split())
        else:
            entries = [x.split() for x in (line.lower().strip() for line in lines) if x]
            self.ids = frozenset(e[0] for e in entries if len(e) == 1)
            self.exceptions = frozenset(e[1] for e in entries if len(e) == 2 and e[0] == "exception")

    def knows(self, name: str, exception: bool) -> bool:
        name = name.lower()
        if exception:
            return name in self.exceptions
        return name.rstrip("+") in self.ids or name.startswith("licenseref-")


#: The rest of a line behind the identifier tag and its colon.
_TAGGED = re.compile(r"spdx[-_ ]license[-_ ]identifier[ \t]*:([^\n]*)", re.I | re.A)
_ID_SHAPE = re.compile(r"[a-z0-9.+]*(?:[0-9]|[a-z0-9]-[a-z0-9])[a-z0-9.+-]*", re.I)


def expression_of(line: str, known: LicenceList) -> tuple[str, set[str]]:
    """The longest licence expression a line begins with, and the unknown identifier that ended it, if any."""
    kept, whole, depth, operand, at, unknown = [], 0, 0, True, 0, set()
    for m in _TOKEN.finditer(line):
        if line[at:m.start()].strip():
            break
        token, at = m[0], m.end()
        name = token.rstrip(".:")
        if token == "(" and operand:
            depth += 1
        elif token == ")" and not operand and depth:
            depth -= 1
        elif token.lower() in _RANK and not operand:
            operand = True
        elif operand and known.knows(name, bool(kept) and kept[-1].lower() == "with"):
            token, operand = name, False
        else:
            if operand and _ID_SHAPE.fullmatch(name):
                unknown.add(name.lower())
            break
        kept.append(token)
        if not operand and not depth:
            whole = len(kept)
        if token == name and m[0] != name:  # a full stop or colon ends the line's expression
            break
    # An expression cut off inside its parentheses still names what stands there.
    return " ".join(kept[:whole] or [t for t in kept if t not in "()"]), unknown


# Every byte that is no word character becomes a space; A-Z are lower-cased.
_KEEP = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """All phrases framed by spaces -> (phrase length, base label or None, label or None, is tag)."""
    found = ahocorasick.Automaton()
    phrases = {**dict.fromkeys(BASE), **dict.fromkeys(NOTICES), TAG: None}
    for p in phrases:
        found.add_word(f" {p} ", (len(p), BASE.get(p), NOTICES.get(p), p == TAG))
    found.make_automaton()
    return found


@lru_cache(maxsize=1)
def _common() -> LicenceList:
    return LicenceList()


def scan(text: str | None, known: LicenceList | None = None) -> dict:
    """All columns of one document but its id."""
    known = known or _common()
    words = ascii_lower(text or "").translate(_KEEP).split()
    joined = f" {b' '.join(words).decode('utf-8', 'replace')} "
    starts, base, labels, unknown, score, tagged = [], set(), set(), set(), 0.0, False
    for end, (length, label, notice, tag) in automaton().iter(joined):
        if label:
            starts.append(end - length)
            base.add(label)
        if notice:
            labels.add(notice)
        tagged |= tag
    labels |= base
    score = max(map(terms_of, labels), default=0.0)
    if tagged:
        for m in _TAGGED.finditer(text):
            expression, strange = expression_of(m[1], known)
            unknown |= strange
            named, value = evaluate(expression)
            labels |= named
            score = max(score, value)
    place = lambda at: joined.count(" ", 0, at) - 1  # noqa: E731  spaces before a word, less the leading one
    return {"n_words": len(words), "n_base": len(starts),
            "first_word": place(min(starts)) if starts else None, "last_word": place(max(starts)) if starts else None,
            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": score,
            "unknown_ids": ",".join(sorted(unknown))}


_OUT = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                  ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("unknown_ids", pa.string())])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", licences: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, unknown_ids.

    `licences` is the path of a licence list, read once on the driver (one small file)."""
    bounded_batches(docs.sparkSession)
    lines = None
    if licences:
        with open(licences, encoding="utf-8") as f:
            lines = f.read().splitlines()

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LicenceList(lines)
        for b in batches:
            found = [scan(x, known) for x in b["_text"].to_pylist()]
            cols = [pa.array([x[f.name] for x in found], f.type) for f in _OUT]
            yield pa.RecordBatch.from_arrays([b["_id"], *cols], names=["doc_id", *_OUT.names])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(scan_batches, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
                                         "base_labels string, labels string, score double, unknown_ids string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: licence scan of the whole documents table."""
    return license_scan(documents(spark, sf_dir))
