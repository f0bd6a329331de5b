import hashlib
import random
import struct

import pytest
import sentencepiece
from corpus_fixtures import SCHEMA, rows_of
from pyspark.sql import functions as F

from shelfmark.llm import pieces, token_counts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def counter():
    with open(token_counts.RANKS, "rb") as f:
        return token_counts.Counter(f.read())


def full(text, counter):
    return len(counter.encoding.encode_ordinary(text or ""))


def test_edits_equal_full_recount(counter):
    """Random edits of awkward texts: tree, sums and pieces equal those of a new count."""
    rng = random.Random(1)
    parts = ["a", "'", "l", " ", "  ", "\n", "1", "!", "'ll", "é", " b", "s", "\t ", "日", " ", "\r\n"]
    for k in range(1_500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30 if k % 2 else 900)))
        tree = token_counts.count(text, counter)
        for _ in range(4):
            ins = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 6, 700 if k % 50 == 0 else 3])))
            text, _ = token_counts.edit(tree, text, rng.randint(0, len(text) + 2), rng.choice([0, 0, 1, 2, 5, 400]), ins, counter)
            found = token_counts._CUT.findall(text)
            assert tree.flat() == (list(map(len, found)), counter(found))
            assert tree.n_chars == len(text) and tree.n_tokens == full(text, counter)


def test_only_the_touched_region_is_encoded(counter):
    text = " ".join(f"word{i}" for i in range(20_000))
    tree = token_counts.count(text, counter)
    new, again = token_counts.edit(tree, text, len(text) // 2, 3, "XYZ", counter)
    assert again < 12 and tree.n_tokens == full(new, counter)


def edited(text, edits):
    text = text or ""
    for e in edits or ():
        if e is not None:
            at, gone = min(max(e[0] or 0, 0), len(text)), max(e[1] or 0, 0)
            text = text[:at] + (e[2] or "") + text[at + gone:]
    return text


def test_edited_counts_table(spark, counter, edge_rows, empty_docs):
    rng = random.Random(2)
    edits = [rng.choice([None, [], [None], [(0, 0, "x ")], [(None, None, None)], [(5, 3, "ab"), (2, 99, ""), (10 ** 6, 1, " end")]]) for _ in edge_rows]
    docs = spark.createDataFrame([(*r, e, 1, "x") for r, e in zip(edge_rows, edits, strict=True)],
                                 SCHEMA + ", e array<struct<at:int,del:int,ins:string>>, n_pieces long, _text string")
    got = token_counts.edited_counts(docs, F.col("e")).select("doc_id", "tokens_before", "tokens_after", "text_after")
    expected = [(r[0], full(r[1], counter), full(edited(r[1], e), counter), edited(r[1], e)) for r, e in zip(edge_rows, edits, strict=True)]
    assert rows_of(got) == sorted(expected, key=repr)
    assert token_counts.edited_counts(empty_docs, F.array()).count() == 0 and token_counts.token_trees(empty_docs).count() == 0


def test_kept_state_gives_the_same_counts(spark, counter):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    trees = token_counts.token_trees(docs).withColumnRenamed("doc_id", "i")
    both = docs.join(trees, F.expr("doc_id = i"))
    edits = token_counts.sample_edits(F.col("text"), F.col("source"), F.col("lang"))
    kept = token_counts.edited_counts(both, edits, state=(F.col("piece_chars"), F.col("piece_tokens")))
    assert rows_of(kept) == rows_of(token_counts.edited_counts(docs, edits))


def test_token_query_whole_table(spark, counter):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = token_counts.query(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        d = docs[r.doc_id]
        n = len(d.text)
        text = edited(d.text, [(0, 0, d.lang + ": "), (int(n / 2), 7, d.source), (int(2 * n / 3), 40, "")])
        assert (r.tokens_before, r.tokens_after, r.text_sha256) == (full(d.text, counter), full(text, counter), hashlib.sha256(text.encode()).hexdigest())
        assert r.n_pieces == len(token_counts._CUT.findall(text))


HARD = ["", "  a  b ", "<s> </s> <unk> <0x0A>", "\n\n\t x", "日本語テキスト 🤖👍🏽 ﬁ ½", "▁▁ a▁b", "a" * 300, "   " * 50, "x" * 5000, "\x00\x01é", "-" * 77, "enenenene ananana",
        "=" * 33 + " " + "=" * 16, "…", "word " * 4000]


@pytest.fixture(scope="module")
def both():
    return pieces.load(pieces.MODEL), sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_parity_on_hard_texts(both):
    ours, theirs = both
    ids = [x.tolist() for x in ours.encode(HARD)]
    assert ids == theirs.encode(HARD)
    assert [ours.decode(x) for x in ids] == theirs.decode(ids)


def test_parity_on_random_texts(both):
    ours, theirs = both
    rng = random.Random(3)
    texts = []
    for k in range(3_000):
        alphabet = rng.choice(["ab", " -=", "en a", "▁ x", "éñ日🤖 e", "0 1f.", "abcdefghijklmnopqrstuvwxyz '"])
        texts.append("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60 if k % 10 else 600))))
    got = [x.tolist() for x in ours.encode(texts)]
    assert got == theirs.encode(texts)
    assert [x.tolist() for x in ours.encode(texts)] == got  # now from the cache


def test_cache_generations(both, monkeypatch):
    ours, theirs = pieces.load(pieces.MODEL), both[1]
    monkeypatch.setattr(pieces, "CACHE_SEGMENTS", 50)
    rng = random.Random(9)
    for _ in range(30):
        texts = [" ".join(str(rng.randint(0, 300)) for _ in range(40)) for _ in range(5)] + ["y" * 100]
        assert [x.tolist() for x in ours.encode(texts)] == theirs.encode(texts)


def test_piece_table(spark, edge_docs, clash_docs, empty_docs, edge_rows, both):
    expected = sorted(((r[0], len(x), x, True, True) for r, x in zip(edge_rows, both[1].encode([r[1] or "" for r in edge_rows]), strict=True)), key=repr)
    for docs in (edge_docs, clash_docs):
        assert rows_of(pieces.piece_ids(docs, parity=True)) == expected
    assert pieces.piece_ids(empty_docs).count() == 0
    marked = spark.createDataFrame([(1, "a▁b", None, None, None)], SCHEMA)
    assert pieces.piece_ids(marked).first().round_trip is False


def test_piece_query_whole_table(spark, both):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = pieces.query(spark, SF).collect()
    assert len(got) == len(docs) and all(r.parity and r.round_trip and r.n_tokens == len(r.ids) for r in got)
    assert all(both[1].decode(r.ids) == docs[r.doc_id] for r in got)


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def message(*fields):
    """Protobuf bytes of (number, value): bytes, float or int."""
    out = b""
    for k, v in fields:
        if isinstance(v, bytes):
            out += varint(k << 3 | 2) + varint(len(v)) + v
        elif isinstance(v, float):
            out += varint(k << 3 | 5) + struct.pack("<f", v)
        else:
            out += varint(k << 3) + varint(v)
    return out


def unigram_model(squeeze):
    """A small hand-written unigram model with byte fallback."""
    listed = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", -20.0, 6) for i in range(256)]
    listed += [(p, s, 1) for p, s in [("▁", -3.0), ("a", -2.0), ("b", -2.1), ("c", -4.0), ("▁a", -2.5), ("ab", -2.6), ("bc", -5.0), ("abc", -6.5), ("▁ab", -3.1), ("aa", -3.9), ("▁b", -3.2)]]
    body = [(1, message((1, p.encode()), (2, float(s)), (3, k))) for p, s, k in listed]
    trainer = message((3, 1), (35, 1), (40, 0), (41, 1), (42, 2))
    return message(*body, (2, trainer), (3, message((1, b"identity"), (3, 1), (4, squeeze), (5, 1))))


@pytest.mark.parametrize("squeeze", [0, 1])
def test_unigram_model_parity(squeeze):
    data = unigram_model(squeeze)
    ours, theirs = pieces.Backend(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc abé") for _ in range(rng.randint(0, 20))) for _ in range(400)]
    got = [x.tolist() for x in ours.encode(texts)]
    wrong = [(t, a, b) for t, a, b in zip(texts, got, theirs.encode(texts), strict=True) if a != b]
    assert not wrong, wrong[:3]
