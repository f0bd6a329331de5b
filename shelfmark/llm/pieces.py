"""SentencePiece models on the tokenizers library: encode, decode, parity with the original.

The model file is parsed from its protobuf wire format.  From it are rebuilt:
the normaliser (compiled character map, extra white space, dummy prefix,
metaspace marker), the model (unigram scores, or merges ranked by piece score),
and byte fallback.  Words repeat, so a batch is cut at the metaspace marker
where no piece crosses it, its distinct segments are encoded in one
multithreaded call, and a bounded cache of segments is kept between batches.

Defined results: null and empty texts have no ids and decode to ''; very long
texts and segments are encoded whole (long segments are not cached); repeated
rows are encoded like any other; an empty table gives an empty result.  A text
with the marker character itself decodes to a space there (`round_trip` false).
Only id and text are read.  The model is one file of bounded size (it is read
once on the driver and broadcast).
"""

from __future__ import annotations

import heapq
import os
import re
import struct
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from shelfmark.llm.common import bounded_batches, documents

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THREADS = 2
MARK = "▁"
CACHE_SEGMENTS = 100_000  # twice as many at most
CACHE_CHARS = 64
# Fixed values of the model file's format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protobuf message; 32- and 64-bit values as raw bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind in (1, 2, 5):
            n = varint() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, data[at: at + n]
            at += n
        else:
            raise ValueError(f"wire type {kind} in the model file")


class Proto:
    """What encoding needs of a model file."""

    def __init__(self, data: bytes) -> None:
        self.pieces: list[tuple[str, float, int]] = []
        trainer, rules = {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = {1: b"", 2: struct.pack("<f", 0.0), 3: NORMAL} | dict(_fields(value))
                self.pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
            elif field == 2:
                trainer |= dict(_fields(value))
            elif field == 3:
                rules |= dict(_fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.suffix_space = bool(trainer.get(24, 0))
        self.charsmap = rules.get(2, b"")
        self.dummy_prefix = bool(rules.get(3, 1))
        self.squeeze = bool(rules.get(4, 1))
        self.escape = bool(rules.get(5, 1))
        self.unk = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        if self.kind not in (UNIGRAM, BPE) or self.suffix_space or not self.escape:
            raise ValueError("only unigram and merge models with the metaspace marker in front of words are supported")


def _ragged(rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows joined, and start and length of each in items of `width` bytes."""
    length = np.fromiter(map(len, rows), np.int64, len(rows)) // width
    return np.frombuffer(b"".join(rows), np.uint8), np.cumsum(length) - length, length


def _gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pieces flat[start: start + length] one after the other."""
    before = np.cumsum(length) - length
    return flat[np.repeat(start - before, length) + np.arange(int(length.sum()))]


class Backend:
    """Encoder and decoder of one model."""

    def __init__(self, data: bytes) -> None:
        p = self.proto = Proto(data)
        steps = []
        if p.charsmap:
            steps.append(normalizers.Precompiled(p.charsmap))
        if p.squeeze:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
        self.plain = not steps  # then normalising is the marker alone
        if p.dummy_prefix:
            steps.append(normalizers.Prepend(MARK))
        steps.append(normalizers.Replace(" ", MARK))
        self.normalizer = normalizers.Sequence(steps)
        ids = {piece: i for i, (piece, _, _) in enumerate(p.pieces)}
        if p.kind == UNIGRAM:
            model = models.Unigram([(piece, score) for piece, score, _ in p.pieces], unk_id=p.unk, byte_fallback=p.byte_fallback)
        else:
            model = models.BPE(ids, self._merges(), unk_token=p.pieces[p.unk][0], fuse_unk=True, byte_fallback=p.byte_fallback)
        self.core = Tokenizer(model)
        self.core.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        self.core.encode_special_tokens = True
        # Where no piece has the marker behind another character, nothing joins over such a place.
        crossed = any(MARK in piece.lstrip(MARK) for piece, _, kind in p.pieces if kind in (NORMAL, USER_DEFINED))
        self.cut = None if crossed else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.ids = ids
        # A second front on the same model cuts at every marker.
        self.joint = Tokenizer(model) if self.cut else None
        if self.joint is not None:
            self.joint.pre_tokenizer = pre_tokenizers.Split(MARK, "merged_with_next")
            self.joint.encode_special_tokens = True
        self.starts = np.array([piece[:1] == MARK for piece, _, _ in p.pieces])
        self.tied = self._ties() if p.kind == BPE else None
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.raw = [self._bytes(*x) for x in p.pieces]
        self.raw_flat, self.raw_start, self.raw_length = _ragged(self.raw, 1)

    def _merges(self) -> list[tuple[str, str]]:
        """All splits of a piece into two pieces, by falling score of the piece."""
        whole = {piece: score for piece, score, kind in self.proto.pieces if kind in (NORMAL, USER_DEFINED)}
        order = {piece: i for i, (piece, _, _) in enumerate(self.proto.pieces)}
        found = [(-score, order[piece[:k]], order[piece[k:]], piece[:k], piece[k:])
                 for piece, score in whole.items() for k in range(1, len(piece)) if piece[:k] in whole and piece[k:] in whole]
        return [x[3:] for x in sorted(found)]

    def _ties(self) -> ahocorasick.Automaton | None:
        """Strings in which two places of one piece overlap that can be put together in several ways.

        Only there can merges of equal score compete; the original takes the
        leftmost, ranked merges the split that ranks first.
        """
        whole = {piece for piece, _, kind in self.proto.pieces if kind in (NORMAL, USER_DEFINED)}
        found = ahocorasick.Automaton()
        for x in whole:
            if sum(x[:k] in whole and x[k:] in whole for k in range(1, len(x))) > 1:
                for k in range(1, len(x)):
                    if x.startswith(x[-k:]):
                        found.add_word(x + x[k:], True)
        if not len(found):
            return None
        found.make_automaton()
        return found

    def _leftmost(self, s: str) -> list[int]:
        """Merges of one segment by score, ties from the left."""
        pieces, ids = self.proto.pieces, self.ids
        part, after, before = list(s), [*range(1, len(s)), -1], [*range(-1, len(s) - 1)]
        heap: list[tuple] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and (n := ids.get(part[i] + part[j])) is not None and pieces[n][2] in (NORMAL, USER_DEFINED):
                heapq.heappush(heap, (-pieces[n][1], i, part[i], part[j]))

        for i in range(len(s)):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j < 0 or part[j] != b:
                continue
            part[i], part[j], after[i] = a + b, "", after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        out: list[int] = []
        for x in filter(None, part):
            if x in ids and pieces[ids[x]][2] in (NORMAL, USER_DEFINED):
                out.append(ids[x])
            elif self.proto.byte_fallback:
                out += [ids[f"<0x{c:02X}>"] for c in x.encode()]
            elif not out or out[-1] != self.proto.unk:
                out.append(self.proto.unk)
        return out

    @staticmethod
    def _bytes(piece: str, _: float, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(MARK, " ").encode()

    def normalise(self, text: str) -> str:
        if not text or not self.plain:
            return self.normalizer.normalize_str(text)
        return (MARK if self.proto.dummy_prefix else "") + text.replace(" ", MARK)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = self.cut.findall if self.cut else lambda s: [s] if s else []
        segments = [cut(self.normalise(x)) for x in texts]
        distinct = list(set().union(*segments))
        look = dict(zip(distinct, self._look_up(distinct), strict=True)).__getitem__
        return [np.frombuffer(b"".join(map(look, s)), np.int32) for s in segments]

    def _encode_new(self, segments: list[str]) -> list[bytes]:
        """Ids of distinct segments, packed.  Where each starts with its only marker, many go into one string."""
        if self.joint is None or any(s[:1] != MARK or s[1:2] == MARK for s in segments):
            plain = [i for i, s in enumerate(segments) if self.joint is not None and s[:1] == MARK and s[1:2] != MARK]
            odd = sorted(set(range(len(segments))).difference(plain))
            out = [b""] * len(segments)
            for i, e in zip(odd, self.core.encode_batch_fast([segments[i] for i in odd], add_special_tokens=False), strict=True):
                out[i] = array("i", e.ids).tobytes()
            for i, x in zip(plain, self._encode_new([segments[i] for i in plain]) if plain else (), strict=True):
                out[i] = x
            return out
        step, out = 500, []
        parts = [segments[i: i + step] for i in range(0, len(segments), step)]
        for part, e in zip(parts, self.joint.encode_batch_fast(["".join(x) for x in parts], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.int32)
            cuts = np.flatnonzero(self.starts[ids])  # a segment's first piece is its only one with the marker
            if len(cuts) != len(part):
                out += [array("i", x.ids).tobytes() for x in self.core.encode_batch_fast(part, add_special_tokens=False)]
                continue
            raw, at = ids.tobytes(), [*(4 * cuts).tolist(), 4 * len(ids)]
            out += [raw[a:b] for a, b in pairwise(at)]
        return out

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column in one row, and where each text's begin (and the end).

        Texts whose words are parted by single spaces are cut and made distinct
        by Arrow; only distinct words are looked at one by one.  Others (runs of
        spaces, spaces at an end, the marker itself) take `encode`.
        """
        if not (self.cut and self.plain and self.proto.dummy_prefix):
            odd = np.ones(len(texts), bool)
        else:
            odd = pc.match_substring_regex(texts, f"^$|^ | $|  |{MARK}").to_numpy(zero_copy_only=False)
        slow = np.flatnonzero(odd)
        apart = dict(zip(slow.tolist(), self.encode(texts.take(pa.array(slow)).to_pylist()) if len(slow) else (), strict=True))
        words = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        coded = words.flatten().dictionary_encode()
        distinct, at = [MARK + w for w in coded.dictionary.to_pylist()], coded.indices.to_numpy()
        packed = self._look_up(distinct)
        flat, start, length = _ragged(packed, 4)
        ids = _gather(flat.view(np.int32), start[at], length[at])
        ends = np.concatenate([[0], np.cumsum(length[at])])[words.offsets.to_numpy() - words.offsets[0].as_py()]
        if not len(slow):
            return ids, ends
        sizes, quick = np.zeros(len(texts), np.int64), iter(np.split(ids, ends[1:-1]) if len(ends) > 1 else ())
        parts = [apart[i] if odd[i] else next(quick) for i in range(len(texts))]
        sizes[:] = [len(x) for x in parts]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])

    def _look_up(self, segments: list[str]) -> list[bytes]:
        """Packed ids of distinct segments, from the cache where it has them."""
        if len(self.cache) > CACHE_SEGMENTS:  # frequent segments come back from the older half
            self.cache, self.older = {}, self.cache
        known, older = self.cache, self.older
        found = [known.get(s) for s in segments]
        missing = [i for i, x in enumerate(found) if x is None]
        new = []
        for i in missing:
            x = older.get(segments[i])
            if x is None:
                new.append(i)
            else:
                found[i] = known[segments[i]] = x
        for k in range(0, len(new), 5_000):
            at = new[k: k + 5_000]
            some = [segments[i] for i in at]
            packed = self._encode_new(some)
            for j in self._tied(some):
                packed[j] = array("i", self._leftmost(some[j])).tobytes()
            for i, s, x in zip(at, some, packed, strict=True):
                found[i] = x
                if len(s) <= CACHE_CHARS:
                    known[s] = x
        return found

    def decode_column(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts in one row and where each text's begin (with the dummy prefix's space)."""
        length = self.raw_length[ids]
        return _gather(self.raw_flat, self.raw_start[ids], length), np.concatenate([[0], np.cumsum(length)])[ends]

    def _tied(self, segments: list[str]) -> set[int]:
        """Which segments have competing merges."""
        if self.tied is None:
            return set()
        ends = list(accumulate(len(s) + 1 for s in segments))
        return {bisect_right(ends, at) for at, _ in self.tied.iter("\0".join(segments))}

    def decode(self, ids) -> str:
        """Text of ids; invalid byte sequences become U+FFFD."""
        out = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return out[1:] if self.proto.dummy_prefix and out[:1] == " " else out


@lru_cache(maxsize=2)
def _backend(data: bytes) -> Backend:
    return Backend(data)


@lru_cache(maxsize=2)
def _original(data: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


def load(path: str) -> Backend:
    """Backend of a model file."""
    with open(path, "rb") as f:
        return Backend(f.read())


def piece_ids(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text", parity: bool = False,
              threads: int = THREADS, keep: bool = True) -> DataFrame:
    """With `keep` Python workers hold the model and the known segments between tasks; without, until the task's end.

    One row per document: doc_id, n_tokens, ids, round_trip (decoded equals the text), and on request parity (same ids as the original library)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(model, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    out = T.StructType([T.StructField("doc_id", rows.schema["_id"].dataType), T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType()),
                        *([T.StructField("parity", T.BooleanType())] if parity else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))  # before the library's pool starts
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        backend = _backend(shared.value) if keep else Backend(shared.value)
        for b in batches:
            for part in _by_chars(b):
                ids, ends = backend.encode_column(part["_text"])
                raw, cuts = backend.decode_column(ids, ends)
                texts = part["_text"].to_pylist()
                prefix = b" " if backend.proto.dummy_prefix else b""
                same = [raw[a:b].tobytes() == (prefix + t.encode() if t else b"") for (a, b), t in zip(pairwise(cuts), texts, strict=True)]
                cols = [part["_id"], pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)), pa.array(same, pa.bool_())]
                if parity:
                    theirs = _original(shared.value).encode(texts, num_threads=1)
                    cols.append(pa.array([ids[a:b].tolist() == x for (a, b), x in zip(pairwise(ends), theirs, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(cols, names=out.names)

    return rows.mapInArrow(run, out)


def _by_chars(b: pa.RecordBatch, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about `limit` bytes of text (a longer text alone), so that lists of ids stay small."""
    sizes = b["_text"].nbytes
    step = max(1, b.num_rows * limit // max(sizes, 1))
    for i in range(0, b.num_rows, step):
        yield b.slice(i, step)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: ids of the whole documents table, each checked against the original library and decoded."""
    return piece_ids(documents(spark, sf_dir), parity=True)
