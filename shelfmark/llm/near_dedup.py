"""MinHash near-dedup by a signature-coordinate inverted join, links confirmed on full sets.

A document is the set of its word shingles; documents with one word sequence
form a class and are handled once.

1. Sketch (one pass over the texts): 192 minima per set.  A signature coordinate
   is the hash of 5 of them (48 fixed choices), so that two sets of similarity J
   agree in a coordinate with probability J^5; at J = 0.8 a pair misses all 48
   with probability 1e-6, while unrelated sets hardly ever meet.  64 further
   one-byte minima estimate similarities.
2. Inverted join: classes are posted under (coordinate, value).  Lists that hold
   one class only are dropped by an aggregate; of the others each list is read
   once, in chunks.  Within a list, matches of the byte minima are counted
   against the list's first class (the prefix); classes that match it are skipped
   from then on, only the rest are merged pairwise.  Pairs above the match
   threshold (34 of 64 bytes, six deviations below J = 0.8) stay connected, and a
   list hands on a spanning star per connected part, never its pairs.
3. Connected components of these stars hold every true link.  Each component is
   cut into blocks; units of work build the full sets from the texts and confirm
   links exactly (100 * intersection >= 80 * union).  Pairs that are already
   connected are skipped, so a unit returns a forest of confirmed links.
   Components of confirmed links are the groups.

Nothing is capped: long lists are chunked (their parts' representatives meet
again in a further round); across the blocks of a large component every pair
that is not connected yet is looked at (`_confirmed`).
Class ids and shingles are 64-bit hashes.

Defined results: null and empty texts have the empty set, are linked with
nothing and stay; texts with fewer words than a shingle have one shingle of all
their words; rows that share id and text share one verdict; null ids rank
behind all others, a group of only null ids keeps the one with the smallest
text hash and has a null component id; an empty table gives an empty result.
Only id and text are read, extra columns of any name are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import bounded_batches, documents, drop_folders, materialise, scratch_made, words_of
from shelfmark.llm.graph import components

MINIMA, COORDINATES, WIDTH, BYTES = 192, 48, 5, 64
MATCHES = 34  # of BYTES; J = 0.8 gives 51.2 on average, with a deviation of 3.2
CHUNK = 4096  # classes of one list that are compared at once
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1 << 19
REPRESENTATIVES = 16  # of a block's largest part
CACHE = 100_000
_U = np.uint64


@lru_cache(maxsize=1)
def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Xor and multiplier of each minimum, and the minima of each coordinate."""
    rng = np.random.default_rng(20_24)
    n = MINIMA + BYTES
    xor = rng.integers(0, 1 << 32, n, np.uint32)
    mul = rng.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1)
    chosen = np.stack([rng.choice(MINIMA, WIDTH, replace=False) for _ in range(COORDINATES)])
    return xor, mul, chosen


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(32))


class Shingler:
    """Shingle sets as sorted 64-bit hashes; word hashes are kept in a bounded cache."""

    def __init__(self, size: int) -> None:
        self.size, self.cache = size, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.uint64)
        known = self.cache
        if len(known) > CACHE:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(words))
        n = len(h) - size + 1
        s = np.full(n, size, np.uint64)
        for k in range(size):
            s = _mix(s * _U(0x9E3779B97F4A7C15) + h[k: k + n])
        return np.unique(s)


def signature(shingles: np.ndarray) -> np.ndarray:
    """All minima of a set (coordinates first, then bytes)."""
    xor, mul, _ = _constants()
    h = (shingles >> _U(32)).astype(np.uint32)
    low = np.full(len(xor), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), 512):
        np.minimum(low, ((h[i: i + 512, None] ^ xor) * mul).min(0), out=low)
    return low


def coordinates(signatures: np.ndarray) -> np.ndarray:
    """Coordinate hashes (sets x COORDINATES) of a matrix of signatures."""
    chosen = _constants()[2]
    h = np.broadcast_to(np.arange(COORDINATES, dtype=np.uint64), (len(signatures), COORDINATES))
    for k in range(WIDTH):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + signatures[:, chosen[:, k]])
    return h


def _sketch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Per row: number of shingles, class, coordinates and bytes (these two only once per class and batch)."""
    shingle = Shingler(size)
    for b in batches:
        n, cid, at, sigs, seen = [], [], [], [], set()
        for i, text in enumerate(b["_text"].to_pylist()):
            words = words_of(text)
            s = shingle(words)
            n.append(len(s))
            c = xxhash.xxh64_intdigest(b" ".join(words)) if words else None
            cid.append(c)
            if c is not None and c not in seen:
                seen.add(c)
                at.append(i)
                sigs.append(signature(s))
        m = np.array(sigs, np.uint32).reshape(-1, MINIMA + BYTES)
        first = np.zeros(len(n), bool)
        first[at] = True
        keys = coordinates(m).astype(np.int64).reshape(-1)
        offsets = np.concatenate([[0], np.cumsum(np.where(first, COORDINATES, 0))]).astype(np.int32)
        tails = iter((m[:, MINIMA:] >> np.uint32(24)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([
            b["_id"], b["_tie"], pa.array(n, pa.int64()), pa.array([None if c is None else c - (1 << 64) * (c >> 63) for c in cid], pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys), mask=pa.array(~first)),
            pa.array([next(tails).tobytes() if f else None for f in first], pa.binary())],
            names=["_id", "_tie", "_n", "_cid", "_keys", "_bytes"])


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Positions where any of the columns changes, with 0 and the length."""
    new = reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
    return np.concatenate([[0], np.flatnonzero(new) + 1, [len(columns[0])]])


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Whole groups of rows that are ordered by `names`; several groups per table."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        cut = int(_starts(*[b[c].to_numpy() for c in names])[-2])
        if cut or (held and any(held[-1][c][-1].as_py() != b[c][0].as_py() for c in names)):
            ready = pa.Table.from_batches([*held, b.slice(0, cut)] if cut else held)
            held = [b.slice(cut)]
            yield ready
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One star per connected part of every list chunk: (_key, a = centre, b = member); lonely centres have b = a."""
    for t in _groups(batches, ["_key", "_chunk"]):
        key, chunk, cid = (t[c].to_numpy() for c in ("_key", "_chunk", "_cid"))
        sig = np.frombuffer(b"".join(t["_bytes"].to_pylist()), np.uint8).reshape(-1, BYTES)
        edge = _starts(key, chunk)
        size = np.diff(edge)
        first = np.repeat(edge[:-1], size)
        centre = first.copy()
        near = np.concatenate([(sig[i: i + 8192] == sig[first[i: i + 8192]]).sum(1) >= MATCHES for i in range(0, len(cid), 8192)])
        for g in np.flatnonzero(np.add.reduceat(~near, edge[:-1])):  # lists with classes unlike their first one
            a, b = edge[g], edge[g + 1]
            centre[a:b] = a + _parts(sig[a:b], near[a:b])
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(cid[centre]), pa.array(cid)], names=["_key", "a", "b"])


def _parts(sig: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Connected part of each row (by its first row) under the match threshold; `near`: those that match row 0."""
    label = np.arange(len(sig))
    label[near] = 0  # skipped from here on; only the others are merged with every row
    for i in np.flatnonzero(~near):
        for j in range(0, len(sig), 8192):
            like = np.flatnonzero((sig[j: j + 8192] == sig[i]).sum(1) >= MATCHES) + j
            joined = np.unique(label[like])
            label[np.isin(label, joined)] = joined[0]
    return label


def _confirm(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Units of work: confirmed links (a, b), as few as connect what is connected."""
    shingle = Shingler(size)
    for table in _groups(batches, ["_root", "_unit"]):
        edge = _starts(table["_root"].to_numpy(), table["_unit"].to_numpy())
        for i, j in zip(edge[:-1], edge[1:], strict=True):
            t = table.slice(i, j - i)
            links = _links([shingle(words_of(x)) for x in t["_text"].to_pylist()], *(t[c].to_numpy() for c in ("_cid", "_side", "_label")), percent)
            if links:
                large = pa.array([t["_large"][0].as_py()] * len(links), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64()), large],
                                                 names=["a", "b", "_large"])


def _links(sets: list[np.ndarray], cid: np.ndarray, side: np.ndarray, known: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Confirmed links between classes, as few as connect what `known` (a label per class) does not connect yet.

    With two sides only pairs across them are looked at, and the new links are
    returned; with one side a star per connected part (member, its first class).
    """
    once = np.unique(cid, return_index=True)[1]  # a class may come from several rows
    sets, cid, side = [sets[i] for i in once], cid[once], side[once]
    n = len(sets)
    count = np.array([len(s) for s in sets], np.int64)
    across = side.min() != side.max()
    sig = np.stack([signature(s)[MINIMA:] >> np.uint32(24) for s in sets]).astype(np.uint8)
    words, local = np.unique(np.concatenate(sets), return_inverse=True)
    offsets = np.concatenate([[0], np.cumsum(count)])
    mask = np.zeros(len(words), bool)
    label, found = np.unique(known[once], return_inverse=True)[1], []
    for i in range(n - 1):
        rest = np.arange(i + 1, n)
        ok = (label[rest] != label[i]) & (100 * np.minimum(count[rest], count[i]) >= percent * np.maximum(count[rest], count[i]))
        if across:
            ok &= side[rest] != side[i]
        rest = rest[ok]
        if not len(rest):
            continue
        like = (sig[rest] == sig[i]).sum(1)
        rest = rest[like >= MATCHES]
        rest = rest[np.argsort(-like[like >= MATCHES], kind="stable")]
        mask[local[offsets[i]: offsets[i + 1]]] = True
        step = 8
        while len(rest):
            some, rest = rest[:step], rest[step:]
            both = np.array([int(mask[local[offsets[j]: offsets[j + 1]]].sum()) for j in some])
            for j in some[100 * both >= percent * (count[some] + count[i] - both)]:
                if label[j] != label[i]:
                    found.append((int(cid[i]), int(cid[j])))
                    label[label == label[j]] = label[i]
            rest = rest[label[rest] != label[i]]  # what is connected by now is skipped
            step = 64
        mask[local[offsets[i]: offsets[i + 1]]] = False
    if across:
        return found
    first, part = np.unique(label, return_index=True, return_inverse=True)[1:]
    centre = cid[first[part]]
    return [(int(a), int(b)) for a, b in zip(cid, centre, strict=True) if a != b]


def _candidate_links(sketches: DataFrame) -> DataFrame:
    """Stars (a, b) over lists of two classes or more, above the match threshold."""
    posted = sketches.filter("_keys is not null").select("_cid", F.explode("_keys").alias("_key"))
    lists = (posted.groupBy("_key").agg(F.min("_cid").alias("lo"), F.max("_cid").alias("hi"), F.count(F.lit(1)).alias("n"))
             .filter("lo < hi").select("_key", F.ceil(F.col("n") / CHUNK).cast("int").alias("_chunks")))
    members = posted.join(lists, "_key")
    sig = sketches.filter("_bytes is not null").groupBy("_cid").agg(F.first("_bytes").alias("_bytes"))
    found, left = [], materialise(members, "lists")
    while True:
        # The hash of list and class deals a long list out to chunks, differently in every round.
        dealt = (left.distinct().withColumn("_chunk", F.pmod(F.xxhash64("_cid", "_key", F.lit(len(found))), F.col("_chunks")).cast("int"))
                 .join(sig, "_cid"))
        n = left.sparkSession.conf.get("spark.sql.shuffle.partitions")
        stars = materialise(dealt.repartition(int(n), "_key", "_chunk").sortWithinPartitions("_key", "_chunk", F.xxhash64("_cid", "_key"))
                            .select("_key", "_chunk", "_cid", "_bytes").mapInArrow(_stars, "_key long, a long, b long"), "stars")
        found.append(stars.filter("a <> b").select("a", "b").distinct())
        long = left.filter("_chunks > 1").select("_key", "_chunks").distinct()
        if long.isEmpty():
            break
        # Centres of the chunks of a long list meet again, in fewer chunks.
        centres = stars.select("_key", F.col("a").alias("_cid")).distinct().join(long.select("_key"), "_key")
        counts = centres.groupBy("_key").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("_now"))
        fewer = centres.join(counts, "_key").join(long, "_key").withColumn("_chunks", F.least("_now", F.col("_chunks") - 1)).select("_cid", "_key", "_chunks")
        left = materialise(fewer, "lists")
    return reduce(DataFrame.unionByName, found)


def _rank(c: str) -> Column:
    return F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_tie").alias("tie")).alias(c)


def _units(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Confirmed links of units of work: rows (_cid _root _unit _side _label _n _large), the texts joined by class."""
    load = members.agg(F.count(F.lit(1)).alias("rows"), F.sum("_n").alias("shingles")).first()
    tasks = max(1, -(-load["rows"] // BLOCK_ROWS), -(-(load["shingles"] or 0) // BLOCK_SHINGLES))
    dealt = members.drop("_n").join(texts, "_cid").withColumn("_to", F.pmod(F.xxhash64("_root", "_unit"), F.lit(tasks)).cast("int"))
    ordered = (dealt.repartitionById(tasks, "_to").sortWithinPartitions("_root", "_unit")
               .select("_cid", "_root", "_unit", "_side", "_label", "_large", "_text"))
    return materialise(ordered.mapInArrow(lambda x: _confirm(x, size, percent), "a long, b long, _large boolean"), "links")


def _confirmed(texts: DataFrame, sketches: DataFrame, roots: DataFrame, size: int, percent: int) -> DataFrame | None:
    """(node, root) of the groups of confirmed links within the candidate components; None where there are no candidates.

    A component of several blocks is worked off block by block first.  The
    largest part of each block is then tied to the next block's by a few
    representatives, so that normally one main part spans all blocks.  What is
    not in the main part (the others) is compared with every block; two members
    of the main part never need to be.  A component of n classes with m others
    so costs n rows for every BLOCK_ROWS others, not n rows for every block.
    """
    # One row per class: the smallest row of the class provides the text.
    reps = (sketches.filter("_cid is not null").groupBy("_cid").agg(F.min(_rank("r")).alias("r"), F.max("_n").alias("_n"))
            .join(roots.select(F.col("node").alias("_cid"), F.col("root").alias("_root")), "_cid"))
    total = reps.groupBy("_root").agg(F.count(F.lit(1)).alias("rows"), F.sum("_n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    placed = materialise(reps.join(total.select("_root", blocks.alias("_blocks")), "_root")
                         .withColumn("_block", F.pmod(F.xxhash64("_cid"), F.col("_blocks")).cast("int")), "members")
    if placed.isEmpty():
        return None
    member = placed.select(F.col("r.id").alias("_mid"), F.col("r.tie").alias("_mtie"), "_cid")
    # The corpus is dealt out by key once, at every size: it is large against any table of candidates.
    found = texts.join(member.hint("merge"), (F.col("_tie") == F.col("_mtie")) & F.col("_id").eqNullSafe(F.col("_mid")))
    kept = materialise(found.groupBy("_cid").agg(F.first("_text").alias("_text")), "texts", "snappy")
    own = placed.select("_cid", "_root", F.col("_block").cast("long").alias("_unit"), F.lit(0).alias("_side"), F.col("_cid").alias("_label"), "_n",
                        (F.col("_blocks") > 1).alias("_large"))
    links = _units(own, kept, size, percent)
    # A component of one block is finished: its stars are its groups.
    done = links.filter("not _large").select(F.col("a").alias("node"), F.col("b").alias("root"))
    done = done.unionByName(done.select(F.col("root").alias("node"), "root").distinct())
    large = placed.filter("_blocks > 1").drop("r").withColumn("_large", F.lit(True))
    if large.isEmpty():
        return done
    links = links.filter("_large")

    def labelled(parts: DataFrame) -> DataFrame:
        named = parts.select(F.col("node").alias("_cid"), F.col("root").alias("_part"))
        return materialise(large.join(named, "_cid", "left").withColumn("_label", F.coalesce("_part", "_cid")).drop("_part"), "parts")

    def largest(rows: DataFrame, *keys: str) -> DataFrame:
        sizes = rows.groupBy(*keys, "_label").agg(F.count(F.lit(1)).alias("n"))
        return sizes.groupBy(*keys).agg(F.max(F.struct("n", "_label")).alias("m")).select(*keys, F.col("m._label").alias("_label"))

    rows = labelled(links.select(F.col("a").alias("node"), F.col("b").alias("root")))
    few = (rows.join(largest(rows, "_root", "_block"), ["_root", "_block", "_label"])
           .groupBy("_root", "_block", "_label", F.pmod(F.xxhash64("_cid", "_root"), F.lit(REPRESENTATIVES)).alias("k"))
           .agg(F.min(F.struct("_cid", "_n")).alias("m")).select("_root", "_block", "_label", "m._cid", "m._n"))
    # Unit i ties block i to block i + 1.
    tied = few.select("_cid", "_root", F.explode(F.array(F.struct(F.col("_block").alias("u"), F.lit(0).alias("s")), F.struct(
        (F.col("_block") - 1).alias("u"), F.lit(1).alias("s")))).alias("e"), "_label", "_n").filter("e.u >= 0")
    tied = tied.select("_cid", "_root", F.col("e.u").cast("long").alias("_unit"), F.col("e.s").alias("_side"), "_label", "_n", F.lit(True).alias("_large"))
    links = links.unionByName(_units(tied, kept, size, percent))
    parts = components(links, "parts")
    rows = labelled(parts)
    main = largest(rows, "_root").withColumnRenamed("_label", "_main")
    marked = materialise(rows.join(main, "_root"), "marked")
    other = marked.filter("_label <> _main")
    chunks = other.groupBy("_root").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum("_n") / BLOCK_SHINGLES)).cast("int").alias("_chunks"))
    if chunks.isEmpty():
        return done.unionByName(parts)
    sized = marked.join(chunks, "_root")
    unit = lambda block, chunk: (block.cast("long") * F.col("_chunks") + chunk).alias("_unit")
    held = sized.select("_cid", "_root", "_block", "_chunks", "_label", "_n", "_large", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("c")).select(
        "_cid", "_root", unit(F.col("_block"), F.col("c")), F.lit(0).alias("_side"), "_label", "_n", "_large")
    moved = sized.filter("_label <> _main").withColumn("b", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).filter("b <> _block").select(
        "_cid", "_root", unit(F.col("b"), F.pmod(F.xxhash64("_cid", "_root"), F.col("_chunks"))), F.lit(1).alias("_side"), "_label", "_n", "_large")
    # A unit without others has nothing to compare.
    active = moved.select("_root", "_unit").distinct()
    more = _units(held.join(active, ["_root", "_unit"], "left_semi").unionByName(moved), kept, size, percent)
    return done.unionByName(components(links.unionByName(more), "roots"))


def _best_of_classes(texts: DataFrame, sketches: DataFrame, size: int, percent: int) -> DataFrame:
    """(_cid, _best): per class the smallest row of its group."""
    stars = materialise(_candidate_links(sketches), "candidates")
    roots = components(stars, "candidate-roots")
    linked = _confirmed(texts, sketches, roots, size, percent)
    classes = sketches.filter("_cid is not null").groupBy("_cid").agg(F.min(_rank("r")).alias("r"))
    if linked is None:
        return classes.select("_cid", F.col("r").alias("_best"))
    grouped = materialise(linked.select(F.col("node").alias("_cid"), "root").join(classes, "_cid"), "groups")
    best = materialise(grouped.groupBy("root").agg(F.min("r").alias("_best")), "best")
    moved = grouped.join(best, "root").select("_cid", "_best")
    return classes.join(moved, "_cid", "left").select("_cid", F.coalesce("_best", "r").alias("_best"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2, percent: int = 80) -> DataFrame:
    """Groups of near-duplicates: `_id _tie _n _best` per row; `_best` is the smallest row (null rank, id, text hash) of its group."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_tie"), F.col(text_col).alias("_text"))
    kind = texts.schema["_id"].dataType.simpleString()
    sketches = materialise(texts.mapInArrow(lambda x: _sketch(x, size), f"_id {kind}, _tie long, _n long, _cid long, _keys array<long>, _bytes binary"), "sketches")
    with scratch_made() as used:
        best = _best_of_classes(texts, sketches, size, percent)
    # Written, so that the join is between two dealt-out tables and a class with many copies can be split.
    classes = materialise(best, "classes")
    drop_folders(spark, used)
    rows = sketches.select("_id", "_tie", "_n", "_cid")
    worded = rows.filter("_cid is not null").join(classes, "_cid").select("_id", "_tie", "_n", "_best")
    return worded.unionByName(rows.filter("_cid is null").select("_id", "_tie", "_n", _rank("_best")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of which one per group stays, with all their columns."""
    gone = (near_dedup(docs, id_col, text_col, size, percent).filter(~_rank("r").eqNullSafe(F.col("_best")))
            .select(F.col("_id").alias("_gone_id"), F.col("_tie").alias("_gone_tie")))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_tie"))
    gone = materialise(gone, "gone")
    on = (row["_tie"] == gone["_gone_tie"]) & row["_id"].eqNullSafe(gone["_gone_id"])
    return row.join(gone.hint("merge"), on, "left_anti").select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: near-duplicate groups of the whole documents table on two-word shingles."""
    out = near_dedup(documents(spark, sf_dir), size=2, percent=80)
    return out.select(F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), F.col("_best.id").alias("component_id"),
                      F.col("_id").eqNullSafe(F.col("_best.id")).alias("kept"))
