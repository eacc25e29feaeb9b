"""MinHash near-duplicates by tensored banding, with every link confirmed on full shingle sets.

Two collections of BANDS short bands of minhashes are drawn for each set. A table of
the search has one band of either collection as its key, so BANDS^2 tables come from
2 BANDS bands, and two sets meet if they agree on some band of both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import id_text, join_groups, small_batches, spool
from asterism.llm.simhash import _forest, components

SHINGLE_WORDS, PERCENT = 3, 85
#: Bands of each collection, and minhashes of a band. At the threshold a pair of sets
#: misses all tables with probability 2 * (1 - 0.85^3)^12 = 2.2e-5; near copies rarer still.
BANDS, ROWS = 12, 3
HASHES = 2 * BANDS * ROWS
#: Sets of one bucket that are compared with each other in one task, and shingles they have together.
BLOCK_SETS, BLOCK_SHINGLES = 256, 1 << 21
#: Pairs that read one copy of a hot set.
PAIRS_A_COPY = 200
#: Ids that a broadcast may hold, 8 bytes each; more are joined by shuffle.
MAX_IDS = 500_000
#: Shingles whose minhashes are found at once.
HASH_BLOCK = 1 << 18

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_random = np.random.default_rng(11)
_PLACES = _random.integers(1 << 62, size=SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = _random.integers(1 << 62, size=SHINGLE_WORDS, dtype=np.uint64)
_FACTORS = _random.integers(1 << 62, size=HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _random.integers(1 << 62, size=HASHES, dtype=np.uint64)


class WordHashes(dict):
    """64-bit hashes of words, kept for words seen before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        return self.setdefault(word, xxhash.xxh64_intdigest(word))


def shingle_set(text: str, seen: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct 3-word shingles, A-Z lower-cased (fewer words: all as one; none: empty)."""
    words = text.encode().translate(_LOWER).split()  # bytes split at space and 9 to 13 only
    w = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
    n = min(len(w), SHINGLE_WORDS)
    if not n:
        return w
    count = len(w) - n + 1
    z = w[:count] * _PLACES[0] + _SHORT[n - 1]
    for k in range(1, n):
        z += w[k:k + count] * _PLACES[k]
    z ^= z >> np.uint64(31)
    z *= np.uint64(0x7FB5D329728EA185)
    z ^= z >> np.uint64(27)
    return np.unique(z)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES 16-bit minhashes (a row a set, none empty): bits of the least value of each random linear function."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint16)
    for k in range(HASHES):
        least = np.minimum.reduceat(flat * _FACTORS[k] + _TERMS[k], starts)
        out[:, k] = (least >> np.uint64(20)) & np.uint64(0xFFFF)
    return out


def _bands(sig: np.ndarray) -> np.ndarray:
    """The 2 BANDS bands of each signature as numbers, those of the first collection before those of the second."""
    parts = sig.reshape(len(sig), 2 * BANDS, ROWS).astype(np.int64)
    return (parts[:, :, 0] << 32) | (parts[:, :, 1] << 16) | parts[:, :, 2]


def _unpack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, digest, sig, keys`` of every row: size and digest of the set, the minhashes, and the first
    collection's bands numbered apart (null for empty sets)."""
    kinds = "doc_id long, n long, digest binary, sig binary, keys array<long>"

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()

        def rows(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
            full = [s for s in sets if len(s)]
            sig = signatures(full) if full else np.empty((0, HASHES), np.uint16)
            keys = (_bands(sig)[:, :BANDS] | (np.arange(BANDS) << 48)).tolist()
            at = iter(range(len(full)))
            place = [next(at) if len(s) else None for s in sets]
            given = lambda values: [None if p is None else values[p] for p in place]
            return pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(given([xxhash.xxh128_digest(s.tobytes()) for s in full]), pa.binary()),
                pa.array(given([row.tobytes() for row in sig]), pa.binary()),
                pa.array(given(keys), pa.list_(pa.int64()))], names=["doc_id", "n", "digest", "sig", "keys"])

        for batch in batches:
            ids, sets, total = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                sets.append(shingle_set(text.as_py(), seen))
                total += len(sets[-1])
                if total >= HASH_BLOCK:
                    yield rows(ids, sets)
                    ids, sets, total = [], [], 0
            yield rows(ids, sets)

    small_batches(docs.sparkSession)
    return id_text(docs, id_col, text_col).mapInArrow(sketched, kinds)


def full_sets(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``cls, hashes``: the whole shingle set of each of ``classes (cls, digest, first)``, from the texts of ``first``.

    The ids are broadcast up to MAX_IDS of them; beyond, the texts meet them by shuffle.
    Ids that repeat or are missing bring other texts along, which the digest tells apart.
    """
    none = F.lit(-(1 << 63))
    ids = spool(classes.select(F.coalesce("first", none).alias("id")).distinct(), "minhash-ids")
    ids = F.broadcast(ids) if ids.count() <= MAX_IDS else ids
    texts = id_text(docs, id_col, text_col).withColumn("id", F.coalesce("doc_id", none)).join(ids, "id", "left_semi")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), seen) for t in batch.column(0)]
            ends = pa.array(np.cumsum([0, *(len(s) for s in sets)]), pa.int32())
            flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(ends, pa.array(flat))], names=["digest", "hashes"])

    found = texts.select("text").mapInArrow(read, "digest binary, hashes array<long>")
    return (found.join(classes.select("digest", "cls"), "digest").groupBy("cls").agg(F.first("hashes").alias("hashes")))


def _meet(pairs: DataFrame) -> DataFrame:
    """``x, y`` of the pairs (with ``sig_x``, ``sig_y``) that share a table: a band of the second collection too."""
    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_bands(_unpack(c))[:, BANDS:] for c in batch.columns[2:])
            hit = pa.array((left == right).any(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(hit) for k in (0, 1)], names=["x", "y"])

    return pairs.select("x", "y", "sig_x", "sig_y").mapInArrow(tested, "x long, y long")


def _similar(common, n_x, n_y):
    return 100 * common >= PERCENT * (n_x + n_y - common)


def star_links(members: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links ``(a, b)`` between each bucket's first set and its other members.

    A set heads as many pairs as its buckets have members, so copies of a hot head's
    hashes are dealt to its pairs, one for PAIRS_A_COPY of them.
    """
    narrow = classes.select("cls", "n", "sig")
    pairs = spool(members.where("cls <> lead").select(F.col("lead").alias("x"), F.col("cls").alias("y")).distinct(),
                  "minhash-stars")
    heads = spool(pairs.groupBy("x").agg(F.count(F.lit(1)).alias("pairs"))
                  .join(narrow.withColumnsRenamed({"cls": "x", "n": "n_x", "sig": "sig_x"}), "x"), "minhash-heads")
    both = join_groups(pairs.join(narrow.withColumnsRenamed({"cls": "y", "n": "n_y", "sig": "sig_y"}), "y"), heads, "x", "pairs")
    fits = 100 * F.least("n_x", "n_y") >= PERCENT * F.greatest("n_x", "n_y")
    small_batches(members.sparkSession, 10_000)
    close = spool(_meet(both.where(fits)), "minhash-candidates")

    counts = spool(close.groupBy("x").agg(F.count(F.lit(1)).alias("pairs")), "minhash-head-counts")
    copies = F.ceil(F.col("pairs") / PAIRS_A_COPY).cast("int")
    dealt = (join_groups(close, counts, "x", "pairs")
             .select("x", "y", F.pmod(F.xxhash64("y"), copies).cast("int").alias("copy")))
    left = (counts.join(sets.withColumnRenamed("cls", "x"), "x")
            .select("x", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"), F.col("hashes").alias("left")))
    matched = (dealt.join(sets.select(F.col("cls").alias("y"), F.col("hashes").alias("right")), "y")
               .join(left, ["x", "copy"]))
    common = F.size(F.array_intersect("left", "right"))
    return spool(matched.where(_similar(common, F.size("left"), F.size("right")))
                 .select(F.col("x").alias("a"), F.col("y").alias("b")), "minhash-links")


def _eligible(table: int, side: np.ndarray, comp: np.ndarray, n: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """Which pairs (u, v) of a block this bucket settles: of two parts that the block pairs, in two components, of
    sizes that can be similar, in this table's band and in none before it, and in some band of the second collection."""
    two = side.any() and not side.all()
    out = (comp[:, None] != comp) & (100 * np.minimum(n[:, None], n) >= PERCENT * np.maximum(n[:, None], n))
    out &= (~side[:, None] & side) if two else np.triu(np.ones((len(n), len(n)), bool), 1)
    earlier = np.zeros_like(out)
    for k in range(table):
        earlier |= bands[:, None, k] == bands[:, k]
    out &= ~earlier
    later = np.zeros_like(out)
    for k in range(BANDS, 2 * BANDS):
        later |= bands[:, None, k] == bands[:, k]
    return out & later


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The runs of equal (key, p, q), the first three columns, of a sorted stream."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        key = np.stack([batch.column(k).to_numpy() for k in range(3)])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        if rest and any(rest[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in range(3)):
            cuts = np.concatenate(([0], cuts))
        last = 0
        for cut in cuts.tolist():
            if cut > last:
                rest.append(batch.slice(last, cut - last))
            yield pa.Table.from_batches(rest)
            rest, last = [], cut
        rest.append(batch.slice(last))
    if rest:
        yield pa.Table.from_batches(rest)


def _block_columns(block: pa.Table) -> tuple[np.ndarray, ...]:
    """Eligible pairs of a block's rows ``key, p, q, side, cls, comp, n, sig``, and their sets' numbers."""
    key = block.column(0)[0].as_py()
    side = np.array(block.column(3).to_pylist(), bool)
    cls, comp, n = (block.column(k).to_numpy() for k in (4, 5, 6))
    bands = _bands(_unpack(block.column(7)))
    return _eligible(key >> 48, side, comp, n, bands), cls


def _linked(block: pa.Table) -> np.ndarray:
    """A spanning forest ``(node, root)`` of the confirmed links in a block with ``hashes`` as its last column."""
    eligible, cls = _block_columns(block)
    hashes = block.column(8).combine_chunks()
    sizes = hashes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    values, at = np.unique(hashes.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
    mark, a, b = np.zeros(len(values), np.int64), [], []
    for u in np.flatnonzero(eligible.any(axis=1)).tolist():
        own = at[starts[u]:starts[u] + sizes[u]]
        mark[own] = 1
        common = np.add.reduceat(mark[at], starts)
        mark[own] = 0
        hit = np.flatnonzero(eligible[u] & _similar(common, sizes[u], sizes))
        a.append(np.full(len(hit), cls[u]))
        b.append(cls[hit])
    none = np.empty(0, np.int64)
    a, b = np.concatenate([none, *a]), np.concatenate([none, *b])
    return _forest(a, b) if len(a) else np.empty((0, 2), np.int64)


def block_links(members: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Confirmed links between the components that still share a bucket; None where no bucket holds two.

    ``labels (node, root)`` are the components so far. Members outside the component of
    the bucket's first set are compared with all its members, block by block, however
    large the bucket; members of one component are not. A pair is settled in the first
    table that holds both. Narrow rows tell which sets a block needs, and only those
    are read; what leaves a task is a forest of links.
    """
    spark = members.sparkSession
    named = (members.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
             .select("key", "cls", "lead", F.coalesce("root", "cls").alias("comp")))
    mixed = spool(named.groupBy("key").agg(F.max(F.when(F.col("cls") == F.col("lead"), F.col("comp"))).alias("main"),
                                           F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("size"))
                  .where("low <> high").select("key", "main", "size"), "minhash-mixed")
    if mixed.isEmpty():
        return None
    within = spool(join_groups(named.select("key", "cls", "comp"), mixed, "key", "size")
                   .join(classes.select("cls", "n", "sig"), "cls"), "minhash-within")
    apart = F.col("comp") != F.col("main")
    blocks = lambda one: F.greatest(F.ceil(F.count_if(one) / BLOCK_SETS),
                                    F.ceil(F.coalesce(F.sum(F.when(one, F.col("n"))), F.lit(0)) / BLOCK_SHINGLES)).cast("long")
    sizes = spool(within.groupBy("key").agg(blocks(apart).alias("n_apart"), blocks(~apart).alias("n_main"),
                                            F.count(F.lit(1)).alias("size")), "minhash-block-counts")
    own = F.when(apart, F.pmod(F.xxhash64("cls"), F.col("n_apart"))).otherwise(
        F.col("n_apart") + F.pmod(F.xxhash64("cls"), F.col("n_main")))
    # members apart from the main component meet all blocks, those of it only blocks of the others
    others = F.when(apart, F.col("n_apart") + F.col("n_main")).otherwise(F.col("n_apart"))
    dealt = (join_groups(within.drop("size"), sizes, "key", "size")
             .select("key", "cls", "comp", "n", "sig", own.alias("own"), F.explode(F.sequence(F.lit(0), others - 1)).alias("other"))
             .select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                     (F.col("own") > F.col("other")).alias("side"), "cls", "comp", "n", "sig"))
    laid = lambda df: df.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "cls")
    kinds = "key long, p long, q long, side boolean, cls long, comp long, n long, sig binary"

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            eligible, _ = _block_columns(block)
            yield from block.filter(pa.array(eligible.any(axis=0) | eligible.any(axis=1))).to_batches()

    small_batches(spark, 10_000)
    wanted = spool(laid(dealt).mapInArrow(needed, kinds), "minhash-blocks")

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            found = _linked(block)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, k].copy(), pa.int64()) for k in (0, 1)], names=["a", "b"])

    small_batches(spark, BLOCK_SETS)
    ready = laid(wanted.join(sets, "cls").select("key", "p", "q", "side", "cls", "comp", "n", "sig", "hashes"))
    return spool(ready.mapInArrow(confirmed, "a long, b long").distinct(), "minhash-block-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Sets are linked where 100 times the shingles they share is at least 85 times those
    they have; ``component_id`` is the smallest doc_id reachable over links, ``kept`` says that
    it is the row's own. Equal sets are one class, however many rows have them. Buckets
    of the first collection's bands with one class are dropped before anything else is
    joined. Each bucket's classes are linked to its first; what remains in two
    components or more is compared in blocks, so no set of pairs grows with the square
    of a group of near copies.

    Defined cases: null and empty texts, and texts of white space, have no shingles and
    are linked with nothing; texts of one or two words are one shingle; rows that repeat
    share a component; null ids never name a component (all its ids null: null) and are
    never kept; rows that share an id are judged by their own texts; an empty table gives
    an empty result; other columns are ignored.
    """
    rows = spool(sketches(docs, id_col, text_col), "minhash-rows")
    # the number is drawn once and stored with the class
    classes = spool(rows.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows"), F.first("n").alias("n"), F.first("sig").alias("sig"),
        F.first("keys").alias("keys")).withColumn("cls", F.monotonically_increasing_id()), "minhash-classes")
    keyed = classes.select("cls", F.explode("keys").alias("key"))
    shared = spool(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("cls").alias("lead"))
                   .where("size > 1"), "minhash-shared")
    members = spool(join_groups(keyed, shared, "key", "size").select("key", "cls", "lead"), "minhash-members")
    near = classes.join(members.select("cls").distinct(), "cls", "left_semi").select("cls", "digest", "first")
    sets = spool(full_sets(docs, near, id_col, text_col), "minhash-sets")

    links = star_links(members, classes, sets)
    labels = spool(components(links), "minhash-labels")
    more = block_links(members, labels, classes, sets)
    if more is not None and not more.isEmpty():
        labels = spool(components(links.unionByName(more)), "minhash-labels")

    least = labels.join(classes.select(F.col("cls").alias("node"), "first"), "node").groupBy("root").agg(F.min("first").alias("least"))
    named = labels.join(least, "root").select(F.col("node").alias("cls"), "least")
    found = spool(classes.join(named, "cls", "left")
                  .select("digest", F.coalesce("least", "first").alias("component_id"), F.col("rows").alias("size")),
                  "minhash-components")
    full = join_groups(rows.where("n > 0").select("doc_id", "n", "digest"), found, "digest", "size").select("doc_id", "n", "component_id")
    empty = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                          F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
