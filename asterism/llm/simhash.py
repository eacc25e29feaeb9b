"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from asterism.llm.common import drop_documents, fresh, id_text, join_groups, small_batches, spool

SHINGLE_WORDS, SEED, RADIUS, BITS = 4, 42, 4, 64
#: Fingerprints of a bucket that are compared with each other; larger buckets go by midpoints.
MAX_BUCKET = 512
#: Shingles hashed before their bits are summed, so that a long text needs bounded memory.
BLOCK = 1 << 16

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str) -> int:
    """The 64-bit SimHash of a text; 0 without words."""
    words = text.encode().translate(_LOWER).split()  # bytes split at space and 9 to 13 only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    starts, ends = starts[:n].tolist(), ends[len(words) - n:].tolist()
    hashed, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        hashes = np.array([hashed(joined[s:e], SEED) for s, e in zip(starts[at:at + BLOCK], ends[at:at + BLOCK])], ">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """``2 ** (radius + 1) - 1`` masks, one of which is zero wherever two words within the radius differ.

    Bit i has a vector m(i) of ``radius + 1`` binary coordinates; the mask of a
    nonzero vector v holds the bits with odd <m(i), v>. At most ``radius`` vectors
    of differing bits span too little to exclude every v, so some v is orthogonal to
    all of them, and its mask ignores just these bits.
    """
    top = 1 << (radius + 1)
    return [sum(1 << i for i in range(bits) if ((1 + i % (top - 1)) & v).bit_count() % 2) for v in range(1, top)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) of every row."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_signed(fingerprint(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    small_batches(docs.sparkSession)
    return id_text(docs, id_col, text_col).mapInArrow(hashed, "doc_id long, fp long")


def _close(batch: np.ndarray, same: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``radius`` among rows of one bucket; ``same`` numbers the buckets of sorted rows."""
    left, right, shift = [], [], 1
    at = np.arange(len(batch))
    while len(at := at[at + shift < len(batch)]) and len(at := at[same[at] == same[at + shift]]):
        near = at[np.bitwise_count(batch[at] ^ batch[at + shift]) <= radius]
        left.append(near)
        right.append(near + shift)
        shift += 1
    none = [np.empty(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The links (a, b) as (node, root) pairs, a tree for each component: at most a row a node."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[:len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new[new]]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return np.stack([nodes[moved], nodes[root[moved]]], 1)


def links(fps: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints (``fp``), enough to connect all within ``radius``.

    Every fingerprint goes into one bucket of each covering table; any two within the
    radius share a bucket. Buckets are sorted runs of a stream: one of at most
    ``max_bucket`` members is compared bitwise, and only a spanning forest of its
    links leaves the task. Members of a larger bucket are passed on unpaired, and
    linked by midpoints: two words are within 2h of each other just if some word is
    within h of both, so each joins the words in its ball of radius h, and those that
    meet there are chained. That takes a fixed number of rows a fingerprint, however
    large the bucket, and a ball holds no more fingerprints than it has words.
    """
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).alias("mask")) for t, m in enumerate(masks)])
    buckets = (fps.select("fp", F.explode(tables).alias("m"))
               .select(F.col("m.t").alias("t"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"), "fp")
               .repartition("t", "key").sortWithinPartitions("t", "key", "fp"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        rest, overfull = (none, none, none), None  # rows of the bucket that the next batch may continue

        def rows(forest, alone):
            a = np.concatenate([forest[:, 0], alone])
            b = pa.array(np.concatenate([forest[:, 1], alone]))
            return pa.RecordBatch.from_arrays(
                [pa.array(a), b, pa.array(np.arange(len(a)) >= len(forest))], names=["a", "b", "many"])

        def settled(t, key, fp):
            nonlocal overfull
            if not len(fp):
                return rows(np.empty((0, 2), np.int64), none)
            new = np.concatenate(([True], (t[1:] != t[:-1]) | (key[1:] != key[:-1])))
            same = np.cumsum(new) - 1
            large = np.bincount(same)[same] > max_bucket
            if overfull is not None:  # a bucket found too large in an earlier batch
                large |= (t == overfull[0]) & (key == overfull[1])
            small = ~large
            x, y = _close(fp[small].view(np.uint64), same[small], radius)
            forest = _forest(fp[small][x], fp[small][y]) if len(x) else np.empty((0, 2), np.int64)
            return rows(forest, fp[large])

        for batch in batches:
            t, key, fp = (np.concatenate([r, c.to_numpy()]) for r, c in zip(rest, batch.columns))
            if not len(t):
                continue
            last = (t == t[-1]) & (key == key[-1])
            if last.sum() > max_bucket:  # too large already: let its members go, remember the bucket
                yield settled(t, key, fp)
                overfull, rest = (t[-1], key[-1]), (none, none, none)
            elif overfull is not None and overfull == (t[-1], key[-1]):
                yield settled(t, key, fp)
                rest = (none, none, none)
            else:
                yield settled(t[~last], key[~last], fp[~last])
                rest = (t[last], key[last], fp[last])
        yield settled(*rest)

    small_batches(fps.sparkSession, 50_000)  # rows of three numbers
    found = spool(buckets.mapInArrow(compare, "a long, b long, many boolean"), "simhash-links")
    ball = [sum(1 << i for i in at) for n in range(radius // 2 + 1) for at in combinations(range(BITS), n)]
    met = (found.where("many").select(F.col("a").alias("fp")).distinct()
           .select("fp", F.explode(F.array(*[F.lit(_signed(d)) for d in ball])).alias("d"))
           .groupBy(F.col("fp").bitwiseXOR(F.col("d")).alias("mid")).agg(F.sort_array(F.collect_list("fp")).alias("fps"))
           .where(F.size("fps") > 1))
    chain = met.select(F.element_at("fps", 1).alias("b"), F.explode(F.slice("fps", F.lit(2), F.size("fps"))).alias("a"))
    return found.where("not many").select("a", "b").unionByName(chain.select("a", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)``: one root for the nodes of each connected component of ``edges (a, b)``.

    Contraction: in each round every node merges into the neighbour (or itself) that
    a hash drawn anew puts lowest, and edges are renamed; a long chain or a star
    shrinks alike, by a constant share expected a round. Each round is stored, so no
    lineage grows; the lowest neighbour is found with partial minima, and renaming
    joins stored tables, whose skew (the middle of a star) the planner splits.
    """
    rounds, edges = 0, spool(edges, "components-edges")
    labels = None
    while not edges.isEmpty():
        rounds += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(rounds), c).alias("h"), c.alias("to"))  # noqa: E731, B023
        a, b = F.col("a"), F.col("b")
        both = edges.select(a.alias("node"), rank(b).alias("r")).unionByName(edges.select(b.alias("node"), rank(a).alias("r")))
        lowest = (both.groupBy("node").agg(F.min("r").alias("r"))
                  .select("node", F.least(F.col("r"), rank(F.col("node")))["to"].alias("to")))
        lowest = spool(lowest, "components-round")
        named = (edges.join(lowest.withColumnsRenamed({"node": "a", "to": "a2"}), "a")
                 .join(lowest.withColumnsRenamed({"node": "b", "to": "b2"}), "b").where("a2 != b2"))
        edges = spool(named.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(),
                      "components-edges")
        if labels is None:
            labels = lowest.select("node", F.col("to").alias("root"))
        else:
            labels = spool(labels.join(lowest.withColumnRenamed("node", "root"), "root", "left")
                           .select("node", F.coalesce("to", "root").alias("root")), "components-labels")
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
                    max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``doc_id, fp, component_id, root`` of every row; ``component_id`` is the smallest doc_id reachable
    over fingerprints that differ in at most ``radius`` (even) bits, ``root`` one fingerprint of the component.

    Documents of one fingerprint count once in the search: links and components are
    found among distinct fingerprints, in tables, and joined back to the documents
    by :func:`asterism.llm.common.join_groups`, as one fingerprint may be that of a
    third of all rows.

    Defined cases: null and empty texts, and texts of white space, have fingerprint
    zero and are near-duplicates of each other; texts of fewer than four words are one
    shingle; rows that repeat share a component; null ids never name a component; an
    empty table gives an empty result; other columns are ignored.
    """
    if radius % 2:
        raise ValueError("the radius must be even: midpoints lie halfway")
    rows = spool(fingerprints(docs, id_col, text_col), "simhash-fingerprints")
    classes = spool(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("size")),
                    "simhash-classes")
    roots = components(links(classes.select("fp"), radius, max_bucket)).withColumnRenamed("node", "fp")
    first = (roots.join(classes, "fp").groupBy("root").agg(F.min("first").alias("least")))
    linked = roots.join(first, "root").select("fp", "least", "root")
    named = spool(classes.join(linked, "fp", "left")
                  .select("fp", F.coalesce("least", "first").alias("component_id"),
                          F.coalesce("root", "fp").alias("root"), "size"), "simhash-components")
    return join_groups(rows, named, "fp", "size").select("doc_id", "fp", "component_id", "root")


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@F.pandas_udf(LongType())
def _fingerprint_column(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(lambda t: _signed(fingerprint(t or "")))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that whose doc_id names it.

    Rows are taken out by id where the id is that of one row. Where an id repeats or
    is missing, rows go by id and fingerprint: one row of each stays, if it is the
    least of its component by id (null last), then fingerprint.

    Defined cases: a row that repeats stays once; of rows that share an id and are far
    apart each is judged on its own; a row without an id stays only in a component
    without any id; an empty table gives an empty result; other columns pass through.
    """
    found = spool(near_duplicates(docs), "simhash-verdicts")
    unsure = spool(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
                   .where("rows > 1 or doc_id is null").select("doc_id"), "simhash-unsure")
    far = found.where("doc_id <> component_id")
    if unsure.isEmpty():
        return drop_documents(docs, far, "simhash-dropped")
    named = docs.where("doc_id is not null")
    kept = drop_documents(named.join(unsure, "doc_id", "left_anti").select(*docs.columns), far, "simhash-dropped")

    fp = fresh(docs, "fp")
    rows = (named.join(unsure, "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))
            .withColumn(fp, _fingerprint_column(F.col("text").cast("string"))).dropDuplicates(["doc_id", fp]))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("least")
    keepers = found.groupBy("root").agg(least).select(
        F.col("least.doc_id").alias("keep_id"), F.col("least.fp").alias("keep_fp")).alias("keepers")
    rest = rows.join(keepers, F.col("doc_id").eqNullSafe(F.col("keepers.keep_id")) & (F.col(fp) == F.col("keepers.keep_fp")),
                     "left_semi")
    return kept.unionByName(rest.select(*docs.columns))
