"""Periodic runs of words by recompression: grammar LCE queries extend the candidates of harmonic grids.

A document's words are recompressed: blocks of one symbol, then pairs of a left
and a right symbol, become new symbols, in turn, until few are left. Where a block
or a pair begins and ends depends on the two symbols at that border only, so equal
stretches of words are cut alike but near their ends, and the longest common
extension of two places is found by climbing and descending the levels.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import fresh, small_batches

#: A run is at least this many words and two periods long.
MIN_LENGTH = 12
#: Levels are added until so few symbols are left.
TOP = 8
#: Grid places tested at once, so that a long text needs bounded memory.
BLOCK = 1 << 20

RUNS = "array<struct<start:long,length:long,period:long>>"
_RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _block_cut(sym: np.ndarray, fresh_id: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First places and new symbols of the maximal blocks of one symbol; the next unused symbol."""
    first = np.flatnonzero(np.concatenate(([True], sym[1:] != sym[:-1])))
    sizes = np.diff(np.append(first, len(sym)))
    new, many = sym[first], sizes > 1
    if many.any():
        names, at = np.unique(new[many] * (len(sym) + 1) + sizes[many], return_inverse=True)
        new[many] = fresh_id + at
        fresh_id += len(names)
    return first, new, fresh_id


def _pair_cut(sym: np.ndarray, fresh_id: int, salt: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First places and new symbols where each left symbol joins a right symbol that follows it.

    A hash bit drawn for the level says which symbols are left; of the two ways to read
    it the one with more pairs is taken. Adjacent symbols differ, so some bit makes pairs.
    """
    while True:
        mixed = (sym.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        left = ((mixed ^ (mixed >> np.uint64(29))) >> np.uint64(17)) & np.uint64(1) == 1
        here, there = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
        pair = here if here.sum() >= there.sum() else there
        if pair.any():
            break
        salt += 0x51ED270B
    opens = np.flatnonzero(pair)
    joined = np.zeros(len(sym), bool)
    joined[opens + 1] = True
    first = np.flatnonzero(~joined)
    new = sym[first]
    starts = np.append(pair, False)[first]
    names, at = np.unique(sym[opens] * np.int64(fresh_id) + sym[opens + 1], return_inverse=True)
    new[starts] = fresh_id + at
    return first, new, fresh_id + len(names)


class _Side:
    """The levels in one reading direction: symbols with an end mark, how many more equal symbols follow
    (itself included), the parent that begins at each symbol (-1: none), the first child of each parent."""

    def __init__(self) -> None:
        self.sym: list[np.ndarray] = []
        self.rest: list[np.ndarray] = []
        self.up: list[np.ndarray] = []
        self.down: list[np.ndarray] = []

    def add(self, sym: np.ndarray, first: np.ndarray | None) -> None:
        self.sym.append(np.append(sym, -1))
        ends = np.append(np.flatnonzero(sym[1:] != sym[:-1]), len(sym) - 1)
        at = np.arange(len(sym))
        self.rest.append(np.append(ends[np.searchsorted(ends, at)] - at + 1, 1))
        if first is not None:
            up = np.full(len(sym) + 1, -1)
            up[first] = np.arange(len(first))
            up[-1] = len(first)
            self.up.append(up)
            self.down.append(np.append(first, len(sym)))

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from places ``i`` and ``j`` on are equal (i < j)."""
        top = len(self.sym) - 1
        a, b = i.copy(), j.copy()
        level = np.full(len(i), top)
        live = np.arange(len(i))
        for k in range(top):
            sym, rest, up = self.sym[k], self.rest[k], self.up[k]
            ready = []
            while len(live):
                x, y = a[live], b[live]
                same = sym[x] == sym[y]
                level[live[~same]] = k
                live, x, y = live[same], x[same], y[same]
                ups, vps = up[x], up[y]
                climbs = (ups >= 0) & (vps >= 0)
                done = live[climbs]
                a[done], b[done] = ups[climbs], vps[climbs]
                ready.append(done)
                live, x, y = live[~climbs], x[~climbs], y[~climbs]
                step = np.minimum(rest[x], rest[y])
                a[live], b[live] = x + step, y + step
            live = np.concatenate(ready) if ready else live
        for k in range(top, -1, -1):
            if k < top:
                lower = np.flatnonzero(level > k)
                a[lower], b[lower] = self.down[k][a[lower]], self.down[k][b[lower]]
            sym, rest = self.sym[k], self.rest[k]
            live = np.flatnonzero(level >= k)
            while len(live):
                x, y = a[live], b[live]
                same = sym[x] == sym[y]
                live, x, y = live[same], x[same], y[same]
                step = np.minimum(rest[x], rest[y])
                a[live], b[live] = x + step, y + step
        return a - i


class Grammar:
    """The run-length grammar of a sequence of numbers (0 and up), by recompression."""

    def __init__(self, words: np.ndarray) -> None:
        self.n = len(words)
        self.after, self.before = _Side(), _Side()
        sym, fresh_id, level = words.astype(np.int64), int(words.max(initial=0)) + 1, 0
        while len(sym) > TOP:
            if level % 2 == 0:
                first, new, fresh_id = _block_cut(sym, fresh_id)
            else:
                first, new, fresh_id = _pair_cut(sym, fresh_id, level)
            self._add(sym, first)
            sym, level = new, level + 1
        self._add(sym, None)

    def _add(self, sym: np.ndarray, first: np.ndarray | None) -> None:
        self.after.add(sym, first)
        # read from the end, a parent begins at its last child
        mirrored = None if first is None else (len(sym) - np.append(first[1:], len(sym)))[::-1]
        self.before.add(sym[::-1], mirrored)

    def lce(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal words from places i < j on, and equal words before them."""
        return self.after.extend(i, j), self.before.extend(self.n - j, self.n - i)


def _grid(n: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid places ``i`` with their periods ``q`` from ``low`` to ``high``: every stretch of ``max(q, 12 - q)``
    places, the least over which a run's words equal those q further, holds one."""
    q = np.arange(low, high + 1)
    step = np.maximum(q, MIN_LENGTH - q)
    counts = np.maximum(0, (n - q - 1) // step + 1)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return at * np.repeat(step, counts), np.repeat(q, counts)


_short_grid = lru_cache(256)(_grid)


def _candidates(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid places ``i`` and periods ``q`` where three words in a row, that at i among them, equal those q further."""
    n, low = len(words), 1
    padded = np.concatenate(([-1, -2], words, [-3, -4]))
    top = n // 2 if n >= MIN_LENGTH else 0
    while low <= top:
        # the places of periods from low on number n / low at most each
        high = min(top, low + max(1, BLOCK * low // n))
        i, q = _short_grid(n, low, high) if n <= 2048 else _grid(n, low, high)
        hit = words[i] == words[i + q]
        i, q = i[hit], q[hit]
        same = [padded[i + 2 + d] == padded[i + 2 + d + q] for d in (-2, -1, 1, 2)]
        hit = same[1] & (same[0] | same[2]) | same[2] & same[3]
        if hit.any():
            yield i[hit], q[hit]
        low = high + 1


def runs(words: np.ndarray) -> np.ndarray:
    """``(start, length, period)`` of every run of a sequence of numbers, by start, then period.

    A stretch with period q and at least two of them is found for q and for its
    multiples; of equal stretches the smallest period stays.
    """
    found, grammar = np.empty((0, 3), np.int64), None
    for i, q in _candidates(words):
        grammar = grammar or Grammar(words)
        after, before = grammar.lce(i, i + q)
        length = after + before + q
        long = length >= np.maximum(MIN_LENGTH, 2 * q)
        new = np.stack([i - before, length, q], 1)[long]
        found = np.concatenate([found, new])
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        kept = np.concatenate(([True], (found[1:, :2] != found[:-1, :2]).any(axis=1)))[:len(found)]
        found = found[kept]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def analyse(text: str) -> tuple[np.ndarray, str]:
    """The runs of a text's words, and the words that no run holds after its first period, joined by one space."""
    words = text.encode().split()  # bytes split at space and 9 to 13 only
    ids: dict[bytes, int] = {}
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    found = runs(numbers)
    if not len(found):
        return found, b" ".join(words).decode()
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, found[:, 0] + found[:, 2], 1)
    np.add.at(cover, found[:, 0] + found[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
    return found, b" ".join([words[k] for k in kept.tolist()]).decode()


def find_runs(docs: DataFrame, id_col: str = "doc_id", text: Column | None = None) -> DataFrame:
    """``doc_id, runs, collapsed`` of every row: the runs of its words as ``(start, length, period)`` by start,
    then period, and the text without what they repeat.

    A run is a stretch of consecutive words with smallest period q, at least
    ``max(12, 2 q)`` long, that no neighbouring word extends. Texts are independent, so
    the search is one narrow pass; grid places take n ln n a text, in blocks.

    Defined cases: null and empty texts, and texts of white space, have no runs and
    collapse to the empty text; a text of one word over and over is one run of
    period 1; rows that repeat, or share or lack an id, are judged one by one; an empty
    table gives an empty result; other columns are ignored.
    """
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_runs, sizes, texts = [], [], []
            for value in batch.column(1):
                got, rest = analyse(value.as_py())
                all_runs.append(got)
                sizes.append(len(got))
                texts.append(rest)
            flat = np.concatenate([np.empty((0, 3), np.int64), *all_runs])
            fields = pa.StructArray.from_arrays([pa.array(c) for c in flat.T.copy()], ["start", "length", "period"])
            ends = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, fields), pa.array(texts, pa.string())],
                names=["doc_id", "runs", "collapsed"])

    value = F.col("text") if text is None else text
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(value.cast("string"), F.lit("")).alias("text"))
    small_batches(docs.sparkSession)
    return rows.mapInArrow(found, f"doc_id long, runs {RUNS}, collapsed string")


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a repeated passage in every tenth text, drawn by the checksum h of its id.

    With g = h div 10 and n words, the words from a = g mod n on repeat those of the
    period p = 1 + (n - a) div (3 + g mod 8). Texts without words, rows without an id and
    all other rows stay as they are.
    """
    h, words, a, p = (fresh(docs, c) for c in ("h_", "words_", "a_", "p_"))
    chosen = F.col(h) % 10 == 0
    g, n, at = F.floor(F.col(h) / 10).cast("long"), F.size(words), F.col(a)
    split = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    marked = (docs.withColumn(h, F.crc32(F.col(id_col).cast("string").cast("binary")))
              .withColumn(words, F.when(chosen, split))
              .withColumn(a, F.when(n > 0, g % n).cast("int"))
              .withColumn(p, (F.lit(1) + F.floor((n - at) / (F.lit(3) + g % 8))).cast("int")))
    moved = F.transform(words, lambda w, i: F.when(i < at, w).otherwise(
        F.element_at(words, (at + (i - at) % F.col(p) + 1).cast("int"))))
    text = F.when(F.col(a).isNotNull(), F.array_join(moved, " ")).otherwise(F.col(text_col))
    return marked.withColumn(text_col, text).select(*docs.columns)


def summary(found: DataFrame) -> DataFrame:
    """The runs of each document in fixed columns: their number, the longest (ties: smallest start, then period), digests."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"),
                                                              r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    length, period = -best["l"], best["p"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["s"].alias("start"), length.alias("length"),
        period.alias("period"), F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
