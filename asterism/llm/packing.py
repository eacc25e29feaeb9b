"""Best-fit packing of token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import base64
import json
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import id_text, small_batches, spool
from asterism.operators.events import with_surrogate_id

CAPACITY, END_ID = 2048, 0
#: The special token of the vocabulary, recognised in texts as its tokenizer does by default.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
#: How the vocabulary's tokenizer cuts a text before merging; white space spelt out.
SPACE = "\t-\r \x85\xa0  -     　"
#: Letters and numbers of newer Unicode tables, which are neither to the vocabulary's tokenizer.
NEWER = ("\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2"
         "\uA7F1\uAB6C-\uAB6D\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7"
         "\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB\U00011DE0-\U00011DE9\U00011DF1\U0001246F"
         "\U00012475-\U0001247F\U00012550-\U00012686\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3"
         "\U00016FF2-\U00016FF6\U000187F8-\U000187FF\U00018CD6-\U00018CDA\U00018D09-\U00018D20"
         "\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168"
         "\U0001D6A6\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF"
         "\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED"
         "\U0001E6F0-\U0001E6F4\U0001E6FE-\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD"
         "\U000323B0-\U00033479\U0003D000-\U0003FC3F")
PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
           rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: The same for texts that hold any of these.
PATTERN_NEWER = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?(?:(?![{NEWER}])\p{{L}})+| ?(?:(?![{NEWER}])\p{{N}})+"
                 rf"| ?(?:[{NEWER}]|[^{SPACE}\p{{L}}\p{{N}}])+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Cut pieces whose ids a task remembers.
CACHE_PIECES = 400_000

#: Islands, their populations, generations between migrations, and migrations.
ISLANDS, POPULATION, GENERATIONS, MIGRATIONS = 4, 6, 6, 2

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- tokens ---------------------------------------------------------------------------------

class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    A byte-level BPE merges within pieces that a pattern cuts, so the ids of each
    distinct piece are found once and remembered.
    """

    def __init__(self, vocabulary: str):
        import regex

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.merge = tiktoken.Encoding("bpe", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        self.cut, self.cut_newer = (regex.compile(p).findall for p in (PATTERN, PATTERN_NEWER))
        self.plain = {chr(c) for a, b in re.findall("(.)(?:-(.))?", NEWER) for c in range(ord(a), ord(b or a) + 1)}.isdisjoint
        self.known: dict[str, bytes] = {}

    def _ids(self, piece: str) -> bytes:
        ids = np.array(self.merge.encode_ordinary(piece), "<u4").tobytes()
        if len(self.known) < CACHE_PIECES:
            self.known[piece] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        known, parts = self.known, []
        for i, plain in enumerate(text.split(SPECIAL)):
            if i:
                parts.append(np.array([SPECIAL_ID], "<u4").tobytes())
            for piece in (self.cut if plain.isascii() or self.plain(plain) else self.cut_newer)(plain):
                ids = known.get(piece)
                parts.append(self._ids(piece) if ids is None else ids)
        return b"".join(parts)


@cache
def encoder(vocabulary: str) -> Encoder:
    """One for each worker process and vocabulary."""
    return Encoder(vocabulary)


def pieces_of(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of ``n`` ids: the first takes what full pieces leave."""
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def tokenize(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    ``vocabulary`` is a file of ranks (base64 token, rank), readable by every executor.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = encode(text.as_py()) + end
                rows += [(doc_id, k, start, size, raw[4 * start:4 * (start + size)])
                         for k, (start, size) in enumerate(pieces_of(len(raw) // 4, capacity))]
            ids, piece, start, size, raw = zip(*rows, strict=True) if rows else ((),) * 5
            arrays = [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                      pa.array(size, pa.int64()), pa.array(map(zlib.crc32, raw), pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(r, "<u4").astype(np.int32) for r in raw], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    small_batches(docs.sparkSession)
    return id_text(docs, id_col, text_col).mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


# --- the search -----------------------------------------------------------------------------
#
# Documents of one length are interchangeable, so a packing is a count of bins by
# content: {((length, how many), ...): how many such bins}. Its size is bounded by
# the number of lengths (at most the capacity), not by the number of documents.

Bins = dict[tuple[tuple[int, int], ...], int]


def used(bin_: tuple[tuple[int, int], ...]) -> int:
    return sum(size * k for size, k in bin_)


def best_fit(bins: Bins, items: dict[int, int], capacity: int = CAPACITY) -> Bins:
    """Put ``items`` {length: count}, longest first, each into the bin that it leaves least room in."""
    by_room: dict[int, Counter] = {}
    rooms = 0  # bit r is set if some bin has room r

    def add(bin_, count):
        nonlocal rooms
        room = capacity - used(bin_)
        by_room.setdefault(room, Counter())[bin_] += count
        rooms |= 1 << room

    def put(bin_, size, k, count):
        if count:
            held = dict(bin_)
            held[size] = held.get(size, 0) + k
            add(tuple(sorted(held.items(), reverse=True)), count)

    for bin_, count in bins.items():
        add(bin_, count)
    for size in sorted(items, reverse=True):
        left = items[size]
        while left > 0:
            fitting = rooms >> size
            room = (fitting & -fitting).bit_length() - 1 + size if fitting else capacity
            if fitting:
                bin_, count = by_room[room].popitem()
                if not by_room[room]:
                    rooms &= ~(1 << room)
            else:
                bin_, count = (), -(-left // (capacity // size))
            each = room // size
            full = min(count, left // each)
            put(bin_, size, each, full)
            left -= full * each
            rest = count - full
            if rest and left:  # the last few go into one bin
                put(bin_, size, left, 1)
                left, rest = 0, rest - 1
            if rest and bin_:
                add(bin_, rest)
    out: Bins = {}
    for group in by_room.values():
        out.update(group)
    return out


def cost(bins: Bins, capacity: int = CAPACITY) -> tuple[int, float]:
    """Number of bins, then how evenly they are filled (fuller ones beside emptier ones are better)."""
    return sum(bins.values()), -sum(n * (used(b) / capacity) ** 2 for b, n in bins.items())


def crossover(mother: Bins, father: Bins, lengths: dict[int, int], rng: random.Random,
              capacity: int = CAPACITY) -> Bins:
    """A child with whole well-filled bins of the father.

    About half of the father's well-filled bins are injected. The mother's bins stay
    as far as their documents are not in the child yet; the documents of her other
    bins are displaced and go back in by best fit.
    """
    child: Bins = {}
    left = dict(lengths)

    def inject(bin_, count):
        count = min([count, *(left[size] // k for size, k in bin_)])
        if count > 0:
            child[bin_] = child.get(bin_, 0) + count
            for size, k in bin_:
                left[size] -= count * k

    filled = sorted(father.items(), key=lambda x: capacity - used(x[0]))
    for bin_, count in filled[:max(1, len(filled) * 3 // 4)]:
        inject(bin_, rng.randint(0, count))
    for bin_, count in sorted(mother.items(), key=lambda x: capacity - used(x[0])):
        inject(bin_, count)
    return best_fit(child, {s: n for s, n in left.items() if n}, capacity)


def mutate(bins: Bins, rng: random.Random, capacity: int = CAPACITY) -> Bins:
    """Empty the worst-filled bins and some others, and put their documents back by best fit."""
    kept, loose = {}, Counter()
    for at, (bin_, count) in enumerate(sorted(bins.items(), key=lambda x: used(x[0]))):
        out = count if at < 8 else rng.randint(0, count) if rng.random() < 0.05 else 0
        for size, k in bin_:
            loose[size] += out * k
        if count > out:
            kept[bin_] = count - out
    first = {s: n for s, n in loose.items() if rng.random() < 0.5}  # in two goes, for another order
    kept = best_fit(kept, {s: n for s, n in first.items() if n}, capacity)
    return best_fit(kept, {s: n for s, n in loose.items() if n and s not in first}, capacity)


def lower_bound(lengths: dict[int, int], capacity: int = CAPACITY) -> int:
    total = sum(s * n for s, n in lengths.items())
    return max(-(-total // capacity), sum(n for s, n in lengths.items() if 2 * s > capacity))


def evolve(population: list[Bins], lengths: dict[int, int], seed: int, capacity: int = CAPACITY) -> list[Bins]:
    """Some generations on one island; the best first. Ends early at the lower bound."""
    rng = random.Random(seed)
    key = lambda b: cost(b, capacity)
    population = population or [best_fit({}, lengths, capacity)]
    while len(population) < POPULATION:
        population.append(mutate(population[0], rng, capacity))
    least = lower_bound(lengths, capacity)
    for _ in range(GENERATIONS):
        population.sort(key=key)
        if key(population[0])[0] <= least:
            break
        for _ in range(POPULATION // 2):
            mother, father = rng.sample(population[:POPULATION - 1], 2)
            child = crossover(mother, father, lengths, rng, capacity)
            population[-1] = min(child, mutate(child, rng, capacity), key=key)
            population.sort(key=key)
    return sorted(population, key=key)


def _write(bins: Bins) -> str:
    return json.dumps([[n, *b] for b, n in bins.items()])


def _read(text: str) -> Bins:
    return {tuple(map(tuple, b)): n for n, *b in json.loads(text)}


def search(spark, lengths: dict[int, int], capacity: int = CAPACITY) -> Bins:
    """The best packing of ``lengths`` found: islands are tasks, and elites migrate between them.

    Each island starts from best fit, and evolves a population of its own. Then its
    best two move to the next island (a ring), as rows of a table, and the next round
    starts from what arrived and the island's own best. Rounds end early if a packing
    meets the lower bound. All of it is bounded by the number of lengths.
    """
    def island(key: tuple, elites: pd.DataFrame) -> pd.DataFrame:
        came = [_read(g) for g in elites.sort_values(["bins", "genes"]).genes if g]
        ranked = evolve(came, lengths, 1000 * int(elites["round"].iloc[0]) + int(key[0]), capacity)
        return pd.DataFrame({"island": int(key[0]), "rank": range(len(ranked)),
                             "bins": [sum(b.values()) for b in ranked], "genes": [_write(b) for b in ranked]})

    schema = "island int, rank int, bins long, genes string"
    elites = spark.range(ISLANDS).select(F.col("id").cast("int").alias("island"), F.lit(0).cast("long").alias("bins"),
                                         F.lit("").alias("genes"), F.lit(0).alias("round"))
    least, found = lower_bound(lengths, capacity), None
    for at in range(1, MIGRATIONS + 2):
        # a stated number of partitions, or the planner would put all islands into one task
        dealt = elites.repartition(4 * ISLANDS, "island")
        found = spool(dealt.groupBy("island").applyInPandas(island, schema), "packing-islands")
        if found.agg(F.min("bins")).first()[0] <= least:
            break
        best = found.where("rank < 2")
        moved = best.withColumn("island", ((F.col("island") + 1) % ISLANDS).cast("int"))
        elites = moved.unionByName(found.where("rank = 0")).select("island", "bins", "genes", F.lit(at).alias("round"))
    return _read(found.agg(F.min(F.struct("bins", "island", "rank", "genes"))).first()[0]["genes"])


# --- assignment -----------------------------------------------------------------------------

def places(bins: Bins, lengths: dict[int, int]) -> dict[str, np.ndarray]:
    """Where the pieces go, by their position in order of length: runs of positions that fill like bins.

    Piece ``p`` of the run from ``lo`` has sequence ``sequence + (p - lo) // each`` and
    offset ``offset + (p - lo) % each * size``.
    """
    at, next_ = {}, 1  # positions start at 1
    for size in sorted(lengths):
        at[size], next_ = next_, next_ + lengths[size]
    runs, sequence = [], 0
    for bin_, count in sorted(bins.items(), reverse=True):
        offset = 0
        for size, each in bin_:
            runs.append((at[size], sequence, each, offset, size))
            at[size] += each * count
            offset += each * size
        sequence += count
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return dict(zip(("lo", "sequence", "each", "offset", "size"), table.T, strict=True))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its place in a sequence of at most ``capacity`` tokens.

    ``doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset``. A document
    is its ids and an end id; only longer ones are cut, and only the first piece of
    these may be shorter than the capacity.

    Pieces are stored once and counted by length; the genetic search packs the counts
    (at most ``capacity`` numbers, whatever the input); pieces are put in order of
    length by a range layout, and each finds its place from its position alone. No
    step gathers documents, and one length may be that of any share of them.

    Defined cases: null and empty texts are a document of the end id alone; rows that
    repeat are packed each; a null id stays null; an empty table gives an empty
    result; other columns are ignored.
    """
    stored = spool(tokenize(docs, vocabulary, capacity, with_ids, id_col, text_col), "packing-pieces")
    lengths = {r["length"]: r["count"] for r in stored.groupBy("length").count().collect()}
    runs = places(search(stored.sparkSession, lengths, capacity) if lengths else {}, lengths)
    ordered = with_surrogate_id(stored, "position", ["length", "doc_id", "piece"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position = batch.column(0).to_numpy()
            run = np.searchsorted(runs["lo"], position, "right") - 1
            k = position - runs["lo"][run]
            sequence = runs["sequence"][run] + k // runs["each"][run]
            offset = runs["offset"][run] + k % runs["each"][run] * runs["size"][run]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sequence), pa.array(offset)],
                                             names=[*batch.schema.names[1:], "sequence_id", "offset"])

    schema = PIECES + (", ids array<int>" if with_ids else "") + ", sequence_id long, offset long"
    return ordered.mapInArrow(place, schema)
