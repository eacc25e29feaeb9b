"""Key checks that leave large tables where they are: primary keys of tables that lie sorted in their
files (V1), foreign keys that are whole numbers (V2)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from asterism.functions.columns import any_null, quoted
from asterism.session import scratch_path


class NotSortedError(ValueError):
    """The files don't hold the table in the order of its keys."""


def _order(now: pa.Table, then: pa.Table) -> tuple[pa.Array, pa.Array]:
    """Row by row, whether ``now`` has the key of ``then``, and whether it comes before it (NULLs first)."""
    same, less = pa.array([True] * len(now)), pa.array([False] * len(now))
    for a, b in zip(now.columns, then.columns):
        nulls_equal = pc.and_(pc.is_null(a), pc.is_null(b))
        equal = pc.or_(nulls_equal, pc.fill_null(pc.equal(a, b), False))
        lower = pc.or_(pc.and_(pc.is_null(a), pc.is_valid(b)), pc.fill_null(pc.less(a, b), False))
        less = pc.or_(less, pc.and_(same, lower))
        same = pc.and_(same, equal)
    return same, less


def _places(mask) -> list[int]:
    return np.flatnonzero(np.asarray(mask.to_numpy(zero_copy_only=False) if isinstance(mask, pa.Array) else mask.to_numpy())).tolist()


def _runs(keys: list[str]):
    """Finds, in a stream of rows ``file, start, keys…``, the runs of equal keys of each block of a file.

    Gives those that repeat a key or hold a NULL inside a block, and the first and the last of a block, which the
    neighbouring blocks may go on with: ``keys…, n, file, start, place`` (0 first, 1 inside, 2 last, 3 both).
    """
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, run, n, first = None, None, 0, True  # the run that goes on, how long it is, whether it is the block's first

        def row(place: int) -> pa.RecordBatch:
            columns = [*run.combine_chunks().columns, pa.array([n], pa.int64()), pa.array([block[0]], pa.string()),
                       pa.array([block[1]], pa.int64()), pa.array([place], pa.int32()), pa.array([False])]
            return pa.Table.from_arrays(columns, names).to_batches()[0]

        names = [*keys, "n", "file", "start", "place", "unsorted"]
        for batch in batches:
            table = pa.Table.from_batches([batch])
            places = pc.or_(pc.not_equal(table["file"][1:], table["file"][:-1]), pc.not_equal(table["start"][1:], table["start"][:-1]))
            cuts = [0, *(i + 1 for i in _places(pc.fill_null(places, True))), len(table)] if len(table) else []
            for low, high in zip(cuts, cuts[1:]):
                part, here = table[low:high].select(keys), (table["file"][low].as_py(), table["start"][low].as_py())
                if here != block:
                    if block is not None:
                        yield row(3 if first else 2)
                    block, run, n, first = here, part[:1], 0, True
                # each row against the one before it; the run that goes on stands before the first
                before = pa.concat_tables([run, part[:-1]])
                same, less = _order(part, before)
                if pc.any(less).as_py():
                    bad = _places(less)[0]
                    columns = [*part[bad:bad + 1].combine_chunks().columns, pa.array([0], pa.int64()), pa.array([block[0]], pa.string()),
                               pa.array([block[1]], pa.int64()), pa.array([1], pa.int32()), pa.array([True])]
                    yield pa.Table.from_arrays(columns, names).to_batches()[0]
                ends = _places(pc.invert(same))
                if ends:  # the run that went on ends here
                    n += ends[0]
                    if first or n > 1 or any(c[0].as_py() is None for c in run.columns):
                        yield row(0 if first else 1)
                    first = False
                # runs wholly inside this part: only those longer than one, or with a NULL, matter
                starts = ends[:-1]
                sizes = [b - a for a, b in zip(ends, ends[1:])]
                gap = set(_places(reduce(pc.or_, [pc.is_null(c) for c in part.columns])))
                long = [k for k, size in enumerate(sizes) if size > 1 or starts[k] in gap]
                if long:
                    picked = part.take([starts[k] for k in long]).combine_chunks()
                    m = len(long)
                    yield pa.Table.from_arrays(
                        [*picked.columns, pa.array([sizes[k] for k in long], pa.int64()), pa.array([block[0]] * m, pa.string()),
                         pa.array([block[1]] * m, pa.int64()), pa.array([1] * m, pa.int32()), pa.array([False] * m)],
                        names).combine_chunks().to_batches()[0]
                if ends:
                    run, n = part[ends[-1]:ends[-1] + 1], len(part) - ends[-1]
                else:
                    n += len(part)
        if block is not None:
            yield row(3 if first else 2)

    return found


def check_unique_sorted(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`asterism.operators.quality.check_unique` of a table read from files sorted by ``keys``, without shuffling it.

    Each block of a file is read in order and reduced to the keys that repeat inside it and its
    first and last key, with their counts; only these few rows are grouped. That the files hold
    disjoint ranges, each sorted by the keys (as ``write_fact`` lays them out by range), is
    checked on the way: a key before its neighbour, or blocks whose ranges overlap, raise
    :class:`NotSortedError`. The blocks' rows are stored when called.
    """
    spark, keys = stored.sparkSession, list(keys)
    rows = stored.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                         *[quoted(k) for k in keys])
    kinds = ", ".join(f"`{k}` {stored.schema[k].dataType.simpleString()}" for k in keys)
    found = rows.mapInArrow(_runs(keys), f"{kinds}, n long, file string, start long, place int, unsorted boolean")
    path = scratch_path(spark, "key-runs")
    found.write.parquet(path)
    runs = spark.read.parquet(path)
    if not runs.where("unsorted").isEmpty():
        raise NotSortedError(f"a file isn't sorted by {keys}")
    key = F.struct(*[quoted(k) for k in keys])
    ends = (runs.where("place <> 1").groupBy("file", "start").agg(F.min(F.struct("place", key.alias("k"))).alias("a"),
                                                                  F.max(F.struct("place", key.alias("k"))).alias("b")))
    # a few rows for each block
    after = F.lag(F.col("b.k")).over(Window.orderBy(F.col("a.k"), F.col("b.k")))
    if not ends.select(F.col("a.k").alias("low"), after.alias("before")).where(F.col("before") > F.col("low")).isEmpty():
        raise NotSortedError(f"files overlap in their ranges of {keys}")
    return (runs.groupBy(*[quoted(k) for k in keys]).agg(F.sum("n").alias("n")).where((F.col("n") > 1) | any_null(keys)))


#: Keys of one row of a key map: WORDS longs of WORD bits.
WORDS, WORD = 8, 64
#: Orphan keys that are broadcast to the fact to be counted; more meet it by shuffle.
MAX_BROADCAST_KEYS = 1_000_000


def key_map(df: DataFrame, key: str) -> DataFrame:
    """``block, words``: which whole numbers occur as ``key``, a bit each, 512 consecutive ones to a row.

    Combined map-side, so a task gives at most a row for each block it meets, however
    often its keys repeat.
    """
    value = quoted(key).cast("long")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), value.bitwiseAND(F.lit(WORD - 1)).cast("int"))
    word = F.shiftright(value, 6).bitwiseAND(F.lit(WORDS - 1))
    bits = [F.coalesce(F.bit_or(F.when(word == k, one)), F.lit(0).cast("long")) for k in range(WORDS)]
    return df.where(quoted(key).isNotNull()).groupBy(F.shiftright(value, 9).alias("block")).agg(F.array(*bits).alias("words"))


def check_dense_foreign_key(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """:func:`asterism.operators.quality.check_foreign_key` for one key of whole numbers, such as a surrogate id.

    Both tables are reduced to maps of their keys, a bit for each, and only the maps are
    shuffled: of a dense key 1/512 as many rows as it has values, however large the parent.
    The bits that the fact has and the parent hasn't are the orphan keys, exactly; they are
    stored, and the fact is read again, without a shuffle of its rows, only if there are any.
    NULL passes. A key spread thinly over its range has a block of its own for each value;
    ``check_foreign_key`` serves it better, and keys of other types.
    """
    spark, dim_key = fact.sparkSession, dim_key or fact_key
    for df, key in ((fact, fact_key), (dim, dim_key)):
        if not isinstance(df.schema[key].dataType, IntegralType):
            raise ValueError(f"{key} isn't a whole number")
    none = F.array_repeat(F.lit(0).cast("long"), WORDS)
    lost = F.zip_with("f.words", F.coalesce("p.words", none), lambda f, p: f.bitwiseAND(F.bitwise_not(p)))
    blocks = (key_map(fact, fact_key).alias("f").join(key_map(dim, dim_key).alias("p"), F.col("f.block") == F.col("p.block"), "left")
              .select(F.col("f.block").alias("block"), lost.alias("lost")).where(F.exists("lost", lambda w: w != 0)))
    word, bit = F.element_at("lost", F.shiftright("i", 6) + 1), F.col("i").bitwiseAND(F.lit(WORD - 1))
    is_set = F.call_function("shiftrightunsigned", word, bit).bitwiseAND(F.lit(1)) == 1
    keys = (blocks.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(WORDS * WORD - 1)))).where(is_set)
            .select((F.shiftleft("block", 9) + F.col("i")).cast(fact.schema[fact_key].dataType).alias(fact_key)))
    path = scratch_path(spark, "orphan-keys")
    keys.write.parquet(path)
    orphans = spark.read.parquet(path)
    found = orphans.count()
    if not found:
        return orphans.withColumn("n", F.lit(1).cast("long"))
    orphans = F.broadcast(orphans) if found <= MAX_BROADCAST_KEYS else orphans
    return (fact.select(quoted(fact_key)).join(orphans, fact_key, "left_semi").groupBy(quoted(fact_key))
            .agg(F.count(F.lit(1)).alias("n")))
