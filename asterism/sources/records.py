"""CSV records of files with line breaks inside quotes, read in many tasks.

A file is read in blocks of physical lines. Whether a block begins inside quotes
isn't known to its task, so a first pass finds for each block how it ends in either
case; a window over the blocks (one small row each) then says how each begins, and a
second pass cuts its records. A record that crosses blocks is put together from its
pieces, at most two a block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asterism.session import scratch_path

#: A record longer than this fails the read: a quote that is never closed would swallow the file.
MAX_RECORD_BYTES = 1 << 26
#: Blocks whose rows are broadcast, some 200 bytes each.
MAX_BLOCKS = 500_000

_BLOCK_SCHEMA = ("file long, start long, lines long, first_text long, out_outside boolean, out_inside boolean, head string, "
                 "closes boolean, tail_outside string, tail_outside_at long, tail_inside string, tail_inside_at long")


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a physical line ends inside quotes, given how it begins: at a record's start, or inside.

    Only a quote at a field's start opens one; a doubled quote inside is a quote.
    """
    at = 0
    if not inside:
        if line.startswith('"'):
            at = 1
        elif (at := line.find(',"')) < 0:
            return False
        else:
            at += 2
    while True:
        close = line.find('"', at)
        if close < 0:
            return True
        if line.startswith('"', close + 1):
            at = close + 2
        elif (at := line.find(',"', close + 1)) < 0:
            return False
        else:
            at += 2


def _line_states(lines: pa.Array, inside: bool) -> np.ndarray:
    """Whether each line begins inside quotes, and whether the last one ends so, given how the first begins.

    Where every quote that would open a field stands at its start, or doubles one, the number
    of quotes before a line tells; only batches with others are scanned line by line.
    """
    lines = lines.cast(pa.large_string())
    ends = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + len(lines) + 1]
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    quotes = np.flatnonzero(data == ord('"'))
    opens = quotes[int(inside)::2]
    before = data[np.maximum(opens - 1, 0)]
    first = ends[np.searchsorted(ends, opens, "right") - 1] == opens
    if (first | (before == ord(",")) | (before == ord('"'))).all():
        return (np.searchsorted(quotes, ends) % 2 == 1) ^ inside
    states = [inside]
    for line in lines.to_pylist():
        states.append(ends_inside(line, states[-1]) if '"' in line else states[-1])
    return np.array(states)


def _joined(lines: list[pa.Array]) -> str:
    return "\n".join(pa.chunked_array(lines).to_pylist())


@dataclass
class _Case:
    """A block's lines so far, for one way it may begin."""

    inside: bool
    pending: list[pa.Array] = field(default_factory=list)  # from the start of the last record on
    size: int = 0
    at: int = 0
    started: bool = False  # a record has begun in this block
    head: str | None = None
    closes: bool = False

    def add(self, lines: pa.Array, states: np.ndarray, base: int) -> None:
        closed = np.flatnonzero(~states[1:]) if not self.started and self.inside else ()
        if len(closed):
            self._keep(lines[:closed[0] + 1])
            self.head, self.closes, self.started = self.text(), True, True
        starts = np.flatnonzero(~states[:-1])
        if len(starts):
            self.pending, self.size, self.at, self.started = [], 0, base + int(starts[-1]), True
            lines = lines[starts[-1]:]
        self._keep(lines)
        self.inside = bool(states[-1])

    def _keep(self, lines: pa.Array) -> None:
        if self.size <= MAX_RECORD_BYTES:  # beyond, the text is of no use
            self.pending.append(lines)
        self.size += lines.nbytes

    def text(self) -> str | None:
        return _joined(self.pending) if self.size <= MAX_RECORD_BYTES else None


def _segments(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Array, bool]]:
    """The lines (last column) of a stream in pieces of one block, named by its first ``keys`` columns."""
    last = None
    for batch in batches:
        if not len(batch):
            continue
        changes = np.zeros(len(batch) - 1, bool)
        # a block's lines follow each other: equal ends mean that no other lies between
        if any(column[0] != column[-1] for column in batch.columns[:keys]):
            for column in batch.columns[:keys]:
                changes |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), len(batch)]
        for low, high in zip(cuts, cuts[1:]):
            key = tuple(c[low].as_py() for c in batch.columns[:keys])
            yield key, batch.columns[-1][low:high], key != last
            last = key


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block of a stream of lines ``file, start, value``."""
    names = [c.split()[0] for c in _BLOCK_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.bool_(), pa.string(), pa.int64(),
             pa.string(), pa.int64()]
    key, count, first, cases = None, 0, None, ()

    def row():
        outside, inside = cases
        head = inside.head if inside.started else inside.text()
        values = [*key, count, first, outside.inside, inside.inside, head, inside.closes,
                  outside.text() if outside.inside else None, outside.at,
                  inside.text() if inside.inside and inside.started else None, inside.at]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    for block, lines, new in _segments(batches, 2):
        if new:
            if key is not None:
                yield row()
            key, count, first, cases = block, 0, None, (_Case(False), _Case(True))
        if first is None:
            texts = np.flatnonzero(pc.not_equal(pc.utf8_trim_whitespace(lines), "").to_numpy(zero_copy_only=False))
            first = count + int(texts[0]) if len(texts) else None
        outside, inside = cases
        states = _line_states(lines, outside.inside)
        # a wrong guess soon meets a quote that sets it right; from then on both are one
        others = states if inside.inside == outside.inside else _line_states(lines, inside.inside)
        outside.add(lines, states, count)
        inside.add(lines, others, count)
        count += len(lines)
    if key is not None:
        yield row()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, line, record`` of the records that lie within one block, from lines ``block, open, value``."""
    rest, count, inside, skips = None, 0, False, False
    for (block, opens), lines, new in _segments(batches, 2):
        if new:  # what the last block left open goes on in the next
            rest, count, inside, skips = None, 0, opens, opens
        states = _line_states(lines, inside)
        inside, base, n = bool(states[-1]), count, len(lines)
        if skips:  # the end of a record that an earlier block begins
            closed = np.flatnonzero(~states[1:])
            skip = int(closed[0]) + 1 if len(closed) else n
            skips, lines, states, base = not len(closed), lines[skip:], states[skip:], base + skip
        count += n
        if rest is not None:
            states = np.concatenate(([False], np.ones(len(rest) - 1, bool), states))
            lines, base = pa.concat_arrays([rest, lines]), base - len(rest)
        starts = np.flatnonzero(~states[:-1])
        whole = starts if inside else np.append(starts, len(lines))
        rest = lines[starts[-1]:] if inside and len(starts) else None
        if rest is not None and rest.nbytes > MAX_RECORD_BYTES:
            raise ValueError(f"a record has more than {MAX_RECORD_BYTES} bytes: is a quote not closed?")
        if len(whole) > 1:
            at = pa.array(whole - whole[0], pa.int32())
            records = pc.binary_join(pa.ListArray.from_arrays(at, lines[whole[0]:whole[-1]]), "\n")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(records), block)), pa.array(base + whole[:-1]), records],
                                             names=["block", "line", "record"])


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    # only \n ends a line, so that joining lines by it restores the text; files go by a hash, as each line carries it
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _names(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, name``: the paths of all files by their hash, from the listing."""
    # a local file is listed with three slashes and read with one
    files = {name for listed in spark.read.text(path).inputFiles() for name in (listed, listed.replace(":///", ":/", 1))}
    return spark.createDataFrame([(name,) for name in files], "name string").select(F.xxhash64("name").alias("file"), "name")


def blocks(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row for each block that the files are read in, with ``open`` (it begins inside quotes) and ``before``
    (lines of the file before it), stored.

    How a block ends is a function of how it begins: itself, the opposite, or the same in
    both cases. So a block's beginning follows from the last block before it that has
    one end only, and the number of opposites since then.
    """
    path_of = scratch_path(spark, "csv-blocks")
    found = _lines(spark, path).mapInArrow(_summed, _BLOCK_SCHEMA)
    order = Window.partitionBy("file").orderBy("start")
    past, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    fixed = F.col("out_outside") == F.col("out_inside")
    turns = F.when(F.col("out_outside") & ~F.col("out_inside"), 1).otherwise(0)
    placed = (found.withColumn("turned", F.sum(turns).over(upto))
              .withColumn("known", F.last(F.when(fixed, F.struct(F.col("out_outside").alias("state"), "turned")), True).over(past))
              .withColumn("turned", F.coalesce(F.sum(turns).over(past), F.lit(0)))
              .withColumn("before", F.coalesce(F.sum("lines").over(past), F.lit(0)))
              .withColumn("header_line", F.min(F.col("before") + F.col("first_text") + 1).over(Window.partitionBy("file"))))
    since = F.col("turned") - F.coalesce(F.col("known.turned"), F.lit(0))
    opens = F.coalesce(F.col("known.state"), F.lit(False)) != (since % 2 == 1)
    (placed.withColumn("open", opens).drop("turned", "known").join(F.broadcast(_names(spark, path)), "file", "left")
     .withColumn("name", F.coalesce("name", F.col("file").cast("string")))
     .withColumn("block", F.monotonically_increasing_id()).write.parquet(path_of))
    return spark.read.parquet(path_of)


def read_records(spark: SparkSession, path: str | Sequence[str], header: bool = True) -> DataFrame:
    """``file, line, record, unclosed``: every CSV record of the files as text, whole, and the line that it begins in.

    Each block of a file is read by a task of its own, of at most
    ``spark.sql.files.maxPartitionBytes``, wherever its quotes begin and end. The blocks are
    found in one pass when called; the records are cut lazily in a second one, and only
    the pieces of records that cross blocks are shuffled. ``header`` leaves out the first
    record of each file. Blank records are left out; a carriage return that ends a record
    is dropped, one inside quotes is kept. ``unclosed`` marks a record whose quote the file
    never closes. A record of more than MAX_RECORD_BYTES fails.
    """
    found = blocks(spark, path)
    if (count := found.count()) > MAX_BLOCKS:
        raise ValueError(f"{count} blocks; raise spark.sql.files.maxPartitionBytes")
    starts = F.broadcast(found.select("file", "start", "open", "block").withColumnsRenamed({"file": "f", "start": "s"}))
    lines = _lines(spark, path)
    # a block that the first pass hasn't seen means other splits than then
    same = F.when(F.col("block").isNull(), F.raise_error(F.lit("the files are split otherwise than before"))).otherwise(F.col("block"))
    named = (lines.join(starts, (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")), "left")
             .select(same.cast("long").alias("block"), "open", "value"))
    about = F.broadcast(found.select("block", F.col("name").alias("file"), "before", "header_line"))
    within = (named.mapInArrow(_cut, "block long, line long, record string").join(about, "block")
              .select("file", (F.col("before") + F.col("line") + 1).alias("line"), "record", F.lit(False).alias("unclosed"),
                      "header_line"))

    text = F.when(F.col("open"), F.col("tail_inside")).otherwise(F.col("tail_outside"))
    at = F.when(F.col("open"), F.col("tail_inside_at")).otherwise(F.col("tail_outside_at"))
    ends_open = F.when(F.col("open"), F.col("out_inside") & F.col("closes")).otherwise(F.col("out_outside"))
    piece = lambda order, text, line: F.struct(
        F.lit(order).alias("order"), text.alias("text"), (F.col("before") + line + 1).alias("line"))
    pieces = (found.select(F.col("name").alias("file"), "start", "header_line", F.explode(F.array_compact(F.array(
        F.when(F.col("open"), piece(0, F.col("head"), F.lit(0))), F.when(ends_open, piece(1, text, at))))).alias("p"),
        "closes").select("file", "start", "header_line", "p.*", (F.col("closes") & (F.col("p.order") == 0)).alias("closed")))
    begun = F.last(F.when(F.col("order") == 1, F.col("start")), True).over(
        Window.partitionBy("file").orderBy("start", "order").rowsBetween(Window.unboundedPreceding, 0))
    too_long = F.raise_error(F.lit(f"a record has more than {MAX_RECORD_BYTES} bytes: is a quote not closed?"))
    across = (pieces.withColumn("begun", begun).groupBy("file", "begun")
              .agg(F.min("line").alias("line"), F.max("header_line").alias("header_line"), F.sort_array(F.collect_list(F.struct("start", "order", "text"))).alias("all"),
                   F.sum(F.octet_length("text")).alias("size"), F.count_if(F.col("text").isNull()).alias("lost"), F.max("closed").alias("closed"))
              .select("file", "line", F.when((F.col("size") > MAX_RECORD_BYTES) | (F.col("lost") > 0), too_long.cast("string"))
                      .otherwise(F.array_join(F.transform("all", lambda p: p["text"]), "\n")).alias("record"),
                      (~F.col("closed")).alias("unclosed"), "header_line"))
    every = within.unionByName(across).withColumn("record", F.regexp_replace("record", "\\r$", ""))
    kept = every.where(F.trim("record") != "")
    return (kept.where("line <> header_line") if header else kept).drop("header_line")
