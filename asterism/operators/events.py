"""Event-table cleaning: dedup with multiplicity (A4), audit (A7), surrogate ids
and the whole clean step (L3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asterism.functions.columns import quoted
from asterism.session import scratch_path

DUPE_COUNT = "group_dupe_cnt"


def dedup_with_count(df: DataFrame, cols: Sequence[str], count_col: str = DUPE_COUNT) -> DataFrame:
    """One row per distinct ``cols`` tuple plus ``count_col`` = number of extra copies.

    A hash aggregate: copies collapse map-side before the shuffle, so a value
    repeated in a third of all rows costs one partial row per task.
    """
    return df.groupBy(*[quoted(c) for c in cols]).agg(
        (F.count(F.lit(1)) - 1).alias(count_col))


def dedup_audit(deduped: DataFrame, count_col: str = DUPE_COUNT) -> DataFrame:
    """One row: ``dupe_count`` = number of groups that had repeats."""
    return deduped.agg(F.count_if(quoted(count_col) > 0).alias("dupe_count"))


def with_surrogate_id(df: DataFrame, name: str, order_by: Sequence[str],
                      first: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Ids 1…n in ``order_by`` order (ascending, NULLs first), without a global sort task.

    ``row_number()`` over an unpartitioned window moves every row into one task.
    Instead rows are range-partitioned on the order and sorted within each
    partition, and written as Parquet under the shared checkpoint folder
    together with their range partition and their position in it. From then on
    the numbering is fixed data: rerun tasks or a different read-back split
    cannot change it. Each row's id is ``offset(partition) + position``; the
    offsets come from a per-partition count (reading only the partition column,
    one row per partition) summed in order and broadcast back.

    Ties in ``order_by`` are broken by a hash of the row, so ids are reproducible
    whenever rows are distinct (after :func:`dedup_with_count` they are). The
    range partitions start from ``spark.sql.shuffle.partitions`` (or
    ``num_partitions``, then fixed); AQE merges adjacent small ones.
    """
    spark = df.sparkSession
    # A hash of the whole row breaks ties last: rows equal on ``order_by`` (say a
    # third of all rows) still spread over several range partitions, and their
    # ids follow a reproducible order. For a total order it never matters.
    tie = F.xxhash64(*[quoted(c) for c in df.columns])
    order = [quoted(c).asc_nulls_first() for c in order_by] + [tie.asc()]
    pid = F.spark_partition_id()
    # Without an explicit count AQE may merge adjacent range partitions (order is
    # kept), so small inputs do not become hundreds of tiny files.
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    laid_out = ranged.sortWithinPartitions(*order).select(
        "*", pid.alias("_pid"),
        (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias("_pos"))
    path = scratch_path(spark, "surrogate-ids")
    laid_out.write.parquet(path)
    stored = spark.read.parquet(path)
    counts = stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    ident = (F.col("_off") + F.col("_pos") + 1).cast("long").alias(name)
    data_cols = [quoted(c) for c in df.columns]
    numbered = stored.join(F.broadcast(offsets), "_pid")
    return numbered.select(ident, *data_cols) if first else numbered.select(*data_cols, ident)


def clean_events(df: DataFrame, keep_cols: Sequence[str], date_col: str | None = None,
                 id_col: str = "id", order_by: Sequence[str] | None = None,
                 time_col: str = "incident_time", time_source: str | None = None,
                 keep_count: bool = False) -> tuple[DataFrame, DataFrame]:
    """Prune, dedup with multiplicity, number, type the date, add the time column (L3).

    Returns ``(clean, audit)``. Rows equal on ``keep_cols`` merge, whatever other
    columns (such as a source id) say. ``date_col`` is reduced to its DATE.
    ``time_col`` (placed after the date) is the time of day as ``'HH:MM:SS'`` text taken from
    ``time_source``, or a typed NULL when there is none. ``group_dupe_cnt`` is
    kept only with ``keep_count=True``.
    """
    deduped = dedup_with_count(df, keep_cols)
    numbered = with_surrogate_id(deduped, id_col, list(order_by or keep_cols))
    if time_source is not None:
        time_value = F.date_format(quoted(time_source), "HH:mm:ss").alias(time_col)
    else:
        time_value = F.lit(None).cast("string").alias(time_col)
    cols = [F.col(id_col)]
    for c in keep_cols:
        cols.append(F.to_date(quoted(c)).alias(c) if c == date_col else quoted(c))
        if c == date_col:
            cols.append(time_value)
    if date_col not in keep_cols:
        cols.append(time_value)
    if keep_count:
        cols.append(F.col(DUPE_COUNT))
    return numbered.select(*cols), dedup_audit(numbered)  # both read the stored layout
