"""Table sinks (S8–S13) and the physical layout of published facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism.functions.columns import quoted

#: Tasks that share one value of the distribution key in the hash layout.
SALTS = 8

MODES = ("errorifexists", "overwrite", "append", "ignore")


def write_table(df: DataFrame, target: str, mode: str = "errorifexists", fmt: str = "parquet",
                partition_by: Sequence[str] = (), as_table: bool = False) -> None:
    """Write ``df`` to a path (or a catalog table with ``as_table=True``).

    ``errorifexists`` (default) refuses to replace anything, like a CREATE
    without IF NOT EXISTS or an upload with replace=False; ``overwrite`` drops
    and recreates.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if as_table:
        w.saveAsTable(target)
    else:
        w.save(target)


def append_log(log_rows: DataFrame, target: str, fmt: str = "parquet") -> None:
    """Append audit rows to the log table."""
    log_rows.write.mode("append").format(fmt).save(target)


def write_fact(df: DataFrame, target: str, dist_key: str, sort_keys: Sequence[str],
               mode: str = "errorifexists", num_partitions: int | None = None,
               layout: str = "range", buckets: int | None = None, fmt: str = "parquet",
               table_path: str | None = None, index: bool = False, tie_cols: Sequence[str] | None = None,
               finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write a fact sorted by ``sort_keys`` so Parquet min/max statistics prune.

    ``layout="range"`` (default) range-partitions on ``dist_key`` then the sort
    keys: files hold contiguous, sorted key ranges, and one hot ``dist_key``
    value is split across several files by the following sort keys (and by a
    row hash when all keys are equal).
    ``layout="hash"`` hash-partitions on ``dist_key`` and a salt of SALTS values, so a
    value lies in at most that many files and a hot one is shared by as many tasks.
    ``layout="bucket"`` saves a catalog table bucketed by ``dist_key`` and sorted
    by ``sort_keys`` so later joins on the key skip their shuffle; ``target`` is
    then a table name, and ``table_path`` the folder of its files (default: the warehouse's).
    A bucket is one file and one task of each join, so a hot key makes one long task there.
    ``index`` adds the least and largest keys of each file (:func:`write_index`).
    ``tie_cols`` are columns that tell rows apart, if fewer than all do. ``finish`` is a step on the rows
    of the range or hash layout, row by row, that leaves their keys and their order: the range layout
    makes its rows twice, for a sample and to move them, so costly columns are better added there.
    """
    if layout == "bucket" and finish:
        raise ValueError("a bucketed table has no finishing step")
    finish = finish or (lambda rows: rows)
    if index and layout == "bucket":
        raise ValueError("a bucketed table has no index of files")
    keys = [dist_key] + [k for k in sort_keys if k != dist_key]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if layout == "range":
        # A hash of the whole row as the last range key (not stored): rows that
        # share every declared key — say a third of all rows — are still spread
        # over several partitions, while files stay sorted by the declared keys.
        tie = F.xxhash64(*[quoted(c) for c in tie_cols or df.columns])
        order = [quoted(k) for k in keys] + [tie]
        # Without an explicit count AQE may merge adjacent small ranges (order kept).
        ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
        laid = finish(ranged.sortWithinPartitions(*order))
        laid.write.mode(mode).format(fmt).save(target)
    elif layout == "hash":
        salt = F.pmod(F.xxhash64(*[quoted(c) for c in tie_cols or df.columns]), F.lit(SALTS))
        laid = finish(df.repartition(n, quoted(dist_key), salt).sortWithinPartitions(*[quoted(k) for k in keys]))
        laid.write.mode(mode).format(fmt).save(target)
    elif layout == "bucket":
        # one file a bucket: rows meet in the partition that their bucket is written from
        writer = (df.repartition(buckets or n, quoted(dist_key)).write.mode(mode).format(fmt).bucketBy(buckets or n, dist_key)
                  .sortBy(*keys))
        (writer.option("path", table_path) if table_path else writer).saveAsTable(target)
    else:
        raise ValueError("layout must be 'range', 'hash' or 'bucket'")
    if index:
        write_index(df.sparkSession, target, keys)


#: Kept inside the table's folder; readers pass over names with an underscore.
INDEX = "_index"
#: Files of a range that are listed by name; beyond, the whole folder is read and filtered.
MAX_LISTED_FILES = 100_000


def write_index(spark: SparkSession, target: str, keys: Sequence[str]) -> None:
    """Store ``file, n`` and the least and largest value of each key for the files of a Parquet table (D3).

    Reads only the key columns; a row for each file.
    """
    rows = spark.read.parquet(target).select(F.col("_metadata.file_name").alias("file"), *[quoted(k) for k in keys])
    bounds = [f(quoted(k)).alias(f"{side}_{k}") for k in keys for side, f in (("low", F.min), ("high", F.max))]
    rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), *bounds).write.mode("overwrite").parquet(f"{target.rstrip('/')}/{INDEX}")


def files_of_range(spark: SparkSession, target: str, ranges: Mapping[str, tuple]) -> DataFrame:
    """``file, n`` of the files that may hold rows within ``ranges`` (key → least and largest value, None: open)."""
    index = spark.read.parquet(f"{target.rstrip('/')}/{INDEX}")
    fits = F.lit(True)
    for key, (low, high) in ranges.items():
        if low is not None:
            fits &= quoted(f"high_{key}") >= F.lit(low)
        if high is not None:
            fits &= quoted(f"low_{key}") <= F.lit(high)
    return index.where(fits).select("file", "n")


def read_range(spark: SparkSession, target: str, ranges: Mapping[str, tuple]) -> DataFrame:
    """The rows of an indexed table within ``ranges`` (ends included; a NULL key is in no range).

    Only the files that the index names are listed and opened, so a narrow range of a table
    of many files costs neither their footers nor a listing.
    """
    within = F.lit(True)
    for key, (low, high) in ranges.items():
        within &= quoted(key).isNotNull()
        within = within & (quoted(key) >= F.lit(low)) if low is not None else within
        within = within & (quoted(key) <= F.lit(high)) if high is not None else within
    root = target.rstrip("/")
    names = [r["file"] for r in files_of_range(spark, target, ranges).take(MAX_LISTED_FILES + 1)]
    if len(names) > MAX_LISTED_FILES:
        return spark.read.parquet(root).where(within)
    schema = spark.read.parquet(root).schema if not names else spark.read.parquet(f"{root}/{names[0]}").schema
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{n}" for n in names]).where(within)
