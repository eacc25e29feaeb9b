"""Date and hour dimensions.

The date dimension is generated with ``spark.range`` over the number of days, so
rows are made in parallel and the id is plain arithmetic (no window, no
recursive CTE, no single-row explode).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DateLike = dt.date | str | None


def _as_date(value: DateLike) -> dt.date | None:
    if value is None:
        return None
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


def date_bounds(frames: Sequence[tuple[DataFrame, str | Column]],
                start_not_later: DateLike = None,
                end_not_earlier: DateLike = None) -> DataFrame:
    """One row ``(lo DATE, hi DATE)``: the date range covering every ``(frame, column)``.

    User bounds can only widen the range: ``lo = least(data minima, start_not_later)``
    and ``hi = greatest(data maxima, end_not_earlier)``; NULLs are skipped.
    Each frame is scanned once by a partial min/max aggregate.
    """
    if not frames:
        raise ValueError("date_bounds needs at least one (frame, column)")
    parts = []
    for df, col in frames:
        c = F.to_date(F.col(col) if isinstance(col, str) else col)
        parts.append(df.agg(F.min(c).alias("lo"), F.max(c).alias("hi")))
    # Stack the one-row aggregates and reduce them again: min/max skip NULLs.
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    start, end = _as_date(start_not_later), _as_date(end_not_earlier)
    return stacked.agg(
        F.least(F.min("lo"), F.lit(start).cast("date")).alias("lo"),
        F.greatest(F.max("hi"), F.lit(end).cast("date")).alias("hi"),
    )


def dim_dates(spark: SparkSession, start: DateLike, end: DateLike,
              num_partitions: int | None = None) -> DataFrame:
    """``dim_dates(id INT, date DATE)``: every day from ``start`` to ``end``, ids from 1."""
    lo, hi = _as_date(start), _as_date(end)
    if lo is None or hi is None:
        raise ValueError("dim_dates needs both bounds; got NULL (no data and no user bound)")
    if lo > hi:
        raise ValueError(f"dim_dates: start {lo} is after end {hi}")
    n_days = (hi - lo).days + 1
    parts = num_partitions or max(1, min(spark.sparkContext.defaultParallelism, n_days // 4096 + 1))
    return spark.range(0, n_days, 1, parts).select(
        (F.col("id") + 1).cast("int").alias("id"),
        F.date_add(F.lit(lo), F.col("id").cast("int")).alias("date"),
    )


def dim_dates_between(spark: SparkSession, frames: Sequence[tuple[DataFrame, str | Column]],
                      start_not_later: DateLike = None,
                      end_not_earlier: DateLike = None) -> DataFrame:
    """G4 then G2: the date dimension covering the data and the user bounds.

    Two scalars (the bounds) cross to the driver; the rows are generated by Spark.
    """
    row = date_bounds(frames, start_not_later, end_not_earlier).first()
    return dim_dates(spark, row["lo"], row["hi"])


def dim_hours(spark: SparkSession) -> DataFrame:
    """``dim_hours(id INT 0–23, hour STRING 'HH:00:00')``."""
    return spark.range(0, 24, 1, 1).select(
        F.col("id").cast("int").alias("id"),
        F.format_string("%02d:00:00", F.col("id")).alias("hour"),
    )
