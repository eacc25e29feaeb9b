"""Fact assembly: the measure fact (F1) and the event fact (F2).

The planner broadcasts dimensions by their size in bytes. Only the hours, 24 rows by
construction, carry a hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.functions.columns import quoted
from asterism.operators.reshape import count_list_names

def build_measure_fact(measures: DataFrame, dates: DataFrame, hours: DataFrame,
                       datetime_col: str = "datetime") -> DataFrame:
    """``date_id, hour_id, measures.*``: **inner** joins on the date and the hour of ``datetime``.

    Rows whose datetime is NULL or outside the dimensions vanish.
    """
    d = dates.select(F.col("id").alias("_date_id"), F.col("date").alias("_date"))
    h = F.broadcast(hours.select(F.col("id").alias("_hour_id")))
    ts = quoted(datetime_col)
    joined = (measures.join(d, F.to_date(ts) == F.col("_date"))
              .join(h, F.hour(ts) == F.col("_hour_id")))
    return joined.select(F.col("_date_id").alias("date_id"), F.col("_hour_id").alias("hour_id"),
                         *[quoted(c) for c in measures.columns])


def _attach_dates_hours(df: DataFrame, dates: DataFrame, hours: DataFrame, date_col: str, time_col: str) -> DataFrame:
    d = dates.select(F.col("id").alias("_date_id"), F.col("date").alias("_date"))
    h = F.broadcast(hours.select(F.col("id").alias("_hour_id"), F.col("hour").alias("_hour")))
    joined = (df.join(d, quoted(date_col) == F.col("_date"), "left")
              .join(h, quoted(time_col) == F.col("_hour"), "left"))
    return joined.select(F.col("_date_id").alias("date_id"), F.col("_hour_id").alias("hour_id"),
                         *[quoted(c) for c in df.columns])


def build_event_fact(events: DataFrame, names: DataFrame, dates: DataFrame, hours: DataFrame,
                     id_cols: Sequence[str], date_col: str, time_col: str) -> DataFrame:
    """``date_id, hour_id, events ⋈ names``: **inner** join to the pivoted names on
    the ids (events without names vanish), **left** joins to the date and to the
    time of day (``time_col`` must equal ``'HH:00:00'`` exactly to match).
    """
    named = events.join(names, list(id_cols), "inner")
    return _attach_dates_hours(named, dates, hours, date_col, time_col)


def build_event_fact_from_lists(events: DataFrame, list_col: str, dates: DataFrame, hours: DataFrame,
                                date_col: str, time_col: str, vocab: Sequence[str] | None = None,
                                delim: str = ";") -> DataFrame:
    """F2 when the names are the event's own delimited list and events have unique ids.

    Same rows and columns as ``build_event_fact(events, pivot_counts(split_to_rows(…)))``,
    computed row by row: no explode, no group-by and no join back, so the
    whole fact needs no shuffle beyond the broadcast dimensions.
    """
    named = count_list_names(events, list_col, vocab, delim)
    return _attach_dates_hours(named, dates, hours, date_col, time_col)


def dated_events(events: DataFrame, list_col: str, dates: DataFrame, hours: DataFrame,
                 date_col: str, time_col: str) -> DataFrame:
    """The event fact of :func:`build_event_fact_from_lists` but for its names: ``date_id, hour_id, events``.

    ``count_list_names`` adds them row by row, so a fact that is laid out for writing is
    moved without them and counted where it lies (``finish`` of :func:`~asterism.sources.sinks.write_fact`).
    """
    return _attach_dates_hours(events.where(quoted(list_col).isNotNull()), dates, hours, date_col, time_col)
