"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: At most this many keys are ever called hot, whatever the size of the input.
MAX_HOT_KEYS = 20_000


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` only, null text as empty; all other columns are ignored, whatever their names."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, LOWER)


def spool(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage, so a lost executor costs a reread and not a rerun, and gives
    the planner the true size of the table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def small_batches(spark, rows: int = 1000) -> None:
    """Bound the rows of one Arrow batch, as one row may be a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where body uses it within lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size_col: str) -> DataFrame:
    """Inner join of ``rows`` with one row per group, none of whose keys can swamp a task.

    ``groups`` must be a stored table with ``size_col``, the number of rows of each
    key. Keys with more than ``max(200, total / MAX_HOT_KEYS)`` rows are hot: there
    are at most MAX_HOT_KEYS of them, so their side is broadcast; the other rows
    meet by shuffle, where a key has no more rows than that bound.
    """
    total = groups.agg(F.sum(size_col)).first()[0] or 0
    bound = max(200, total // MAX_HOT_KEYS)
    hot = F.col(size_col) > bound
    hot_keys = F.broadcast(groups.where(hot).select(key))
    return (rows.join(F.broadcast(groups.where(hot)), key)
            .unionByName(rows.join(hot_keys, key, "left_anti").join(groups.where(~hot), key)))


def drop_documents(docs: DataFrame, dropped: DataFrame, name: str, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the ids in ``dropped``; rows without an id stay.

    The ids are stored first, so that the planner knows their size and broadcasts
    them only below its limit.
    """
    ids = spool(dropped.select(F.col("doc_id").alias(id_col)).where(F.col(id_col).isNotNull()).distinct(), name)
    return docs.join(ids, id_col, "left_anti").select(*docs.columns)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called that (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
