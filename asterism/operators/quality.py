"""Data quality and audit: conform a dimension (L1), audit rows (L2), key checks
(V1, V2, V4) and the small column helpers used while cleaning (P2, P4)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from asterism.functions.columns import all_not_null, any_null, quoted


@dataclass(frozen=True)
class Conformed:
    """Result of :func:`conform_dimension`.

    ``clean``: one row per non-NULL key (keys whose rows disagree are removed
    entirely), plus the distinct rows with a NULL key.
    ``quarantine``: the distinct rows of those conflicting keys.
    ``full_dupe_keys``: the key of each row that appeared more than once.
    ``audit``: one row ``n_rows, full_dupe_groups, conflicting_keys, top_key_rows``.
    """

    clean: DataFrame
    quarantine: DataFrame
    full_dupe_keys: DataFrame
    audit: DataFrame


def _copies(df: DataFrame) -> DataFrame:
    """Each distinct row with its multiplicity.

    Like :func:`_versions_of` a hash aggregate with count buffers, combined map-side: a
    key that holds a third of all rows is reduced inside each task before the shuffle.
    """
    return df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))


def _versions_of(copies: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key, the number of distinct rows, the row count and the number of repeated rows."""
    return copies.groupBy(*[quoted(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("_versions"),
        F.sum("_copies").alias("_rows"),
        F.count_if(F.col("_copies") > 1).alias("_dupes"))


def conform_dimension(df: DataFrame, keys: Sequence[str], copies_path: str | None = None,
                      copies_mode: str = "errorifexists", digest_key: bool = False) -> Conformed:
    """Drop repeats of identical rows, remove and quarantine keys whose rows differ.

    NULL keys never equal anything (as with EXISTS): rows with a NULL key stay in
    ``clean`` (deduplicated) and are never quarantined; :func:`check_unique`
    reports them. The conflict counter counts key groups, the NULL group included.
    With ``copies_path`` (a folder on shared storage) the distinct rows are
    written once, so using several outputs does not re-read the raw input.
    ``digest_key`` is for one key of long texts: versions are counted and joined on
    its SHA-256, so that the texts themselves are shuffled once, for the distinct rows.

    Plan: distinct rows (hash aggregate) → versions per key (hash aggregate) →
    semi/anti join of the distinct rows with the conflicting keys. The planner
    broadcasts the conflicting keys when their measured size allows (AQE), else
    it sort-merge joins with skewed partitions split.
    """
    keys = list(keys)
    if digest_key and len(keys) != 1:
        raise ValueError("digest_key takes one key")
    cols = df.columns
    copies = _copies(df)
    if digest_key:
        copies = copies.withColumn("_key", F.sha2(quoted(keys[0]).cast("string"), 256))
    if copies_path is not None:
        # Store the distinct rows once; every output then reads them instead of
        # re-reading and re-aggregating the raw input.
        copies.write.mode(copies_mode).parquet(copies_path)
        copies = df.sparkSession.read.parquet(copies_path)
    by = ["_key"] if digest_key else keys
    versions = _versions_of(copies, by)
    conflicting = versions.where(all_not_null(by) & (F.col("_versions") > 1)).select(*[quoted(k) for k in by])
    distinct_rows = copies.select(*[quoted(c) for c in dict.fromkeys([*cols, *by])])
    clean = distinct_rows.join(conflicting, by, "left_anti").select(*[quoted(c) for c in cols])
    quarantine = distinct_rows.join(conflicting, by, "left_semi").select(*[quoted(c) for c in cols])
    full_dupe_keys = copies.where(F.col("_copies") > 1).select(*[quoted(k) for k in keys])
    audit = versions.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum("_dupes"), F.lit(0)).cast("long").alias("full_dupe_groups"),
        F.count_if(F.col("_versions") > 1).alias("conflicting_keys"),
        F.coalesce(F.max("_rows"), F.lit(0)).cast("long").alias("top_key_rows"))
    return Conformed(clean, quarantine, full_dupe_keys, audit)


def key_surplus(df: DataFrame, key: str) -> DataFrame:
    """``COUNT(key) − COUNT(DISTINCT key)``: how many key values are surplus (A1).

    Texts are told apart by their SHA-256, 32 bytes each, so that long texts aren't shuffled.
    """
    value = quoted(key)
    if isinstance(df.schema[key].dataType, (StringType, BinaryType)):
        value = F.unhex(F.sha2(value, 256))
    return df.agg((F.count(quoted(key)) - F.count_distinct(value)).alias("surplus"))


def full_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key of each whole row that occurs more than once (A2)."""
    return (df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1).select(*[quoted(k) for k in keys]))


def conflicting_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys carrying more than one distinct row (A3), the NULL-key group included."""
    return _versions_of(_copies(df), keys).where(F.col("_versions") > 1).select(*[quoted(k) for k in keys])


# Fixed texts of the audit log messages.
MSG_DUPLICATES = "Duplicate records found for {n} keys of {table}; see its full-duplicate key table."
MSG_CONFLICTS = "{n} keys of {table} have inconsistent records; they were moved to its quarantine table."
MSG_EVENT_DUPES = "Duplicate records found in {n} groups of {table}; repeats were removed."
MSG_NONE = "No duplicate or inconsistent records found in {table}."


def _message(template: str, table: str, count_col: str | None):
    before, _, after = template.partition("{n}")
    parts = [F.lit(before.replace("{table}", table))]
    if count_col is not None:
        parts += [F.col(count_col).cast("string"), F.lit(after.replace("{table}", table))]
    return F.concat(*parts)


def audit_rows(audit: DataFrame, schema_name: str, table_name: str) -> DataFrame:
    """Log rows ``(schema_name, table_name, message, dt)`` from a one-row counter frame (L2).

    Understands the counters of :func:`conform_dimension` (``full_dupe_groups``,
    ``conflicting_keys``) and of :func:`~asterism.operators.events.dedup_audit`
    (``dupe_count``); emits one row per finding, or one "none found" row.
    """
    cases = []
    if "full_dupe_groups" in audit.columns:
        cases.append((F.col("full_dupe_groups") > 0, _message(MSG_DUPLICATES, table_name, "full_dupe_groups")))
    if "conflicting_keys" in audit.columns:
        cases.append((F.col("conflicting_keys") > 0, _message(MSG_CONFLICTS, table_name, "conflicting_keys")))
    if "dupe_count" in audit.columns:
        cases.append((F.col("dupe_count") > 0, _message(MSG_EVENT_DUPES, table_name, "dupe_count")))
    if not cases:
        raise ValueError("audit frame has no known counter column")
    nothing = ~reduce(lambda a, b: a | b, [c for c, _ in cases])
    messages = F.array(*[F.when(c, m) for c, m in cases], F.when(nothing, _message(MSG_NONE, table_name, None)))
    return (audit.select(F.explode(messages).alias("message"))
            .where(F.col("message").isNotNull())
            .select(F.lit(schema_name).alias("schema_name"), F.lit(table_name).alias("table_name"),
                    "message", F.localtimestamp().alias("dt")))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary-key check (V1): keys occurring more than once, and NULL keys, with count ``n``."""
    return (df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) | any_null(keys)))


def check_foreign_key(fact: DataFrame, dim: DataFrame, fact_keys: Sequence[str],
                      dim_keys: Sequence[str] | None = None) -> DataFrame:
    """Foreign-key check (V2): fact key values absent from ``dim``, with their row count ``n``.

    A NULL foreign key passes. The count per key is a partial aggregate; Catalyst
    places the anti join before it (the join only reads the key), so with parent
    keys small enough to broadcast the fact is filtered map-side and shuffled
    only as partial counts; large parents are sort-merge joined with AQE.
    """
    fact_keys = list(fact_keys)
    dim_keys = list(dim_keys or fact_keys)
    counts = (fact.where(all_not_null(fact_keys)).groupBy(*[quoted(k) for k in fact_keys])
              .agg(F.count(F.lit(1)).alias("n")))
    parents = dim.select(*[quoted(d).alias(f) for f, d in zip(fact_keys, dim_keys)])
    return counts.join(parents, fact_keys, "left_anti")


def check_lengths(df: DataFrame, col: str, max_len: int, key_cols: Sequence[str] = ()) -> DataFrame:
    """VARCHAR(n) check (V4): rows whose ``col`` is longer than ``max_len`` characters."""
    length = F.length(quoted(col))
    return df.where(length > max_len).select(
        *[quoted(k) for k in key_cols], quoted(col), length.cast("int").alias("len"))


def check_all_lengths(df: DataFrame, limits: dict[str, int], key_cols: Sequence[str] = ()) -> DataFrame:
    """V4 for many columns in one pass: ``(keys…, column, len)`` for every value too long."""
    checks = F.array(*[
        F.when(F.length(quoted(c)) > n, F.struct(F.lit(c).alias("column"),
                                                 F.length(quoted(c)).cast("int").alias("len")))
        for c, n in limits.items()])
    return (df.select(*[quoted(k) for k in key_cols], F.explode(checks).alias("_v"))
            .where(F.col("_v").isNotNull())
            .select(*[quoted(k) for k in key_cols], "_v.column", "_v.len"))


def add_slug_key(df: DataFrame, src: str, dst: str, find: str = " ", repl: str = "_") -> DataFrame:
    """``REPLACE(src, find, repl) AS dst`` put first, then every column."""
    return df.select(F.replace(quoted(src), F.lit(find), F.lit(repl)).alias(dst),
                     *[quoted(c) for c in df.columns])


def with_typed_null(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """Add (or replace) a column that is NULL of the given type."""
    return df.withColumn(name, F.lit(None).cast(dtype))
