"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import ascii_lower, drop_documents, fresh, id_text, join_groups, spool

#: Characters of the normalised text that the prefix hash covers.
PREFIX_CHARS = 128
#: Bits of the filter for each surviving group: one row in 16 of the others passes it.
FILTER_BITS = 16
#: The filter is broadcast in rows of BLOCK bits, at most this many (some 150 MB). Beyond
#: 64 million surviving groups it lets more of the other rows through, and never fewer of theirs.
MAX_FILTER_ROWS = 1 << 21
WORDS, WORD = 8, 64
BLOCK = WORDS * WORD


def _filter(groups: DataFrame) -> tuple[DataFrame, int]:
    """The stored filter ``block, words`` of ``groups (n, prefix)``, as large as their number asks for, and its bits."""
    bits = BLOCK
    while bits < FILTER_BITS * groups.count() and bits < MAX_FILTER_ROWS * BLOCK:
        bits *= 2
    place = _place(bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (place % WORD).cast("int"))
    words = [F.coalesce(F.bit_or(F.when(F.floor(place % BLOCK / WORD) == k, one)), F.lit(0).cast("long")) for k in range(WORDS)]
    found = groups.groupBy(F.floor(place / BLOCK).alias("block")).agg(F.array(*words).alias("words"))
    return spool(found, "dedup-filter"), bits


def _place(bits: int):
    return F.pmod(F.xxhash64("n", "prefix"), F.lit(bits))


def _passes(bits: int):
    """Whether a row with its block's ``words`` may belong to a surviving group."""
    place = _place(bits)
    word = F.element_at("words", (F.floor(place % BLOCK / WORD) + 1).cast("int"))
    return F.coalesce(F.call_function("shiftrightunsigned", word, (place % WORD).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    The row with the largest doc_id of a group stays (``keep_id``).

    Refinement: (1) rows are counted by byte length; (2) rows whose length occurs
    twice are counted by (length, hash of the first characters); (3) only rows that
    may be in a surviving group have their whole text hashed with SHA-256, and
    groups form on (length, SHA-256). Step 3 tests rows against a bit filter of the
    surviving groups, broadcast, whose size follows their number (FILTER_BITS, up to
    MAX_FILTER_ROWS); a row that the filter lets through wrongly only costs a hash.
    Texts are never shuffled.
    ``text_sha256`` is null for rows proven unique without a full read, unless
    ``hash_all`` asks for the digest of every text.

    A group of copies of any size is counted with map-side partial sums, and
    members meet their group by :func:`join_groups`, so no task gets a whole group.

    Defined cases: empty and null texts form one group; rows that repeat both doc_id
    and text are one document and share its verdict; a null doc_id is the smallest
    id; an empty table gives an empty result; other columns are ignored.
    """
    text = ascii_lower(F.col("text"))
    narrow = id_text(docs, id_col, text_col).select(
        "doc_id", "text", F.octet_length("text").alias("n"),
        F.xxhash64(ascii_lower(F.left("text", F.lit(PREFIX_CHARS)))).alias("prefix"))
    sketch = spool(narrow.select("doc_id", "n", "prefix"), "dedup-sketch")

    lengths = spool(sketch.groupBy("n").agg(F.count(F.lit(1)).alias("rows_n")).where("rows_n > 1"), "dedup-lengths")
    prefixes = (join_groups(sketch, lengths, "n", "rows_n").groupBy("n", "prefix")
                .agg(F.count(F.lit(1)).alias("rows_p")).where("rows_p > 1"))
    survivors, bits = _filter(spool(prefixes.select("n", "prefix"), "dedup-prefixes"))

    full = F.sha2(text, 256)
    if not hash_all:
        full = F.when(F.col("passed"), full)
    rows = spool(narrow.withColumn("block", F.floor(_place(bits) / BLOCK)).join(F.broadcast(survivors), "block", "left")
                 .withColumn("passed", _passes(bits)).select("doc_id", "n", full.alias("text_sha256"), "passed"), "dedup-rows")

    # (length, digest) of a surviving row as one key; rows proven unique stand alone.
    keyed = rows.where("passed").withColumn("key", F.concat_ws(":", F.col("n").cast("string"), "text_sha256"))
    groups = spool(keyed.groupBy("key").agg(F.max("doc_id").alias("keep_id"),
                                            F.count(F.lit(1)).alias("group_size")), "dedup-groups")
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    grouped = join_groups(keyed, groups, "key", "group_size").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    alone = rows.where(~F.col("passed")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    return grouped.select(*out).unionByName(alone)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text, as judged by :func:`exact_dedup`.

    Rows are taken out by id where the id is that of one row. Where an id repeats or
    is missing it doesn't tell which row is meant, so these rows, usually few, go by
    id and digest: first one row of each (combined map-side, so a row may repeat any
    number of times), then those whose text stays elsewhere are taken out.

    Defined cases: a row that repeats stays once; of rows that share an id and not a
    text each is judged on its own; a row without an id stays if no row with an id has
    its text; an empty table gives an empty result; other columns pass through.
    """
    verdicts = spool(exact_dedup(docs, id_col, text_col), "dedup-verdicts")
    unsure = spool(verdicts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
                   .where("rows > 1 or doc_id is null").select(F.col("doc_id").alias(id_col)), "dedup-unsure")
    named = docs.where(F.col(id_col).isNotNull())
    single = named.join(unsure, id_col, "left_anti").select(*docs.columns)
    kept = drop_documents(single, verdicts.where(~F.col("kept")), "dedup-dropped", id_col)

    digest = fresh(docs, "text_sha256")
    text = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = named.join(unsure, id_col, "left_semi").unionByName(docs.where(F.col(id_col).isNull()))
    rows = rows.withColumn(digest, F.sha2(text, 256)).dropDuplicates([id_col, digest])
    gone = verdicts.where(~F.col("kept")).select(
        F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_sha256")).distinct()
    rest = rows.join(gone, F.col(id_col).eqNullSafe(F.col("gone_id")) & (F.col(digest) == F.col("gone_sha256")), "left_anti")
    return kept.unionByName(rest.select(*docs.columns))
