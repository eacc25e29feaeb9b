"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import bind, drop_documents, fresh, id_text, spool

SHINGLE_WORDS = 5
CONTAINMENT = 0.8


def words(text: Column) -> Column:
    """Lower-case words: what stands between characters that are neither letters nor digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(text: Column, n: int = SHINGLE_WORDS) -> Column:
    """The distinct ``n``-word shingles; fewer words are one shingle, none give none."""
    def of(w: Column) -> Column:
        return (F.when(F.size(w) == 0, F.array().cast("array<string>"))
                .when(F.size(w) < n, F.array(F.array_join(w, " ")))
                .otherwise(F.array_distinct(F.transform(
                    F.sequence(F.lit(1), F.size(w) - (n - 1)),
                    lambda i: F.concat_ws(" ", *[F.element_at(w, i + k) for k in range(n)])))))

    return bind(words(text), of)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", threshold: float = CONTAINMENT) -> DataFrame:
    """Pairs ``(doc_id, item_id, common, item_shingles, containment)`` with containment of the
    item's shingles in the document of ``threshold`` or more.

    Search: items are partitioned by size (powers of two of their shingle counts).
    The sketch of an item is its k least shingle hashes, k set from the threshold t
    and the partition's largest size u as ``u - ceil(t * u) + 1``: a document with a
    share t of the shingles misses at most k - 1 of them, so it has one of the k. No
    document is lost, whatever its length. Documents' shingle hashes probe the
    sketches; only hits leave a task. The stored sketch table is broadcast by the
    planner if it is below its limit, else the probe is a shuffle join, whose skew
    (a passage in many documents) the planner splits.

    Check: for the pairs found, and only for these documents, the shingles
    themselves are compared.

    Defined cases: null and empty texts, on either side, have no shingles and match
    nothing; texts of fewer than five words are one shingle, so that an item of one to
    four words is found only in a document of just these words and not within longer
    ones (the SQL has the same rule); rows that repeat an id
    and a text give one pair; rows with a null id are left out, as no pair could
    name them; empty tables give an empty result; other columns are ignored.
    """
    items = (benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
             .where("item_id is not null").select("item_id", shingles(F.coalesce("text", F.lit(""))).alias("item"))
             .where(F.size("item") > 0))
    items = spool(items, "decontam-items")
    size = F.size("item")
    part = F.floor(F.log2(size.cast("double"))).cast("int")
    # the largest size in a partition; sizes 2^p to 2^(p+1) - 1 share one
    largest = items.groupBy(part.alias("part")).agg(F.max(size).alias("u"))
    k = (F.col("u") - F.ceil(F.round(F.col("u") * threshold, 6)) + 1).cast("int")
    sketches = spool(
        items.withColumn("part", part).join(F.broadcast(largest), "part")
        .select("item_id", F.explode(F.slice(F.array_sort(F.transform("item", lambda s: F.xxhash64(s))), F.lit(1), k))
                .alias("hash")), "decontam-sketches")

    rows = id_text(docs, id_col, text_col).where("doc_id is not null")
    probes = rows.select("doc_id", F.explode(shingles(F.col("text"))).alias("shingle")).select(
        "doc_id", F.xxhash64("shingle").alias("hash"))
    pairs = spool(probes.join(sketches, "hash").select("doc_id", "item_id").distinct(), "decontam-pairs")

    common = F.size(F.array_intersect("item", shingles(F.col("text"))))
    compared = (rows.join(pairs, "doc_id").join(items, "item_id")
                .select("doc_id", "item_id", common.alias("common"), F.size("item").alias("item_shingles")))
    share = F.col("common") / F.col("item_shingles")
    best = F.max(F.struct(share.alias("containment"), "common", "item_shingles")).alias("best")
    return (compared.groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", F.col("best.common").cast("long").alias("common"),
                    F.col("best.item_shingles").cast("long").alias("item_shingles"), "best.containment")
            .where(F.col("containment") >= threshold))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` less the rows that hold a benchmark item.

    Rows are judged by a 64-bit hash of their id and text and not by the id, so that
    each row is judged on its own where ids repeat or are missing (a clean row is
    lost only if its hash is that of one of the rows that go).

    Defined cases: a row without an id goes if it holds an item; rows that repeat go
    or stay together; an empty table on either side drops nothing; other columns pass
    through, whatever their names.
    """
    row = fresh(docs, "row_id")
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    return drop_documents(keyed, contaminated(keyed, benchmark, row), "decontam-dropped", row).select(*docs.columns)
