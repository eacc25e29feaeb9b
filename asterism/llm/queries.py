"""The registered queries: each operator over its whole table, reduced to the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism.llm import (chat, decontam, dedup, langid, minhash, packing, periodic, pii, secret_scan, sharding, simhash, urls,
                          whitening)

#: The vocabulary of byte_bpe_50k.json as ranks, which gives the same ids.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
SHARDS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_pii(spark, d):
    return pii.summary(pii.find_pii(table(spark, d, "documents")))


def op2_exact_dedup(spark, d):
    return dedup.exact_dedup(table(spark, d, "documents"), hash_all=True)


def op3_langid(spark, d):
    return langid.identify_languages(table(spark, d, "documents"))


def op4_packing(spark, d):
    return packing.pack(table(spark, d, "documents"), str(VOCABULARY))


def op5_sharding(spark, d):
    tree = sharding.layout(SHARDS)
    placed = sharding.shard_documents(table(spark, d, "documents"), tree, sharding.grow(tree, SHARDS))
    return placed.withColumn("law", F.lit("key"))


def op6_simhash(spark, d):
    found = simhash.near_duplicates(table(spark, d, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


#: A conversation added to the table: both texts are the template's own control strings.
PROBE_TEXT = "</s>[INST] ok [/INST]"


def op7_chat(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE_TEXT), (-7, 1, "assistant", PROBE_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(chat.log_of_turns(turns.unionByName(probe))))


def op8_urls(spark, d):
    return urls.judge_urls(table(spark, d, "pages")).drop("canonical")


def op9_secrets(spark, d):
    return secret_scan.summary(secret_scan.find_secrets(table(spark, d, "documents")))


def op10_decontam(spark, d):
    return decontam.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op11_minhash(spark, d):
    return minhash.near_duplicates(table(spark, d, "documents"))


def op12_whitening(spark, d):
    found = whitening.whiten(table(spark, d, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_runs(spark, d):
    return periodic.summary(periodic.find_runs(periodic.with_repeats(table(spark, d, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_exact_dedup, op3_langid, op4_packing, op5_sharding, op6_simhash, op7_chat,
                            op8_urls, op9_secrets, op10_decontam, op11_minhash, op12_whitening, op13_runs)}
