"""Uniqueness of sorted tables, the index of files, and bucketed joins."""

import random

import pytest
from pyspark.sql import functions as F

from asterism.operators import keys
from asterism.operators.keys import NotSortedError, check_dense_foreign_key, check_unique_sorted, key_map
from asterism.operators.quality import check_foreign_key, check_unique
from asterism.plans import bindings
from asterism.sources.sinks import files_of_range, read_range, write_fact
from tests.conftest import SF_SMALL, plan, rows


@pytest.mark.parametrize(("n", "values"), [(0, 1), (1, 2), (700, 2), (700, 300)])
def test_sorted_check_equals_the_grouped_one(spark, tmp_dir, n, values):
    r = random.Random(n + values)
    data = [(r.choice([None, *range(values)]), r.choice(["a", "b", None, "é"]), k) for k in range(n)]
    df = spark.createDataFrame(data, "a int, b string, v int").repartition(3)
    write_fact(df, f"{tmp_dir}/t", "a", ["a", "b"], num_partitions=5)
    stored = spark.read.parquet(f"{tmp_dir}/t")
    for key in (["a", "b"], ["a"]):
        assert rows(check_unique_sorted(stored, key)) == rows(check_unique(df, key))


def test_sorted_check_of_a_key_in_many_files_and_batches(spark, tmp_dir):
    df = spark.range(0, 30_000, 1, 4).selectExpr("IF(id < 10000, -1, IF(id % 3 = 0, id - 1, id)) AS k", "id AS v")
    write_fact(df, f"{tmp_dir}/t", "k", ["k"], num_partitions=8)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = check_unique_sorted(spark.read.parquet(f"{tmp_dir}/t"), ["k"])
        assert rows(got) == rows(check_unique(df, ["k"])) and rows(got)[0] == (-1, 10_000)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_sorted_check_refuses_other_layouts(spark, tmp_dir):
    spark.range(100).selectExpr("(id * 37) % 100 AS k").coalesce(1).write.parquet(f"{tmp_dir}/unsorted")
    with pytest.raises(NotSortedError, match="sorted"):
        check_unique_sorted(spark.read.parquet(f"{tmp_dir}/unsorted"), ["k"])
    spark.range(100).selectExpr("id % 50 AS k").repartition(4).sortWithinPartitions("k").write.parquet(f"{tmp_dir}/overlap")
    with pytest.raises(NotSortedError, match="overlap"):
        check_unique_sorted(spark.read.parquet(f"{tmp_dir}/overlap"), ["k"])


def test_sorted_check_shuffles_no_rows(spark, tmp_dir, monkeypatch):
    df = spark.range(0, 20_000, 1, 4).selectExpr("id AS k")
    write_fact(df, f"{tmp_dir}/t", "k", ["k"], num_partitions=6)
    monkeypatch.setattr(keys, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}")
    got = check_unique_sorted(spark.read.parquet(f"{tmp_dir}/t"), ["k"])
    assert "MapInArrow" not in plan(got)  # what is grouped has been stored
    assert spark.read.parquet(f"{tmp_dir}/key-runs").count() <= 2 * 6  # the ends of the files' blocks, no rows between


def test_a_range_reads_the_files_that_the_index_names(spark, tmp_dir):
    fact = spark.range(0, 4000, 1, 4).selectExpr("concat('s', id % 9) AS stn", "CAST(id % 200 AS INT) AS date_id", "id AS v",
                                                 "IF(id % 50 = 0, NULL, id % 24) AS hour_id")
    target = f"{tmp_dir}/f"
    write_fact(fact, target, "stn", ["stn", "date_id"], num_partitions=12, index=True)
    assert rows(spark.read.parquet(target)) == rows(fact)  # the index isn't part of the table
    some = read_range(spark, target, {"stn": ("s2", "s3"), "date_id": (10, 20)})
    assert rows(some) == rows(fact.where("stn BETWEEN 's2' AND 's3' AND date_id BETWEEN 10 AND 20"))
    named = files_of_range(spark, target, {"stn": ("s2", "s3"), "date_id": (10, 20)})
    total = spark.read.parquet(target).select(F.col("_metadata.file_name")).distinct().count()
    assert sorted(f.rsplit("/", 1)[1] for f in some.inputFiles()) == sorted(r[0] for r in named.collect())
    assert 0 < named.count() < total / 2
    assert named.agg(F.sum("n")).first()[0] < fact.count() / 2  # rows read
    assert rows(read_range(spark, target, {"stn": ("x", None)})) == [] and read_range(spark, target, {"stn": ("x", None)}).columns == fact.columns
    assert read_range(spark, target, {"date_id": (None, 5)}).count() == fact.where("date_id <= 5").count()


def test_bucketed_tables_join_without_a_shuffle(spark):
    text = plan(bindings.bucketed_join(spark, SF_SMALL))
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_dense_foreign_key_equals_the_grouped_check(spark):
    r = random.Random(4)
    edge = [0, 1, 63, 64, 511, 512, 513, -1, -64, -512, -513, 2 ** 31 - 1, -2 ** 31]
    fact = spark.createDataFrame([(r.choice([None, *edge, r.randrange(2000)]),) for _ in range(3000)], "k int")
    dim = spark.createDataFrame([(k,) for k in [None, *edge[::2], *range(0, 2000, 3), 2 ** 40, -2 ** 63, 2 ** 63 - 1]], "id long")
    got = check_dense_foreign_key(fact, dim, "k", "id")
    assert rows(got) == rows(check_foreign_key(fact, dim, ["k"], ["id"])) and got.schema["k"].dataType.simpleString() == "int"
    assert rows(check_dense_foreign_key(fact, fact, "k")) == []
    assert rows(check_dense_foreign_key(fact, dim.where("false"), "k", "id")) == rows(fact.where("k IS NOT NULL").groupBy("k").count())
    with pytest.raises(ValueError, match="whole number"):
        check_dense_foreign_key(spark.sql("SELECT 'a' AS k"), dim, "k", "id")


def test_dense_foreign_key_shuffles_maps_and_not_the_fact(spark, tmp_dir):
    spark.range(0, 200_000, 1, 4).selectExpr("id DIV 4 AS k").write.parquet(f"{tmp_dir}/fact")
    spark.range(0, 49_000).write.parquet(f"{tmp_dir}/dim")
    fact, dim = spark.read.parquet(f"{tmp_dir}/fact"), spark.read.parquet(f"{tmp_dir}/dim")
    assert key_map(fact, "k").count() == 98  # 50,000 values, 512 to a row
    got = check_dense_foreign_key(fact, dim, "k", "id")
    text = plan(got)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert got.count() == 1000 and got.agg(F.sum("n")).first()[0] == 4000
