import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from asterism.operators.events import clean_events, dedup_audit, dedup_with_count, with_surrogate_id
from tests.conftest import plan, rows


def test_dedup_with_count(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "b")], "x int, y string")
    d = dedup_with_count(df, ["x", "y"])
    assert rows(d) == [(1, "a", 2), (2, "b", 0)]
    assert dedup_audit(d).first().dupe_count == 1


def test_surrogate_ids_match_row_number(spark):
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5003).alias("a"), (F.col("id") % 3).alias("b"))
    got = with_surrogate_id(df, "id", ["a", "b"], num_partitions=5)
    expected = df.select(F.row_number().over(Window.orderBy("a", "b")).cast("long").alias("id"), "a", "b")
    assert rows(got) == rows(expected)
    assert got.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first() == (1, 5000, 5000)


def test_surrogate_ids_nulls_first_and_no_single_partition(spark):
    df = spark.createDataFrame([(3,), (None,), (1,), (2,)], "a int")
    got = with_surrogate_id(df, "id", ["a"], num_partitions=3)
    assert rows(got) == [(1, None), (2, 1), (3, 2), (4, 3)]
    # Only the per-partition count table (one row per partition) is gathered in
    # one task, to sum the offsets; the data rows never are.
    lines = plan(got).splitlines()
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert single and all("HashAggregate(keys=[_pid" in lines[i + 1] for i in single)


def test_surrogate_id_last(spark):
    df = spark.createDataFrame([("b",), ("a",)], "n string")
    assert with_surrogate_id(df, "num", ["n"], first=False).columns == ["n", "num"]


def test_clean_events(spark):
    t1 = dt.datetime(2021, 5, 1, 13, 30)
    df = spark.createDataFrame(
        [(100, "ORI1", t1, "A;B"), (101, "ORI1", t1, "A;B"), (102, "ORI2", t1, "C")],
        "incident_id_orig long, ori string, incident_date timestamp_ntz, offenses string")
    clean, audit = clean_events(df, ["ori", "incident_date", "offenses"], date_col="incident_date")
    assert clean.columns == ["id", "ori", "incident_date", "incident_time", "offenses"]
    assert rows(clean) == [(1, "ORI1", dt.date(2021, 5, 1), None, "A;B"), (2, "ORI2", dt.date(2021, 5, 1), None, "C")]
    assert audit.first().dupe_count == 1
    with_time, _ = clean_events(df, ["ori", "incident_date", "offenses"], date_col="incident_date",
                                time_source="incident_date", keep_count=True)
    assert rows(with_time, "incident_time", "group_dupe_cnt") == [("13:30:00", 0), ("13:30:00", 1)]


def test_surrogate_ids_empty_input(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert with_surrogate_id(empty, "id", ["a", "b"]).collect() == []


def test_surrogate_ids_hot_leading_value(spark):
    # a third of the rows share the leading order value; the layout splits them
    # by the following order column, and ids stay 1…n in order
    n = 3000
    df = spark.range(0, n, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("a"),
                                        F.col("id").alias("b"))
    got = with_surrogate_id(df, "id", ["a", "b"], num_partitions=6)
    expected = df.select(F.row_number().over(Window.orderBy("a", "b")).cast("long").alias("id"), "a", "b")
    assert rows(got) == rows(expected)
    per_part = got.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_part) < n / 2


def test_surrogate_ids_hot_ties_spread(spark):
    # order by a column whose one value holds a third of the rows: ties are
    # split over partitions by the row hash and numbered reproducibly
    n = 3000
    df = spark.range(0, n, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("a"),
                                        F.col("id").alias("b"))
    got = with_surrogate_id(df, "id", ["a"], num_partitions=6)
    assert got.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first() == (1, n, n)
    assert max(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()) < n / 2
    again = with_surrogate_id(df, "id", ["a"], num_partitions=3)
    assert rows(got) == rows(again)
    # rows with a = 0 come first, in one block
    assert rows(got.where("a = 0"), "id")[-1] == (1000,)
