import pytest

from asterism.operators.quality import (
    add_slug_key,
    audit_rows,
    check_all_lengths,
    check_foreign_key,
    check_lengths,
    check_unique,
    conflicting_keys,
    conform_dimension,
    full_duplicate_keys,
    key_surplus,
    with_typed_null,
)
from tests.conftest import plan, rows


@pytest.fixture()
def dim(spark):
    data = [
        ("k1", "a", 1.0),                      # one clean row
        ("k2", "b", 2.0), ("k2", "b", 2.0),    # identical twice → kept once
        ("k3", "c", 3.0), ("k3", "d", 3.0),    # two different rows → quarantined
        ("k4", "e", 4.0), ("k4", "e", 4.0), ("k4", "f", 4.0),  # repeated and conflicting
        (None, "g", 5.0), (None, "h", 5.0),    # NULL key, two different rows
        ("k5", None, None), ("k5", None, None),  # repeats with NULL values
    ]
    return spark.createDataFrame(data, "k string, name string, v double")


def test_conform_clean_and_quarantine(dim):
    c = conform_dimension(dim, ["k"])
    assert c.clean.columns == ["k", "name", "v"]
    assert rows(c.clean) == [(None, "g", 5.0), (None, "h", 5.0), ("k1", "a", 1.0), ("k2", "b", 2.0),
                             ("k5", None, None)]
    assert rows(c.quarantine) == [("k3", "c", 3.0), ("k3", "d", 3.0), ("k4", "e", 4.0), ("k4", "f", 4.0)]
    assert rows(c.full_dupe_keys) == [("k2",), ("k4",), ("k5",)]


@pytest.mark.parametrize("stored", [False, True])
def test_conform_on_a_digest_of_the_key_is_the_same(dim, tmp_dir, stored):
    a = conform_dimension(dim, ["k"])
    b = conform_dimension(dim, ["k"], copies_path=f"{tmp_dir}/copies" if stored else None, digest_key=True)
    for name in ("clean", "quarantine", "full_dupe_keys", "audit"):
        x, y = getattr(a, name), getattr(b, name)
        assert x.columns == y.columns and rows(x) == rows(y)
    with pytest.raises(ValueError):
        conform_dimension(dim, ["k", "name"], digest_key=True)


def test_conform_audit_counts_keys(dim):
    a = conform_dimension(dim, ["k"]).audit.first().asDict()
    # conflicting key groups: k3, k4 and the NULL group (counted, never quarantined)
    assert a == {"n_rows": 12, "full_dupe_groups": 3, "conflicting_keys": 3, "top_key_rows": 3}


def test_conform_properties(dim):
    c = conform_dimension(dim, ["k"])
    distinct = rows(dim.distinct())
    assert sorted(rows(c.clean) + rows(c.quarantine), key=str) == sorted(distinct, key=str)
    assert not set(r[0] for r in rows(c.clean) if r[0]) & set(r[0] for r in rows(c.quarantine))


def test_conform_two_keys_with_null_values(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (1.0, 2.0, "b"), (1.0, None, "c"), (1.0, None, "d")],
                               "lat double, lon double, city string")
    c = conform_dimension(df, ["lat", "lon"])
    assert rows(c.quarantine) == [(1.0, 2.0, "a"), (1.0, 2.0, "b")]
    assert rows(c.clean) == [(1.0, None, "c"), (1.0, None, "d")]


def test_conform_no_duplicates_passes_through(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    c = conform_dimension(df, ["k"])
    assert rows(c.clean) == [("a", 1), ("b", 2)] and c.quarantine.count() == 0
    assert c.full_dupe_keys.count() == 0  # an empty table, not a missing one


def test_conform_uses_hash_aggregates(dim):
    text = plan(conform_dimension(dim, ["k"]).clean)
    assert "SortAggregate" not in text and "SinglePartition" not in text


def test_audit_rows_messages(spark, dim):
    log = audit_rows(conform_dimension(dim, ["k"]).audit, "stage", "agencies")
    assert log.columns == ["schema_name", "table_name", "message", "dt"]
    msgs = [r.message for r in log.collect()]
    assert len(msgs) == 2 and msgs[0].startswith("Duplicate records found for 3 keys of agencies")
    assert msgs[1].startswith("3 keys of agencies have inconsistent records")
    clean = spark.createDataFrame([("a", 1)], "k string, v int")
    none = audit_rows(conform_dimension(clean, ["k"]).audit, "stage", "stations").collect()
    assert [r.message for r in none] == ["No duplicate or inconsistent records found in stations."]


def test_a1_a2_a3(dim):
    assert key_surplus(dim, "k").first().surplus == 10 - 5  # COUNT(k) skips NULLs
    assert rows(full_duplicate_keys(dim, ["k"])) == [("k2",), ("k4",), ("k5",)]
    assert rows(conflicting_keys(dim, ["k"])) == [(None,), ("k3",), ("k4",)]


def test_check_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "id int, v string")
    assert rows(check_unique(df, ["id"])) == [(None, 1), (1, 2)]


def test_check_foreign_key_null_passes(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "fk int")
    dim = spark.createDataFrame([(1,), (3,)], "id int")
    assert rows(check_foreign_key(fact, dim, ["fk"], ["id"])) == [(2, 2)]


def test_check_lengths(spark):
    df = spark.createDataFrame([(1, "abc", "x"), (2, "abcdef", "xyz")], "id int, s string, t string")
    assert rows(check_lengths(df, "s", 3, ["id"])) == [(2, "abcdef", 6)]
    assert rows(check_all_lengths(df, {"s": 3, "t": 2}, ["id"])) == [(2, "s", 6), (2, "t", 3)]


def test_slug_key_first(spark):
    df = spark.createDataFrame([("San Francisco", "US")], "stn_city string, stn_country string")
    out = add_slug_key(df, "stn_city", "stn_name")
    assert out.columns == ["stn_name", "stn_city", "stn_country"]
    assert rows(out) == [("San_Francisco", "San Francisco", "US")]


def test_typed_null(spark):
    out = with_typed_null(spark.createDataFrame([(1,)], "a int"), "incident_time", "string")
    assert out.schema["incident_time"].dataType.simpleString() == "string" and rows(out) == [(1, None)]


def test_conform_hot_key(spark):
    # one key holds a third of all rows (identical copies plus one conflicting version)
    from pyspark.sql import functions as F

    base = spark.range(0, 3000, 1, 6)
    df = base.select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                     F.when(F.col("id") == 3, F.lit("other")).otherwise(F.lit("same")).alias("v"))
    c = conform_dimension(df, ["k"])
    assert rows(c.quarantine) == [("hot", "other"), ("hot", "same")]
    assert c.clean.count() == 2000 and c.clean.where("k = 'hot'").count() == 0
    a = c.audit.first()
    assert (a.n_rows, a.conflicting_keys, a.top_key_rows) == (3000, 1, 1000)
    text = plan(c.clean)
    assert "SinglePartition" not in text and "Exchange hashpartitioning(k" in text


def test_foreign_key_plan(spark):
    from pyspark.sql import functions as F

    fact = spark.range(0, 1000).select((F.col("id") % 10).alias("fk"))
    dim = spark.range(0, 5).withColumnRenamed("id", "pk")
    out = check_foreign_key(fact, dim, ["fk"], ["pk"])
    assert rows(out) == [(i, 100) for i in range(5, 10)]
    text = plan(out)
    # small parent keys are broadcast: the anti join filters fact rows map-side,
    # before the partial count, and the fact is shuffled only as partial counts
    assert "BroadcastHashJoin" in text and "LeftAnti" in text and "partial_count" in text
    assert "SortMergeJoin" not in text


def test_conform_with_stored_copies(spark, dim, tmp_dir):
    c = conform_dimension(dim, ["k"], copies_path=f"{tmp_dir}/copies")
    assert rows(c.clean) == rows(conform_dimension(dim, ["k"]).clean)
    assert c.audit.first().asDict()["n_rows"] == 12
    assert "FileScan parquet" in plan(c.quarantine)


def test_key_surplus_shuffles_digests_of_texts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("A",), (None,), (None,), ("é" * 1000,), ("é" * 1000,)], "t string")
    out = key_surplus(df, "t")
    assert rows(out) == [(2,)] and "sha2" in plan(out)
    assert rows(key_surplus(spark.createDataFrame([(1,), (1,), (None,)], "k int"), "k")) == [(1,)]
