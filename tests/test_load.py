"""Loads with bad rows kept aside, manifests, and times that no session zone moves."""

import json
import os

import pytest

from asterism.sources.csv import read_manifest, read_positional_csv
from asterism.sources.load import LoadError, check_manifest, listed_files, load_csv, manifest_paths
from tests.conftest import rows

SCHEMA = "k BIGINT NOT NULL, name VARCHAR(5), paid BOOLEAN, at TIMESTAMP_NTZ, price DECIMAL(5,2)"
LINES = ['k,name,paid,at,price', '1,ann,yes,1/2/2021 3:04,1.005', '2,"two\nlines",no,2021-01-01,2', '3,bob,maybe,13/13/2021,12345.678',
         ',eve,t,2021-01-01,1', '5,x,t,2021-01-01', '6,,,,']


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_bad_rows_are_kept_with_line_column_and_reason(spark, tmp_dir):
    path = write(f"{tmp_dir}/in/a.csv", "\n".join(LINES) + "\n")
    got = load_csv(spark, path, SCHEMA, max_errors=10, lineage=True)
    assert (got.n_rows, got.n_bad) == (2, 4)
    assert [(r.k, r.name, r.paid, str(r.at), str(r.price), r._line) for r in got.rows.orderBy("k").collect()] == [
        (1, "ann", True, "2021-01-02 03:04:00", "1.01", 2), (6, None, None, "None", "None", 8)]
    assert rows(got.errors, "line", "column", "reason", "value") == [
        (3, "name", "longer than 5", "two\nlines"), (5, "at", "not a timestamp_ntz", "13/13/2021"), (5, "paid", "not a boolean", "maybe"),
        (5, "price", "not a decimal(5,2)", "12345.678"), (6, "k", "missing", None), (7, None, "not 5 fields", None)]
    assert {r.record for r in got.errors.where("line = 7").collect()} == {LINES[5]}
    assert all(r.file.endswith("a.csv") for r in got.errors.collect())
    assert [r[1:] for r in rows(got.by_file())] == [(2, 4)]


def test_a_load_fails_above_its_limit_and_keeps_what_it_stored(spark, tmp_dir):
    path = write(f"{tmp_dir}/in/a.csv", "\n".join(LINES) + "\n")
    for limit in (0, 3):
        with pytest.raises(LoadError, match=f"4 of 6 records are bad, {limit} allowed"):
            load_csv(spark, path, SCHEMA, max_errors=limit, stored=f"{tmp_dir}/stored-{limit}")
        assert spark.read.parquet(f"{tmp_dir}/stored-{limit}").where("size(_errors) > 0").count() == 4
    assert load_csv(spark, path, SCHEMA, max_errors=4).n_bad == 4


def test_an_open_quote_is_one_bad_row(spark, tmp_dir):
    path = write(f"{tmp_dir}/in/q.csv", 'k,s\n1,a\n2,"b\n3,c\n')
    got = load_csv(spark, path, "k INT, s STRING", max_errors=1)
    assert rows(got.errors, "line", "reason", "record") == [(3, "a quote is not closed", '2,"b\n3,c')]
    assert rows(got.rows) == [(1, "a")]


def test_empty_load(spark, tmp_dir):
    got = load_csv(spark, write(f"{tmp_dir}/in/e.csv", "k,s\n"), "k INT, s STRING")
    assert (got.n_rows, got.n_bad) == (0, 0) and rows(got.rows) == rows(got.errors) == rows(got.by_file()) == []


def manifest(spark, tmp_dir, pairs):
    return read_manifest(spark, write(f"{tmp_dir}/m.json", json.dumps({"data_files": [{"local": a, "s3": b} for a, b in pairs]})))


def test_manifests_are_checked(spark, tmp_dir):
    write(f"{tmp_dir}/root/a b.csv", "x\n1\n")
    write(f"{tmp_dir}/root/d+e/part-1.csv", "x\n22\n")
    write(f"{tmp_dir}/root/d+e/part-2.csv", "x\n333\n")
    assert rows(listed_files(spark, f"{tmp_dir}/root/")) == [("a b.csv", 4), ("d+e/part-1.csv", 5), ("d+e/part-2.csv", 6)]
    assert rows(listed_files(spark, f"file://{tmp_dir}/root"), "path")[0] == ("a b.csv",)
    good = manifest(spark, tmp_dir, [("a b.csv", "one"), ("d+e", "two")])
    assert rows(check_manifest(spark, good, f"{tmp_dir}/root")) == [("a b.csv", "one", 1, 1, 4), ("d+e", "two", 1, 2, 11)]
    assert manifest_paths(spark, good, f"{tmp_dir}/root", ["two"]) == {"one": f"{tmp_dir}/root/a b.csv", "two": f"{tmp_dir}/root/d+e"}
    for pairs, required, message in (
            ([("a b.csv", "one"), ("d+e", "one")], [], "named twice: one"), ([("a b.csv", "one"), ("a b.csv", "one")], [], "named twice: one"),
            ([("gone.csv", "one")], [], "not found: gone.csv"), ([("a b.csv", "one")], ["one", "three"], "not in the manifest: three")):
        with pytest.raises(ValueError, match=message):
            manifest_paths(spark, manifest(spark, tmp_dir, pairs), f"{tmp_dir}/root", required)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Berlin"])
def test_times_are_read_as_written(spark, tmp_dir, zone):
    """Night hours that a change of clocks leaves out or repeats, in formats with and without a zone of the session."""
    texts = ["3/14/2021 2:30", "2021-03-14 02:30:00", "11/7/2021 1:30:05", "28-Mar-2021 2:15", "2021/10/31 2:59:59", "1/2/0050 0:00"]
    want = ["2021-03-14 02:30:00", "2021-03-14 02:30:00", "2021-11-07 01:30:05", "2021-03-28 02:15:00", "2021-10-31 02:59:59",
            "0050-01-02 00:00:00"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        path = write(f"{tmp_dir}/in/t.csv", "k,t\n" + "".join(f"{k},{t}\n" for k, t in enumerate(texts)))
        for multi_line in (False, True):
            df = read_positional_csv(spark, path, "k INT, t TIMESTAMP_NTZ", multi_line=multi_line)
            assert [r[0] for r in df.orderBy("k").selectExpr("CAST(t AS STRING)").collect()] == want
        own = write(f"{tmp_dir}/in/u.csv", "t\n14.03.2021 02.30.15.123456\n28.03.2021 02.00.00.000001\n")
        df = read_positional_csv(spark, own, "t TIMESTAMP_NTZ", timestamp_format="dd.MM.yyyy HH.mm.ss.SSSSSS")
        assert [r[0] for r in df.orderBy("t").selectExpr("CAST(t AS STRING)").collect()] == [
            "2021-03-14 02:30:15.123456", "2021-03-28 02:00:00.000001"]
        zoned = write(f"{tmp_dir}/in/z.csv", "t\n2021-06-01 12:00 +02:00\n")
        df = read_positional_csv(spark, zoned, "t TIMESTAMP_NTZ", timestamp_format="yyyy-MM-dd HH:mm xxx")
        assert df.selectExpr("CAST(t AS STRING)").first()[0] == "2021-06-01 10:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
