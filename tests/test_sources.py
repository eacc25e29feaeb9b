import decimal
import json
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from asterism.operators.schema import measure_schemas, schema_ddl_frame
from asterism.sources.csv import csv_header, read_manifest, read_ordered_names, read_positional_csv
from tests.conftest import rows

# The source project's format spec (6 rows) and its first stations, retyped.
SPEC_LINES = ["table_name,data_format", 'temperature,"DECIMAL(5, 2)"', 'pressure,"DECIMAL(6, 2)"',
              'humidity,"DECIMAL(5, 2)"', 'wind_speed,"DECIMAL(5, 2)"', 'wind_direction,"DECIMAL(5, 2)"',
              'description,"VARCHAR(MAX)"']
STATIONS = ["Vancouver", "Portland", "San_Francisco", "Seattle"]


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_positional_binding_ignores_header_names(spark, tmp_dir):
    p = write(f"{tmp_dir}/a.csv", ["whatever,names,here", "1,x,2.5", "2,y,3.5"])
    df = read_positional_csv(spark, p, "id BIGINT, name STRING, price DOUBLE")
    assert df.columns == ["id", "name", "price"] and rows(df) == [(1, "x", 2.5), (2, "y", 3.5)]


def test_decimal_round_and_truncate(spark, tmp_dir):
    p = write(f"{tmp_dir}/d.csv", ["datetime,Vancouver", "2020-01-01 00:00:00,284.629", "2020-01-01 01:00:00,-1.005"])
    schema = "datetime TIMESTAMP_NTZ, Vancouver DECIMAL(5,2)"
    assert [r[1] for r in rows(read_positional_csv(spark, p, schema))] == [decimal.Decimal("284.63"),
                                                                          decimal.Decimal("-1.01")]
    assert [r[1] for r in rows(read_positional_csv(spark, p, schema, scale_mode="truncate"))] == [
        decimal.Decimal("284.62"), decimal.Decimal("-1.00")]


def test_failfast_on_overflow_and_short_row(spark, tmp_dir):
    over = write(f"{tmp_dir}/o.csv", ["h,v", "1,12345.67"])
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_positional_csv(spark, over, "k INT, v DECIMAL(5,2)").collect()
    short = write(f"{tmp_dir}/s.csv", ["h,v,w", "1,2"])
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_positional_csv(spark, short, "k INT, v INT, w INT").collect()
    permissive = read_positional_csv(spark, short, "k INT, v INT, w INT", mode="PERMISSIVE",
                                     corrupt_column="_bad")
    assert rows(permissive) == [(1, 2, None, "1,2")]


def test_empty_strings(spark, tmp_dir):
    p = write(f"{tmp_dir}/e.csv", ["k,s", '1,', '2,""', "3,A;B"])
    assert rows(read_positional_csv(spark, p, "k INT, s STRING")) == [(1, None), (2, None), (3, "A;B")]
    assert rows(read_positional_csv(spark, p, "k INT, s STRING", empty_strings="keep")) == [
        (1, None), (2, ""), (3, "A;B")]


def test_ordered_names(spark, tmp_dir):
    p = write(f"{tmp_dir}/auxfs/station_names.csv", STATIONS + [""])
    names = read_ordered_names(spark, p)
    assert rows(names) == [(1, "Vancouver"), (2, "Portland"), (3, "San_Francisco"), (4, "Seattle")]
    read_ordered_names(spark, p, expected=STATIONS)
    with pytest.raises(ValueError, match="order"):
        read_ordered_names(spark, p, expected=list(reversed(STATIONS)))
    quoted = write(f"{tmp_dir}/q.csv", ['"New York"', '"a ""b"" c"', "back\\slash"])
    assert [r[1] for r in rows(read_ordered_names(spark, quoted))] == ["New York", 'a "b" c', "back\\slash"]
    many = write(f"{tmp_dir}/many.csv", [f"n{i}" for i in range(12_000)])
    assert rows(read_ordered_names(spark, many)) == [(i + 1, f"n{i}") for i in range(12_000)]


def test_csv_header(spark, tmp_dir):
    p = write(f"{tmp_dir}/w.csv", ["datetime," + ",".join(STATIONS), "2020-01-01 00:00:00,1,2,3,4"])
    assert csv_header(spark, p) == ["datetime"] + STATIONS


def test_manifest(spark, tmp_dir):
    p = f"{tmp_dir}/data_files.json"
    with open(p, "w") as f:
        json.dump({"data_files": [{"local": "agencies.csv", "s3": "agencies.csv"},
                                  {"local": "meteodata/x.csv", "s3": "meteodata/x.csv"}]}, f, indent=2)
    assert rows(read_manifest(spark, p)) == [("agencies.csv", "agencies.csv"), ("meteodata/x.csv", "meteodata/x.csv")]


def test_measure_schemas_from_specs(spark, tmp_dir):
    spec = read_positional_csv(spark, write(f"{tmp_dir}/fmt.csv", SPEC_LINES), "tbl_name STRING, col_fmt STRING")
    names = read_ordered_names(spark, write(f"{tmp_dir}/names.csv", STATIONS))
    schemas = measure_schemas(spec, names)
    assert sorted(schemas) == sorted(["temperature", "pressure", "humidity", "wind_speed", "wind_direction",
                                      "description"])
    assert schemas["pressure"].simpleString() == (
        "struct<datetime:timestamp_ntz,Vancouver:decimal(6,2),Portland:decimal(6,2),"
        "San_Francisco:decimal(6,2),Seattle:decimal(6,2)>")
    assert schemas["description"]["Seattle"].dataType.simpleString() == "string"
    ddl = dict(rows(schema_ddl_frame(spec, names)))
    assert ddl["temperature"] == ("datetime DATETIME, Vancouver DECIMAL(5, 2), Portland DECIMAL(5, 2), "
                                  "San_Francisco DECIMAL(5, 2), Seattle DECIMAL(5, 2)")


def test_schema_ddl_of_many_stations_in_name_order(spark):
    specs = spark.createDataFrame([("u", "TEXT"), ("t", "INT")], "tbl_name string, col_fmt string")
    stations = spark.range(1, 12_001).selectExpr("CAST(id AS INT) AS id", "concat('s', id) AS station_name")
    got = schema_ddl_frame(specs, stations).collect()
    assert [r[0] for r in got] == ["t", "u"] and got[0][1].endswith("s12000 INT")
    assert got[0][1].startswith("datetime DATETIME, s1 INT, s2 INT")


def test_quotes_and_backslashes(spark, tmp_dir):
    assert rows(read_positional_csv(spark, write(f"{tmp_dir}/o.csv", ["a,k", '"""5",1']), "a STRING, k INT")) == [('"5', 1)]
    p = write(f"{tmp_dir}/q.csv", ["a,b,k", '"5"" nail","He said ""hi"", ok",1', 'ends\\,"in \\",2', 'C:\\x,"a,b",3'])
    assert rows(read_positional_csv(spark, p, "a STRING, b STRING, k INT"), "k", "a", "b") == [
        (1, '5" nail', 'He said "hi", ok'), (2, "ends\\", "in \\"), (3, "C:\\x", "a,b")]


def test_line_breaks_inside_quotes(spark, tmp_dir):
    p = write(f"{tmp_dir}/n.csv", ["k,s", '1,"x', 'y"', "2,z"])
    assert rows(read_positional_csv(spark, p, "k INT, s STRING", multi_line=True)) == [(1, "x\ny"), (2, "z")]
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_positional_csv(spark, p, "k INT, s STRING").collect()
    inner = write(f"{tmp_dir}/i.csv", ["s,k", '"x', 'y",1'])
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_positional_csv(spark, inner, "s STRING, k INT").collect()


def test_spellings_of_times_and_booleans(spark, tmp_dir):
    p = write(f"{tmp_dir}/t.csv", ["b,t", "t,2021-01-01T00:00:00.000Z", "1,1/2/2021", "NO,2021-03-04 05:06:07", ",", "Yes,1/2/2021 3:04"])
    got = [(r.b, str(r.t)) for r in read_positional_csv(spark, p, "b BOOLEAN, t TIMESTAMP_NTZ").collect()]
    assert got == [(True, "2021-01-01 00:00:00"), (True, "2021-01-02 00:00:00"), (False, "2021-03-04 05:06:07"),
                   (None, "None"), (True, "2021-01-02 03:04:00")]
    for line in ("maybe,2021-01-01", "t,not a time"):
        bad = write(f"{tmp_dir}/bad-{line[:2]}.csv", ["b,t", line])
        with pytest.raises((PySparkException, Py4JJavaError)):
            read_positional_csv(spark, bad, "b BOOLEAN, t TIMESTAMP_NTZ").collect()
    german = write(f"{tmp_dir}/g.csv", ["t", "31.12.2020"])
    assert str(rows(read_positional_csv(spark, german, "t TIMESTAMP_NTZ", timestamp_format="dd.MM.yyyy"))[0][0]) == "2020-12-31 00:00:00"


def test_truncation_takes_whole_numbers_only(spark, tmp_dir):
    p = write(f"{tmp_dir}/d.csv", ["v", "1e2", "-1.009", "+.5", "7."])
    assert [str(r.v) for r in read_positional_csv(spark, p, "v DECIMAL(6,2)", scale_mode="truncate").collect()] == [
        "100.00", "-1.00", "0.50", "7.00"]
    for text in ("12abc", "1.2.3", "99999.99"):
        bad = write(f"{tmp_dir}/x{text}.csv", ["v", text])
        with pytest.raises((PySparkException, Py4JJavaError)):
            read_positional_csv(spark, bad, "v DECIMAL(6,2)", scale_mode="truncate").collect()
