import pytest

from asterism.functions.columns import regex_literal
from asterism.functions.names import pivot_column_name, pivot_column_names
from asterism.functions.types import spark_type, varchar_length


@pytest.mark.parametrize("given,expected", [
    ("DATETIME", "TIMESTAMP_NTZ"), ("timestamp", "TIMESTAMP_NTZ"), ("DATE", "DATE"), ("TIME", "STRING"),
    ("FLOAT", "DOUBLE"), ("INT", "INT"), ("BIGINT", "BIGINT"), ("BOOLEAN", "BOOLEAN"),
    ("VARCHAR(MAX)", "STRING"), ("varchar(9)", "STRING"), ("DECIMAL(5, 2)", "DECIMAL(5,2)"),
    ("numeric(6,2)", "DECIMAL(6,2)"), ("DECIMAL(10)", "DECIMAL(10,0)"),
])
def test_spark_type(given, expected):
    assert spark_type(given) == expected


def test_unsupported_type_raises():
    with pytest.raises(ValueError):
        spark_type("GEOMETRY")


def test_varchar_length():
    assert varchar_length("VARCHAR(800)") == 800
    assert varchar_length("VARCHAR(MAX)") is None and varchar_length("INT") is None


def test_pivot_names():
    assert pivot_column_name("Assault") == "assault" and pivot_column_name("") == "not_named"
    assert pivot_column_names(["B", "a", ""]) == {"B": "b", "a": "a", "": "not_named"}
    with pytest.raises(ValueError):
        pivot_column_names(["X", "x"])
    with pytest.raises(ValueError):
        pivot_column_names(["ID"], reserved=["id"])


def test_regex_literal_quotes(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a.b|c\\Ed",)], "s string")
    got = df.select(F.split("s", regex_literal("|"), -1).alias("x"),
                    F.split("s", regex_literal("\\E"), -1).alias("y")).first()
    assert got.x == ["a.b", "c\\Ed"] and got.y == ["a.b|c", "d"]
