"""Schemas of the wide measure files from two spec tables.

Each parameter (name, type) gets the columns ``datetime`` then one column per
station, in the station list's order, all of the parameter's type. The station
list is a spec (tens of rows): it is gathered once, ordered, and applied to
every parameter with ``transform`` — no cross join of parameters × stations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from asterism.functions.columns import quoted
from asterism.functions.types import spark_type

# Fixed value: the leading column of every measure table definition.
DATETIME_PREFIX = "datetime DATETIME, "


def _station_list(stations: DataFrame, station_col: str, order_col: str):
    """The station names in order, as one array: a scalar subquery over the spec table."""
    ordered = stations.agg(F.transform(
        F.array_sort(F.collect_list(F.struct(quoted(order_col).alias("o"), quoted(station_col).alias("s")))),
        lambda e: e["s"]).alias("a"))
    return ordered.scalar()


def schema_ddl_frame(specs: DataFrame, stations: DataFrame, name_col: str = "tbl_name",
                     fmt_col: str = "col_fmt", station_col: str = "station_name",
                     order_col: str = "id", prefix: str = DATETIME_PREFIX) -> DataFrame:
    """``(name, col_defs)``: the column definition text of each parameter's table, in order of name.

    ``A T, B T, C T`` is the station array joined by ``' T, '`` plus a last ``' T'``.
    The station list is one value of the result by definition.
    """
    names = _station_list(stations, station_col, order_col)
    fmt = quoted(fmt_col)
    joined = F.call_function("array_join", names, F.concat(F.lit(" "), fmt, F.lit(", ")))
    defs = F.when(F.size(names) > 0, F.concat(joined, F.lit(" "), fmt)).otherwise(F.lit(""))
    return (specs.select(quoted(name_col), F.concat(F.lit(prefix), defs).alias("col_defs"))
            .orderBy(quoted(name_col)))


def measure_schemas(specs: DataFrame, stations: DataFrame, name_col: str = "tbl_name",
                    fmt_col: str = "col_fmt", station_col: str = "station_name",
                    order_col: str = "id") -> dict[str, StructType]:
    """``{parameter: StructType}`` for reading each wide file by position.

    Both spec tables are tiny and are collected (a driver crossing by design).
    """
    station_rows = stations.select(quoted(order_col), quoted(station_col)).orderBy(quoted(order_col)).collect()
    names = [r[1] for r in station_rows]
    if len(set(n.lower() for n in names)) != len(names):
        raise ValueError("station names repeat (case-insensitively); columns would clash")
    out: dict[str, StructType] = {}
    for r in specs.select(quoted(name_col), quoted(fmt_col)).orderBy(quoted(name_col)).collect():
        dtype = spark_type(r[1])
        cols = ", ".join(["datetime TIMESTAMP_NTZ"] + ["`" + n.replace("`", "``") + "` " + dtype for n in names])
        out[r[0]] = StructType.fromDDL(cols)
    return out
