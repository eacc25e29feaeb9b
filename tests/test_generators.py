import datetime as dt

import pytest

from asterism.operators.generators import date_bounds, dim_dates, dim_dates_between, dim_hours
from tests.conftest import rows


def test_dim_dates_ids_and_bounds(spark):
    d = dim_dates(spark, "2024-02-27", "2024-03-02")
    assert [f.simpleString() for f in d.schema.fields] == ["id:int", "date:date"]
    assert rows(d) == [(1, dt.date(2024, 2, 27)), (2, dt.date(2024, 2, 28)), (3, dt.date(2024, 2, 29)),
                       (4, dt.date(2024, 3, 1)), (5, dt.date(2024, 3, 2))]


def test_dim_dates_single_day(spark):
    assert rows(dim_dates(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 1))) == [(1, dt.date(2020, 1, 1))]


def test_dim_dates_reversed_raises(spark):
    with pytest.raises(ValueError, match="after"):
        dim_dates(spark, "2020-01-02", "2020-01-01")


def test_dim_dates_null_bound_raises(spark):
    with pytest.raises(ValueError, match="NULL"):
        dim_dates(spark, None, "2020-01-01")


def test_dim_dates_many_partitions_contiguous(spark):
    d = dim_dates(spark, "1900-01-01", "2099-12-31", num_partitions=7)
    got = d.selectExpr("count(*) n", "min(id) lo", "max(id) hi", "count(distinct date) nd",
                       "sum(CAST(date_add(DATE'1900-01-01', id - 1) = date AS INT)) ok").first()
    assert got.n == got.hi == got.nd == got.ok and got.lo == 1


def _frames(spark):
    a = spark.createDataFrame([(dt.datetime(2020, 1, 5, 10),), (dt.datetime(2020, 2, 1, 23),)], "ts timestamp_ntz")
    b = spark.createDataFrame([(dt.date(2020, 1, 10),), (None,)], "d date")
    return [(a, "ts"), (b, "d")]


def test_date_bounds_from_data(spark):
    assert rows(date_bounds(_frames(spark))) == [(dt.date(2020, 1, 5), dt.date(2020, 2, 1))]


def test_date_bounds_user_bounds_only_widen(spark):
    wider = date_bounds(_frames(spark), "2019-12-01", "2020-03-01")
    assert rows(wider) == [(dt.date(2019, 12, 1), dt.date(2020, 3, 1))]
    narrower = date_bounds(_frames(spark), "2020-01-20", "2020-01-20")
    assert rows(narrower) == [(dt.date(2020, 1, 5), dt.date(2020, 2, 1))]


def test_date_bounds_empty_data_uses_user_bounds(spark):
    empty = spark.createDataFrame([], "d date")
    assert rows(date_bounds([(empty, "d")], "2020-01-01", "2020-01-03")) == [
        (dt.date(2020, 1, 1), dt.date(2020, 1, 3))]
    with pytest.raises(ValueError):
        dim_dates_between(spark, [(empty, "d")])


def test_dim_hours(spark):
    h = rows(dim_hours(spark))
    assert len(h) == 24 and h[0] == (0, "00:00:00") and h[9] == (9, "09:00:00") and h[23] == (23, "23:00:00")
