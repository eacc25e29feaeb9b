import datetime as dt

import pytest

from asterism.operators.facts import build_measure_fact
from asterism.operators.generators import dim_dates, dim_hours
from asterism.streaming.measures import measure_fact_stream, start_measure_fact_stream
from tests.conftest import rows

SCHEMA = "datetime timestamp_ntz, stn string, temperature double"


def test_stream_equals_batch(spark, tmp_dir):
    data = [(dt.datetime(2020, 1, 1, h), s, float(h)) for h in range(5) for s in ("A", "B")] + [(None, "C", 1.0)]
    src = spark.createDataFrame(data, SCHEMA)
    src.write.parquet(f"{tmp_dir}/in/part1")
    dates, hours = dim_dates(spark, "2020-01-01", "2020-01-02"), dim_hours(spark)
    q = start_measure_fact_stream(spark, f"{tmp_dir}/in/*", SCHEMA, dates, hours, f"{tmp_dir}/out",
                                  checkpoint_location=f"{tmp_dir}/ckpt")
    q.awaitTermination(120)
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert rows(got) == rows(build_measure_fact(src, dates, hours))
    # a second file is picked up by the next run, from the checkpoint
    spark.createDataFrame([(dt.datetime(2020, 1, 2, 7), "A", 9.0)], SCHEMA).write.parquet(f"{tmp_dir}/in/part2")
    start_measure_fact_stream(spark, f"{tmp_dir}/in/*", SCHEMA, dates, hours, f"{tmp_dir}/out",
                              checkpoint_location=f"{tmp_dir}/ckpt").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 11


def test_batch_input_rejected(spark):
    with pytest.raises(ValueError):
        measure_fact_stream(spark.createDataFrame([], SCHEMA), dim_dates(spark, "2020-01-01", "2020-01-01"),
                            dim_hours(spark))
