"""The measure fact (F1) over a stream of long measure rows.

F1 is a stateless stream–static join: each micro-batch of ``(datetime, stn,
measures…)`` rows is joined to the static date and hour dimensions, so no
state, watermark or late-data rule is involved. Output goes to a Parquet sink
with its progress checkpoint under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from asterism.operators.facts import build_measure_fact
from asterism.session import scratch_path


def measure_fact_stream(measures: DataFrame, dates: DataFrame, hours: DataFrame,
                        datetime_col: str = "datetime") -> DataFrame:
    """The streaming measure fact: same columns and join rules as the batch one."""
    if not measures.isStreaming:
        raise ValueError("measures must be a streaming DataFrame (spark.readStream…)")
    return build_measure_fact(measures, dates, hours, datetime_col)


def start_measure_fact_stream(spark: SparkSession, source_path: str, schema: StructType | str,
                              dates: DataFrame, hours: DataFrame, sink_path: str,
                              checkpoint_location: str | None = None,
                              available_now: bool = True) -> StreamingQuery:
    """Read new Parquet files of long measures from ``source_path`` and append fact rows.

    ``available_now=True`` processes what is there and stops (a batch-like run
    that resumes from its checkpoint next time); otherwise it keeps running.
    """
    stream = spark.readStream.schema(schema).parquet(source_path)
    fact = measure_fact_stream(stream, dates, hours)
    writer = (fact.writeStream.format("parquet").outputMode("append")
              .option("path", sink_path)
              .option("checkpointLocation", checkpoint_location or scratch_path(spark, "measure_stream")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
