"""Running a streaming plan to completion (available-now) into a file sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_available_now(df: DataFrame, sink_path: str, checkpoint: str,
                      fmt: str = "parquet", output_mode: str = "append",
                      partition_by: list[str] | None = None,
                      query_name: str | None = None) -> None:
    """Process everything available now, then stop (W7: own checkpoint).

    Restarting with the same checkpoint picks up only new input.
    """
    w = (df.writeStream.format(fmt).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).option("path", sink_path)
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def run_foreach_batch(df: DataFrame, fn, checkpoint: str, output_mode: str = "append",
                      query_name: str | None = None) -> None:
    """Available-now run with a ``foreachBatch`` sink."""
    w = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(fn).trigger(availableNow=True))
    if query_name:
        w = w.queryName(query_name)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_sink(spark: SparkSession, path: str, fmt: str = "parquet",
              schema=None) -> DataFrame:
    """Batch view of a file sink (only committed files are listed).

    With ``schema`` given, a sink no batch has written to yet (empty input)
    reads as an empty table instead of failing.
    """
    try:
        return spark.read.format(fmt).load(path)
    except Exception:  # noqa: BLE001 - PATH_NOT_FOUND / unable to infer schema
        if schema is None:
            raise
        return spark.createDataFrame([], schema)
