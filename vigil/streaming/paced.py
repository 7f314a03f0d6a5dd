"""Paced replay: a stream that releases a table's rows in order, so many a batch (K3).

A rate source counts the rows out: batch k holds the numbers k * r to (k + 1) * r - 1,
whatever was done before a restart, and is joined to the rows at these positions.  With
a trigger of one second that is r events a second at most.  The table is kept sorted by
position, so a batch reads its own row groups alone.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.operators.align import frozen


_HELD = "paced replay: held for the next run"


def positioned(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with ``pos``, 0-based in ``order``: ranges, and a table of their sizes.

    Rows that are equal in all of ``order`` come in any order.
    """
    cut = frozen(df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
                 .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
                 .withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = cut.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # one row a partition
    out = cut.withColumn("_part", part).join(F.broadcast(start), "_part")
    return out.withColumn("pos", F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))) \
        .drop("_part", "_start", "_id")


def store_positioned(df: DataFrame, order: Sequence[str], path: str) -> int:
    """Write ``df`` by position; the number of its rows."""
    rows = positioned(df, order)
    rows.repartitionByRange("pos").sortWithinPartitions("pos").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def replay(spark: SparkSession, path: str, n_rows: int, rate: int, checkpoint: str,
           send: Callable[[DataFrame, int], None], seconds: float = 1.0, until: int | None = None) -> None:
    """Release the rows stored at ``path``, ``rate`` a batch, one batch each ``seconds``.

    ``send(rows, batch)`` should replace what an earlier run of the batch sent; Kafka
    gets it at least once.  Ends when all rows are out, or before batch ``until``.
    Started again with the same checkpoint it goes on with the next batch.
    """
    total = -(-n_rows // rate)
    last = total if until is None else min(until, total)

    def release(numbers: DataFrame, batch: int) -> None:
        if batch >= total:
            return
        if batch >= last:
            # not sent, so not to be committed either
            raise RuntimeError(_HELD)
        low, high = batch * rate, min((batch + 1) * rate, n_rows)
        rows = spark.read.parquet(path).where((F.col("pos") >= low) & (F.col("pos") < high))
        send(rows.join(numbers.select(F.col("value").alias("_out")), F.col("pos") == F.col("_out")).drop("_out"), batch)

    q = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rate).load()
         .writeStream.foreachBatch(release).option("checkpointLocation", checkpoint)
         .trigger(processingTime=f"{max(1, round(seconds * 1000))} milliseconds").start())
    try:
        while q.isActive and last > 0:
            p = q.lastProgress
            if p is not None and p["batchId"] >= last - 1:
                break
            time.sleep(0.05)
        if q.exception() is not None and _HELD not in str(q.exception()):
            raise q.exception()
    finally:
        q.stop()
