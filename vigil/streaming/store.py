"""Replay-safe daily stores (K8, K9).

The reference relies on a search index with a per-record id, so a replay
overwrites instead of duplicating.  Here the store is a Parquet table
partitioned by ``day`` with merge-on-read:

* every micro-batch is *appended* to the days it touches, each row tagged
  with ``_version`` (the write's own time, which grows across batches,
  restarts and new checkpoints) and ``_seq`` (its place in the batch), so
  the copy that arrived last wins, as in the index; a re-run of a failed
  batch appends the same rows again, which is harmless;
* readers see :func:`read_store`: the last write per record key, over the
  days they ask for (partition pruning first, then a shuffle on the key,
  which is unique per record so no task holds more than one record's
  copies);
* :func:`compact_days` rewrites closed days to one row per key, off the
  streaming path: it appends the merged rows under their own versions and
  then removes exactly the files it has read, so rows that arrive meanwhile
  stay, and readers see the same result at every moment.

``upsert_days`` is the eager variant (merge the batch into its days and
overwrite them, dynamic partition overwrite); it suits small stores.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.columns import to_day

VERSION, SEQ = "_version", "_seq"


def next_version() -> int:
    """Microseconds of the writing driver's clock, never the same twice in a process."""
    global _last_version
    _last_version = max(_last_version + 1, time.time_ns() // 1000)
    return _last_version


_last_version = 0


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # noqa: B018 - listing only
        return True
    except Exception:  # noqa: BLE001 - missing path / empty folder
        return False


def last_write_wins(df: DataFrame, keys: Sequence[str], version: str = VERSION) -> DataFrame:
    """Keep the highest-version row per key.

    An aggregate with a map-side step: a record replayed millions of times is
    reduced to one copy per input partition before the shuffle.  Of equal
    versions the later place in its batch wins; what is equal in both is the
    same write, and a hash of the row makes the choice repeatable.
    """
    rest = [c for c in df.columns if c not in keys]
    place = [F.col(SEQ)] if SEQ in df.columns else []
    order = F.struct(F.col(version), *place, F.xxhash64(*[F.col(c) for c in rest]))
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]),
                                            order).alias("_last"))
    return picked.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest]).select(
        *df.columns)


def tag_batch(batch: DataFrame, time_col: str, version=None, order: str | None = None) -> DataFrame:
    """Day, version and place in the batch of every row.

    ``order`` names a column that gives the arrival order (a Kafka offset); by
    default the order of the source's partitions and rows stands for it.
    """
    place = F.col(order).cast("bigint") if order else F.monotonically_increasing_id()
    return batch.withColumns({
        "day": to_day(F.col(time_col)), SEQ: place,
        VERSION: F.lit(next_version() if version is None else version).cast("bigint")})


def append_batch(batch: DataFrame, table: str, time_col: str, version=None,
                 cluster_by: Sequence[str] = (), order: str | None = None) -> None:
    """K8 write side: append the batch to its day partitions.

    Rows are range-partitioned by (day, *cluster_by) first, so each task
    writes a contiguous run of days (few files per day, even when a batch
    spans years) and a hot day is still split across several tasks.
    """
    tagged = tag_batch(batch, time_col, version, order)
    tagged = tagged.repartitionByRange("day", *cluster_by).sortWithinPartitions("day")
    tagged.write.mode("append").partitionBy("day").parquet(table)


def read_store(spark: SparkSession, table: str, keys: Sequence[str],
               days: Sequence[str] | None = None, keep_version: bool = False) -> DataFrame:
    """K8 read side: one row per key (the last write), optionally for some days."""
    df = spark.read.parquet(table)
    if days is not None:
        df = df.filter(F.col("day").isin(list(days)))
    out = last_write_wins(df, keys)
    return out if keep_version else out.drop(VERSION, SEQ)


def compact_days(spark: SparkSession, table: str, keys: Sequence[str],
                 days: Sequence[str], staging: str | None = None, before_swap=None) -> None:
    """Rewrite the given (closed) days to one row per key, losing no append.

    The merged rows are appended with the versions they had, so until the old
    files go a reader merges equal copies; then only the files that were read
    are removed.  ``before_swap`` is called between the two (tests).
    ``staging`` is no longer needed and ignored.
    """
    if not days:
        return
    old = spark.read.parquet(table).filter(F.col("day").isin(list(days)))
    # one row per file of the days at hand: the file list of this very read
    files = [r[0] for r in old.select(F.col("_metadata.file_path")).distinct().collect()]
    if not files:
        return
    last_write_wins(spark.read.option("basePath", table).parquet(*files), keys) \
        .repartitionByRange("day", *keys).sortWithinPartitions("day") \
        .write.mode("append").partitionBy("day").parquet(table)
    if before_swap is not None:
        before_swap()
    jvm = spark._jvm
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    spark.catalog.refreshByPath(table)


def upsert_days(batch: DataFrame, table: str, keys: Sequence[str], time_col: str,
                version, staging: str) -> None:
    """Eager merge of one batch into its days (small stores)."""
    spark = batch.sparkSession
    batch = tag_batch(batch, time_col, version)
    # the days one micro-batch touches: a handful of values
    days = [r[0] for r in batch.select("day").distinct().collect()]
    if not days:
        return
    merged = batch
    if _exists(spark, table):
        old = spark.read.parquet(table).filter(F.col("day").isin(days))
        merged = batch.unionByName(old.select(*batch.columns))
    last_write_wins(merged, keys).write.mode("overwrite").partitionBy("day").parquet(staging)
    (spark.read.parquet(staging).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(table))


def daily_store_sink(table: str, time_col: str, cluster_by: Sequence[str] = (),
                     order: str | None = None):
    """foreachBatch function for K8 / K9 (append, merge-on-read)."""
    def _fn(batch_df: DataFrame, batch_id: int) -> None:
        append_batch(batch_df, table, time_col, None, cluster_by, order)
    return _fn


def daily_upsert_sink(table: str, keys: Sequence[str], time_col: str, staging: str):
    """foreachBatch function for the eager variant; the time of the write orders writes."""
    def _fn(batch_df: DataFrame, batch_id: int) -> None:
        upsert_days(batch_df, table, keys, time_col, None, f"{staging}/current")
    return _fn
