"""Registered streaming queries: the events table replayed as a file stream.

Each query stages its input under the shared checkpoint folder (data that
Spark derives from the table), runs the streaming plan available-now with
its own checkpoint, and returns a batch view of the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.columns import event_key
from vigil.operators import metrics, rules
from vigil.session import scratch_path
from vigil.sources.stream import file_event_source
from vigil.sources.tables import decode_props, read_table
from vigil.streaming.dedup import dedup_events
from vigil.streaming.run import read_sink, run_available_now, run_foreach_batch
from vigil.streaming.store import daily_store_sink, read_store

WATERMARK = "5 minutes"
METRICS_WINDOW = "1 hour"
DAILY_WINDOW = "1 minute"


def _events_glob(sf_dir: str) -> str:
    """The events file as a file-stream path (a stream source takes a folder
    or a glob, not a bare file)."""
    return f"{sf_dir.rstrip('/')}/event[s].parquet"


def _events_stream(spark: SparkSession, path: str, schema, max_files: int | None = None,
                   extra=()) -> DataFrame:
    """Stream of raw events rows -> envelope shape (topic/partition/offset/kafka_ts)."""
    ev = file_event_source(spark, path, schema, max_files_per_trigger=max_files)
    return ev.select(
        *extra,
        F.col("event_type").alias("topic"),
        F.col("ts").cast("timestamp").alias("kafka_ts"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("props").alias("json_str"),
        F.col("value").alias("f1"),
        (F.col("event_type") == "error").cast("int").alias("label"),
        F.col("event_type").alias("attack_name"))


def _metrics_text(out: DataFrame, extra=()) -> DataFrame:
    from vigil.plans.catalog import _metrics_text as text
    return text(out, extra)


def _score(df: DataFrame) -> DataFrame:
    from vigil.plans.catalog import R2_F1, R2_F2
    df = rules.compound_rule(decode_props(df), f1_threshold=R2_F1, f2_threshold=R2_F2)
    return rules.truth_layer(df, pred_logic="rule")


def q_confusion_window_stream(spark, sf_dir):
    """Watermarked tumbling-window metrics, append mode."""
    src = _events_glob(sf_dir)
    schema = read_table(spark, sf_dir, "events").schema
    scored = _score(_events_stream(spark, src, schema))
    m = metrics.confusion_by_window(scored, "kafka_ts", METRICS_WINDOW, watermark=WATERMARK)
    base = scratch_path(spark, "confusion_window_stream")
    run_available_now(m, f"{base}/out", f"{base}/checkpoint")
    return _metrics_text(read_sink(spark, f"{base}/out", schema=m.schema))


BATCHES = 4


def _stage(batch: DataFrame, src: str) -> int:
    """Append the rows as one batch of files; the number of files.

    The file source reads files by their time, so with that number of files to a
    trigger the stream sees write after write.  Every task writes one file; where
    rows are too few for that, empty files make up the number.
    """
    spark = batch.sparkSession
    files = spark.sparkContext.defaultParallelism
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{src}/*.parquet")
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    before = len(fs.globStatus(fs_path))
    batch.repartition(files).write.mode("append").parquet(src)
    for _ in range(len(fs.globStatus(fs_path)) - before, files):
        batch.limit(0).coalesce(1).write.mode("append").parquet(src)
    return files


def _stage_in_order(spark, ev: DataFrame, src: str, parts: int = BATCHES) -> int:
    """The events as ``parts`` batches of files, one write after the other in time
    order, rows without a time in the first; the number of files of a batch."""
    sec = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = ev.select((sec / 1e6).alias("t")).approxQuantile(
        "t", [k / parts for k in range(1, parts)], 0.001)
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        part = ev
        if lo is not None:
            part = part.filter(sec / 1e6 > lo)
        if hi is not None:
            within = sec / 1e6 <= hi
            part = part.filter(within if lo is not None else within | sec.isNull())
        files = _stage(part, src)
    return files


def q_stream_dedup(spark, sf_dir):
    """The events in ordered batches, then a full replay in a later batch;
    each event comes out once (kept state for the latest, lateness for the rest)."""
    base = scratch_path(spark, "stream_dedup")
    src = f"{base}/input"
    ev = read_table(spark, sf_dir, "events")
    _stage_in_order(spark, ev, src)
    files = _stage(ev, src)
    s = _events_stream(spark, src, ev.schema, max_files=files)
    s = s.withColumn("event_id", event_key("topic", "partition", "offset"))
    d = dedup_events(s, ["event_id"], "kafka_ts", WATERMARK).select(
        "event_id", "topic", "partition", "offset", "f1")
    run_available_now(d, f"{base}/out", f"{base}/checkpoint")
    return read_sink(spark, f"{base}/out", schema=d.schema)


def q_late_rows(spark, sf_dir):
    """Window metrics over ordered batches; the last batch holds the first
    quarter again, far behind the watermark, and must change no window."""
    base = scratch_path(spark, "late_rows")
    src = f"{base}/input"
    ev = read_table(spark, sf_dir, "events")
    _stage_in_order(spark, ev, src)
    sec = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    cut = ev.select(sec.alias("t")).approxQuantile("t", [1 / BATCHES], 0.001)[0]
    files = _stage(ev.filter(sec <= cut), src)
    scored = _score(_events_stream(spark, src, ev.schema, max_files=files))
    m = metrics.confusion_by_window(scored, "kafka_ts", METRICS_WINDOW, watermark=WATERMARK)
    run_available_now(m, f"{base}/out", f"{base}/checkpoint")
    return _metrics_text(read_sink(spark, f"{base}/out", schema=m.schema))


def q_rate_limited_stream(spark, sf_dir):
    """With the files of one write to a trigger, batch k holds the k-th write and no more."""
    base = scratch_path(spark, "rate_limited")
    src, out = f"{base}/input", f"{base}/out"
    ev = read_table(spark, sf_dir, "events")
    for k in range(BATCHES):
        files = _stage(ev.filter(F.col("event_id") % BATCHES == k), src)
    s = _events_stream(spark, src, ev.schema, max_files=files).select("offset")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("append").parquet(out)

    run_foreach_batch(s, keep, f"{base}/checkpoint")
    return spark.read.parquet(out).groupBy("batch").agg(
        F.count("*").alias("n"), F.min("offset").alias("first_id"), F.max("offset").alias("last_id"))


def _replay_errors(ev: DataFrame) -> DataFrame:
    """The replay: the 'error' topic twice in one batch, each time with new values."""
    errors = ev.filter(F.col("event_type") == "error")
    return errors.withColumns({"value": F.col("value") * 2, "arrival": F.lit(1).cast("bigint")}) \
        .unionByName(errors.withColumns({"value": F.col("value") * 3,
                                         "arrival": F.lit(2).cast("bigint")}))


def q_daily_upsert(spark, sf_dir):
    """K8 + F14: the events, then a replay from a *new* checkpoint (whose batch
    numbers start at 0 again) with two copies of each record in one batch; the
    store, read back last-write-wins per record key, has the last copy."""
    base = scratch_path(spark, "daily_upsert")
    ev = read_table(spark, sf_dir, "events").withColumn("arrival", F.lit(0).cast("bigint"))
    table = f"{base}/table"
    keys = ["topic", "partition", "offset"]

    def run(src: str, checkpoint: str):
        s = _events_stream(spark, src, ev.schema, extra=["arrival"])
        s = s.withColumn("event_id", event_key(*keys))
        s = s.select("event_id", *keys, "kafka_ts", "f1", "arrival")
        run_foreach_batch(s, daily_store_sink(table, "kafka_ts", keys, order="arrival"), checkpoint)

    ev.write.parquet(f"{base}/input")
    run(f"{base}/input", f"{base}/checkpoint")
    _replay_errors(ev).write.parquet(f"{base}/replay")
    run(f"{base}/replay", f"{base}/checkpoint-of-the-replay")
    return read_store(spark, table, keys).select("day", "event_id", *keys, "f1")


def q_daily_metrics(spark, sf_dir):
    """K9: watermarked 1-minute metrics stored per day, keyed by window start,
    so a replayed window overwrites instead of duplicating."""
    src = _events_glob(sf_dir)
    schema = read_table(spark, sf_dir, "events").schema
    scored = _score(_events_stream(spark, src, schema))
    m = metrics.confusion_by_window(scored, "kafka_ts", DAILY_WINDOW, watermark=WATERMARK)
    base = scratch_path(spark, "daily_metrics")
    table = f"{base}/table"
    run_foreach_batch(m, daily_store_sink(table, "window_start"), f"{base}/checkpoint")
    return _metrics_text(read_store(spark, table, ["window_start"]), extra=["day"])


def q_paced_replay(spark, sf_dir):
    """K3: the events released an eighth at a time, with a restart half way."""
    from vigil.streaming import paced
    d = scratch_path(spark, "paced_replay")
    n = paced.store_positioned(read_table(spark, sf_dir, "events").select("event_id"), ["event_id"], f"{d}/rows")
    rate = max(1, -(-n // 8))

    def send(rows, batch):
        rows.select("event_id", "pos").write.mode("overwrite").parquet(f"{d}/out/batch={batch}")

    for until in (4, None):
        paced.replay(spark, f"{d}/rows", n, rate, f"{d}/checkpoint", send, seconds=0.05, until=until)
    return read_sink(spark, f"{d}/out", schema="event_id bigint, pos bigint, batch int") \
        .select("event_id", "pos", "batch")


STREAM_QUERIES = {
    "paced_replay": q_paced_replay,
    "confusion_window_stream": q_confusion_window_stream,
    "stream_dedup": q_stream_dedup,
    "late_rows": q_late_rows,
    "rate_limited_stream": q_rate_limited_stream,
    "daily_upsert": q_daily_upsert,
    "daily_metrics": q_daily_metrics,
}
