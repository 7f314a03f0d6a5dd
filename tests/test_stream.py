"""Streaming: watermark / late rows, restart from checkpoint, replay safety,
stream = batch on closed windows."""

import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from vigil.operators import metrics
from vigil.plans.streams import _stage_in_order
from vigil.session import scratch_path
from vigil.streaming.dedup import dedup_events
from vigil.streaming.run import read_sink, run_available_now, run_foreach_batch
from vigil.streaming.store import (compact_days, daily_store_sink, daily_upsert_sink,
                                   last_write_wins, read_store)

SCHEMA = "id long, ts timestamp, fp int, fn int, tp int, tn int, " \
         "is_attack_true boolean, is_attack_pred boolean"


def _rows(minutes, start=dt.datetime(2024, 1, 1)):
    return [(i, start + dt.timedelta(minutes=m), 0, 0, 1, 0, True, True)
            for i, m in enumerate(minutes)]


def _write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_staged_batches_are_split_and_keep_rows_without_time(spark):
    for n in (400, 3):
        src = f"{scratch_path(spark, 't_staged')}/{n}"
        rows = _rows(range(n)) + [(n, None, 0, 0, 1, 0, True, True)]
        files = _stage_in_order(spark, spark.createDataFrame(rows, SCHEMA), src, 4)
        assert files == spark.sparkContext.defaultParallelism
        got = spark.read.schema(SCHEMA).parquet(src).select("id", "_metadata.file_path",
                                                            "_metadata.file_modification_time")
        assert sorted(r.id for r in got.collect()) == list(range(n + 1))
        at = sorted((p.stat().st_mtime_ns, p.name) for p in Path(src.removeprefix("file:")).glob("*.parquet"))
        assert len(at) == 4 * files
        batch = {name: k // files for k, (_, name) in enumerate(at)}
        of = {r.id: batch[r.file_path.rsplit("/", 1)[1]] for r in got.collect()}
        assert of[n] == 0 and [of[i] for i in range(n)] == sorted(of[i] for i in range(n))
        assert len({r.file_path for r in got.collect()}) > 4 or n == 3


def test_late_rows_dropped_and_restart(spark):
    base = scratch_path(spark, "t_late")
    src, out, ck = f"{base}/in", f"{base}/out", f"{base}/ck"

    def run():
        s = spark.readStream.schema(SCHEMA).parquet(src)
        m = metrics.confusion_by_window(s, "ts", "1 minute", watermark="5 minutes")
        run_available_now(m, out, ck)

    _write(spark, _rows([0, 0, 1, 2, 30]), src)     # watermark -> 00:25
    run()
    first = {r.window_start.minute: r.total for r in read_sink(spark, out).collect()}
    assert first == {0: 2, 1: 1, 2: 1}               # 00:30 window still open
    _write(spark, _rows([3, 31, 40]), src)           # 00:03 is behind the watermark
    run()
    second = {r.window_start.minute: r.total for r in read_sink(spark, out).collect()}
    assert second == {0: 2, 1: 1, 2: 1, 30: 1, 31: 1}
    run()                                            # restart, nothing new
    assert read_sink(spark, out).count() == 5


def test_stream_equals_batch_on_closed_windows(spark):
    base = scratch_path(spark, "t_eq")
    minutes = [0, 1, 1, 7, 9, 15, 16, 40]
    _write(spark, _rows(minutes), f"{base}/in")
    s = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    run_available_now(metrics.confusion_by_window(s, "ts", "5 minutes", "5 minutes"),
                      f"{base}/out", f"{base}/ck")
    streamed = {(r.window_start, r.total) for r in read_sink(spark, f"{base}/out").collect()}
    batch = metrics.confusion_by_window(spark.read.parquet(f"{base}/in"), "ts", "5 minutes")
    limit = dt.datetime(2024, 1, 1, 0, 35)
    expected = {(r.window_start, r.total) for r in batch.collect() if r.window_end <= limit}
    assert streamed == expected


def test_dedup_replay(spark):
    base = scratch_path(spark, "t_dedup")
    rows = _rows([0, 1, 2])
    _write(spark, rows, f"{base}/in")
    _write(spark, rows, f"{base}/in")
    s = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    run_available_now(dedup_events(s, ["id"], "ts"), f"{base}/out", f"{base}/ck")
    assert sorted(r.id for r in read_sink(spark, f"{base}/out").collect()) == [0, 1, 2]
    batch = dedup_events(spark.read.parquet(f"{base}/in"), ["id"], "ts")
    assert batch.count() == 3


def test_daily_upsert_is_idempotent(spark):
    base = scratch_path(spark, "t_upsert")
    table = f"{base}/table"
    rows = spark.createDataFrame(
        [("t", 0, 1, dt.datetime(2024, 1, 1, 1), 1.0), ("t", 0, 2, dt.datetime(2024, 1, 2, 1), 2.0)],
        "topic string, partition int, offset long, kafka_ts timestamp, f1 double")
    sink = daily_upsert_sink(table, ["topic", "partition", "offset"], "kafka_ts",
                             f"{base}/staging")
    sink(rows, 0)
    sink(rows, 0)                                        # same batch re-run
    assert spark.read.parquet(table).count() == 2
    sink(rows.filter("offset = 1").withColumn("f1", F.lit(9.0)), 1)   # replay, new value
    got = {r.offset: (r.f1, r.day) for r in spark.read.parquet(table).collect()}
    assert got == {1: (9.0, "2024.01.01"), 2: (2.0, "2024.01.02")}


def test_last_write_wins_batch(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")],
                               "k int, _version long, v string")
    assert {r.k: r.v for r in last_write_wins(df, ["k"]).collect()} == {1: "b", 2: "c"}


def test_foreach_batch_restart(spark):
    base = scratch_path(spark, "t_feb")
    _write(spark, _rows([0, 1]), f"{base}/in")
    seen = []
    s = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    run_foreach_batch(s, lambda df, bid: seen.append((bid, df.count())), f"{base}/ck")
    run_foreach_batch(spark.readStream.schema(SCHEMA).parquet(f"{base}/in"),
                      lambda df, bid: seen.append((bid, df.count())), f"{base}/ck")
    assert seen == [(0, 2)]


def test_daily_store_merge_on_read_and_compaction(spark):
    base = scratch_path(spark, "t_store")
    table = f"{base}/table"
    keys = ["topic", "partition", "offset"]
    rows = spark.createDataFrame(
        [("t", 0, 1, dt.datetime(2024, 1, 1, 1), 1.0), ("t", 0, 2, dt.datetime(2024, 1, 2, 1), 2.0)],
        "topic string, partition int, offset long, kafka_ts timestamp, f1 double")
    sink = daily_store_sink(table, "kafka_ts")
    sink(rows, 0)
    sink(rows, 0)                                        # re-run of the same batch
    sink(rows.filter("offset = 1").withColumn("f1", F.lit(9.0)), 1)
    assert spark.read.parquet(table).count() == 5        # appended, not rewritten
    got = {r.offset: (r.f1, r.day) for r in read_store(spark, table, keys).collect()}
    assert got == {1: (9.0, "2024.01.01"), 2: (2.0, "2024.01.02")}
    assert read_store(spark, table, keys, days=["2024.01.02"]).count() == 1
    compact_days(spark, table, keys, ["2024.01.01"], f"{base}/staging")
    assert spark.read.parquet(table).filter("day = '2024.01.01'").count() == 1
    assert spark.read.parquet(table).filter("day = '2024.01.02'").count() == 2
    again = {r.offset: r.f1 for r in read_store(spark, table, keys).collect()}
    assert again == {1: 9.0, 2: 2.0}


def test_labelled_total_counts_known_truth(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), 1, 0, 0, 0, True, True),
         (dt.datetime(2024, 1, 1), None, 0, None, 0, None, True)],
        "ts timestamp, fp int, fn int, tp int, tn int, is_attack_true boolean, "
        "is_attack_pred boolean")
    r = metrics.confusion_by_window(df, "ts", "1 hour", keep_counts=True).first()
    assert (r.total, r.labelled_total, r.fp) == (2, 1, 1)



def test_read_sink_of_empty_stream(spark):
    base = scratch_path(spark, "t_empty")
    import os
    os.makedirs(f"{base}/in".replace("file:", ""), exist_ok=True)
    s = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    m = metrics.confusion_by_window(s, "ts", "1 minute", watermark="5 minutes")
    run_available_now(m, f"{base}/out", f"{base}/ck")
    assert read_sink(spark, f"{base}/out", schema=m.schema).count() == 0


def test_compact_job_rewrites_only_multi_version_days(spark):
    from vigil.plans import compact
    base = scratch_path(spark, "t_compact")
    table = f"{base}/table"
    keys = ["topic", "partition", "offset"]
    rows = spark.createDataFrame(
        [("t", 0, 1, dt.datetime(2024, 1, 1, 1), 1.0), ("t", 0, 2, dt.datetime(2024, 1, 2, 1), 2.0),
         ("t", 0, 3, dt.datetime(2024, 1, 3, 1), 3.0)],
        "topic string, partition int, offset long, kafka_ts timestamp, f1 double")
    sink = daily_store_sink(table, "kafka_ts")
    sink(rows, 0)
    sink(rows.filter("offset < 3").withColumn("f1", F.lit(9.0)), 1)
    done = compact.run(spark, table, keys, f"{base}/staging", before="2024.01.02")
    assert done == ["2024.01.01"]
    t = spark.read.parquet(table)
    assert t.filter("day = '2024.01.01'").count() == 1
    assert t.filter("day = '2024.01.02'").count() == 2          # not before the bound
    assert {r.offset: r.f1 for r in read_store(spark, table, keys).collect()} == \
        {1: 9.0, 2: 9.0, 3: 3.0}


KEYS = ["topic", "partition", "offset"]
STORE_SCHEMA = "topic string, partition int, offset long, kafka_ts timestamp, f1 double"


def _event(offset, value, day=1):
    return ("t", 0, offset, dt.datetime(2024, 1, day, 1), value)


def test_replay_from_a_new_checkpoint_wins(spark):
    """Batch numbers start at 0 again with a new checkpoint; the later write still wins."""
    base = scratch_path(spark, "t_replay")
    table = f"{base}/table"
    for batch_id, value in ((0, 1.0), (7, 1.0), (0, 99.0)):
        daily_store_sink(table, "kafka_ts")(spark.createDataFrame([_event(1, value)], STORE_SCHEMA), batch_id)
    assert [r.f1 for r in read_store(spark, table, KEYS).collect()] == [99.0]


def test_later_copy_in_a_batch_wins(spark):
    for trial in range(4):
        table = scratch_path(spark, "t_copies")
        rows = [_event(1, float(v + trial)) for v in range(6)]
        daily_store_sink(table, "kafka_ts")(spark.createDataFrame(rows, STORE_SCHEMA), 0)
        assert [r.f1 for r in read_store(spark, table, KEYS).collect()] == [5.0 + trial]


def test_compaction_keeps_what_is_appended_meanwhile(spark):
    table = scratch_path(spark, "t_race") + "/table"
    sink = daily_store_sink(table, "kafka_ts")
    sink(spark.createDataFrame([_event(1, 1.0), _event(2, 2.0, 2)], STORE_SCHEMA), 0)
    sink(spark.createDataFrame([_event(1, 5.0)], STORE_SCHEMA), 1)
    late = spark.createDataFrame([_event(1, 8.0), _event(3, 3.0)], STORE_SCHEMA)
    compact_days(spark, table, KEYS, ["2024.01.01"], before_swap=lambda: sink(late, 2))
    got = {r.offset: r.f1 for r in read_store(spark, table, KEYS).collect()}
    assert got == {1: 8.0, 2: 2.0, 3: 3.0}
    # the merged old rows (1) and the appended ones (2) of that day
    assert spark.read.parquet(table).filter("day = '2024.01.01'").count() == 3


def test_hot_key_of_a_batch_is_folded_in_its_tasks(spark):
    """A third of the rows on one key: one row a task goes on, the latest."""
    import datetime as dt
    from vigil.streaming import dedup
    t0 = dt.datetime(2024, 1, 1)
    df = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.lit(t0) + F.make_dt_interval(secs=F.col("id"))).alias("ts"), "id")
    out = dedup.fold_in_task(df, ["k"], "ts")
    got = out.withColumn("part", F.spark_partition_id()).where("k = 'hot'").collect()
    assert len(got) == 6 and {r.id for r in got} == {498, 999, 1497, 1998, 2499, 2997}
    assert out.where("k <> 'hot'").count() == 2000


def test_folded_stream_gives_each_key_once(spark):
    """Null keys and null times too; a late copy never hides one in time."""
    import datetime as dt
    base = scratch_path(spark, "t_fold")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, t0 + dt.timedelta(seconds=i)) for i in range(50) for k in ("hot", None, f"k{i}")] + [("x", None)]
    spark.createDataFrame(rows, "id string, ts timestamp").repartition(5).write.parquet(f"{base}/in")
    s = spark.readStream.schema("id string, ts timestamp").parquet(f"{base}/in")
    run_available_now(dedup_events(s, ["id"], "ts"), f"{base}/out", f"{base}/ck")
    got = [r.id for r in spark.read.parquet(f"{base}/out").collect()]
    assert sorted(got, key=str) == sorted(["hot", None, "x"] + [f"k{i}" for i in range(50)], key=str)
