"""Paced replay and the progress listener."""

from pyspark.sql import functions as F

from vigil.plans import replay as job
from vigil.streaming import paced
from vigil.streaming.progress import record_progress


def test_positions_follow_the_order_over_partitions(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k")).repartition(9)
    got = paced.positioned(df.union(spark.createDataFrame([(None,)], "k long")), ["k"]).collect()
    assert sorted((r.pos, r.k) for r in got) == [(0, None), *((i + 1, i) for i in range(5000))]
    assert paced.positioned(df.limit(0), ["k"]).count() == 0


def test_each_batch_holds_its_rows_over_restarts(spark, tmp_path):
    n = paced.store_positioned(spark.range(95).repartition(5), ["id"], str(tmp_path / "rows"))
    sent: dict = {}

    def send(rows, batch):
        sent.setdefault(batch, []).append(sorted(r.id for r in rows.collect()))

    for until in (2, 2, 5, None, None):
        paced.replay(spark, str(tmp_path / "rows"), n, 10, str(tmp_path / "ck"), send, 0.02, until)
    assert n == 95 and sent == {k: [list(range(10 * k, min(10 * k + 10, 95)))] for k in range(10)}


def test_a_failing_send_is_sent_again(spark, tmp_path):
    import pytest
    n = paced.store_positioned(spark.range(30), ["id"], str(tmp_path / "rows"))
    sent, fail = [], [True]

    def send(rows, batch):
        if batch == 1 and fail.pop() if fail else False:
            raise ValueError("broker away")
        sent.append((batch, rows.count()))

    with pytest.raises(Exception, match="broker away"):
        paced.replay(spark, str(tmp_path / "rows"), n, 10, str(tmp_path / "ck"), send, 0.02)
    paced.replay(spark, str(tmp_path / "rows"), n, 10, str(tmp_path / "ck"), send, 0.02)
    assert sent == [(0, 10), (1, 10), (2, 10)]


def test_job_paces_a_table(spark, tmp_path):
    rows = spark.range(25).select(F.col("id").cast("double").alias("f0"), F.lit(0).alias("label"),
                                  F.lit("benign").alias("attack_name"), "id")
    rows.write.option("header", "true").csv(str(tmp_path / "in"))
    job.main(["--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--rate", "10", "--order", "id",
              "--checkpoint", str(tmp_path / "ck")])
    got = spark.read.text(str(tmp_path / "out")).select("batch", F.get_json_object("value", "$.f0").cast("double").alias("f"))
    assert {r.batch: r.n for r in got.groupBy("batch").agg(F.count("*").alias("n")).collect()} == {0: 10, 1: 10, 2: 5}


def test_listener_counts_rows_in_and_dropped(spark, tmp_path):
    import time
    for k, ts in enumerate(("2024-01-01 00:00:00", "2024-01-01 05:00:00", "2024-01-01 05:10:00",
                            "2024-01-01 00:10:00")):
        spark.range(10).select(F.lit(ts).cast("timestamp").alias("ts")).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in"))
        time.sleep(0.02 * k)
    log = record_progress(spark)
    try:
        q = spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")) \
            .withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 hour")).count().writeStream.format("parquet") \
            .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")) \
            .trigger(availableNow=True).start()
        q.awaitTermination()
        for _ in range(200):
            if log.ended(q):
                break
            time.sleep(0.05)
        assert log.totals(q)[0] == 40 and log.totals(q)[1] >= 1 and len(log.batches(q)) >= 4
    finally:
        spark.streams.removeListener(log)
