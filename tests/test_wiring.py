"""Kafka options, payload cleaning and file lines, without a broker."""

import argparse

import pytest
from pyspark.sql import functions as F

from vigil.plans import enrich, score
from vigil.session import scratch_path
from vigil.sinks import kafka as sinks
from vigil.sources import stream


class Calls:
    """Stands for a reader or writer: keeps what it is told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def outputMode(self, mode):
        self.told["mode"] = mode
        return self

    def trigger(self, **trigger):
        self.told["trigger"] = trigger
        return self

    def load(self):
        return self

    start = save = load


class Stub:
    def __init__(self, call):
        self.readStream = self.writeStream = self.write = call


def test_kafka_source_options():
    c = Calls()
    stream.kafka_source(Stub(c), "h:1", "events", "earliest", 77)
    assert c.told == {"format": "kafka", "kafka.bootstrap.servers": "h:1", "subscribe": "events",
                      "startingOffsets": "earliest", "maxOffsetsPerTrigger": "77", "failOnDataLoss": "false"}


def test_kafka_sink_options():
    c = Calls()
    sinks.stream_to_kafka(Stub(c), "h:1", "out", "/ck", {"kafka.acks": "all"}, {"availableNow": True})
    assert c.told == {"format": "kafka", "kafka.bootstrap.servers": "h:1", "topic": "out",
                      "checkpointLocation": "/ck", "mode": "append", "kafka.acks": "all",
                      "trigger": {"availableNow": True}}
    c = Calls()
    sinks.write_kafka(Stub(c), "h:1", "out")
    assert c.told == {"format": "kafka", "kafka.bootstrap.servers": "h:1", "topic": "out"}


class Query:
    def __init__(self, log, name):
        self.log, self.name = log, name

    def awaitTermination(self):
        self.log.append(("await", self.name))


@pytest.mark.parametrize("now", [True, False])
def test_scoring_with_kafka_scores_once_and_honours_available_now(spark, monkeypatch, now):
    log = []
    env = spark.createDataFrame([], "topic string, timestamp timestamp, partition int, offset long, "
                                    "key binary, value binary")
    enriched = spark.createDataFrame([], "event_id string")
    monkeypatch.setattr(score, "load_bundle", lambda *a: (None, [], None))
    monkeypatch.setattr(score, "kafka_source",
                        lambda s, servers, topic, *a: log.append(("read", topic, *a[:1])) or env)
    monkeypatch.setattr(score, "enrich", lambda *a: log.append(("enrich",)) or enriched)
    monkeypatch.setattr(score, "encode_events", lambda df, cols, key_col=None: df)
    monkeypatch.setattr(score, "window_metrics", lambda df, job: df)
    monkeypatch.setattr(score, "stream_to_kafka", lambda df, servers, topic, ck, trigger=None:
                        log.append(("write", topic, trigger)) or Query(log, topic))
    job = score.ScoreJob("m", "c", bootstrap_servers="h:1", topic_in="i", topic_out="o", topic_metrics="m",
                         enable_metrics=True, available_now=now)
    assert len(score.start(spark, job)) == 2
    trigger = {"availableNow": True} if now else {}
    assert log.count(("enrich",)) == 1
    assert ("read", "o", "earliest") in log and ("write", "m", trigger) in log and ("write", "o", trigger) in log
    assert (("await", "o") in log) == now


def test_enrich_options_reach_the_source(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(enrich, "load_ensemble", lambda *a: None)
    monkeypatch.setattr(enrich, "kafka_source", lambda s, *a: seen.update(source=a))
    monkeypatch.setattr(enrich, "envelope", lambda df, with_key: None)
    monkeypatch.setattr(enrich, "enrich_frame", lambda env, model, n: seen.update(n=n))
    monkeypatch.setattr(enrich, "encode_events", lambda df, cols: None)
    monkeypatch.setattr(enrich, "stream_to_kafka", lambda *a, trigger=None: seen.update(trigger=trigger))
    enrich.consume(spark, argparse.Namespace(
        artifacts="a", checkpoint="c", bootstrap_servers="h:1", topic_in="i", topic_out="o", input=None,
        output=None, starting_offsets="earliest", max_offsets_per_trigger=5, max_files_per_trigger=1,
        n_features=9, available_now=True))
    assert seen == {"source": ("h:1", "i", "earliest", 5), "n": 9, "trigger": {"availableNow": True}}


def test_replay_payload_cleans_fields(spark):
    rows = [("1.5", "1.0", "a"), ("NaN", "0", None), ("bad", "x", "b"), (None, None, "c"), ("-Infinity", "1", "d")]
    df = spark.createDataFrame(rows, "f0 string, label string, attack_name string")
    got = [r.value for r in sinks.replay_payload(df, ["f0"]).collect()]
    import json
    parsed = [json.loads(v) for v in got]
    assert [p["f0"] for p in parsed] == [1.5, 0.0, 0.0, 0.0, 0.0]
    assert [p.get("label") for p in parsed] == [1, 0, None, None, 1]


def test_broken_payloads_are_counted(spark):
    rows = [("t", '{"f0": 1.0, "f1": 2}'), ("t", "not json"), ("t", '{"other": 1}'), ("u", '{"f0": 1}'), ("u", None)]
    got = {r.topic: (r.n, r.broken) for r in score.broken_payloads(
        spark.createDataFrame(rows, "topic string, json_str string"), 2).collect()}
    assert got == {"t": (3, 2), "u": (2, 1)}


def test_equal_lines_of_a_file_stay_two_events(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"ts": 5}\n{"ts": 5}\n\n{"ts": 6}\n')
    base = scratch_path(spark, "t_lines")
    q = (stream.file_lines(spark, str(tmp_path / "in"), "x").writeStream.format("parquet")
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(f"{base}/out").orderBy("offset").collect()
    assert [r.offset for r in got] == [0, 1, 3] and len({r.partition for r in got}) == 1
    assert [r.kafka_ts.timestamp() for r in got][0] == got[1].kafka_ts.timestamp()


def test_benign_cap_keeps_partitions_and_is_exact(spark):
    from vigil.operators.sample import first_rows
    df = spark.range(4000).repartition(6).select(
        (F.col("id") % 1000).alias("k"), "id", F.lit(0).alias("label"))
    got = first_rows(df, 1501, ["k"])
    assert got.count() == 1501 and got.rdd.getNumPartitions() > 1
    assert got.filter("k < 375").count() == 1500
    assert first_rows(df, 9999, ["k", "id"]).count() == 4000
    assert first_rows(df.limit(0), 5, ["k"]).count() == 0


def test_row_keys_of_many_small_partitions_hash_evenly(spark):
    """The ensemble job keys rows by their fields, so the hash cut is a fair sample."""
    from vigil.functions.columns import hash_uniform
    df = spark.range(20000).repartition(200).select(F.xxhash64(F.col("id") * 1.5, "id").alias("_key"))
    u = df.select(hash_uniform("_key").alias("u"))
    assert u.distinct().count() > 19900
    assert 80 < u.filter("u < 0.005").count() < 120


def test_cluster_without_shared_folder_is_refused(monkeypatch):
    from vigil import session

    class Context:
        master = "spark://h:7077"

        def getConf(self):
            return self

        def get(self, *a):
            return None

        def getCheckpointDir(self):
            return None

    class Fake:
        sparkContext = conf = Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Fake())


def test_store_job_carries_files_and_messages(spark, tmp_path):
    import datetime as dt
    from vigil.plans import store_job
    from vigil.streaming.store import read_store
    base = scratch_path(spark, "t_store_job")
    ts = dt.datetime(2024, 1, 2, 3, 4)
    rows = spark.createDataFrame([(ts, ts + dt.timedelta(minutes=1), 1, 0, 2, 0, 3, 0.3, 0.0, 0.6, 0.9)],
                                 store_job.METRICS_FIELDS)
    rows.write.parquet(f"{base}/in")
    a = store_job.parse_args(["--kind", "metrics", "--table", f"{base}/t", "--checkpoint", f"{base}/c",
                              "--input", f"{base}/in", "--available_now"])
    store_job.start(spark, a).awaitTermination()
    got = read_store(spark, f"{base}/t", ["window_start"]).collect()
    assert [(r.day, r.fp, r.total) for r in got] == [("2024.01.02", 1, 3)]
    msgs = spark.createDataFrame(
        [(0, '{"topic":"x","partition":1,"offset":7,"kafka_ts":"2024-01-02T03:04:00.000Z","fp":1}'),
         (1, "broken"), (2, '{"topic":"x"}')], "offset long, json_str string")
    got = store_job.records(msgs, "events").collect()
    assert [(r.topic, r.partition, r.offset, r.fp, r._at) for r in got] == [("x", 1, 7, 1, 0)]
    with pytest.raises(SystemExit):
        store_job.parse_args(["--kind", "events", "--table", "t", "--checkpoint", "c",
                              "--bootstrap_servers", "h:1"])
