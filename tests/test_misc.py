"""Small operators: inferred-width read, renames, tags, JSON encoding, sinks."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from vigil.functions.columns import event_key, hash_uniform, lcg_hash, to_day
from vigil.operators.clean import rename_positional, tag_source
from vigil.sinks.files import to_console
from vigil.sinks.kafka import encode_events
from vigil.sources.capture import read_features_inferred
from vigil.sources.stream import envelope


def test_read_features_inferred(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("1,2,3,4\n5,6,7,8\n")
    df = read_features_inferred(spark, d)
    assert df.columns == ["f0", "f1", "f2", "f3"] and df.count() == 2


def test_rename_and_tag(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    out = tag_source(rename_positional(df), "Mirai")
    assert out.columns == ["f0", "f1", "attack_name"] and out.first().attack_name == "Mirai"


def test_encode_events_drops_null_fields(spark):
    df = spark.createDataFrame([("k1", 1, None)], "event_id string, a int, b string")
    row = encode_events(df, ["event_id", "a", "b"], key_col="event_id").first()
    assert row.key == "k1" and json.loads(row.value) == {"event_id": "k1", "a": 1}


def test_envelope_projection(spark):
    df = spark.createDataFrame([(b"k", b'{"f0": 1}', "t", 2, 7, None)],
                               "key binary, value binary, topic string, partition int, "
                               "offset long, timestamp timestamp")
    out = envelope(df, with_key=True).first()
    assert (out.topic, out.partition, out.offset, out.key, out.json_str) == \
        ("t", 2, 7, "k", '{"f0": 1}')


def test_column_helpers(spark):
    df = spark.createDataFrame([("t", 1, 5, "2024-03-04 05:06:07")],
                               "topic string, p int, o long, ts string")
    r = df.select(event_key("topic", "p", "o").alias("k"),
                  to_day(F.to_timestamp("ts")).alias("d"),
                  lcg_hash(F.lit(10)).alias("h"), hash_uniform(F.lit(10)).alias("u")).first()
    assert r.k == "t:1:5" and r.d == "2024.03.04"
    assert r.h == (10 * 1103515245 + 12345) % 2 ** 31 and abs(r.u - r.h / 2 ** 31) < 1e-15


def test_console_sink_batch(spark, capsys):
    assert to_console(spark.range(2)) is None
