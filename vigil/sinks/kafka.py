"""Kafka-shaped sinks (K3-K6).

Rows are encoded to the Kafka sink contract (``key``/``value`` strings) by
plain expressions; the writer is ``format("kafka")`` when a connector and a
broker exist, or any file format with the same two columns otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.columns import finite_or_zero


def encode_events(df: DataFrame, cols: Sequence[str], key_col: str | None = None) -> DataFrame:
    """K3 / K4 / K5: ``value = to_json(struct(cols))`` and an optional key.

    Null fields are left out of the JSON text (Spark's ``to_json`` rule).
    """
    value = F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value")
    if key_col is None:
        return df.select(value)
    return df.select(F.col(key_col).cast("string").alias("key"), value)


def whole_label(col) -> Column:
    """A label of any spelling (1, "1", "1.0", 1.0) as int; what is no number is null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("string").try_cast("double")).cast("int")


def replay_payload(df: DataFrame, features: Sequence[str], label: str | None = "label",
                   attack: str | None = "attack_name", keep: Sequence[str] = (),
                   also: Sequence[str] = (), sent: Column | None = None) -> DataFrame:
    """K3: table rows as raw-event JSON: features as doubles (null, text, NaN and
    infinities -> 0.0, which JSON can hold), label as int, attack as string,
    ``ts`` = send time in epoch seconds (now, if ``sent`` does not say).  ``keep`` lists
    columns to carry along, ``also`` columns to add to the JSON."""
    cols = [finite_or_zero(F.col(c).cast("string").try_cast("double")).alias(c) for c in features]
    if label:
        cols.append(whole_label(label).alias("label"))
    if attack:
        cols.append(F.col(attack).cast("string").alias("attack_name"))
    ts = F.unix_micros(F.current_timestamp()) / F.lit(1e6) if sent is None else sent
    return df.select(*keep, F.to_json(F.struct(*cols, *also, ts.alias("ts"))).alias("value"))


def write_kafka(df: DataFrame, servers: str, topic: str, options: dict | None = None):
    """Batch write of key/value rows to a Kafka topic (needs the connector)."""
    w = (df.write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save()


def stream_to_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str,
                    options: dict | None = None, trigger: dict | None = None):
    """Streaming append of key/value rows to Kafka with its own checkpoint."""
    w = (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).option("checkpointLocation", checkpoint)
         .outputMode("append"))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
