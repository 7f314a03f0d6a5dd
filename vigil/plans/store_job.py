"""Carry enriched events or window metrics into the daily store (K8 / K9).

    python -m vigil.plans.store_job --kind events|metrics --table PATH --checkpoint DIR
        (--bootstrap_servers H --topic T | --input DIR) [--starting_offsets earliest]
        [--max_offsets_per_trigger N] [--available_now]

Events are keyed by (topic, partition, offset), metrics by window_start; a replay
overwrites what it repeats (merge-on-read, see :mod:`vigil.streaming.store`).
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.schema import MAX_OFFSETS_PER_TRIGGER
from vigil.sources.stream import envelope, kafka_source
from vigil.streaming.store import daily_store_sink

EVENT_FIELDS = """processing_ts TIMESTAMP, event_id STRING, topic STRING, kafka_ts TIMESTAMP,
  partition INT, offset BIGINT, raw_input STRING, model_version STRING, predicted_attack STRING,
  confidence DOUBLE, p_benign DOUBLE, anomaly_score DOUBLE, suspect BOOLEAN, rule_alert STRING,
  severity STRING, label INT, attack_name STRING, true_class STRING, is_attack_true BOOLEAN,
  is_attack_pred BOOLEAN, fp INT, fn INT, tp INT, tn INT"""
METRICS_FIELDS = """window_start TIMESTAMP, window_end TIMESTAMP, fp BIGINT, fn BIGINT, tp BIGINT,
  tn BIGINT, total BIGINT, fp_rate DOUBLE, fn_rate DOUBLE, attack_true_rate DOUBLE,
  attack_pred_rate DOUBLE"""
# kind -> (fields, time column, record key)
KINDS = {"events": (EVENT_FIELDS, "kafka_ts", ["topic", "partition", "offset"]),
         "metrics": (METRICS_FIELDS, "window_start", ["window_start"])}


def records(raw: DataFrame, kind: str) -> DataFrame:
    """Envelope of JSON messages -> typed records; unreadable ones have no key and go."""
    fields, time_col, keys = KINDS[kind]
    j = F.from_json("json_str", fields)
    return raw.select(F.col("offset").alias("_at"), j.alias("j")).select("_at", "j.*") \
        .where(F.col(time_col).isNotNull() & F.col(keys[-1]).isNotNull())


def start(spark: SparkSession, a):
    fields, time_col, keys = KINDS[a.kind]
    if a.bootstrap_servers:
        raw = envelope(kafka_source(spark, a.bootstrap_servers, a.topic, a.starting_offsets,
                                    a.max_offsets_per_trigger))
        df, order = records(raw, a.kind), "_at"
    else:
        df, order = spark.readStream.schema(fields).parquet(a.input), None
    w = (df.writeStream.option("checkpointLocation", a.checkpoint)
         .foreachBatch(daily_store_sink(a.table, time_col, keys, order)))
    return (w.trigger(availableNow=True) if a.available_now else w).start()


def parse_args(argv: Sequence[str] | None = None):
    ap = argparse.ArgumentParser(description="write a stream of records to the daily store")
    ap.add_argument("--kind", choices=sorted(KINDS), required=True)
    ap.add_argument("--table", required=True)
    ap.add_argument("--checkpoint", required=True)
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--bootstrap_servers")
    source.add_argument("--input")
    ap.add_argument("--topic")
    ap.add_argument("--starting_offsets", choices=["latest", "earliest"], default="earliest")
    ap.add_argument("--max_offsets_per_trigger", type=int, default=MAX_OFFSETS_PER_TRIGGER)
    ap.add_argument("--available_now", action="store_true")
    a = ap.parse_args(argv)
    if a.bootstrap_servers and not a.topic:
        ap.error("--bootstrap_servers needs --topic")
    return a


def main(argv: Sequence[str] | None = None) -> None:
    from vigil.session import get_spark
    start(get_spark("vigil-store"), parse_args(argv)).awaitTermination()


if __name__ == "__main__":
    main()
