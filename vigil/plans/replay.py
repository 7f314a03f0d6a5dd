"""Replay producer (K3): a labelled table published as raw-event JSON.

The reference loops over rows in one Python process; here every
partition encodes and sends its own rows.  With ``--rate`` the rows go out in
their order, so many a second at most (:mod:`vigil.streaming.paced`).

    python -m vigil.plans.replay --input PATH [--format csv|parquet]
        (--bootstrap_servers H --topic T | --output DIR) [--features_only]
        [--rate N --order COLS --checkpoint DIR]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from vigil.sinks.kafka import replay_payload, write_kafka
from vigil.sources.capture import discover_features
from vigil.streaming import paced


def replay_frame(df: DataFrame, features_only: bool = False) -> DataFrame:
    feats = discover_features(df.columns, required=() if features_only else
                              ("label", "attack_name"))
    if features_only:
        return replay_payload(df, feats, None, None)
    return replay_payload(df, feats)


def _stored(spark: SparkSession, path: str) -> bool:
    """Whether an earlier run has written the rows to the end."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def main(argv: Sequence[str] | None = None) -> None:
    from vigil.session import get_spark
    ap = argparse.ArgumentParser(description="publish a table as raw events")
    ap.add_argument("--input", required=True)
    ap.add_argument("--format", choices=["csv", "parquet"], default="csv")
    ap.add_argument("--bootstrap_servers")
    ap.add_argument("--topic", default="events")
    ap.add_argument("--output")
    ap.add_argument("--features_only", action="store_true")
    ap.add_argument("--rate", type=int, help="events a second at most")
    ap.add_argument("--order", help="columns that order the rows, with --rate")
    ap.add_argument("--checkpoint", help="folder of the paced replay's state, with --rate")
    a = ap.parse_args(argv)
    spark: SparkSession = get_spark("vigil-replay")
    df = spark.read.format(a.format).option("header", "true").load(a.input)
    options = {"kafka.linger.ms": "10", "kafka.compression.type": "lz4"}
    if a.rate:
        if not (a.order and a.checkpoint and (a.bootstrap_servers or a.output)):
            ap.error("--rate needs --order, --checkpoint and a place to send to")
        store = f"{a.checkpoint.rstrip('/')}/rows"
        done = spark.createDataFrame([], "pos long") if not _stored(spark, store) else spark.read.parquet(store)
        n = done.count() or paced.store_positioned(df, a.order.split(","), store)

        def send(rows, batch):
            out = replay_frame(rows.drop("pos"), a.features_only)
            if a.bootstrap_servers:
                write_kafka(out, a.bootstrap_servers, a.topic, options)
            else:
                out.write.mode("overwrite").text(f"{a.output.rstrip('/')}/batch={batch}")
        paced.replay(spark, store, n, a.rate, f"{a.checkpoint.rstrip('/')}/stream", send)
        return
    payload = replay_frame(df, a.features_only)
    if a.bootstrap_servers:
        write_kafka(payload, a.bootstrap_servers, a.topic, options)
    elif a.output:
        payload.write.mode("overwrite").text(a.output)
    else:
        ap.error("give --bootstrap_servers or --output")


if __name__ == "__main__":
    main()
