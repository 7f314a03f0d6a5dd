"""Ensemble jobs: train the artifacts, then enrich a stream with them.

    python -m vigil.plans.enrich train --input PATH --out DIR [--format csv|parquet]
    python -m vigil.plans.enrich consume --artifacts DIR --checkpoint DIR
        (--bootstrap_servers H --topic_in T --topic_out T | --input DIR --output DIR)

Output rows have the reference's 11 fields: kafka_ts, kafka_topic,
kafka_partition, kafka_offset, kafka_key, rule_alert, iso_score,
iso_is_anom, pred_lr, pred_xgb, pred_final.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.ml.ensemble import (EnsembleConfig, fit_ensemble, load_ensemble,
                               save_ensemble, score_ensemble)
from vigil.operators.clean import coerce_numeric, features_array
from vigil.schema import (ENSEMBLE_COLUMNS, MAX_OFFSETS_PER_TRIGGER, N_FEATURES_DEFAULT,
                          feature_names, feature_schema)
from vigil.sinks.kafka import encode_events, stream_to_kafka, whole_label
from vigil.session import scratch_path
from vigil.sources.capture import discover_features
from vigil.sources.stream import envelope, file_lines, kafka_source


def train(spark: SparkSession, df: DataFrame, out: str,
          cfg: EnsembleConfig = EnsembleConfig()):
    """Fit on a labelled table whose fields may be text: numbers are coerced (P10),
    labels go through double, and rows are keyed by their fields and their place.

    Equal rows, which flood captures are full of, thus have keys of their own: each is
    sampled, salted and subsampled by itself.  The key is fixed when the rows are written.
    """
    feats = discover_features(df.columns)
    clean = coerce_numeric(df, feats).withColumn("label", whole_label("label"))
    rows = clean.select(F.xxhash64(*feats, "label", "attack_name", F.monotonically_increasing_id())
                        .alias("_key"), features_array(feats, "features"), "label", "attack_name")
    # the fits read the rows several times: parse and coerce the text once
    path = scratch_path(spark, "ensemble-rows")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    model = fit_ensemble(rows, "features", "_key", cfg)
    save_ensemble(spark, model, out)
    return model


def enrich_frame(env: DataFrame, model, n_features: int = 115) -> DataFrame:
    """Envelope (with key) -> decoded features -> ensemble -> 11 columns.

    The payload is parsed into one struct and the feature array is built
    from its fields, so the plan never holds 115 top-level columns.
    """
    feats = feature_names(n_features)
    j = F.col("j")
    x = env.select("kafka_ts", "topic", "partition", "offset", "key",
                   F.from_json(F.col("json_str"), feature_schema(n_features)).alias("j"))
    x = x.select("kafka_ts", F.col("topic").alias("kafka_topic"),
                 F.col("partition").alias("kafka_partition"),
                 F.col("offset").alias("kafka_offset"), F.col("key").alias("kafka_key"),
                 j.getField("f1").alias("f1"), j.getField("f2").alias("f2"),
                 F.array(*[j.getField(c) for c in feats]).alias("features"))
    out = score_ensemble(x, model, "features")
    return out.select(*ENSEMBLE_COLUMNS)


def main(argv: Sequence[str] | None = None) -> None:
    from vigil.session import get_spark
    ap = argparse.ArgumentParser(description="ensemble artifacts: train / consume")
    sub = ap.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    t.add_argument("--input", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--format", choices=["csv", "parquet"], default="csv")
    c = sub.add_parser("consume")
    c.add_argument("--artifacts", required=True)
    c.add_argument("--checkpoint", required=True)
    c.add_argument("--bootstrap_servers")
    c.add_argument("--topic_in", default="events")
    c.add_argument("--topic_out", default="events_enriched")
    c.add_argument("--input")
    c.add_argument("--output")
    c.add_argument("--starting_offsets", choices=["latest", "earliest"], default="latest")
    c.add_argument("--max_offsets_per_trigger", type=int, default=MAX_OFFSETS_PER_TRIGGER)
    c.add_argument("--max_files_per_trigger", type=int, default=1)
    c.add_argument("--n_features", type=int, default=N_FEATURES_DEFAULT)
    c.add_argument("--available_now", action="store_true")
    a = ap.parse_args(argv)
    spark = get_spark("vigil-enrich")
    if a.cmd == "train":
        df = spark.read.format(a.format).option("header", "true").load(a.input)
        train(spark, df, a.out)
        return
    consume(spark, a).awaitTermination()


def consume(spark: SparkSession, a):
    """Start the enrichment of a stream; ``a`` holds the options of ``consume``."""
    model = load_ensemble(spark, a.artifacts)
    trigger = {"availableNow": True} if a.available_now else {}
    if a.bootstrap_servers:
        source = kafka_source(spark, a.bootstrap_servers, a.topic_in, a.starting_offsets,
                              a.max_offsets_per_trigger)
        out = encode_events(enrich_frame(envelope(source, with_key=True), model, a.n_features),
                            ENSEMBLE_COLUMNS)
        return stream_to_kafka(out, a.bootstrap_servers, a.topic_out, a.checkpoint, trigger=trigger)
    env = file_lines(spark, a.input, a.topic_in, a.max_files_per_trigger).select(
        "kafka_ts", "topic", "partition", "offset", F.lit(None).cast("string").alias("key"), "json_str")
    w = (enrich_frame(env, model, a.n_features).writeStream.format("parquet")
         .option("path", a.output).option("checkpointLocation", a.checkpoint))
    return (w.trigger(**trigger) if trigger else w).start()


if __name__ == "__main__":
    main()
