"""Streaming scoring job: source -> model -> alert layer -> enriched sink,
plus optional watermarked window metrics (M12 argument surface, W1-W9).

The metrics query reads the enriched output (folder or topic) as a stream
instead of re-reading the source, so inference runs once per event.

    python -m vigil.plans.score --model_dir DIR --checkpoint_dir DIR
        [--source kafka|files] [--bootstrap_servers H] [--topic_in T] [--topic_out T]
        [--input PATH] [--output PATH] [--starting_offsets latest|earliest]
        [--max_offsets_per_trigger 20000] [--anomaly_threshold 0.7]
        [--confidence_threshold 0.7] [--model_version V]
        [--pred_logic predicted_attack|suspect] [--enable_metrics]
        [--topic_metrics T] [--metrics_window "1 minute"] [--watermark "5 minutes"]
        [--available_now]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, IntegerType, StringType, StructField, StructType,
                               TimestampType)

from vigil.functions.columns import event_key
from vigil.ml.bundle import load_bundle
from vigil.ml.forest import score_events
from vigil.operators import metrics
from vigil.schema import (ANOMALY_THRESHOLD, CONFIDENCE_THRESHOLD, ENRICHED_COLUMNS,
                          MAX_OFFSETS_PER_TRIGGER, METRICS_COLUMNS, METRICS_WINDOW,
                          N_FEATURES_DEFAULT, WATERMARK_DELAY, feature_names,
                          raw_event_schema)
from vigil.sinks.kafka import encode_events, stream_to_kafka, whole_label
from vigil.sources.stream import envelope, file_lines, kafka_source


@dataclass(frozen=True)
class ScoreJob:
    model_dir: str
    checkpoint_dir: str
    source: str = "kafka"
    bootstrap_servers: str | None = None
    topic_in: str = "events"
    topic_out: str = "events_enriched"
    input: str | None = None
    output: str | None = None
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER
    max_files_per_trigger: int = 1
    anomaly_threshold: float = ANOMALY_THRESHOLD
    confidence_threshold: float = CONFIDENCE_THRESHOLD
    model_version: str = "rf_v1"
    pred_logic: str = "predicted_attack"
    enable_metrics: bool = False
    topic_metrics: str = "events_metrics"
    metrics_window: str = METRICS_WINDOW
    watermark: str = WATERMARK_DELAY
    n_features: int = N_FEATURES_DEFAULT
    available_now: bool = False


def parse_args(argv: Sequence[str] | None = None) -> ScoreJob:
    ap = argparse.ArgumentParser(description="score a stream with a model bundle")
    ap.add_argument("--model_dir", required=True)
    ap.add_argument("--checkpoint_dir", required=True)
    ap.add_argument("--source", choices=["kafka", "files"], default="kafka")
    ap.add_argument("--bootstrap_servers")
    ap.add_argument("--topic_in", default="events")
    ap.add_argument("--topic_out", default="events_enriched")
    ap.add_argument("--input")
    ap.add_argument("--output")
    ap.add_argument("--starting_offsets", choices=["latest", "earliest"], default="latest")
    ap.add_argument("--max_offsets_per_trigger", type=int, default=MAX_OFFSETS_PER_TRIGGER)
    ap.add_argument("--max_files_per_trigger", type=int, default=1,
                    help="back-pressure of the file source (files per micro-batch)")
    ap.add_argument("--anomaly_threshold", type=float, default=ANOMALY_THRESHOLD)
    ap.add_argument("--confidence_threshold", type=float, default=CONFIDENCE_THRESHOLD)
    ap.add_argument("--model_version", default="rf_v1")
    ap.add_argument("--pred_logic", choices=["predicted_attack", "suspect"],
                    default="predicted_attack")
    ap.add_argument("--enable_metrics", action="store_true")
    ap.add_argument("--topic_metrics", default="events_metrics")
    ap.add_argument("--metrics_window", default=METRICS_WINDOW)
    ap.add_argument("--watermark", default=WATERMARK_DELAY)
    ap.add_argument("--n_features", type=int, default=N_FEATURES_DEFAULT)
    ap.add_argument("--available_now", action="store_true")
    a = ap.parse_args(argv)
    if a.source == "files" and not (a.input and a.output):
        ap.error("--source files needs --input and --output")
    if a.source == "kafka" and not a.bootstrap_servers:
        ap.error("--source kafka needs --bootstrap_servers")
    return ScoreJob(**vars(a))


def source_frame(spark: SparkSession, job: ScoreJob) -> DataFrame:
    """Kafka envelope, or its file twin (JSON lines of raw events + file time)."""
    if job.source == "kafka":
        return envelope(kafka_source(spark, job.bootstrap_servers, job.topic_in,
                                     job.starting_offsets, job.max_offsets_per_trigger))
    return file_lines(spark, job.input, job.topic_in, job.max_files_per_trigger)


def enrich(df: DataFrame, model, labels, job: ScoreJob) -> DataFrame:
    """Decode -> P8 -> inference -> R3-R8 -> P19/P20 -> 24-column output.

    The payload is parsed into one struct and the feature vector is built
    from its fields directly (null / NaN -> 0.0, as ``fillna`` does), so the
    plan never carries 115 top-level feature columns and the decode, the
    rules and the output projection stay in whole-stage codegen.
    """
    from pyspark.ml.functions import array_to_vector
    # the label may come as 1, 1.0 or "1": read as text, then through double
    j = F.from_json(F.col("json_str"), raw_event_schema(job.n_features, StringType()))
    parsed = df.select("topic", "kafka_ts", "partition", "offset", "json_str", j.alias("j"))
    raw = F.array(*[F.nanvl(F.coalesce(F.col("j").getField(c), F.lit(0.0)), F.lit(0.0))
                    for c in feature_names(job.n_features)])
    parsed = parsed.select("topic", "kafka_ts", "partition", "offset", "json_str",
                           whole_label(F.col("j.label")).alias("label"),
                           F.col("j.attack_name").alias("attack_name"),
                           array_to_vector(raw).alias("__features_raw"))
    scored = score_events(parsed, model, labels, job.anomaly_threshold,
                          job.confidence_threshold, job.pred_logic,
                          features_vector="__features_raw")
    return scored.select(
        F.current_timestamp().alias("processing_ts"),
        event_key("topic", "partition", "offset").alias("event_id"),
        "topic", "kafka_ts", "partition", "offset", F.col("json_str").alias("raw_input"),
        F.lit(job.model_version).alias("model_version"), "predicted_attack", "confidence",
        "p_benign", "anomaly_score", "suspect", "rule_alert", "severity", "label",
        "attack_name", "true_class", "is_attack_true", "is_attack_pred", "fp", "fn", "tp", "tn")


def window_metrics(enriched: DataFrame, job: ScoreJob) -> DataFrame:
    return metrics.confusion_by_window(enriched, "kafka_ts", job.metrics_window,
                                       watermark=job.watermark).select(*METRICS_COLUMNS)


# what the window metrics need of an enriched event
METRICS_INPUT = StructType([StructField(n, t) for n, t in (
    ("kafka_ts", TimestampType()), ("fp", IntegerType()), ("fn", IntegerType()),
    ("tp", IntegerType()), ("tn", IntegerType()), ("is_attack_true", BooleanType()),
    ("is_attack_pred", BooleanType()))])


def decode_enriched(env: DataFrame) -> DataFrame:
    """Enriched events read back from their topic, as the window metrics need them."""
    return env.select(F.from_json("json_str", METRICS_INPUT).alias("j")).select("j.*")


def broken_payloads(env: DataFrame, n_features: int = N_FEATURES_DEFAULT) -> DataFrame:
    """Payloads that are no JSON object or hold none of the features: they are scored
    as all zeros, so they are counted by topic."""
    j = F.from_json(F.col("json_str"), raw_event_schema(n_features, StringType()))
    empty = F.forall(F.array(*[F.col("j").getField(c) for c in feature_names(n_features)]),
                     lambda x: x.isNull())
    return env.select("topic", j.alias("j")).groupBy("topic").agg(
        F.count("*").alias("n"), F.count_if(F.col("j").isNull() | empty).alias("broken"))


def start(spark: SparkSession, job: ScoreJob):
    """Start the events query (and the metrics query); returns the handles."""
    model, labels, _ = load_bundle(spark, job.model_dir)
    out = enrich(source_frame(spark, job), model, labels, job)
    ck = job.checkpoint_dir.rstrip("/")
    trig = {"availableNow": True} if job.available_now else {}
    queries = []
    if job.source == "kafka":
        kafka_out = encode_events(out, ENRICHED_COLUMNS, key_col="event_id")
        queries.append(stream_to_kafka(kafka_out, job.bootstrap_servers, job.topic_out,
                                       f"{ck}/events", trigger=trig))
        if job.enable_metrics:
            if job.available_now:
                queries[0].awaitTermination()
            # the enriched topic again: each event is scored once
            back = envelope(kafka_source(spark, job.bootstrap_servers, job.topic_out, "earliest",
                                         job.max_offsets_per_trigger))
            m = encode_events(window_metrics(decode_enriched(back), job), METRICS_COLUMNS)
            queries.append(stream_to_kafka(m, job.bootstrap_servers, job.topic_metrics,
                                           f"{ck}/metrics", trigger=trig))
        return queries
    events_path = f"{job.output.rstrip('/')}/events"
    w = (out.writeStream.format("parquet").option("path", events_path)
         .option("checkpointLocation", f"{ck}/events").outputMode("append"))
    queries.append((w.trigger(**trig) if trig else w).start())
    if job.enable_metrics:
        if job.available_now:
            queries[0].awaitTermination()
        # the enriched plan's own schema: the folder may still be empty
        enriched = spark.readStream.schema(out.schema).parquet(events_path)
        mw = (window_metrics(enriched, job).writeStream.format("parquet")
              .option("path", f"{job.output.rstrip('/')}/metrics")
              .option("checkpointLocation", f"{ck}/metrics").outputMode("append"))
        queries.append((mw.trigger(**trig) if trig else mw).start())
    return queries


def main(argv: Sequence[str] | None = None) -> None:
    from vigil.session import get_spark
    job = parse_args(argv)
    spark = get_spark("vigil-score")
    qs = start(spark, job)
    if job.available_now:
        for q in qs:
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
