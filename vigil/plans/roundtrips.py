"""Registered queries that write what the jobs write and read it back.

Tables go through CSV folders, rows through the sinks' JSON, classes through the
indexers; the result must be the rows that went in.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.functions.columns import event_key
from vigil.operators import clean, metrics, rules
from vigil.plans.build import write_csv
from vigil.plans.catalog import (METRICS_WINDOW, MODEL_VERSION, _classes, _metrics_text, _r,
                                 scored_events, soft_scored, q_decision_cascade)
from vigil.plans.store_job import EVENT_FIELDS, METRICS_FIELDS
from vigil.schema import ENRICHED_COLUMNS, ENSEMBLE_COLUMNS, METRICS_COLUMNS
from vigil.session import scratch_path
from vigil.sinks.kafka import encode_events
from vigil.sources.capture import discover_features, read_features_inferred, read_labelled
from vigil.sources.tables import read_table

KAFKA_TS = "2024-01-02 03:04:05"


def q_labelled_csv(spark, sf_dir):
    """Lineitem as a labelled CSV with header, read under the declared schema."""
    li = read_table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "labelled_csv")
    write_csv(li.select(F.col("l_orderkey").cast("double").alias("f0"),
                        F.col("l_linenumber").cast("double").alias("f1"),
                        F.col("l_extendedprice").cast("double").alias("f2"),
                        (F.col("l_quantity") > 25).cast("int").alias("label"),
                        F.col("l_returnflag").alias("attack_name")), path)
    header = spark.read.option("header", "true").csv(path).columns
    feats = discover_features(header, 3)
    return read_labelled(spark, path, len(feats)).select(
        F.col("f0").cast("bigint").alias("l_orderkey"), F.col("f1").cast("int").alias("l_linenumber"),
        F.col("f2").alias("price"), "label", "attack_name")


def q_inferred_capture(spark, sf_dir):
    """Orders as a headerless CSV whose width is read from the first line."""
    path = scratch_path(spark, "inferred")
    read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("double")).write.csv(path)
    df = read_features_inferred(spark, path)
    return df.select(F.col("f0").cast("bigint").alias("o_orderkey"),
                     F.col("f1").cast("bigint").alias("o_custkey"), F.col("f2").alias("price"),
                     F.lit(len(df.columns)).alias("width"))


def q_feature_array(spark, sf_dir):
    """P18, P12 (array form): features packed into one array, non-finite entries zeroed."""
    li = read_table(spark, sf_dir, "lineitem")
    bad = F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))) \
        .when(F.col("l_linenumber") == 4, F.lit(float("inf"))).otherwise(F.col("l_tax").cast("double"))
    x = li.withColumn("odd", bad).select(
        "l_orderkey", "l_linenumber", clean.features_array(["l_quantity", "l_discount", "odd"], "x"))
    x = x.withColumn("x", clean.zero_nonfinite_array("x"))
    return x.select("l_orderkey", "l_linenumber", F.size("x").alias("n"),
                    *[F.get("x", i).alias(f"x{i}") for i in range(3)])


def q_enriched_json(spark, sf_dir):
    """The 24 fields of an enriched event through their JSON."""
    s = rules.truth_layer(soft_scored(spark, sf_dir))
    s = s.withColumns({
        "processing_ts": F.current_timestamp(), "topic": F.lit("embeddings"),
        "kafka_ts": F.lit(KAFKA_TS).cast("timestamp"), "partition": F.lit(0),
        "offset": F.col("vec_id").cast("bigint"), "model_version": F.lit(MODEL_VERSION),
        "raw_input": F.to_json(F.struct("vec_id"))})
    s = s.withColumn("event_id", event_key("topic", "partition", "offset"))
    sent = encode_events(s, ENRICHED_COLUMNS, key_col="event_id")
    j = sent.select("key", F.from_json("value", EVENT_FIELDS).alias("j")).select("key", "j.*")
    round9 = {c: _r(c) for c in ("confidence", "p_benign", "anomaly_score")}
    return j.select("key", (F.col("processing_ts").isNotNull()).alias("has_time"),
                    F.date_format("kafka_ts", "yyyy-MM-dd HH:mm:ss").alias("kafka_ts"),
                    *[round9.get(c, F.col(c)).alias(c) for c in ENRICHED_COLUMNS
                      if c not in ("processing_ts", "kafka_ts")])


def q_ensemble_json(spark, sf_dir):
    """K5: the 11 fields of an ensemble decision through their JSON."""
    s = q_decision_cascade(spark, sf_dir).withColumns({
        "kafka_ts": F.lit(KAFKA_TS).cast("timestamp"), "kafka_topic": F.lit("embeddings"),
        "kafka_partition": F.lit(0), "kafka_offset": F.col("vec_id").cast("bigint"),
        "kafka_key": F.col("vec_id").cast("string"), "iso_score": F.col("vec_id") / 8.0})
    sent = encode_events(s, ENSEMBLE_COLUMNS)
    fields = ("kafka_ts TIMESTAMP, kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT, "
              "kafka_key STRING, rule_alert INT, iso_score DOUBLE, iso_is_anom INT, pred_lr STRING, "
              "pred_xgb STRING, pred_final STRING")
    j = sent.select(F.from_json("value", fields).alias("j")).select("j.*")
    return j.withColumn("kafka_ts", F.date_format("kafka_ts", "yyyy-MM-dd HH:mm:ss"))


def q_metrics_json(spark, sf_dir):
    """K6: window metrics through their JSON."""
    m = metrics.confusion_by_window(scored_events(spark, sf_dir), "kafka_ts", METRICS_WINDOW)
    sent = encode_events(m, METRICS_COLUMNS)
    return _metrics_text(sent.select(F.from_json("value", METRICS_FIELDS).alias("j")).select("j.*"))


def q_class_index(spark, sf_dir):
    """Class -> index (by frequency, by name) -> class."""
    from pyspark.ml.feature import IndexToString, StringIndexer
    df = _classes(spark, sf_dir).select("vec_id", "class_name")
    by_freq = StringIndexer(inputCol="class_name", outputCol="freq", handleInvalid="keep").fit(df)
    by_name = StringIndexer(inputCol="class_name", outputCol="alpha",
                            stringOrderType="alphabetAsc").fit(df)
    out = by_name.transform(by_freq.transform(df))
    back = IndexToString(inputCol="alpha", outputCol="back", labels=by_name.labels).transform(out)
    return back.select("vec_id", "class_name", F.col("freq").cast("int").alias("freq_index"),
                       F.col("alpha").cast("int").alias("alpha_index"), "back")


def q_feature_stats_incremental(spark, sf_dir):
    """A5: a state of three captures, then two more folded in; only the new ones are read."""
    from vigil.operators.moments import add_capture, merged, read_moments
    from vigil.sources.tables import array_width
    emb = read_table(spark, sf_dir, "embeddings")
    cols = [f"f{i}" for i in range(array_width(emb))]
    base = scratch_path(spark, "feature_stats_incremental")
    wide = emb.select("vec_id", *[F.get("embedding", i).cast("double").alias(c) for i, c in enumerate(cols)])
    wide.withColumn("capture", F.pmod(F.coalesce("vec_id", F.lit(0)), F.lit(5))).write.partitionBy("capture") \
        .parquet(f"{base}/captures")
    state = f"{base}/state"
    for some in (range(3), range(3, 5)):
        for k in some:
            path = f"{base}/captures/capture={k}"
            add_capture(spark.read.schema(wide.schema).parquet(path), cols, f"capture {k}", state)
    add_capture(spark.read.schema(wide.schema).parquet(path), cols, "capture 4", state)   # again: nothing changes
    return merged(read_moments(spark, state)).select(
        "feature", "n", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


ROUNDTRIP_QUERIES = {
    "feature_stats_incremental": q_feature_stats_incremental,
    "labelled_csv": q_labelled_csv,
    "inferred_capture": q_inferred_capture,
    "feature_array": q_feature_array,
    "enriched_json": q_enriched_json,
    "ensemble_json": q_ensemble_json,
    "metrics_json": q_metrics_json,
    "class_index": q_class_index,
}
