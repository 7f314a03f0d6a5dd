"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They bind the pipeline's operators to the driver's tables (see
:mod:`vigil.sources.tables`) and always run over the whole tables.  Doubles
are rounded and timestamps rendered as text only at the very end, so the
result compares exactly with the DuckDB oracle in :mod:`vigil.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.columns import argmax, class_lookup, event_key, fold_scores, softmax
from vigil.operators import clean, metrics, rules, sample
from vigil.sources.tables import (EMBEDDING_VOCAB, array_width, decode_props, embeddings_features,
                                  events_envelope, read_table)

DIGITS = 9
TS_FMT = "yyyy-MM-dd HH:mm:ss"
TS_FMT_US = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Stand-in parameters of the rules on the events table (value in 0..490,
# props.k in 0..99); the reference's own defaults are the function defaults.
R1_THRESHOLD = 113.0
R2_F1, R2_F2 = 150.0, 90.0
SOFTMAX_K, SOFTMAX_SCALE = 10, 20.0
METRICS_WINDOW = "1 hour"
MODEL_VERSION = "vigil_v1"


def _r(c, d: int = DIGITS):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def _ts(c, fmt: str = TS_FMT):
    return F.date_format(F.col(c) if isinstance(c, str) else c, fmt)


# ----------------------------------------------------------------- events
def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope -> decode -> R2 -> truth + flags, the events stand-in of scoring."""
    ev = decode_props(events_envelope(spark, sf_dir))
    ev = rules.compound_rule(ev, f1_threshold=R2_F1, f2_threshold=R2_F2)
    return rules.truth_layer(ev, pred_logic="rule")


def q_rule_alert_simple(spark, sf_dir):
    ev = rules.threshold_rule(events_envelope(spark, sf_dir), "f1", R1_THRESHOLD)
    hit = rules.threshold_predicate("f1", R1_THRESHOLD)
    return rules.alerts_only(ev, predicate=hit).select("offset", "topic", "f1", "rule_alert")


def q_rule_alert_compound(spark, sf_dir):
    ev = decode_props(events_envelope(spark, sf_dir))
    ev = rules.compound_rule(ev, f1_threshold=R2_F1, f2_threshold=R2_F2)
    return ev.select("offset", "f1", "f2", "rule_alert")


def q_alert_counts(spark, sf_dir):
    ev = decode_props(events_envelope(spark, sf_dir))
    return metrics.alert_counts(rules.compound_rule(ev, f1_threshold=R2_F1,
                                                    f2_threshold=R2_F2))


def q_json_decode_flatten(spark, sf_dir):
    from vigil.sources.stream import decode_payload
    env = events_envelope(spark, sf_dir)
    schema = "k DOUBLE, label INT, attack_name STRING, ts DOUBLE"
    out = decode_payload(env, schema, keep=["offset"])
    return clean.fill_features(out, ["k"]).select("offset", "k", "label", "attack_name", "ts")


def _kafka_rows(spark, sf_dir) -> DataFrame:
    """The events in the columns that a Kafka source delivers."""
    return events_envelope(spark, sf_dir).select(
        "topic", F.col("kafka_ts").alias("timestamp"), "partition", "offset",
        F.col("topic").cast("binary").alias("key"), F.col("json_str").cast("binary").alias("value"))


def q_event_envelope(spark, sf_dir):
    from vigil.sources.stream import envelope
    env = envelope(_kafka_rows(spark, sf_dir), with_key=True)
    return env.select(
        "topic", _ts("kafka_ts", TS_FMT_US).alias("kafka_ts"), "partition", "offset",
        "json_str", event_key("topic", "partition", "offset").alias("event_id"),
        F.lit(MODEL_VERSION).alias("model_version"))


# planted bad fields of the replay stand-in, by l_orderkey mod 7
REPLAY_FEATURES = ["l_quantity", "l_discount"]


def q_replay_payload(spark, sf_dir):
    """K3 on lineitem with planted NaN, text and null features and '1.0' labels:
    the published JSON is parsed again and holds doubles, whole labels, text."""
    from vigil.sinks.kafka import replay_payload
    li = read_table(spark, sf_dir, "lineitem")
    kind = F.col("l_orderkey") % 7
    bad = F.when(kind == 1, F.lit("NaN")).when(kind == 2, F.lit("bad")) \
        .when(kind == 3, F.lit(None).cast("string")).when(kind == 4, F.lit("Infinity")) \
        .otherwise(F.col("l_quantity").cast("string"))
    rows = li.select(
        "l_orderkey", "l_linenumber", bad.alias("l_quantity"), "l_discount",
        F.when(F.col("l_linenumber") % 3 == 0, F.lit("1.0")).when(F.col("l_linenumber") % 3 == 1, F.lit("0"))
        .otherwise(F.lit("x")).alias("label"), F.col("l_returnflag").alias("attack_name"))
    sent = replay_payload(rows, REPLAY_FEATURES, keep=["l_orderkey", "l_linenumber"])
    j = F.from_json("value", "l_quantity DOUBLE, l_discount DOUBLE, label DOUBLE, attack_name STRING, ts DOUBLE")
    return sent.select("l_orderkey", "l_linenumber", j.alias("j")).select(
        "l_orderkey", "l_linenumber", "j.l_quantity", "j.l_discount", F.col("j.label").cast("int").alias("label"),
        "j.attack_name", (F.col("j.ts") > 0).alias("has_ts"))


def q_event_json_encode(spark, sf_dir):
    from vigil.sinks.kafka import encode_events
    env = events_envelope(spark, sf_dir).withColumn(
        "event_id", event_key("topic", "partition", "offset"))
    enc = encode_events(env, ["event_id", "topic", "partition", "offset", "f1",
                              "label", "attack_name"], key_col="event_id")
    back = F.from_json("value", "event_id STRING, topic STRING, partition INT, "
                                "offset BIGINT, f1 DOUBLE, label INT, attack_name STRING")
    return enc.select("key", back.alias("j")).select("key", "j.topic", "j.partition",
                                                      "j.offset", "j.f1", "j.label",
                                                      "j.attack_name")


def q_confusion_window(spark, sf_dir):
    out = metrics.confusion_by_window(scored_events(spark, sf_dir), "kafka_ts",
                                      METRICS_WINDOW)
    return _metrics_text(out)


def _metrics_text(out: DataFrame, extra=()) -> DataFrame:
    """Metrics rows with window bounds as text and rates rounded (oracle form)."""
    return out.select(
        *extra,
        _ts("window_start").alias("window_start"), _ts("window_end").alias("window_end"),
        "fp", "fn", "tp", "tn", "total",
        *[_r(c).alias(c) for c in ["fp_rate", "fn_rate", "attack_true_rate",
                                    "attack_pred_rate"]])


# ------------------------------------------------------------- embeddings
def soft_scored(spark, sf_dir, plant_nulls: bool = True) -> DataFrame:
    emb = embeddings_features(spark, sf_dir, plant_nulls=plant_nulls)
    emb = emb.withColumn("scores", fold_scores("embedding", SOFTMAX_K, array_width(emb))) \
        .withColumn("prob_arr", softmax("scores", SOFTMAX_K, SOFTMAX_SCALE))
    return rules.alert_layer(emb, "prob_arr", EMBEDDING_VOCAB)


def q_soft_alerts(spark, sf_dir):
    s = soft_scored(spark, sf_dir)
    return s.select("vec_id", "predicted_attack", _r("confidence").alias("confidence"),
                    _r("p_benign").alias("p_benign"),
                    _r("anomaly_score").alias("anomaly_score"),
                    "suspect", "rule_alert", "severity")


def q_confusion_flags(spark, sf_dir):
    s = rules.truth_layer(soft_scored(spark, sf_dir))
    return s.select("vec_id", "predicted_attack", "label", "attack_name", "true_class",
                    "is_attack_true", "is_attack_pred", "fp", "fn", "tp", "tn")


def q_class_name(spark, sf_dir):
    e = embeddings_features(spark, sf_dir)
    e = e.withColumns({"label_filled": clean.fill_binary_label("label"),
                       "attack_name_filled": F.col("attack_name")})
    e = clean.fill_attack_name(e, "attack_name_filled")
    return e.select("vec_id", "label", "label_filled", "attack_name_filled",
                    clean.class_name("label_filled", "attack_name_filled").alias("class_name"),
                    clean.true_class().alias("true_class"))


def _classes(spark, sf_dir) -> DataFrame:
    e = embeddings_features(spark, sf_dir, plant_nulls=False)
    return e.withColumn("class_name", clean.class_name())


def q_class_counts(spark, sf_dir):
    return metrics.class_counts(_classes(spark, sf_dir))


def q_label_vocab(spark, sf_dir):
    return sample.label_vocab(_classes(spark, sf_dir), "class_name")


def q_multiclass_metrics(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    e = e.withColumn("scores", fold_scores("embedding", SOFTMAX_K, array_width(e))).withColumn(
        "prob", softmax("scores", SOFTMAX_K, SOFTMAX_SCALE)).withColumn(
        "prediction", argmax("prob"))
    m = metrics.multiclass_metrics(e, "label", "prediction")
    return m.select(_r("accuracy").alias("accuracy"), _r("weighted_f1").alias("weighted_f1"),
                    "n")


def q_pair_metrics(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels")
    m = metrics.multiclass_metrics(lab, "quality", "toxic")
    return m.select(_r("accuracy").alias("accuracy"), _r("weighted_f1").alias("weighted_f1"),
                    "n")


def q_decision_cascade(spark, sf_dir):
    s = soft_scored(spark, sf_dir, plant_nulls=False)
    width = array_width(read_table(spark, sf_dir, "embeddings"))
    s = s.withColumn("lr_scores", fold_scores(F.reverse("embedding"), SOFTMAX_K, width)) \
        .withColumn("lr_prob", softmax("lr_scores", SOFTMAX_K, SOFTMAX_SCALE))
    s = s.withColumns({
        "iso_is_anom": F.col("suspect").cast("int"),
        "f1": F.get("embedding", 1).cast("double"),
        "f2": F.get("embedding", 2).cast("double"),
        "pred_xgb": F.when(F.col("vec_id") % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("predicted_attack")),
        "pred_lr": F.when(F.col("vec_id") % 5 == 0, F.lit(None).cast("string"))
        .otherwise(class_lookup(EMBEDDING_VOCAB, argmax("lr_prob"))),
    })
    s = rules.compound_rule(s, f1_threshold=0.1, f2_threshold=0.1)
    s = rules.decision_cascade(s)
    return s.select("vec_id", "iso_is_anom", "rule_alert", "pred_xgb", "pred_lr",
                    "pred_final")


def q_feature_stats(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    n = emb.agg(F.max(F.size("embedding"))).first()[0]
    cols = [f"f{i}" for i in range(n)]
    wide = emb.select(*[F.get("embedding", i).cast("double").alias(c)
                        for i, c in enumerate(cols)])
    st = metrics.feature_stats(wide, cols)
    return st.select("feature", "n", _r("mean").alias("mean"), _r("std").alias("std"))


def q_standardize(spark, sf_dir):
    from vigil.ml.scaling import fit_scaler
    emb = read_table(spark, sf_dir, "embeddings")
    centred = fit_scaler(emb, "embedding", "z", with_mean=True).transform(emb)
    scaled = fit_scaler(emb, "embedding", "s", with_mean=False).transform(centred)
    from pyspark.ml.functions import vector_to_array
    z = scaled.select("vec_id", F.arrays_zip(vector_to_array("z").alias("z"),
                                             vector_to_array("s").alias("s")).alias("zs"))
    z = z.select("vec_id", F.posexplode("zs").alias("i", "v"))
    return z.select("vec_id", F.concat(F.lit("f"), F.col("i").cast("string")).alias("feature"),
                    _r("v.z").alias("z_center"), _r("v.s").alias("z_scale"))


def q_score_quantile(spark, sf_dir):
    """The 1 % quantile of the anomaly score (interpolated, exact)."""
    q = metrics.score_quantile(soft_scored(spark, sf_dir), "anomaly_score", 0.01)
    return q.select(_r("quantile").alias("quantile"))


def q_label_domain(spark, sf_dir):
    """A8 + P7: the distinct values of the label columns."""
    lab = read_table(spark, sf_dir, "labels")
    return (metrics.distinct_values(lab.select(F.col("quality").alias("label")), "label")
            .unionByName(metrics.distinct_values(lab.select(F.col("toxic").alias("label")),
                                                 "label"))
            .distinct())


# --------------------------------------------------------------- sampling
def _lineitem_keyed(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.withColumn("u", sample.uniform_from_key(
        F.col("l_orderkey") * 8 + F.col("l_linenumber")))


LINEITEM_ORDER = ["u", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                  "l_quantity", "l_extendedprice"]
LINEITEM_OUT = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                "l_extendedprice"]


def q_hash_sample(spark, sf_dir):
    li = _lineitem_keyed(spark, sf_dir)
    return sample.hash_sample(li, "u", 0.1).select(*LINEITEM_OUT, _r("u").alias("u"))


def q_hash_split(spark, sf_dir):
    li = _lineitem_keyed(spark, sf_dir)
    return sample.hash_split(li, "u", 0.8).select(*LINEITEM_OUT, "split")


def q_class_capped_sample(spark, sf_dir):
    li = _lineitem_keyed(spark, sf_dir)
    out = sample.class_capped_sample(li, "l_returnflag", 5000, LINEITEM_ORDER)
    return out.select("l_returnflag", *LINEITEM_OUT)


def q_ordered_limit(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return sample.ordered_limit(ev, 500, ["event_id"]).select(
        "event_id", _ts("ts", TS_FMT_US).alias("ts"), "value")


DUPLICATE_CAP, DUPLICATE_SALTS = 2000, 16


def q_duplicate_sample(spark, sf_dir):
    """U5 with a third of all rows equal: sampled in proportion, few candidates, even salts."""
    from vigil.session import scratch_path
    li = read_table(spark, sf_dir, "lineitem")
    copy = F.col("l_orderkey") % 3 == 0
    features = [F.when(copy, F.lit(0)).otherwise(F.col(c)).cast("double").alias(c)
                for c in ("l_quantity", "l_extendedprice", "l_partkey")]
    rows = li.select("l_returnflag", copy.alias("copy"), *features).select(
        "*", F.xxhash64("l_returnflag", "l_quantity", "l_extendedprice", "l_partkey",
                        F.monotonically_increasing_id()).alias("_key"))
    path = scratch_path(spark, "duplicate_sample")
    rows.write.parquet(path)
    rows = spark.read.parquet(path).withColumn("u", sample.uniform_from_key("_key"))
    cand = sample.hash_prefix(rows, "u", DUPLICATE_CAP, "l_returnflag", materialize=True)
    taken = sample.class_capped_sample(cand, "l_returnflag", DUPLICATE_CAP, ["u", "_key"],
                                       salts=DUPLICATE_SALTS, uniform_first=False)
    c = "l_returnflag"
    all_rows = rows.groupBy(c).agg(F.count("*").alias("n_rows"), F.count_if("copy").alias("n_copies"))
    salted = cand.withColumn("salt", sample.salt_of(DUPLICATE_SALTS)).groupBy(c, "salt").agg(F.count("*").alias("n")) \
        .groupBy(c).agg(F.sum("n").alias("n_cand"), F.max("n").alias("most"))
    got = taken.groupBy(c).agg(F.count("*").alias("n_sampled"), F.count_if("copy").alias("k"))
    share = F.col("n_copies") / F.col("n_rows")
    spread = 6 * F.sqrt(F.col("n_sampled") * share * (1 - share)) + 1
    return all_rows.join(salted, c).join(got, c).select(
        c, "n_rows", "n_copies", "n_sampled",
        (F.col("n_cand") <= F.least(F.col("n_rows"), F.lit(2 * DUPLICATE_CAP))).alias("candidates_ok"),
        (F.col("most") <= 2 * F.col("n_cand") / DUPLICATE_SALTS + 4).alias("salts_ok"),
        (F.abs(F.col("k") - F.col("n_sampled") * share) <= spread).alias("proportion_ok"))


def q_benign_cap(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").withColumn(
        "label", (F.col("event_type") == "error").cast("int"))
    ev = ev.withColumn("u", sample.uniform_from_key(F.col("event_id")))
    out = sample.benign_cap(ev, 3000, ["u", "event_id"], min_rows=100)
    return out.select("event_id", "value")


# --------------------------------------------------------------- cleaning
def planted_text(c: str, shift: int):
    """Text form of a numeric column with bad values planted deterministically."""
    b = F.pmod(F.col("l_orderkey") + F.lit(shift), F.lit(97))
    return (F.when(b == 1, F.lit("x")).when(b == 2, F.lit("NaN"))
            .when(b == 3, F.lit("Infinity")).when(b == 4, F.lit("-Infinity"))
            .when(b == 5, F.lit(None).cast("string")).when(b == 6, F.lit('"2.5"'))
            .when(b == 7, F.lit("1e39")).otherwise(F.col(c).cast("string")))


def _planted_lineitem(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    li = li.select(*LINEITEM_OUT[:4], planted_text("l_quantity", 0).alias("q"),
                   planted_text("l_extendedprice", 50).alias("e"))
    return clean.coerce_numeric(li, ["q", "e"])


def q_clean_features(spark, sf_dir):
    li = _planted_lineitem(spark, sf_dir)
    li = li.withColumn("row_finite", clean.all_finite(["q", "e"]))
    li = clean.zero_nonfinite(li, ["q", "e"])
    return li.select(*LINEITEM_OUT[:4], _r("q").alias("q"), _r("e").alias("e"),
                     "row_finite")


def q_finite_rows(spark, sf_dir):
    li = clean.drop_nonfinite(_planted_lineitem(spark, sf_dir), ["q", "e"])
    return li.select(*LINEITEM_OUT[:4], _r("q").alias("q"), _r("e").alias("e"))


QUERIES = {
    "rule_alert_simple": q_rule_alert_simple,
    "rule_alert_compound": q_rule_alert_compound,
    "alert_counts": q_alert_counts,
    "json_decode_flatten": q_json_decode_flatten,
    "event_envelope": q_event_envelope,
    "event_json_encode": q_event_json_encode,
    "replay_payload": q_replay_payload,
    "confusion_window": q_confusion_window,
    "soft_alerts": q_soft_alerts,
    "confusion_flags": q_confusion_flags,
    "class_name": q_class_name,
    "class_counts": q_class_counts,
    "label_vocab": q_label_vocab,
    "multiclass_metrics": q_multiclass_metrics,
    "pair_metrics": q_pair_metrics,
    "decision_cascade": q_decision_cascade,
    "feature_stats": q_feature_stats,
    "score_quantile": q_score_quantile,
    "label_domain": q_label_domain,
    "standardize": q_standardize,
    "hash_sample": q_hash_sample,
    "hash_split": q_hash_split,
    "class_capped_sample": q_class_capped_sample,
    "ordered_limit": q_ordered_limit,
    "benign_cap": q_benign_cap,
    "duplicate_sample": q_duplicate_sample,
    "clean_features": q_clean_features,
    "finite_rows": q_finite_rows,
}


def _register_streams():
    from vigil.plans.models import MODEL_QUERIES
    from vigil.plans.staged import STAGED_QUERIES
    from vigil.plans.streams import STREAM_QUERIES
    QUERIES.update(STREAM_QUERIES)
    QUERIES.update(STAGED_QUERIES)
    QUERIES.update(MODEL_QUERIES)
    from vigil.plans.roundtrips import ROUNDTRIP_QUERIES
    QUERIES.update(ROUNDTRIP_QUERIES)
    from vigil.plans.model_checks import CHECK_QUERIES
    QUERIES.update(CHECK_QUERIES)


_register_streams()


QUERY_OPERATORS = {
    "rule_alert_simple": "R1, P16, A1 (predicate pushed into the scan)",
    "rule_alert_compound": "R2, F1, S9",
    "alert_counts": "A1 (one pass)",
    "json_decode_flatten": "S9, F11, P8",
    "event_envelope": "S8, P19, P20",
    "event_json_encode": "K3, K4, F11",
    "replay_payload": "K3, P10 (planted NaN, text and '1.0' labels)",
    "confusion_window": "A2, A3, W2, R7, R8",
    "soft_alerts": "R3-R6, J2, F9",
    "confusion_flags": "R7, R8, P15",
    "class_name": "P9, P13, P14, P15",
    "class_counts": "A6",
    "label_vocab": "M1, M2, U7",
    "multiclass_metrics": "A4, M8",
    "pair_metrics": "A4",
    "decision_cascade": "R9, R2, F2",
    "feature_stats": "A5",
    "feature_stats_incremental": "A5 (a state of moments, capture by capture)",
    "score_quantile": "A9",
    "label_domain": "A8, P7",
    "standardize": "M4, M5",
    "hash_sample": "U2",
    "hash_split": "U4",
    "class_capped_sample": "U5",
    "ordered_limit": "U3",
    "benign_cap": "U6, P17",
    "duplicate_sample": "U5 (a third of the rows equal)",
    "clean_features": "P8, P10, P12",
    "finite_rows": "P10, P11",
    "confusion_window_stream": "W1-W5, W7, A2, A3",
    "stream_dedup": "W10 (the replay comes in later batches)",
    "late_rows": "W4, W2, W5 (ordered batches, late rows planted in the last)",
    "rate_limited_stream": "W5, W11",
    "daily_upsert": "K8, F14",
    "daily_metrics": "K9, W1-W3",
    "positional_label_join": "J1, P22, S3, P6",
    "label_parse_guard": "S3, P5-P7",
    "union_tagged_sources": "U1, P4, S2",
    "build_dataset": "S2, S3, P1-P7, P22, J1, U1, K1",
    "source_counts": "A7",
    "rf_score": "M1, M3, M4, M6, M7, S10, K10, R3-R8",
    "stream_score": "K3, S8, S9, W5-W9, W11, M7, R3-R8, P19-P21",
    "labelled_csv": "S1, S6, K2",
    "inferred_capture": "S4",
    "feature_array": "P18, P12",
    "enriched_json": "K4, P19-P21, S9",
    "ensemble_json": "K5, R9",
    "metrics_json": "K6, A2, A3",
    "class_index": "M1, M2, F15",
    "rf_check": "M1, M3, M6, M7, K10, S10, R3-R6 (recomputed from the node tables)",
    "iforest_check": "M9, X1, X2, A9 (recomputed from the node table)",
    "lr_check": "M10, X3, M2 (recomputed from the coefficients)",
    "score_metrics": "W1-W3, W5, W8, W9 (metrics of the scoring job, listener counts)",
    "paced_replay": "K3 (so many rows a batch, restarted half way)",
    "artifacts_check": "K11 (saved, loaded, scored again)",
    "gbt_check": "M11, X4 (scores from the node tables, leaves from their rows)",
    "stream_score_check": "K3, S8, S9, W5-W9, W11, M7 (stream equals batch)",
    "iforest_score": "M9, X1, X2, A9, M5, U6",
    "lr_score": "M10, X3, M2, U5",
    "gbt_score": "M11, X4, M2, U5",
    "ensemble_decision": "M9-M11, R2, R9, X1-X4",
    "gbt_score_10x4": "M11, X4, M2, U5 (10 rounds of depth 4)",
    "ensemble_decision_10x4": "M9-M11, R2, R9, X1-X4 (10 rounds of depth 4)",
}
