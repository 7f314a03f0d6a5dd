"""Registered model queries; their facts are checked in :mod:`vigil.plans.model_checks`.

All fit on the ``embeddings`` stand-in with the jobs' default settings and score
the whole table.  One thing differs, because of the stand-in: the least number
of benign rows (it has few).  The boosted trees run 300 rounds of depth 8, one tree a
class in each; ``gbt_score_10x4`` and ``ensemble_decision_10x4`` are the same queries with
10 rounds of depth 4.  The number of features is that of the data.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from vigil.ml.bundle import load_bundle, save_bundle
from vigil.ml.ensemble import EnsembleConfig, fit_ensemble, score_ensemble
from vigil.ml.forest import ForestConfig, bundle_metadata, score_events, train_forest
from vigil.session import scratch_path
from vigil.sources.tables import array_width, embedding_columns, embeddings_features

RF_CFG = ForestConfig()
ENS_CFG = EnsembleConfig(benign_min=10, rule_predicates=("f1 > 0.1", "f2 > 0.1"))
ENS_10X4 = replace(ENS_CFG, gbt_rounds=10, gbt_depth=4)


def _feature_rows(spark, sf_dir):
    e = embeddings_features(spark, sf_dir)
    e = embedding_columns(e, array_width(e))
    return e.withColumn("class_name", F.when(F.col("class_label") == 0, F.lit("benign"))
                        .otherwise(F.concat(F.lit("attack_"),
                                            F.col("class_label").cast("string"))))


def _feats(rows) -> list[str]:
    """The feature columns f0, f1, ... in order."""
    return [c for c in rows.columns if c[0] == "f" and c[1:].isdigit()]


def q_rf_score(spark, sf_dir):
    """Train -> save bundle -> load -> score."""
    rows = _feature_rows(spark, sf_dir)
    feats = _feats(rows)
    model, labels, scores, _ = train_forest(rows, feats, RF_CFG)
    d = scratch_path(spark, "rf_bundle")
    save_bundle(spark, d, model, labels,
                bundle_metadata(RF_CFG, f"{sf_dir}/embeddings.parquet", scores, len(feats),
                                spark.version))
    loaded, labels2, _ = load_bundle(spark, d)
    out = score_events(rows, loaded, labels2)
    return out.select("vec_id", "predicted_attack", "confidence", "p_benign",
                      "anomaly_score", "suspect", "rule_alert", "severity", "true_class",
                      "is_attack_true", "is_attack_pred", "fp", "fn", "tp", "tn")


def q_stream_score(spark, sf_dir):
    """K3 + S8 + S9 + W11 + M7 + R3-R8 + P19-P21: the streaming scoring job.

    The feature rows are replayed as raw-event JSON, scored by the forest
    bundle in a file-stream twin of the Kafka source (available-now, with
    the metrics query reading the enriched output), and the enriched events
    are returned (``processing_ts`` left out: it is the wall clock).
    """
    from vigil.plans.score import ScoreJob, start
    from vigil.sinks.kafka import replay_payload
    rows = _feature_rows(spark, sf_dir)
    feats = _feats(rows)
    model, labels, scores, _ = train_forest(rows, feats, RF_CFG)
    d = scratch_path(spark, "stream_score")
    save_bundle(spark, f"{d}/model", model, labels,
                bundle_metadata(RF_CFG, f"{sf_dir}/embeddings.parquet", scores, len(feats),
                                spark.version))
    replay_payload(rows, feats).write.text(f"{d}/in")
    job = ScoreJob(model_dir=f"{d}/model", checkpoint_dir=f"{d}/checkpoint", source="files",
                   input=f"{d}/in", output=f"{d}/out", n_features=len(feats),
                   enable_metrics=True, available_now=True, max_files_per_trigger=8)
    for q in start(spark, job):
        q.awaitTermination()
    return spark.read.parquet(f"{d}/out/events").drop("processing_ts")


def _ensemble_input(spark, sf_dir):
    e = embeddings_features(spark, sf_dir)
    return e.withColumns({
        "features": F.transform("embedding", lambda x: x.cast("double")),
        "f1": F.get("embedding", 1).cast("double"),
        "f2": F.get("embedding", 2).cast("double"),
    })


def _ensemble(spark, sf_dir, with_lr, with_gbt, with_iforest=True, cfg=ENS_CFG):
    rows = _ensemble_input(spark, sf_dir)
    m = fit_ensemble(rows, "features", "vec_id", cfg, with_lr=with_lr, with_gbt=with_gbt,
                     with_iforest=with_iforest)
    return score_ensemble(rows, m, "features", rule_predicates=cfg.rule_predicates)


def q_iforest_score(spark, sf_dir):
    """Isolation forest fitted on benign rows, all rows scored."""
    out = _ensemble(spark, sf_dir, False, False)
    return out.select("vec_id", "label", "iso_score", "iso_is_anom")


def q_lr_score(spark, sf_dir):
    """Multinomial logistic regression on the scaled features."""
    out = _ensemble(spark, sf_dir, True, False, with_iforest=False)
    return out.select("vec_id", "label", "attack_name", "pred_lr")


def q_gbt_score(spark, sf_dir, cfg=ENS_CFG):
    """Softmax boosted trees on the scaled features."""
    out = _ensemble(spark, sf_dir, False, True, with_iforest=False, cfg=cfg)
    return out.select("vec_id", "label", "attack_name", "pred_xgb")


def q_ensemble_decision(spark, sf_dir, cfg=ENS_CFG):
    """M9 + M10 + M11 + R2 + R9: the 11-column enriched form's decision fields."""
    out = _ensemble(spark, sf_dir, True, True, cfg=cfg)
    return out.select("vec_id", "rule_alert", "iso_score", "iso_is_anom", "pred_lr",
                      "pred_xgb", "pred_final")


def q_gbt_score_10x4(spark, sf_dir):
    """gbt_score with 10 rounds of depth 4: a quick run, not the reference settings."""
    return q_gbt_score(spark, sf_dir, ENS_10X4)


def q_ensemble_decision_10x4(spark, sf_dir):
    """ensemble_decision with 10 rounds of depth 4: a quick run, not the reference settings."""
    return q_ensemble_decision(spark, sf_dir, ENS_10X4)


MODEL_QUERIES = {
    "rf_score": q_rf_score,
    "stream_score": q_stream_score,
    "iforest_score": q_iforest_score,
    "lr_score": q_lr_score,
    "gbt_score": q_gbt_score,
    "ensemble_decision": q_ensemble_decision,
    "gbt_score_10x4": q_gbt_score_10x4,
    "ensemble_decision_10x4": q_ensemble_decision_10x4,
}
