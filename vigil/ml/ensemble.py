"""Scaler + isolation forest + logistic regression + boosted trees.

The reference trains these on one machine and scores them through four
Python UDFs that each re-run the scaler.  Here the scaler is fitted once
with MLlib, LR is an MLlib model applied in the JVM, and the isolation forest
and the boosted trees (:mod:`vigil.ml.boost`, one joint softmax booster) run in
one Arrow UDF each per batch.

Training data, as in the reference:
* scaler     : every row whose features are all finite;
* iso forest : benign rows (null label counts as attack), capped in hash
               order (reference: first rows in file order), min count checked;
* LR / GBT   : at most ``per_class`` rows per class in hash order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.columns import hash_uniform
from vigil.ml.boost import BoostConfig, BoostModel, fit_boost, score_boost
from vigil.ml.iforest import IsolationForestModel, fit_iforest, score_iforest
from vigil.ml.scaling import ArrayScaler, fit_scaler
from vigil.operators import rules, sample
from vigil.functions.columns import f32_finite
from vigil.operators.align import frozen
from vigil.operators.clean import zero_nonfinite_array
from vigil.schema import (BENIGN, BENIGN_CAP, BENIGN_MIN, COMPOUND_RULE_F1, COMPOUND_RULE_F2,
                          GBT_DEPTH, GBT_ROUNDS, GBT_STEP, GBT_SUBSAMPLE, ISO_CONTAMINATION,
                          ISO_MAX_SAMPLES, ISO_TREES, LR_MAX_ITER, PER_CLASS_CAP, RF_SEED)


ROWS_PER_PARTITION = 100_000
ROWS_AT_LEAST = 5_000


@dataclass(frozen=True)
class EnsembleConfig:
    n_trees: int = ISO_TREES
    contamination: float = ISO_CONTAMINATION
    max_samples: int = ISO_MAX_SAMPLES
    benign_cap: int = BENIGN_CAP
    benign_min: int = BENIGN_MIN
    per_class: int = PER_CLASS_CAP
    lr_max_iter: int = LR_MAX_ITER
    gbt_rounds: int = GBT_ROUNDS
    gbt_depth: int = GBT_DEPTH
    gbt_step: float = GBT_STEP
    gbt_subsample: float = GBT_SUBSAMPLE
    seed: int = RF_SEED
    rule_predicates: tuple = (f"f1 > {COMPOUND_RULE_F1}", f"f2 > {COMPOUND_RULE_F2}")


@dataclass
class EnsembleModel:
    scaler: ArrayScaler
    iforest: IsolationForestModel | None
    lr: PipelineModel | None = None
    gbt: BoostModel | None = None
    classes: list = field(default_factory=list)


def _prepared(df: DataFrame, features_col: str) -> DataFrame:
    return df.withColumn("__x", zero_nonfinite_array(features_col))


def fit_ensemble(df: DataFrame, features_col: str, key_col: str,
                 cfg: EnsembleConfig = EnsembleConfig(), label: str = "label",
                 attack: str = "attack_name", with_lr: bool = True,
                 with_gbt: bool = True, with_iforest: bool = True) -> EnsembleModel:
    """``df``: features as ARRAY<DOUBLE>, a unique integer key, label, attack name."""
    finite = F.forall(features_col, lambda x: f32_finite(x.cast("double")))
    clean = df.filter(finite)
    scaler = fit_scaler(clean, features_col, "__z")
    scaled = scaler.transform(clean).withColumn("__zx", _vec_to_arr("__z"))
    scaled = scaled.withColumn("u", hash_uniform(F.col(key_col), cfg.seed))
    labelled = scaled.withColumn("__label", F.coalesce(F.col(label).cast("int"), F.lit(1)))
    labelled = labelled.withColumn(
        "class_name", F.when(F.col("__label") == 0, F.lit(BENIGN))
        .otherwise(F.coalesce(F.col(attack), F.lit("unknown"))))
    # one exact hash cut serves both samples (benign cap for the forest,
    # per-class cap for LR / GBT); it is frozen once, so the big input is
    # read twice here (counts, cut) and everything after reads the bounded
    # candidate table
    caps = {BENIGN: cfg.benign_cap} if with_iforest else {}
    per_class = cfg.per_class if (with_lr or with_gbt) else 0
    cand = sample.hash_prefix(labelled, "u", per_class, "class_name", caps, materialize=True)
    # the three models only share the frozen candidates: fit them side by
    # side from driver threads (Spark runs jobs of several threads at once)
    from concurrent.futures import ThreadPoolExecutor
    model = EnsembleModel(scaler, None)
    with ThreadPoolExecutor(max_workers=3) as pool:
        iso_f = pool.submit(_fit_iso, cand, key_col, cfg) if with_iforest else None
        clf_f = (pool.submit(_fit_classifiers, cand, key_col, cfg, with_lr, with_gbt)
                 if (with_lr or with_gbt) else None)
        if iso_f is not None:
            model.iforest = iso_f.result()
        if clf_f is not None:
            model.lr, model.gbt, model.classes = clf_f.result()
    return model


def _fit_iso(cand: DataFrame, key_col: str, cfg: EnsembleConfig) -> IsolationForestModel:
    """Isolation forest on benign rows (null label counts as attack), capped."""
    benign = sample.benign_cap(cand, cfg.benign_cap, ["u", key_col], "__label", cfg.benign_min)
    return fit_iforest(benign, "__zx", key_col, cfg.n_trees, cfg.max_samples,
                       cfg.contamination, cfg.seed)


def _fit_classifiers(cand: DataFrame, key_col: str, cfg: EnsembleConfig, with_lr: bool,
                     with_gbt: bool):
    """LR and softmax boosted trees on the per-class capped sample."""
    train = sample.class_capped_sample(cand, "class_name", cfg.per_class, ["u", key_col],
                                       materialize=False)   # cand is frozen already
    train = train.withColumn("features", array_to_vector("__zx")).select(
        "features", "class_name")
    # the capped set is bounded (per_class x classes): size its partitions to
    # the cores at hand, of 5k to 100k rows each
    n_train = train.count()
    if n_train == 0:
        raise ValueError("no rows sampled for the classifiers (all features non-finite?)")
    cores = train.sparkSession.sparkContext.defaultParallelism
    parts = max(math.ceil(n_train / ROWS_PER_PARTITION), min(cores, math.ceil(n_train / ROWS_AT_LEAST)))
    # written to the shared folder: a lost executor does not sample and split again
    train = frozen(train.repartition(max(1, parts)))
    # M2: alphabetical class index, fitted once and shared by both models
    indexer = StringIndexer(inputCol="class_name", outputCol="y",
                            stringOrderType="alphabetAsc").fit(train)
    classes = list(indexer.labels)
    indexed = indexer.transform(train)

    def fit_lr():
        lr = LogisticRegression(featuresCol="features", labelCol="y", family="multinomial",
                                maxIter=cfg.lr_max_iter, standardization=False,
                                regParam=1.0 / max(n_train, 1))
        return PipelineModel(stages=[indexer, lr.fit(indexed)])

    def fit_gbt():
        boost = BoostConfig(cfg.gbt_rounds, cfg.gbt_depth, cfg.gbt_step, cfg.gbt_subsample, cfg.gbt_subsample,
                            seed=cfg.seed)
        return fit_boost(indexed.select(_vec_to_arr("features").alias("x"), "y"), classes, boost)

    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=2) as pool:
        lr_f = pool.submit(fit_lr) if with_lr else None
        gbt_f = pool.submit(fit_gbt) if with_gbt else None
        lr_m = lr_f.result() if lr_f is not None else None
        gbt_m = gbt_f.result() if gbt_f is not None else None
    return lr_m, gbt_m, classes


def _vec_to_arr(c: str):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(c))


def _predict_names(fitted: PipelineModel | None, df: DataFrame, out: str) -> DataFrame:
    """Class names from a fitted (indexer, classifier) pipeline; null if absent."""
    if fitted is None:
        return df.withColumn(out, F.lit(None).cast("string"))
    clf = fitted.stages[-1]
    labels = fitted.stages[0].labels
    pred = clf.transform(df.withColumn("features", array_to_vector("__zx")))
    pred = IndexToString(inputCol=clf.getPredictionCol(), outputCol=out,
                         labels=labels).transform(pred)
    drop = [c for c in (clf.getPredictionCol(), "rawPrediction", "probability", "features")
            if c in pred.columns]
    return pred.drop(*drop)


def score_ensemble(df: DataFrame, model: EnsembleModel, features_col: str,
                   f1: str = "f1", f2: str = "f2",
                   rule_predicates: tuple | None = None) -> DataFrame:
    """X1-X4 + R2 + R9: rule, iso score / flag, LR and GBT classes, final decision."""
    x = _prepared(df, features_col)
    x = _scale(model.scaler, x)
    preds = rule_predicates or (f"{f1} > {COMPOUND_RULE_F1}", f"{f2} > {COMPOUND_RULE_F2}")
    x = rules.any_rule(x, list(preds))
    if model.iforest is not None:
        x = score_iforest(x, model.iforest, "__zx")
    else:
        x = x.withColumns({"iso_raw": F.lit(None).cast("double"),
                           "iso_score": F.lit(None).cast("double"),
                           "iso_is_anom": F.lit(None).cast("int")})
    x = _predict_names(model.lr, x, "pred_lr")
    x = score_boost(x, model.gbt, "__zx", "pred_xgb") if model.gbt is not None \
        else x.withColumn("pred_xgb", F.lit(None).cast("string"))
    x = rules.decision_cascade(x)
    return x.drop("__x", "__z", "__zx", "iso_raw")


def _scale(scaler: ArrayScaler, x: DataFrame) -> DataFrame:
    out = ArrayScaler(scaler.model, "__x").transform(x)
    return out.withColumn("__zx", _vec_to_arr(scaler.model.getOutputCol())).drop(
        scaler.model.getOutputCol())


def save_ensemble(spark, model: EnsembleModel, path: str) -> None:
    """Every artifact as a Spark model folder (no joblib files)."""
    from vigil.ml.bundle import write_json
    d = path.rstrip("/")
    model.scaler.model.write().overwrite().save(f"{d}/scaler")
    if model.iforest is not None:
        model.iforest.save(spark, f"{d}/iso_forest")
    if model.lr is not None:
        model.lr.write().overwrite().save(f"{d}/attack_classifier_lr")
    if model.gbt is not None:
        model.gbt.save(spark, f"{d}/attack_classifier_gbt")
    write_json(spark, f"{d}/classes.json", {"classes": model.classes,
                                            "has_iforest": model.iforest is not None,
                                            "has_lr": model.lr is not None,
                                            "has_gbt": model.gbt is not None})


def load_ensemble(spark, path: str, array_col: str = "features") -> EnsembleModel:
    from pyspark.ml.feature import StandardScalerModel
    from vigil.ml.bundle import read_json
    d = path.rstrip("/")
    meta = read_json(spark, f"{d}/classes.json")
    scaler = ArrayScaler(StandardScalerModel.load(f"{d}/scaler"), array_col)
    iso = (IsolationForestModel.load(spark, f"{d}/iso_forest")
           if meta.get("has_iforest", True) else None)
    lr = PipelineModel.load(f"{d}/attack_classifier_lr") if meta["has_lr"] else None
    gbt = BoostModel.load(spark, f"{d}/attack_classifier_gbt") if meta["has_gbt"] else None
    return EnsembleModel(scaler, iso, lr, gbt, meta["classes"])
