"""Random-forest pipeline (M1, M3, M4, M6, M7, A4).

Pipeline = StringIndexer(class -> index, unseen kept) -> VectorAssembler ->
StandardScaler(std only) -> RandomForestClassifier.  The indexer is fitted
on the training split only (the reference fits it before splitting, which
lets test rows shape the vocabulary).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators import metrics, rules
from vigil.schema import (ANOMALY_THRESHOLD, BENIGN, CONFIDENCE_THRESHOLD, RF_MAX_DEPTH,
                          RF_NUM_TREES, RF_SEED)


@dataclass(frozen=True)
class ForestConfig:
    num_trees: int = RF_NUM_TREES
    max_depth: int = RF_MAX_DEPTH
    seed: int = RF_SEED
    sample_frac: float = 1.0
    limit_rows: int = 0
    class_col: str = "class_name"


def forest_pipeline(features: Sequence[str], cfg: ForestConfig) -> Pipeline:
    return Pipeline(stages=[
        StringIndexer(inputCol=cfg.class_col, outputCol="label_idx", handleInvalid="keep"),
        VectorAssembler(inputCols=list(features), outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features", withStd=True,
                       withMean=False),
        RandomForestClassifier(featuresCol="features", labelCol="label_idx",
                               numTrees=cfg.num_trees, maxDepth=cfg.max_depth,
                               seed=cfg.seed),
    ])


def train_forest(df: DataFrame, features: Sequence[str], cfg: ForestConfig = ForestConfig()):
    """-> (PipelineModel, labels, metrics dict, test predictions).

    ``df`` carries the features and ``cfg.class_col``.  It is persisted once
    after sampling so the split, the fit and the evaluation share one scan.
    """
    from vigil.operators.sample import bernoulli_sample, limit_rows, random_split
    data = limit_rows(bernoulli_sample(df, cfg.sample_frac, cfg.seed), cfg.limit_rows)
    data = data.persist()
    train, test = random_split(data, (0.8, 0.2), cfg.seed)
    model = forest_pipeline(features, cfg).fit(train)
    labels = list(model.stages[0].labels)
    if BENIGN not in labels:
        raise RuntimeError(f"'{BENIGN}' not found in labels: {labels}. "
                           "The data needs label == 0 rows.")
    pred = model.transform(test)
    m = metrics.multiclass_metrics(pred, "label_idx", "prediction").first()
    data.unpersist()
    return model, labels, {"accuracy": m["accuracy"], "f1": m["weighted_f1"]}, pred


def bundle_metadata(cfg: ForestConfig, source: str, scores: dict, n_features: int,
                    spark_version: str) -> dict:
    meta = {"created_at": datetime.now(timezone.utc).isoformat().replace("+00:00", "Z"),
            "input_csv": source, **{k: v for k, v in asdict(cfg).items() if k != "class_col"},
            "metrics": scores, "n_features": n_features, "spark_version": spark_version}
    return meta


def after_assembler(model):
    """The fitted stages that follow the VectorAssembler (scaler, forest)."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler
    stages = list(model.stages)
    cut = next(i for i, st in enumerate(stages) if isinstance(st, VectorAssembler))
    return PipelineModel(stages=stages[cut + 1:]), stages[cut].getOutputCol()


def score_events(df: DataFrame, model, labels: Sequence[str],
                 anomaly_threshold: float = ANOMALY_THRESHOLD,
                 confidence_threshold: float = CONFIDENCE_THRESHOLD,
                 pred_logic: str = "predicted_attack",
                 features_vector: str | None = None) -> DataFrame:
    """M7 + R3-R8: pipeline inference then the alert and truth layers.

    Works unchanged on a stream.  Only JVM expressions are involved.  With
    ``features_vector`` (a vector column already holding the raw features)
    the assembler is skipped, so 115 feature columns never have to exist as
    top-level columns (more than 100 fields switch whole-stage codegen off).
    """
    if features_vector is not None:
        rest, raw_col = after_assembler(model)
        scored = rest.transform(df.withColumnRenamed(features_vector, raw_col))
    else:
        scored = model.transform(df)
    scored = scored.withColumn("prob_arr", vector_to_array(F.col("probability")))
    scored = rules.alert_layer(scored, "prob_arr", labels, prediction_col="prediction",
                               anomaly_threshold=anomaly_threshold,
                               confidence_threshold=confidence_threshold)
    return rules.truth_layer(scored, pred_logic=pred_logic)
