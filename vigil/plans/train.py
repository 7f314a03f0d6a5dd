"""Offline training job for the random-forest bundle (M12 argument surface).

    python -m vigil.plans.train --input PATH --model_dir DIR [--format csv|parquet]
        [--sample_frac 1.0] [--limit_rows 0] [--num_trees 80] [--max_depth 12]
        [--seed 42] [--n_features 115]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from vigil.ml.bundle import save_bundle
from vigil.ml.forest import ForestConfig, bundle_metadata, train_forest
from vigil.operators.clean import class_name, fill_attack_name, fill_features
from vigil.schema import (N_FEATURES_DEFAULT, RF_MAX_DEPTH, RF_NUM_TREES, RF_SEED,
                          feature_names)
from vigil.sources.capture import read_labelled


@dataclass(frozen=True)
class TrainJob:
    input: str
    model_dir: str
    fmt: str = "csv"
    n_features: int = N_FEATURES_DEFAULT
    forest: ForestConfig = ForestConfig()


def parse_args(argv: Sequence[str] | None = None) -> TrainJob:
    ap = argparse.ArgumentParser(description="train the random-forest bundle")
    ap.add_argument("--input", "--input_csv", dest="input", required=True)
    ap.add_argument("--model_dir", required=True)
    ap.add_argument("--format", choices=["csv", "parquet"], default="csv")
    ap.add_argument("--sample_frac", type=float, default=1.0)
    ap.add_argument("--limit_rows", type=int, default=0)
    ap.add_argument("--num_trees", type=int, default=RF_NUM_TREES)
    ap.add_argument("--max_depth", type=int, default=RF_MAX_DEPTH)
    ap.add_argument("--seed", type=int, default=RF_SEED)
    ap.add_argument("--n_features", type=int, default=N_FEATURES_DEFAULT)
    a = ap.parse_args(argv)
    return TrainJob(a.input, a.model_dir, a.format, a.n_features,
                    ForestConfig(a.num_trees, a.max_depth, a.seed, a.sample_frac, a.limit_rows))


def training_frame(spark: SparkSession, job: TrainJob) -> DataFrame:
    """Declared-schema read, P8 + P9 cleaning, P14 class column."""
    feats = feature_names(job.n_features)
    if job.fmt == "csv":
        df = read_labelled(spark, job.input, job.n_features)
    else:
        df = spark.read.parquet(job.input)
        if "label" not in df.columns and "label_binary" in df.columns:
            df = df.withColumnRenamed("label_binary", "label")
    df = fill_attack_name(fill_features(df, feats))
    return df.withColumn("class_name", class_name())


def run(spark: SparkSession, job: TrainJob) -> dict:
    feats = feature_names(job.n_features)
    model, labels, scores, _ = train_forest(training_frame(spark, job), feats, job.forest)
    meta = bundle_metadata(job.forest, job.input, scores, job.n_features, spark.version)
    save_bundle(spark, job.model_dir, model, labels, meta)
    return {"labels": labels, **scores}


def main(argv: Sequence[str] | None = None) -> None:
    from vigil.session import get_spark
    job = parse_args(argv)
    spark = get_spark("vigil-train")
    res = run(spark, job)
    print(f"Model saved to {job.model_dir}/pipeline; labels={res['labels']}; "
          f"accuracy={res['accuracy']:.4f}, f1={res['f1']:.4f}")


if __name__ == "__main__":
    main()
