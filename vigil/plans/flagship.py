"""Flagship query: score -> alert layer -> truth -> summary per true class."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators import rules


def alert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigil.plans.catalog import soft_scored
    s = rules.truth_layer(soft_scored(spark, sf_dir))
    return (s.groupBy("true_class", "rule_alert", "severity")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum("tp").cast("bigint").alias("tp"),
                 F.sum("fp").cast("bigint").alias("fp"),
                 F.sum("fn").cast("bigint").alias("fn"),
                 F.sum("tn").cast("bigint").alias("tn"),
                 F.round(F.avg("anomaly_score"), 9).alias("mean_anomaly_score")))
