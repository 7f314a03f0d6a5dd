"""Incremental feature statistics: a stored table of mergeable moments (A5, M5).

The state has one row for each source and feature: rows counted, mean, and the sum
of squared distances from that mean (M2).  Sources merge by

    n = sum n_i,  mean = sum n_i mean_i / n,  M2 = sum (M2_i + n_i (mean_i - mean)^2),

which loses no digits to large means.  Adding a capture reads that capture alone; adding
it again replaces its rows (a partition of the state each), so a repeated job changes
nothing.  The state is sources x features rows, whatever the captures hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.operators.clean import drop_nonfinite

STATE = "feature string, n bigint, mean double, m2 double, source string"


def feature_moments(df: DataFrame, cols: Sequence[str], source: str) -> DataFrame:
    """(feature, n, mean, m2, source) of a capture's rows, one aggregate pass.

    Rows with a non-finite feature are left out, as the reference leaves them out.
    """
    clean = drop_nonfinite(df, list(cols))
    wide = clean.agg(*[a for c in cols for a in (
        F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"),
        (F.var_pop(c) * F.count(c)).alias(f"{c}__m2"))])
    args = ", ".join(f"'{c}', `{c}__n`, `{c}__mean`, `{c}__m2`" for c in cols)
    long = wide.selectExpr(f"stack({len(cols)}, {args}) AS (feature, n, mean, m2)")
    return long.where("n > 0").withColumn("source", F.lit(source))


def add_capture(df: DataFrame, cols: Sequence[str], source: str, path: str) -> None:
    """Fold one capture into the state at ``path``; its own rows are replaced."""
    feature_moments(df, cols, source).coalesce(1).write.partitionBy("source") \
        .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_moments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(path)


def merged(state: DataFrame) -> DataFrame:
    """(feature, n, mean, std): all sources of a state, with the sample deviation."""
    each = Window.partitionBy("feature")
    whole = state.withColumn("_n", F.sum("n").over(each)) \
        .withColumn("_mean", F.sum(F.col("n") * F.col("mean")).over(each) / F.col("_n"))
    apart = F.col("mean") - F.col("_mean")
    out = whole.groupBy("feature").agg(F.first("_n").alias("n"), F.first("_mean").alias("mean"),
                                       F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"))
    return out.select("feature", "n", "mean",
                      F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"))


def standardized(df: DataFrame, cols: Sequence[str], stats: DataFrame) -> DataFrame:
    """M5 from merged moments: (x - mean) / std, and 0 for a feature that never varies."""
    by = {r["feature"]: r for r in stats.collect()}     # one row a feature
    missing = sorted(set(cols) - set(by))
    if missing:
        raise ValueError(f"no statistics for {missing[:5]}")

    def scaled(c):
        r = by[c]
        return (F.col(c) - F.lit(r["mean"])) / F.lit(r["std"]) if r["std"] else F.lit(0.0)
    return df.withColumns({c: scaled(c) for c in cols})
