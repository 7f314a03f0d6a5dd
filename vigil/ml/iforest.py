"""Isolation forest as a Spark job.

Liu, Ting & Zhou, "Isolation Forest", ICDM 2008.

fit:
  1. a hash keeps a pool of about 4 * trees * psi fit rows; every pooled row
     draws a hash per tree and per tree the ``psi`` rows with the smallest
     hash form its subsample (a filter keeps about 2*psi candidates per
     tree, then a per-tree row_number limit);
  2. ``groupBy(tree).applyInPandas`` grows one tree per group (<= 2*psi rows,
     whatever the data size) and emits its node table;
  3. the node table (trees x (2*psi - 1) rows at most, independent of the
     data size) is the model; it is broadcast for scoring;
  4. the offset is the ``contamination`` quantile of the fit rows' scores.
score:
  one Arrow-batched pandas UDF returns (score, is_anomaly) together, with
  score = -(2 ** (-E[h(x)] / c(psi))) - offset, higher = more normal, and
  anomaly when score < 0 (the convention of the reference's scorer).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StructField,
                               StructType)

from vigil.schema import ISO_CONTAMINATION, ISO_MAX_SAMPLES, ISO_TREES, RF_SEED  # noqa: E402

EULER_GAMMA = 0.5772156649015329

NODE_SCHEMA = StructType([
    StructField("tree", IntegerType()), StructField("node", IntegerType()),
    StructField("feature", IntegerType()), StructField("threshold", DoubleType()),
    StructField("left", IntegerType()), StructField("right", IntegerType()),
    StructField("size", LongType()), StructField("depth", IntegerType()),
])


def average_path_length(n):
    """c(n): mean path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=np.float64)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + EULER_GAMMA) - 2.0 * (nb - 1.0) / nb
    return out


def grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Grow one isolation tree; -> rows (node, feature, threshold, left, right, size, depth)."""
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, -1, False)]
    while stack:
        idx, depth, parent, is_right = stack.pop()
        node_id = len(nodes)
        nodes.append([node_id, -1, 0.0, -1, -1, len(idx), depth])
        if parent >= 0:
            nodes[parent][4 if is_right else 3] = node_id
        if len(idx) <= 1 or depth >= max_depth:
            continue
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            continue
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] <= thr
        nodes[node_id][1], nodes[node_id][2] = f, thr
        stack.append((idx[~go_left], depth + 1, node_id, True))
        stack.append((idx[go_left], depth + 1, node_id, False))
    return [tuple(n) for n in nodes]


def _stack_features(col: pd.Series) -> np.ndarray:
    return np.vstack(col.to_numpy()).astype(np.float64)


@dataclass
class IsolationForestModel:
    nodes: pd.DataFrame          # NODE_SCHEMA rows
    psi: int
    offset: float = 0.0
    n_trees: int = 0

    def arrays(self):
        """Dense per-tree arrays, padded to the largest tree."""
        t = self.nodes.sort_values(["tree", "node"])
        n_max = int(t.groupby("tree")["node"].max().max()) + 1
        trees = sorted(t["tree"].unique())
        shape = (len(trees), n_max)
        feat = np.full(shape, -1, np.int32)
        thr = np.zeros(shape)
        left = np.full(shape, -1, np.int32)
        right = np.full(shape, -1, np.int32)
        depth = np.zeros(shape)
        size = np.zeros(shape)
        for i, (_, g) in enumerate(t.groupby("tree", sort=True)):
            k = g["node"].to_numpy()
            feat[i, k] = g["feature"].to_numpy()
            thr[i, k] = g["threshold"].to_numpy()
            left[i, k] = g["left"].to_numpy()
            right[i, k] = g["right"].to_numpy()
            depth[i, k] = g["depth"].to_numpy()
            size[i, k] = g["size"].to_numpy()
        leaf_len = depth + average_path_length(size)
        return feat, thr, left, right, leaf_len

    def save(self, spark: SparkSession, path: str) -> None:
        from vigil.ml.bundle import write_json
        spark.createDataFrame(self.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(
            f"{path}/nodes")
        write_json(spark, f"{path}/params", {"psi": self.psi, "offset": self.offset,
                                             "n_trees": self.n_trees})

    @staticmethod
    def load(spark: SparkSession, path: str) -> "IsolationForestModel":
        from vigil.ml.bundle import read_json
        p = read_json(spark, f"{path}/params")
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        return IsolationForestModel(nodes, p["psi"], p["offset"], p["n_trees"])


def raw_scores(x: np.ndarray, arrays, psi: int) -> np.ndarray:
    """-(2 ** (-mean path length / c(psi))) for each row of x.

    All trees are walked at once: ``node`` is a rows x trees index matrix
    advanced one level per step, so the loop runs tree depth times (at most
    ceil(log2 psi) + 1), not trees x depth times.
    """
    feat, thr, left, right, leaf_len = arrays
    n, t = x.shape[0], feat.shape[0]
    trees = np.broadcast_to(np.arange(t), (n, t))
    rows = np.broadcast_to(np.arange(n)[:, None], (n, t))
    node = np.zeros((n, t), np.int32)
    while True:
        f = feat[trees, node]
        inner = f >= 0
        if not inner.any():
            break
        xv = x[rows, np.where(inner, f, 0)]
        go_left = xv <= thr[trees, node]
        nxt = np.where(go_left, left[trees, node], right[trees, node])
        node = np.where(inner, nxt, node)
    mean_len = leaf_len[trees, node].sum(axis=1) / t
    return -np.power(2.0, -mean_len / average_path_length([psi])[0])


def fit_iforest(df: DataFrame, features_col: str, key_col: str, n_trees: int = ISO_TREES,
                max_samples: int = ISO_MAX_SAMPLES, contamination: float = ISO_CONTAMINATION,
                seed: int = RF_SEED) -> IsolationForestModel:
    """Fit on ``df`` (already cleaned, scaled and capped by the caller)."""
    spark = df.sparkSession
    n = df.count()
    if n == 0:
        raise ValueError("isolation forest needs at least one row")
    psi = int(min(max_samples, n))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    # a pool of about 4 * trees * psi rows holds every tree's candidates, so
    # only the pool is exploded per tree, however large the fit set is
    pool = min(1.0, 4.0 * n_trees * psi / n)
    keep = min(1.0, (2.0 * psi + 64.0) / (n * pool))
    base = df.select(F.col(key_col).alias("_key"), F.col(features_col).alias("x"))
    if pool < 1.0:
        base = base.filter(F.abs(F.xxhash64("_key", F.lit(-1), F.lit(seed)))
                           / F.lit(float(2 ** 63)) < F.lit(pool))
    cand = (base.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
            .withColumn("_h", F.xxhash64("_key", "tree", F.lit(seed)))
            .filter(F.abs(F.col("_h")) / F.lit(float(2 ** 63)) < F.lit(keep)))
    w = Window.partitionBy("tree").orderBy("_h", "_key")
    sub = cand.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= psi)

    def _grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = _stack_features(pdf.sort_values(["_h", "_key"])["x"])
        rng = np.random.default_rng([seed, tree])
        rows = grow_tree(x, rng, max_depth)
        out = pd.DataFrame(rows, columns=["node", "feature", "threshold", "left", "right",
                                          "size", "depth"])
        out.insert(0, "tree", tree)
        return out.astype({"tree": "int32", "node": "int32", "feature": "int32",
                           "left": "int32", "right": "int32", "size": "int64",
                           "depth": "int32"})

    nodes = (sub.select("tree", "_h", "_key", "x").groupBy("tree")
             .applyInPandas(_grow, NODE_SCHEMA).toPandas())
    model = IsolationForestModel(nodes, psi, 0.0, n_trees)
    # the fit rows' scores feed several aggregate passes: compute them once
    from vigil.operators.align import frozen
    scored = frozen(score_iforest(df, model, features_col, spark=spark).select("iso_raw"))
    # exact interpolated quantile, as the reference computes it
    from vigil.operators.metrics import exact_quantile
    q = exact_quantile(scored, "iso_raw", contamination).first()["quantile"]
    model.offset = float(q)
    return model


def score_iforest(df: DataFrame, model: IsolationForestModel, features_col: str,
                  spark: SparkSession | None = None, score_col: str = "iso_score",
                  anom_col: str = "iso_is_anom") -> DataFrame:
    """Adds iso_raw, iso_score (= raw - offset) and iso_is_anom (score < 0)."""
    spark = spark or df.sparkSession
    bc = spark.sparkContext.broadcast((model.arrays(), model.psi, model.offset))

    @F.pandas_udf("raw double, score double, anom int")
    def _score(col: pd.Series) -> pd.DataFrame:
        arrays, psi, offset = bc.value
        x = _stack_features(col)
        raw = raw_scores(x, arrays, psi)
        score = raw - offset
        return pd.DataFrame({"raw": raw, "score": score,
                             "anom": (score < 0).astype(np.int32)})

    out = df.withColumn("__iso", _score(F.col(features_col)))
    return out.withColumns({"iso_raw": F.col("__iso.raw"), score_col: F.col("__iso.score"),
                            anom_col: F.col("__iso.anom")}).drop("__iso")
