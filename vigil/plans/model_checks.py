"""Model queries whose facts SQL can state: every row of every verdict is true.

SQL cannot refit a model, but each score can be recomputed as relations from
what the model stores: trees walked by joins with their node tables, logits as
sums over a coefficient table, a streamed score against the batch score of the
same row.  A query returns the row keys with one verdict for each such fact.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.ml.bundle import load_bundle, save_bundle
from vigil.ml.ensemble import fit_ensemble, score_ensemble
from vigil.ml.forest import bundle_metadata, score_events, train_forest
from vigil.ml.iforest import EULER_GAMMA, NODE_SCHEMA
from vigil.plans.models import ENS_CFG, RF_CFG, _ensemble_input, _feats, _feature_rows
from vigil.schema import (ALERT_HIGH, ALERT_LOW, ALERT_NONE, ANOMALY_THRESHOLD, CONFIDENCE_THRESHOLD,
                          SEVERITY_HIGH, SEVERITY_MEDIUM, SEVERITY_NONE)
from vigil.session import scratch_path

CLOSE = 1e-9
CHECKED_ROUND = 5
WALKED_ROWS = 4096


def walk(rows: DataFrame, nodes: DataFrame, n_trees: int, depth: int, key: str, x: str) -> DataFrame:
    """(key, tree, node) of the leaf that each row reaches in each tree.

    ``nodes`` (tree, node, feature, threshold, left, right), feature < 0 for a
    leaf; a model's node table is bounded by its trees and depth, so it is
    broadcast for each level.
    """
    at = rows.select(key, x).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1)))) \
        .withColumn("node", F.lit(0))
    for _ in range(depth):
        n = F.broadcast(nodes.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "feature",
                                     "threshold", "left", "right"))
        step = at.join(n, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")))
        down = F.when(F.get(x, F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = step.select(key, x, "tree", F.when(F.col("feature") < 0, F.col("node")).otherwise(down).alias("node"))
    return at.select(key, "tree", "node")


def walk_many(rows: DataFrame, nodes: pd.DataFrame, depth: int, key: str, x: str, sums: bool) -> DataFrame:
    """(key, tree, node) of ``walk`` for thousands of trees, or (key, cls, s): each row's sums of their values.

    Joins would make a row of each row, tree and level.  Here a node's number leads to its
    place in the node table, which every task has whole (bounded by trees and depth), and
    a batch of rows goes down one tree after the other.
    """
    t = nodes.sort_values(["tree", "node"], ignore_index=True)
    trees, first = np.unique(t.tree.to_numpy(), return_index=True)
    size = np.diff([*first, len(t)])
    if (t.node.to_numpy() != np.arange(len(t)) - np.repeat(first, size)).any():
        raise ValueError("a tree's nodes are numbered from 0 without gaps")
    table = [t[c].to_numpy() for c in ("feature", "threshold", "left", "right", "value")]
    bc = rows.sparkSession.sparkContext.broadcast((trees, first, size, t.cls.to_numpy()[first], table))
    key_type = rows.schema[key].dataType.simpleString()

    def ends(x, feature, threshold, left, right, value):
        inner = feature >= 0
        place, feature = np.arange(len(x)) * x.shape[1], np.maximum(feature, 0).astype(np.int64)
        # where a row goes from a node, to the left or to the right; at a leaf it stays
        to = np.where(inner, (left, right), np.arange(len(inner))).T.ravel().astype(np.int64)
        values, at = x.ravel(), np.zeros(len(x), np.int64)
        for _ in range(depth):
            over = ~(values[place + feature[at]] <= threshold[at])
            at = to[2 * at + over]
        return at

    def run(batches):
        trees, first, size, cls, table = bc.value
        for b in batches:
            for i in range(0, b.num_rows, WALKED_ROWS):
                some = b.slice(i, WALKED_ROWS)
                keys, m = some.column(0), some.num_rows
                # a null array or value is over every threshold, as null is in the joins
                values = np.array([v if v is not None else () for v in some.column(1).to_pandas()], dtype=object)
                width = max((len(v) for v in values), default=0)
                x = np.full((m, max(width, int(table[0].max(initial=0)) + 1)), np.nan)
                for r, v in enumerate(values):
                    x[r, :len(v)] = v
                total = np.zeros((m, int(cls.max(initial=0)) + 1))
                for tree, a, n, k in zip(trees, first, size, cls):
                    part = [c[a:a + n] for c in table]
                    at = ends(x, *part)
                    if sums:
                        total[:, k] += part[-1][at]
                    else:
                        yield pa.record_batch([keys, pa.array(np.full(m, tree), pa.int32()), pa.array(at, pa.int32())],
                                              names=[key, "tree", "node"])
                if sums:
                    known = np.unique(cls)
                    yield pa.record_batch([keys.take(pa.array(np.repeat(np.arange(m), len(known)))),
                                           pa.array(np.tile(known, m), pa.int32()), pa.array(total[:, known].ravel())],
                                          names=[key, "cls", "s"])

    return rows.select(key, x).mapInArrow(run, f"{key} {key_type}, " + ("cls int, s double" if sums else "tree int, node int"))


def _forest_nodes(spark, forest) -> DataFrame:
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    d = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    leaf = F.col("leftChild") < 0
    return d.select("tree", F.col("id").alias("node"),
                    F.when(leaf, F.lit(-1)).otherwise(F.col("split.featureIndex")).alias("feature"),
                    F.get("split.leftCategoriesOrThreshold", 0).alias("threshold"),
                    F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
                    F.col("impurityStats").alias("stats"))


def q_rf_check(spark, sf_dir):
    """Class probabilities from the node tables."""
    rows = _feature_rows(spark, sf_dir)
    feats = _feats(rows)
    model, labels, scores, _ = train_forest(rows, feats, RF_CFG)
    path = scratch_path(spark, "rf_check")
    save_bundle(spark, path, model, labels,
                bundle_metadata(RF_CFG, f"{sf_dir}/embeddings.parquet", scores, len(feats), spark.version))
    loaded, names, benign = load_bundle(spark, path)
    nodes = _forest_nodes(spark, loaded.stages[-1])
    fitted = model.transform(rows).select("vec_id", vector_to_array("probability").alias("p_fitted"))
    scored = score_events(rows, loaded, names).select(
        "vec_id", vector_to_array("features").alias("x"), "prob_arr", "predicted_attack", "confidence",
        "p_benign", "suspect", "rule_alert", "severity")
    leaves = walk(scored, nodes, RF_CFG.num_trees, RF_CFG.max_depth + 1, "vec_id", "x")
    total = F.aggregate("stats", F.lit(0.0), lambda a, b: a + b)
    votes = leaves.join(F.broadcast(nodes.select("tree", "node", "stats")), ["tree", "node"]) \
        .select("vec_id", F.posexplode(F.transform("stats", lambda v: v / total)).alias("c", "v")) \
        .groupBy("vec_id", "c").agg((F.sum("v") / RF_CFG.num_trees).alias("p"))
    p = votes.groupBy("vec_id").agg(F.sort_array(F.collect_list(F.struct("c", "p"))).alias("s")) \
        .select("vec_id", F.transform("s", lambda s: s["p"]).alias("p"))
    both = scored.join(p, "vec_id").join(fitted, "vec_id")
    apart = lambda a, b: F.array_max(F.zip_with(a, b, lambda u, v: F.abs(u - v)))
    top, is_benign = F.array_max("p"), F.get("p", benign)
    suspect = 1 - is_benign >= ANOMALY_THRESHOLD
    alert = F.when(suspect & (top >= CONFIDENCE_THRESHOLD), ALERT_HIGH).when(suspect, ALERT_LOW) \
        .otherwise(ALERT_NONE)
    severity = F.when(alert == ALERT_HIGH, SEVERITY_HIGH).when(alert == ALERT_LOW, SEVERITY_MEDIUM) \
        .otherwise(SEVERITY_NONE)
    chosen = F.element_at(F.array(*[F.lit(c) for c in names]),
                          F.array_position("prob_arr", F.array_max("prob_arr")).cast("int"))
    return both.select(
        "vec_id", (apart("p", "prob_arr") < CLOSE).alias("probabilities_ok"),
        (apart("p_fitted", "prob_arr") < CLOSE).alias("bundle_ok"),
        ((F.abs(F.col("confidence") - top) < CLOSE) & (F.abs(F.col("p_benign") - is_benign) < CLOSE)
         & (F.col("predicted_attack") == chosen)).alias("prediction_ok"),
        ((F.col("suspect") == suspect) & (F.col("rule_alert") == alert)
         & (F.col("severity") == severity)).alias("alert_ok"))


def q_iforest_check(spark, sf_dir):
    """Path lengths from the node table give score and flag."""
    rows = _ensemble_input(spark, sf_dir)
    m = fit_ensemble(rows, "features", "vec_id", ENS_CFG, with_lr=False, with_gbt=False)
    scored = score_ensemble(rows, m, "features", rule_predicates=ENS_CFG.rule_predicates) \
        .select("vec_id", "iso_score", "iso_is_anom")
    from vigil.ml.ensemble import _prepared, _scale
    x = _scale(m.scaler, _prepared(rows, "features")).select("vec_id", F.col("__zx").alias("x"))
    nodes = spark.createDataFrame(m.iforest.nodes, NODE_SCHEMA)
    depth = int(math.ceil(math.log2(max(m.iforest.psi, 2)))) + 1

    def c(n):
        return F.when(n > 2, 2.0 * (F.ln(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n) \
            .when(n == 2, 1.0).otherwise(0.0)

    leaves = walk(x, nodes, m.iforest.n_trees, depth, "vec_id", "x") \
        .join(F.broadcast(nodes.select("tree", "node", "size", "depth")), ["tree", "node"])
    size = F.col("size").cast("double")
    mean = leaves.groupBy("vec_id").agg(F.avg(F.col("depth") + c(size)).alias("h"))
    score = -F.pow(F.lit(2.0), -F.col("h") / c(F.lit(float(m.iforest.psi)))) - F.lit(m.iforest.offset)
    return scored.join(mean, "vec_id").select(
        "vec_id", (F.abs(F.col("iso_score") - score) < CLOSE).alias("score_ok"),
        (F.col("iso_is_anom") == (F.col("iso_score") < 0).cast("int")).alias("flag_ok"))


def q_lr_check(spark, sf_dir):
    """The class with the largest logit, summed over a coefficient table."""
    rows = _ensemble_input(spark, sf_dir)
    m = fit_ensemble(rows, "features", "vec_id", ENS_CFG, with_gbt=False, with_iforest=False)
    scored = score_ensemble(rows, m, "features", rule_predicates=ENS_CFG.rule_predicates) \
        .select("vec_id", "pred_lr")
    from vigil.ml.ensemble import _prepared, _scale
    x = _scale(m.scaler, _prepared(rows, "features")).select("vec_id", F.posexplode("__zx").alias("i", "v"))
    lr = m.lr.stages[-1]
    w = lr.coefficientMatrix.toArray()
    table = spark.createDataFrame([(c, m.classes[c], i, float(w[c, i]), float(lr.interceptVector[c]))
                                   for c in range(w.shape[0]) for i in range(w.shape[1])],
                                  "c int, name string, i int, w double, b double")
    logits = x.join(F.broadcast(table), "i").groupBy("vec_id", "c", "name", "b") \
        .agg((F.sum(F.col("v") * F.col("w"))).alias("s")).withColumn("s", F.col("s") + F.col("b"))
    best = logits.groupBy("vec_id").agg(F.max("s").alias("top"))
    mine = logits.select("vec_id", F.col("name").alias("pred_lr"), "s")
    return scored.join(best, "vec_id").join(mine, ["vec_id", "pred_lr"]).select(
        "vec_id", (F.col("s") >= F.col("top") - CLOSE).alias("largest_logit"),
        F.col("pred_lr").isin(list(m.classes)).alias("class_known"))


def q_stream_score_check(spark, sf_dir):
    """Each streamed event has the batch score of its row."""
    from vigil.plans.score import ScoreJob, start
    from vigil.sinks.kafka import replay_payload
    rows = _feature_rows(spark, sf_dir)
    feats = _feats(rows)
    model, labels, scores, _ = train_forest(rows, feats, RF_CFG)
    d = scratch_path(spark, "stream_check")
    save_bundle(spark, f"{d}/model", model, labels,
                bundle_metadata(RF_CFG, f"{sf_dir}/embeddings.parquet", scores, len(feats), spark.version))
    replay_payload(rows, feats, also=["vec_id"]).write.text(f"{d}/in")
    job = ScoreJob(model_dir=f"{d}/model", checkpoint_dir=f"{d}/checkpoint", source="files",
                   input=f"{d}/in", output=f"{d}/out", n_features=len(feats),
                   available_now=True, max_files_per_trigger=2)
    for q in start(spark, job):
        q.awaitTermination()
    loaded, names, _ = load_bundle(spark, f"{d}/model")
    cols = ["predicted_attack", "confidence", "p_benign", "anomaly_score", "suspect", "rule_alert",
            "severity", "label", "attack_name", "true_class", "is_attack_true", "is_attack_pred",
            "fp", "fn", "tp", "tn"]
    batch = score_events(rows, loaded, names).select("vec_id", F.struct(*cols).alias("b"))
    events = spark.read.parquet(f"{d}/out/events").select(
        F.get_json_object("raw_input", "$.vec_id").cast("bigint").alias("vec_id"), "event_id",
        F.struct(*cols).alias("s"))
    copies = events.groupBy("event_id").count().where("count > 1").count()
    met = batch.join(events.select("vec_id", "s"), "vec_id", "left")
    return met.groupBy("vec_id").agg(
        (F.count("s") == 1).alias("scored_once"),
        F.bool_and(F.col("b").eqNullSafe(F.col("s"))).alias("like_batch"),
        F.lit(copies == 0).alias("ids_unique"))


METRICS_START, METRICS_STEP = 1_704_067_200, 7     # seconds: the first event, and between two


def q_artifacts_check(spark, sf_dir):
    """Every artifact of the ensemble, saved and loaded again, scores alike."""
    from vigil.ml.ensemble import load_ensemble, save_ensemble
    from vigil.plans.models import ENS_10X4
    rows = _ensemble_input(spark, sf_dir)
    m = fit_ensemble(rows, "features", "vec_id", ENS_10X4)
    path = scratch_path(spark, "artifacts")
    save_ensemble(spark, m, path)
    cols = ("rule_alert", "iso_score", "iso_is_anom", "pred_lr", "pred_xgb", "pred_final")
    fitted, loaded = (score_ensemble(rows, x, "features", rule_predicates=ENS_CFG.rule_predicates)
                      .select("vec_id", F.struct(*cols).alias(n)) for x, n in
                      ((m, "a"), (load_ensemble(spark, path), "b")))
    return fitted.join(loaded, "vec_id").select("vec_id", F.col("a").eqNullSafe(F.col("b")).alias("same_scores"),
                                                F.col("b.pred_final").isNotNull().alias("decided"))


def q_score_metrics(spark, sf_dir):
    """The metrics of the scoring job are those of its own events.

    The rows are sent in four files, seven seconds apart; for each closed window the
    metrics output is compared with the window aggregate over the enriched output, and
    the listener's counts with the rows sent.
    """
    import time
    from vigil.plans.score import ScoreJob, start, window_metrics
    from vigil.sinks.kafka import replay_payload
    from vigil.streaming.progress import record_progress
    rows = _feature_rows(spark, sf_dir)
    feats = _feats(rows)
    model, labels, scores, _ = train_forest(rows, feats, RF_CFG)
    d = scratch_path(spark, "score_metrics")
    save_bundle(spark, f"{d}/model", model, labels,
                bundle_metadata(RF_CFG, f"{sf_dir}/embeddings.parquet", scores, len(feats), spark.version))
    n = rows.agg(F.max("vec_id")).first()[0] or 0
    for k in range(4):     # one after the other: their times order the files
        part = rows.where((F.col("vec_id") * 4 >= k * (n + 1)) & (F.col("vec_id") * 4 < (k + 1) * (n + 1)))
        sent = (F.col("vec_id") * METRICS_STEP + METRICS_START).cast("double")
        replay_payload(part, feats, also=["vec_id"], sent=sent).write.mode("append").text(f"{d}/in")
    n_sent = rows.count()
    n_files = spark.read.text(f"{d}/in").select(F.input_file_name()).distinct().count()
    job = ScoreJob(model_dir=f"{d}/model", checkpoint_dir=f"{d}/checkpoint", source="files",
                   input=f"{d}/in", output=f"{d}/out", n_features=len(feats), enable_metrics=True,
                   available_now=True, max_files_per_trigger=max(1, n_files // 4))
    log = record_progress(spark)
    try:
        queries = start(spark, job)
        for q in queries:
            q.awaitTermination()
        for _ in range(200):       # events reach the listener a little later
            if all(log.ended(q) for q in queries):
                break
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(log)
    (events_in, _), (metrics_in, late) = (log.totals(q) for q in queries)
    counts_ok = metrics_in == n_sent and late == 0 and events_in > 0
    events = spark.read.parquet(f"{d}/out/events")
    whole = window_metrics(events, job)
    found = spark.read.parquet(f"{d}/out/metrics")
    cols = [c for c in whole.columns if c not in ("processing_ts", "window_start", "window_end")]
    closed = events.agg((F.max("kafka_ts") - F.expr(f"INTERVAL {job.watermark}")).alias("t"))
    want = whole.join(F.broadcast(closed), F.col("window_end") <= F.col("t")) \
        .select("window_start", "total", F.struct(*cols).alias("w"))
    met = want.join(found.select("window_start", F.struct(*cols).alias("f")), "window_start", "left")
    extra = found.select("window_start").exceptAll(want.select("window_start")).count()
    return met.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "total",
                      F.col("w").eqNullSafe(F.col("f")).alias("metrics_ok"),
                      F.lit(counts_ok and extra == 0).alias("counts_ok"))


def q_gbt_check(spark, sf_dir):
    """Scores from the node tables, and each leaf of one round from its rows.

    Every row's softmax scores are the sums of the leaves it reaches over all
    rounds; the leaves of ``CHECKED_ROUND`` hold -step G / (H + lambda) of the training
    rows that reach them, with the chances that the rounds before give those rows.
    """
    from vigil.ml.boost import sampled, score_boost
    from vigil.ml.ensemble import _prepared, _scale
    rows = _ensemble_input(spark, sf_dir)
    m = fit_ensemble(rows, "features", "vec_id", ENS_CFG, with_lr=False, with_iforest=False)
    gbt, cfg = m.gbt, m.gbt.cfg
    x = _scale(m.scaler, _prepared(rows, "features")).select("vec_id", F.col("__zx").alias("x"))
    scored = score_boost(x, gbt, "x", "pred", "scores").select("vec_id", "pred", "scores")
    again = score_ensemble(rows, m, "features", rule_predicates=ENS_CFG.rule_predicates).select("vec_id", "pred_xgb")
    n = len(gbt.classes)
    nodes = gbt.nodes.assign(tree=gbt.nodes["round"] * n + gbt.nodes["cls"])
    r = CHECKED_ROUND

    def sums(of: DataFrame, key: str, some: pd.DataFrame) -> DataFrame:
        """(key, cls, s): the values of the leaves that each row reaches in some trees."""
        return walk_many(of, some, cfg.depth, key, "x", True).groupBy(key, "cls").agg(F.sum("s").alias("s"))

    # trees of one leaf give every row the same: only the others are walked
    size = nodes.groupby("tree")["node"].transform("size")
    base = nodes[size == 1].groupby("cls", as_index=False)["value"].sum()
    flat = spark.createDataFrame([(int(c), float(v)) for c, v in zip(base["cls"], base["value"])], "cls int, b double")
    tall = nodes[size > 1]
    every = x.select("vec_id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("cls"))
    total = every.join(F.broadcast(flat), "cls", "left").join(
        sums(x, "vec_id", tall), ["vec_id", "cls"], "left") \
        .select("vec_id", "cls", (F.coalesce("b", F.lit(0.0)) + F.coalesce("s", F.lit(0.0))).alias("s"))
    got = scored.select("vec_id", F.posexplode("scores").alias("cls", "score"))
    apart = got.join(total, ["vec_id", "cls"], "left").groupBy("vec_id").agg(
        F.max(F.abs(F.col("score") - F.col("s"))).alias("apart"), F.count("s").alias("n"),
        F.max_by("cls", F.struct("s", -F.col("cls"))).alias("best"))

    # the leaves of one round, from the training rows
    margin = sums(gbt.rows, "rid", nodes[nodes["round"] < r])
    top = margin.groupBy("rid").agg(F.sum(F.exp("s")).alias("z"))
    mine = nodes[nodes["round"] == r]
    facts = gbt.table(spark).where(F.col("round") == r).select(
        (F.col("round") * n + F.col("cls")).alias("tree"), F.col("node").alias("_leaf"), "value", "g", "h", "cls")
    leaf = walk_many(gbt.rows.where(sampled(F.col("rid"), r, cfg)), mine, cfg.depth, "rid", "x", False) \
        .withColumnRenamed("node", "_leaf").join(F.broadcast(facts), ["tree", "_leaf"])
    p = F.exp("s") / F.col("z")
    grads = leaf.join(margin, ["rid", "cls"]).join(top, "rid").join(gbt.rows.select("rid", "y"), "rid") \
        .groupBy("cls", "_leaf").agg(F.sum(p - (F.col("y") == F.col("cls")).cast("int")).alias("sg"),
                                     F.sum(2 * p * (1 - p)).alias("sh"), F.first("g").alias("g"),
                                     F.first("h").alias("h"), F.first("value").alias("value"))
    bad = (F.abs(F.col("sg") - F.col("g")) > 1e-6) | (F.abs(F.col("sh") - F.col("h")) > 1e-6) \
        | (F.abs(F.col("value") + cfg.step * F.col("sg") / (F.col("sh") + cfg.reg)) > 1e-6)
    counted = grads.agg(F.count("*").alias("n"), F.count_if(bad).alias("bad")).first()
    leaves_ok = counted["bad"] == 0 and counted["n"] == int((mine["feature"] < 0).sum())
    falls = len(gbt.losses) == cfg.rounds and all(b < a for a, b in zip(gbt.losses, gbt.losses[1:]))
    names = F.array(*[F.lit(c) for c in gbt.classes])
    return scored.join(apart, "vec_id").join(again, "vec_id").select(
        "vec_id", ((F.col("apart") < 1e-6) & (F.col("n") == n)).alias("scores_ok"),
        ((F.get(names, F.col("best")) == F.col("pred")) & (F.col("pred") == F.col("pred_xgb"))).alias("class_ok"),
        F.lit(leaves_ok).alias("leaves_ok"), F.lit(falls).alias("loss_falls"))


CHECK_QUERIES = {
    "score_metrics": q_score_metrics,
    "artifacts_check": q_artifacts_check,
    "gbt_check": q_gbt_check,
    "rf_check": q_rf_check,
    "iforest_check": q_iforest_check,
    "lr_check": q_lr_check,
    "stream_score_check": q_stream_score_check,
}
