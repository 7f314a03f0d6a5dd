"""Models: bundle round trip, score invariants, isolation forest, metrics."""

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tests.conftest import SF01
from vigil.ml.bundle import load_bundle, save_bundle
from vigil.ml.ensemble import EnsembleConfig
from vigil.ml.forest import ForestConfig, score_events, train_forest
from vigil.ml.iforest import average_path_length, fit_iforest, grow_tree, score_iforest
from vigil.operators import metrics
from vigil.plans import models
from vigil.session import scratch_path
from vigil.plans.models import _feature_rows


def test_forest_bundle_round_trip(spark):
    rows = _feature_rows(spark, SF01)
    feats = [f"f{i}" for i in range(64)]
    cfg = ForestConfig(num_trees=5, max_depth=4)
    model, labels, scores, pred = train_forest(rows, feats, cfg)
    assert labels[0] == "benign" or "benign" in labels
    ev = MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="prediction")
    assert abs(ev.setMetricName("f1").evaluate(pred) - scores["f1"]) < 1e-12
    assert abs(ev.setMetricName("accuracy").evaluate(pred) - scores["accuracy"]) < 1e-12
    d = scratch_path(spark, "t_bundle")
    save_bundle(spark, d, model, labels, {"metrics": scores})
    loaded, labels2, benign_idx = load_bundle(spark, d)
    assert labels2 == labels and labels2[benign_idx] == "benign"
    a = score_events(rows, model, labels).select("vec_id", "predicted_attack", "confidence")
    b = score_events(rows, loaded, labels2).select("vec_id", "predicted_attack", "confidence")
    assert a.exceptAll(b).count() == 0
    s = score_events(rows, loaded, labels2).select(
        F.aggregate("prob_arr", F.lit(0.0), lambda acc, x: acc + x).alias("t"),
        (F.col("anomaly_score") + F.col("p_benign")).alias("one")).collect()
    assert all(abs(r.t - 1) < 1e-9 and abs(r.one - 1) < 1e-12 for r in s)


def test_width_comes_from_the_data(spark, tmp_path):
    def table(*sizes):
        d = str(tmp_path / "-".join(map(str, sizes)))
        spark.createDataFrame([(i, [float(x) for x in range(n)], i % 3) for i, n in enumerate(sizes)],
                              "vec_id long, embedding array<float>, label int").write.parquet(
            f"{d}/embeddings.parquet")
        return d
    rows = models._feature_rows(spark, table(70, 70, 70))
    assert models._feats(rows) == [f"f{i}" for i in range(70)]
    assert rows.select("f69").first()[0] == 69.0
    with pytest.raises(ValueError, match="70 to 71"):
        models._feature_rows(spark, table(70, 71))


def test_boosted_queries_have_the_reference_settings():
    full = EnsembleConfig()
    assert (models.ENS_CFG.gbt_rounds, models.ENS_CFG.gbt_depth) == (full.gbt_rounds, full.gbt_depth) == (300, 8)
    assert {"gbt_score", "gbt_score_10x4", "ensemble_decision", "ensemble_decision_10x4"} <= set(
        models.MODEL_QUERIES)


def test_average_path_length():
    got = average_path_length([0, 1, 2, 256])
    assert got[0] == 0 and got[1] == 0 and got[2] == 1
    assert abs(got[3] - (2 * (np.log(255) + 0.5772156649015329) - 2 * 255 / 256)) < 1e-12


def test_grow_tree_isolates_outlier():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(255, 3)), [[50.0, 50.0, 50.0]]])
    nodes = grow_tree(x, rng, 8)
    assert nodes[0][5] == 256 and all(n[6] <= 8 for n in nodes)


def test_iforest_flags_contamination_share(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(v) for v in rng.normal(size=4)]) for i in range(3000)]
    df = spark.createDataFrame(data, "k long, x array<double>")
    model = fit_iforest(df, "x", "k", n_trees=50, contamination=0.01, seed=7)
    scored = score_iforest(df, model, "x")
    share = scored.agg(F.avg("iso_is_anom")).first()[0]
    assert 0.005 <= share <= 0.02
    out = spark.createDataFrame([(0, [40.0, 40.0, 40.0, 40.0])], "k long, x array<double>")
    assert score_iforest(out, model, "x").first().iso_is_anom == 1
    d = scratch_path(spark, "t_iso")
    model.save(spark, d)
    from vigil.ml.iforest import IsolationForestModel
    again = IsolationForestModel.load(spark, d)
    a = score_iforest(df, again, "x").select("k", "iso_score")
    assert a.exceptAll(scored.select("k", "iso_score")).count() == 0


def test_multiclass_metrics_equal_evaluator(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (2.0, 1.0), (2.0, 2.0),
                                (0.0, 2.0), (3.0, 3.0)], "label double, prediction double")
    m = metrics.multiclass_metrics(df).first()
    ev = MulticlassClassificationEvaluator()
    assert abs(m.weighted_f1 - ev.setMetricName("f1").evaluate(df)) < 1e-12
    assert abs(m.accuracy - ev.setMetricName("accuracy").evaluate(df)) < 1e-12


def test_iforest_pooled_subsamples_are_full(spark):
    rng = np.random.default_rng(3)
    data = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(20000)]
    df = spark.createDataFrame(data, "k long, x array<double>")
    model = fit_iforest(df, "x", "k", n_trees=10, contamination=0.02, seed=5)
    roots = model.nodes[model.nodes["node"] == 0]
    assert len(roots) == 10 and (roots["size"] == 256).all()
    share = score_iforest(df, model, "x").agg(F.avg("iso_is_anom")).first()[0]
    assert 0.01 <= share <= 0.03



def test_exact_quantile_matches_percentile(spark, monkeypatch):
    import vigil.operators.metrics as M
    rng = np.random.default_rng(9)
    vals = np.concatenate([rng.normal(size=5000), np.full(3000, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "s double")
    monkeypatch.setattr(M, "QUANTILE_BAND_MAX", 50)   # force the refinement loop
    for q in [0.0, 0.01, 0.37, 0.5, 0.99, 1.0]:
        got = M.exact_quantile(df, "s", q, accuracy=100).first()["quantile"]
        want = df.agg(F.percentile("s", F.lit(q))).first()[0]
        assert abs(got - want) <= 1e-12 * max(1.0, abs(want)), (q, got, want)



def test_exact_quantile_ignores_nan_and_infinities(spark):
    import vigil.operators.metrics as M
    rows = [(float("nan"),)] * 50 + [(float(v),) for v in range(100)] + \
        [(float("inf"),), (float("-inf"),), (None,)]
    df = spark.createDataFrame(rows, "s double")
    clean = df.filter(~F.isnan("s"))
    for q in [0.0, 0.5, 0.999, 1.0]:
        got = M.exact_quantile(df, "s", q, accuracy=20).first()["quantile"]
        want = clean.agg(F.percentile("s", F.lit(q))).first()[0]
        assert got == want or (np.isinf(got) and got == want), (q, got, want)



def test_benign_guards(spark):
    import pytest
    from vigil.ml.bundle import write_json
    from vigil.operators import rules
    df = spark.createDataFrame([([0.5, 0.5],)], "p array<double>")
    with pytest.raises(ValueError, match="benign"):
        rules.alert_layer(df, "p", ["a", "b"])
    d = scratch_path(spark, "t_nobenign")
    write_json(spark, f"{d}/labels.json", {"labels": ["a", "b"]})
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer
    Pipeline(stages=[SQLTransformer(statement="SELECT * FROM __THIS__")]).fit(df) \
        .write().overwrite().save(f"{d}/pipeline")
    with pytest.raises(RuntimeError, match="benign"):
        load_bundle(spark, d)


def test_empty_classification_sample_raises(spark):
    import pytest
    from vigil.ml.ensemble import EnsembleConfig, fit_ensemble
    df = spark.createDataFrame([(1, [float("nan"), 1.0], 0, "x")],
                               "k long, features array<double>, label int, attack_name string")
    with pytest.raises(Exception):
        fit_ensemble(df, "features", "k", EnsembleConfig(benign_min=0), with_iforest=False)


def test_vectorised_walk_equals_naive_traversal():
    import pandas as pd
    from vigil.ml.iforest import IsolationForestModel, raw_scores
    rng = np.random.default_rng(11)
    rows = []
    for t in range(7):
        x = rng.normal(size=(64, 3))
        rows += [(t,) + r for r in grow_tree(x, np.random.default_rng([2, t]), 6)]
    nodes = pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left",
                                        "right", "size", "depth"])
    model = IsolationForestModel(nodes, 64, 0.0, 7)
    xs = rng.normal(size=(200, 3)) * 2
    got = raw_scores(xs, model.arrays(), 64)
    by_tree = {t: g.set_index("node") for t, g in nodes.groupby("tree")}
    want = []
    for x in xs:
        total = 0.0
        for t, g in by_tree.items():
            k = 0
            while g.loc[k, "feature"] >= 0:
                f = g.loc[k, "feature"]
                k = g.loc[k, "left"] if x[f] <= g.loc[k, "threshold"] else g.loc[k, "right"]
            total += g.loc[k, "depth"] + average_path_length([g.loc[k, "size"]])[0]
        want.append(-2.0 ** (-(total / 7) / average_path_length([64])[0]))
    assert np.allclose(got, want, rtol=0, atol=1e-12)
