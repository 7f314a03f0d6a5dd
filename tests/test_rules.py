"""Alert layer and rule edge rows (thresholds, nulls, class index range)."""

from pyspark.sql import functions as F

from vigil.operators import rules


def test_threshold_rule_edges(spark):
    df = spark.createDataFrame([(1, 1500.0), (2, 1500.0001), (3, None), (4, 1400.0)],
                               "id int, f1 double")
    out = {r.id: r.rule_alert for r in rules.threshold_rule(df, "f1", 1500.0).collect()}
    assert out == {1: 0, 2: 1, 3: 0, 4: 0}


def test_threshold_rule_text_feature_is_lenient(spark):
    df = spark.createDataFrame([(1, "x"), (2, "1600")], "id int, f1 string")
    out = {r.id: r.rule_alert for r in rules.threshold_rule(df, "f1", 1500.0).collect()}
    assert out == {1: 0, 2: 1}


def test_compound_rule_edges(spark):
    df = spark.createDataFrame(
        [(1, 1400.0, 0.0), (2, 1400.5, 0.0), (3, 0.0, 100000.0), (4, 0.0, 100000.5),
         (5, None, None), (6, None, 200000.0)], "id int, f1 double, f2 double")
    out = {r.id: r.rule_alert for r in rules.compound_rule(df).collect()}
    assert out == {1: 0, 2: 1, 3: 0, 4: 1, 5: 0, 6: 1}


def _alerts(spark, rows):
    df = spark.createDataFrame(rows, "id int, p array<double>, prediction double")
    return {r.id: r for r in rules.alert_layer(df, "p", ["benign", "a", "b"],
                                               prediction_col="prediction").collect()}


def test_alert_layer_thresholds_inclusive(spark):
    out = _alerts(spark, [
        (1, [0.30, 0.70, 0.0], 1.0),   # anomaly exactly 0.70, confidence exactly 0.70
        (2, [0.30, 0.40, 0.30], 1.0),  # suspect, low confidence
        (3, [0.90, 0.05, 0.05], 0.0),  # benign
        (4, [0.1, 0.2, 0.7], 3.0),     # index outside the vocabulary
    ])
    assert out[1].suspect and out[1].rule_alert == "ALERT_HIGH" and out[1].severity == "high"
    assert out[2].rule_alert == "ALERT_LOW" and out[2].severity == "medium"
    assert not out[3].suspect and out[3].rule_alert == "BENIGN" and out[3].severity == "none"
    assert out[4].predicted_attack == "unknown"
    assert abs(out[1].anomaly_score + out[1].p_benign - 1.0) < 1e-12


def test_alert_layer_null_probability(spark):
    out = _alerts(spark, [(1, None, None)])
    assert out[1].suspect is None and out[1].rule_alert == "BENIGN"


def test_truth_flags_three_valued(spark):
    rows = [(0, True), (0, False), (1, True), (1, False), (None, True), (None, False),
            (0, None), (1, None), (None, None)]
    df = spark.createDataFrame(
        [(i, lab, None if p is None else ("a" if p else "benign"), None)
         for i, (lab, p) in enumerate(rows)],
        "id int, label int, predicted_attack string, attack_name string")
    out = {r.id: (r.fp, r.fn, r.tp, r.tn) for r in rules.truth_layer(df).collect()}
    assert out[0] == (1, 0, 0, 0) and out[1] == (0, 0, 0, 1)
    assert out[2] == (0, 0, 1, 0) and out[3] == (0, 1, 0, 0)
    assert out[4] == (None, 0, None, 0) and out[5] == (0, None, 0, None)
    assert out[6] == (None, 0, 0, None) and out[7] == (0, None, None, 0)
    assert out[8] == (None, None, None, None)


def test_true_class_fallbacks(spark):
    df = spark.createDataFrame([(1, 0, "Mirai"), (2, 1, "Mirai"), (3, 1, None), (4, None, None)],
                               "id int, label int, attack_name string")
    df = df.withColumn("predicted_attack", F.lit("benign"))
    out = {r.id: r.true_class for r in rules.truth_layer(df).collect()}
    assert out == {1: "benign", 2: "Mirai", 3: "attack", 4: "attack"}
    out2 = {r.id: r.true_class for r in
            rules.truth_layer(df, unlabelled_as_null=True).collect()}
    assert out2[4] is None


def test_decision_cascade(spark):
    df = spark.createDataFrame(
        [(1, 0, 0, "x", "y"), (2, 1, 0, "x", "y"), (3, 0, 1, None, "y"), (4, 1, 1, None, None)],
        "id int, iso_is_anom int, rule_alert int, pred_xgb string, pred_lr string")
    out = {r.id: r.pred_final for r in rules.decision_cascade(df).collect()}
    assert out == {1: "benign", 2: "x", 3: "y", 4: "attack"}


def test_pred_logic_suspect(spark):
    df = spark.createDataFrame([(1, 1, True, "a"), (2, 0, False, "a")],
                               "id int, label int, suspect boolean, attack_name string")
    out = {r.id: r.tp for r in rules.truth_layer(df, pred_logic="suspect").collect()}
    assert out == {1: 1, 2: 0}



def test_lookup_class_names_matches_array_lookup(spark):
    from vigil.functions.columns import class_lookup
    vocab = ["benign", "a", "b"]
    vdf = spark.createDataFrame(list(enumerate(vocab)), "idx int, name string")
    df = spark.createDataFrame([(0, 0.0), (1, 2.0), (2, 3.0), (3, None)], "id int, p double")
    joined = {r.id: r.predicted_attack for r in rules.lookup_class_names(df, "p", vdf).collect()}
    direct = {r.id: r.c for r in df.select("id", class_lookup(vocab, "p", "unknown").alias("c")).collect()}
    assert joined == direct == {0: "benign", 1: "b", 2: "unknown", 3: "unknown"}
