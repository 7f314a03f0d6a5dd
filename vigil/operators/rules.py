"""Detection rules and the alert layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.columns import argmax, class_lookup
from vigil.schema import (ALERT_HIGH, ALERT_LOW, ALERT_NONE, ANOMALY_THRESHOLD, BENIGN,
                          COMPOUND_RULE_F1, COMPOUND_RULE_F2, CONFIDENCE_THRESHOLD,
                          FALLBACK_ATTACK, SEVERITY_HIGH, SEVERITY_MEDIUM, SEVERITY_NONE,
                          SIMPLE_RULE_F1, UNKNOWN_ATTACK)


def threshold_predicate(feature: str = "f1", threshold: float = SIMPLE_RULE_F1) -> Column:
    """R1's condition; null (missing or non-numeric feature) means no alert.

    Text features are coerced leniently, so a bad value never raises; on a
    numeric column the cast disappears and the comparison reaches the scan.
    """
    return F.col(feature).try_cast("double") > F.lit(float(threshold))


def threshold_rule(df: DataFrame, feature: str = "f1", threshold: float = SIMPLE_RULE_F1,
                   out: str = "rule_alert") -> DataFrame:
    """1 when ``feature > threshold`` else 0 (a null feature gives 0)."""
    return df.withColumn(out, F.when(threshold_predicate(feature, threshold), 1).otherwise(0))


def any_rule(df: DataFrame, predicates: Sequence[str | Column],
             out: str = "rule_alert") -> DataFrame:
    """R2 generalised: 1 when any predicate holds (SQL text or Column) else 0."""
    cond = None
    for p in predicates:
        c = F.expr(p) if isinstance(p, str) else p
        cond = c if cond is None else (cond | c)
    return df.withColumn(out, F.when(F.coalesce(cond, F.lit(False)), 1).otherwise(0))


def compound_rule(df: DataFrame, f1: str = "f1", f2: str = "f2",
                  f1_threshold: float = COMPOUND_RULE_F1,
                  f2_threshold: float = COMPOUND_RULE_F2,
                  out: str = "rule_alert") -> DataFrame:
    """R2: ``CASE WHEN f1 > a OR f2 > b THEN 1 ELSE 0 END``."""
    return any_rule(df, [F.col(f1) > F.lit(float(f1_threshold)),
                         F.col(f2) > F.lit(float(f2_threshold))], out)


def alert_layer(df: DataFrame, prob_col: str, vocab: Sequence[str],
                prediction_col: str | None = None,
                anomaly_threshold: float = ANOMALY_THRESHOLD,
                confidence_threshold: float = CONFIDENCE_THRESHOLD,
                benign: str = BENIGN) -> DataFrame:
    """R3-R6 + J2 on a probability array.

    Adds predicted_attack, confidence, p_benign, anomaly_score, suspect,
    rule_alert (ALERT_HIGH / ALERT_LOW / BENIGN) and severity.
    The class index is the model's ``prediction`` column when given, else the
    argmax of the probabilities; an index outside the vocabulary maps to
    'unknown' instead of failing.
    """
    if benign not in vocab:
        raise ValueError(f"'{benign}' not found in labels: {list(vocab)}")
    benign_idx = list(vocab).index(benign)
    p = F.col(prob_col)
    idx = F.col(prediction_col).cast("int") if prediction_col else argmax(p)
    conf = F.array_max(p)
    p_benign = F.get(p, benign_idx)
    out = df.withColumns({
        "predicted_attack": class_lookup(vocab, idx, UNKNOWN_ATTACK),
        "confidence": conf,
        "p_benign": p_benign,
        "anomaly_score": F.lit(1.0) - p_benign,
    })
    suspect = F.col("anomaly_score") >= F.lit(float(anomaly_threshold))
    out = out.withColumn("suspect", suspect)
    hi = F.col("suspect") & (F.col("confidence") >= F.lit(float(confidence_threshold)))
    lo = F.col("suspect") & (F.col("confidence") < F.lit(float(confidence_threshold)))
    rule = (F.when(hi, F.lit(ALERT_HIGH)).when(lo, F.lit(ALERT_LOW))
            .otherwise(F.lit(ALERT_NONE)))
    out = out.withColumn("rule_alert", rule)
    sev = (F.when(F.col("rule_alert") == ALERT_HIGH, F.lit(SEVERITY_HIGH))
           .when(F.col("rule_alert") == ALERT_LOW, F.lit(SEVERITY_MEDIUM))
           .otherwise(F.lit(SEVERITY_NONE)))
    return out.withColumn("severity", sev)


def truth_layer(df: DataFrame, label: str = "label", attack: str = "attack_name",
                pred_logic: str = "predicted_attack", benign: str = BENIGN,
                unlabelled_as_null: bool = False) -> DataFrame:
    """P15 + R7 + R8: ground truth and per-row confusion flags.

    ``pred_logic`` is 'predicted_attack' (class != benign), 'suspect', or
    'rule' (a 0/1 ``rule_alert`` column).
    Flags keep SQL three-valued logic: an unknown truth or prediction gives a
    null flag unless the other side already decides it.
    """
    from vigil.operators.clean import true_class
    if pred_logic == "suspect":
        pred = F.col("suspect") == F.lit(True)
    elif pred_logic == "predicted_attack":
        pred = F.col("predicted_attack") != F.lit(benign)
    elif pred_logic == "rule":
        pred = F.col("rule_alert") == F.lit(1)
    else:
        raise ValueError("pred_logic must be 'predicted_attack', 'suspect' or 'rule', "
                         f"got {pred_logic!r}")
    out = df.withColumns({
        "true_class": true_class(label, attack, unlabelled_as_null),
        "is_attack_true": F.col(label) == F.lit(1),
        "is_attack_pred": pred,
    })
    t, p = F.col("is_attack_true"), F.col("is_attack_pred")
    return out.withColumns({
        "fp": (p & ~t).cast("int"),
        "fn": (~p & t).cast("int"),
        "tp": (p & t).cast("int"),
        "tn": (~p & ~t).cast("int"),
    })


VOCAB_BROADCAST_MAX = 100_000


def lookup_class_names(df: DataFrame, idx_col: str, vocab: DataFrame,
                       out: str = "predicted_attack") -> DataFrame:
    """J2, relational form: class index -> name by joining a vocabulary table
    (``idx INT, name STRING``).  The vocabulary is one row per class; it is
    broadcast after its size is counted (shuffle-joined above
    VOCAB_BROADCAST_MAX rows).  An index it does not know gives 'unknown'."""
    v = vocab.select(F.col("idx").cast("int").alias("__idx"), F.col("name").alias("__name"))
    if v.count() <= VOCAB_BROADCAST_MAX:
        v = F.broadcast(v)
    j = df.join(v, F.col(idx_col).cast("int") == F.col("__idx"), "left")
    return j.withColumn(out, F.coalesce(F.col("__name"), F.lit(UNKNOWN_ATTACK))).drop(
        "__idx", "__name")


def decision_cascade(df: DataFrame, iso_col: str = "iso_is_anom",
                     rule_col: str = "rule_alert", gbt_col: str = "pred_xgb",
                     lr_col: str = "pred_lr", out: str = "pred_final") -> DataFrame:
    """No anomaly and no rule -> benign; else boosted class, LR class, 'attack'."""
    quiet = (F.col(iso_col) == 0) & (F.col(rule_col) == 0)
    return df.withColumn(out, F.when(quiet, F.lit(BENIGN)).otherwise(
        F.coalesce(F.col(gbt_col), F.col(lr_col), F.lit(FALLBACK_ATTACK))))


def alerts_only(df: DataFrame, rule_col: str = "rule_alert",
                predicate: Column | None = None) -> DataFrame:
    """Rows that raised the rule.

    Given the rule's own predicate, filter on it instead of on the 0/1
    column: a plain comparison is pushed into the Parquet scan (row-group
    skipping), while ``CASE ... END = 1`` is not.
    """
    if predicate is not None:
        return df.filter(predicate)
    return df.filter(F.col(rule_col) == 1)
