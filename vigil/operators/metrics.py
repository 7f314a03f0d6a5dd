"""Aggregations.

All of them are hash aggregates with a map-side partial step, so the
shuffle carries one row per group per input partition, whatever the skew.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.schema import METRICS_WINDOW


def alert_counts(df: DataFrame, rule_col: str = "rule_alert") -> DataFrame:
    """A1: total rows and alerted rows in one pass."""
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(F.col(rule_col) == 1).alias("alerted"))


def confusion_sums(df: DataFrame, keys: Sequence) -> DataFrame:
    """A2: fp, fn, tp, tn sums, total and the two attack counts per group.

    ``labelled_total`` counts rows whose truth is known; flag sums skip the
    unknown ones, so rates over it are the labelled-only rates.
    """
    return df.groupBy(*keys).agg(
        F.sum("fp").cast("bigint").alias("fp"),
        F.sum("fn").cast("bigint").alias("fn"),
        F.sum("tp").cast("bigint").alias("tp"),
        F.sum("tn").cast("bigint").alias("tn"),
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col("is_attack_true").cast("int")).cast("bigint").alias("attack_true_cnt"),
        F.sum(F.col("is_attack_pred").cast("int")).cast("bigint").alias("attack_pred_cnt"),
        F.count(F.col("is_attack_true")).alias("labelled_total"),
    )


def add_rates(df: DataFrame) -> DataFrame:
    """A3: rates over the window total, as the reference defines them (so
    fp_rate is fp / total, not the usual fp / negatives)."""
    tot = F.col("total")
    return df.withColumns({
        "fp_rate": F.col("fp") / tot,
        "fn_rate": F.col("fn") / tot,
        "attack_true_rate": F.col("attack_true_cnt") / tot,
        "attack_pred_rate": F.col("attack_pred_cnt") / tot,
    })


def confusion_by_window(df: DataFrame, time_col: str = "kafka_ts",
                        size: str = METRICS_WINDOW, watermark: str | None = None,
                        keep_counts: bool = False) -> DataFrame:
    """A2 + A3 + W1 + W2: tumbling-window confusion metrics.

    With ``watermark`` set (streams) a window is final once the watermark
    passes its end; late rows are dropped with the window's state.
    """
    src = df.withWatermark(time_col, watermark) if watermark else df
    agg = confusion_sums(src, [F.window(F.col(time_col), size).alias("window")])
    out = add_rates(agg.withColumns({"window_start": F.col("window.start"),
                                     "window_end": F.col("window.end")}).drop("window"))
    cols = ["window_start", "window_end", "fp", "fn", "tp", "tn", "total",
            "fp_rate", "fn_rate", "attack_true_rate", "attack_pred_rate"]
    if keep_counts:
        cols += ["attack_true_cnt", "attack_pred_cnt", "labelled_total"]
    return out.select(*cols)


def multiclass_metrics(df: DataFrame, label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """A4: accuracy and weighted F1 in one distributed pass.

    weighted F1 = sum_c n_c * 2 tp_c / (n_c + m_c) / sum_c n_c, with n_c the
    true count and m_c the predicted count of class c (the definition of
    MulticlassClassificationEvaluator). Only the (label, prediction) pair
    counts are shuffled; their number is bounded by classes^2.
    """
    pairs = df.groupBy(F.col(label).alias("t"), F.col(prediction).alias("p")).count()
    # each pair counts once for its true and once for its predicted class
    n, none = F.col("count"), F.lit(0).cast("bigint")
    as_truth = F.struct(F.col("t").alias("c"), n.alias("n_c"), none.alias("m_c"),
                        F.when(F.col("t") == F.col("p"), n).otherwise(none).alias("tp_c"))
    as_pred = F.struct(F.col("p").cast(df.schema[label].dataType).alias("c"), none.alias("n_c"),
                       n.alias("m_c"), none.alias("tp_c"))
    per = pairs.select(F.explode(F.array(as_truth, as_pred)).alias("x")).select("x.*") \
        .groupBy("c").agg(*[F.sum(x).alias(x) for x in ("n_c", "m_c", "tp_c")])
    return per.agg(
        (F.sum("tp_c") / F.sum("n_c")).alias("accuracy"),
        (F.sum(F.when(F.col("n_c") > 0, F.col("n_c") * 2.0 * F.col("tp_c")
                      / (F.col("n_c") + F.col("m_c"))).otherwise(0.0))
         / F.sum("n_c")).alias("weighted_f1"),
        F.sum("n_c").cast("bigint").alias("n"),
    )


def class_counts(df: DataFrame, class_col: str = "class_name") -> DataFrame:
    """Rows per class or per source."""
    return df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(col).distinct()


def feature_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5: per-feature count, mean and sample std in one aggregate pass.

    One wide partial aggregate (no explode), then ``stack`` turns the single
    result row into one row per feature.
    """
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__std")]
    wide = df.agg(*aggs)
    args = ", ".join(f"'{c}', `{c}__n`, `{c}__mean`, `{c}__std`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {args}) AS (feature, n, mean, std)")


def score_quantile(df: DataFrame, col: str, q: float, exact: bool = True) -> DataFrame:
    """The q-quantile of a score, interpolated between the two nearest
    ranks (exact) or approximate; one row, column ``quantile``."""
    if exact:
        return exact_quantile(df, col, q)
    return df.agg(F.percentile_approx(col, q, 100000).alias("quantile"))


QUANTILE_BAND_MAX = 1_000_000


def _bracket(x: DataFrame, low: float, high: float, size: int) -> tuple:
    """(rows, about the values at two rank shares) from a mergeable KLL sketch of a size, one pass."""
    margin = 12 / size
    shares = f"array({max(0.0, low - margin)!r}D, {min(1.0, high + margin)!r}D)"
    r = x.agg(F.count(F.lit(1)).alias("n"), F.expr(f"kll_sketch_agg_double(x, {size})").alias("s")) \
        .select("n", F.expr(f"if(n > 0, kll_sketch_get_quantile_double(s, {shares}), NULL)").alias("b")).first()
    return r["n"], r["b"]


def exact_quantile(df: DataFrame, col: str, q: float, accuracy: int = 4096) -> DataFrame:
    """Exact interpolated quantile without holding all values in one buffer.

    The scores are written once as a table of one column, however dear they are to
    compute, and read twice: a KLL sketch (of size ``accuracy``) brackets the two target ranks, then one
    aggregate counts the rows below the bracket and each distinct value inside it.
    Should the bracket miss a rank it is opened on that side, and while it holds more than
    QUANTILE_BAND_MAX values it is narrowed by a sketch of its own.  Interpolation
    follows Spark's ``percentile``: position (n - 1) * q between the neighbouring ranks.
    Null and NaN values are left out.
    """
    from vigil.operators.align import frozen
    spark = df.sparkSession
    # null and NaN count as missing (Spark would sort NaN above +Infinity)
    x = frozen(df.select(F.col(col).cast("double").alias("x")).filter(
        F.col("x").isNotNull() & ~F.isnan("x")))
    n, b = _bracket(x, q, q, accuracy)
    if n == 0:
        return spark.createDataFrame([(None,)], "quantile double")
    pos = (n - 1) * q
    k0, k1 = int(math.floor(pos)), int(math.ceil(pos))
    lo, hi = b
    inf = float("inf")
    while True:
        side = F.when(F.col("x") < F.lit(lo), -1).when(F.col("x") > F.lit(hi), 1).otherwise(0)
        # ties (even a third of all rows on one value) collapse in each task
        counts = frozen(x.select(side.alias("side"), F.when(side == 0, F.col("x")).alias("x"))
                        .groupBy("side", "x").agg(F.count(F.lit(1)).alias("c")))
        st = counts.agg(F.coalesce(F.sum(F.when(F.col("side") < 0, F.col("c"))), F.lit(0)).alias("below"),
                        F.coalesce(F.sum(F.when(F.col("side") == 0, F.col("c"))), F.lit(0)).alias("band"),
                        F.count_if(F.col("side") == 0).alias("values")).first()
        below, band = st["below"], st["band"]
        if below > k0 and lo != -inf:
            lo = -inf
        elif below + band <= k1 and hi != inf:
            hi = inf
        elif st["values"] <= QUANTILE_BAND_MAX:
            break
        else:
            inner = x.filter(F.col("x").between(F.lit(lo), F.lit(hi)))
            new = _bracket(inner, (k0 - below) / band, (k1 - below) / band, accuracy)[1]
            if list(new) == [lo, hi]:
                break
            lo, hi = new
    # the global window sorts at most QUANTILE_BAND_MAX distinct values
    w = Window.orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.where("side = 0").withColumn("end", F.sum("c").over(w) + F.lit(below)) \
        .withColumn("start", F.col("end") - F.col("c"))

    def at(k):
        return F.max(F.when((F.col("start") <= k) & (F.lit(k) < F.col("end")), F.col("x")))

    v0, v1 = at(k0), at(k1)
    frac = pos - k0
    value = F.when(v0 == v1, v0).otherwise(
        F.lit(k1 - pos) * v0 + F.lit(frac) * v1) if k1 != k0 else v0
    return ranked.agg(value.alias("quantile"))
