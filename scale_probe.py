"""Scale probe: the operators whose plans matter most, on ~6M rows (10x the
sf0.1 lineitem, or spark.range), with exactness checked and timings printed
as one JSON line.  PROBE_ROWS / PROBE_CPUS / PROBE_SF_DIR change the size.

    python scale_probe.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from vigil.ml.iforest import fit_iforest, score_iforest
    from vigil.operators import metrics, sample
    from vigil.operators.align import positional_join
    from vigil.plans.staged import write_layout_a, write_ordered_csv
    from vigil.session import get_spark, scratch_path
    from vigil.sources.capture import file_position_columns, read_features
    from vigil.sources.labels import read_labels
    from vigil.streaming.store import append_batch, read_store

    cpus = os.environ.get("PROBE_CPUS", "8")
    sf_dir = os.environ.get("PROBE_SF_DIR", "/root/testdata/sf0.1")
    reps = int(os.environ.get("PROBE_REPS", "10"))
    spark = get_spark("vigil-probe", f"local[{cpus}]", int(cpus) * 2,
                      extra={"spark.ui.enabled": "false", "spark.driver.memory": "6g"})
    spark.sparkContext.setLogLevel("ERROR")
    out: dict = {}

    def timed(name, fn):
        t = time.perf_counter()
        value = fn()
        out[name] = {"sec": round(time.perf_counter() - t, 2), "result": value}
        return value

    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    big = (li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity",
                     "l_extendedprice", "l_shipdate")
           .withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))
           .withColumn("key", (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 64
                       + F.col("rep"))
           .withColumn("u", sample.uniform_from_key(F.col("key"))))
    n = big.count()
    out["rows"] = n

    cap = 80_000
    naive = lambda: big.withColumn("rn", F.row_number().over(
        Window.partitionBy("l_returnflag").orderBy("u", "key"))).filter(F.col("rn") <= cap)
    ids_naive = timed("class_cap_plain_window", lambda: naive().count())
    ids_ours = timed("class_cap_hash_prefix", lambda: sample.class_capped_sample(
        big, "l_returnflag", cap, ["u", "key"]).count())
    same = (sample.class_capped_sample(big, "l_returnflag", cap, ["u", "key"])
            .select("key").exceptAll(naive().select("key")).count() == 0)
    out["class_cap_exact"] = bool(same and ids_naive == ids_ours)

    q_ours = timed("quantile_exact_banded", lambda: metrics.exact_quantile(
        big, "l_extendedprice", 0.01).first()[0])
    q_ref = timed("quantile_spark_percentile", lambda: big.agg(
        F.percentile("l_extendedprice", F.lit(0.01))).first()[0])
    out["quantile_exact"] = q_ours == q_ref

    base = scratch_path(spark, "probe")
    src = spark.range(n).select(F.col("id").alias("i"), (F.col("id") * 0.5).alias("v"),
                                (F.col("id") % 2).cast("int").alias("label"))
    write_ordered_csv(src, "i", ["i", "v"], f"{base}/x")
    write_layout_a(src, "i", "label", f"{base}/y")
    x = file_position_columns(read_features(spark, f"{base}/x", 2, "c")).withColumn(
        "capture", F.lit("c"))
    y = read_labels(spark, f"{base}/y", "c").withColumn("capture", F.lit("c"))
    j = positional_join(x, y)
    bad = timed("positional_join", lambda: j.filter(
        (F.col("f0").cast("long") != F.col("pos")) | (F.col("label") != F.col("pos") % 2)
    ).count())
    out["positional_join_exact"] = bad == 0

    ev = big.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"),
                    F.col("key").alias("offset"),
                    F.col("l_shipdate").cast("timestamp").alias("kafka_ts"),
                    F.col("l_quantity").alias("f1"))
    table = f"{base}/store"
    timed("store_append_2_batches", lambda: [append_batch(ev, table, "kafka_ts", v, ["offset"])
                                             for v in (0, 1)] and 2)
    timed("store_read_last_write", lambda: read_store(
        spark, table, ["topic", "partition", "offset"]).count())

    fit = big.filter(F.col("rep") == 0).select(
        "key", F.array(F.col("l_quantity"), F.col("l_extendedprice") / 1000.0).alias("x"))
    model = timed("iforest_fit", lambda: fit_iforest(fit, "x", "key", n_trees=100))
    out["iforest_fit"]["result"] = round(model.offset, 6)
    timed("iforest_score_fit_rows", lambda: round(score_iforest(fit, model, "x").agg(
        F.avg("iso_is_anom")).first()[0], 4))
    # streaming: watermarked hourly windows over time-ordered files, RocksDB state
    from vigil.streaming.run import read_sink, run_available_now
    flags = big.select(
        (F.col("l_shipdate").cast("timestamp")
         + F.make_interval(secs=F.col("l_orderkey") % 86400)).alias("ts"),
        (F.col("l_returnflag") == "R").alias("is_attack_true"),
        (F.col("l_quantity") > 25).alias("is_attack_pred"))
    t, p = F.col("is_attack_true"), F.col("is_attack_pred")
    flags = flags.withColumns({"fp": (p & ~t).cast("int"), "fn": (~p & t).cast("int"),
                               "tp": (p & t).cast("int"), "tn": (~p & ~t).cast("int")})
    flags.repartitionByRange(24, "ts").sortWithinPartitions("ts").write.parquet(f"{base}/ev")
    stream = (spark.readStream.schema(flags.schema).option("maxFilesPerTrigger", "4")
              .parquet(f"{base}/ev"))
    agg = metrics.confusion_by_window(stream, "ts", "1 hour", watermark="5 minutes")
    timed("stream_window_metrics", lambda: run_available_now(
        agg, f"{base}/win", f"{base}/win_ck") or read_sink(spark, f"{base}/win").count())
    out["stream_window_metrics"]["events_per_s"] = round(n / out["stream_window_metrics"]["sec"])
    print(json.dumps(out))


if __name__ == "__main__":
    main()
