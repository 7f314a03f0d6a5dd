"""Job wiring: argument surfaces, train -> bundle -> streaming score with
metrics, replay encoding, ensemble train -> save -> load -> enrich."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from vigil.ml.ensemble import EnsembleConfig, load_ensemble
from vigil.plans import enrich, replay, score, train
from vigil.schema import ENRICHED_COLUMNS, ENSEMBLE_COLUMNS, METRICS_COLUMNS
from vigil.session import scratch_path
from vigil.sources.tables import embedding_columns, embeddings_features

N = 64


@pytest.fixture(scope="module")
def labelled_csv(spark):
    """The embeddings stand-in written as the global labelled CSV (S1 layout)."""
    e = embedding_columns(embeddings_features(spark, SF01, plant_nulls=False), N)
    path = scratch_path(spark, "t_global_csv")
    e.select(*[f"f{i}" for i in range(N)], "label", "attack_name") \
        .write.option("header", "true").csv(path)
    return path


def test_train_args():
    job = train.parse_args(["--input_csv", "x", "--model_dir", "m", "--num_trees", "3"])
    assert job.forest.num_trees == 3 and job.forest.max_depth == 12 and job.fmt == "csv"


def test_score_args():
    job = score.parse_args(["--model_dir", "m", "--checkpoint_dir", "c", "--enable_metrics",
                            "--pred_logic", "suspect", "--bootstrap_servers", "h:1"])
    with pytest.raises(SystemExit):        # no deployment's host is assumed
        score.parse_args(["--model_dir", "m", "--checkpoint_dir", "c"])
    assert job.enable_metrics and job.pred_logic == "suspect"
    assert job.max_offsets_per_trigger == 20000 and job.watermark == "5 minutes"
    with pytest.raises(SystemExit):
        score.parse_args(["--model_dir", "m", "--checkpoint_dir", "c", "--source", "files"])


def test_train_then_stream_score(spark, labelled_csv):
    model_dir = scratch_path(spark, "t_model")
    job = train.TrainJob(labelled_csv, model_dir, "csv", N,
                         train.ForestConfig(num_trees=5, max_depth=4))
    res = train.run(spark, job)
    assert "benign" in res["labels"] and 0 <= res["accuracy"] <= 1
    meta = json.loads(spark.read.text(f"{model_dir}/metadata.json", wholetext=True).first()[0])
    assert meta["num_trees"] == 5 and meta["n_features"] == N

    events_in = scratch_path(spark, "t_events_in")
    df = spark.read.option("header", "true").csv(labelled_csv)
    replay.replay_frame(df).write.text(events_in)
    out = scratch_path(spark, "t_scored")
    sjob = score.ScoreJob(model_dir=model_dir, checkpoint_dir=f"{out}/ck", source="files",
                          input=events_in, output=out, enable_metrics=True,
                          n_features=N, available_now=True, metrics_window="1 minute",
                          watermark="0 seconds")
    for q in score.start(spark, sjob):
        q.awaitTermination()
    ev = spark.read.parquet(f"{out}/events")
    assert ev.columns == ENRICHED_COLUMNS and ev.count() == 500
    assert ev.filter(F.col("event_id").isNull() | F.col("predicted_attack").isNull()).count() == 0
    assert spark.read.parquet(f"{out}/metrics").columns == METRICS_COLUMNS
    # stream = batch: the same bundle over the same payloads as a batch table
    from vigil.ml.bundle import load_bundle
    model, labels, _ = load_bundle(spark, model_dir)
    env = spark.read.text(events_in).select(
        F.lit("t").alias("topic"), F.current_timestamp().alias("kafka_ts"),
        F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
        F.col("value").alias("json_str"))
    batch = score.enrich(env, model, labels, sjob).select("raw_input", "predicted_attack",
                                                         "confidence", "severity")
    streamed = ev.select("raw_input", "predicted_attack", "confidence", "severity")
    assert batch.exceptAll(streamed).count() == 0 and streamed.exceptAll(batch).count() == 0


def test_replay_payload_shape(spark, labelled_csv):
    df = spark.read.option("header", "true").csv(labelled_csv)
    row = json.loads(replay.replay_frame(df).first().value)
    assert len([k for k in row if k.startswith("f")]) == N
    assert isinstance(row["label"], int) and "ts" in row and "attack_name" in row
    only = json.loads(replay.replay_frame(df, features_only=True).first().value)
    assert "label" not in only


def test_ensemble_train_and_consume(spark, labelled_csv):
    df = spark.read.option("header", "true").csv(labelled_csv)
    df = df.withColumns({f"f{i}": F.col(f"f{i}").cast("double") for i in range(N)})
    art = scratch_path(spark, "t_art")
    cfg = EnsembleConfig(n_trees=20, benign_min=10, lr_max_iter=20, gbt_rounds=3, gbt_depth=3)
    enrich.train(spark, df, art, cfg)
    model = load_ensemble(spark, art)
    env = replay.replay_frame(df).select(
        F.current_timestamp().alias("kafka_ts"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"),
        F.lit(None).cast("string").alias("key"), F.col("value").alias("json_str"))
    out = enrich.enrich_frame(env, model, N)
    rows = out.collect()
    assert out.columns == ENSEMBLE_COLUMNS and len(rows) == 500
    assert all(r.pred_final is not None and r.iso_is_anom in (0, 1) for r in rows)


def test_score_continuous_mode_starts_on_empty_output(spark, labelled_csv):
    model_dir = scratch_path(spark, "t_model_c")
    train.run(spark, train.TrainJob(labelled_csv, model_dir, "csv", N,
                                    train.ForestConfig(num_trees=3, max_depth=3)))
    events_in = scratch_path(spark, "t_events_c")
    replay.replay_frame(spark.read.option("header", "true").csv(labelled_csv)) \
        .write.text(events_in)
    out = scratch_path(spark, "t_scored_c")
    sjob = score.ScoreJob(model_dir=model_dir, checkpoint_dir=f"{out}/ck", source="files",
                          input=events_in, output=out, enable_metrics=True, n_features=N,
                          watermark="0 seconds")
    qs = score.start(spark, sjob)
    try:
        assert len(qs) == 2
        qs[0].processAllAvailable()
        qs[1].processAllAvailable()
    finally:
        for q in qs:
            q.stop()
    assert spark.read.parquet(f"{out}/events").count() == 500


def test_train_from_partitioned_parquet(spark, labelled_csv):
    from vigil.plans.build import write_parquet
    df = spark.read.option("header", "true").csv(labelled_csv)
    df = df.withColumns({f"f{i}": F.col(f"f{i}").cast("double") for i in range(N)}).withColumn(
        "label", F.col("label").cast("int"))
    pq = scratch_path(spark, "t_global_pq")
    write_parquet(df, pq)                                   # partitioned by attack_name
    job = train.parse_args(["--input", pq, "--format", "parquet", "--model_dir",
                            scratch_path(spark, "t_model_pq"), "--num_trees", "3",
                            "--max_depth", "3", "--n_features", str(N)])
    res = train.run(spark, job)
    assert "benign" in res["labels"] and len(res["labels"]) == 10
