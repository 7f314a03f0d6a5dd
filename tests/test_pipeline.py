"""End to end, as the reference's jobs chain: build -> CSV -> train -> replay
-> stream score with metrics; every hand-off goes through files."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from vigil.plans import build, replay, score, staged, train
from vigil.schema import ENRICHED_COLUMNS
from vigil.session import scratch_path
from vigil.sources.tables import embedding_columns, embeddings_features

N = 64


def test_build_train_replay_score(spark):
    base = scratch_path(spark, "t_chain")
    e = embedding_columns(embeddings_features(spark, SF01, plant_nulls=False), N)
    e = e.withColumn("cap", F.concat(F.lit("cap"), (F.col("vec_id") % 3).cast("string")))
    feats = [f"f{i}" for i in range(N)]
    sources = []
    for k in range(3):
        part = e.filter(F.col("cap") == f"cap{k}")
        cols = (["vec_id"] if k == 0 else []) + feats          # cap0 keeps an index column
        staged.write_ordered_csv(part, "vec_id", cols, f"{base}/cap{k}_x")
        writer = staged.write_layout_a if k != 2 else staged.write_layout_b
        writer(part, "vec_id", "label", f"{base}/cap{k}_y")
        sources.append((f"cap{k}", f"{base}/cap{k}_x", f"{base}/cap{k}_y"))
    built = build.build_labelled_table(spark, sources, n_features=N)
    build.write_csv(built, f"{base}/global_csv")

    job = train.parse_args(["--input", f"{base}/global_csv", "--model_dir", f"{base}/model",
                            "--num_trees", "5", "--max_depth", "4", "--n_features", str(N)])
    res = train.run(spark, job)
    assert "benign" in res["labels"]

    csv = spark.read.option("header", "true").csv(f"{base}/global_csv")
    assert csv.count() == 500 and set(csv.columns) == set(feats) | {"label", "attack_name"}
    replay.replay_frame(csv).write.text(f"{base}/events_in")

    sjob = score.parse_args(["--model_dir", f"{base}/model", "--checkpoint_dir", f"{base}/ck",
                             "--source", "files", "--input", f"{base}/events_in",
                             "--output", f"{base}/out", "--enable_metrics", "--available_now",
                             "--n_features", str(N), "--watermark", "0 seconds"])
    for q in score.start(spark, sjob):
        q.awaitTermination()
    ev = spark.read.parquet(f"{base}/out/events")
    assert ev.columns == ENRICHED_COLUMNS and ev.count() == 500
    by_cap = {r.attack_name: r["count"] for r in ev.groupBy("attack_name").count().collect()}
    assert set(by_cap) == {"cap0", "cap1", "cap2"} and sum(by_cap.values()) == 500
    truth = {r.label for r in ev.select("label").distinct().collect()}
    assert truth <= {0, 1}


@pytest.mark.parametrize("mod", ["build", "train", "score", "replay", "enrich", "compact"])
def test_cli_help(mod):
    out = subprocess.run([sys.executable, "-m", f"vigil.plans.{mod}", "--help"],
                         capture_output=True, text=True, timeout=120,
                         cwd=__file__.rsplit("/tests/", 1)[0])
    assert out.returncode == 0 and "usage" in out.stdout


def test_bench_prints_one_json_line():
    import json
    import os
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="alert_counts,confusion_window_stream", BENCH_MEM="2g")
    root = __file__.rsplit("/tests/", 1)[0]
    out = subprocess.run([sys.executable, "bench.py"], capture_output=True, text=True,
                         timeout=600, cwd=root, env=env)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and set(d["queries"]) == {"alert_counts", "confusion_window_stream"}
    assert d["value"] > 0 and d["sf"] == 0.001 and "throughput" in d
