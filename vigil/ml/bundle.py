"""Model bundle I/O (K10, S10): pipeline folder + labels.json + metadata.json.

Side files are written and read through Spark, so the bundle can live on
any file system the cluster uses (HDFS, S3, ...), not only a local disk.
Each side file is a folder holding one JSON text part.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def write_json(spark: SparkSession, path: str, obj) -> None:
    text = json.dumps(obj, ensure_ascii=False, indent=2)
    (spark.createDataFrame([(text,)], "value string")
     .write.mode("overwrite").text(path))


def read_json(spark: SparkSession, path: str):
    row = spark.read.text(path, wholetext=True).first()
    if row is None:
        raise FileNotFoundError(path)
    return json.loads(row[0])


def save_bundle(spark: SparkSession, model_dir: str, model, labels: list[str],
                metadata: dict) -> None:
    d = model_dir.rstrip("/")
    model.write().overwrite().save(f"{d}/pipeline")
    write_json(spark, f"{d}/labels.json", {"labels": list(labels)})
    write_json(spark, f"{d}/metadata.json", metadata)


def load_bundle(spark: SparkSession, model_dir: str, benign: str = "benign"):
    """-> (PipelineModel, labels, benign index); requires the benign class."""
    from pyspark.ml import PipelineModel
    d = model_dir.rstrip("/")
    model = PipelineModel.load(f"{d}/pipeline")
    labels = read_json(spark, f"{d}/labels.json")["labels"]
    if benign not in labels:
        raise RuntimeError(f"'{benign}' not found in labels.json: {labels}")
    return model, labels, labels.index(benign)
