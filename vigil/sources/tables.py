"""Bindings of the driver's parquet tables to the pipeline's data model.

* feature matrix  = ``embeddings``: f_i = embedding[i], class 'benign' for
  label 0 else 'attack_<label>', binary label = label <> 0.
* event stream    = ``events``: topic = event_type, partition = user_id % 4,
  offset = event_id, kafka_ts = ts, payload = props JSON, f1 = value,
  f2 = props.k, truth = (event_type = 'error').
* truth/prediction pairs = ``labels`` (quality, toxic).
* volume          = ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.schema import BENIGN

# Class vocabulary of the embeddings stand-in (label 0 is benign).
EMBEDDING_VOCAB = [BENIGN] + [f"attack_{i}" for i in range(1, 10)]
PROPS_SCHEMA = "k DOUBLE"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the Kafka envelope shape (S8) plus f1 and the binary truth."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("topic"),
        F.col("ts").cast("timestamp").alias("kafka_ts"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("props").alias("json_str"),
        F.col("value").alias("f1"),
        (F.col("event_type") == "error").cast("int").alias("label"),
        F.col("event_type").alias("attack_name"),
    )


def decode_props(df: DataFrame, col: str = "json_str", out: str = "f2") -> DataFrame:
    """S9 on the stand-in payload: props.k becomes feature f2."""
    return df.withColumn(out, F.from_json(F.col(col), PROPS_SCHEMA).getField("k"))


def embeddings_features(spark: SparkSession, sf_dir: str, n: int = 10,
                        plant_nulls: bool = True) -> DataFrame:
    """Feature rows with a binary label and an attack name.

    ``plant_nulls`` makes the unlabelled rows the tests need: every 11th
    vector has no binary label and every 7th no attack name.
    """
    emb = read_table(spark, sf_dir, "embeddings")
    binary = (F.col("label") != 0).cast("int")
    attack = F.concat(F.lit("attack_"), F.col("label").cast("string"))
    if plant_nulls:
        binary = F.when(F.col("vec_id") % 11 == 0, F.lit(None).cast("int")).otherwise(binary)
        attack = F.when(F.col("vec_id") % 7 == 0, F.lit(None).cast("string")).otherwise(attack)
    return emb.select("vec_id", "embedding", F.col("label").alias("class_label"),
                      binary.alias("label"), attack.alias("attack_name"))


def embedding_columns(df: DataFrame, n: int, col: str = "embedding") -> DataFrame:
    """Unpack the first n array entries into f0..f{n-1} DOUBLE columns."""
    return df.withColumns({f"f{i}": F.get(F.col(col), i).cast("double") for i in range(n)})


def array_width(df: DataFrame, col: str = "embedding") -> int:
    """The number of entries that all arrays of the column have; null arrays do not count
    (0 if there are no arrays)."""
    n = F.when(F.col(col).isNotNull(), F.size(col))
    lo, hi = df.agg(F.min(n), F.max(n)).first()
    if lo != hi:
        raise ValueError(f"{col}: arrays of {lo} to {hi} entries, one width is needed")
    return hi or 0
