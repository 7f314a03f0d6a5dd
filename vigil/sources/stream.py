"""Stream sources.

``kafka_source`` is the production source; ``file_event_source`` is its
twin for places without a broker: a file stream whose rows are shaped like
the Kafka envelope, with ``maxFilesPerTrigger`` standing in for
``maxOffsetsPerTrigger``.  Everything downstream is the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigil.schema import MAX_OFFSETS_PER_TRIGGER


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest",
                 max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
                 fail_on_data_loss: bool = False) -> DataFrame:
    """Subscribe one topic (needs the Kafka connector on the classpath)."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
            .load())


def envelope(df: DataFrame, with_key: bool = False) -> DataFrame:
    """Kafka columns -> topic, kafka_ts, partition, offset, (key), json_str."""
    cols = [F.col("topic"), F.col("timestamp").alias("kafka_ts"), F.col("partition"),
            F.col("offset")]
    if with_key:
        cols.append(F.col("key").cast("string").alias("key"))
    cols.append(F.col("value").cast("string").alias("json_str"))
    return df.select(*cols)


def decode_payload(df: DataFrame, schema: StructType | str, col: str = "json_str",
                   keep: Sequence[str] | None = None) -> DataFrame:
    """Parse the JSON text under a declared schema and flatten it.

    A malformed document gives nulls for its fields (PERMISSIVE), never an
    error; ``keep`` lists envelope columns to carry along (default: all).
    """
    keep = list(df.columns) if keep is None else list(keep)
    return (df.select(*keep, F.from_json(F.col(col), schema).alias("__j"))
            .select(*keep, "__j.*"))


def file_event_source(spark: SparkSession, path: str, schema: StructType,
                      fmt: str = "parquet", max_files_per_trigger: int | None = None,
                      latest_first: bool = False) -> DataFrame:
    """File stream twin of the Kafka source (W5 / W6 via file options)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if latest_first:
        r = r.option("latestFirst", "true")
    return r.load(path)


# a file of JSON lines is one record of the scan: larger ones are refused
FILE_BYTES_MAX = 256 << 20


def file_lines(spark: SparkSession, path: str, topic: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Files of raw JSON lines in the envelope's columns, without a broker.

    The whole file is one record of the scan, so a line's place in its file is
    known and two equal lines stay two events: partition = a hash of the file's
    path, offset = the line's number.  Files should be kept at the size of a
    Kafka batch; one over ``FILE_BYTES_MAX`` fails the batch with its name.  The event time is the payload's send time, else the file's.
    """
    raw = (spark.readStream.format("text").option("wholetext", "true")
           .option("maxFilesPerTrigger", str(max_files_per_trigger)).load(path))
    size, name = F.col("_metadata.file_size"), F.col("_metadata.file_path")
    large = F.concat(F.lit(f"over {FILE_BYTES_MAX} bytes, split it: "), name)
    raw = raw.where(F.when(size > FILE_BYTES_MAX, F.raise_error(large).cast("boolean")).otherwise(True))
    lines = raw.select(
        F.pmod(F.xxhash64(F.col("_metadata.file_path")), F.lit((1 << 31) - 1)).cast("int").alias("partition"),
        F.col("_metadata.file_modification_time").alias("_modified"),
        F.posexplode(F.split("value", "\r?\n")).alias("offset", "json_str")).where("json_str <> ''")
    sent = F.timestamp_seconds(F.get_json_object("json_str", "$.ts").try_cast("double"))
    return lines.select(F.lit(topic).alias("topic"), F.coalesce(sent, "_modified").alias("kafka_ts"),
                        "partition", F.col("offset").cast("bigint").alias("offset"), "json_str")
