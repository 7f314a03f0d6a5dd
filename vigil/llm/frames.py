"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.session import checkpoint_root, scratch_path


def small_batches(spark) -> None:
    """Fewer rows in an Arrow batch, unless the session has set a number: texts are large,
    and a batch lies in the memory of the JVM and of the Python worker at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "2000")


def documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) alone: other columns, whatever their names, stay out of the work."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))


def parallelism(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def freeze(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later work starts from there."""
    spark = df.sparkSession
    checkpoint_root(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def same(left: Column, right: Column) -> Column:
    """Equality for joins in which a null key is a key like any other."""
    return left.eqNullSafe(right)
