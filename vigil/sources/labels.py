"""Label files.

Layout A: one column, no header, optional BOM, blank lines allowed.
Layout B: header ``"","x"``; the label is column ``x`` (else the last one).
Blank labels are dropped *before* positions are assigned, as the
reference does, so position i is the i-th non-blank label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.clean import check_label_domain, parse_labels
from vigil.sources.capture import first_line, file_position_columns


def label_layout(spark: SparkSession, path: str, source: str | None = None) -> str:
    return "B" if "," in first_line(spark, path, source) else "A"


def read_label_text(spark: SparkSession, path: str, source: str | None = None,
                    layout: str | None = None) -> DataFrame:
    """Raw label text with its file position columns; blanks dropped."""
    layout = layout or label_layout(spark, path, source)
    if layout == "A":
        raw = spark.read.text(path).withColumnRenamed("value", "label_text")
        return _positioned(raw, "label_text")
    if layout != "B":
        raise ValueError(f"unknown label layout {layout!r}")
    df = spark.read.option("header", "true").csv(path)
    cols = [c.lstrip("\ufeff").strip('"') for c in df.columns]
    df = df.toDF(*cols)
    pick = "x" if "x" in cols else cols[-1]
    return _positioned(df.select(F.col(pick).alias("label_text")), "label_text")


def _positioned(df: DataFrame, col: str) -> DataFrame:
    # trim + blank filter run inside the scan stage, then ids are attached
    t = F.trim(F.regexp_replace(F.coalesce(F.col(col), F.lit("")), "^\ufeff", ""))
    return file_position_columns(df.select(t.alias(col)).filter(F.col(col) != ""))


def read_labels(spark: SparkSession, path: str, source: str | None = None,
                layout: str | None = None, allowed=(0, 1)) -> DataFrame:
    """S3 + P5 + P6 + P7: positioned 0/1 labels; bad text or values raise."""
    src = source or path
    df = read_label_text(spark, path, src, layout)
    df = parse_labels(df, "label_text", "label", src)
    return check_label_domain(df, "label", allowed, src).drop("label_text")
