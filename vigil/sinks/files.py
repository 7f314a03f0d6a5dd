"""File and console sinks (K1, K2, K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def to_console(df: DataFrame, rows: int = 20, truncate: bool = False):
    """K7: print a batch (``show``) or start a console stream."""
    if df.isStreaming:
        return (df.writeStream.format("console").option("numRows", str(rows))
                .option("truncate", str(truncate).lower()).outputMode("append").start())
    df.show(rows, truncate=truncate)
    return None

