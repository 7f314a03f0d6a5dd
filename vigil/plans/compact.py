"""Compaction of the replay-safe daily store (K8 / K9, merge-on-read).

Rewrites closed days to one row per record key, off the streaming path:

    python -m vigil.plans.compact --table PATH --keys topic,partition,offset
        (--days 2024.01.01,2024.01.02 | --before 2024.01.03) [--staging PATH]

Only days holding more than one write version are rewritten.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vigil.streaming.store import VERSION, compact_days


def days_to_compact(spark: SparkSession, table: str, before: str | None = None,
                    days: Sequence[str] | None = None) -> list[str]:
    """Days (before a bound, or from a list) with more than one version."""
    df = spark.read.parquet(table)
    if days:
        df = df.filter(F.col("day").isin(list(days)))
    if before:
        df = df.filter(F.col("day") < F.lit(before))
    multi = df.groupBy("day").agg(F.countDistinct(VERSION).alias("v")).filter("v > 1")
    return sorted(r["day"] for r in multi.collect())   # one row per day


def run(spark: SparkSession, table: str, keys: Sequence[str], staging: str,
        before: str | None = None, days: Sequence[str] | None = None) -> list[str]:
    todo = days_to_compact(spark, table, before, days)
    compact_days(spark, table, keys, todo, staging)
    return todo


def main(argv: Sequence[str] | None = None) -> None:
    from vigil.session import get_spark, scratch_path
    ap = argparse.ArgumentParser(description="compact closed days of a daily store")
    ap.add_argument("--table", required=True)
    ap.add_argument("--keys", required=True, help="comma-separated record key columns")
    group = ap.add_mutually_exclusive_group(required=True)
    group.add_argument("--days", help="comma-separated yyyy.MM.dd days")
    group.add_argument("--before", help="compact every day before this yyyy.MM.dd")
    ap.add_argument("--staging")
    a = ap.parse_args(argv)
    spark = get_spark("vigil-compact")
    done = run(spark, a.table, a.keys.split(","), a.staging or scratch_path(spark, "compact"),
               a.before, a.days.split(",") if a.days else None)
    print(f"compacted {len(done)} day(s): {', '.join(done)}")


if __name__ == "__main__":
    main()
