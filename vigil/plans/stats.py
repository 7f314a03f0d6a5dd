"""Job: fold captures into the stored feature statistics, one at a time (A5).

    python -m vigil.plans.stats --state DIR --input CAPTURE.csv --source NAME [--n_features 115]

Reads the new capture alone; a capture that is folded in again replaces its own rows.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from vigil.operators.moments import add_capture, merged, read_moments
from vigil.schema import N_FEATURES_DEFAULT, feature_names
from vigil.sources.capture import read_features


def fold(spark: SparkSession, state: str, path: str, source: str,
         n_features: int = N_FEATURES_DEFAULT) -> DataFrame:
    """Fold the capture at ``path`` in, and return the merged statistics."""
    names = feature_names(n_features)
    add_capture(read_features(spark, path, n_features, source).select(*names), names, source, state)
    return merged(read_moments(spark, state))


def main(argv: Sequence[str] | None = None) -> None:
    from vigil.session import get_spark
    ap = argparse.ArgumentParser(description="fold a capture into the feature statistics")
    ap.add_argument("--state", required=True)
    ap.add_argument("--input", required=True)
    ap.add_argument("--source", required=True)
    ap.add_argument("--n_features", type=int, default=N_FEATURES_DEFAULT)
    a = ap.parse_args(argv)
    out = fold(get_spark("vigil-stats"), a.state, a.input, a.source, a.n_features)
    print(f"OK: {a.source} folded in, {out.count()} features")


if __name__ == "__main__":
    main()
