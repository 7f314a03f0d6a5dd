"""Incremental feature statistics, and totals seen by a write."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_align import _write
from vigil.operators import moments
from vigil.plans import build, stats


def test_state_grows_by_captures_and_reads_only_the_new_one(spark, tmp_path):
    rng = np.random.default_rng(5)
    data = {f"c{k}": rng.normal(1e6, 1 + k, size=(50 + 30 * k, 3)) for k in range(5)}
    data["c2"][:, 2] = 7.0
    state = str(tmp_path / "state")
    for name, x in data.items():
        _write(f"{tmp_path}/{name}.csv", [",".join(map(repr, r.tolist())) for r in x])
    read = []

    def fold(name):
        scan = spark.read.csv(f"{tmp_path}/{name}.csv", schema="f0 double, f1 double, f2 double")
        read.append({p.rsplit("/", 1)[1] for p in moments.feature_moments(scan, ["f0", "f1", "f2"], name).inputFiles()})
        return stats.fold(spark, state, f"{tmp_path}/{name}.csv", name, 3)

    for name in list(data)[:3]:
        fold(name)
    for name in list(data)[3:]:
        got = {r.feature: r for r in fold(name).collect()}
    assert read == [{f"{n}.csv"} for n in data]
    got = {r.feature: r for r in fold("c4").collect()}          # again: its rows are replaced
    x = np.concatenate(list(data.values()))
    for i in range(3):
        r = got[f"f{i}"]
        assert r.n == len(x) and r.mean == pytest.approx(x[:, i].mean(), rel=1e-14)
        assert r.std == pytest.approx(x[:, i].std(ddof=1), rel=1e-9)


def test_moments_leave_out_nonfinite_rows_and_empty_captures(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, float("nan")), (5.0, None), (7.0, 4.0), (1e39, 1.0)], "a double, b double")
    state = str(tmp_path / "s")
    moments.add_capture(df, ["a", "b"], "x", state)
    moments.add_capture(df.limit(0), ["a", "b"], "none", state)
    got = {r.feature: tuple(r)[1:] for r in moments.merged(moments.read_moments(spark, state)).collect()}
    assert got == {"a": (2, 4.0, pytest.approx(18 ** 0.5)), "b": (2, 3.0, pytest.approx(2 ** 0.5))}
    z = moments.standardized(df.limit(1), ["a", "b"], moments.merged(moments.read_moments(spark, state))).first()
    assert z.a == pytest.approx(-3 / 18 ** 0.5) and z.b == pytest.approx(-1 / 2 ** 0.5)
    with pytest.raises(ValueError, match="no statistics"):
        moments.standardized(df, ["a", "c"], moments.merged(moments.read_moments(spark, state)))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_write_counts_its_rows(spark, tmp_path, fmt):
    df = spark.range(0, 1000, 1, 5).select((F.col("id") * 1.0).alias("f0"), F.lit(0).alias("label"),
                                           F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("attack_name"),
                                           F.col("id").alias("pos"))
    counts = build.write_counted(df, str(tmp_path / "t"), ["a", "b", "c"], fmt)
    assert counts == {"a": 250, "b": 750, "c": 0}
    assert spark.read.format(fmt).option("header", "true").load(str(tmp_path / "t")).count() == 1000
    with pytest.raises(ValueError, match="no known source"):
        build.write_counted(df, str(tmp_path / "u"), ["a"], fmt)
