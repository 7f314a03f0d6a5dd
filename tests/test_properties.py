"""Property tests (few examples each: every example runs Spark jobs)."""

import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.operators import rules, sample
from vigil.operators.align import positional_join
from vigil.sources.capture import file_position_columns, read_features
from vigil.sources.labels import read_labels

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([0, 1, None]),
                          st.sampled_from(["benign", "x", None])), min_size=1, max_size=40))
def test_flags_partition_labelled_rows(spark, rows):
    df = spark.createDataFrame([(i, lab, p, None) for i, (lab, p) in enumerate(rows)],
                               "id int, label int, predicted_attack string, attack_name string")
    for r in rules.truth_layer(df).collect():
        flags = [r.fp, r.fn, r.tp, r.tn]
        if r.label is not None and r.predicted_attack is not None:
            assert sum(flags) == 1
        else:
            assert sum(f for f in flags if f is not None) <= 1


@SETTINGS
@given(st.lists(st.sampled_from(["a", "a", "a", "b", "c"]), min_size=1, max_size=300),
       st.integers(min_value=1, max_value=40), st.integers(min_value=1, max_value=9))
def test_class_cap_equals_brute_force(spark, classes, cap, salts):
    df = spark.createDataFrame(list(enumerate(classes)), "id long, c string").withColumn(
        "u", sample.uniform_from_key(F.col("id")))
    got = {r.id for r in sample.class_capped_sample(df, "c", cap, ["u", "id"], salts).collect()}
    rows = df.collect()
    want = set()
    for c in set(classes):
        members = sorted((r for r in rows if r.c == c), key=lambda r: (r.u, r.id))
        want |= {r.id for r in members[:cap]}
    assert got == want


@SETTINGS
@given(st.integers(min_value=1, max_value=3000), st.sampled_from([512, 2048, 65536]),
       st.integers(min_value=1, max_value=3))
def test_positional_join_any_split_size(spark, n, split_bytes, n_files):
    d = tempfile.mkdtemp(prefix="vigil-prop-")
    os.makedirs(f"{d}/x")
    os.makedirs(f"{d}/y")
    per = -(-n // n_files)
    for f in range(n_files):
        rng = range(f * per, min(n, (f + 1) * per))
        with open(f"{d}/x/part-{f:05d}.csv", "w") as fx:
            fx.write("".join(f"{i},{i * 3}\n" for i in rng))
        with open(f"{d}/y/part-{f:05d}.txt", "w") as fy:
            fy.write("".join(f"{i % 2}\n\n" if i % 7 == 0 else f"{i % 2}\n" for i in rng))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        x = file_position_columns(read_features(spark, f"{d}/x", 2, "p")).withColumn(
            "capture", F.lit("p"))
        y = read_labels(spark, f"{d}/y", "p", layout="A").withColumn("capture", F.lit("p"))
        out = positional_join(x, y).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(out) == n
    assert all(int(r.f0) == r.pos and r.label == r.pos % 2 for r in out)


@SETTINGS
@given(st.lists(st.one_of(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False),
                          st.sampled_from([0.0, 1.5, -2.0])), min_size=1, max_size=400),
       st.floats(min_value=0.0, max_value=1.0))
def test_exact_quantile_equals_percentile(spark, values, q):
    import vigil.operators.metrics as M
    df = spark.createDataFrame([(v,) for v in values], "s double")
    old = M.QUANTILE_BAND_MAX
    M.QUANTILE_BAND_MAX = 7            # force the narrowing loop on small inputs
    try:
        got = M.exact_quantile(df, "s", q, accuracy=50).first()["quantile"]
    finally:
        M.QUANTILE_BAND_MAX = old
    want = df.agg(F.percentile("s", F.lit(q))).first()[0]
    assert abs(got - want) <= 1e-9 * max(1.0, abs(want))
