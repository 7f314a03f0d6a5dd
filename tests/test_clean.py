"""Cleaning, JSON decoding and label parsing edge rows."""

import math

import pytest
from pyspark.sql import functions as F

from vigil.operators import clean
from vigil.sources.stream import decode_payload


def test_coerce_fill_and_zero(spark):
    df = spark.createDataFrame([(1, None), (2, "NaN"), (3, "Infinity"), (4, "-Infinity"),
                                (5, "x"), (6, '"2.5"'), (7, "2.5"), (8, "1e39")],
                               "id int, f0 string")
    num = clean.coerce_numeric(df, ["f0"])
    filled = {r.id: r.f0 for r in clean.fill_features(num, ["f0"]).collect()}
    assert filled[1] == 0.0 and filled[2] == 0.0 and math.isinf(filled[3])
    assert filled[5] == 0.0 and filled[6] == 0.0 and filled[7] == 2.5
    zeroed = {r.id: r.f0 for r in clean.zero_nonfinite(num, ["f0"]).collect()}
    assert zeroed == {1: 0.0, 2: 0.0, 3: 0.0, 4: 0.0, 5: 0.0, 6: 0.0, 7: 2.5, 8: 0.0}
    kept = sorted(r.id for r in clean.drop_nonfinite(num, ["f0"]).collect())
    assert kept == [7]


def test_zero_nonfinite_array(spark):
    df = spark.createDataFrame([([1.0, float("nan"), float("inf"), None],)], "a array<double>")
    assert df.select(clean.zero_nonfinite_array("a").alias("z")).first().z == [1.0, 0, 0, 0]


def test_json_decode_edges(spark):
    rows = [(1, "not json"), (2, '{"f1": null}'), (3, '{"f1": 2, "extra": 1}'),
            (4, '{"f1": 1}'), (5, '{"f1": 1, "label": 1.0}'), (6, '{"f1": NaN}'),
            (7, '{"f1": Infinity, "label": 1}'), (8, '{"f1": "2.5"}')]
    df = spark.createDataFrame(rows, "id int, json_str string")
    out = {r.id: r for r in decode_payload(df, "f1 DOUBLE, label INT", keep=["id"]).collect()}
    assert out[1].f1 is None and out[2].f1 is None and out[3].f1 == 2.0
    assert out[4].label is None and out[5].label is None
    assert math.isnan(out[6].f1) and math.isinf(out[7].f1) and out[7].label == 1
    assert out[8].f1 is None


def test_parse_labels(spark):
    df = spark.createDataFrame([("\ufeff1",), (" 0 ",), ("",), ("1.0",), ("   ",)], "label_text string")
    out = [r.label for r in clean.parse_labels(df).collect()]
    assert out == [1, 0, 1]


def test_parse_labels_rejects_text(spark):
    df = spark.createDataFrame([("1",), ("yes",)], "label_text string")
    with pytest.raises(Exception, match="not a number"):
        clean.parse_labels(df, source="cap").collect()


def test_label_domain_guard(spark):
    df = spark.createDataFrame([("0",), ("2",)], "label_text string")
    with pytest.raises(Exception, match="outside"):
        clean.check_label_domain(clean.parse_labels(df), source="cap").collect()


def test_class_name_and_binary_fill(spark):
    df = spark.createDataFrame([(0, "Mirai"), (1, None), (None, "Fuzzing")],
                               "label int, attack_name string")
    df = clean.fill_attack_name(df)
    out = df.select(clean.fill_binary_label().alias("l"), clean.class_name().alias("c")).collect()
    assert [(r.l, r.c) for r in out] == [(0, "benign"), (1, "unknown"), (1, "Fuzzing")]


def test_features_array(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "f0 double, f1 double")
    assert df.select(clean.features_array(["f0", "f1"])).first().features == [1.0, 2.0]
