"""Capture reading, width guards and the positional join."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from vigil.operators.align import positional_join
from vigil.plans.build import build_labelled_table
from vigil.sources.capture import (discover_features, file_position_columns, read_features,
                                   validate_rows)
from vigil.sources.labels import label_layout, read_labels


def _write(path, lines, bom=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        if bom:
            f.write("\ufeff")
        f.write("\n".join(lines) + "\n")


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="vigil-test-")


@pytest.mark.parametrize("width,ok", [(2, False), (3, True), (4, True), (5, False)])
def test_width_guard(spark, tmp, width, ok):
    p = f"{tmp}/w{width}.csv"
    _write(p, [",".join(str(i + j) for j in range(width)) for i in range(3)])
    if ok:
        df = read_features(spark, p, 3, "cap")
        assert df.columns == ["f0", "f1", "f2"]
        first = sorted(df.collect(), key=lambda r: r.f0)[0]
        assert first.f0 == (1.0 if width == 4 else 0.0)
    else:
        with pytest.raises(ValueError, match=r"\[cap\] unexpected column count"):
            read_features(spark, p, 3, "cap")


def test_missing_input(spark, tmp):
    with pytest.raises(FileNotFoundError, match="cap"):
        read_features(spark, f"{tmp}/nope.csv", 3, "cap")


def test_label_layouts(spark, tmp):
    _write(f"{tmp}/a.csv", ["1", "", "0", "1.0"], bom=True)
    _write(f"{tmp}/b.csv", ['"","x"', '"1",0', '"2",1'])
    assert label_layout(spark, f"{tmp}/a.csv") == "A"
    assert label_layout(spark, f"{tmp}/b.csv") == "B"
    a = [r.label for r in read_labels(spark, f"{tmp}/a.csv").collect()]
    b = [r.label for r in read_labels(spark, f"{tmp}/b.csv").collect()]
    assert a == [1, 0, 1] and b == [0, 1]


def test_label_value_two_fails(spark, tmp):
    _write(f"{tmp}/bad.csv", ["0", "2"])
    with pytest.raises(Exception, match="outside"):
        read_labels(spark, f"{tmp}/bad.csv", "cap").collect()


def _pairs(spark, tmp, n, n_labels, name="cap"):
    _write(f"{tmp}/{name}_x.csv", [f"{i},{i * 0.5}" for i in range(n)])
    _write(f"{tmp}/{name}_y.csv", [str(i % 2) for i in range(n_labels)])
    x = file_position_columns(read_features(spark, f"{tmp}/{name}_x.csv", 2, name))
    y = read_labels(spark, f"{tmp}/{name}_y.csv", name)
    return (x.withColumn("capture", F.lit(name)), y.withColumn("capture", F.lit(name)))


def test_positional_join_exact_across_splits(spark, tmp):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        x, y = _pairs(spark, tmp, 20000, 20000)
        assert x.rdd.getNumPartitions() > 4
        out = positional_join(x, y).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(out) == 20000
    assert all(int(r.f0) == r.pos and r.label == r.pos % 2 for r in out)


@pytest.mark.parametrize("n_labels,msg", [(11, "more labels"), (9, "more feature rows")])
def test_positional_join_length_guard(spark, tmp, n_labels, msg):
    x, y = _pairs(spark, tmp, 10, n_labels)
    with pytest.raises(ValueError, match=rf"\[cap\] {msg}"):
        positional_join(x, y)


def test_build_labelled_table_two_captures(spark, tmp):
    _write(f"{tmp}/A_x.csv", [f"{i},{i},{i * 2}" for i in range(5)])      # leading index
    _write(f"{tmp}/A_y.csv", ["0", "1", "0", "1", "0"], bom=True)
    _write(f"{tmp}/B_x.csv", [f"{i},{i + 100}" for i in range(3)])
    _write(f"{tmp}/B_y.csv", ['"","x"', '"1",1', '"2",1', '"3",0'])
    df = build_labelled_table(spark, [("A", f"{tmp}/A_x.csv", f"{tmp}/A_y.csv"),
                              ("B", f"{tmp}/B_x.csv", f"{tmp}/B_y.csv")], n_features=2)
    rows = sorted((r.attack_name, r.f0, r.f1, r.label) for r in df.collect())
    assert rows[:2] == [("A", 0.0, 0.0, 0), ("A", 1.0, 2.0, 1)]
    assert [r[3] for r in rows if r[0] == "B"] == [1, 1, 0]


def test_discover_features():
    cols = ["f10", "f2", "label", "f0", "f1", "attack_name"] + [f"f{i}" for i in range(3, 10)]
    assert discover_features(cols, 11)[:3] == ["f0", "f1", "f2"]
    with pytest.raises(ValueError, match="label"):
        discover_features(["f0", "attack_name"])
    with pytest.raises(ValueError, match="expected 115"):
        discover_features(["f0", "label", "attack_name"], 115)


@pytest.mark.parametrize("bad", ["1,2", "1,2,3,4", "1,x,3"])
def test_strict_row_guard(spark, tmp, bad):
    p = f"{tmp}/s.csv"
    _write(p, ["1,2,3", bad, "4,5,6"])
    assert read_features(spark, p, 3, "cap").count() == 3
    with pytest.raises(Exception, match=r"\[cap\] malformed row"):
        read_features(spark, p, 3, "cap", strict=True).collect()
    with pytest.raises(ValueError, match=r"\[cap\] malformed row"):
        validate_rows(spark, p, 3, "cap")


def test_strict_guard_passes_clean_rows(spark, tmp):
    p = f"{tmp}/ok.csv"
    _write(p, ["1,2,3", "4,5,6", ",,"])
    assert len(read_features(spark, p, 3, "cap", strict=True).collect()) == 3


def test_build_fails_on_malformed_capture(spark, tmp):
    _write(f"{tmp}/A_x.csv", ["1,2", "3,x"])
    _write(f"{tmp}/A_y.csv", ["0", "1"])
    with pytest.raises(Exception, match=r"\[A\] malformed row: 3,x"):
        build_labelled_table(spark, [("A", f"{tmp}/A_x.csv", f"{tmp}/A_y.csv")], n_features=2).collect()


def test_positional_join_same_files_new_split_size(spark, tmp):
    # a second read of the same files with other split settings must not
    # reuse the first read's split table
    x, y = _pairs(spark, tmp, 20000, 20000)
    assert positional_join(x, y).count() == 20000
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        x2, y2 = _pairs(spark, tmp, 20000, 20000)
        out = positional_join(x2, y2).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(out) == 20000 and all(int(r.f0) == r.pos for r in out)


def test_build_glob_paths_fall_back_to_per_capture_scans(spark, tmp):
    _write(f"{tmp}/A_x.csv", [f"{i},{i},{i * 2}" for i in range(5)])
    _write(f"{tmp}/A_y.csv", ["0", "1", "0", "1", "0"], bom=True)
    _write(f"{tmp}/B_x.csv", [f"{i},{i + 100}" for i in range(3)])
    _write(f"{tmp}/B_y.csv", ['"","x"', '"1",1', '"2",1', '"3",0'])
    plain = [("A", f"{tmp}/A_x.csv", f"{tmp}/A_y.csv"), ("B", f"{tmp}/B_x.csv", f"{tmp}/B_y.csv")]
    globbed = [("A", f"{tmp}/A_[x].csv", f"{tmp}/A_y.csv"), ("B", f"{tmp}/B_x.csv", f"{tmp}/B_y.csv")]
    a = build_labelled_table(spark, plain, n_features=2)
    b = build_labelled_table(spark, globbed, n_features=2)
    assert a.count() == 8 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_strict_build_supports_actions_that_prune_features(spark, tmp):
    _write(f"{tmp}/A_x.csv", ["1,2", "3,4"])
    _write(f"{tmp}/A_y.csv", ["0", "1"])
    src = [("A", f"{tmp}/A_x.csv", f"{tmp}/A_y.csv")]
    assert build_labelled_table(spark, src, n_features=2).count() == 2
    assert build_labelled_table(spark, src, n_features=2).groupBy("attack_name").count() \
        .first()["count"] == 2
    _write(f"{tmp}/B_x.csv", ["1,2", "3,x"])
    _write(f"{tmp}/B_y.csv", ["0", "1"])
    with pytest.raises(Exception, match=r"\[B\] malformed row: 3,x"):
        build_labelled_table(spark, [("B", f"{tmp}/B_x.csv", f"{tmp}/B_y.csv")],
                             n_features=2).count()


def _changed(spark, key, value, run):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        return run()
    finally:
        spark.conf.set(key, old) if old is not None else spark.conf.unset(key)


@pytest.mark.parametrize("key,value", [("spark.sql.files.maxPartitionBytes", "30000"),
                                       ("spark.sql.files.minPartitionNum", "37"),
                                       ("spark.sql.files.openCostInBytes", "1")])
def test_positional_join_never_loses_rows_when_the_plan_changes(spark, tmp, key, value):
    """Either all pairs, or an error: never fewer or other pairs."""
    for part in range(6):
        _write(f"{tmp}/x/part-0000{part}.csv",
               [f"{i},{i * 0.5}" for i in range(part * 3000, part * 3000 + 3000 + part)][:3000])
    _write(f"{tmp}/y.csv", [str(i % 2) for i in range(18000)])
    x = file_position_columns(read_features(spark, f"{tmp}/x", 2, "c")).withColumn("capture", F.lit("c"))
    y = read_labels(spark, f"{tmp}/y.csv", "c").withColumn("capture", F.lit("c"))
    joined = positional_join(x, y)
    try:
        rows = _changed(spark, key, value, lambda: joined.select("*").collect())
    except Exception as e:  # noqa: BLE001 - the job refuses
        assert "split plan changed" in str(e)
    else:
        assert len(rows) == 18000 and all(int(r.f0) == r.pos and r.label == r.pos % 2 for r in rows)
    assert joined.count() == 18000


def test_positional_join_refuses_a_changed_split_size(spark, tmp):
    x, y = _pairs(spark, tmp, 20000, 20000)
    joined = positional_join(x, y)
    with pytest.raises(Exception, match="split plan changed"):
        _changed(spark, "spark.sql.files.maxPartitionBytes", "9000",
                 lambda: joined.select("*").count())


def test_part_numbers_order_files_not_their_text(spark, tmp):
    for no, values in (("99999", ["10", "11"]), ("100000", ["12", "13"])):
        _write(f"{tmp}/x/part-{no}-u.csv", [f"{v},1" for v in values])
    _write(f"{tmp}/y/part-99999-u.txt", ["0", "0"])
    _write(f"{tmp}/y/part-100000-u.txt", ["1", "1"])
    x = file_position_columns(read_features(spark, f"{tmp}/x", 2, "c")).withColumn("capture", F.lit("c"))
    y = read_labels(spark, f"{tmp}/y", "c", "A").withColumn("capture", F.lit("c"))
    got = sorted((r.pos, r.f0, r.label) for r in positional_join(x, y).collect())
    assert got == [(0, 10.0, 0), (1, 11.0, 0), (2, 12.0, 1), (3, 13.0, 1)]


def test_capture_folder_with_sub_folders(spark, tmp):
    _write(f"{tmp}/A/one/part-00000.csv", ["1,2", "3,4"])
    _write(f"{tmp}/A/two/part-00000.csv", ["5,6"])
    _write(f"{tmp}/A_y.csv", ["0", "1", "0"])
    _write(f"{tmp}/B.csv", ["7,8"])
    _write(f"{tmp}/B_y.csv", ["1"])
    df = build_labelled_table(spark, [("A", f"{tmp}/A/*", f"{tmp}/A_y.csv"),
                                      ("B", f"{tmp}/B.csv", f"{tmp}/B_y.csv")], n_features=2)
    assert sorted((r.attack_name, r.f0, r.label) for r in df.collect()) == [
        ("A", 1.0, 0), ("A", 3.0, 1), ("A", 5.0, 0), ("B", 7.0, 1)]


def test_folder_key_is_the_given_folder():
    from vigil.sources.capture import _folder_key
    assert _folder_key("/d/A", "file:///d/A/one/part-0.csv") == "file:///d/A/"
    assert _folder_key("hdfs://h:1/d/A b/", "hdfs://h:1/d/A%20b/x/p.csv") == "hdfs://h:1/d/A%20b/"


def _label_pairs(spark, tmp, labels):
    _write(f"{tmp}/l_x.csv", [f"{i},{i * 0.5}" for i in range(len(labels))])
    _write(f"{tmp}/l_y.csv", labels)
    x = file_position_columns(read_features(spark, f"{tmp}/l_x.csv", 2, "cap")).withColumn("capture", F.lit("cap"))
    y = file_position_columns(spark.read.text(f"{tmp}/l_y.csv")).withColumn("capture", F.lit("cap"))
    return x, y.withColumn("label", F.col("value").cast("int")).drop("value")


@pytest.mark.parametrize("labels", [
    ["0"] * 9000, ["0"] * 5000 + ["1"] * 6000, [str(i * i % 7 % 2) for i in range(13001)], ["1"], ["1", "0"] * 32,
    ["0"] * 4096 + ["1"]])
def test_packed_labels_join_like_rows(spark, tmp, monkeypatch, labels):
    from vigil.operators import align
    x, y = _label_pairs(spark, tmp, labels)
    packed = positional_join(x, y)
    assert " Exchange hashpartitioning" not in packed._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    monkeypatch.setattr(align, "LABEL_BYTES_MAX", 0)
    rows = positional_join(x, y)
    assert packed.schema["label"].dataType == rows.schema["label"].dataType and set(packed.columns) == set(rows.columns)
    got, want = (sorted((r.pos, r.f0, r.label) for r in d.collect()) for d in (packed, rows))
    assert got == want == [(i, float(i), int(v)) for i, v in enumerate(labels)]


def test_other_labels_join_row_by_row(spark, tmp):
    """Labels outside 0 and 1, and nulls, are no bits."""
    from vigil.operators.align import add_positions, packed_labels
    labels = [("null" if i % 5 == 0 else str(i % 4)) for i in range(500)]
    x, y = _label_pairs(spark, tmp, labels)
    y = y.drop("label").withColumn("label", F.when(F.col("_rid") >= 0, F.lit(3)))
    assert packed_labels(add_positions(y), "label") is None
    assert {r.label for r in positional_join(x, y).collect()} == {3}
    y = y.withColumn("label", F.lit(None).cast("int"))
    assert positional_join(x, y).where("label IS NULL").count() == 500


def test_long_runs_take_no_words(spark, tmp):
    from vigil.operators.align import add_positions, packed_labels
    _, y = _label_pairs(spark, tmp, ["0"] * 8192 + ["1"] * 8192 + ["0", "1"] * 50)
    bits = packed_labels(add_positions(y), "label").orderBy("_chunk").collect()
    assert [(r["_one"], r["_words"] and len(r["_words"]), r["_all"]) for r in bits] == [
        (0, None, 4096), (0, None, 4096), (1, None, 4096), (1, None, 4096), (None, 2, 100)]
