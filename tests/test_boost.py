"""Softmax boosted trees: both ways of growing them, plain sums, save and load."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.ml import boost


def table(spark, n=600, d=6, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).round(2)
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] * x[:, 2] > 0.2).astype(int)
    return spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y)], "x array<double>, y int").repartition(3)


def nodes_of(model):
    return model.nodes.sort_values(["round", "cls", "node"], ignore_index=True)


def test_levels_over_blocks_grow_the_trees_of_one_block(spark, monkeypatch):
    cfg = boost.BoostConfig(rounds=4, depth=3)
    train = table(spark).checkpoint()
    one = boost.fit_boost(train, ["a", "b", "c"], cfg)
    monkeypatch.setattr(boost, "BLOCK_ROWS", 170)
    monkeypatch.setattr(boost, "KEEP_ROUNDS", 2)
    many = boost.fit_boost(train, ["a", "b", "c"], cfg)
    a, b = nodes_of(one), nodes_of(many)
    assert len(a) == len(b) > 4 * 3 * 5
    for c in ("round", "cls", "node", "feature", "threshold", "left", "right"):
        assert (a[c] == b[c]).all()
    assert np.allclose(a[["g", "h", "value"]], b[["g", "h", "value"]], atol=1e-9)
    assert np.allclose(one.losses, many.losses) and len(one.losses) == 4


def test_first_round_is_what_sums_say(spark):
    cfg = boost.BoostConfig(rounds=1, depth=2, rows=1.0, columns=1.0)
    train = table(spark)
    m = boost.fit_boost(train, ["a", "b", "c"], cfg)
    rows = [(np.array(r.x), r.y) for r in m.rows.collect()]
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    for k in range(3):
        g, h = 1 / 3 - (y == k), np.full(len(y), 2 / 3 * 2 / 3)
        t = nodes_of(m)[lambda n: n.cls == k].set_index("node")
        best = max(((g[low].sum() ** 2 / (h[low].sum() + 1) + g[~low].sum() ** 2 / (h[~low].sum() + 1)), f, c)
                   for f in range(6) for c in np.unique(x[:, f])
                   for low in [x[:, f] <= c] if h[low].sum() >= 1 and h[~low].sum() >= 1)
        got = x[:, t.feature[0]] <= t.threshold[0]
        gain = g[got].sum() ** 2 / (h[got].sum() + 1) + g[~got].sum() ** 2 / (h[~got].sum() + 1)
        assert gain >= 0.98 * best[0]      # cuts are at quantiles
        assert t.g[t.left[0]] == pytest.approx(g[got].sum()) and t.h[t.left[0]] == pytest.approx(h[got].sum())
        assert t.value[t.left[0]] == pytest.approx(-0.1 * t.g[t.left[0]] / (t.h[t.left[0]] + 1)) or t.left[t.left[0]] >= 0


def test_it_learns_and_survives_saving(spark, tmp_path):
    m = boost.fit_boost(table(spark, 1500), ["a", "b", "c"], boost.BoostConfig(rounds=40, depth=4))
    assert all(b < a for a, b in zip(m.losses, m.losses[1:]))
    test = table(spark, 700, seed=9).withColumn("truth", F.get(F.array(*map(F.lit, "abc")), F.col("y")))
    scored = boost.score_boost(test, m, "x", "pred", "s").cache()
    assert scored.agg(F.avg((F.col("pred") == F.col("truth")).cast("int"))).first()[0] > 0.85
    m.save(spark, str(tmp_path / "b"))
    again = boost.score_boost(test, boost.BoostModel.load(spark, str(tmp_path / "b")), "x", "pred", "s")
    assert scored.select("x", "s", "pred").exceptAll(again.select("x", "s", "pred")).count() == 0


def test_samples_are_those_of_the_column(spark):
    cfg = boost.BoostConfig()
    for rnd in (0, 7):
        rows = spark.range(3000).select("id", boost.sampled(F.col("id"), rnd, cfg).alias("s")).collect()
        got = boost._sampled(np.array([r.id for r in rows]), rnd, cfg)
        assert got.tolist() == [r.s for r in rows] and 0.77 < got.mean() < 0.83
    assert len(boost.columns_of(3, 1, 64, cfg)) == 51


def test_refuses_ragged_or_no_rows(spark):
    for rows in ([], [([1.0], 0), ([1.0, 2.0], 1)]):
        with pytest.raises(ValueError, match="one width"):
            boost.fit_boost(spark.createDataFrame(rows, "x array<double>, y int"), ["a", "b"])


def test_constant_features_leave_single_leaves(spark):
    m = boost.fit_boost(spark.createDataFrame([([1.0], i % 2) for i in range(40)], "x array<double>, y int"),
                        ["a", "b"], boost.BoostConfig(rounds=2))
    assert len(m.nodes) == 4 and (m.nodes.feature < 0).all()


def test_a_round_over_blocks_is_one_job_and_ways_agree(spark, monkeypatch):
    cfg = boost.BoostConfig(rounds=5, depth=3)
    train = table(spark).checkpoint()
    one = boost.fit_boost(train, ["a", "b", "c"], cfg)
    monkeypatch.setattr(boost, "BLOCK_ROWS", 170)
    monkeypatch.setattr(boost, "CLASS_KEEP_ROUNDS", 2)
    levels = []
    monkeypatch.setattr(boost, "_find_by_level", lambda *a, f=boost._find_by_level: levels.append(a[2]) or f(*a))
    by_class = boost.fit_boost(train, ["a", "b", "c"], cfg)
    assert not levels
    by_level = boost.fit_boost(train, ["a", "b", "c"], cfg, by_level=True)
    assert levels == [0, 1, 2, 3, 4]
    monkeypatch.setattr(boost, "WHOLE_BYTES", 1000)
    boost.fit_boost(train, ["a", "b", "c"], boost.BoostConfig(rounds=1, depth=2))
    assert levels == [0, 1, 2, 3, 4, 0]      # too large for a task: level by level
    for m in (by_class, by_level):
        a, b = nodes_of(one), nodes_of(m)
        for c in ("round", "cls", "node", "feature", "threshold", "left", "right"):
            assert (a[c] == b[c]).all()
        assert np.allclose(a[["g", "h", "value"]], b[["g", "h", "value"]], atol=1e-9)
        assert np.allclose(one.losses, m.losses) and len(m.losses) == 5


def test_a_worker_without_rows_or_behind_catches_up():
    cfg, rng = boost.BoostConfig(depth=3), np.random.default_rng(1)
    n = 200
    r = {"n": n, "bins": rng.integers(0, 9, (n, 4), np.uint8).tobytes(), "y": rng.integers(0, 3, n).astype("<i4").tobytes(),
         "rid": np.arange(n, dtype="<i8").tobytes(), "scores": None}
    block, new = boost.Block(r, n_classes=3), []
    for rnd in range(4):
        new.append(boost._round(block, rnd, range(3), 9, cfg))
        block.learn(new[-1], cfg)
    boost._HELD.clear()
    for rounds in (2, 3, 3, 4):     # a new worker, one behind, a repeated task
        got = boost._caught_up("f", iter([r]), 0, new[:rounds], 3, cfg)
        assert boost._HELD["f"][0] == rounds
    assert np.array_equal(got.scores, block.scores)
    kept = {**r, "scores": block.scores.tobytes()}
    assert np.array_equal(boost._caught_up("other", iter([kept]), 4, [], 3, cfg).scores, block.scores)
    assert list(boost._HELD) == ["other"]
    boost._HELD.clear()


def many(n=40_000, d=8, classes=3, seed=3):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 64, (n, d), np.uint8)
    y = ((bins[:, 0] > 30).astype(int) + (rng.random(n) < bins[:, 1] / 80)).astype("<i4")
    return boost.Block({"n": n, "bins": bins.tobytes(), "y": y.tobytes(), "rid": np.arange(n, dtype="<i8").tobytes(),
                        "scores": None}, n_classes=classes)


def test_many_rows_grow_the_same_trees_from_fewer_sums(monkeypatch):
    block, cfg, summed = many(), boost.BoostConfig(depth=6), []
    count = lambda x, w, n, f=np.bincount: summed.append(len(x)) or f(x, w, n)
    block.learn(boost._round(block, 0, range(3), 64, cfg), cfg)     # rows then differ in g and h
    trees = boost._round(block, 1, range(3), 64, cfg)
    monkeypatch.setattr(boost.np, "bincount", lambda x, w=None, n=0, minlength=0: count(x, w, n or minlength))
    again = boost._round(block, 1, range(3), 64, cfg)
    few, summed[:] = sum(summed), []
    monkeypatch.setattr(boost, "MANY_ROWS", 1 << 40)
    plain = boost._round(block, 1, range(3), 64, cfg)
    assert few < 0.7 * sum(summed)
    for a, b, c in zip(trees, again, plain):
        assert len(a.g) == len(c.g) > 60 and list(a.g) == list(b.g)
        for name in ("feature", "cut", "left", "right"):
            assert list(getattr(a, name)) == list(getattr(c, name))
        assert np.allclose(a.g, c.g, atol=1e-7) and np.allclose(a.h, c.h, atol=1e-7)


def test_both_ways_down_a_tree_end_alike(monkeypatch):
    block, cfg = many(9000), boost.BoostConfig()
    for t in boost._round(block, 0, range(3), 64, cfg):
        assert len(t.g) > 100
        by_node = t.leaves(block.bins, cfg.depth)
        assert np.array_equal(by_node, t.leaves(np.ascontiguousarray(block.bins), cfg.depth))
        monkeypatch.setattr(boost, "BYTE_ROWS", 1000)
        assert np.array_equal(by_node, t.leaves(block.bins, cfg.depth))


def test_rounds_after_the_first_read_no_rows_again(spark, monkeypatch):
    monkeypatch.setattr(boost, "BLOCK_ROWS", 170)
    reads = []
    monkeypatch.setattr(boost, "_class_task", lambda *a, f=boost._class_task: reads.append(a[-1]) or f(*a))
    m = boost.fit_boost(table(spark), ["a", "b", "c"], boost.BoostConfig(rounds=30, depth=2))
    # each worker reads the rows once, whatever their number
    assert len(m.losses) == 30 and reads[0] and reads.count(False) == 29 and reads.count(True) < 20


def test_many_trees_are_walked_as_joins_walk_them(spark):
    from vigil.plans.model_checks import walk, walk_many
    m = boost.fit_boost(table(spark, 300), ["a", "b", "c"], boost.BoostConfig(rounds=3, depth=4))
    rows = [(i, [float(v) for v in np.random.default_rng(i).normal(size=6)]) for i in range(200)]
    rows += [(7, rows[3][1]), (None, rows[4][1]), (500, [float("nan")] * 6), (501, None), (502, [0.1, None, 0.2, 0.0, 0.0, 0.0])]
    of = spark.createDataFrame(rows, "id long, x array<double>")
    nodes = m.nodes.assign(tree=m.nodes["round"] * 3 + m.nodes["cls"])
    table_ = m.table(spark).withColumn("tree", F.col("round") * 3 + F.col("cls"))
    joined = walk(of, table_, 9, 4, "id", "x")
    got = walk_many(of, nodes, 4, "id", "x", False)
    assert sorted(map(str, got.collect())) == sorted(map(str, joined.collect()))
    sums = walk_many(of, nodes, 4, "id", "x", True).groupBy("id", "cls").agg(F.sum("s").alias("s")).where("id < 400")
    want = joined.join(table_.select("tree", "node", "cls", "value"), ["tree", "node"]).groupBy("id", "cls") \
        .agg(F.sum("value").alias("w"))
    apart = sums.join(want, ["id", "cls"]).agg(F.count("*"), F.max(F.abs(F.col("s") - F.col("w")))).first()
    assert apart[0] == 600 and apart[1] < 1e-9
