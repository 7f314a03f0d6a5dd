"""Mixtures, prefix tries and hard negatives against plain versions."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from vigil.llm import mixture, negatives, trie


# ----------------------------------------------------------------------- mixture
def plain_mix(rows, weights=(3, 1, 2)):
    sized = [(i, s, len(cases.WORD.findall(t or ""))) for i, t, s in rows]
    sources = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(n for _, q, n in sized if q == s) for s in sources}
    w = {s: weights[k % 3] for k, s in enumerate(sources)}
    capped, total = set(), 1.5 * sum(size.values())
    while True:
        free = [s for s in sources if s not in capped]
        level = (total - sum(2 * size[s] for s in capped)) / (sum(w[s] for s in free) or 1)
        over = {s for s in free if w[s] * level > 2 * size[s]}
        if not over:
            break
        capped |= over
    target = {s: 2.0 * size[s] if s in capped else w[s] * level for s in sources}
    return sized, size, target


def mix_rows():
    rows = [(i, t, f"s{(i or 0) % 4}" if (i or 0) % 5 else None) for i, t in cases.odd_texts()]
    return rows + [(500, "equal words here", "s1")] * 700 + [(None, "one two", "s2")] * 30 + [(900, None, "zero")]


def mix_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                                 "doc_id long, text string, source string, size long, key string, pieces int")


@pytest.mark.parametrize("parts,run", [(1, 4096), (7, 50)])
def test_mix_like_plain_version(spark, monkeypatch, parts, run):
    monkeypatch.setattr(mixture, "COPIES_A_RUN", run)
    rows = mix_rows()
    sized, size, target = plain_mix(rows)
    got = mixture.mixture(mix_frame(spark, rows).repartition(parts)).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(sized)
    taken = Counter()
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        n = sum(p.end - p.start for p in r.pieces)
        assert 0 <= n <= 2 * r.size
        taken[r.source] += n
        for k in (0, 1):     # pieces of a pass follow one another
            p = sorted((p.start, p.end) for p in r.pieces if p["pass"] == k)
            assert all(0 <= a < b <= r.size for a, b in p) and all(x[1] == y[0] for x, y in zip(p, p[1:]))
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_mix_does_not_depend_on_partitions(spark):
    digests = [sorted(map(tuple, mixture.mix_digest(mix_frame(spark, mix_rows()).repartition(n)).collect()), key=repr)
               for n in (2, 5)]
    assert digests[0] == digests[1]


def test_shards_get_equal_shares_and_all_quotas(spark):
    q = spark.range(1).select(F.expr("array(5000L, 1L, 0L, 777L, 40L)").alias("quotas"))
    for n in (1, 2, 7, 64):
        rows = mixture.shard_quotas(q, n).orderBy("shard").collect()
        assert [r.shard for r in rows] == list(range(n))
        assert np.sum([r.quotas for r in rows], axis=0).tolist() == [5000, 1, 0, 777, 40]
        sizes = [sum(r.quotas) for r in rows]
        assert min(min(r.quotas) for r in rows) >= 0 and max(sizes) - min(sizes) <= (n - 1).bit_length()


def test_hypergeometric_draws_are_such(spark):
    """Mean and variance over even quantiles are those of the distribution."""
    for pop, marked, drawn in ((100, 30, 50), (5000, 7, 2500), (60, 60, 20), (10, 0, 4), (100000, 33333, 50000)):
        sql = mixture.hypergeometric(f"{pop}L", f"{marked}L", f"{drawn}L", "(id + 0.5D) / 2000")
        x = np.array([r[0] for r in spark.range(2000).selectExpr(f"{sql} AS x").collect()])
        mean = drawn * marked / pop
        var = mean * (1 - marked / pop) * (pop - drawn) / (pop - 1)
        assert abs(x.mean() - mean) < 0.01 * math.sqrt(var) + 0.01
        assert abs(x.var() - var) < 0.03 * var + 0.1 and (np.diff(x) >= 0).all()


def test_mixed_texts_hold_the_pieces(spark):
    rows = [r for r in mix_rows() if r[0] not in (500, None)]
    df = mix_frame(spark, rows)
    texts = mixture.mixed_texts(df, words_a_shard=100).collect()
    words = Counter()
    for r in texts:
        words[r.source] += len(cases.WORD.findall(r.text))
    _, _, target = plain_mix(rows)
    # a doc_id that repeats with the same text is taken once for each row
    assert all(abs(words[s] - t) <= 1 for s, t in target.items())
    assert len({r.shard for r in texts}) > 16


def test_empty_mix(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixture.mix_digest(df).count() == 0
    one = spark.createDataFrame([(1, None, None), (2, "", "a")], df.schema)
    assert sorted(map(tuple, mixture.mix_digest(one).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


# -------------------------------------------------------------------------- trie
def plain_trie(rows):
    own: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0, role or ""), (role or "", text or "")))
    own = {c: [x for _, x in sorted(v, key=lambda p: p[0])] for c, v in own.items()}
    members: dict = {}
    ends: dict = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seq = (own.get(c - c % 100) or [])[:h] + turns[h:]
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
        ends.setdefault(tuple(seq), []).append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    return sorted((min(cs), len(p), min(members[p[:-1]]) if p else -1, len(cs), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
                  for p, cs in members.items())


def trie_rows():
    rnd = np.random.default_rng(4)
    rows = []
    for c in [*range(0, 60), *range(100, 140), 205, 1100, 1107]:
        path = rnd.integers(0, 2, int(rnd.integers(1, 12)))
        rows += [(c, k, "user" if k % 2 else "system", f"t{k} é{x}") for k, x in enumerate(path)]
    rows += [(300, k, "u", f"long {k}") for k in range(150)] + [(301, k, "u", f"long {k}") for k in range(150)]
    rows += [(k, 0, "system", "hub") for k in range(400, 480)] + [(k, 1, "user", f"own {k}") for k in range(400, 480)]
    rows += [(601, None, None, None), (601, 2, "u", ""), (602, 1, None, "x"), (None, 1, "u", "lost"),
             (603, 1, "u", "twice"), (603, 1, "u", "twice"), (604, 0, "u", "a" * 5000)]
    return rows


def trie_of(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, b"k", "x") for r in rows],
                               "conv_id long, turn long, role string, text string, n int, keys binary, top string")
    out = trie.prefix_trie(trie.rebuilt(df.repartition(parts))).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *tuple(r)[3:]) for r in out)


def test_trie_like_plain_version(spark):
    assert trie_of(spark, trie_rows()) == plain_trie(trie_rows())


def test_small_tries(spark):
    for rows in ([], [(5, 0, "u", "x")], [(100, 0, "u", "x"), (101, 0, "u", "x"), (102, 0, "u", "y")],
                 [(7, None, None, None)] * 9):
        assert trie_of(spark, rows) == plain_trie(rows)


# --------------------------------------------------------------------- negatives
def plain_negatives(rows):
    use, seen = [], set()
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        key = (i, tuple(v), label)
        if key not in seen:
            seen.add(key)
            use.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for a, la, va in use:
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(va, v)), i, la == label)
                        for i, label, v in use if i != a and len(v) == len(va))
        for ps, pid, _ in [x for x in scored if x[2]][:5]:
            near = [(n, i) for n, i, same in scored if not same and 80 * -ps <= 100 * -n <= 100 * -ps][:5]
            out += [(a, pid, k, i, -ps, -n) for k, (n, i) in enumerate(near, 1)]
    return sorted(out)


def negative_rows():
    rng = np.random.default_rng(8)
    rows = []
    for i in range(700):
        v = rng.normal(size=20)
        v[:3] *= 4
        rows.append((i, (v / np.linalg.norm(v)).tolist(), int(rng.integers(0, 4))))
    rows += [(700 + k, rows[3][1], k % 3) for k in range(60)] + [(i, rows[100][1], 2) for i in (801, 803, 804)]
    rows += [(1000, rows[0][1], 8), (1001, rows[1][1], 8), (1100, rows[5][1], 9), (1200, [0.0] * 20, 1),
             (1300, [1.0, 2.0], 1), (1301, [1.0, 1.5], 1), (1302, [1.0, 1.9], 0), (1400, [], 1), (1401, [], 1),
             (1402, [], 2), (1500, None, 1), (1600, [1.0, None], 1), (1700, [float("nan")] * 20, 1),
             (1800, [1.0] * 20, None), (None, [1.0] * 20, 1), rows[100], rows[200], rows[200],
             (1900, (-np.array(rows[0][1])).tolist(), 5), (2000, [1e6, 3.0], 3), (2001, [1e6, 2.0], 3), (2002, [9e5, 1.0], 4)]
    return rows


@pytest.mark.parametrize("block,broadcast", [(2048, 16 << 20), (37, 16 << 20), (100, 0)])
def test_negatives_like_plain_version(spark, monkeypatch, block, broadcast):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "BROADCAST_BYTES", broadcast)
    rows = negative_rows()
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows],
                               "vec_id long, embedding array<double>, label int, id int, n int, key string")
    assert sorted(map(tuple, negatives.mine(df.repartition(4)).collect())) == plain_negatives(rows)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.mine(df).count() == 0
    df = spark.createDataFrame([(100, [1.0], 1), (101, [1.0], None)], df.schema)
    assert negatives.mine(df).count() == 0


def test_reach_is_exact_whatever_the_threshold():
    rng = np.random.default_rng(1)
    a, x = rng.integers(-99, 99, (7, 50)), rng.integers(-99, 99, (300, 50))
    x[:, 20:] //= 20
    s = a @ x.T
    for t in (np.full(7, -np.inf), np.quantile(s, 0.99, axis=1), np.quantile(s, 0.5, axis=1), np.full(7, 1e9)):
        i, j, found = negatives.reach(a, x, t)
        assert sorted(zip(i, j, found)) == [(p, q, s[p, q]) for p, q in zip(*np.nonzero(s >= t[:, None]))]
