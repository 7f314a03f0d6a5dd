"""Hard negatives by threshold joins in the manner of L2AP.

Every anchor asks twice: for its best rows of its own label (positives), then for the
best rows of other labels below each positive's score (negatives).  A question is a
join of the anchors with all rows at a score threshold:

* Dimensions are ordered by their energy over all rows.  Blocks of rows hold an inverted
  index by groups of dimensions: a row is listed under the leading ones alone, up to
  where the norms of what is left of it and of the anchors cannot make up the threshold.
* Partial scores are accumulated along the index; a row is pruned as soon as its partial
  score and the remaining norms stay below the threshold of every anchor, a block for an
  anchor whose bound over the block's box does.  What is left is completed exactly.
* The first threshold of an anchor is where, by the means and covariances of all rows,
  some 20 rows are expected.  Anchors whose windows are not full lower it (16 times as
  many rows each time) and ask again, until they are full or nothing lower may count.

Anchors meet all rows block by block: they are broadcast below a counted size, and
beyond it pairs of block numbers are dealt to tasks and both blocks joined to them.  Equal
scores are settled by id.  No candidate is dropped below a threshold that a full window
did not set.

Defined cases: rows without id or label, without a vector, or with a null or non-finite
component take no part; vectors of different lengths are not compared; rows that repeat
whole count once; rows that share an id but differ are rows of their own, never partners
of each other, and the one with the smallest label and vector is the anchor; a score that
does not fit a long fails the job; other columns are not looked at.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.frames import freeze, parallelism

POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100          # percent of a positive's score that a negative's may have
EXPECTED, WIDER = 20, 16     # rows above the first threshold, and how that grows
BLOCK_ROWS, ANCHOR_ROWS, DIMS = 2048, 256, 16
BROADCAST_BYTES = 16 << 20
_NONE = np.iinfo(np.int64).min


# ------------------------------------------------------------------------- input
def whole_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(id, label, vec) of the rows that take part, components as floor(scale * x)."""
    x = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                             x.alias("x")).where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return rows.where(finite).select("id", "label", F.transform(
        "x", lambda v: F.floor(v * float(scale)).cast("long")).alias("vec"))


def _moments(batches):
    """(d, i, j, s): sums of products of components, and under j = -1 of components."""
    sums: dict = {}
    for b in batches:
        by: dict = {}
        for v in b.column(0).to_pylist():
            by.setdefault(len(v), []).append(v)
        for d, vs in by.items():
            x = np.array(vs, float).reshape(len(vs), d)
            old = sums.get(d, (0, 0, 0))
            sums[d] = (old[0] + len(vs), old[1] + x.sum(axis=0), old[2] + x.T @ x)
    for d, (n, s, p) in sums.items():
        i, j = np.indices((d, d)).reshape(2, -1)
        rows = [(np.array([-1]), np.array([-1]), np.array([float(n)])), (np.arange(d), np.full(d, -1), s), (i, j, p.ravel())]
        for i, j, s in rows:
            yield pa.record_batch([pa.array(np.full(len(s), d), pa.int32()), pa.array(i, pa.int32()),
                                   pa.array(j, pa.int32()), pa.array(s, pa.float64())], names=["d", "i", "j", "s"])


def moments(vectors: DataFrame) -> dict[int, tuple]:
    """Length -> (order of dimensions, mean, covariance): bounded by the vectors' length."""
    rows = vectors.select("vec").mapInArrow(_moments, "d int, i int, j int, s double") \
        .groupBy("d", "i", "j").agg(F.sum("s").alias("s")).toPandas()
    out = {}
    for d, part in rows.groupby("d"):
        d, mean, square = int(d), np.zeros(int(d)), np.zeros((int(d), int(d)))
        n = part.s[part.i < 0].iloc[0]
        one, two = part[(part.i >= 0) & (part.j < 0)], part[part.j >= 0]
        mean[one.i] = one.s / n
        square[two.i, two.j] = two.s / n
        out[d] = (np.argsort(-np.diag(square), kind="stable"), mean, square - np.outer(mean, mean))
    return out


# ------------------------------------------------------------------------ blocks
_ROWS = "label long, d int, ids binary, vecs binary"


def _blocks(size: int, stats: dict, *more: str):
    """Sorted rows as blocks of one label and length; dimensions in the order of their energy."""
    def emit(key, rows):
        label, d = key
        vecs = np.array([r["vec"] for r in rows], np.int64).reshape(len(rows), d)
        cols = [pa.array([label], pa.int64()), pa.array([d], pa.int32()),
                pa.array([np.array([r["id"] for r in rows], "<i8").tobytes()], pa.binary()),
                pa.array([vecs[:, stats[d][0]].astype("<i8").tobytes()], pa.binary()),
                *[pa.array([np.array([r[c] for r in rows], "<f8" if c == "t" else "<i8").tobytes()], pa.binary())
                  for c in more]]
        return pa.record_batch(cols, names=["label", "d", "ids", "vecs", *more])

    def run(batches):
        key, rows, last = None, [], None
        for b in batches:
            for r in b.to_pylist():
                now = (r["label"], len(r["vec"]))
                if rows and (now != key or len(rows) == size):
                    yield emit(key, rows)
                    rows = []
                if r != last:       # rows that repeat whole stand side by side
                    rows.append(r)
                key, last = now, r
        if rows:
            yield emit(key, rows)
    return run


def row_blocks(vectors: DataFrame, stats: dict) -> DataFrame:
    """All rows in blocks, ordered by label and the cells of the two strongest dimensions."""
    parts = parallelism(vectors)
    strong = next(iter(stats.values()))[0][:2] if stats else []
    cells = [F.floor(F.get("vec", int(j)) / 64) for j in strong]
    order = ["label", F.size("vec"), *cells, "id", "vec"]
    dealt = vectors.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # 128 KB or more a row: written as they are, numbered by their ids' hash
    return freeze(dealt.mapInArrow(_blocks(BLOCK_ROWS, stats), _ROWS)
                  .withColumn("key", F.xxhash64("label", "d", "ids", "vecs")), "blocks")


def _ask(anchors: DataFrame, stats: dict, *more: str) -> DataFrame:
    """Anchors with their thresholds in blocks."""
    n = -(-anchors.count() // (8 * ANCHOR_ROWS))
    order = ["label", F.size("vec"), "id"]
    dealt = anchors.repartitionByRange(max(1, n), *order).sortWithinPartitions(*order)
    blocks = dealt.mapInArrow(_blocks(ANCHOR_ROWS, stats, *more),
                              _ROWS + "".join(f", {c} binary" for c in more))
    return freeze(blocks.select(*[F.col(c).alias(f"a_{c}") for c in blocks.columns],
                                F.xxhash64("label", "d", "ids").alias("a_key")), "anchors")


def _met(blocks: DataFrame, anchors: DataFrame, own_label: bool) -> DataFrame:
    """Each block of rows with each block of anchors that asks for its label."""
    asks = (F.col("d") == F.col("a_d")) & ((F.col("label") == F.col("a_label")) if own_label
                                           else (F.col("label") != F.col("a_label")))
    size = anchors.agg(F.sum(F.length("a_ids") + F.length("a_vecs"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return blocks.join(F.broadcast(anchors), asks)
    pairs = blocks.select("key", "label", "d").join(anchors.select("a_key", "a_label", "a_d"), asks) \
        .select(F.col("key").alias("_k"), F.col("a_key").alias("_a"))
    pairs = freeze(pairs, "pairs")
    deal = max(parallelism(blocks), -(-pairs.count() // 32))
    return pairs.repartition(deal, "_k", "_a").join(anchors, F.col("_a") == F.col("a_key")) \
        .join(blocks, F.col("_k") == F.col("key")).drop("_k", "_a")


# -------------------------------------------------------------------------- join
def _suffix_norms(x: np.ndarray, at: list[int]) -> np.ndarray:
    """Norms of what is left of each row from each of the places on."""
    sq = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    sq = np.concatenate([sq, np.zeros((len(x), 1))], axis=1)
    return np.sqrt(sq[:, at]) * (1 + 1e-9)


def reach(a: np.ndarray, x: np.ndarray, t: np.ndarray, dims: int = DIMS) -> tuple:
    """(anchor, row, score) of every pair with a score of at least the anchor's threshold.

    ``a`` and ``x`` hold whole numbers; scores are exact.
    """
    d = a.shape[1]
    if not d or float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * d >= 2.0 ** 53:
        s = a.astype(object) @ x.T.astype(object) if d else np.zeros((len(a), len(x)), object)
        i, j = np.nonzero(s >= t[:, None])
        return i, j, np.array([int(v) for v in s[i, j]], object)
    a, x = a.astype(float), x.astype(float)
    # a block's box: no row of it scores higher with an anchor
    best = np.maximum(a, 0) @ x.max(axis=0) + np.minimum(a, 0) @ x.min(axis=0)
    asking = np.flatnonzero(best >= t)
    if not len(asking):
        return (np.zeros(0, int),) * 3
    a, t = a[asking], t[asking]
    at = [*range(0, d, dims), d]
    na, nx = _suffix_norms(a, at), _suffix_norms(x, at)
    # the inverted index: a row is listed under the groups before the first covered place
    covered = nx * na.max(axis=0) < t.min()
    listed = np.where(covered.any(axis=1), covered.argmax(axis=1), len(at) - 1)
    order = np.argsort(-listed, kind="stable")
    x, nx, listed = x[order], nx[order], listed[order]
    alive = np.flatnonzero(listed > 0) if (t > 0).all() else np.arange(len(x))
    acc = np.zeros((len(a), len(x)))
    for k, (i, j) in enumerate(zip(at[:-1], at[1:])):
        here = alive[listed[alive] > k]
        acc[:, here] += a[:, i:j] @ x[here, i:j].T
        rest = np.minimum(k + 1, listed[alive])      # where each row's listed part ends so far
        bound = acc[:, alive] + na[:, rest] * nx[alive, rest]
        alive = alive[(bound >= t[:, None] - 1e-6).any(axis=0)]
        if not len(alive):
            return (np.zeros(0, int),) * 3
    for k, (i, j) in enumerate(zip(at[:-1], at[1:])):     # what was not listed
        left = alive[listed[alive] <= k]
        if len(left):
            acc[:, left] += a[:, i:j] @ x[left, i:j].T
    s = acc[:, alive]
    i, j = np.nonzero(s >= t[:, None])
    return asking[i], order[alive[j]], s[i, j].astype(np.int64)


def _pair(r) -> tuple:
    d = r["d"]
    ids, a_ids = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["a_ids"], "<i8")
    i, j, s = reach(np.frombuffer(r["a_vecs"], "<i8").reshape(len(a_ids), d),
                    np.frombuffer(r["vecs"], "<i8").reshape(len(ids), d), np.frombuffer(r["a_t"], "<f8"))
    other = a_ids[i] != ids[j]
    i, j, s = i[other], j[other], s[other]
    by = np.lexsort((ids[j], -s, i))
    return a_ids, i[by], ids[j[by]], s[by]


def _found(anchor, slot, other, score) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, pa.int64()) for c in (anchor, slot, other, score)],
                           names=["anchor", "slot", "other", "score"])


def _nth(groups: np.ndarray) -> np.ndarray:
    """Place of each element among equal neighbours."""
    at = np.arange(len(groups))
    new = np.ones(len(groups), bool)
    new[1:] = groups[1:] != groups[:-1]
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _best(k: int):
    """The first k of each anchor in a block."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                a_ids, i, other, s = _pair(r)
                top = _nth(i) < k
                if top.any():
                    yield _found(a_ids[i[top]], np.zeros(top.sum(), int), other[top], s[top])
    return run


def _windows(k: int, width: int):
    """The first k of each anchor in a block below each of its positives' scores."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                a_ids, i, other, s = _pair(r)
                if not len(i):
                    continue
                p = np.frombuffer(r["a_p"], "<i8").reshape(len(a_ids), width)
                for slot in range(width):
                    q = p[i, slot]
                    ok = (q != _NONE) & (s <= q) & (HIGH * s >= LOW * q)
                    at = np.flatnonzero(ok)
                    at = at[_nth(i[at]) < k]
                    if len(at):
                        yield _found(a_ids[i[at]], np.full(len(at), slot), other[at], s[at])
    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


_FOUND = "anchor long, slot long, other long, score long"


def _threshold(stats: dict, step: int):
    """Adds ``t``: the score above which ``EXPECTED * WIDER ** step`` of ``n`` rows are
    expected beyond those over ``under`` (null: over any score); -inf where that is all."""
    normal = NormalDist()

    def run(batches):
        for b in batches:
            out = []
            for r in b.select(["vec", "n", "under"]).to_pylist():
                v, d = np.array(r["vec"], float), len(r["vec"])
                mean, var = (float(stats[d][1] @ v), float(v @ stats[d][2] @ v)) if d else (0.0, 0.0)
                sd = math.sqrt(max(var, 0.0))
                above = 0.0 if r["under"] is None or not sd else 1 - normal.cdf((r["under"] - mean) / sd)
                share = above + EXPECTED * WIDER ** step / max(r["n"], 1)
                out.append(mean + sd * normal.inv_cdf(1 - share) if share < 1 else -math.inf)
            yield b.append_column("t", pa.array(out, pa.float64()))
    return run


def _asked(anchors: DataFrame, stats: dict, step: int, floor: Column | None = None) -> DataFrame:
    schema = ", ".join(f"`{c}` {t}" for c, t in anchors.dtypes)
    asked = anchors.mapInArrow(_threshold(stats, step), schema + ", t double")
    return asked if floor is None else asked.withColumn("t", F.greatest("t", floor))


def _until_full(anchors: DataFrame, ask, full: Column) -> DataFrame:
    """Ask with lower and lower thresholds until ``full`` holds for every anchor.

    ``ask(open, step)`` returns the asked anchors and what they found.
    """
    step, still, parts = 0, anchors, []
    while True:
        asked, found = ask(still, step)
        counts = found.groupBy(F.col("anchor").alias("_a")).agg(
            F.collect_list("slot").alias("slots"))       # at most k a slot
        state = freeze(asked.join(counts, F.col("id") == F.col("_a"), "left").withColumn(
            "slots", F.coalesce("slots", F.array().cast("array<long>"))).withColumn("_full", full), "state")
        done = state.where("_full").select(F.col("id").alias("_a"))
        parts.append(found.join(done, F.col("anchor") == F.col("_a")).drop("_a"))
        still = state.where("NOT _full").select(*anchors.columns)
        if not still.count():
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
            return out
        step += 1


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES,
                   negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` and ``anchors`` are (id, label, vec array<long>); anchors are some of the vectors.
    """
    vectors = freeze(vectors, "vectors")
    stats = moments(vectors)
    blocks = row_blocks(vectors, stats)
    per_label = blocks.groupBy(F.col("label").alias("_l"), F.col("d").alias("_d")).agg(
        F.sum(F.length("ids") / 8).cast("long").alias("n_own"))
    per_length = per_label.groupBy(F.col("_d").alias("_e")).agg(F.sum("n_own").alias("n_all"))
    one = anchors.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("s")).select("id", "s.label", "s.vec")
    base = freeze(one.join(per_label, (F.col("label") == F.col("_l")) & (F.size("vec") == F.col("_d")))
                  .join(F.broadcast(per_length), F.size("vec") == F.col("_e"))   # one row a vector length
                  .select("id", "label", "vec", "n_own", "n_all"), "asking")

    def ask_own(still, step):
        asked = freeze(_asked(still, stats, step), "asked")
        met = _met(blocks, _ask(asked, stats, "t"), own_label=True)
        return asked, freeze(_first(met.mapInArrow(_best(positives), _FOUND), positives), "found")

    own = base.withColumn("n", F.col("n_own")).withColumn("under", F.lit(None).cast("double"))
    enough = (F.col("t") == float("-inf")) | (F.size("slots") >= positives)
    best = freeze(_until_full(own, ask_own, enough).select(
        F.col("anchor").alias("_anchor"), (F.col("rank") - 1).cast("long").alias("_slot"),
        F.col("other").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # a window below a negative score is empty
    scores = best.where("positive_score >= 0").groupBy("_anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("_slot", "positive_score"))).alias("m"),
        F.min("positive_score").cast("double").alias("under"))
    slots = F.array(*[F.coalesce(F.try_element_at("m", F.lit(k).cast("long")), F.lit(int(_NONE)))
                      for k in range(positives)])
    below = freeze(base.join(scores, F.col("id") == F.col("_anchor")).select(
        "id", "label", "vec", (F.col("n_all") - F.col("n_own")).alias("n"), "under", slots.alias("p")), "below")

    def ask_others(still, step):
        # nothing below this share of the lowest positive counts
        asked = freeze(_asked(still, stats, step, F.col("under") * (LOW / HIGH) - 0.5), "asked")
        met = _met(blocks, _ask(asked, stats, "t", "p"), own_label=False)
        return asked, freeze(_first(met.mapInArrow(_windows(negatives, positives), _FOUND), negatives), "found")

    settled = F.forall(F.sequence(F.lit(0), F.lit(positives - 1)), lambda k: (
        (F.get("p", k) == int(_NONE)) | (F.col("t") <= F.get("p", k) * (LOW / HIGH))
        | (F.size(F.filter("slots", lambda s: s == k)) >= negatives)))
    found = _until_full(below, ask_others, settled)
    return found.join(best, (F.col("anchor") == F.col("_anchor")) & (F.col("slot") == F.col("_slot"))).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine(embeddings: DataFrame, every: int = 100, moved: int = 7, labels: int = 10) -> DataFrame:
    """The contract's anchors (ids divisible by ``every``) and labels (those of ids divisible by ``moved`` move on)."""
    rows = whole_vectors(embeddings)
    rows = rows.withColumn("label", F.when(F.col("id") % moved == 0, (F.col("label") + 1) % labels)
                           .otherwise(F.col("label")))
    return hard_negatives(rows, rows.where(F.col("id") % every == 0))
