"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors of one label have a cosine of at least ``threshold`` exactly if
their distance is at most epsilon = sqrt(2 - 2 threshold).

1. Equal vectors of a label fold to one with a count.
2. The leading principal directions come from sums over all vectors.  Vectors are
   sorted by label and by their cells of side epsilon on those directions
   (range-partitioned, the epsilon grid order) and cut into blocks of the sequence.
3. The sequence intervals are joined recursively: from the whole sequence down to
   the blocks, pairs of intervals of one label go on only while their bounding
   boxes on the principal directions are within epsilon.
4. Block pairs that are left are compared in double precision.  A task returns for
   each vector its number of links and a spanning forest of them, never the pairs.

The components of the forests are the components of all links.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
numbers, and rows without label, link with nothing; vectors of different
lengths are not compared; rows are vectors of their own also where they repeat;
a null vec_id orders before all others; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.frames import freeze, parallelism
from vigil.llm.graph import components
from vigil.llm.groups import spanning

THRESHOLD = 0.98
GRID, BOX = 4, 12            # directions that order the sequence, and that bound blocks
BLOCK_ROWS, PAIRS_A_TASK = 1024, 32
FAN_BITS = 4                 # an interval has 16 parts
NO_ID, _NO_IDS = -(1 << 63), 1 << 61


def units(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _can_link():
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col("label").isNotNull() & F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False)) \
        & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False))


def _keys() -> dict:
    """A 128-bit name of a label and its vector."""
    return {"k1": F.xxhash64("label", "vec"), "k2": F.xxhash64(F.lit(3), "label", "vec")}


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of products of the unit vectors, by dimension."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        by: dict[int, list] = {}
        for v in b.column(0).to_pylist():
            by.setdefault(len(v), []).append(v)
        for d, vs in by.items():
            u = units(vs)
            sums[d] = sums.get(d, 0) + u.T @ u
    for d, s in sums.items():
        i, j = np.indices(s.shape)
        yield pa.record_batch([pa.array(np.full(s.size, d, np.int32)), pa.array(i.ravel().astype(np.int32)),
                               pa.array(j.ravel().astype(np.int32)), pa.array(s.ravel())],
                              names=["d", "i", "j", "s"])


def directions(vecs: DataFrame) -> dict[int, np.ndarray]:
    """The leading principal directions of each vector length, as columns."""
    rows = vecs.select("vec").mapInArrow(_moments, "d int, i int, j int, s double") \
        .groupBy("d", "i", "j").agg(F.sum("s").alias("s")).toPandas()
    out = {}
    for d, part in rows.groupby("d"):
        m = np.zeros((d, d))
        m[part.i, part.j] = part.s
        out[int(d)] = np.linalg.eigh(m)[1][:, ::-1][:, :BOX]
    return out


def _ordered(axes: dict, epsilon: float):
    """Each vector with its place in the grid order."""
    def run(batches):
        for b in batches:
            vecs = b.column(3).to_pylist()
            cells = np.zeros((len(vecs), GRID), np.int32)
            for d in {len(v) for v in vecs}:
                rows = [i for i, v in enumerate(vecs) if len(v) == d]
                p = units([vecs[i] for i in rows]) @ axes[d][:, :GRID]
                cells[rows, :p.shape[1]] = np.floor(p / epsilon)
            yield pa.record_batch([*b.columns, *[pa.array(c) for c in cells.T]],
                                  names=[*b.schema.names, *[f"c{k}" for k in range(GRID)]])
    return run


_BLOCK = ("key long, label long, dim int, " + ", ".join(f"lo{k} double, hi{k} double" for k in range(BOX))
          + ", ids binary, copies binary, vecs binary")


def _blocks(axes: dict):
    """The sorted sequence of a partition, cut into blocks of one label and length."""
    def emit(part, seq, label, rows):
        u = units([r["vec"] for r in rows])
        p = u @ axes[u.shape[1]]
        lo, hi = np.zeros(BOX), np.zeros(BOX)
        lo[:p.shape[1]], hi[:p.shape[1]] = p.min(axis=0), p.max(axis=0)
        box = [float(x) for k in range(BOX) for x in (lo[k], hi[k])]
        return ((part << 32) | seq, label, u.shape[1], *box,
                np.array([r["id"] for r in rows], "<i8").tobytes(),
                np.array([r["n"] for r in rows], "<i8").tobytes(), u.astype("<f8").tobytes())

    def run(batches):
        part, seq, label, rows = TaskContext.get().partitionId(), 0, None, []
        for b in batches:
            for r in b.to_pylist():
                key = (r["label"], len(r["vec"]))
                if rows and (key != label or len(rows) == BLOCK_ROWS):
                    yield _block_batch(emit(part, seq, label[0], rows))
                    seq, rows = seq + 1, []
                label = key
                rows.append(r)
        if rows:
            yield _block_batch(emit(part, seq, label[0], rows))

    return run


def _block_batch(row) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), *[pa.float64()] * (2 * BOX), *[pa.binary()] * 3]
    names = ["key", "label", "dim", *[x for k in range(BOX) for x in (f"lo{k}", f"hi{k}")],
             "ids", "copies", "vecs"]
    return pa.record_batch([pa.array([x], t) for x, t in zip(row, types)], names=names)


def _near_boxes(a: str, b: str, epsilon: float):
    gap = F.lit(0.0)
    for k in range(BOX):
        d = F.greatest(F.col(f"{a}lo{k}") - F.col(f"{b}hi{k}"),
                       F.col(f"{b}lo{k}") - F.col(f"{a}hi{k}"), F.lit(0.0))
        gap = gap + d * d
    return gap <= epsilon * epsilon


def interval_join(blocks: DataFrame, epsilon: float) -> DataFrame:
    """(a, b), a <= b: keys of the blocks of one label that may hold a pair within epsilon."""
    most = blocks.agg(F.max(F.shiftright("key", 32)).alias("p"),
                      F.max(F.col("key").bitwiseAND(0xFFFFFFFF)).alias("s")).first()
    if most["p"] is None:
        return blocks.select(F.col("key").alias("a"), F.col("key").alias("b"))
    seq_bits = int(most["s"]).bit_length()
    bits = int(most["p"]).bit_length() + seq_bits
    place = F.shiftleft(F.shiftright("key", 32), seq_bits).bitwiseOR(F.col("key").bitwiseAND(0xFFFFFFFF))
    leaves = blocks.withColumn("at", place)
    box = [f(f"{x}{k}").alias(f"{x}{k}") for k in range(BOX) for f, x in ((F.min, "lo"), (F.max, "hi"))]

    def nodes(shift: int, prefix: str) -> DataFrame:
        n = leaves.groupBy("label", "dim", F.shiftright("at", shift).alias("at")).agg(
            *box, F.min("key").alias("key"))
        return n.select(*[F.col(c).alias(prefix + c) for c in n.columns])

    shift = -(-bits // FAN_BITS) * FAN_BITS
    pairs = nodes(shift, "a_").select("a_label", "a_dim", "a_at", F.col("a_at").alias("b_at"))
    while shift:
        shift -= FAN_BITS
        a, b = nodes(shift, "a_"), nodes(shift, "b_")
        up = lambda c: F.shiftright(c, FAN_BITS)
        old = pairs.select(F.col("a_label").alias("l"), F.col("a_dim").alias("d"),
                           F.col("a_at").alias("pa"), F.col("b_at").alias("pb"))
        half = old.join(a, (F.col("l") == F.col("a_label")) & (F.col("d") == F.col("a_dim"))
                        & (F.col("pa") == up("a_at")))
        pairs = half.join(b, (F.col("l") == F.col("b_label")) & (F.col("d") == F.col("b_dim"))
                          & (F.col("pb") == up("b_at"))) \
            .where(F.col("a_at") <= F.col("b_at")).where(_near_boxes("a_", "b_", epsilon))
    # at the last level an interval is one block of its label
    return pairs.select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))


def _leaf(threshold: float):
    """Links between two blocks: counts for each vector, and a spanning forest."""
    def run(batches):
        for t in batches:
            for r in t.to_pylist():
                ids, copies, u = [], [], []
                for s in ("a_",) if r["a"] == r["b"] else ("a_", "b_"):
                    ids.append(np.frombuffer(r[s + "ids"], "<i8"))
                    copies.append(np.frombuffer(r[s + "copies"], "<i8"))
                    u.append(np.frombuffer(r[s + "vecs"], "<f8").reshape(len(ids[-1]), r["dim"]))
                m = u[0] @ u[-1].T >= threshold
                if len(u) == 1:
                    np.fill_diagonal(m, False)
                    links = m @ copies[0]
                else:
                    links = np.concatenate([m @ copies[1], m.T @ copies[0]])
                    n, k = m.shape
                    m = np.block([[np.zeros((n, n), bool), m], [m.T, np.zeros((k, k), bool)]])
                at = np.flatnonzero(links)
                if not len(at):
                    continue
                ids, m = np.concatenate(ids)[at], m[np.ix_(at, at)]
                yield _found(ids, np.full(len(ids), None), links[at])
                edges = spanning(len(at), lambda i, js: m[i, js])  # noqa: B023
                x, y = zip(*edges)
                yield _found(ids[list(x)], ids[list(y)], np.zeros(len(x), np.int64))
    return run


def _found(a, b, n) -> pa.RecordBatch:
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())],
                           names=["a", "b", "n"])


def embedding_links(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label)."""
    parts = parallelism(embeddings)
    epsilon = float(np.sqrt(2 - 2 * threshold)) + 1e-6
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"),
                             F.col("label").cast("long").alias("label"),
                             F.col("embedding").cast("array<double>").alias("vec"))
    # rows without vec_id get ids below all others, one for each vector
    rows = rows.withColumn("id", F.coalesce("id", F.lit(NO_ID) + F.pmod(_keys()["k1"], F.lit(_NO_IDS))))
    valid = rows.where(_can_link()).withColumns(_keys())
    distinct = freeze(valid.groupBy("k1", "k2").agg(
        F.min("id").alias("id"), F.first("label").alias("label"), F.first("vec").alias("vec"),
        F.count("*").alias("n")), "vectors")
    axes = directions(distinct)
    cells = [f"c{k}" for k in range(GRID)]
    dealt = distinct.select("id", "label", "n", "vec").mapInArrow(
        _ordered(axes, epsilon), "id long, label long, n long, vec array<double>, "
        + ", ".join(f"{c} int" for c in cells))
    order = ["label", F.size("vec"), *cells, "id"]
    blocks = freeze(dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .select("id", "label", "n", "vec").mapInArrow(_blocks(axes), _BLOCK), "blocks")
    pairs = freeze(interval_join(blocks, epsilon), "pairs")
    deal = max(parts, -(-pairs.count() // PAIRS_A_TASK))
    side = lambda s: blocks.select(F.col("key").alias(s + "key"), *[
        F.col(c).alias(s + c) for c in ("ids", "copies", "vecs")], *(["dim"] if s == "a_" else []))
    met = pairs.repartition(deal, "a", "b") \
        .join(side("a_"), F.col("a") == F.col("a_key")) \
        .join(side("b_"), F.col("b") == F.col("b_key")) \
        .select("a", "b", "dim", *[s + c for s in ("a_", "b_") for c in ("ids", "copies", "vecs")])
    found = freeze(met.mapInArrow(_leaf(threshold), "a long, b long, n long"), "links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("_id")).agg(F.sum("n").alias("links"))
    parts_of = components(found.where("b IS NOT NULL").select("a", "b"))
    reps = distinct.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"),
                           F.col("id").alias("rep"), "n") \
        .join(counts, F.col("rep") == F.col("_id"), "left") \
        .join(parts_of.withColumnRenamed("id", "_pid"), F.col("rep") == F.col("_pid"), "left") \
        .select("_k1", "_k2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("comp"))
    keyed = rows.select("id", *[F.when(_can_link(), k).alias(n) for n, k in _keys().items()])
    out = keyed.join(reps, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left")
    real = lambda c: F.when(c >= F.lit(NO_ID + _NO_IDS), c)
    comp = F.coalesce("comp", "id")
    return out.select(real(F.col("id")).alias("vec_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      real(comp).alias("component_id"), (comp == F.col("id")).alias("kept"))
