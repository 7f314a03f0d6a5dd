"""Near-duplicate documents by BagMinHash.

Documents are multisets of ``SHINGLE`` (5) word shingles.  BagMinHash draws, for
every shingle, a Poisson process over its discretised weight axis, cut into
dyadic blocks [0,1) [1,2) [2,4) ...: a block's first arrival is drawn at once, and
only a block that has an arrival before the document's bound is split, its first
arrival passed to one half.  The arrivals of the unit cells below the shingle's
weight fall on the slots of the signature; the earliest of each slot stays, and
two signatures agree in a slot with the probability of the weighted Jaccard
similarity.

1. Signatures, frozen as a table; exact copies fold to the smallest doc_id.
2. Bands of ``ROWS`` slots bucket the rest; within buckets signatures are compared
   and those that agree in ``AGREE`` slots link to candidate groups.
3. Inside a candidate group the multiset overlap of the whole texts decides:
   similarity >= ``SIMILARITY``.  The classes are the components of these links.

Large buckets and groups are dealt to bounded cells in which any two members
meet; a search that leaves settled members aside finds spanning links only, so no
task lists the pairs of a group.

A pair at similarity 0.8 misses all bands with a probability of 3e-5, or the
agreement with 1e-6; pairs above are found more surely, pairs below never.

Defined cases: null and blank texts are alike to nothing; texts of fewer than
five words are one shingle; rows that share a doc_id are one document, linked by
any of its texts; a null doc_id orders before all others and rows without one are
told apart by their texts; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import tokens
from vigil.llm.frames import documents, freeze, parallelism, same
from vigil.llm.graph import components
from vigil.llm.groups import cells, spanning, stream

SHINGLE, SIMILARITY = 5, 0.8
ROWS, BANDS = 4, 20
SLOTS = ROWS * BANDS
AGREE = 45
CELL_ROWS, CELL_BYTES = 512, 4 << 20
NO_ID, _NO_IDS = -(1 << 63), 1 << 61
_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_SALT = [int(x) for x in tokens.mix(np.arange(101, 106, dtype=_U))]


def shingles(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, weight) of the distinct shingles of each text, sorted by row and hash."""
    w = tokens.Words(col)
    g, at = w.grams(SHINGLE)
    row = w.row[at]
    n = np.diff(w.first)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        whole = np.array([tokens.mix(np.bitwise_xor.reduce(tokens.mix(
            w.hash[w.first[r]:w.first[r + 1]] + np.arange(n[r], dtype=_U) * _GOLD), keepdims=True))[0]
            for r in short], _U)
        g, row = np.concatenate([g, whole]), np.concatenate([row, short])
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return row[first], g[first], np.diff(np.append(first, len(g)))


def _wait(seed: np.ndarray) -> np.ndarray:
    """Exponential waiting times from seeds."""
    u = (tokens.mix(seed ^ _U(_SALT[0])) >> _U(11)).astype(float) * 2.0 ** -53
    return -np.log1p(-u)


def _arrivals(row, g, weight, bound):
    """(row, slot, time, value) of the arrivals of the shingles up to bound[row]."""
    seed, lo, width, owner = [], [], [], []
    at, size = np.arange(len(g)), 1
    start = 0
    while len(at):          # dyadic blocks of the weight axis that the weights reach
        seed.append(tokens.mix(g[at] + np.array([size + start], _U) * _GOLD))
        lo.append(np.full(len(at), start))
        width.append(np.full(len(at), size))
        owner.append(at)
        start, size = start + size, max(1, start + size)
        at = at[weight[at] > start]
    seed, lo, width, owner = map(np.concatenate, (seed, lo, width, owner))
    time = _wait(seed) / width
    out = []
    while len(seed):
        keep = time <= bound[row[owner]]
        seed, lo, width, owner, time = seed[keep], lo[keep], width[keep], owner[keep], time[keep]
        unit = width == 1
        s, t, o = seed[unit], time[unit], owner[unit]
        v = tokens.mix(s ^ _U(_SALT[1]))
        out.append((row[o], (v % _U(SLOTS)).astype(np.int64), t, (v >> _U(32)).astype(np.uint32)))
        nxt = s + _GOLD
        parts = [(nxt, lo[unit], width[unit], o, t + _wait(nxt))]
        if not unit.all():
            s, a, h, o, t = seed[~unit], lo[~unit], width[~unit] // 2, owner[~unit], time[~unit]
            right = (tokens.mix(s ^ _U(_SALT[2])) & _U(1)).astype(bool)
            for salt, side, begin in ((_SALT[3], ~right, a), (_SALT[4], right, a + h)):
                c = tokens.mix(s ^ _U(salt))
                inside = begin < weight[o]
                x = np.where(side, t, t + _wait(c) / h)
                parts.append(tuple(y[inside] for y in (c, begin, h, o, x)))
        seed, lo, width, owner, time = map(np.concatenate, zip(*parts))
    return tuple(map(np.concatenate, zip(*out)))


def signatures(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(total weight, signature of SLOTS 32-bit values) of each text."""
    row, g, weight = shingles(col)
    n = len(col)
    total = np.bincount(row, weight, n).astype(np.int64)
    sig = np.zeros((n, SLOTS), np.uint32)
    todo = total > 0
    bound = SLOTS / np.maximum(total, 1) * (np.log(SLOTS) + 3.5)
    while todo.any():
        use = todo[row]
        r, slot, t, v = _arrivals(row[use], g[use], weight[use], bound)
        key = r * SLOTS + slot
        order = np.lexsort((t, key))
        key, v = key[order], v[order]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        full = np.bincount(key[first] // SLOTS, minlength=n) == SLOTS
        done = full[key // SLOTS] & first
        sig.reshape(-1)[key[done]] = v[done]
        todo &= ~full
        bound = bound * 2         # rare: a slot without an arrival yet
    return total, sig


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in tokens.chunks(batches, limit=tokens.CHUNK_BYTES // 2):
        total, sig = signatures(b.column(3))
        use = np.flatnonzero(total > 0)
        sig = sig[use].astype(_U)
        bands = np.empty((len(use), BANDS), _U)
        for k in range(BANDS):
            h = np.full(len(use), _U(k + 1))
            for c in range(ROWS):
                h = tokens.mix(h * _GOLD + sig[:, k * ROWS + c])
            bands[:, k] = h
        flat = pa.array(bands.ravel().view(np.int64))
        ends = np.arange(len(use) + 1, dtype=np.int32) * BANDS
        raw = (sig & _U(0xFFFF)).astype("<u2")
        yield pa.record_batch([b.column(k).take(pa.array(use)) for k in range(3)]
                              + [pa.array([x.tobytes() for x in raw], pa.binary()),
                                 pa.ListArray.from_arrays(pa.array(ends), flat)],
                              names=["id", "k1", "k2", "sig", "bands"])


def _keyed(docs: DataFrame) -> DataFrame:
    """(id, k1, k2, text): an id for every row and a 128-bit name of its text.

    Rows without doc_id get ids below all others, one for each text.
    """
    named = documents(docs).select("doc_id", F.xxhash64("text").alias("k1"),
                                   F.xxhash64(F.lit(7), "text").alias("k2"), "text")
    return named.select(F.coalesce("doc_id", F.lit(NO_ID) + F.pmod("k1", F.lit(_NO_IDS))).alias("id"),
                        "k1", "k2", "text")


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of the signatures of each cell."""
    a, b = [], []
    for t in stream(batches, ("bucket", "i", "j")):
        ids = t["id"].to_numpy()
        if len(ids) < 2:
            continue
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), "<u2").reshape(len(ids), SLOTS)
        near = lambda i, js: (sig[js] == sig[i]).sum(axis=1) >= AGREE
        for x, y in spanning(len(ids), near):
            a.append(ids[x])
            b.append(ids[y])
        if len(a) > 50_000:
            yield _edges(a, b)
            a, b = [], []
    if a:
        yield _edges(a, b)


def _edges(a, b) -> pa.RecordBatch:
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links by the multiset overlap of the texts of each cell."""
    for t in stream(batches, ("component", "i", "j")):
        ids = t["id"].to_numpy()
        if len(ids) < 2:
            continue
        row, g, weight = shingles(t["text"])
        total = np.bincount(row, weight, len(ids))
        edge = np.searchsorted(row, np.arange(len(ids) + 1))

        def near(i, js):
            ok = np.minimum(total[js], total[i]) >= SIMILARITY * np.maximum(total[js], total[i])
            js2 = js[ok]
            mine = np.zeros(len(ids), bool)
            mine[js2] = True
            use = mine[row]
            own, w = g[edge[i]:edge[i + 1]], weight[edge[i]:edge[i + 1]]
            at = np.minimum(np.searchsorted(own, g[use]), len(own) - 1)
            both = np.where(own[at] == g[use], np.minimum(w[at], weight[use]), 0)
            shared = np.bincount(row[use], both, len(ids))[js2]
            ok[ok] = shared >= SIMILARITY * (total[js2] + total[i] - shared)
            return ok

        pairs = spanning(len(ids), near)
        if pairs:
            x, y = zip(*pairs)
            yield _edges(ids[list(x)], ids[list(y)])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, kept, k1, k2) of every row: the class is named by its smallest doc_id."""
    parts = parallelism(docs)
    src = _keyed(docs)
    signed = freeze(src.mapInArrow(
        _sign, "id long, k1 long, k2 long, sig binary, bands array<long>"), "signatures")
    reps = freeze(signed.groupBy("k1", "k2").agg(
        F.min(F.struct("id", "sig", "bands")).alias("r"))
        .select("k1", "k2", "r.id", "r.sig", "r.bands"), "originals")
    banded = reps.select("id", "sig", F.explode("bands").alias("bucket"))
    full = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1") \
        .select("bucket", F.ceil(F.col("n") / CELL_ROWS).alias("n_blocks"))
    alike = cells(banded, "bucket", full, parts).mapInArrow(_alike, "a long, b long")
    groups = freeze(components(alike), "candidates")
    members = src.join(reps.select(F.col("id").alias("_id"), F.col("k1").alias("_k1"),
                                   F.col("k2").alias("_k2"))
                       .join(groups.withColumnRenamed("id", "_gid"), F.col("_id") == F.col("_gid")),
                       (F.col("id") == F.col("_id")) & (F.col("k1") == F.col("_k1"))
                       & (F.col("k2") == F.col("_k2"))) \
        .dropDuplicates(["id", "k1", "k2"]).select("id", "component", "text")
    size = members.groupBy("component").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")) \
        .select("component", F.greatest(F.ceil(F.col("n") / CELL_ROWS),
                                        F.ceil(F.col("bytes") / CELL_BYTES)).alias("n_blocks"))
    links = cells(members, "component", size, parts).mapInArrow(_verified, "a long, b long")
    classes = components(links)
    named = reps.select("k1", "k2", F.col("id").alias("rep")) \
        .join(classes, F.col("rep") == classes["id"], "left") \
        .select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"),
                F.coalesce("component", "rep").alias("class"))
    ids = src.select("id", "k1", "k2")
    out = ids.join(named, (ids["k1"] == F.col("_k1")) & (ids["k2"] == F.col("_k2")), "left") \
        .withColumn("class", F.coalesce("class", "id"))
    real = lambda c: F.when(F.col(c) >= F.lit(NO_ID + _NO_IDS), F.col(c))
    return out.select(real("id").alias("doc_id"), real("class").alias("class_id"),
                      (F.col("id") == F.col("class")).alias("kept"), "k1", "k2")


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their class, all columns kept."""
    gone = near_duplicates(docs).where("NOT kept").select(
        F.col("doc_id").alias("_id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
    text = docs["text"].cast("string")
    return docs.join(gone, same(docs["doc_id"].cast("long"), gone["_id"])
                     & (F.xxhash64(text) == gone["_k1"])
                     & (F.xxhash64(F.lit(7), text) == gone["_k2"]), "left_anti")
