"""Substring dedup with fixed-block anchors.

A window is ``WINDOW`` (20) consecutive words of a document; words covered by a
window whose word sequence also starts earlier (smaller doc_id, or the same
document and an earlier start) go.

1. Anchors.  Every document is cut into non-overlapping reference blocks of
   ``BLOCK`` (10) words.  Each window holds at least one whole block of its own
   document, so a window can only repeat if that block occurs at another place.
   The index holds the blocks, the probes are the rolling runs of 10 words of all
   documents.  Both travel as sorted hash sets, packed per map piece and bucket
   (about four bytes a word); back come the blocks that occur twice.
2. Extension.  The windows whose own blocks all occur twice are compared by
   96 bits of their whole sequence and their place; of equal windows the earliest
   is kept.  Overlapping repeats join to maximal exact repeats.

Hot passages and groups of copies: a piece sends one entry per distinct hash,
however often it holds it; repeats inside a piece are settled there.  All texts
cross the network once.

Defined cases: null, empty and short texts (under 20 words) lose nothing; of rows
that share a doc_id a window is earlier where its start is smaller, so the same
text twice under one id is no repeat of itself; a null doc_id is ordered before
all others; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import tokens
from vigil.llm.frames import documents, parallelism

WINDOW, BLOCK = 20, 10
PIECE_BYTES = 2 << 20
_U = np.uint64
_LOW32 = _U(0xFFFFFFFF)
NO_ID = -(1 << 63)          # stands for a null doc_id, before all others
# packed entries of one map piece for one bucket; settled: what a piece has found by
# itself, already in the form that the reduce side returns
_PACKED = "bucket int, settled boolean, data binary, places binary, ids binary"
_ARROW = pa.schema([("bucket", pa.int32()), ("settled", pa.bool_()), ("data", pa.binary()),
                    ("places", pa.binary()), ("ids", pa.binary())])
# bytes of the columns of findings: hits (id, block), repeats (id, fingerprint, start, length)
HITS, REPEATS = (8, 4), (8, 8, 4, 4)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal values in a sorted array."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    return at, np.diff(np.append(at, len(key)))


def _numbers(x) -> bytes:
    return tokens.planes(np.asarray(x), 4)


def _pack(cols, widths) -> bytes:
    return b"".join(tokens.planes(np.asarray(c).astype(np.int64).view(_U), w) for c, w in zip(cols, widths))


def _unpack(raws: list[bytes], widths) -> list[np.ndarray]:
    out: list[list] = [[np.empty(0, np.int64)] for _ in widths]
    for raw in raws:
        n, at = len(raw) // sum(widths), 0
        for k, w in enumerate(widths):
            out[k].append(tokens.from_planes(raw[at:at + n * w], w).view(np.int64))
            at += n * w
    return [np.concatenate(x) for x in out]


def _home(ids: np.ndarray, parts: int) -> np.ndarray:
    return (tokens.mix(ids.view(_U)) % _U(parts)).astype(np.int64)


def _send(cols, widths, parts: int) -> Iterator[pa.RecordBatch]:
    """Findings to the partition that gathers those of their id, one row for each."""
    home = _home(cols[0], parts)
    order = np.argsort(home, kind="stable")
    rows = [(int(home[order[a]]), _pack([c[order[a:a + n]] for c in cols], widths))
            for a, n in zip(*_groups(home[order]))]
    if rows:
        to, data = zip(*rows)
        yield pa.record_batch([pa.array(to, pa.int32()), pa.array(data, pa.binary())],
                              names=["home", "data"])


def gather(widths):
    """(id, found): all findings of each id, packed without the id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = _unpack([x for b in batches for x in b.column(1).to_pylist()], widths)
        order = np.argsort(cols[0], kind="stable")
        cols = [c[order] for c in cols]
        starts, sizes = _groups(cols[0])
        for k in range(0, len(starts), 5000):
            s = list(zip(starts[k:k + 5000].tolist(), sizes[k:k + 5000].tolist()))
            yield pa.record_batch(
                [pa.array(cols[0][starts[k:k + 5000]]),
                 pa.array([_pack([c[a:a + n] for c in cols[1:]], widths[1:]) for a, n in s], pa.binary())],
                names=["id", "found"])
    return run


# ----------------------------------------------------------------- anchors
def anchor_sets(parts: int):
    """Map side of the anchors: hash sets by bucket, and the blocks that ask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tokens.chunks(batches, limit=PIECE_BYTES):
            ids = b.column(0).to_numpy(zero_copy_only=False)
            w = tokens.Words(b.column(1))
            g, at = w.grams(BLOCK)
            if not len(g):
                continue
            row = w.row[at]
            place = at - w.first[row]
            key = (((g >> _U(32)) % _U(parts)) << _U(32)) | (g & _LOW32)
            order = np.argsort(key, kind="stable")
            key, row, place = key[order], row[order], place[order]
            start, size = _groups(key)
            is_block = place % BLOCK == 0
            many = np.repeat(size > 1, size)
            out = []
            mine = np.flatnonzero(is_block & many)
            if len(mine):
                out.append((int(_home(ids[:1], parts)[0]), True,
                            _pack((ids[row[mine]], place[mine] // BLOCK), HITS), b"", b""))
            # one entry for each distinct hash: bit 0 says that it occurs again here
            sets = (key[start] << _U(1)) | (size > 1).astype(_U)
            asks = np.flatnonzero(is_block & ~many)
            bucket, ask_bucket = (key[start] >> _U(32)).astype(np.int64), (key[asks] >> _U(32)).astype(np.int64)
            edges = np.searchsorted(bucket, np.arange(parts + 1))
            ask_edges = np.searchsorted(ask_bucket, np.arange(parts + 1))
            low = sets & _U(0x1FFFFFFFF)
            low[1:] = np.where(bucket[1:] == bucket[:-1], low[1:] - low[:-1], low[1:])
            index = np.searchsorted(key[start], key[asks]) - edges[ask_bucket]
            for k in np.flatnonzero(np.diff(edges)).tolist():
                q = asks[ask_edges[k]:ask_edges[k + 1]]
                out.append((k, False, tokens.planes(low[edges[k]:edges[k + 1]], 5),
                            _numbers(index[ask_edges[k]:ask_edges[k + 1]]) + _numbers(place[q] // BLOCK),
                            tokens.planes(ids[row[q]].view(_U), 8)))
            yield _batch(out)

    return run


def anchor_hits(parts: int):
    """Reduce side: the blocks whose hash occurs at a second place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        ids, blocks = _unpack([r["data"] for r in rows if r["settled"]], HITS)
        hashes, again, asked, ask_ids, ask_blocks = ([np.empty(0, t)] for t in (
            _U, _U, _U, np.int64, np.int64))
        for r in rows:
            if r["settled"]:
                continue
            x = np.cumsum(tokens.from_planes(r["data"], 5))
            h = (x >> _U(1)) | (_U(r["bucket"]) << _U(32))
            hashes.append(h)
            again.append(h[(x & _U(1)).astype(bool)])
            half = len(r["places"]) // 2
            asked.append(h[tokens.from_planes(r["places"][:half], 4).astype(np.int64)])
            ask_blocks.append(tokens.from_planes(r["places"][half:], 4).view(np.int64))
            ask_ids.append(tokens.from_planes(r["ids"], 8).view(np.int64))
        every = np.sort(np.concatenate([*hashes, *again]))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        asked, ask_ids, ask_blocks = map(np.concatenate, (asked, ask_ids, ask_blocks))
        at = np.searchsorted(twice, asked)
        hit = at < len(twice)
        hit[hit] = twice[at[hit]] == asked[hit]
        yield from _send((np.concatenate([ids, ask_ids[hit]]), np.concatenate([blocks, ask_blocks[hit]])),
                         HITS, parts)

    return run


# ----------------------------------------------------------------- windows
def window_sets(parts: int):
    """Map side of the windows: of each distinct sequence the earliest place of a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tokens.chunks(batches, limit=PIECE_BYTES):
            ids = b.column(0).to_numpy(zero_copy_only=False)
            w = tokens.Words(b.column(1))
            hit = np.zeros(len(w) + 2 * WINDOW, bool)
            for r, found in enumerate(b.column(2).to_pylist()):
                at = w.first[r] + BLOCK * tokens.from_planes(found, HITS[1]).astype(np.int64)
                hit[at[at < w.first[r + 1]]] = True
            g, at = w.grams(WINDOW)
            place = at - w.first[w.row[at]]
            own = at + (-place % BLOCK)
            take = hit[own] & ((place % BLOCK != 0) | hit[own + BLOCK])
            if not take.any():
                continue
            g, at, place = g[take], at[take], place[take]
            g2 = w.grams(WINDOW, 1)[0][take]
            row = w.row[at]
            rank = np.empty(len(ids), np.int64)
            order = np.argsort(ids, kind="stable")
            rank[order] = np.cumsum(np.concatenate([[0], np.diff(ids[order]) != 0]))
            loc = (rank[row] << 32) | place
            order = np.lexsort((loc, g2, g))
            gs, g2s, locs = g[order], g2[order], loc[order]
            new = np.ones(len(gs), bool)
            new[1:] = (gs[1:] != gs[:-1]) | (g2s[1:] != g2s[:-1])
            first = locs[np.flatnonzero(new)][np.cumsum(new) - 1]
            later = np.zeros(len(gs), bool)
            later[order] = locs > first
            fps = _fingerprints(w, b.num_rows)
            out = []
            mine = np.flatnonzero(later)
            if len(mine):
                out.append((int(_home(ids[:1], parts)[0]), True, _pack(
                    _runs(ids[row[mine]], fps[row[mine]], place[mine]), REPEATS), b"", b""))
            ask = np.flatnonzero(~later)
            bucket = ((g2[ask] >> _U(32)) % _U(parts)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ask, bucket = ask[order], bucket[order]
            for a, n in zip(*_groups(bucket)):
                q = ask[a:a + n]
                at_row, per_row = _groups(row[q])
                docs = row[q][at_row]
                out.append((int(bucket[a]), False,
                            tokens.planes(g[q], 8) + _numbers(g2[q] & _LOW32),
                            _numbers(place[q]) + _numbers(per_row),
                            tokens.planes(ids[docs].view(_U), 8) + tokens.planes(fps[docs].view(_U), 8)))
            yield _batch(out)

    return run


def _fingerprints(w: tokens.Words, n: int) -> np.ndarray:
    """A hash of each row's whole word sequence: tells rows that share an id apart."""
    up, _ = tokens._GRAM[0].get(len(w) + 1)
    place = np.arange(len(w)) - w.first[w.row]
    total = np.concatenate([np.zeros(1, _U), np.cumsum(w.hash * up[place])])
    return tokens.mix(total[w.first[1:]] - total[w.first[:-1]] + np.diff(w.first).astype(_U)).view(np.int64)


def _runs(ids, fps, place) -> tuple:
    """Places sorted within each text, as runs (id, fingerprint, start, length)."""
    new = np.ones(len(place), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (fps[1:] != fps[:-1]) | (np.diff(place) != 1)
    at = np.flatnonzero(new)
    return ids[at], fps[at], place[at], np.diff(np.append(at, len(place)))


def window_repeats(parts: int):
    """Reduce side: all but the earliest of equal windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        settled = _unpack([r["data"] for r in rows if r["settled"]], REPEATS)
        g, g2, ids, fps, place = ([np.empty(0, t)] for t in (_U, _U, np.int64, np.int64, np.int64))
        for r in rows:
            if r["settled"]:
                continue
            n = len(r["data"]) // 12
            g.append(tokens.from_planes(r["data"][:8 * n], 8))
            g2.append(tokens.from_planes(r["data"][8 * n:], 4))
            place.append(tokens.from_planes(r["places"][:4 * n], 4).view(np.int64))
            per_row = tokens.from_planes(r["places"][4 * n:], 4).astype(np.int64)
            half = len(r["ids"]) // 2
            ids.append(np.repeat(tokens.from_planes(r["ids"][:half], 8).view(np.int64), per_row))
            fps.append(np.repeat(tokens.from_planes(r["ids"][half:], 8).view(np.int64), per_row))
        g, g2, ids, fps, place = map(np.concatenate, (g, g2, ids, fps, place))
        order = np.lexsort((place, ids, g2, g))
        new = np.ones(len(g), bool)
        new[1:] = (g[order][1:] != g[order][:-1]) | (g2[order][1:] != g2[order][:-1])
        head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        later = order[(ids[order] != ids[head]) | (place[order] != place[head])]
        later = later[np.lexsort((place[later], fps[later], ids[later]))]
        found = _runs(ids[later], fps[later], place[later])
        yield from _send([np.concatenate(x) for x in zip(settled, found)], REPEATS, parts)

    return run


# ------------------------------------------------------------------ result
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in tokens.chunks(batches, limit=PIECE_BYTES):
        ids = pa.array([None if i == NO_ID else i for i in b.column(0).to_pylist()], pa.int64())
        found = b.column(2).to_pylist()
        texts = b.column(1).cast(pa.binary()).to_pylist()
        fps = _fingerprints(tokens.Words(b.column(1)), b.num_rows) if any(found) else None
        rest = REPEATS[1:]
        n_words, n_removed, kept = [], [], []
        for r, (text, raw) in enumerate(zip(texts, found)):
            words = (text or b"").split()
            n = len(words)
            if raw:
                fp, start, size = _unpack([raw], rest)
                start, size = start[fp == fps[r]], size[fp == fps[r]]
                change = np.bincount(start, minlength=n + 1)
                change -= np.bincount(np.minimum(start + size - 1 + WINDOW, n), minlength=n + 1)
                words = list(compress(words, (np.cumsum(change[:n]) == 0).tolist()))
            n_words.append(n)
            n_removed.append(n - len(words))
            kept.append(b" ".join(words))
        yield pa.record_batch([ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                               pa.array(kept, pa.binary()).cast(pa.string())],
                              names=["doc_id", "n_words", "n_removed", "kept"])


def cut_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: ``kept`` joins the words that stay."""
    parts = parallelism(docs)
    src = documents(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text")
    hits = src.mapInArrow(anchor_sets(parts), _PACKED).repartitionById(parts, F.col("bucket")) \
        .mapInArrow(anchor_hits(parts), "home int, data binary") \
        .repartitionById(parts, F.col("home")).mapInArrow(gather(HITS), "id long, found binary")
    # one exchange of the texts serves both joins
    texts = src.repartition(parts, "id")
    repeats = texts.join(hits, "id").select("id", "text", "found") \
        .mapInArrow(window_sets(parts), _PACKED).repartitionById(parts, F.col("bucket")) \
        .mapInArrow(window_repeats(parts), "home int, data binary") \
        .repartitionById(parts, F.col("home")).mapInArrow(gather(REPEATS), "id long, found binary")
    return texts.join(repeats, "id", "left").select("id", "text", "found") \
        .mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")


def substring_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    return cut_repeats(docs).select("doc_id", "n_words", "n_removed",
                                    F.sha2("kept", 256).alias("kept_sha256"))
