"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items become sequences of normalised tokens (case of
A-Z and punctuation do not count; in scripts written without spaces each
character is a token).  Seeds of ``min_match`` tokens that a
document shares with an item select the (document, item) pairs; a pair goes on
only if its seeds could still cover the threshold, which no tiling can exceed.
Greedy string tiling then marks the longest common runs first, never overlapping,
with running Karp-Rabin hashes of falling search lengths, so that reordered
passages are covered as well.  A document is contaminated by an item when the
tiles cover at least ``threshold`` of the item's tokens.

The benchmark goes to the executors in blocks of bounded size, each against all
documents; no text is shuffled and no pair leaves its task.

Defined cases: a null or empty text is clean; an item of under ``min_match``
tokens matches where it stands whole, as one run; an item without tokens never
matches; several items of equal
coverage: the smallest item_id is named; rows that share a doc_id share the
verdict (the highest coverage); a null doc_id is an id like any other; with an
empty benchmark all documents are clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import tokens
from vigil.llm.frames import documents, same

MIN_MATCH = 5
THRESHOLD = 0.6
BLOCK_BYTES = 16 << 20     # benchmark text in one broadcast block
_HITS = "doc_id long, item_id long, coverage double, n_tiles int, matched int"
_BITS = 20


class Items:
    """A block of benchmark items: token sequences and the index of their seeds."""

    def __init__(self, rows: list, min_match: int):
        text = pa.array([r["text"] for r in rows], pa.string())
        w = tokens.Words(text, normal=True)
        self.ids = [r["item_id"] for r in rows]
        self.tokens = [w.hash[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
        seeds, at = w.grams(min_match)
        order = np.argsort(seeds, kind="stable")
        self.seed, self.item, self.at = seeds[order], w.row[at][order], (at - w.first[w.row[at]])[order]
        # bit table that passes every seed and few other hashes
        self.sieve = np.zeros(1 << _BITS, bool)
        self.sieve[self.seed >> np.uint64(64 - _BITS)] = True
        # items of fewer tokens, by their length: hash of the whole item, item
        sizes = np.diff(w.first)
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, min_match):
            whole, at = w.grams(n)
            mine = sizes[w.row[at]] == n
            if mine.any():
                order = np.argsort(whole[mine], kind="stable")
                self.short[n] = whole[mine][order], w.row[at][mine][order]


def greedy_tiles(item: np.ndarray, doc: np.ndarray, starts: np.ndarray,
                 min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (item position, document position, length), longest first, none overlapping.

    ``starts``: document positions at which a common run of min_match tokens
    can begin.  The search length falls from the longest run to min_match; at
    each length the windows of the item are looked up among those of the
    document by hash, and hits are extended token by token.
    """
    free_i, free_d = np.ones(len(item), bool), np.ones(len(doc), bool)
    tiles: list[tuple[int, int, int]] = []
    length = max(min_match, len(item) // 2)
    while True:
        longest, found = _scan(item, doc, starts, free_i, free_d, length)
        if longest > 2 * length:
            length = longest     # much longer runs exist: look for those first
            continue
        marked = False
        for n, i, d in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if not (free_i[i:i + n].all() and free_d[d:d + n].all()):
                break            # partly taken by now: look again at what is left
            free_i[i:i + n] = free_d[d:d + n] = False
            tiles.append((i, d, n))
            marked = True
        if not marked:
            if length <= min_match:
                return tiles
            length = max(min_match, length // 2)


def _scan(item, doc, starts, free_i, free_d, length):
    """The longest run, and all maximal runs of at least ``length`` free tokens."""
    zeros = np.zeros(len(item), np.int8)
    hi, ai = tokens.gram_hashes(item, zeros, length)
    near = starts[starts <= len(doc) - length]
    if not len(hi) or not len(near):
        return 0, []
    hd, _ = tokens.gram_hashes(doc, np.zeros(len(doc), np.int8), length)
    index: dict[int, list[int]] = {}
    taken_d = np.concatenate([[0], np.cumsum(~free_d)])
    taken_i = np.concatenate([[0], np.cumsum(~free_i)])
    near = near[taken_d[near + length] == taken_d[near]]
    known = np.isin(hd[near], hi)
    for d, h in zip(near[known].tolist(), hd[near][known].tolist()):
        index.setdefault(h, []).append(d)
    longest, found = 0, []
    for i, h in zip(ai.tolist(), hi.tolist()):
        if taken_i[i + length] != taken_i[i]:
            continue
        for d in index.get(h, ()):
            if i and d and item[i - 1] == doc[d - 1] and free_i[i - 1] and free_d[d - 1]:
                continue         # not the run's beginning
            m = min(len(item) - i, len(doc) - d)
            stop = (item[i:i + m] != doc[d:d + m]) | ~free_i[i:i + m] | ~free_d[d:d + m]
            n = int(np.argmax(stop)) if stop.any() else m
            if n >= length:
                found.append((n, i, d))
                longest = max(longest, n)
    return longest, found


def _short_hits(items: Items, w: tokens.Words) -> Iterator[tuple[int, int, int]]:
    """(row, item, tokens) of the items under min_match tokens that stand whole in a row."""
    for n, (whole, item) in items.short.items():
        h, at = w.grams(n)
        hit = np.flatnonzero(np.isin(h, whole))
        row, seen = np.unique(np.stack([w.row[at[hit]].astype(np.uint64), h[hit]]), axis=1)
        lo, hi = np.searchsorted(whole, seen, "left"), np.searchsorted(whole, seen, "right")
        for r, a, b in zip(row.tolist(), lo.tolist(), hi.tolist()):
            for k in item[a:b].tolist():
                yield r, k, n


def _matcher(block, min_match: int, threshold: float):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()),
                        ("n_tiles", pa.int32()), ("matched", pa.int32())])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(block.value, min_match)
        for b in tokens.chunks(batches):
            w = tokens.Words(b.column(1), normal=True)
            seeds, at = w.grams(min_match)
            at_hit = np.flatnonzero(items.sieve[seeds >> np.uint64(64 - _BITS)])
            at_hit = at_hit[np.isin(seeds[at_hit], items.seed)]
            out = []
            pairs: dict[tuple[int, int], tuple[set, list]] = {}
            lo = np.searchsorted(items.seed, seeds[at_hit], "left")
            hi = np.searchsorted(items.seed, seeds[at_hit], "right")
            for a, x, y in zip(at[at_hit].tolist(), lo.tolist(), hi.tolist()):
                row = int(w.row[a])
                for k in range(x, y):
                    covered, starts = pairs.setdefault((row, int(items.item[k])), (set(), []))
                    p = int(items.at[k])
                    covered.update(range(p, p + min_match))
                    starts.append(a - int(w.first[row]))
            ids = b.column(0).to_pylist()
            for (row, k), (covered, starts) in pairs.items():
                item = items.tokens[k]
                if len(covered) < threshold * len(item):
                    continue
                doc = w.hash[w.first[row]:w.first[row + 1]]
                tiles = greedy_tiles(item, doc, np.unique(np.array(starts)), min_match)
                matched = sum(t[2] for t in tiles)
                if matched >= threshold * len(item):
                    out.append((ids[row], items.ids[k], matched / len(item), len(tiles), matched))
            out.extend((ids[row], items.ids[k], 1.0, 1, n) for row, k, n in _short_hits(items, w))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), schema.types)],
                                      schema=schema)
    return match


def matches(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
            threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, matched) of all contaminated pairs."""
    spark = docs.sparkSession
    src = documents(docs)
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")) \
        .where("text is not null")
    size = items.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    n_blocks = -(-size // block_bytes)
    out = spark.createDataFrame([], _HITS)
    for k in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).collect()
        block = spark.sparkContext.broadcast(rows)
        hits = src.mapInArrow(_matcher(block, min_match, threshold), _HITS)
        out = hits if not k else out.unionByName(hits)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, contaminated, item_id, coverage, n_tiles): one row per row of ``docs``."""
    best = matches(docs, benchmark, **options).groupBy(F.col("doc_id").alias("_id")).agg(
        F.min(F.struct((-F.col("coverage")).alias("c"), "item_id", "n_tiles")).alias("_b"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    return d.join(best, same(d["doc_id"], best["_id"]), "left").select(
        "doc_id", F.col("_b").isNotNull().alias("contaminated"),
        F.col("_b.item_id").alias("item_id"),
        F.coalesce(-F.col("_b.c"), F.lit(0.0)).alias("coverage"),
        F.coalesce(F.col("_b.n_tiles"), F.lit(0)).alias("n_tiles"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, all columns kept."""
    bad = matches(docs, benchmark, **options).select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(bad, same(docs["doc_id"].cast("long"), bad["_id"]), "left_anti")
