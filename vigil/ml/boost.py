"""Multi-class boosted trees with one joint softmax objective.

Every round grows one tree a class on the gradients of the softmax loss:
g = p - [y = class] and h = 2 p (1 - p).  A feature's values become bins once, cut at
its approximate quantiles, and are kept as bytes in blocks of rows.  A level of all
trees of a round takes ONE aggregate: (class, node, feature, bin) -> (sum g, sum h);
running sums over the bins of a node then give the gain of each cut,

    GL^2 / (HL + lambda) + GR^2 / (HR + lambda) - G^2 / (H + lambda),

and the best cut of each node goes back to the driver, so what a level returns is
bounded by the nodes it opens.  A leaf holds -step * G / (H + lambda).  Rows are
sampled by a hash of (row, round), columns by one of (round, class, feature).

The training set is bounded by the caps per class.  If it fits one block, no sums have
to cross tasks and all rounds run where that block is.  Up to ``WHOLE_BYTES`` of bins and
scores a round is ONE job with a task a class, and only its tree leaves it, where the sums
of a deep level would be as large as the rows.  A Python worker reads the blocks once and
holds them; a task on a worker without them says so, and runs again with the blocks as
its input.  Above that, blocks meet level by level in the aggregate.  All ways grow the
same trees.  Of two children of a node with many rows only the smaller one is summed:
the other has what is left of the parent's sums.  Blocks are written to the shared
folder, with the scores so far every ``KEEP_ROUNDS`` or ``CLASS_KEEP_ROUNDS`` rounds, so a
lost executor costs one block's work and no fit.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.align import frozen

BLOCK_ROWS, BINS, KEEP_ROUNDS = 8192, 256, 10
CLASS_KEEP_ROUNDS = 30           # workers hold the scores: only a new one learns the rounds since
SENT_ROUNDS = 5                 # of trees sent to a worker that holds the scores; one further behind reads them
WHOLE_BYTES = 256 << 20         # bins and scores that a task may hold at once
LEAST_GAIN, CELLS = 1e-6, 1 << 15
MANY_ROWS = 1 << 14             # sampled rows from which a tree's larger children are not summed
PIECE_ROWS = 1 << 15            # rows summed at once: a core's cache holds them
BYTE_ROWS = 1 << 17             # the same where a row is a byte
SELECT_ROWS = 1 << 12           # rows from which a tree is walked node by node, not row by row
RESIDUE = 1e-11                 # what a difference of sums leaves where no row is
SCORE_ROWS = 10_000
NODES = ("round int, cls int, node int, feature int, threshold double, left int, right int, "
         "g double, h double, value double")


@dataclass(frozen=True)
class BoostConfig:
    rounds: int = 300
    depth: int = 8
    step: float = 0.1
    rows: float = 0.8           # share of rows that a round looks at
    columns: float = 0.8        # share of features that a tree looks at
    reg: float = 1.0            # lambda
    least_h: float = 1.0        # sum of h that each side of a cut has at least
    seed: int = 42


# ---------------------------------------------------------------------- sampling
_MULT, _ADD, _MOD = 1103515245, 12345, 1 << 31


def _scramble(x, salts, xor, mod):
    for s in salts:
        x = mod(xor(x, s) * _MULT + _ADD)
    return x


def sampled(rid: Column, rnd: int, cfg: BoostConfig) -> Column:
    """Whether a round looks at a row, from its number ``rid`` in [0, 2^31)."""
    h = _scramble(rid, _salts(rnd, cfg), lambda x, s: x.bitwiseXOR(F.lit(s)), lambda x: F.pmod(x, F.lit(_MOD)))
    return h < int(cfg.rows * _MOD)


def _sampled(rid: np.ndarray, rnd: int, cfg: BoostConfig) -> np.ndarray:
    return _scramble(rid, _salts(rnd, cfg), lambda x, s: x ^ s, lambda x: x % _MOD) < int(cfg.rows * _MOD)


def _salts(rnd: int, cfg: BoostConfig) -> list[int]:
    d = hashlib.blake2b(f"{cfg.seed}:{rnd}".encode(), digest_size=12).digest()
    return [int.from_bytes(d[i:i + 4], "little") % _MOD for i in (0, 4, 8)]


def columns_of(rnd: int, cls: int, d: int, cfg: BoostConfig) -> np.ndarray:
    """The features a tree looks at, ascending."""
    def key(f):
        return hashlib.blake2b(f"{cfg.seed}:{rnd}:{cls}:{f}".encode(), digest_size=8).digest()
    return np.array(sorted(sorted(range(d), key=key)[:max(1, round(cfg.columns * d))]))


# ------------------------------------------------------------------------- trees
class Tree:
    """One class's tree of a round; a node without feature is a leaf."""

    def __init__(self):
        self.feature, self.cut, self.left, self.right = [-1], [0], [-1], [-1]
        self.g, self.h = [0.0], [0.0]

    def split(self, node: int, feature: int, cut: int, gl: float, hl: float) -> tuple[int, int]:
        low, high = len(self.g), len(self.g) + 1
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, low, high
        for xs, new in ((self.feature, [-1, -1]), (self.cut, [0, 0]), (self.left, [-1, -1]), (self.right, [-1, -1]),
                        (self.g, [gl, self.g[node] - gl]), (self.h, [hl, self.h[node] - hl])):
            xs.extend(new)
        return low, high

    def values(self, cfg: BoostConfig) -> np.ndarray:
        return -cfg.step * np.array(self.g) / (np.array(self.h) + cfg.reg)

    def steps(self) -> tuple:
        """What ``below`` needs of each node; a leaf leads to itself, as no bin is over its cut."""
        feature = np.array(self.feature)
        inner = feature >= 0
        return (np.maximum(feature, 0).astype(np.int64), np.where(inner, self.cut, BINS - 1).astype(np.uint8),
                np.where(inner, self.left, np.arange(len(inner))).astype(np.int64))

    @staticmethod
    def below(steps: tuple, bin_of, at: np.ndarray) -> np.ndarray:
        """One step down; ``bin_of`` gives each row's bin of a feature."""
        feature, cut, low = steps
        return low[at] + (bin_of(feature[at]) > cut[at])    # the right child is numbered after the left one

    def leaves(self, bins: np.ndarray, depth: int) -> np.ndarray:
        return leaves(self.steps(), bins, depth if len(self.g) > 1 else 0)

    def __getstate__(self) -> dict:
        kinds = {"feature": np.int32, "cut": np.int16, "left": np.int32, "right": np.int32, "g": float, "h": float}
        return {n: np.array(v, kinds[n]) for n, v in vars(self).items()}


def leaves(steps: tuple, bins: np.ndarray, depth: int) -> np.ndarray:
    """The node at which each row ends."""
    if not depth:
        return np.zeros(len(bins), np.int64)
    if len(bins) >= SELECT_ROWS and bins.flags.f_contiguous:
        return _selected(steps, bins)
    feature, cut, low = steps
    flat, first = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    at = low[0] + (flat[first + feature[0]] > cut[0])
    for _ in range(depth - 1):
        at = low[at] + (flat[first + feature[at]] > cut[at])
    return at


def _selected(steps: tuple, bins: np.ndarray) -> np.ndarray:
    """``leaves`` from the last node up to the first: each has the end below it that its bin selects, and the ends,
    256 at depth 8, fit a byte, so a step over all rows takes a few byte operations."""
    feature, cut, low = steps
    inner = low != np.arange(len(low))
    ends = np.flatnonzero(~inner)
    kind = np.min_scalar_type(len(ends) - 1)
    number = dict(zip(ends.tolist(), np.arange(len(ends), dtype=kind)))
    nodes = np.flatnonzero(inner)[::-1]
    todo = list(zip(nodes.tolist(), feature[nodes].tolist(), cut[nodes], low[nodes].tolist()))
    out = np.empty(len(bins), np.int64)
    for i in range(0, len(bins), BYTE_ROWS):
        columns, below = list(bins[i:i + BYTE_ROWS].T), number.copy()
        for node, f, c, left in todo:
            a, b = below.pop(left), below.pop(left + 1)
            over = columns[f] > c
            over = over.view(kind) if kind.itemsize == 1 else over.astype(kind)
            np.negative(over, over)     # all bits
            np.bitwise_and(over, a ^ b, over)
            below[node] = np.bitwise_xor(over, a, over)
        out[i:i + BYTE_ROWS] = ends[below[0]]
    return out


def grow(find, classes, cfg: BoostConfig) -> dict[int, Tree]:
    """Some classes' trees of a round; ``find(trees, open)`` gives (class, node) -> (G, H, feature, cut, GL, HL)."""
    trees = {k: Tree() for k in classes}
    open_ = [(k, 0) for k in trees]
    for _ in range(cfg.depth):
        found, deeper = find(trees, open_), []
        for k, node in open_:
            g, h, feature, cut, gl, hl = found.get((k, node), (0.0, 0.0, -1, 0, 0.0, 0.0))
            t = trees[k]
            if node == 0:
                t.g[0], t.h[0] = g, h
            if feature >= 0:
                deeper += [(k, c) for c in t.split(node, feature, cut, gl, hl) if t.h[c] >= 2 * cfg.least_h]
        open_ = deeper
        if not open_:
            break
    return trees


# ------------------------------------------------------------------------ blocks
class Block:
    """Rows of the training set: bins, classes, and their scores so far."""

    def __init__(self, *rs, n_classes: int):
        n = sum(r["n"] for r in rs)
        joined = lambda c, kind: np.frombuffer(b"".join(r[c] for r in rs), kind)
        # a feature after the other
        self.bins = np.ascontiguousarray(joined("bins", np.uint8).reshape(n, -1).T).T
        self.y, self.rid = joined("y", "<i4"), joined("rid", "<i8")
        self.scores = np.zeros((n, n_classes)) if rs[0]["scores"] is None \
            else joined("scores", "<f8").reshape(n, n_classes).copy()

    def learn(self, trees: list[Tree], cfg: BoostConfig) -> None:
        for k, t in enumerate(trees):
            self.scores[:, k] += t.values(cfg)[t.leaves(self.bins, cfg.depth)]

    def chances(self) -> np.ndarray:
        out = np.empty_like(self.scores)
        for i in range(0, len(out), PIECE_ROWS):
            scores = self.scores[i:i + PIECE_ROWS]
            e = np.exp(scores - scores.max(axis=1, keepdims=True))
            np.divide(e, e.sum(axis=1, keepdims=True), out=out[i:i + PIECE_ROWS])
        return out

    def loss(self, p: np.ndarray | None = None) -> float:
        """Sum of the rows' log losses, from their chances if known."""
        p = self.chances() if p is None else p
        return float(-np.log(np.maximum(p[np.arange(len(self.y)), self.y], 1e-300)).sum())

    def gradients(self) -> tuple[np.ndarray, np.ndarray]:
        p = self.chances()
        h = np.maximum(2 * p * (1 - p), 1e-16)
        p[np.arange(len(self.y)), self.y] -= 1
        return p, h

    def sums(self, rows: np.ndarray, at: np.ndarray, nodes: list[int], cols: np.ndarray, g: np.ndarray,
             h: np.ndarray, n_bins: int) -> tuple[np.ndarray, np.ndarray]:
        """(node, feature, bin) sums of g and h of one class over the sampled rows."""
        place = np.full(max(int(at.max(initial=0)), max(nodes)) + 1, -1)
        place[nodes] = np.arange(len(nodes))
        where = place[at[rows]]
        rows, where = rows[where >= 0], where[where >= 0]
        flat = ((where[:, None] * len(cols) + np.arange(len(cols))) * n_bins + self.bins[rows][:, cols]).ravel()
        shape = (len(nodes), len(cols), n_bins)
        return tuple(np.bincount(flat, np.repeat(w[rows], len(cols)), math.prod(shape)).reshape(shape)
                     for w in (g, h))


def best_cuts(sums, cfg: BoostConfig) -> list[tuple]:
    """For each node (G, H, feature, cut, GL, HL) from some features' sums after the other's:
    ``sums`` gives (features, (feature, node, bin) sums of g, of h); feature -1 where no cut gains."""
    best = None
    for fs, sg, sh in sums:
        gl, hl = np.cumsum(sg, axis=2), np.cumsum(sh, axis=2)
        g, h = gl[:, :, -1:], hl[:, :, -1:]
        gr, hr = g - gl, h - hl
        gain = gl * gl / (hl + cfg.reg) + gr * gr / (hr + cfg.reg) - g * g / (h + cfg.reg)
        gain[(hl < cfg.least_h) | (hr < cfg.least_h)] = -np.inf
        cut = gain.argmax(axis=2)
        gain = np.take_along_axis(gain, cut[:, :, None], 2)[:, :, 0]
        n, j = np.arange(gain.shape[1]), gain.argmax(axis=0)
        b = cut[j, n]
        if best is None:
            best = [g[0, :, 0], h[0, :, 0], np.full(len(n), -1), np.zeros(len(n), int), gl[0, :, 0], hl[0, :, 0]]
            top = np.full(len(n), LEAST_GAIN)
        more = gain[j, n] > top
        top = np.where(more, gain[j, n], top)
        best[2:] = [np.where(more, new, was) for new, was in zip((fs[j], b, gl[j, n, b], hl[j, n, b]), best[2:])]
    return list(zip(*(x.tolist() for x in best)))


def _class_tree(by_column: np.ndarray, k: int, rnd: int, n_bins: int, g: np.ndarray, h: np.ndarray,
                cfg: BoostConfig) -> Tree:
    """A class's tree from the sampled rows; ``by_column`` has their bins, a feature after the other."""
    cols = columns_of(rnd, k, len(by_column), cfg)
    if len(g) >= MANY_ROWS:
        return grow(_find_in_many(by_column, cols, k, n_bins, g, h, cfg), [k], cfg)[k]
    place_of = np.zeros(len(by_column), int)
    place_of[cols] = np.arange(len(cols))
    bins, at = by_column[cols], np.zeros(len(g), np.int64)

    def find(trees, open_):
        nonlocal bins, at, g, h
        nodes = [n for _, n in open_]
        if len(trees[k].g) > 1:
            flat, n = bins.ravel(), np.arange(len(at))
            at = Tree.below(trees[k].steps(), lambda f: flat[place_of[f] * len(at) + n], at)
        place = np.full(len(trees[k].g), -1)
        place[nodes] = np.arange(len(nodes))
        where = place[at]
        if where.min(initial=0) < 0:        # rows on closed nodes stay there
            on = np.flatnonzero(where >= 0)
            bins, at, g, h, where = bins.take(on, axis=1), at[on], g[on], h[on], where[on]
        cells, first = len(nodes) * n_bins, where * n_bins
        step = min(len(cols), max(1, CELLS // max(cells, len(first))))

        offset = np.arange(step)[:, None] * cells + first
        weights = [np.tile(w, step) if step > 1 else w for w in (g, h)]

        def sums():     # of as many features at once as stay in a core's cache
            for i in range(0, len(cols), step):
                some = bins[i:i + step]
                flat = (offset[:len(some)] + some).ravel()
                yield cols[i:i + step], *(np.bincount(flat, w[:len(flat)], len(some) * cells)
                                          .reshape(len(some), len(nodes), n_bins) for w in weights)

        return dict(zip(open_, best_cuts(sums(), cfg)))

    return grow(find, [k], cfg)[k]


def _find_in_many(by_column: np.ndarray, cols: np.ndarray, k: int, n_bins: int, g: np.ndarray, h: np.ndarray,
                  cfg: BoostConfig):
    """``find`` of ``grow`` for one class and many rows, which are kept in the order of their open nodes."""
    flat, n = by_column.ravel(), len(g)
    rows, slot, last, held = np.arange(n), np.zeros(n, np.int64), None, None

    def pieces(rows, slot):
        """(rows, first cells, weights, slots) of some rows at once."""
        for i in range(0, len(rows), PIECE_ROWS):
            r, s = rows[i:i + PIECE_ROWS], slot[i:i + PIECE_ROWS]
            yield r, (s - s[0]) * n_bins, g[r], h[r], s[0], s[-1] + 1

    def summed(some, f, n_slots):
        """(slot, bin) sums of g and h of a feature."""
        sg, sh = np.zeros((n_slots, n_bins)), np.zeros((n_slots, n_bins))
        for r, first, wg, wh, a, z in some:
            at = first + by_column[f].take(r, mode="clip") if last is not None else by_column[f, r[0]:r[-1] + 1].astype(np.int64)
            for out, w in ((sg, wg), (sh, wh)):
                out[a:z] += np.bincount(at, w, (z - a) * n_bins).reshape(z - a, n_bins)
        return sg, sh

    def find(trees, open_):
        nonlocal rows, slot, last, held
        t, nodes = trees[k], [node for _, node in open_]
        if last is None:
            parents, small, from_small, family = None, np.zeros(1, int), np.ones(1, bool), np.zeros(1, int)
            some = list(pieces(rows, slot))
        else:
            # of the nodes opened last, those with an open child go on
            feature, cut, low = (np.array(c)[last] for c in (t.feature, t.cut, t.left))
            place = np.full(len(t.g), -1)
            place[nodes] = np.arange(len(nodes))
            parents = np.flatnonzero((feature >= 0) & ((place[low] >= 0) | (place[low + 1] >= 0)))
            number = np.full(len(last), -1)
            number[parents] = np.arange(len(parents))
            if len(parents) < len(last):
                on = number[slot] >= 0
                rows, slot = rows[on], slot[on]
            over = flat.take(feature[slot] * n + rows, mode="clip") > cut[slot]
            child = (2 * number[slot] + over).astype(np.uint16)
            order = np.argsort(child, kind="stable")
            rows, child = rows[order], child[order].astype(np.int64)
            count = np.bincount(child, minlength=2 * len(parents))
            small = 2 * np.arange(len(parents)) + (count[1::2] < count[::2])
            is_small = np.zeros(len(count), bool)
            is_small[small] = True
            on = is_small[child]
            some = list(pieces(rows[on], child[on] >> 1))
            ids = np.stack([low[parents], low[parents] + 1], axis=1).ravel()    # the children, as numbered in ``child``
            where = np.flatnonzero(place[ids] >= 0)
            assert ids[where].tolist() == nodes
            from_small, family = is_small[where], where >> 1
            on = place[ids][child] >= 0
            rows, slot = rows[on], place[ids][child[on]]
        now = [np.empty((len(cols), len(nodes), n_bins)) for _ in range(2)]

        def sums():
            step = max(1, CELLS // (len(nodes) * n_bins))
            for i in range(0, len(cols), step):
                for j, f in enumerate(cols[i:i + step], i):
                    got = summed(some, f, len(small))
                    if parents is not None:
                        rest = [all_[j, parents] - part for all_, part in zip(held, got)]
                        none = (np.abs(rest[0]) < RESIDUE) & (np.abs(rest[1]) < RESIDUE)
                        for r in rest:
                            r[none] = 0
                    for c in range(2):
                        now[c][j, from_small] = got[c][family[from_small]]
                        if parents is not None:
                            now[c][j, ~from_small] = rest[c][family[~from_small]]
                yield cols[i:i + step], now[0][i:i + step], now[1][i:i + step]

        found = dict(zip(open_, best_cuts(sums(), cfg)))
        last, held = nodes, now
        return found

    return find


def _round(block: Block, rnd: int, classes, n_bins: int, cfg: BoostConfig, p: np.ndarray | None = None) -> list[Tree]:
    """Some classes' trees of a round whose rows are all in one block, with chances ``p``."""
    p = block.chances() if p is None else p
    rows = np.flatnonzero(_sampled(block.rid, rnd, cfg))
    by_column, y = block.bins.T.take(rows, axis=1), block.y[rows]
    out = []
    for k in classes:
        pk = p[rows, k]
        out.append(_class_tree(by_column, k, rnd, n_bins, pk - (y == k), np.maximum(2 * pk * (1 - pk), 1e-16), cfg))
    return out


# ---------------------------------------------------------------- training set
def cuts_of(train: DataFrame, d: int, bins: int = BINS) -> list[np.ndarray]:
    """The values at which each feature is cut: at most bins - 1 approximate quantiles."""
    probs = [float(q) for q in np.linspace(0, 1, bins + 1)[1:-1]]
    row = train.agg(*[F.percentile_approx(F.get("x", i), F.array(*map(F.lit, probs)), 10_000).alias(f"q{i}")
                      for i in range(d)]).first()
    return [np.unique(np.array(row[i], float)) for i in range(d)]


def _to_blocks(cuts: list[np.ndarray]):
    def run(batches):
        x, y, rid = [], [], []

        def emit():
            v = np.array(x, float).reshape(len(x), len(cuts))
            bins = np.stack([np.searchsorted(c, v[:, i], "left") for i, c in enumerate(cuts)], axis=1)
            return pa.record_batch([pa.array([len(x)], pa.int32()), pa.array([bins.astype(np.uint8).tobytes()]),
                                    pa.array([np.array(y, "<i4").tobytes()]), pa.array([np.array(rid, "<i8").tobytes()]),
                                    pa.array([None], pa.binary())], names=["n", "bins", "y", "rid", "scores"])
        for b in batches:
            for v, c, i in zip(*(b.column(k).to_pylist() for k in ("x", "y", "rid"))):
                x.append(v)
                y.append(c)
                rid.append(i)
                if len(x) == BLOCK_ROWS:
                    yield emit()
                    x, y, rid = [], [], []
        if x:
            yield emit()
    return run


def _node_rows(rnd: int, trees: list[Tree], cuts: list[np.ndarray], cfg: BoostConfig) -> pd.DataFrame:
    """A round's part of the node table."""
    def joined(name, kind):
        return np.concatenate([np.array(getattr(t, name), kind) for t in trees])
    sizes, first = [len(t.g) for t in trees], np.cumsum([0, *map(len, cuts)])
    feature = joined("feature", np.int32)
    at = np.where(feature >= 0, first[feature] + joined("cut", np.int64), 0)
    threshold = np.where(feature >= 0, np.concatenate([*cuts, [0.0]])[at], 0.0)
    return pd.DataFrame({
        "round": np.full(len(feature), rnd, np.int32), "cls": np.repeat(np.arange(len(trees), dtype=np.int32), sizes),
        "node": np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]), "feature": feature, "threshold": threshold,
        "left": joined("left", np.int32), "right": joined("right", np.int32), "g": joined("g", float),
        "h": joined("h", float), "value": np.concatenate([t.values(cfg) for t in trees])})


def _loss_row(rnd: int, loss: float) -> pd.DataFrame:
    one = dict(zip((f.split()[0] for f in NODES.split(", ")), (rnd, -1, -1, -1, 0.0, -1, -1, 0.0, 0.0, loss)))
    return pd.DataFrame({c: np.array([v], float if isinstance(v, float) else np.int32) for c, v in one.items()})


def _fit_in_block(cuts: list[np.ndarray], n_classes: int, n_bins: int, cfg: BoostConfig):
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                block = Block(r, n_classes=n_classes)
                for rnd in range(cfg.rounds):
                    trees = _round(block, rnd, range(n_classes), n_bins, cfg)
                    block.learn(trees, cfg)
                    for part in (_node_rows(rnd, trees, cuts, cfg), _loss_row(rnd, block.loss() / len(block.y))):
                        yield pa.RecordBatch.from_pandas(part, preserve_index=False)
    return run


# ------------------------------------------------------------- a task for each class
_HELD: dict = {}    # the rows that this Python worker holds: fit -> (rounds learnt, block)


def _holds(fit: str, since: int, upto: int) -> bool:
    """Whether this worker holds the rows with the scores of some round so far (asked here: a function
    made for a task has a copy of ``_HELD``)."""
    return since <= _HELD.get(fit, (-1, None))[0] <= upto


def _caught_up(fit: str, rows, kept: int, new: list, n_classes: int, cfg: BoostConfig) -> Block:
    """All rows with the scores after the rounds so far.  A worker that helped with a round
    before learns the rounds since; another starts from the scores kept in the blocks."""
    done, block = _HELD.pop(fit, (-1, None))
    _HELD.clear()
    if kept <= done <= kept + len(new):
        for _ in rows:      # the input is read to its end, or Spark ends the worker
            pass
    else:
        done, block = kept, Block(*rows, n_classes=n_classes)
    for trees in new[done - kept:]:
        block.learn(trees, cfg)
    _HELD[fit] = (kept + len(new), block)
    return block


def _class_task(fit: str, kept: int, new: list, n_tasks: int, n_classes: int, n_bins: int, cfg: BoostConfig,
                reads: bool):
    """(class, tree, the rows' mean loss before it) of each class that falls to the partition, if any: other
    tasks keep their workers up to date, as Spark gives the next round's tasks to the workers that waited longest.
    Nothing if the task does not read the rows and its worker does not hold them."""
    def run(i, rows):
        if not reads and not _holds(fit, kept, kept + len(new)):
            for _ in rows:
                pass
            return
        block = _caught_up(fit, rows, kept, new, n_classes, cfg)
        classes = range(i, n_classes, n_tasks) if i < n_tasks else ()
        if not classes:
            return
        p = block.chances()
        lost = block.loss(p) / len(block.y) if i == 0 else None
        yield from ((k, t, lost) for k, t in zip(classes, _round(block, kept + len(new), classes, n_bins, cfg, p)))
    return run


def _fit_by_class(blocks: DataFrame, cuts: list, n_classes: int, n_bins: int, cfg: BoostConfig) -> list[pd.DataFrame]:
    fit, sc = uuid.uuid4().hex, blocks.sparkSession.sparkContext
    # a class a task; with fewer cores than classes, as many in each as the cores take one after the other
    n_tasks = math.ceil(n_classes / math.ceil(n_classes / max(1, sc.defaultParallelism)))
    n_all = max(n_tasks, min(sc.defaultParallelism, 2 * n_classes))
    empty = sc.parallelize(range(n_all), n_all)
    tables, new, recent, kept, tasks = [], [], [], 0, None
    for rnd in range(cfg.rounds):
        if len(new) == CLASS_KEEP_ROUNDS:
            blocks = frozen(blocks.mapInArrow(_rescored(new, n_classes, cfg, False), _BLOCK))
            new, kept, tasks = [], rnd, None
        found = []
        if rnd:         # the workers that hold the rows need no input
            task = _class_task(fit, rnd - len(recent), recent, n_tasks, n_classes, n_bins, cfg, False)
            found = empty.mapPartitionsWithIndex(task).collect()
        missing = sorted({k % n_tasks for k in set(range(n_classes)) - {k for k, _, _ in found}})
        if missing:
            if tasks is None:       # partitions that each read all blocks
                tasks = sc.union([blocks.rdd.coalesce(1)] * n_all)
            task = _class_task(fit, kept, list(new), n_tasks, n_classes, n_bins, cfg, True)
            found += sc.runJob(tasks.mapPartitionsWithIndex(task), list, missing if rnd else range(n_all))
        found.sort(key=lambda x: x[0])
        if rnd:
            tables.append(_loss_row(rnd - 1, found[0][2]))
        new.append([t for _, t, _ in found])
        recent = [*recent, new[-1]][-SENT_ROUNDS:]
        tables.append(_node_rows(rnd, new[-1], cuts, cfg))
    one = blocks.mapInArrow(_rescored(new, n_classes, cfg, True), "n long, loss array<double>") \
        .agg(F.sum("n"), F.sum(F.get("loss", len(new) - 1))).first()
    return [*tables, _loss_row(cfg.rounds - 1, one[1] / one[0])]


# ------------------------------------------------------------- levels over blocks
def _level_sums(new: list, trees: list[Tree], open_: list, rnd: int, n_classes: int, n_bins: int, cfg: BoostConfig):
    """A block's sums for the open nodes, as rows."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                block = Block(r, n_classes=n_classes)
                for t in new:
                    block.learn(t, cfg)
                g, h = block.gradients()
                rows = np.flatnonzero(_sampled(block.rid, rnd, cfg))
                for k in sorted({k for k, _ in open_}):
                    nodes = [n for c, n in open_ if c == k]
                    cols = columns_of(rnd, k, block.bins.shape[1], cfg)
                    at = trees[k].leaves(block.bins, cfg.depth)
                    sg, sh = block.sums(rows, at, nodes, cols, g[:, k], h[:, k], n_bins)
                    i, j, v = np.nonzero(sh)
                    yield pa.record_batch(
                        [pa.array(np.full(len(i), k), pa.int32()), pa.array(np.array(nodes)[i], pa.int32()),
                         pa.array(cols[j], pa.int32()), pa.array(v, pa.int32()), pa.array(sg[i, j, v]),
                         pa.array(sh[i, j, v])], names=["k", "node", "f", "bin", "g", "h"])
    return run


def _find_by_level(blocks: DataFrame, new: list, rnd: int, n_classes: int, n_bins: int, cfg: BoostConfig):
    def find(trees, open_):
        sums = blocks.mapInArrow(_level_sums(new, trees, open_, rnd, n_classes, n_bins, cfg),
                                 "k int, node int, f int, bin int, g double, h double") \
            .groupBy("k", "node", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        upto = Window.partitionBy("k", "node", "f").orderBy("bin")
        whole = upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        upto = upto.rowsBetween(Window.unboundedPreceding, 0)
        run = sums.select("k", "node", "f", "bin", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
                          F.sum("g").over(whole).alias("sg"), F.sum("h").over(whole).alias("sh"))
        gr, hr = F.col("sg") - F.col("gl"), F.col("sh") - F.col("hl")
        gain = F.col("gl") * F.col("gl") / (F.col("hl") + cfg.reg) + gr * gr / (hr + cfg.reg) \
            - F.col("sg") * F.col("sg") / (F.col("sh") + cfg.reg)
        can = (F.col("hl") >= cfg.least_h) & (hr >= cfg.least_h)
        scored = run.withColumn("gain", F.when(can, gain))
        best = scored.groupBy("k", "node").agg(
            F.min_by(F.struct("sg", "sh"), "f").alias("all"),
            F.max_by(F.struct("gain", "f", "bin", "gl", "hl"),
                     F.when(F.col("gain") > LEAST_GAIN, F.struct("gain", -F.col("f"), -F.col("bin")))).alias("c"))
        out = {}
        for r in best.collect():       # one row an open node
            c = r["c"] if r["c"] is not None and r["c"]["gain"] is not None and r["c"]["gain"] > LEAST_GAIN else None
            out[(r["k"], r["node"])] = (r["all"]["sg"], r["all"]["sh"], c["f"] if c else -1, c["bin"] if c else 0,
                                        c["gl"] if c else 0.0, c["hl"] if c else 0.0)
        return out
    return find


def _rescored(new: list, n_classes: int, cfg: BoostConfig, losses: bool):
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                block, lost = Block(r, n_classes=n_classes), []
                for t in new:
                    block.learn(t, cfg)
                    lost.append(block.loss())
                if losses:
                    yield pa.record_batch([pa.array([r["n"]], pa.int64()), pa.array([lost])], names=["n", "loss"])
                else:
                    yield pa.record_batch([pa.array([r["n"]], pa.int32()), pa.array([r["bins"]]), pa.array([r["y"]]),
                                           pa.array([r["rid"]]), pa.array([block.scores.astype("<f8").tobytes()])],
                                          names=["n", "bins", "y", "rid", "scores"])
    return run


_BLOCK = "n int, bins binary, y binary, rid binary, scores binary"


def _fit_by_level(blocks: DataFrame, cuts: list, n_classes: int, n_bins: int, cfg: BoostConfig) -> list[pd.DataFrame]:
    tables, new = [], []
    for rnd in range(cfg.rounds):
        trees = list(grow(_find_by_level(blocks, list(new), rnd, n_classes, n_bins, cfg), range(n_classes), cfg).values())
        tables.append(_node_rows(rnd, trees, cuts, cfg))
        new.append(trees)
        if len(new) == KEEP_ROUNDS or rnd == cfg.rounds - 1:
            lost = blocks.mapInArrow(_rescored(new, n_classes, cfg, True), "n long, loss array<double>")
            one = lost.agg(F.sum("n"), *[F.sum(F.get("loss", i)) for i in range(len(new))]).first()
            tables += [_loss_row(rnd - len(new) + 1 + i, one[i + 1] / one[0]) for i in range(len(new))]
            if rnd < cfg.rounds - 1:
                blocks, new = frozen(blocks.mapInArrow(_rescored(new, n_classes, cfg, False), _BLOCK)), []
    return tables


# ------------------------------------------------------------------------- model
@dataclass
class BoostModel:
    """``nodes`` is the table of all trees, bounded by rounds x classes x 2^(depth + 1)."""
    nodes: pd.DataFrame
    classes: list
    depth: int
    losses: list = field(default_factory=list)
    rows: DataFrame | None = None      # the training rows (rid, y, x)
    cfg: BoostConfig = BoostConfig()

    def save(self, spark, path: str) -> None:
        from vigil.ml.bundle import write_json
        self.table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        write_json(spark, f"{path}/booster.json", {"classes": self.classes, "depth": self.depth, "losses": self.losses})

    @staticmethod
    def load(spark, path: str) -> BoostModel:
        from vigil.ml.bundle import read_json
        meta = read_json(spark, f"{path}/booster.json")
        return BoostModel(spark.read.parquet(f"{path}/nodes").toPandas(), meta["classes"], meta["depth"], meta["losses"])

    def table(self, spark) -> DataFrame:
        """The node table as a DataFrame, sent by column."""
        return spark.createDataFrame(pa.Table.from_pandas(self.nodes, preserve_index=False)).select(
            *(F.col(c).cast(kind) for c, kind in (f.split() for f in NODES.split(", "))))

    def arrays(self) -> tuple:
        """Trees end to end: (first node, nodes, class) of each and all nodes' (feature, bin of the threshold, left,
        value), with the thresholds of each feature that make its bins, and each class's sum over trees of one leaf."""
        t = self.nodes.sort_values(["round", "cls", "node"], ignore_index=True)
        first = np.flatnonzero(t.node.to_numpy() == 0)
        size = np.diff([*first, len(t)])
        cls = t.cls.to_numpy()[first]
        value = t.value.to_numpy()
        base = np.zeros(len(self.classes))
        np.add.at(base, cls[size == 1], value[first[size == 1]])     # trees of one leaf
        feature, threshold = t.feature.to_numpy(), t.threshold.to_numpy()
        cuts = [np.unique(threshold[feature == f]) for f in range(int(feature.max(initial=-1)) + 1)]
        # a value is at most the threshold if no more thresholds are below it than below the threshold
        cut = np.full(len(t), max(map(len, cuts), default=0), np.int32)
        for f, c in enumerate(cuts):
            cut[feature == f] = np.searchsorted(c, threshold[feature == f])
        here = t.node.to_numpy()
        tall = size > 1
        return (np.stack([first[tall], size[tall], cls[tall]], axis=1), np.maximum(feature, 0).astype(np.int32),
                cut.astype(np.min_scalar_type(int(cut.max(initial=0)))), np.where(feature < 0, here, t.left.to_numpy()).astype(np.int32),
                value, cuts, base)


def fit_boost(train: DataFrame, classes: list, cfg: BoostConfig = BoostConfig(),
              by_level: bool | None = None) -> BoostModel:
    """``train``: (x array<double> of one width, without nulls; y class index).

    ``by_level``: whether blocks meet level by level; else by their size."""
    # a row's number: its partition and place, 2^20 rows and 2^11 partitions before numbers repeat
    place = F.monotonically_increasing_id()
    rid = F.shiftleft(F.shiftright(place, 33).bitwiseAND(F.lit(2047)), 20).bitwiseOR(place.bitwiseAND(F.lit(1048575)))
    rows = frozen(train.select(rid.alias("rid"), F.col("y").cast("int").alias("y"), F.col("x").cast("array<double>").alias("x")))
    size = rows.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("lo"), F.max(F.size("x")).alias("hi")).first()
    if not size["n"] or size["lo"] != size["hi"]:
        raise ValueError("boosted trees need rows, and one width of features")
    cuts = cuts_of(rows, size["hi"])
    n_bins = max(len(c) for c in cuts) + 1
    n_blocks = math.ceil(size["n"] / BLOCK_ROWS)
    blocks = frozen(rows.repartition(n_blocks).mapInArrow(_to_blocks(cuts), _BLOCK))
    if by_level is None:
        by_level = size["n"] * (len(cuts) + 8 * len(classes) + 12) > WHOLE_BYTES and n_blocks > 1
    if by_level or blocks.count() > 1:
        fit = _fit_by_level if by_level else _fit_by_class
        table = pd.concat(fit(blocks, cuts, len(classes), n_bins, cfg), ignore_index=True)
    else:
        table = blocks.mapInArrow(_fit_in_block(cuts, len(classes), n_bins, cfg), NODES).toPandas()
    losses = table[table.cls < 0].sort_values("round").value.tolist()
    return BoostModel(table[table.cls >= 0].reset_index(drop=True), list(classes), cfg.depth, losses, rows, cfg)


def raw_scores(x: np.ndarray, arrays: tuple, depth: int) -> np.ndarray:
    """(rows, classes): the sums of the leaves' values."""
    trees, feature, cut, low, value, cuts, base = arrays
    out = np.tile(base, (len(x), 1))
    if not len(trees):
        return out
    bins = np.empty((len(x), len(cuts)), cut.dtype, order="F")
    for f, c in enumerate(cuts):
        bins[:, f] = np.searchsorted(c, x[:, f])
    for k in range(out.shape[1]):
        mine = trees[trees[:, 2] == k]
        ends = np.empty((len(mine), len(x)))
        for i, (a, n, _) in enumerate(mine):
            steps = feature[a:a + n].astype(np.int64), cut[a:a + n], low[a:a + n].astype(np.int64)
            ends[i] = value[a:a + n].take(leaves(steps, bins, depth))
        # a row's sum is the same in any batch, which a product of matrices does not promise
        out[:, k] += np.ascontiguousarray(ends.T).sum(axis=1)
    return out


def score_boost(df: DataFrame, model: BoostModel, features_col: str, out: str,
                scores_col: str | None = None) -> DataFrame:
    """Adds ``out``, the class of the largest score (the first of equal ones)."""
    bc = df.sparkSession.sparkContext.broadcast((model.arrays(), model.depth))

    @F.pandas_udf("array<double>")
    def scored(col: pd.Series) -> pd.Series:
        arrays, depth = bc.value
        rows = []
        for i in range(0, len(col), SCORE_ROWS):
            x = np.array(col.iloc[i:i + SCORE_ROWS].tolist(), float)
            rows += list(raw_scores(x, arrays, depth))
        return pd.Series(rows)

    got = df.withColumn("__s", scored(F.col(features_col)))
    names = F.array(*[F.lit(c) for c in model.classes])
    best = F.get(names, F.array_position("__s", F.array_max("__s")).cast("int") - 1)
    got = got.withColumn(out, best)
    return got.withColumnRenamed("__s", scores_col) if scores_col else got.drop("__s")
