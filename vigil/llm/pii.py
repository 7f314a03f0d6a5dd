"""Personal data: fixed patterns plus a skip-chain conditional random field.

The patterns find the base spans.  The field then labels every candidate: a token
that holds a digit or an ``@``, or a number written in several tokens.  Unary
potentials come from the candidate's shape and its neighbours, chain edges join
neighbours, and skip edges join each candidate to the previous one in the document
with the same letters and digits, and numbers of which one is the end of the
other (7 digits at least).  Messages pass until they settle and make far-apart
mentions agree, so a number that is spelled out once as a phone number is also
found where it stands bare.  Candidates with a
marginal of at least ``confidence`` outside the base spans become added spans.

The field is trained on the base spans.  A candidate outside them that skip edges
connect to one is not known to be harmless: its label is hidden, and taken to be that
of the span it repeats.  All other candidates are negatives.  Chain potentials are
smoothed log ratios of the label pairs of all edges of the corpus.  The skip potential
is tied to agreement: one weight, the log odds of the corpus's skip pairs to agree,
with a prior that mentions of one number differ in kind once in 100,000 times.
Unaries are a softmax regression, for hidden labels given what the skip edges say, so
a form that is personal only where it repeats a span is not personal by itself.
Candidates with the same features, label and skip neighbour form one training row with
their number in the corpus as its weight; of over ``MAX_FORMS`` such forms, those
with the lowest hashes (some half of the bound at least) are learned from.
Documents without a digit or an ``@`` hold no personal data of these kinds and
cost one look at their bytes.  Repeats are linked in a chain, so the graph stays
linear in the document's length.

Defined cases: null and empty texts have no spans; repeated rows each get their
row; a null doc_id is passed through; without any training token only the base
spans are returned; keys of under four letters and digits get no skip edge, and an
address's key keeps its dots; a group of repeats that meets spans of two kinds is
taught the kind of most of them, and of equally many the one listed first.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import tokens
from vigil.llm.frames import documents, freeze

# fixed values: kinds in their listed order, and their patterns; the look-behinds
# and possessive quantifiers only spare work on long runs
KINDS = ["email", "ip", "card", "phone"]
_LOCAL = r"[A-Za-z0-9._%+-]"
_EMAIL = re.compile(_LOCAL + r"++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_EMAIL_START = re.compile(rf"(?<!{_LOCAL})" + _EMAIL.pattern)
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

MAX_FORMS = 100_000          # different forms of candidates the unaries learn from
FEATURES = 1 << 12
CONFIDENCE = 0.95
SETTLED = 1e-5              # change of a message that counts as none
_K = len(KINDS) + 1          # label 0: no personal data
# log odds that skip neighbours agree: pairs believed before any is seen, and the bounds
AGREE_PRIOR, AGREE_LEAST, AGREE_MOST = 100_000, 6.0, 12.0
OBSERVED = 30.0              # what a base span's label counts in its candidate's unary


def emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while True:
        # right after a match a local part may begin inside a run of its characters
        m = (at and _EMAIL.match(text, at)) or _EMAIL_START.search(text, at)
        if not m:
            return
        yield m.span()
        at = m.end()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches that pass their tests, sorted."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
            if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                if 9 <= len(_DIGITS.findall(m.group())) <= 15]
    return sorted(out)


# ------------------------------------------------------------------ the field
_RUNS = [(re.compile(r"[0-9]+"), "9"), (re.compile(r"[A-Z]+"), "A"), (re.compile(r"[a-z]+"), "a"),
         (re.compile(r"[^\x00-\x7f]+"), "u")]
_KEEP = re.compile(r"[^a-z0-9]")


def shape(token: str) -> str:
    """Runs of digits, letters and others each become one character."""
    for pattern, sign in _RUNS:
        token = pattern.sub(sign, token)
    return token


def _feature(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "big") % FEATURES


_NUMBER = re.compile(r"[+(]*[0-9][0-9+().,;:!?/-]*")     # a token of a number written in parts
_WHOLE, _SUFFIX, _LONGEST = 9, 7, 19    # digits: whole by itself, told by its end, of any number


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _units(texts: list[str], start: list, end: list, spaced: list, spans: list, text: str) -> list:
    """(first token, last token, key) of the candidates of one row, in order.

    Tokens under one base span are one candidate, keyed by the span's own letters and
    digits.  Of the other tokens, a run of number tokens with single spaces between
    is cut where its parts say again (the end of) a number that the row holds;
    otherwise a run of the size of one number stays whole.
    """
    n = len(texts)
    owner: list = [None] * n
    units, k = [], 0
    for a, kind, b in spans:
        while k < n and end[k] <= a:
            k += 1
        j = k
        while j < n and start[j] < b:
            j += 1
        if j > k and not any(owner[k:j]):
            owner[k:j] = [True] * (j - k)
            units.append((k, j - 1, text[a:b] if KINDS[kind] == "ip" else _KEEP.sub("", text[a:b].lower())))
    runs, i = [], 0
    while i < n:
        j = i + 1
        if not owner[i] and _NUMBER.fullmatch(texts[i]):
            while j < n and spaced[j] and not owner[j] and texts[j][0] != "+" \
                    and _NUMBER.fullmatch(texts[j]):
                j += 1
        if not owner[i]:
            runs.append((i, j, [_digits(t) for t in texts[i:j]]))
        i = j
    parted = [r for r in runs if r[1] - r[0] > 1]
    whole = {r[0] for r in parted if _SUFFIX <= sum(map(len, r[2])) <= _LONGEST
             and max(map(len, r[2])) < _WHOLE}
    ends: set = set()
    if parted:
        known = {key for _, _, key in units if key.isdigit()}
        known.update(d for i, j, ds in runs if j - i == 1 or i not in whole
                     for t, d in zip(texts[i:j], ds) if _NUMBER.fullmatch(t))
        known.update("".join(ds) for i, _, ds in parted if i in whole)
        ends = {d[x:] for d in known if len(d) <= _LONGEST for x in range(len(d) - _SUFFIX + 1)}
    for i, j, ds in runs:
        at = i
        while at < j:
            size, best, key = 0, at, ""
            for to in range(at, j if j - i > 1 else at):
                size += len(ds[to - i])
                if size > _LONGEST:
                    break
                if size >= _SUFFIX and (d := "".join(ds[at - i:to - i + 1])) in ends:
                    best, key = to, d
            units.append((at, best, key if best > at else _KEEP.sub("", texts[at].lower())))
            at = best + 1
    return sorted(units)


def _links(keys: list[str]) -> list[tuple[int, int]]:
    """Pairs of candidates of one row: each with the one before of its key, and the first of
    a key with the nearest of the longest key that is its end.  A forest."""
    places: dict[str, list[int]] = {}
    for i, key in enumerate(keys):
        if len(key) >= 4:
            places.setdefault(key, []).append(i)
    out = [(a, b) for at in places.values() for a, b in zip(at[:-1], at[1:])]
    for key, at in places.items():
        if key.isdigit() and len(key) <= _LONGEST:
            for x in range(1, len(key) - _SUFFIX + 1):
                if key[x:] in places:
                    ends = places[key[x:]]
                    k = bisect(ends, at[0])
                    near = min(ends[max(0, k - 1):k + 1], key=lambda i: abs(i - at[0]))
                    out.append((min(near, at[0]), max(near, at[0])))
                    break
    return out


class Graph:
    """Candidates of the rows of a text column (tokens, or numbers of several tokens),
    with base spans, features and edges."""

    def __init__(self, col: pa.Array):
        w = tokens.Words(col)
        data, off = tokens.text_buffer(col)
        mark = ((data >= 48) & (data <= 57)) | (data == 64)
        before = np.concatenate([[0], np.cumsum(mark, dtype=np.int64)])
        self.live = np.diff(before[off]) > 0                      # rows with any candidate
        at = np.flatnonzero(before[w.end] > before[w.start])
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
        row = w.row[at]
        base = chars[off[row]]
        start, end = (chars[w.start[at]] - base).tolist(), (chars[w.end[at]] - base).tolist()
        text = [data[a:b].tobytes().decode() for a, b in zip(w.start[at], w.end[at])]
        next_to = np.zeros(len(at), bool)                          # next to the one before
        next_to[1:] = (np.diff(at) == 1) & (np.diff(row) == 0)
        spaced = next_to.copy()                                    # by a single space
        spaced[1:] &= (w.start[at][1:] - w.end[at][:-1] == 1) & (data[w.start[at][1:] - 1] == 32)
        self.spans: list[list] = [[]] * len(self.live)
        rows, first, last, skip, self.text = [], [], [], [], []
        bounds = np.searchsorted(row, np.arange(len(self.live) + 1))
        for r in np.flatnonzero(self.live).tolist():
            a, b = bounds[r], bounds[r + 1]
            whole = data[off[r]:off[r + 1]].tobytes().decode()
            self.spans[r] = base_spans(whole)
            units = _units(text[a:b], start[a:b], end[a:b], spaced[a:b], self.spans[r], whole)
            skip += [(len(rows) + x, len(rows) + y) for x, y in _links([k for *_, k in units]) if y - x > 1
                     or not next_to[a + units[y][0]]]
            for i, j, _ in units:
                rows.append(r)
                first.append(a + i)
                last.append(a + j)
                self.text.append(whole[start[a + i]:end[a + j]])
        n = len(rows)
        self.row = np.array(rows, np.int64)
        self.start = np.array([start[i] for i in first], np.int64)
        self.end = np.array([end[i] for i in last], np.int64)
        near = next_to[np.array(first, np.int64)] if n else np.zeros(0, bool)
        self.chain = np.column_stack([np.flatnonzero(near) - 1, np.flatnonzero(near)])
        self.skip = np.array(skip, np.int64).reshape(-1, 2)
        shapes = [shape(t) for t in self.text]
        feats = np.zeros((n, 7), np.int64)
        for i, t in enumerate(self.text):
            digits = sum(c.isdigit() for c in t)
            left = shapes[i - 1] if near[i] else "-"
            right = shapes[i + 1] if i + 1 < n and near[i + 1] else "-"
            feats[i] = [_feature(f) for f in (
                "bias", f"shape {shapes[i]}", f"digits {digits}", f"size {len(t)}",
                f"left {left}", f"right {right}", f"dots {min(t.count('.'), 5)} at {t.count('@')}")]
        self.feats = feats


def token_labels(g: Graph) -> np.ndarray:
    """1 + the kind of the base span that meets a candidate, or 0."""
    y = np.zeros(len(g.row), np.int64)
    before, at = -1, 0
    for i, r in enumerate(g.row.tolist()):
        spans = g.spans[r]
        if r != before:
            before, at = r, 0
        while at < len(spans) and spans[at][2] <= g.start[i]:
            at += 1
        x = at
        while x < len(spans) and spans[x][0] < g.end[i]:
            if g.start[i] < spans[x][2]:
                y[i] = spans[x][1] + 1
                break
            x += 1
    return y


def taught_labels(g: Graph) -> tuple[np.ndarray, np.ndarray]:
    """The labels to learn (hidden ones are those of the spans they repeat), and for each
    hidden one what its skip neighbours say (-1 for all others)."""
    y = token_labels(g)
    root = np.arange(len(y))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for a, b in g.skip.tolist():
        root[find(a)] = find(b)
    linked = np.unique(g.skip)
    groups: dict[int, list[int]] = {}
    for i in linked.tolist():
        groups.setdefault(find(i), []).append(i)
    said = np.full(len(y), -1, np.int64)
    for at in groups.values():
        known = Counter(y[at][y[at] > 0].tolist())
        label = min(known, key=lambda k: (-known[k], k)) if known else 0
        if label:
            hidden = [i for i in at if y[i] == 0]
            y[hidden] = said[hidden] = label
    return y, said


def marginals(unary: np.ndarray, edges: list[tuple[np.ndarray, np.ndarray]],
              rounds: int | None = None) -> np.ndarray:
    """Sum-product message passing; edges: (pairs, log potentials) of each kind.

    Messages pass until they settle: an edge is worked on as long as what comes in at
    its source changes.  Exact on forests, approximate on loops, where ``rounds``
    (by default four for each candidate, which the longest path needs at most,
    and 200) ends a graph that swings.
    """
    n = len(unary)
    src = np.concatenate([np.concatenate([p[:, 0], p[:, 1]]) for p, _ in edges])
    dst = np.concatenate([np.concatenate([p[:, 1], p[:, 0]]) for p, _ in edges])
    if not len(src):
        return _softmax(unary)
    kind = np.concatenate([np.repeat([2 * k, 2 * k + 1], len(p)) for k, (p, _) in enumerate(edges)])
    pot = np.stack([x for _, w in edges for x in (w, w.T)])
    # the message that runs against each edge's own
    back = np.concatenate([base + np.concatenate([np.arange(len(p)) + len(p), np.arange(len(p))])
                           for (p, _), base in zip(edges, np.cumsum(
                               [0] + [2 * len(p) for p, _ in edges])[:-1])])
    m = np.zeros((len(src), _K))
    into = np.zeros((n, _K))
    work = np.arange(len(src))
    for _ in range(4 * n + 200 if rounds is None else rounds):
        out = _logsum((unary[src[work]] + into[src[work]] - m[back[work]])[:, :, None] + pot[kind[work]])
        out -= out.max(axis=1, keepdims=True)
        step = 0.5 * (out - m[work])
        m[work] += step
        moved = np.abs(step).max(axis=1) > SETTLED
        if not moved.any():
            break
        np.add.at(into, dst[work], step)
        touched = np.zeros(n, bool)
        touched[dst[work[moved]]] = True
        again = touched[src]
        again[work[moved]] = True
        work = np.flatnonzero(again)
    return _softmax(unary + _gather(m, dst, n))


def _gather(m, dst, n):
    return np.column_stack([np.bincount(dst, m[:, k], n) for k in range(_K)])


def _logsum(x):
    top = x.max(axis=1)
    return top + np.log(np.exp(x - top[:, None, :]).sum(axis=1))


def _softmax(x):
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, said: np.ndarray, weight: np.ndarray, chain: np.ndarray,
          skip: np.ndarray, rounds: int = 120) -> tuple:
    """Weights (unary, chain, skip) from features, labels, skip neighbours and pair counts."""
    same = np.trace(skip)
    agree = float(np.clip(np.log((same + AGREE_PRIOR) / (skip.sum() - same + 1)), AGREE_LEAST, AGREE_MOST))
    given = np.where(said[:, None] == np.arange(_K), agree, 0.0)
    weight = (weight / weight.sum())[:, None]
    w, mem = np.zeros((FEATURES, _K)), np.full((FEATURES, _K), 1e-6)
    goal = np.eye(_K)[y]
    for _ in range(rounds):
        err = (_softmax(w[x].sum(axis=1) + given) - goal) * weight
        grad = np.column_stack([np.bincount(x.ravel(), np.repeat(err[:, k], x.shape[1]), FEATURES)
                                for k in range(_K)]) + 1e-5 * w
        mem += grad ** 2
        w -= 0.5 * grad / np.sqrt(mem)

    def ratio(c):
        c = c + c.T + 1.0
        return np.clip(np.log(c / c.sum()) - np.log(np.outer(c.sum(1), c.sum(0)) / c.sum() ** 2),
                       -3, 3)
    return w, ratio(chain), agree * np.eye(_K)


def added_spans(g: Graph, model: tuple, confidence: float) -> list[tuple]:
    """(row, start, kind, end) of confident candidates outside the base spans; neighbours merge."""
    w, chain, skip = model
    y = token_labels(g)
    unary = w[g.feats].sum(axis=1)
    unary[np.flatnonzero(y), y[y > 0]] += OBSERVED
    p = marginals(unary, [(g.chain, chain), (g.skip, skip)])
    kind = p.argmax(axis=1)
    sure = (kind > 0) & (p.max(axis=1) >= confidence) & (y == 0)
    follows = set(map(tuple, g.chain.tolist()))
    out: list[list] = []
    last = None
    for i in np.flatnonzero(sure).tolist():
        if last is not None and (last, i) in follows and kind[last] == kind[i]:
            out[-1][3] = int(g.end[i])
        else:
            out.append([int(g.row[i]), int(g.start[i]), int(kind[i]) - 1, int(g.end[i])])
        last = i
    return [tuple(x) for x in out]


def _train_rows(batches):
    """(t, a, b, x, n), summed over a piece: candidates (t = 0) with their label, that of their
    skip neighbours, and features; and label pairs of edges (1 chain, 2 skip)."""
    for b in tokens.chunks(batches):
        g = Graph(b.column(1))
        y, said = taught_labels(g)
        n = Counter((0, k, o, tuple(x)) for k, o, x in zip(y.tolist(), said.tolist(), g.feats.tolist()))
        for t, pairs in ((1, g.chain), (2, g.skip)):
            n.update((t, p, q, None) for p, q in zip(y[pairs[:, 0]].tolist(), y[pairs[:, 1]].tolist()))
        if n:
            t, first, second, feats = zip(*n)
            yield pa.record_batch([pa.array(t, pa.int32()), pa.array(first, pa.int32()),
                                   pa.array(second, pa.int32()), pa.array(feats, pa.list_(pa.int32())),
                                   pa.array(n.values(), pa.int64())], names=["t", "a", "b", "x", "n"])


def training_table(docs: DataFrame) -> DataFrame:
    """(t, a, b, x, n, level) of all documents; level: leading zero bits of the form's hash."""
    rows = documents(docs).mapInArrow(_train_rows, "t int, a int, b int, x array<int>, n long") \
        .groupBy("t", "a", "b", "x").agg(F.sum("n").alias("n"))
    return rows.withColumn("level", F.lit(64) - F.length(F.bin(F.xxhash64("a", "b", "x"))))


def fit(docs: DataFrame, max_forms: int = MAX_FORMS) -> tuple | None:
    table = freeze(training_table(docs), "pii-training")
    sizes = {r.level: r.n for r in
             table.where("t = 0").groupBy("level").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    # the lowest level from which on the forms fit the bound
    least, kept = max(sizes), sizes[max(sizes)]
    for k in sorted(sizes, reverse=True)[1:]:
        if kept + sizes[k] > max_forms:
            break
        least, kept = k, kept + sizes[k]
    forms = table.where((F.col("t") == 0) & (F.col("level") >= least)).orderBy("a", "b", "x").toPandas()
    counts = np.zeros((3, _K, _K))
    for r in table.where("t > 0").collect():
        counts[r.t, r.a, r.b] = r.n
    x = np.array(forms.x.tolist(), np.int64).reshape(len(forms), -1)
    return train(x, forms.a.to_numpy(np.int64), forms.b.to_numpy(np.int64), forms.n.to_numpy(np.float64), counts[1], counts[2])


def _spell(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_OUT = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, spans string")


def pii_digest(docs: DataFrame, confidence: float = CONFIDENCE) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document."""
    model = fit(docs)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for b in tokens.chunks(batches):
            n = b.num_rows
            g = Graph(b.column(1))
            counts = np.zeros((n, len(KINDS)), np.int64)
            sha, spelled = [nothing] * n, [""] * n
            live = np.flatnonzero(g.live)
            spans = g.spans
            more: dict[int, list] = {}
            if model is not None and len(live):
                for r, a, k, e in added_spans(g, model, confidence):
                    more.setdefault(r, []).append((a, k, e))
            for r in live.tolist():
                for _, k, _ in spans[r]:
                    counts[r, k] += 1
                sha[r] = hashlib.sha256(_spell(spans[r]).encode()).hexdigest()
                spelled[r] = _spell(sorted(spans[r] + more.get(r, [])))
            yield pa.record_batch([b.column(0), *[pa.array(c) for c in counts.T],
                                   pa.array(sha, pa.string()), pa.array(spelled, pa.string())],
                                  names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return documents(docs).mapInArrow(find, _OUT)
