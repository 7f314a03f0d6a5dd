"""Small documents with every odd case, and plain versions of the contracts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that operators use inside
          "id long, key string, kept string, row string, pos int, h1 long, component long, _id long")


def odd_texts(seed: int = 5) -> list:
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["été", "straße", "Ünder", "漢字", "😀"]
    text = lambda n: " ".join(rnd.choices(vocab, k=n))
    base, shared = text(120), text(45)
    near = base.split()
    near[60] = "changed"
    line = "This Line Stands in Many Documents"
    out = [(1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n "), (7, "one"),
           (8, "one"), (9, f"{line}\n{text(30)}\n{line}"), (10, f"  {line.lower()}\t\n{text(8)}"),
           (11, f"x\n{line.upper()}"), (12, text(20) + " " + shared + " " + text(25)),
           (13, shared + " " + text(9)), (14, text(33) + "\n" + shared), (15, "a " * 300),
           (16, text(4000) + " " + shared), (17, "b" * 20000), (18, " " * 5000 + "\n" * 300),
           (19, "\x1c  odd space\x85 x"), (1, base), (20, text(60)), (20, text(60)),
           (None, base), (None, None), (None, text(30)), (21, "ÀÉ Long enough line\nàé long enough line"),
           (22, "Àé LONG enough line\r"), (23, shared)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 1, "k", "x", "r", 0,
                                   7, 3, 9) for i, t in rows], SCHEMA)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def order(i):
    return -(1 << 63) if i is None else i


def lines_expected(rows, least=10):
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in k)
    holders: dict = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(key(x)) < least or min(holders[key(x)]) == order(i)]
        out.append((i, len(lines), len(lines) - len(keep), sha("\n".join(keep))))
    return out


def repeats_expected(rows, size=20):
    first: dict = {}
    words = [WORD.findall(t or "") for _, t in rows]
    for (i, _), w in zip(rows, words):
        for s in range(len(w) - size + 1):
            k, at = tuple(w[s:s + size]), (order(i), s)
            first[k] = min(first.get(k, at), at)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for s in range(len(w) - size + 1):
            if first[tuple(w[s:s + size])] < (order(i), s):
                gone.update(range(s, s + size))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def bags(rows, n=5):
    out = []
    for _, t in rows:
        w = WORD.findall(t or "")
        out.append(Counter(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n
                   else Counter([tuple(w)] if w else []))
    return out


def jaccard(a, b) -> float:
    i = sum((a & b).values())
    return i / (sum(a.values()) + sum(b.values()) - i) if a and b else 0.0


def classes_expected(rows, least=0.8):
    """The smallest id that each row reaches over links of at least ``least``."""
    b = bags(rows)
    at = list(range(len(rows)))

    def root(x):
        while at[x] != x:
            x = at[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if jaccard(b[i], b[j]) >= least:
                at[root(i)] = root(j)
    low: dict = {}
    for i in range(len(rows)):
        low[root(i)] = min(low.get(root(i), order(rows[i][0])), order(rows[i][0]))
    return [low[root(i)] for i in range(len(rows))]


def kinds_expected(text, patterns):
    """Spans (start, kind number, end) of (kind, pattern, test) in plain regular expressions."""
    return sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(patterns)
                  for m in re.finditer(p, text or "") if ok(m))
