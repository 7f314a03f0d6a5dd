"""SentencePiece encoding and decoding with an Aho-Corasick driven Viterbi search.

The pieces of a given model file form an Aho-Corasick automaton.  One pass over
the text moves through it; at each position the output links give every piece
that ends there, longest first, and relax the best score of the position.  A
character without a piece costs the lowest score less 10 and becomes byte
pieces, so decoding gives back every text exactly.  Among equal scores the
longer last piece wins.

No piece has a space after another character, so the lattice falls apart before
every run of spaces; such units are searched once and remembered (a bounded
memory).  A model with other pieces is searched text by text.

Defined cases: null and empty texts have no pieces (and decode to an empty
text); repeated rows and extra columns do not matter; an empty table gives an
empty table.  A literal U+2581 in a text is kept apart from the space mark.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vigil.llm import tokens
from vigil.llm.frames import documents

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
REMEMBERED, LONGEST_REMEMBERED = 250_000, 40
_UNIT = re.compile(r" +[^ ]*|[^ ]+")
_MARK = "▁"


def load(path: str = MODEL) -> dict:
    """Pieces of a model file: normal (text, score, id), bytes, and what each id spells."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    normal, byte_ids, spelled = [], {}, []
    for i in range(m.get_piece_size()):
        p = m.id_to_piece(i)
        if m.is_byte(i):
            byte_ids[int(p[3:-1], 16)] = i
            spelled.append(bytes([int(p[3:-1], 16)]))
        elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
            spelled.append(b"")
        else:
            normal.append((p.replace(_MARK, " "), float(m.get_score(i)), i))
            spelled.append(normal[-1][0].encode())
    if len(byte_ids) < 256:
        raise ValueError("exact round trips need a model with byte pieces")
    return {"normal": normal, "bytes": [byte_ids[b] for b in range(256)], "spelled": spelled}


class Automaton:
    """Goto, failure and output links over the pieces, and the Viterbi pass."""

    def __init__(self, model: dict):
        self.go: list[dict] = [{}]
        self.piece: list[tuple | None] = [None]        # (length, score, id) that ends here
        for text, score, i in model["normal"]:
            node = 0
            for c in text:
                nxt = self.go[node].get(c)
                if nxt is None:
                    nxt = self.go[node][c] = len(self.go)
                    self.go.append({})
                    self.piece.append(None)
                node = nxt
            self.piece[node] = (len(text), score, i)
        self.fail, self.out = [0] * len(self.go), [0] * len(self.go)
        queue = deque(self.go[0].values())
        while queue:
            node = queue.popleft()
            for c, child in self.go[node].items():
                f = self.fail[node]
                while f and c not in self.go[f]:
                    f = self.fail[f]
                self.fail[child] = f = self.go[f].get(c, 0) if self.go[f].get(c) != child else 0
                # the nearest suffix that is a piece
                self.out[child] = f if self.piece[f] else self.out[f]
                queue.append(child)
        # the pieces that end at a node, longest first: itself, then along the output links
        self.ends: list[tuple] = [()] * len(self.go)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            if node:
                own = ((self.piece[node],) if self.piece[node] else ())
                self.ends[node] = own + self.ends[self.out[node]]
            queue.extend(self.go[node].values())
        self.bytes = model["bytes"]
        self.unknown = min((s for _, s, _ in model["normal"]), default=0.0) - UNKNOWN_PENALTY
        # neighbouring characters that some piece holds; between others no piece reaches
        self.joined = {t[i:i + 2] for t, _, _ in model["normal"] for i in range(len(t) - 1)}
        self.splits = not any(x[1] == " " != x[0] for x in self.joined)

    def cut(self, text: str) -> int:
        """The last place at which no piece can reach across, or 0."""
        joined = self.joined
        for i in range(len(text) - 1, 0, -1):
            if text[i - 1:i + 1] not in joined:
                return i
        return 0

    def best_path(self, text: str) -> tuple[int, ...]:
        go, fail, ends, unknown = self.go, self.fail, self.ends, self.unknown
        best, back = [0.0], [None]
        node = 0
        for c in text:
            nxt = go[node].get(c)
            while nxt is None and node:
                node = fail[node]
                nxt = go[node].get(c)
            node = nxt or 0
            top, via = best[-1] + unknown, None
            for p in ends[node]:
                s = best[-p[0]] + p[1]
                if s > top:
                    top, via = s, p
            best.append(top)
            back.append(via)
        ids, i = [], len(text)
        while i:
            via = back[i]
            if via is None:
                i -= 1
                ids.extend([self.bytes[b] for b in reversed(text[i].encode())])
            else:
                ids.append(via[2])
                i -= via[0]
        return tuple(reversed(ids))


class _Memory(dict):
    """Paths of the units met so far, up to a bound."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, unit: str) -> tuple[int, ...]:
        if len(unit) > LONGEST_REMEMBERED:
            return self.automaton.best_path(unit)
        at = self.automaton.cut(unit)
        path = self[unit[:at]] + self[unit[at:]] if at else self.automaton.best_path(unit)
        if len(self) >= REMEMBERED:
            self.clear()
        self[unit] = path
        return path


class Codec:
    def __init__(self, model: dict):
        self.automaton = Automaton(model)
        self.memory = _Memory(self.automaton)
        self.spelled = model["spelled"]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text, which is read with one space before it."""
        if not text:
            return []
        units = _UNIT.findall(" " + text) if self.automaton.splits else [" " + text]
        return list(chain.from_iterable(map(self.memory.__getitem__, units)))

    def decode(self, ids) -> str:
        return b"".join(map(self.spelled.__getitem__, ids))[1:].decode("utf-8", "replace")


_CODECS: dict[int, Codec] = {}


def _codec(model) -> Codec:
    """One codec for each broadcast model in a worker."""
    key = model._jbroadcast.id() if getattr(model, "_jbroadcast", None) else id(model.value)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model.value)
    return _CODECS[key]


def _lists(rows: list[list[int]]) -> pa.Array:
    sizes = np.fromiter(map(len, rows), np.int32, len(rows))
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(sizes.sum()))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                                    pa.array(flat))


def encode(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of every row: round_trip says that decoding
    the ids gave the text again."""
    model = docs.sparkSession.sparkContext.broadcast(load(model_path))   # one vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for b in tokens.chunks(batches):
            texts = b.column(1).to_pylist()
            ids = [codec.encode(t) for t in texts]
            same = [codec.decode(x) == (t or "") for x, t in zip(ids, texts)]
            yield pa.record_batch([b.column(0), pa.array([len(x) for x in ids], pa.int32()),
                                   _lists(ids), pa.array(same)],
                                  names=["doc_id", "n_tokens", "ids", "round_trip"])
        codec.memory.clear()      # the worker lives on with other work

    return documents(docs).mapInArrow(
        run, "doc_id long, n_tokens int, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model_path: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows with ``ids``; null ids give an empty text."""
    model = encoded.sparkSession.sparkContext.broadcast(load(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for b in batches:
            texts = [codec.decode(x or ()) for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(texts, pa.string())],
                                  names=["doc_id", "text"])

    return encoded.selectExpr("cast(doc_id as long) doc_id", "ids") \
        .mapInArrow(run, "doc_id long, text string")
