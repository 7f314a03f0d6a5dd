"""Words and rolling hashes of Arrow text columns, vectorised with numpy.

All hashes are functions of the bytes alone (fixed tables), so every executor
and every retry computes the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
CHUNK_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection that spreads every input bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            m = max(n, 1 << 16)
            self.up, self.down = (np.concatenate([np.ones(1, _U), np.cumprod(np.full(m - 1, b, _U))])
                                  for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_IN_WORD = Powers(0xD6E8FEB86659FD93)
# independent bases for n-gram hashes; two of them give 128-bit identities
_GRAM = [Powers(0xA0761D6478BD642F), Powers(0xE7037ED1A0B428DB)]

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
# word separators of normalised tokens: white space, controls and ASCII punctuation
_PUNCT = WHITE.copy()
_PUNCT[[c for c in range(128) if not chr(c).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# scripts written without spaces between words: each character is a normalised token
UNSPACED = [(0x0E00, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3005, 0x3007),
            (0x3031, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF),
            (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF)]
# their spaces and punctuation separate like those of ASCII
WIDE_PUNCT = [(0x3000, 0x3004), (0x3008, 0x3030), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20),
              (0xFF3B, 0xFF40), (0xFF5B, 0xFF65)]


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the n + 1 row offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def _within(code: np.ndarray, ranges: list) -> np.ndarray:
    flat = np.array(ranges).ravel()
    flat[1::2] += 1
    return np.searchsorted(flat, code, "right") % 2 == 1


def _unspaced(data: np.ndarray, inside: np.ndarray, edge: np.ndarray) -> None:
    """Word edges around each character of unspaced scripts; wide punctuation is outside."""
    for lead, size in ((0xE0, 3), (0xF0, 4)):
        at = np.flatnonzero((data >= lead) & (data < lead + (16 if size == 3 else 8)))
        at = at[at + size <= len(data)]
        if not len(at):
            continue
        code = (data[at] & (0x0F if size == 3 else 0x07)).astype(np.int64)
        for k in range(1, size):
            code = (code << 6) | (data[at + k] & 0x3F)
        alone = at[_within(code, UNSPACED)]
        edge[alone] = edge[alone + size] = True
        wide = at[_within(code, WIDE_PUNCT)]
        for k in range(size):
            inside[wide + k] = False


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches by rows so that the texts of a piece stay near ``limit`` bytes.

    A longer single text forms a piece of its own; texts are never cut.
    """
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(text))), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield b.slice(at, to - at)
            at = to
    # workers live on: give what the texts took back to the machine
    pa.default_memory_pool().release_unused()


class Words:
    """Words of all rows of a text column, in order.

    ``start``/``end``: byte spans; ``row``: the row of each word; ``first``:
    n + 1 offsets of each row's words; ``hash``: 64-bit word hashes.
    ``normal``: case of A-Z and punctuation do not count, and each character of a
    script written without spaces (``UNSPACED``) is a word.
    """

    def __init__(self, col: pa.Array, normal: bool = False):
        data, off = text_buffer(col)
        sep = _PUNCT if normal else WHITE
        inside = ~sep[data]
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        if normal and n and data.max() >= 0xE0:
            _unspaced(data, inside, edge)
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
        self.data = data
        self.start = np.flatnonzero(inside & (~before | edge[:n]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, off)
        self.row = np.repeat(np.arange(len(off) - 1), np.diff(self.first))
        v = _BYTE[_LOWER[data] if normal else data]
        up, down = _IN_WORD.get(n + 1)
        v = v * up[:n]
        total = np.zeros(n + 1, _U)
        np.cumsum(v, out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start])

    def __len__(self) -> int:
        return len(self.start)

    def grams(self, n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of n words within one row, and the index of the first word."""
        return gram_hashes(self.hash, self.row, n, which)


def gram_hashes(words: np.ndarray, row: np.ndarray, n: int,
                which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, _U), np.empty(0, np.int64)
    up, down = _GRAM[which].get(len(words))
    total = np.zeros(len(words) + 1, _U)
    np.cumsum(words * up, out=total[1:])
    at = np.flatnonzero(row[:m] == row[n - 1:])
    return mix((total[at + n] - total[at]) * down[at]), at


def planes(x: np.ndarray, width: int) -> bytes:
    """Little-endian bytes of unsigned numbers, first all lowest bytes, and so on."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(raw: bytes, width: int) -> np.ndarray:
    n = len(raw) // width
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T
    return out.view("<u8").ravel().astype(_U)
