"""Array kernels that run inside Spark tasks: byte names, words, shingles.

Every function takes the texts of a small block of rows as one byte buffer
with row offsets, so a task works on a few megabytes at a time whatever
the size of its partition. All hashes are fixed functions of the bytes;
no state is kept between blocks.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

try:
    _LIBC = ctypes.CDLL(None)
except OSError:
    _LIBC = None
KEPT: list[Callable[[], None]] = []  # let go of what an operator keeps in a worker between its tasks
U64 = np.uint64
BLOCK_BYTES = 1 << 20  # bytes of text handled at once; a longer text forms its own block
_M1, _M2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_C1, _C2, _C3 = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> U64(33))) * _M1
    x = (x ^ (x >> U64(33))) * _M2
    return x ^ (x >> U64(33))


def pair_name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of an ordered pair of names."""
    return mix(a * _C1 + (b ^ (b >> U64(29))) * _C2 + _C3)


def give_back() -> None:
    """Return freed memory to the system: workers live on between tasks, and
    what one task has freed would add to what the next one takes."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_blocks(column, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets) of consecutive rows of an
    Arrow string column; null texts are empty. What other operators keep in
    the worker goes."""
    for let_go in KEPT:
        let_go()
    column = pa.chunked_array([column]) if isinstance(column, pa.Array) else column
    base = 0
    for chunk in column.chunks:
        chunk = chunk.cast(pa.large_binary()) if not pa.types.is_large_binary(chunk.type) else chunk
        if chunk.null_count:
            chunk = chunk.fill_null(b"")
        n = len(chunk)
        _, off, data = chunk.buffers()
        offsets = np.frombuffer(off, np.int64)[chunk.offset : chunk.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1)
            j = min(j, n)
            yield base + i, base + j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            i = j
        base += n
    give_back()


def names(raw: np.ndarray, length: int) -> np.ndarray:
    """Name of the ``length`` bytes at each position, by doubling: the name
    of 2L bytes is the name of the pair (name at p, name at p + L)."""
    n = len(raw) - length + 1
    if n <= 0:
        return np.zeros(0, U64)
    name, have = mix(raw.astype(U64) + _C3), 1
    while have < length:
        step = min(have, length - have)
        name = pair_name(name[: len(name) - step], name[step:])
        have += step
    return name


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive values (van Herk's block scheme)."""
    n = len(x)
    if n < w:
        return x[:0]
    full = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    full[:n] = x
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a block of rows.

    ``start`` and ``end`` are byte positions in the block, ``row`` the row
    of each word, ``first`` the first word of each row (length rows + 1)."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = True):
        self.raw = _LOWER[raw] if lower else raw
        solid = ~_WHITE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        begins = solid.copy()
        begins[1:] &= ~solid[:-1] | edge[1:-1]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:] | edge[1:-1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.rows = len(offsets) - 1
        self.row = np.repeat(np.arange(self.rows), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word."""
        n = len(self.raw)
        if not n:
            return np.zeros(0, U64)
        power = np.full(n + 1, _C1, U64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        total = np.zeros(n + 1, U64)
        np.cumsum((self.raw.astype(U64) + U64(1)) * power[:-1], out=total[1:])
        # shifting to the block's end keeps the value free of the position
        value = (total[self.end] - total[self.start]) * power[n - self.start]
        back = np.full(1, pow(int(_C1), -1, 1 << 64), U64)
        scale = np.uint64(pow(int(back[0]), n, 1 << 64))
        return mix(value * scale + (self.end - self.start).astype(U64) * _C2)


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct ``size``-word shingles of each row,
    sorted by row and hash. A row of fewer words has its whole sequence as
    one shingle; a row without words has none."""
    h = words.hashes()
    count = np.diff(words.first)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    value, have = h, 1
    at = np.arange(len(h))
    for step in range(1, size):
        nxt = np.zeros_like(h)
        nxt[:-step] = h[step:]
        value = pair_name(value, nxt) if step == 1 else pair_name(value, nxt + U64(step))
        have += 1
    last = words.first[1:][words.row] - size
    keep = at <= last
    row, out = words.row[keep], value[keep]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        extra = np.empty(len(short), U64)
        for i, r in enumerate(short):
            acc = np.array([count[r]], U64) * _C3
            for x in h[words.first[r] : words.first[r + 1]]:
                acc = pair_name(acc, np.array([x], U64))
            extra[i] = acc[0]
        row, out = np.concatenate([row, short]), np.concatenate([out, extra])
    order = np.lexsort((out, row))
    row, out = row[order], out[order]
    new = np.ones(len(out), bool)
    new[1:] = (row[1:] != row[:-1]) | (out[1:] != out[:-1])
    return row[new], out[new]
