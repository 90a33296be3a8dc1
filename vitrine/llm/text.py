"""Whole texts as flat byte arrays: words, word hashes and rolling hashes, without a Python loop per character.

Everything works on UTF-8 bytes. Word classes here are ASCII sets, so a byte of 0x80 and above always belongs to a word
and no character is ever split. Hashes are 64 bit; they depend on the text and fixed seeds alone, never on the task, so
that a retried task gives the same values.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_rng = np.random.default_rng(20240229)
#: A random odd value for each byte, and for each place in a word.
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE_VALUES = _rng.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ORDER_VALUES = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 15

#: Bytes that end a word: white space, or all ASCII but letters and digits.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 bit values over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Texts:
    """Texts one after the other: ``buf[start[i]:end[i]]`` is text i."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.start[i] : self.end[i]].tobytes()


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The bytes of an Arrow string column, without copying them; NULL is the empty text."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if not len(array):
        return Texts(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))
    large = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return Texts(buf, at[:-1] - at[0], at[1:] - at[0])


#: What tasks leave in their worker for later tasks of the same kind, by the name of the kind.
kept: dict[str, object] = {}

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):  # another C library than GNU's
    _trim = None


def give_back() -> None:
    """Returns to the system what Arrow's pool and the C library, which has NumPy's arrays, keep of what was freed."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def returning(batches: Iterator[pa.RecordBatch], keeps: str | None = None) -> Iterator[pa.RecordBatch]:
    """The same batches. What is kept of earlier ones goes back to the system after every 8 MB and at the end, and at the
    beginning all that tasks of another kind than ``keeps`` have left in ``kept``.

    Spark's Python workers live on after a task. Each would be left with the room of its largest batches and of the arrays
    made of them, beside an executor whose other tasks need it.
    """
    for name in [name for name in kept if name != keeps]:
        del kept[name]
    passed = 0
    for batch in batches:
        passed += batch.nbytes
        if passed >= 1 << 23:
            give_back()
            passed = 0
        yield batch
        del batch
    give_back()


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", at_most: int = 1 << 20, keeps: str | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``at_most`` bytes of text; a longer text comes alone."""
    for batch in returning(batches, keeps):
        if not batch.num_rows:
            continue
        sizes = np.maximum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), 0)
        cut = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // at_most)) + 1
        for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


@dataclass
class Words:
    """Words of texts: byte places, hash, and for each text the range of its words."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first)), self.last - self.first)


def words_of(texts: Texts, ends: np.ndarray = SPACE, lower: bool = False) -> Words:
    """All words of all texts. A word never goes on into the next text."""
    buf = LOWER[texts.buf] if lower else texts.buf
    if not len(buf):
        none = np.zeros(0, np.int64)
        zero = np.zeros(len(texts), np.int64)
        return Words(none, none, np.zeros(0, np.uint64), zero, zero)
    inside = ~ends[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = texts.start[texts.start < texts.end]
    begins[at] = inside[at]
    start = np.flatnonzero(begins)
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    at = texts.end[texts.start < texts.end] - 1
    stops[at] = inside[at]
    end = np.flatnonzero(stops) + 1
    if len(start):
        place = np.arange(len(buf)) - np.maximum.accumulate(np.where(begins, np.arange(len(buf)), 0))
        value = np.where(inside, BYTE_VALUES[buf], np.uint64(0)) * PLACE_VALUES[place & 4095]
        if len(place) > 4096 and int((end - start).max()) > 4096:
            value *= (2 * (place >> 12) + 1).astype(np.uint64)
        hashes = mix(np.add.reduceat(value, start))
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(start, end, hashes, np.searchsorted(start, texts.start), np.searchsorted(start, texts.end))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``size`` words from each word on, and whether they lie in one text."""
    n = len(words.hash)
    inside = np.arange(n) + size <= np.repeat(words.last, words.last - words.first)
    total = np.zeros(n, np.uint64)
    for j in range(min(size, n)):
        total[: n - j] += words.hash[j:] * ORDER_VALUES[j]
    return mix(total), inside


_powers: dict[int, np.ndarray] = {}


def _power(base: int) -> np.ndarray:
    if base not in _powers:
        _powers[base] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(_BLOCK + 4096, base, np.uint64)]))
    return _powers[base]


def rolling(buf: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each byte on, worked off in blocks that stay in the CPU's cache."""
    n = len(buf) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _power(_BASE), _power(pow(_BASE, -1, 1 << 64))
    out = np.empty(n, np.uint64)
    sums = np.zeros(_BLOCK + size + 1, np.uint64)
    for s in range(0, n, _BLOCK):
        m = min(_BLOCK, n - s)
        values = BYTE_VALUES[buf[s : s + m + size]]
        np.cumsum(values * up[: len(values)], out=sums[1 : len(values) + 1])
        out[s : s + m] = mix((sums[size : size + m] - sums[:m]) * down[:m])
    return out


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or largest of the ``width`` values from each place on, by doubling."""
    done, have = values, 1
    while have * 2 <= width:
        done = pick(done[:-have], done[have:])
        have *= 2
    return pick(done[: len(values) - width + 1], done[width - have : width - have + len(values) - width + 1]) if have < width else done


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]
