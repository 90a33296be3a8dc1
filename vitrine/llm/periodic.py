"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of words with smallest period q, at least ``least`` words and ``repeats`` (3) periods long, that cannot
be made longer on either side. ``collapse`` keeps the first period of each run.

1. The words of a text get numbers, and numbers get random residues modulo a prime.
2. At scale B = 8, 16, 32, ... the texts are cut into aligned blocks of B words. A run with a period of B to 2B - 1 has such a
   block within its words but the last period, and the block occurs again one period on. So for each block and each distance
   of that range the sum of squared differences to the words at that distance is wanted: two sums of squares less twice a
   convolution, for all distances at once by an exact number-theoretic transform. Where the sum is 0 the block occurs.
   The first scale looks at distances 1 to 15. From B = 8,192 on blocks stay at 4,096 words and the distances come in pieces.
3. Distances with a zero are seeds, smallest first. Seeds that lie in a known run whose period divides the distance
   are its repetitions and go (the stretch has the smaller period as a whole). Of the others each is extended
   word by word to both sides, which also exposes sums that are 0 only modulo the prime.

The transform is exact: residues are below 2**20, sums of up to 64 of their products fit in the 53 bits of a double, so
each of its factors (at most 64 long) is one matrix product.

Scale: a text is worked off by one task, in time n log(n)**2 and memory in proportion to it; texts are never shuffled.
Texts of a batch share the transforms, longest first, so that short ones take part in the small scales only.

Edge cases: NULL, empty and blank texts have no words and no runs; their collapsed text is empty. Repeated rows are found
alike, tables without rows give none. Columns named in ``carry`` stay beside the result; others, whatever their names, are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.text import mix, slices

PRIME = 786_433  # 3 * 2**18 + 1
ROOT = 10  # generates all residues but 0
FIRST = 8
LARGEST = 4_096
RUNS = "array<struct<start: long, length: long, period: long>>"


def _reduced(x: np.ndarray) -> np.ndarray:
    """Residues between about -PRIME / 2 and PRIME / 2 of whole numbers held as doubles."""
    x -= np.rint(x * (1 / PRIME)) * PRIME
    return x


@lru_cache
def _powers(size: int, inverse: bool) -> np.ndarray:
    """All powers of a root of unity of order ``size``."""
    root = pow(ROOT, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, -1, PRIME)
    out = np.ones(size, np.int64)
    for i in range(1, size):
        out[i] = out[i - 1] * root % PRIME
    return out


@lru_cache
def _factors(size: int, inverse: bool) -> tuple[int, np.ndarray, np.ndarray]:
    """First factor of a transform's size, the matrix of its transform, and the twiddles between it and the rest."""
    first = size if size <= 64 else min(64, 1 << (size.bit_length() // 2))
    powers, rest = _powers(size, inverse), size // first
    matrix = powers[np.outer(np.arange(first), np.arange(first)) * rest % size]
    twiddle = powers[np.outer(np.arange(rest), np.arange(first)) % size]
    return first, matrix.astype(float), _reduced(twiddle.astype(float))


def ntt(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Transform modulo PRIME of each row; the inverse is not divided by the size."""
    rows, size = x.shape
    first, matrix, twiddle = _factors(size, inverse)
    rest = size // first
    # the factor's matrix is symmetric: one product for all columns of all rows
    y = _reduced(x.reshape(rows, first, rest).transpose(0, 2, 1).reshape(rows * rest, first) @ matrix)
    if rest == 1:
        return y
    y = _reduced(y.reshape(rows, rest, first) * twiddle)
    y = ntt(np.ascontiguousarray(y.transpose(0, 2, 1)).reshape(rows * first, rest), inverse)
    return y.reshape(rows, first, rest).transpose(0, 2, 1).reshape(rows, size)


class Blocks:
    """Transforms and sums of squares of the aligned blocks of ``size`` words."""

    def __init__(self, values: np.ndarray, size: int):
        self.size = size
        count = -(-len(values) // size) + 2
        padded = np.zeros(count * size)
        padded[: len(values)] = values
        self.transforms = np.empty((count, 2 * size))
        per = max(1, (1 << 18) // size)
        for a in range(0, count, per):
            part = padded[a * size : (a + per) * size].reshape(-1, size)
            self.transforms[a : a + per] = ntt(np.concatenate([part, np.zeros_like(part)], 1))
        squares = _reduced(values * values)
        self.squares = np.zeros((count + 1) * size + 1)
        self.squares[1 : len(values) + 1] = np.cumsum(squares)
        self.squares[len(values) + 1 :] = self.squares[len(values)]
        self.sign = np.where(np.arange(2 * size) % 2, -1.0, 1.0)
        self.back = (-np.arange(2 * size)) % (2 * size)

    def zeros(self, every: int, shift: int, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks from multiples of ``every`` on in the first ``words`` and the distances, ``shift`` to ``shift + size - 1``, of their occurrences."""
        size, ahead = self.size, shift // self.size
        last = min(words // size, len(self.transforms) - ahead - 2)
        blocks = np.arange(0, last + 1, every // size)
        scale = pow(2 * size, -1, PRIME)
        per = max(1, (1 << 18) // size)
        for a in range(0, len(blocks), per):
            at = blocks[a : a + per]
            window = self.transforms[at + ahead] + self.sign * self.transforms[at + ahead + 1]
            both = ntt(_reduced(self.transforms[at][:, self.back] * _reduced(window)), inverse=True)[:, :size]
            both = _reduced(both * scale)
            start = at[:, None] * size
            place = start + shift + np.arange(size)[None, :]
            own = self.squares[start + size] - self.squares[start]
            there = self.squares[place + size] - self.squares[place]
            row, distance = np.nonzero(_reduced(own + there - 2 * both) == 0)
            yield at[row] * size, distance + shift


def _matches(ids: np.ndarray, start: int, distance: int) -> tuple[int, int]:
    """The words from which on, and up to which, each equals that at a distance, around the word ``start`` (that may not)."""
    low, step = start, 64
    while low > 0:
        a = max(0, low - step)
        wrong = np.flatnonzero(ids[a:low] != ids[a + distance : low + distance])
        if len(wrong):
            low = a + int(wrong[-1]) + 1
            break
        low, step = a, step * 2
    high, step = start, 64
    end = len(ids) - distance
    while high < end:
        b = min(end, high + step)
        wrong = np.flatnonzero(ids[high:b] != ids[high + distance : b + distance])
        if len(wrong):
            high += int(wrong[0])
            break
        high, step = b, step * 2
    return low, high


def _likely(ids: np.ndarray, start: np.ndarray, distance: np.ndarray, size: int) -> np.ndarray:
    """Seeds around which a stretch of two periods of matches is possible: half a block more on one side, by a few probes."""
    n = len(ids)

    def match(at: np.ndarray) -> np.ndarray:
        inside = (at >= 0) & (at + distance < n)
        at = np.where(inside, at, 0)
        return inside & (ids[at] == ids[np.where(inside, at + distance, 0)])

    left, right, own = np.ones(len(start), bool), np.ones(len(start), bool), np.ones(len(start), bool)
    for step in (1, size // 4, size // 2):
        left &= match(start - step)
        right &= match(start + size - 1 + step)
    for step in (0, size // 2, size - 1):
        own &= match(start + step)
    return own & (left | right)


def _without_repetitions(start: np.ndarray, distance: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Seeds, sorted by start, that no run of a smaller period dividing the distance covers for a whole distance."""
    keep = np.ones(len(start), bool)
    for begin, length, period in runs:
        a, b = np.searchsorted(start, [begin, begin + length])
        if a < b:
            d = distance[a:b]
            keep[a:b] &= (d % period != 0) | (d == period) | (start[a:b] + d > begin + length)
    return keep


def runs_of(ids: np.ndarray, lengths: np.ndarray, least: int = 24, repeats: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in texts one after the other, longest first, each followed by a word of its own.

    ``lengths`` counts that last word, which no text shares, so that no run goes past it.
    """
    rng = mix(ids.astype(np.uint64) + np.uint64(0x51ED270B0A1B2C3D))
    values = _reduced((rng % np.uint64(PRIME)).astype(float))
    ends = np.cumsum(lengths)
    runs: list[tuple[int, int, int]] = []
    scale = FIRST
    while True:
        taking = int(np.searchsorted(-lengths, -(repeats * (scale if scale > FIRST else 1)), side="right"))
        size = int(ends[taking - 1]) if taking else 0
        if size < least:
            return runs
        here = ids[:size]
        block = min(scale, LARGEST)
        if scale <= LARGEST:  # larger scales use the blocks of this one
            blocks = Blocks(values[:size], block)
        shifts = range(scale, 2 * scale, block) if scale > FIRST else (0, FIRST)
        for shift in shifts:
            found = [(s, d) for s, d in blocks.zeros(scale, shift, size)]
            start = np.concatenate([s for s, _ in found]) if found else np.zeros(0, np.int64)
            distance = np.concatenate([d for _, d in found]) if found else np.zeros(0, np.int64)
            inside = (distance > 0) & (start + block + distance <= size)
            start, distance = start[inside], distance[inside]
            good = _likely(here, start, distance, block)
            start, distance = start[good], distance[good]
            good = _without_repetitions(start, distance, runs)
            start, distance = start[good], distance[good]
            order = np.argsort(distance, kind="stable")
            start, distance = start[order], distance[order]
            for seeds in np.split(start, np.flatnonzero(np.diff(distance)) + 1) if len(start) else ():
                d = int(distance[0])
                distance = distance[len(seeds) :]
                if scale == FIRST:
                    seeds = seeds[_without_repetitions(seeds, np.full(len(seeds), d), runs)]
                done = -1
                for s in seeds.tolist():
                    if s < done:
                        continue
                    low, high = _matches(here, s, d)
                    done = max(high, s + 1)
                    length = high - low + d
                    if high >= s + block and length >= max(least, repeats * d):
                        runs.append((low, length, d))
        scale *= 2


def _found(words: list[list[bytes]], least: int, repeats: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text of a batch, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    order = sorted((i for i in range(len(words)) if len(words[i]) >= least), key=lambda i: -len(words[i]))
    if not order:
        return out
    known: dict[bytes, int] = {}
    lengths = np.array([len(words[i]) + 1 for i in order])
    ids = np.empty(int(lengths.sum()), np.int64)
    at = 0
    for number, i in enumerate(order):
        ids[at : at + len(words[i])] = [known.setdefault(w, len(known)) for w in words[i]]
        at += len(words[i])
        ids[at] = -1 - number
        at += 1
    begins = np.cumsum(lengths) - lengths
    for start, length, period in runs_of(ids, lengths, least, repeats):
        text = int(np.searchsorted(begins, start, side="right")) - 1
        out[order[text]].append((start - int(begins[text]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def periodic_runs(documents: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), least: int = 24, repeats: int = 3) -> DataFrame:
    """``carry`` columns with n_words, runs (by start, then period) and collapsed, the text without all but their first periods.

    Words are cut at ASCII white space and numbered from 0; collapsed has single blanks between words.
    """
    if repeats < 3 or least < 3 * FIRST:
        raise ValueError("blocks find runs of three periods and 24 words or more")
    names = {c: f"_carry{i}" for i, c in enumerate(carry)}
    rows = documents.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([*(f for f in rows.schema if f.name != "text"), *T.StructType.fromDDL(f"n_words long, runs {RUNS}, collapsed string")])
    shape = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            # bytes.split() cuts at exactly the six white space characters of ASCII
            words = [(t.as_buffer().to_pybytes() if t.is_valid else b"").split() for t in batch.column("text")]
            found = _found(words, least, repeats)
            made = [pa.array([len(w) for w in words], pa.int64()), pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found], shape)]
            text = pa.array([_collapsed(w, r) for w, r in zip(words, found, strict=True)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names.values()), *made, text], schema.names)

    return rows.mapInArrow(run, schema).select(*(F.col(n).alias(c) for c, n in names.items()), "n_words", "runs", "collapsed")


def repeating(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents of which every tenth, by the CRC-32 h of its id, repeats itself from a word on.

    With n words and g = floor(h / 10) each word i from a = g % n on becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    ready = documents.select(doc_id, text, h.alias("_h")).withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    n, g = F.size("_words"), F.floor(F.col("_h") / 10)
    first = (g % n).cast("int")
    period = F.lit(1) + F.floor((n - first) / (3 + g % 8)).cast("int")
    ready = ready.withColumns({"_first": F.when(n > 0, first), "_period": F.when(n > 0, period)})
    a, p = F.col("_first"), F.col("_period")
    repeated = F.transform("_words", lambda w, i: F.when(i < a, w).otherwise(F.element_at("_words", a + F.pmod(i - a, p) + 1)))
    return ready.select(doc_id, F.when(a.isNotNull(), F.array_join(repeated, " ")).otherwise(F.col(text)).alias(text))


def _longest(runs: Column) -> Column:
    """The run of the greatest length per period, exactly; the first of equal ones."""
    return F.aggregate(
        runs,
        F.lit(None).cast("struct<start: long, length: long, period: long>"),
        lambda best, r: F.when(best.isNull() | (r.length * best.period > best.length * r.period), r).otherwise(best),
    )


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per document the number of runs, its most repeated one, and hashes of all runs and of the collapsed text."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    top = found.withColumn("_top", _longest(F.col("runs")))
    best = F.col("_top")
    return top.select(
        doc_id,
        F.size("runs").cast("long").alias("n_runs"),
        best.start.alias("start"),
        best.length.alias("length"),
        best.period.alias("period"),
        F.floor(best.length * 1000 / best.period).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
