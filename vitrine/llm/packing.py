"""Packing by minimum bin slack over the histogram of remaining lengths.

A document's tokens are cut at multiples of the window: full pieces fill windows of their own, at most one remaining
piece per document is shorter. Windows for those are filled by minimum bin slack: the longest length left is placed, then
a bitset subset-sum over the counts of all lengths left finds the fill closest to capacity, and walking back through the
bitsets gives the counts of each length. The multiset found is used for as many windows as the counts allow, so the work
depends on the number of different lengths (below the window), not on the number of documents.

Scale: texts are tokenized once, in place; only pieces (a few numbers each) are shuffled. The plan needs a histogram of
at most ``capacity`` entries. Pieces are numbered within their length by a range partitioning on (length, document,
start), so a length that holds a third of all pieces is spread over many tasks. What the driver collects is a row for
each pair of partition and length; as partitions are ranges, that is at most partitions + capacity rows.

Edge cases: a NULL or empty text is the separator alone; repeated rows and ids are packed row by row, rows with a NULL id
like others; ids of any type are given back as they are; an empty table packs nothing; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.storage import settled
from vitrine.llm.text import BYTE_VALUES, PLACE_VALUES, Texts, kept, mix, returning, slices, texts_of

PIECES = "start long, length long, ids_crc32 long, doc_tokens long"
#: Units of text whose ids a worker remembers, at most.
REMEMBERED = 400_000


_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!#$%&*+,-./:;<=>?@|")] = True
#: A text that any unit may follow: what a unit's first characters look like decides which.
_AFTER_LETTER, _AFTER_LINE = b" a", b" a\n"


class Units:
    """Token ids of whole texts, from the ids of units that repeat.

    A unit begins at a blank before a visible ASCII character; at a blank between a visible ASCII character and a
    multi-byte one; at a mark after an ASCII letter; and behind a single line end between visible ASCII characters. Spellings
    of added tokens are taken out first; what stands between them is encoded like whole texts. The byte-level pattern never puts characters on both sides of such a place into one token, nor does it look across, so that
    the ids of a text are those of its units, one after the other.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # An added token is one id wherever a text spells it, and a text's end to what stands before it.
        added = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = added
        self.spelled = re.compile(b"|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        # A byte-level token has a character for each byte that it stands for.
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())], np.int64)
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.bounds = np.zeros(1 << 16, np.int64)

    def _append(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        known = len(self.place)
        used = int(self.bounds[known])
        while used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while known + len(sizes) >= len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        self.ids[used : used + len(ids)] = ids
        self.bounds[known + 1 : known + 1 + len(sizes)] = used + np.cumsum(sizes)

    def learn(self, units: list[bytes]) -> None:
        """Ids of new units, as parts of longer texts that are cut only where texts are."""
        parts: list[bytes] = []
        mine: list[bool] = []
        joined: list[bytes] = []
        alone: list[bytes] = []
        for u in units:
            first, second = u[0], u[1] if len(u) > 1 else 0
            if first == 0x20 and 0x20 < second < 0x7F:
                before = b""
            elif (first == 0x20 and second >= 0x80) or _MARK[first]:
                before = _AFTER_LETTER
            elif 0x20 < first < 0x7F:
                before = _AFTER_LINE
            else:
                alone.append(u)
                continue
            parts += [before, u]
            mine += [False, True]
            joined.append(u)
        if joined:
            texts = [b"".join(parts[i : i + 400]).decode() for i in range(0, len(parts), 400)]
            ids = np.concatenate([np.array(x.ids, np.int64) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            start = np.cumsum(self.bytes_of[ids]) - self.bytes_of[ids]
            part = np.searchsorted(np.cumsum([len(x) for x in parts]), start, side="right")
            own = np.array(mine)
            self._append(ids[own[part]].astype(np.uint32), np.bincount(part, minlength=len(parts))[own])
            self.place.update(zip(joined, range(len(self.place), len(self.place) + len(joined)), strict=True))
        for u in alone:
            ids = self.tokenizer.encode(u.decode(), add_special_tokens=False).ids
            self._append(np.array(ids, np.uint32), np.array([len(ids)]))
            self.place[u] = len(self.place)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts one after the other, and where each text's ids end."""
        if self.spelled is None or not self.spelled.search(texts.buf):
            return self.encode_plain(texts)
        parts: list[bytes] = []
        after: list[int] = []  # the added token behind a part, or -1 at the end of a text
        for i in range(len(texts)):
            whole, low = texts.bytes_of(i), 0
            for found in self.spelled.finditer(whole):
                parts.append(whole[low : found.start()])
                after.append(self.added[found.group()])
                low = found.end()
            parts.append(whole[low:])
            after.append(-1)
        ends = np.cumsum([len(x) for x in parts])
        ids, at = self.encode_plain(Texts(np.frombuffer(b"".join(parts), np.uint8), np.append(0, ends[:-1]), ends))
        token = np.array(after)
        between = token >= 0
        ids = np.insert(ids, at[between], token[between].astype(np.uint32))
        return ids, (at + np.cumsum(between))[~between]

    def encode_plain(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts that spell no added token."""
        buf = texts.buf
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        visible = (buf > 0x20) & (buf < 0x7F)
        cut = np.zeros(len(buf), bool)
        cut[1:-1] = (buf[1:-1] == 0x20) & (visible[2:] | (visible[:-2] & (buf[2:] >= 0x80)))
        cut[texts.end[texts.start < texts.end] - 1] = False  # what follows is another text
        cut[1:] |= _MARK[buf[1:]] & _LETTER[buf[:-1]]
        cut[2:] |= visible[2:] & (buf[1:-1] == 0x0A) & visible[:-2]
        cut[texts.start[texts.start < texts.end]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(buf))
        place = np.arange(len(buf)) - np.repeat(start, end - start)
        value = BYTE_VALUES[buf] * PLACE_VALUES[place & 4095]
        if int((end - start).max()) > 4096:
            value *= (2 * (place >> 12) + 1).astype(np.uint64)
        hashes = mix(np.add.reduceat(value, start)) + (end - start).astype(np.uint64)
        _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        whole = buf.tobytes()
        keys = [whole[a:b] for a, b in zip(start[one].tolist(), end[one].tolist(), strict=True)]
        if len(self.place) + len(keys) > REMEMBERED:
            self.forget()
        self.learn([k for k in keys if k not in self.place])
        at = np.fromiter((self.place[k] for k in keys), np.int64, len(keys))
        low, size = self.bounds[at][which], (self.bounds[at + 1] - self.bounds[at])[which]
        total = np.cumsum(size)
        ids = self.ids[np.repeat(low - (total - size), size) + np.arange(total[-1])]
        units = np.searchsorted(start, texts.end)
        return ids, np.concatenate([[0], total])[units]


def cut_pieces(path: str, capacity: int, separator: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in kept:
            kept[path] = Units(path)
        units = kept[path]
        for batch in slices(batches, keeps=path):
            ids, ends = units.encode(texts_of(batch.column("text")))
            doc, start, length, crc, whole = [], [], [], [], []
            low = 0
            for i, high in enumerate(ends.tolist()):
                own = np.append(ids[low:high], np.uint32(separator)).astype("<u4")
                low = high
                for at in range(0, len(own), capacity):
                    piece = own[at : at + capacity]
                    doc.append(i)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    whole.append(len(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(doc, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, whole))],
                ["doc", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return cut


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Counts of lengths, within ``counts``, whose sum is as close to ``capacity`` as any can be."""
    reach, steps = 1, []
    mask = (1 << (capacity + 1)) - 1
    for length in sorted(counts, reverse=True):
        left, take = min(counts[length], capacity // length if length else 0), 1
        while left > 0:  # the count in parts of 1, 2, 4 ... and a rest: every number up to it is a sum of parts
            part = min(take, left)
            steps.append((length, part, reach))
            reach |= (reach << (length * part)) & mask
            left -= part
            take *= 2
        if reach >> capacity & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, part, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + part
            at -= length * part
    return used


def plan_windows(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Multisets of lengths, each with the number of windows that it fills."""
    left = {n: c for n, c in histogram.items() if 0 < n < capacity and c}
    plan = []
    while left:
        longest = max(left)
        rest = {n: c - (n == longest) for n, c in left.items() if c - (n == longest) > 0 and n <= capacity - longest}
        used = best_fill(rest, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[n] // k for n, k in used.items())
        plan.append((used, times))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return plan


def place_pieces(offsets: dict[tuple[int, int], int], plan: list[tuple[dict[int, int], int]], first: int, capacity: int):
    """Gives every piece its window and place there, from its number among the pieces of its length."""
    segments: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = first
    for used, times in plan:
        at = 0
        for n in sorted(used, reverse=True):
            segments.setdefault(n, []).append((taken.get(n, 0), used[n], sequence, at))
            taken[n] = taken.get(n, 0) + used[n] * times
            at += n * used[n]
        sequence += times
    tables = {n: np.array(s, np.int64) for n, s in segments.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}
        for batch in returning(batches):
            n = batch.num_rows
            length = batch.column("length").to_numpy()
            part = batch.column("part").to_numpy()
            key = part * (capacity + 1) + length
            order = np.argsort(key, kind="stable")
            groups, at, size = np.unique(key[order], return_index=True, return_counts=True)
            number = np.empty(n, np.int64)
            for g, a, c in zip(groups.tolist(), at.tolist(), size.tolist(), strict=True):
                p = divmod(g, capacity + 1)
                number[order[a : a + c]] = offsets[p] + seen.get(p, 0) + np.arange(c)
                seen[p] = seen.get(p, 0) + c
            sequence, offset = number.copy(), np.zeros(n, np.int64)
            for g in np.unique(length).tolist():
                if g == capacity:
                    continue
                own = np.flatnonzero(length == g)
                t = tables[g][np.searchsorted(tables[g][:, 0], number[own], side="right") - 1]
                copy, slot = np.divmod(number[own] - t[:, 0], t[:, 1])
                sequence[own], offset[own] = t[:, 2] + copy, t[:, 3] + slot * g
            columns = [c for c in batch.schema.names if c != "part"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    return place


def pack(documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 1024, separator: int = 0) -> DataFrame:
    """A row for each piece: document, start, length, ids_crc32, doc_tokens, sequence_id and offset."""
    rows = documents.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, {PIECES}"
    pieces = settled(rows.mapInArrow(cut_pieces(tokenizer, capacity, separator), schema))
    spark = documents.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = settled(
        pieces.repartitionByRange(partitions, "length", "doc", "start").sortWithinPartitions("length", "doc", "start", "ids_crc32").withColumn("part", F.spark_partition_id().cast("long"))
    )
    offsets: dict[tuple[int, int], int] = {}
    histogram: dict[int, int] = {}
    for part, length, n in sorted(map(tuple, numbered.groupBy("part", "length").agg(F.count("*")).collect())):
        offsets[part, length] = histogram.get(length, 0)
        histogram[length] = histogram.get(length, 0) + n
    placed = numbered.mapInArrow(place_pieces(offsets, plan_windows(histogram, capacity), histogram.get(capacity, 0), capacity), f"{schema}, sequence_id long, offset long")
    return placed.withColumnRenamed("doc", doc_id)
