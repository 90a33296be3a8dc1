"""Repeated passages by sorting hashed ranks of half-strings.

A position is repeated when the ``threshold`` bytes from it on also start earlier (smaller document, or same document and
earlier byte). Every byte under a repeated position is removed; all positions are judged on the input. There
are no doubling rounds: the rank of half a threshold is a 64 bit hash, which names equal strings equally in every task without
a shuffle; a longer string's rank is the pair (or triple) of its parts' ranks at their offsets. Spark sorts anchors once by
triple, and the positions still open once by pair.

1. Half the threshold. Of the positions whose window holds a half-string, the one at the window's least rank stands for
   all windows that share it ("anchor"). Equal windows have equal anchors at equal places, so a window whose anchor's
   rank is unique is unique. That is most of a corpus, and it ends here: about one in 26 positions is ever sorted.
2. All bytes under an anchor's windows: the triple of ranks at the first window, half a threshold on, and at the last
   window's second half. Among anchors of one rank, sorted by triple and position, every one but the first of an equal
   triple is a repeat as a whole; if only one triple exists its first position is no repeat. Both end here.
3. What is left (anchors with unlike surroundings, thus the edges of repeats) is opened into positions, which Spark sorts
   by the pair of ranks at offsets 0 and half; the first of equal pairs is no repeat, all others are.

Scale: a third of all rows may share a passage, and then its rank. Tasks fold equal triples and pairs of what they read
before the shuffle, to one row each; a rank of which a task sees more than ``most_votes`` triples sends that many, marked,
and opens the others at once. So a rank has at most ``most_votes`` rows per task and batch, whatever its share of rows.
Sorted streams are worked off with one row of state. Texts are shuffled once, by document, and that exchange is read twice.
Nothing but settings passes through the driver.

Edge cases: NULL and empty texts have no bytes and no repeats. Where ids repeat or are NULL, rows are ordered by id (NULL
last), then text, and each is a document of its own; of equal rows all but one are repeats of the other. Texts below the
threshold are never touched. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.storage import release, settled
from vitrine.llm.text import Texts, mix, returning, rolling, runs, slices, sliding, texts_of

_SEGMENT = 1 << 16
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_VOTE, _MARKED, _REPEAT, _OPEN = range(4)


@dataclass
class Anchors:
    """Anchors of a chunk of texts: place, windows from ``low`` to ``high``, text, and the ranks of all half-strings."""

    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    text: np.ndarray
    rank: np.ndarray

    def triple(self, half: int) -> np.ndarray:
        parts = (self.rank[self.low], self.rank[self.low + half], self.rank[self.high + half], (self.at - self.low).astype(np.uint64), (self.high - self.low).astype(np.uint64))
        return mix(sum((p * c for p, c in zip(parts[1:], _C[1:], strict=True)), parts[0] * _C[0]))


def anchors_of(texts: Texts, threshold: int) -> Anchors:
    half = threshold // 2
    width = threshold - half + 1  # half-strings of a window
    rank = rolling(texts.buf, half)
    none = np.zeros(0, np.int64)
    if len(texts.buf) < threshold:
        return Anchors(none, none, none, none, rank)
    ats, lows, highs = [none], [none], [none]
    n = len(texts.buf) - threshold + 1
    edge = np.zeros(len(texts.buf) + 1, np.int32)  # windows inside one text
    long = texts.end - texts.start >= threshold
    np.add.at(edge, texts.start[long], 1)
    np.add.at(edge, texts.end[long] - threshold + 1, -1)
    valid = np.cumsum(edge)[:n] > 0
    for s in range(0, n, _SEGMENT):
        m = min(_SEGMENT, n - s)
        own = rank[s : s + m + width - 1]
        least = sliding(own, width, np.minimum)
        pad = np.zeros(width - 1, np.uint64)
        chosen = own == sliding(np.concatenate([pad, least, pad]), width, np.maximum)
        place = np.flatnonzero(chosen)
        window = np.flatnonzero(valid[s : s + m])
        k = (np.cumsum(chosen) - chosen)[window]  # first chosen place from the window's start on
        wrong = np.flatnonzero(own[place[k]] != least[window])
        while len(wrong):
            k[wrong] += 1
            wrong = wrong[own[place[k[wrong]]] != least[window[wrong]]]
        if not len(window):
            continue
        at = place[k]
        first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)]))
        ats.append(at[first] + s)
        lows.append(window[first] + s)
        highs.append(window[np.append(first[1:], len(window)) - 1] + s)
    at, low, high = np.concatenate(ats), np.concatenate(lows), np.concatenate(highs)
    if len(at):  # runs that a segment's end has cut
        joint = np.concatenate([[False], (at[1:] == at[:-1]) & (low[1:] == high[:-1] + 1)])
        start = np.flatnonzero(~joint)
        high = high[np.append(start[1:], len(at)) - 1]
        at, low = at[start], low[start]
    return Anchors(at, low, high, np.searchsorted(texts.end, at, side="right"), rank)


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before in any key."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _chunks(batches: Iterator[pa.RecordBatch], columns: list[str], collect, at_most: int) -> Iterator[tuple]:
    """Arrays that ``collect`` makes of small batches, joined until they stand for about ``at_most`` bytes of text."""
    held: list[tuple] = []
    size = 0
    for batch in slices(batches):
        texts = texts_of(batch.column("text"))
        got = collect(batch, texts)
        if got is not None:
            held.append(got)
        size += len(texts.buf)
        if size >= at_most and held:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x)


def _votes(threshold: int, most_votes: int, fold_bytes: int):
    """Round 1 and 2, in the tasks: a row (rank, triple, doc, at, kind) for each anchor."""
    half = threshold // 2

    def collect(batch: pa.RecordBatch, texts: Texts) -> tuple:
        a = anchors_of(texts, threshold)
        doc = batch.column("doc").to_numpy(zero_copy_only=False)
        return a.rank[a.at] if len(a.at) else np.zeros(0, np.uint64), a.triple(half) if len(a.at) else np.zeros(0, np.uint64), doc[a.text], a.at - texts.start[a.text]

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rank, triple, doc, at in _chunks(batches, ["doc", "text"], collect, fold_bytes):
            order = np.lexsort((at, doc, triple, rank))
            rank, triple, doc, at = rank[order], triple[order], doc[order], at[order]
            new_rank = _first_of(rank)
            new = _first_of(rank, triple)
            kind = np.where(new, _VOTE, _REPEAT).astype(np.int64)
            start = np.flatnonzero(new_rank)
            number = np.cumsum(new) - np.repeat(np.cumsum(new)[start], np.diff(np.append(start, len(new))))  # triples before, of the rank
            kind[new & (number >= most_votes)] = _OPEN
            crowded = np.repeat(np.logical_or.reduceat(kind == _OPEN, start), np.diff(np.append(start, len(new)))) if len(start) else new
            kind[crowded & (kind == _VOTE)] = _MARKED
            settled_here = kind >= _REPEAT
            # what is settled needs no meeting: it goes where its position sends it
            rank = np.where(settled_here, mix(doc.astype(np.uint64) * _C[0] + at.astype(np.uint64)), rank)
            yield pa.RecordBatch.from_arrays([_signed(rank), _signed(triple), _signed(doc), _signed(at), _signed(kind)], ["rank", "triple", "doc", "at", "kind"])

    return vote


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round 2 over rows sorted by (rank, triple, doc, at): (doc, code), code being 2 * at, + 1 where left open."""
    last_rank = last_triple = None
    waiting: tuple[int, int] | None = None  # first row of the current rank, while it has but one triple
    for batch in returning(batches):
        rank, triple, doc, at, kind = (batch.column(c).to_numpy() for c in ("rank", "triple", "doc", "at", "kind"))
        known = kind >= _REPEAT
        docs, codes = [doc[known]], [2 * at[known] + (kind[known] == _OPEN)]
        rank, triple, doc, at, marked = (x[~known] for x in (rank, triple, doc, at, kind == _MARKED))
        if len(rank):
            new_rank, new = _first_of(rank), _first_of(rank, triple)
            new_rank[0] = last_rank is None or rank[0] != last_rank
            new[0] = new_rank[0] or triple[0] != last_triple
            docs.append(doc[~new])
            codes.append(2 * at[~new])
            start = np.unique(np.concatenate([[0], np.flatnonzero(new_rank)]))
            several = np.logical_or.reduceat((new & ~new_rank) | marked, start)
            size = np.diff(np.append(start, len(rank)))
            later = new & ~new_rank
            docs.append(doc[later])
            codes.append(2 * at[later] + 1)
            if not new_rank[0] and waiting is not None and several[0]:
                docs.append(np.array([waiting[0]]))
                codes.append(np.array([2 * waiting[1] + 1]))
                waiting = None
            first = new_rank & np.repeat(several, size)
            docs.append(doc[first])
            codes.append(2 * at[first] + 1)
            if new_rank[start[-1]]:
                waiting = None if several[-1] else (int(doc[start[-1]]), int(at[start[-1]]))
            last_rank, last_triple = rank[-1], triple[-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(docs)), pa.array(np.concatenate(codes).astype(np.int64))], ["doc", "code"])


def _marks(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every element of a column of lists, sorted."""
    lists = batch.column(column)
    size = np.nan_to_num(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
    row = np.repeat(np.arange(batch.num_rows), size)
    value = lists.flatten().to_numpy(zero_copy_only=False)
    order = np.lexsort((value, row))
    return row[order], value[order]


def _windows(batch: pa.RecordBatch, texts: Texts, threshold: int) -> tuple[Anchors, np.ndarray, np.ndarray]:
    """Anchors of texts whose rows carry ``codes``; which are repeats as a whole, and which are open."""
    a = anchors_of(texts, threshold)
    row, code = _marks(batch, "codes")
    repeat, open_ = np.zeros(len(a.at), bool), np.zeros(len(a.at), bool)
    k = np.searchsorted(a.at, texts.start[row] + (code >> 1))
    # an anchor at one place can stand for windows on both sides of others'; all its runs bear the same mark
    repeat[k[code & 1 == 0]] = True
    open_[k[code & 1 == 1]] = True
    return a, repeat, open_


def _spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All positions of the ranges low..high."""
    size = high - low + 1
    end = np.cumsum(size)
    return np.repeat(low - (end - size), size) + np.arange(end[-1] if len(end) else 0)


def _open_windows(threshold: int, fold_bytes: int):
    """Round 3, in the tasks: a row (first, second, doc, at) for each different open window."""
    half = threshold // 2

    def collect(batch: pa.RecordBatch, texts: Texts) -> tuple | None:
        some = np.flatnonzero(batch.column("codes").is_valid().to_numpy(zero_copy_only=False))
        if not len(some):
            return None
        batch = batch.take(pa.array(some))
        texts = texts_of(batch.column("text"))
        a, _, open_ = _windows(batch, texts, threshold)
        p = _spread(a.low[open_], a.high[open_])
        text = np.repeat(a.text[open_], (a.high - a.low + 1)[open_])
        doc = batch.column("doc").to_numpy(zero_copy_only=False)
        second = p + half if threshold % 2 == 0 else p + threshold - half
        return a.rank[p], a.rank[second], doc[text], p - texts.start[text]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, second, doc, at in _chunks(batches, ["doc", "text", "codes"], collect, fold_bytes):
            order = np.lexsort((at, doc, second, first))
            order = order[_first_of(first[order], second[order])]
            for s in range(0, len(order), 1 << 17):
                k = order[s : s + (1 << 17)]
                yield pa.RecordBatch.from_arrays([_signed(first[k]), _signed(second[k]), _signed(doc[k]), _signed(at[k])], ["first", "second", "doc", "at"])

    return windows


def _first_positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round 3 over rows sorted by (first, second, doc, at): the first position of each pair."""
    last = None
    for batch in returning(batches):
        if batch.num_rows:
            first, second = batch.column("first").to_numpy(), batch.column("second").to_numpy()
            new = _first_of(first, second)
            new[0] = last is None or (first[0], second[0]) != last
            last = (first[-1], second[-1])
            yield batch.filter(pa.array(new)).select(["doc", "at"])


def _cut(threshold: int, carry: list[str], as_text: bool):
    """Applies all marks: (doc, n_bytes, spans, kept) and the columns carried along."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = texts_of(batch.column("text"))
            removed = np.zeros(len(texts.buf), bool)
            if batch.column("codes").null_count < batch.num_rows:
                a, repeat, open_ = _windows(batch, texts, threshold)
                row, at = _marks(batch, "firsts")
                opened = _spread(a.low[open_], a.high[open_])
                hit = np.zeros(len(texts.buf) + 1, np.int32)
                np.add.at(hit, a.low[repeat], 1)
                np.add.at(hit, a.high[repeat] + threshold, -1)
                dup = np.zeros(len(texts.buf), bool)
                dup[opened] = True
                dup[texts.start[row] + at] = False
                at = np.flatnonzero(dup)
                hit[at] += 1
                np.add.at(hit, at + threshold, -1)
                removed = np.cumsum(hit)[:-1] > 0
            spans, kept = [], []
            touched = np.add.reduceat(np.append(removed, False), np.minimum(texts.start, len(removed))) if len(texts) else []
            for i in range(len(texts)):
                own = texts.buf[texts.start[i] : texts.end[i]]
                if len(own) and touched[i]:
                    gone = removed[texts.start[i] : texts.end[i]]
                    s, e = runs(gone)
                    spans.append([{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist(), strict=True)])
                    kept.append(own[~gone].tobytes())
                else:
                    spans.append([])
                    kept.append(own.tobytes())
            left = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
            columns = [batch.column("doc"), pa.array(texts.end - texts.start), pa.array(spans, spans_type), left]
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c) for c in carry)], ["doc", "n_bytes", "spans", "kept", *carry])

    return cut


def _codes(docs: DataFrame, threshold: int, most_votes: int, fold_bytes: int) -> DataFrame:
    """Rounds 1 and 2: (doc, codes) of texts with anchors that are repeats or open."""
    votes = docs.mapInArrow(_votes(threshold, most_votes, fold_bytes), "rank long, triple long, doc long, at long, kind long")
    judged = votes.repartition("rank").sortWithinPartitions("rank", "triple", "doc", "at").mapInArrow(_judge, "doc long, code long")
    return settled(judged.groupBy("doc").agg(F.collect_list("code").alias("codes")))  # at most a text's own positions


def remove_repeats(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: int = 100,
    carry: tuple[str, ...] = (),
    as_text: bool = False,
    most_votes: int = 16,
    fold_bytes: int = 24 << 20,
) -> DataFrame:
    """For each row of documents: its id, ``n_bytes``, the byte ranges removed (``spans``) and the bytes ``kept``.

    ``as_text`` gives ``kept`` as a string, without what a cut has left of characters of several bytes. The columns
    ``carry`` come along.
    """
    names = [f"_in_{i}" for i in range(len(carry))]
    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), *(F.col(c).alias(n) for c, n in zip(carry, names, strict=True)))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    ids = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null")
    clean = kind["id"] in ("bigint", "int", "smallint", "tinyint") and not ids.take(1)
    if clean:
        docs = rows.withColumn("doc", F.col("id").cast("long"))
    else:  # numbers that rise with the order of rows
        docs = settled(rows.orderBy(F.col("id").asc_nulls_last(), "text").withColumn("doc", F.monotonically_increasing_id()))
    codes = _codes(docs.select("doc", "text"), threshold, most_votes, fold_bytes)
    release(documents.sparkSession)  # of rounds 1 and 2 nothing else is needed
    carried = names if clean else [*names, "id"]
    marked = docs.select("doc", "text", *carried).join(codes, "doc", "left")
    windows = marked.mapInArrow(_open_windows(threshold, fold_bytes), "first long, second long, doc long, at long")
    firsts = windows.repartition("first", "second").sortWithinPartitions("first", "second", "doc", "at").mapInArrow(_first_positions, "doc long, at long")
    firsts = firsts.groupBy("doc").agg(F.collect_list("at").alias("firsts"))
    schema = ", ".join(["doc long, n_bytes long, spans array<struct<start:long,end:long>>", f"kept {'string' if as_text else 'binary'}", *(f"{c} {kind[c]}" for c in carried)])
    done = marked.join(firsts, "doc", "left").mapInArrow(_cut(threshold, carried, as_text), schema)
    identity = F.col("doc").cast(kind["id"]) if clean else F.col("id")
    return done.select(identity.alias(doc_id), "n_bytes", "spans", "kept", *(F.col(n).alias(c) for c, n in zip(carry, names, strict=True)))


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return found.select(
        doc_id,
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
