"""Benchmark decontamination by a prefix-filtered containment join.

A window is ``size`` consecutive words of a benchmark item (an item with fewer words is one window). A window is the set
of its word shingles (three words; fewer for shorter windows), each at a fixed place. Containment of the whole window
needs all of its shingles, so the necessary prefix is one token: the shingle that is rarest in the documents. The join
therefore looks up, for each shingle of a document, the windows whose rarest shingle it is. The place of the shingle in
the window gives the only place where the window can start (positional bound), which must leave room for the whole
window inside the text (length bound). What is left is verified word by word.

Scale: a benchmark of at most ``broadcast_bytes`` is indexed once and goes to all tasks; documents are then read twice (for how
rare its shingles are, and for the join) and never shuffled. A larger one stays in DataFrames: its windows, their shingles and
how rare those are; documents' shingles that may be in a window (a bit table of at most ``filter_bits`` turns most others away)
are counted, and those that may be a prefix meet the prefixes in a join by shuffle that can split frequent shingles. Each brings
the words around it, so that bounds and words are checked in the join. Documents take part by their texts there: equal texts
are worked off once. No task or driver holds the benchmark, or more than one row of a document and the hits in its text.

Edge cases: NULL and word-free texts have no words and hits; an item without words has no window; items with equal
windows are all reported; repeated rows and repeated ids are answered row by row; a NULL item_id takes part as NULL and
is left out of ``item_ids``; item ids of any type are given back as they are; an empty benchmark gives no hit. Other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.storage import settled
from vitrine.llm.text import NON_ALNUM, runs, shingles, slices, texts_of, words_of
from vitrine.operators.joins import lookup

SHINGLE = 3


@dataclass
class Index:
    """Windows of a block of items, and their tokens. ``tokens`` are sorted shingle hashes."""

    length: np.ndarray
    words: np.ndarray  # window x size, word hashes, zero beyond the window's length
    items: list[list[str]]
    tokens: np.ndarray
    size_of_token: np.ndarray
    window_tokens: list[np.ndarray]  # per window, its tokens' places in ``tokens``, by offset
    # the chosen token of each window: sorted by token, with where its windows start and end
    prefix: np.ndarray | None = None
    prefix_window: np.ndarray | None = None
    prefix_offset: np.ndarray | None = None


def index_of(rows: list[tuple[int | None, str | None]], size: int) -> Index:
    texts = texts_of(pa.array([text for _, text in rows], pa.string()))
    words = words_of(texts, NON_ALNUM, lower=True)
    found: dict[tuple[int, ...], set] = {}
    for i, (item, _) in enumerate(rows):
        own = [int(h) for h in words.hash[words.first[i] : words.last[i]]]
        for at in range(max(1, len(own) - size + 1) if own else 0):
            found.setdefault(tuple(own[at : at + size]), set()).add(item)
    windows = sorted(found)
    table = np.zeros((len(windows), size), np.uint64)
    length = np.array([len(w) for w in windows], np.int64)
    for k, w in enumerate(windows):
        table[k, : len(w)] = w
    # shingles of windows, by the same function that hashes those of documents
    tokens_of, sizes = [], {}
    for k, w in enumerate(windows):
        g = min(SHINGLE, len(w))
        hashes = shingles(_words(table[k, : len(w)]), g)[0][: len(w) - g + 1]
        tokens_of.append(hashes)
        sizes.update((int(h), g) for h in hashes)
    tokens = np.array(sorted(sizes), np.uint64)
    return Index(
        length,
        table,
        [sorted(x for x in found[w] if x is not None) for w in windows],
        tokens,
        np.array([sizes[int(t)] for t in tokens], np.int64),
        [np.searchsorted(tokens, h) for h in tokens_of],
    )


def _words(hashes: np.ndarray):
    from vitrine.llm.text import Words

    return Words(np.zeros(0), np.zeros(0), hashes, np.array([0]), np.array([len(hashes)]))


class Lookup:
    """Sorted values behind a table of bits that turns away nearly all others."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.bits = max(16, min(24, int(len(values)).bit_length() + 6))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[values >> np.uint64(64 - self.bits)] = True

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places in ``hashes`` whose value is one of the values."""
        at = np.flatnonzero(self.seen[hashes >> np.uint64(64 - self.bits)])
        k = np.minimum(np.searchsorted(self.values, hashes[at]), max(0, len(self.values) - 1))
        return at[self.values[k] == hashes[at]] if len(self.values) else at[:0]


def count_tokens(documents: DataFrame, index: Index, text: str) -> np.ndarray:
    """How often each token occurs in all documents. One row for each task and token leaves the scan."""
    tokens, sizes = index.tokens, index.size_of_token

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(tokens), np.int64)
        by_size = {g: Lookup(tokens[sizes == g]) for g in set(sizes.tolist())}
        for batch in slices(batches):
            words = words_of(texts_of(batch.column("text")), NON_ALNUM, lower=True)
            for g, lookup in by_size.items():
                hashes, inside = shingles(words, g)
                at = lookup.find(hashes)
                at = at[inside[at]]
                total += np.bincount(np.searchsorted(tokens, hashes[at]), minlength=len(tokens))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["token", "n"])

    counted = documents.select(F.col(text).alias("text")).mapInArrow(count, "token long, n long")
    total = np.zeros(len(tokens), np.int64)
    for token, n in counted.groupBy("token").agg(F.sum("n")).collect():  # a row for each token of the bounded block
        total[token] = n
    return total


def choose_prefix(index: Index, counts: np.ndarray) -> Index:
    """The rarest token of each window is the one that containment cannot do without."""
    rank = np.empty(len(counts), np.int64)
    rank[np.lexsort((index.tokens, counts))] = np.arange(len(counts))
    offset = np.array([int(np.argmin(rank[t])) for t in index.window_tokens], np.int64)
    token = np.array([t[o] for t, o in zip(index.window_tokens, offset, strict=True)], np.int64)
    order = np.argsort(token, kind="stable")
    index.prefix, index.prefix_window, index.prefix_offset = index.tokens[token[order]], order, offset[order]
    return index


def scan(index: Index, carry: list[str]):
    """Adds the hits of one block to rows of (doc, text, spans, items) and the columns carried along."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.minimum(index.length, SHINGLE)
        by_size = {}
        for g in set(sizes.tolist()):
            own = np.flatnonzero(sizes[index.prefix_window] == g)
            by_size[g] = (Lookup(np.unique(index.prefix[own])), index.prefix[own], own)
        for batch in slices(batches):
            words = words_of(texts_of(batch.column("text")), NON_ALNUM, lower=True)
            text = words.text
            starts, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for g, (lookup, prefix, own) in by_size.items():
                hashes, inside = shingles(words, g)
                at = lookup.find(hashes)
                at = at[inside[at]]
                low, high = np.searchsorted(prefix, hashes[at]), np.searchsorted(prefix, hashes[at], side="right")
                pair = np.repeat(at, high - low)
                k = own[np.repeat(low, high - low) + np.arange(len(pair)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)]
                window = index.prefix_window[k]
                start = pair - index.prefix_offset[k]
                room = (start >= words.first[text[pair]]) & (start + index.length[window] <= words.last[text[pair]])
                start, window = start[room], window[room]
                same = np.ones(len(start), bool)
                for j in range(index.words.shape[1]):
                    more = j < index.length[window]
                    same[more] &= words.hash[(start + j)[more]] == index.words[window[more], j]
                starts.append(start[same])
                windows.append(window[same])
            start, window = np.concatenate(starts), np.concatenate(windows)
            edge = np.zeros(len(words.hash) + 1, np.int32)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + index.length[window], -1)
            hit = np.cumsum(edge)[:-1] > 0
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            items: list[set] = [set() for _ in range(batch.num_rows)]
            for s, w in zip(start.tolist(), window.tolist(), strict=True):
                items[text[s]].update(index.items[w])
            for i in np.unique(text[start]).tolist():
                a, b = runs(hit[words.first[i] : words.last[i]])
                spans[i] = [{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("text"),
                    pa.array(words.last - words.first, pa.int64()),
                    pa.array([[*old, *new] for old, new in zip(batch.column("spans").to_pylist(), spans, strict=True)], kind),
                    pa.array([sorted({*old, *new}) for old, new in zip(batch.column("items").to_pylist(), items, strict=True)], pa.list_(pa.string())),
                    *(batch.column(c) for c in carry),
                ],
                ["doc", "text", "n_words", "spans", "items", *carry],
            )

    return join


def _lists(table: np.ndarray) -> pa.ListArray:
    rows, width = table.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(table).view(np.int64).ravel()))


def _windows(size: int, at_most: int = 20_000):
    """A row for each window of an item: its words, and the shingles of it, as hashes."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(texts_of(batch.column("text")), NON_ALNUM, lower=True)
            of_size = {g: shingles(words, g)[0] for g in range(1, SHINGLE + 1)}
            for item, first, last in zip(batch.column("item").to_pylist(), words.first.tolist(), words.last.tolist(), strict=True):
                length = min(size, last - first)
                g = min(SHINGLE, length)
                starts = np.arange(first, last - length + 1) if length else np.zeros(0, np.int64)
                for k in range(0, len(starts), at_most):
                    own = starts[k : k + at_most, None]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(own), pa.string()), _lists(words.hash[own + np.arange(length)]), _lists(of_size[g][own + np.arange(length - g + 1)]), pa.array(np.full(len(own), g, np.int32))],
                        ["item", "words", "tokens", "g"],
                    )

    return emit


class BitTable:
    """Which remainders the tokens have: turns away nearly all others, and none of them."""

    def __init__(self, tokens: DataFrame, bits: int):
        slot = F.pmod("token", F.lit(bits))
        held = tokens.select(F.shiftright(slot, 6).alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int")).alias("bit"))
        found = held.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most bits / 64 rows
        self.bits = bits
        self.table = np.zeros(bits // 64, np.int64)
        self.table[found.column("at").to_numpy()] = found.column("bits").to_numpy()

    def find(self, hashes: np.ndarray, inside: np.ndarray) -> np.ndarray:
        slot = hashes.view(np.int64) % self.bits
        return np.flatnonzero(inside & (((self.table[slot >> 6] >> (slot & 63)) & 1) == 1))


def _count_shingles(table: BitTable, sizes: list[int]):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(texts_of(batch.column("text")), NON_ALNUM, lower=True)
            for g in sizes:
                hashes, inside = shingles(words, g)
                token, n = np.unique(hashes[table.find(hashes, inside)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(token), g, np.int32)), pa.array(token.view(np.int64)), pa.array(n)], ["g", "token", "n"])

    return emit


def _postings(table: BitTable, sizes: list[int], size: int, at_most: int = 20_000):
    """A row for each place of a text whose shingle may be a prefix, with the words around it; ``before`` of them come first."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(texts_of(batch.column("text")), NON_ALNUM, lower=True)
            text = words.text
            for g in sizes:
                hashes, inside = shingles(words, g)
                found = table.find(hashes, inside)
                for k in range(0, len(found), at_most):
                    at = found[k : k + at_most]
                    row = text[at]
                    low, high = np.maximum(words.first[row], at - size + 1), np.minimum(words.last[row], at + size)
                    offsets = np.concatenate([[0], np.cumsum(high - low)])
                    around = np.repeat(low - offsets[:-1], high - low) + np.arange(offsets[-1])
                    own = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("k1").take(own), batch.column("k2").take(own), pa.array(at - words.first[row]), pa.array(np.full(len(at), g, np.int32)), pa.array(hashes[at].view(np.int64)),
                         pa.array(at - low), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(words.hash[around].view(np.int64)))],
                        ["k1", "k2", "at", "g", "token", "before", "around"],
                    )

    return emit


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        words = words_of(texts_of(batch.column("text")), NON_ALNUM, lower=True)
        yield batch.append_column("n_words", pa.array(words.last - words.first, pa.int64()))


def _ids(column: Column, names: tuple[str, str]) -> list[Column]:
    """128 bits of a value, as two numbers."""
    return [F.xxhash64(column).alias(names[0]), F.xxhash64(F.lit(1), column).alias(names[1])]


def prefixes(texts: DataFrame, items: DataFrame, size: int, filter_bits: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """The rarest shingle of each different window (w1, w2, words, g, token, offset), the items of windows (w1, w2, item), and
    the sizes of shingles."""
    windows = items.mapInArrow(_windows(size), "item string, words array<long>, tokens array<long>, g int")
    windows = settled(windows.groupBy("item", "words", "g").agg(F.first("tokens").alias("tokens")).select("*", *_ids(F.col("words"), ("w1", "w2"))))
    sizes = [g for g in range(1, SHINGLE + 1) if windows.where(F.col("g") == g).take(1)]
    different = windows.groupBy("w1", "w2").agg(F.first("words").alias("words"), F.first("tokens").alias("tokens"), F.first("g").alias("g"))
    tokens = settled(different.select("w1", "w2", "g", F.posexplode("tokens").alias("offset", "token")))
    table = BitTable(tokens.select("token"), filter_bits)
    counts = texts.select("text").mapInArrow(_count_shingles(table, sizes), "g int, token long, n long").groupBy("g", "token").agg(F.sum("n").alias("n"))
    rare = F.min(F.struct(F.coalesce("n", F.lit(0).cast("long")).alias("n"), "token", "offset")).alias("rare")
    chosen = lookup(tokens, counts, ["g", "token"]).groupBy("w1", "w2").agg(rare)
    return settled(different.drop("tokens").join(chosen, ["w1", "w2"]).select("w1", "w2", "words", "g", "rare.token", "rare.offset")), windows.select("w1", "w2", "item"), sizes


def found_in_texts(texts: DataFrame, items: DataFrame, size: int = 10, filter_bits: int = 1 << 26) -> DataFrame:
    """``spans`` and ``items`` for each text that holds a window, by its numbers k1 and k2. ``texts`` has k1, k2 and text."""
    chosen, of_window, sizes = prefixes(texts, items, size, filter_bits)
    table = BitTable(chosen.select("token"), filter_bits)
    postings = texts.select("k1", "k2", "text").mapInArrow(_postings(table, sizes, size), "k1 long, k2 long, at long, g int, token long, before long, around array<long>")
    places = postings.groupBy("k1", "k2", "at", "g").agg(*(F.first(c).alias(c) for c in ("token", "before", "around")))  # equal texts have equal rows
    start, length = F.col("before") - F.col("offset"), F.size("words")
    fits = (start >= 0) & (start + length <= F.size("around"))
    same = F.when(fits, F.slice("around", (start + 1).cast("int"), length) == F.col("words")).otherwise(F.lit(False))
    met = lookup(places, chosen, ["g", "token"], "inner").where(same)
    hits = settled(met.select("k1", "k2", "w1", "w2", (F.col("at") - F.col("offset")).alias("start"), (F.col("at") - F.col("offset") + length).alias("end")))
    order = Window.partitionBy("k1", "k2").orderBy("start")
    ends = hits.groupBy("k1", "k2", "start").agg(F.max("end").alias("end"))
    apart = F.col("start") > F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1).cast("long"))
    runs_ = ends.withColumn("apart", apart).withColumn("run", F.sum(F.col("apart").cast("int")).over(order)).groupBy("k1", "k2", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = runs_.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    named = lookup(hits.select("k1", "k2", "w1", "w2").distinct(), of_window.where("item is not null"), ["w1", "w2"], "inner")
    names = named.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return spans.join(names, ["k1", "k2"], "left")


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = 10,
    broadcast_bytes: int = 2 << 20,
    filter_bits: int = 1 << 26,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """For each row of documents: its id, n_words, ``spans`` (runs of hit words, from and to) and ``item_ids`` found.

    The columns ``carry`` of documents come along. A benchmark of up to ``broadcast_bytes`` of text goes to all tasks.
    """
    names = [f"_in_{i}" for i in range(len(carry))]
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    kind = benchmark.schema[item_id].dataType
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item"), F.lit(0)) + 8), F.lit(0))).first()[0]
    carried = [F.col(c).alias(n) for c, n in zip(carry, names, strict=True)]
    no_spans, no_items = F.array().cast("array<struct<start:long,end:long>>"), F.array().cast("array<string>")
    if total <= broadcast_bytes:
        rows = documents.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"), F.lit(0).cast("long").alias("n_words"), no_spans.alias("spans"), no_items.alias("items"), *carried)
        index = index_of([(r[0], r[1]) for r in items.where("text is not null").collect()], size)  # at most broadcast_bytes
        counts = count_tokens(documents, index, text) if len(index.tokens) else np.zeros(0, np.int64)
        rows = rows.mapInArrow(scan(choose_prefix(index, counts), names), rows.schema)
    else:
        rows = documents.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"), *carried)
        found = settled(found_in_texts(documents.select(*_ids(F.col(text), ("k1", "k2")), F.col(text).alias("text")), items, size, filter_bits))
        held = found.agg(F.sum(48 + 16 * F.size("spans") + F.coalesce(F.octet_length(F.array_join("items", "")), F.lit(0)))).first()[0] or 0
        counted = rows.mapInArrow(_count_words, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "n_words long"])).select("*", *_ids(F.col("text"), ("k1", "k2")))
        rows = counted.join(F.broadcast(found), ["k1", "k2"], "left") if held <= broadcast_bytes else lookup(counted, found, ["k1", "k2"])
    spans = F.coalesce("spans", no_spans)
    item_ids = F.array_sort(F.transform(F.coalesce("items", no_items), lambda i: i.cast(kind)))
    return rows.select(F.col("doc").alias(doc_id), "n_words", spans.alias("spans"), item_ids.alias("item_ids"), *(F.col(n).alias(c) for c, n in zip(carry, names, strict=True)))


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts and a checksum of what ``contamination`` found."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    names = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select(
        doc_id,
        "n_words",
        hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
