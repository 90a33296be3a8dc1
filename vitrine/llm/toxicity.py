"""Toxicity: a bidirectional gated recurrent network with attention pooling, over word and character inputs.

A word's input is a learned vector of its hash and the sum of learned vectors (over the root of their number) of its character trigrams' hashes. One
channel of each starts as the smoothed log odds of toxic against other sample texts that hold it, the others at random. Two
gated recurrent units read a window of ``WINDOW`` words, one in each direction; attention pools their states; a logistic
unit scores the window. A text's score is that of its worst window. Windows overlap by ``WINDOW - STRIDE`` words and cover
every word of every text; a shorter text is one window.

Training is backpropagation through time with Adam, over a sample of at most ``sample`` labelled documents chosen by a hash of
their id, and all windows of these. A sampled text's error goes to its worst window. Sampled texts stay in the tasks, however long: these count words for
the log odds, and before each epoch look for every text's worst window (by the log odds before the first). The driver gets
that window as rows of the tables, at most ``WINDOW`` words of at most ``GRAMS`` trigrams, and does the epoch in numpy.
Identifiers, language, source and labels are not among the inputs.

Scale: the model is a fixed number of floats. The sample is written once to the shared folder. Scoring is one pass over the texts without a shuffle; inputs are computed
once per distinct word of a batch, and windows of many texts are run through the network together.

Edge cases: NULL, empty and word-free texts are scored by the bias. Without labels the score is 0.5; with one class only its
smoothed share. NULL ids are never held out and never learned from. Repeated rows are scored alike. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.labelled import learning_sample, remainder
from vitrine.llm.storage import settled
from vitrine.llm.text import BYTE_VALUES, NON_ALNUM, ORDER_VALUES, Texts, mix, slices, texts_of, words_of

WINDOW, STRIDE = 32, 24
WORDS, GRAMS = 1 << 15, 1 << 14
#: Channels of a word's vector, of its trigrams' vector, and of a state.
E_WORD, E_GRAM, HIDDEN = 6, 6, 8
E = E_WORD + E_GRAM


@dataclass
class Vocabulary:
    """Distinct words of some texts: their row in the table of words, and their trigrams' rows and weights (a list for each)."""

    row: np.ndarray
    grams: np.ndarray
    at: np.ndarray
    weight: np.ndarray


def read_words(texts: Texts) -> tuple[Vocabulary, np.ndarray, np.ndarray, np.ndarray]:
    """Vocabulary, each word's number in it, and each text's first and last word."""
    words = words_of(texts, NON_ALNUM, lower=True)
    hashes, one, which = np.unique(words.hash, return_index=True, return_inverse=True)
    start, size = words.start[one], (words.end - words.start)[one]
    # trigrams of "<word>": size of them for a word of that many bytes
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(size)), size)
    place = np.arange(end[-1] if len(end) else 0) - np.repeat(end - size, size)
    low = texts.buf | np.where((texts.buf >= 0x41) & (texts.buf <= 0x5A), 0x20, 0).astype(np.uint8)
    byte = lambda k: np.where((place + k >= 0) & (place + k < size[owner]), low[np.clip(start[owner] + place + k, 0, max(0, len(low) - 1))], 0x20) if len(owner) else place
    total = sum(BYTE_VALUES[byte(k)] * ORDER_VALUES[k + 1] for k in (-1, 0, 1)) if len(owner) else np.zeros(0, np.uint64)
    grams = (mix(total) % np.uint64(GRAMS)).astype(np.int64)
    weight = np.repeat(1 / np.sqrt(size), size).astype(np.float32)
    return Vocabulary((hashes % np.uint64(WORDS)).astype(np.int64), grams, np.concatenate([[0], end]), weight), which, words.first, words.last


def part_of(v: Vocabulary, used: np.ndarray) -> Vocabulary:
    """The vocabulary of the words ``used`` alone."""
    size = np.diff(v.at)[used]
    end = np.cumsum(size)
    which = np.repeat(v.at[used] - (end - size), size) + np.arange(end[-1] if len(end) else 0)
    return Vocabulary(v.row[used], v.grams[which], np.concatenate([[0], end]), v.weight[which])


def packed(v: Vocabulary) -> tuple[bytes, bytes, bytes, bytes]:
    """Rows, numbers of trigrams, trigrams and weights of a vocabulary; equal trigrams of a word become one, so that no word is large."""
    key, which = np.unique(np.repeat(np.arange(len(v.row)), np.diff(v.at)) * GRAMS + v.grams, return_inverse=True)
    owner, grams = np.divmod(key, GRAMS)
    size = np.bincount(owner, minlength=len(v.row))
    weight = np.bincount(which, v.weight, minlength=len(key))
    return v.row.astype(np.uint16).tobytes(), size.astype(np.int32).tobytes(), grams.astype(np.uint16).tobytes(), weight.astype(np.float32).tobytes()


def unpacked(parts: list[tuple[bytes, bytes, bytes, bytes]]) -> Vocabulary:
    """The words of many packed vocabularies, one after the other."""
    row, size, grams, weight = (np.frombuffer(b"".join(p[k] for p in parts), t) for k, t in enumerate((np.uint16, np.int32, np.uint16, np.float32)))
    return Vocabulary(row.astype(np.int64), grams.astype(np.int64), np.concatenate([[0], np.cumsum(size, dtype=np.int64)]), weight)


def windows_of(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and size of all windows; a text without words has none."""
    n = last - first
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = first[text] + k * STRIDE
    return text, start, np.minimum(WINDOW, last[text] - start)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters by name, and passes over a batch of windows."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.p = {"word": normal(WORDS, E_WORD, scale=0.05), "gram": normal(GRAMS, E_GRAM, scale=0.05)}
        for d in "fb":
            self.p |= {f"x{d}": normal(E, 3 * HIDDEN, scale=0.4), f"h{d}": normal(HIDDEN, 3 * HIDDEN, scale=0.3), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"a": normal(2 * HIDDEN, 2 * HIDDEN, scale=0.3), "q": normal(2 * HIDDEN, scale=0.5), "o": normal(2 * HIDDEN, scale=0.5), "bias": np.zeros(1, np.float32)}
        self.constant: float | None = None

    def inputs(self, v: Vocabulary) -> np.ndarray:
        """Input vector of each word of a vocabulary."""
        grams = np.add.reduceat(self.p["gram"][v.grams] * v.weight[:, None], v.at[:-1], axis=0) if len(v.grams) else np.zeros((len(v.row), E_GRAM), np.float32)
        return np.concatenate([self.p["word"][v.row], grams], 1).astype(np.float32)

    def _unit(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """States (time, window, HIDDEN) of one direction. x: time, window, 3 * HIDDEN; masked steps carry the state on."""
        n = x.shape[1]
        h = np.zeros((n, HIDDEN), np.float32)
        states = np.empty((len(x), n, HIDDEN), np.float32)
        weight = self.p[f"h{d}"]
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            r = h @ weight
            gates = 1 / (1 + np.exp(-(x[t, :, : 2 * HIDDEN] + r[:, : 2 * HIDDEN])))
            z, g = gates[:, :HIDDEN], gates[:, HIDDEN:]
            c = np.tanh(x[t, :, 2 * HIDDEN :] + g * r[:, 2 * HIDDEN :])
            new = h + mask[t][:, None] * z * (c - h)
            if keep is not None:
                keep.append((t, h, z, g, c, r[:, 2 * HIDDEN :]))
            states[t] = h = new
        return states

    def run(self, table: np.ndarray, index: np.ndarray, mask: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Logits of windows. table: input vectors; index and mask: time by window."""
        out = []
        for d in "fb":
            kept: list | None = [] if trace is not None else None
            out.append(self._unit(d, (table @ self.p[f"x{d}"] + self.p[f"c{d}"])[index], mask, kept))
            if trace is not None:
                trace[d] = kept
        h = np.concatenate(out, 2)
        u = np.tanh(h @ self.p["a"])
        s = np.where(mask > 0, u @ self.p["q"], -1e9)
        e = np.exp(s - s.max(0))
        alpha = e / e.sum(0)
        pooled = (alpha[:, :, None] * h).sum(0)
        if trace is not None:
            trace |= {"h": h, "u": u, "alpha": alpha, "pooled": pooled}
        return pooled @ self.p["o"] + self.p["bias"][0]

    def gradients(self, v: Vocabulary, table: np.ndarray, index: np.ndarray, mask: np.ndarray, trace: dict, error: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of all parameters, for the error of each window's logit."""
        p, g = self.p, {"bias": np.array([error.sum()]), "o": trace["pooled"].T @ error}
        h, u, alpha = trace["h"], trace["u"], trace["alpha"]
        d_pooled = error[:, None] * p["o"]
        d_alpha = (h * d_pooled).sum(2)
        d_s = alpha * (d_alpha - (alpha * d_alpha).sum(0))
        g["q"] = np.tensordot(d_s, u, ((0, 1), (0, 1)))
        d_u = d_s[:, :, None] * p["q"] * (1 - u * u)
        g["a"] = np.tensordot(h, d_u, ((0, 1), (0, 1)))
        d_h = alpha[:, :, None] * d_pooled + d_u @ p["a"].T
        d_table = np.zeros_like(table)
        for k, d in enumerate("fb"):
            own = d_h[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            carry = np.zeros_like(own[0])
            d_x = np.zeros((len(h), own.shape[1], 3 * HIDDEN), np.float32)
            g[f"h{d}"] = np.zeros_like(p[f"h{d}"])
            for t, before, z, gate, c, r in reversed(trace[d]):
                m = mask[t][:, None]
                total = own[t] + carry
                d_z = total * m * (c - before) * z * (1 - z)
                d_c = total * m * z * (1 - c * c)
                d_g = d_c * r * gate * (1 - gate)
                d_x[t] = np.concatenate([d_z, d_g, d_c], 1)
                d_r = np.concatenate([d_z, d_g, d_c * gate], 1)
                g[f"h{d}"] += before.T @ d_r
                carry = total * (1 - m * z) + d_r @ p[f"h{d}"].T
            g[f"c{d}"] = d_x.sum((0, 1))
            projected = np.zeros((len(table), 3 * HIDDEN), np.float32)
            np.add.at(projected, index.ravel(), d_x.reshape(-1, 3 * HIDDEN))
            g[f"x{d}"] = table.T @ projected
            d_table += projected @ p[f"x{d}"].T
        g["word"] = (v.row, d_table[:, :E_WORD])
        g["gram"] = (v.grams, np.repeat(d_table[:, E_WORD:], np.diff(v.at), axis=0) * v.weight[:, None])
        return g


def _batch(index_of_word: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and mask of windows, time by window, no longer than the longest."""
    step = np.arange(int(size.max()))[:, None]
    mask = step < size[None, :]
    return index_of_word[np.where(mask, start[None, :] + step, start[None, :])], mask.astype(np.float32)


def worst_windows(net: Network, texts: Texts, odds: bool = False, at_once: int = 4096) -> tuple[np.ndarray, list[Vocabulary | None]]:
    """The logit of each text's worst window, and that window's words; -inf and None without words.

    odds: windows are judged by the mean of the first channels of their words, before anything is learned.
    """
    worst, best = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64)
    v, number, first, last = read_words(texts)
    text, start, size = windows_of(first, last)
    table = net.inputs(v)
    for s in range(0, len(text), at_once):
        index, mask = _batch(number, start[s : s + at_once], size[s : s + at_once])
        logit = ((table[:, 0] + table[:, E_WORD])[index] * mask).sum(0) / mask.sum(0) if odds else net.run(table, index, mask)
        own = text[s : s + at_once]
        order = np.lexsort((-logit, own))  # the first of a text is its worst, of equal ones the earliest
        order = order[np.append(True, np.diff(own[order]) > 0)]
        order = order[logit[order] > worst[own[order]]]
        worst[own[order]], best[own[order]] = logit[order], s + order
    found = (number[start[k] : start[k] + size[k]] if w > -np.inf else None for k, w in zip(best, worst, strict=True))
    return worst, [part_of(v, used) if used is not None else None for used in found]


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many clean and toxic texts each row of words, then of trigrams, occurs; at last the numbers of texts."""
    for batch in slices(batches):
        v, number, first, last = read_words(texts_of(batch.column("text")))
        seen = np.zeros((2, WORDS + GRAMS + 1), np.int64)
        for i, y in enumerate(batch.column("label").to_pylist()):
            own = np.unique(number[first[i] : last[i]])
            seen[y, np.unique(v.row[own])] += 1
            seen[y, WORDS + np.unique(part_of(v, own).grams)] += 1
            seen[y, -1] += 1
        at = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, seen[0, at], seen[1, at])], ["at", "clean", "toxic"])


def train(chosen: DataFrame, epochs: int = 6, step: float = 0.01, seed: int = 11) -> Network:
    """Learns from rows of doc_id, text and label. Texts stay in the tasks; the driver sees one window of each, packed."""
    net = Network(seed)
    seen = np.zeros((2, WORDS + GRAMS + 1))
    for r in chosen.mapInArrow(_seen, "at long, clean long, toxic long").groupBy("at").sum("clean", "toxic").collect():  # at most a row for each of the tables
        seen[:, r[0]] = r[1], r[2]
    clean, toxic = seen[:, -1]
    share = float((toxic + 0.5) / (clean + toxic + 1))
    if not clean or not toxic:
        net.constant = share
        return net
    # log odds of the words and trigrams of toxic texts, each text counted once
    for name, (neg, pos) in (("word", seen[:, :WORDS]), ("gram", seen[:, WORDS:-1])):
        odds = np.log((pos + 2 * share) / (toxic + 2)) - np.log((neg + 2 * (1 - share)) / (clean + 2))
        net.p[name][:, 0] = 0.5 * np.where(pos + neg > 0, odds, 0)
    net.p["bias"][0] = np.log(share / (1 - share))
    rng = np.random.default_rng(seed)
    moment = {n: (np.zeros_like(x), np.zeros_like(x)) for n, x in net.p.items()}
    turn = 0
    kind = chosen.schema["doc_id"].dataType.simpleString()
    for epoch in range(epochs):

        def worst(batches: Iterator[pa.RecordBatch], odds: bool = epoch == 0) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = worst_windows(net, texts_of(batch.column("text")), odds)[1]
                kept = [k for k, v in enumerate(found) if v is not None]
                parts = [packed(found[k]) for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(kept, pa.int64())), batch.column("label").take(pa.array(kept, pa.int64())), *(pa.array([p[k] for p in parts], pa.binary()) for k in range(4))],
                    ["doc_id", "label", "row", "size", "grams", "weight"],
                )

        got = chosen.mapInArrow(worst, f"doc_id {kind}, label int, row binary, size binary, grams binary, weight binary").collect()  # a window of each text
        rows = sorted((r[0], *map(bytes, r[2:]), r[1]) for r in got)
        labels = np.array([r[-1] for r in rows], np.float32)
        v = unpacked([r[1:5] for r in rows])
        size = np.array([len(r[1]) // 2 for r in rows], np.int64)
        start = np.cumsum(size) - size
        rate = step * (1 - epoch / epochs) + 1e-3
        for some in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 48)) if rows else ():
            index, mask = _batch(np.arange(len(v.row)), start[some], size[some])
            used, index = np.unique(index, return_inverse=True)
            few, index = part_of(v, used), index.reshape(mask.shape)
            table = net.inputs(few)
            trace: dict = {}
            error = (_sigmoid(net.run(table, index, mask, trace)) - labels[some]).astype(np.float32) / len(some)
            turn += 1
            for name, g in net.gradients(few, table, index, mask, trace, error).items():
                if isinstance(g, tuple):  # rows of a table
                    rows_, place = np.unique(g[0], return_inverse=True)
                    dense = np.zeros((len(rows_), g[1].shape[1]), np.float32)
                    np.add.at(dense, place, g[1])
                    touched = np.flatnonzero(np.abs(dense).sum(1) > 0)
                    where, g = rows_[touched], dense[touched]
                else:
                    where = slice(None)
                a, b = moment[name]
                a[where] = 0.9 * a[where] + 0.1 * g
                b[where] = 0.999 * b[where] + 0.001 * g * g
                net.p[name][where] -= rate * (a[where] / (1 - 0.9**turn)) / (np.sqrt(b[where] / (1 - 0.999**turn)) + 1e-8)
    return net


def score_texts(net: Network, texts: Texts, at_once: int = 4096) -> np.ndarray:
    """The score of each text's worst window."""
    worst = np.full(len(texts), -np.inf)
    if net.constant is not None:
        return np.full(len(texts), net.constant)
    v, number, first, last = read_words(texts)
    if len(number):
        table = net.inputs(v)
        text, start, size = windows_of(first, last)
        for s in range(0, len(text), at_once):
            index, mask = _batch(number, start[s : s + at_once], size[s : s + at_once])
            np.maximum.at(worst, text[s : s + at_once], net.run(table, index, mask))
    return _sigmoid(np.where(np.isinf(worst), float(net.p["bias"][0]), worst))


def toxicity_scores(
    documents: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 4, held_out: int = 2, threshold: float = 0.3, sample: int = 4000
) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of documents (doc_id and text)."""
    docs = documents.select("doc_id", "text")
    net = train(settled(learning_sample(docs, labels, label, parts, held_out, sample)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score_texts(net, texts_of(batch.column("text"))).astype(float))], ["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = docs.mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(remainder("doc_id", parts) == held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
