"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text is a sparse vector: its distinct words hashed to ``buckets`` columns (square root of the count, scaled to length 1),
statistics of its structure in bins (each bin a column), and metadata in bins (by default the recorded number of
characters). The score is the logistic of

    bias + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),

which takes time linear in the number of words, by the sum-of-squares identity for all pairwise interactions of rank
``rank``. Training is Adagrad on minibatches in numpy, on a sample of at most ``sample`` labelled documents, chosen by
a hash of their id; identifiers, language, source and labels are not among the inputs.

Scale: the model is a fixed number of floats, whatever the corpus. Features of the sample are made in the tasks (a text
yields at most ``buckets`` words) and collected as packed arrays; scoring is one pass over the texts, without a shuffle.

Edge cases: NULL and empty texts have no words and are scored by bias and statistics. Without any label the score is 0.5;
with one class only it is that class's smoothed share. NULL ids are never held out and never learned from. Repeated rows are
scored alike. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.labelled import learning_sample, remainder
from vitrine.llm.robust_rules import FEATURES, statistics
from vitrine.llm.text import slices, texts_of, words_of

BINS = 24
#: Upper end of each statistic's bins, in its own unit (thousandths).
_REACH = {"f_length": 12_000, "f_word": 4_800}


def features(batch: pa.RecordBatch, buckets: int, metadata: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns and values of all rows one after the other, and where each row's begin (and the end)."""
    texts = texts_of(batch.column("text"))
    n = len(texts)
    words = words_of(texts, lower=False)
    key = words.text * buckets + (words.hash % np.uint64(buckets)).astype(np.int64)
    key, count = np.unique(key, return_counts=True)
    row, column = np.divmod(key, buckets)
    value = np.sqrt(count)
    norm = np.sqrt(np.bincount(row, value**2, minlength=n))
    value = value / np.maximum(norm[row], 1)
    got = statistics(texts)
    binned = [np.clip(got[f] * BINS // _REACH.get(f, 1200), 0, BINS - 1) for f in FEATURES]
    for name in metadata:
        meta = batch.column(name).cast(pa.float64()).fill_null(-1.0).to_numpy(zero_copy_only=False)
        binned.append(np.clip(np.where(meta < 0, 0, 1 + np.log1p(np.maximum(meta, 0)) * 1.5), 0, BINS - 1).astype(np.int64))
    dense = np.stack([buckets + k * BINS + b for k, b in enumerate(binned)], 1)
    rows = np.concatenate([row, np.repeat(np.arange(n), dense.shape[1])])
    columns = np.concatenate([column, dense.ravel()])
    values = np.concatenate([value, np.full(dense.size, 0.3)])
    order = np.argsort(rows, kind="stable")
    return columns[order].astype(np.int32), values[order].astype(np.float32), np.searchsorted(rows[order], np.arange(n + 1))


@dataclass
class Model:
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def parts(self, columns: np.ndarray, values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits of rows, and the sums of their factors."""
        terms = self.factor[columns] * values[:, None]
        sums = np.add.reduceat(terms, at[:-1], axis=0)
        pairs = 0.5 * (np.square(sums).sum(1) - np.add.reduceat(np.square(terms).sum(1), at[:-1]))
        return self.bias + np.add.reduceat(self.weight[columns] * values, at[:-1]) + pairs, sums

    def score(self, columns: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.parts(columns, values, at)[0], -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], width: int, rank: int = 8, epochs: int = 6, step: float = 0.1, l2: float = 1e-4, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    labels = np.array([r[2] for r in rows], float)
    share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.5
    model = Model(float(np.log(share / (1 - share))), np.zeros(width, np.float32), rng.normal(0, 0.05, (width, rank)).astype(np.float32))
    if labels.min(initial=1) == labels.max(initial=0) or not len(labels):
        return Model(model.bias, model.weight, np.zeros_like(model.factor))
    square_w, square_v = np.full(width, 1e-3, np.float32), np.full((width, rank), 1e-3, np.float32)
    square_b = 1e-3
    for _ in range(epochs):
        for some in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 64)):
            sizes = np.array([len(rows[i][0]) for i in some])
            at = np.concatenate([[0], np.cumsum(sizes)])
            columns, values = (np.concatenate([rows[i][k] for i in some]) for k in (0, 1))
            logit, sums = model.parts(columns, values, at)
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[some]).astype(np.float32)
            each = np.repeat(error, sizes) * values
            used, place = np.unique(columns, return_inverse=True)
            grad_w = np.bincount(place, each, minlength=len(used)).astype(np.float32) + l2 * model.weight[used]
            inner = each[:, None] * (np.repeat(sums, sizes, axis=0) - model.factor[columns] * values[:, None])
            grad_v = np.stack([np.bincount(place, inner[:, f], minlength=len(used)) for f in range(rank)], 1).astype(np.float32) + l2 * model.factor[used]
            square_w[used] += grad_w**2
            square_v[used] += grad_v**2
            square_b += float(error.sum()) ** 2
            model.weight[used] -= step * grad_w / np.sqrt(square_w[used])
            model.factor[used] -= step * grad_v / np.sqrt(square_v[used])
            model.bias -= step * float(error.sum()) / square_b**0.5
    return model


def quality_scores(
    documents: DataFrame, labels: DataFrame, label: str = "quality", metadata: tuple[str, ...] = ("n_chars",), parts: int = 3, held_out: int = 1, buckets: int = 1 << 15, sample: int = 6000
) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of documents (doc_id, text and the metadata columns)."""
    docs = documents.select("doc_id", "text", *(F.col(m).cast("double").alias(m) for m in metadata))
    width = buckets + BINS * (len(FEATURES) + len(metadata))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns, values, at = features(batch, buckets, metadata)
            ends = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([columns[a:b].tobytes() for a, b in ends], pa.binary()), pa.array([values[a:b].tobytes() for a, b in ends], pa.binary())],
                ["doc_id", "label", "columns", "values"],
            )

    chosen = learning_sample(docs, labels, label, parts, held_out, sample)
    learned = chosen.mapInArrow(vectors, f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, label int, columns binary, values binary")
    rows = sorted((r[0], bytes(r[2]), bytes(r[3]), r[1]) for r in learned.collect())  # of the bounded sample
    model = train([(np.frombuffer(c, np.int32), np.frombuffer(v, np.float32), y) for _, c, v, y in rows], width)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(*features(batch, buckets, metadata)).astype(float))], ["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = docs.mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(remainder("doc_id", parts) == held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
