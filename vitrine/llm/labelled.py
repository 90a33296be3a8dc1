"""Labelled rows for the classifiers: a bounded sample to learn from, and which rows are held out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def remainder(doc_id: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def learning_sample(documents: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents that are not held out, a row each, with ``label``.

    Labels are 0 or 1, one for each id (the larger, should an id have several). Which of more than ``rows`` labels are taken
    depends on a hash of the id alone. The sample's ids, and they alone, are broadcast. Of several rows of an id the one with the
    least hash of the other columns stands for it; a task sends one row per id however many copies it read. Ids are numbers of any
    width, or texts, in both tables alike; numbers against texts are refused.
    """
    kinds = [d.schema["doc_id"].dataType for d in (documents, labels)]
    if isinstance(kinds[0], T.NumericType) != isinstance(kinds[1], T.NumericType):
        raise TypeError(f"doc_id: {kinds[0].simpleString()} in documents against {kinds[1].simpleString()} in labels")
    wanted = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", parts) != held_out))
    wanted = wanted.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    some = wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()  # at most ``rows`` pairs of numbers
    table = documents.sparkSession.createDataFrame([(r[0], r[1]) for r in some], f"doc_id {kinds[1].simpleString()}, label int")
    others = [c for c in documents.columns if c != "doc_id"]
    least = F.min(F.struct(F.xxhash64(*others).alias("hash"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(others))))
    one = documents.join(F.broadcast(table), "doc_id").groupBy("doc_id", "label").agg(least.alias("least"))
    return one.select("doc_id", *(F.col(f"least.c{k}").alias(c) for k, c in enumerate(others)), "label")
