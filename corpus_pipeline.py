"""From raw documents to training sequences: rules, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes the documents that the stage before it kept and returns those that it keeps, with the columns of
documents; the last one returns packed pieces. Rows with the same id are one document to the stages that compare documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import decontamination, near_dups, packing, robust_rules, suffix_dedup
from vitrine.llm.storage import new_folder, release

TOKENIZER = "byte_bpe_50k.json"


def _aside(docs: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """Documents with all columns but the ``used`` ones under names that no operator has, and those names."""
    names = {c: f"_aside_{i}" for i, c in enumerate(docs.columns) if c not in used}
    return docs.select(*used, *(F.col(f"`{c}`").alias(n) for c, n in names.items())), names


def _back(docs: DataFrame, names: dict[str, str], columns: list[str]) -> DataFrame:
    return docs.select(*(F.col(names.get(c, c)).alias(c) for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return robust_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id. Documents without an id stay."""
    found = near_dups.near_duplicates(docs, percent=80)
    copies = found.where("not kept").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 100 bytes and more that start earlier; documents of which nothing is left go."""
    rows, names = _aside(docs, ("doc_id", "text"))
    found = suffix_dedup.remove_repeats(rows, carry=tuple(names.values()), as_text=True).withColumnRenamed("kept", "text")
    left = found.where((F.size("spans") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in names:
        left = left.withColumn(names["n_chars"], F.length("text").cast(docs.schema["n_chars"].dataType))
    return _back(left, names, docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, names = _aside(docs.withColumn("_text", F.col("text")), ("doc_id", "text"))
    found = decontamination.contamination(rows, benchmark, carry=tuple(names.values()))
    return _back(found.where(F.size("spans") == 0), names | {"text": names["_text"]}, docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packed_sequences", packed_sequences),
]

#: Robust estimates and tokenizing are no SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        release(spark)
        docs = spark.read.parquet(out)
    return docs
