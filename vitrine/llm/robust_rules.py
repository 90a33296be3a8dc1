"""Quality rules: text statistics, fixed base rules, and robust multivariate outliers per language and source.

Every text becomes a vector of transformed statistics. For each (language, source) the minimum-covariance-determinant
estimate of centre and covariance is sought among the shares of ``kept_share`` of the group's rows:

* four starts: medians with scaled deviations; the same with the correlations of squashed deviations, and with those of
  their directions; mean and covariance of all rows;
* concentration steps: the rows with the smallest Mahalanobis distances give the next centre and covariance, whose
  determinant is not greater. After ``trials`` steps the ``finalists`` with the least determinants go on, each until its
  determinant stops falling (at most ``most_steps``); the least of all is kept.

A variance below the square of FLOOR is raised to it: many statistics do not vary at all in the inner share. The estimate is
widened by what the inner share of a normal cloud lacks, and a text is rejected when its squared distance is beyond the
``quantile`` of the chi-square distribution with ``len(FEATURES)`` degrees of freedom.

Scale: one pass over the texts makes vectors of whole numbers (thousandths); all later passes read those. A group's sums
are partially aggregated in every task, so a group holding a third of all rows costs no more than any other. Sums are
exact whole numbers and quantiles are read off counted bins, so the result does not depend on the order of rows. Estimates
stay in DataFrames, one row for each group and start; the driver sees counts of groups alone. Rows meet the estimates by a
broadcast while there are at most ``max_groups`` groups (about 1 kB each), else by a join by shuffle that can split hot groups.

Groups with fewer than ``least_rows`` rows use the estimate of their language, and languages with fewer that of all rows.

Edge cases: NULL and empty texts have no words and fail the base rules; NULL language or source is a group of its own;
repeated rows count as often as they come; an empty table gives an empty result; other columns are passed by.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.storage import settled
from vitrine.llm.text import SPACE, Texts, returning, shingles, slices, texts_of, words_of
from vitrine.operators.joins import lookup

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[list(b".,;:!?")] = True
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Transformed statistics, in thousandths.
FEATURES = ["f_length", "f_word", "f_symbol", "f_repeat", "f_line", "f_upper", "f_punct", "f_digit", "f_variety", "f_stutter"]
#: The least spread of each statistic, in thousandths: where the inner rows vary less, as where they do not vary at all.
FLOOR = [700, 500, 60, 120, 200, 60, 80, 150, 35, 90]


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(b > 0, a / np.maximum(b, 1), 0.0)


def statistics(texts: Texts) -> dict[str, np.ndarray]:
    """COUNTS and FEATURES of each text."""
    n = len(texts)
    words = words_of(texts)
    own = words.text
    per_text = lambda at: np.diff(np.searchsorted(at, np.append(texts.start, len(texts.buf))))
    n_words = words.last - words.first
    letter = np.flatnonzero((texts.buf & 0xC0) != 0x80)
    blank = np.flatnonzero(SPACE[texts.buf])
    chars = per_text(letter) - per_text(blank)
    # words inside 5-word windows that the text holds at least twice
    hashes, inside = shingles(words, 5)
    at = np.flatnonzero(inside)
    repeated = np.zeros(len(words.hash), bool)
    if len(at):
        order = at[np.lexsort((hashes[at], own[at]))]
        same = (hashes[order][1:] == hashes[order][:-1]) & (own[order][1:] == own[order][:-1])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        for j in range(5):
            repeated[order[twice] + j] = True
    n_repeat = np.bincount(own[repeated], minlength=n)
    # different words of each text
    order = np.lexsort((words.hash, own))
    first = np.ones(len(order), bool)
    first[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (own[order][1:] != own[order][:-1])
    n_distinct = np.bincount(own[order[first]], minlength=n)
    same = np.flatnonzero((words.hash[1:] == words.hash[:-1]) & (own[1:] == own[:-1]))
    n_stutter = np.bincount(own[same], minlength=n)
    dup_lines, lines = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        held: set[bytes] = set()
        for line in texts.bytes_of(i).split(b"\n"):
            if line.strip(b" \t\n\v\f\r"):
                lines[i] += 1
                if line in held:
                    dup_lines[i] += 1
                held.add(line)
    count = lambda table: per_text(np.flatnonzero(table[texts.buf]))
    symbols, upper, punct, digit = count(SYMBOLS), count(UPPER), count(PUNCTUATION), count(DIGIT)
    out = {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": n_repeat}
    milli = lambda x: np.rint(1000 * x).astype(np.int64)
    out |= {
        "f_length": milli(np.log1p(n_words)),
        "f_word": milli(np.sqrt(_ratio(chars, n_words))),
        "f_symbol": milli(np.sqrt(_ratio(symbols, n_words))),
        "f_repeat": milli(np.sqrt(_ratio(n_repeat, n_words))),
        "f_line": milli(np.sqrt(_ratio(dup_lines, lines))),
        "f_upper": milli(np.sqrt(_ratio(upper, chars))),
        "f_punct": milli(np.sqrt(_ratio(punct, n_words))),
        "f_digit": milli(np.sqrt(_ratio(digit, chars))),
        # what the variety of words lacks of what a text of that length has (Herdan's C)
        "f_variety": milli(_ratio(np.log1p(n_distinct), np.log1p(n_words))),
        "f_stutter": milli(np.sqrt(_ratio(n_stutter, n_words))),
    }
    return out


def text_statistics(documents: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` of documents, with COUNTS and FEATURES of the whole text of each row."""
    columns = documents.select(*keep, F.col(text).alias("text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema if f.name in keep), *(f"{c} long" for c in [*COUNTS, *FEATURES])])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = statistics(texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *(pa.array(got[c].astype(np.int64)) for c in [*COUNTS, *FEATURES])], [*keep, *COUNTS, *FEATURES]
            )

    return columns.mapInArrow(measure, schema)


BINS = 64  # bins of a doubling of the squared distance
_D = len(FEATURES)
_PAIRS = [(i, j) for i in range(_D) for j in range(i, _D)]
#: A group's estimate, and the bin of the distance up to which a row belongs to its inner share.
_PARAMETERS = "p struct<centre:array<double>,inverse:array<double>,most:long>"


def _values(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES], 1).astype(np.int64)


def _distances(values: np.ndarray, estimates: pa.StructArray) -> np.ndarray:
    """Squared Mahalanobis distances of rows to the estimates they carry; NaN for rows without one."""
    known = estimates.is_valid().to_numpy(zero_copy_only=False)
    out = np.full(len(values), np.nan)
    if known.any():
        own = estimates.filter(pa.array(known))
        centre = own.field("centre").flatten().to_numpy(zero_copy_only=False).reshape(-1, _D)
        inverse = own.field("inverse").flatten().to_numpy(zero_copy_only=False).reshape(-1, _D, _D)
        diff = values[known] - centre
        out[known] = np.maximum(np.einsum("ni,nij,nj->n", diff, inverse, diff), 0.0)
    return out


def _bins(distance: np.ndarray) -> np.ndarray:
    return np.floor(BINS * np.log2(distance + 1e-3)).astype(np.int64)


def _count_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each estimate (``key``) and bin, a row for each batch."""
    for batch in returning(batches):
        if batch.num_rows:
            key = batch.column("key").dictionary_encode()
            code, n = np.unique(np.stack([key.indices.to_numpy(), _bins(_distances(_values(batch), batch.column("p")))]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([key.dictionary.take(pa.array(code[0])), pa.array(code[1]), pa.array(n)], ["key", "bin", "n"])


def _summed(keys: pa.DictionaryArray, values: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """Exact sums over the chosen rows of each key: their number, the values, and products of two values."""
    code, values = keys.indices.to_numpy()[rows], values[rows]
    terms = np.concatenate([np.ones((len(values), 1), np.int64), values, *(values[:, [i]] * values[:, [j]] for i, j in _PAIRS)], 1)
    order = np.argsort(code, kind="stable")
    some, at = np.unique(code[order], return_index=True)
    sums = np.add.reduceat(terms[order], at, axis=0) if len(some) else terms[:0]
    k = np.tile(np.arange(terms.shape[1]), len(some))
    return pa.RecordBatch.from_arrays([keys.dictionary.take(pa.array(np.repeat(some, terms.shape[1]))), pa.array(k), pa.array(sums.ravel())], ["key", "k", "total"])


def _sum_inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows that lie in the inner share of an estimate."""
    for batch in returning(batches):
        if batch.num_rows:
            values = _values(batch)
            inner = _bins(_distances(values, batch.column("p"))) <= batch.column("p").field("most").to_numpy(zero_copy_only=False)
            yield _summed(batch.column("key").dictionary_encode(), values, inner)


_MICRO = 10**6


def _sum_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of all rows: deviations squashed (start 1), their directions (2), both in millionths, and the rows as they are (3)."""
    for batch in returning(batches):
        if not batch.num_rows:
            continue
        values = _values(batch)
        arrays = [batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, _D) for c in ("middle", "spread")]
        z = (values - arrays[0]) / arrays[1]
        length = np.linalg.norm(z, axis=1, keepdims=True)
        micro = lambda x: np.rint(_MICRO * x).astype(np.int64)
        every = np.ones(len(values), bool)
        pool = batch.column("pool").to_pylist()
        for start, y in ((1, micro(np.tanh(z))), (2, micro(z / np.maximum(length, 1e-9))), (3, values)):
            yield _summed(pa.array([f"{x}/{start}" for x in pool]).dictionary_encode(), y, every)


_SUMS = "key string, k long, total long"
_ESTIMATE = "centre array<double>, cov array<double>, inverse array<double>, logdet double"


def _moments(sums: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    t = {int(k): int(total) for k, total in zip(sums["k"], sums["total"], strict=True)}
    n = t[0]
    centre = np.array([t[1 + i] / n for i in range(_D)])
    cov = np.zeros((_D, _D))
    for k, (i, j) in enumerate(_PAIRS):  # whole numbers up to the one division
        cov[i, j] = cov[j, i] = (n * t[1 + _D + k] - t[1 + i] * t[1 + j]) / (n * n)
    return centre, cov


def regular(cov: np.ndarray) -> np.ndarray:
    """Variances below the square of FLOOR are raised to it, and correlations drawn in by a thousandth."""
    out = 0.999 * cov
    out[np.diag_indices(_D)] = np.maximum(np.diag(cov), np.square(np.array(FLOOR, float)))
    return out


def _row(key: str, centre: np.ndarray, cov: np.ndarray, logdet: float | None = None) -> dict:
    used = regular(cov)
    logdet = float(np.linalg.slogdet(used)[1]) if logdet is None else logdet
    return {"key": key, "centre": centre.tolist(), "cov": cov.ravel().tolist(), "inverse": np.linalg.inv(used).ravel().tolist(), "logdet": logdet}


def _estimate(sums: pd.DataFrame) -> pd.DataFrame:
    """The next estimate, from the sums over the inner share of the one before."""
    return pd.DataFrame([_row(sums["key"].iloc[0], *_moments(sums))])


def _start(sums: pd.DataFrame) -> pd.DataFrame:
    """A start, from the sums over all rows. Its determinant says nothing yet."""
    key = sums["key"].iloc[0]
    centre, cov = _moments(sums)
    if not key.endswith("/3"):
        scale = np.sqrt(np.maximum(np.diag(cov), 1.0))
        spread = np.array(sums["spread"].iloc[0], float)
        alike = 0.9 * cov / np.outer(scale, scale)
        alike[np.diag_indices(_D)] = 1.0
        centre, cov = np.array(sums["middle"].iloc[0], float), alike * np.outer(spread, spread)
    return pd.DataFrame([_row(key, centre, cov, math.inf)])


def _joined(rows: DataFrame, table: DataFrame, on: str, groups: int, max_groups: int, how: str = "inner") -> DataFrame:
    return rows.join(F.broadcast(table), on, how) if groups <= max_groups else lookup(rows, table, [on], how)


def _pools(vectors: DataFrame, least_rows: int) -> DataFrame:
    """For each ``grp`` the pool whose estimate it uses, and all ``pools`` that its rows count for."""
    counted = settled(vectors.groupBy("grp", "lang_grp").agg(F.count("*").alias("n")))
    small = F.col("n") < least_rows
    by_lang = counted.groupBy("lang_grp").agg(F.sum("n").alias("in_lang"), F.max(small).alias("asked"))
    whole = by_lang.agg(F.max(F.col("asked") & (F.col("in_lang") < least_rows))).first()[0]
    known = lookup(counted, by_lang, ["lang_grp"])
    enough = F.col("in_lang") >= least_rows
    own, lang, every = F.col("grp"), F.col("lang_grp"), F.lit("*")
    pools = F.array(F.when(~small, own), F.when(F.col("asked") & enough, lang), every if whole else F.lit(None))
    return settled(known.select("grp", F.when(~small, own).when(enough, lang).otherwise(every).alias("pool"), F.array_compact(pools).alias("pools")))


def fit(
    vectors: DataFrame, kept_share: float = 0.75, least_rows: int = 200, max_groups: int = 2000, trials: int = 1, finalists: int = 2, most_steps: int = 30
) -> tuple[DataFrame, int]:
    """Robust ``centre`` and ``cov`` (by rows) for each ``grp``, with its ``logdet`` (of the inner share) and ``p`` for distances; and
    the number of groups.

    ``vectors`` has ``grp`` (language and source), ``lang_grp`` and FEATURES. Small groups borrow from larger ones.
    """
    pools = _pools(vectors, least_rows)
    groups = pools.count()
    rows = _joined(vectors.select("grp", *FEATURES), pools.select("grp", "pools"), "grp", groups, max_groups)
    rows = rows.select(F.explode("pools").alias("pool"), *FEATURES)
    if groups > max_groups:
        rows = settled(rows)
    median = rows.groupBy("pool").agg(*(F.percentile(f, 0.5).alias(f"m_{f}") for f in FEATURES))
    away = (F.percentile(F.abs(F.col(f) - F.col(f"m_{f}")), 0.5) for f in FEATURES)
    middle = settled(
        _joined(rows, median, "pool", groups, max_groups)
        .groupBy("pool")
        .agg(
            F.array(*(F.first(f"m_{f}").cast("double") for f in FEATURES)).alias("middle"),
            F.array(*(F.greatest(1.4826 * x, F.lit(float(least))) for x, least in zip(away, FLOOR, strict=True))).alias("spread"),
        )
    )
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    pool_of = lambda key: F.expr(f"left({key}, length({key}) - 2)")
    sums = _joined(rows, middle, "pool", groups, max_groups).mapInArrow(_sum_starts, _SUMS).groupBy("key", "k").agg(total)
    drawn = lookup(sums.withColumn("pool", pool_of("key")), middle, ["pool"]).groupBy("key").applyInPandas(_start, f"key string, {_ESTIMATE}")

    def plain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [_row(f"{g}/0", np.array(m, float), np.diag(np.square(np.array(s, float))), math.inf) for g, m, s in zip(pdf["pool"], pdf["middle"], pdf["spread"], strict=True)]
            yield pd.DataFrame(found, columns=["key", "centre", "cov", "inverse", "logdet"])

    state = settled(middle.mapInPandas(plain, f"key string, {_ESTIMATE}").unionByName(drawn).withColumn("open", F.lit(True)))
    for step in range(most_steps):
        table = state.where("open").select(pool_of("key").alias("pool"), "key", "centre", "inverse")
        met = _joined(rows, table.select("pool", "key", F.struct("centre", "inverse").alias("p")), "pool", groups, max_groups)
        bins = met.mapInArrow(_count_bins, "key string, bin long, n long").groupBy("key", "bin").agg(F.sum("n").alias("n"))
        over = Window.partitionBy("key")
        upto = bins.select("key", "bin", F.sum("n").over(over.orderBy("bin")).alias("upto"), F.sum("n").over(over).alias("all"))
        cut = upto.where(F.col("upto") >= F.ceil(kept_share * F.col("all"))).groupBy("key").agg(F.min("bin").alias("most"))
        inner = table.join(cut, "key").select("pool", "key", F.struct("centre", "inverse", "most").alias("p"))
        sums = _joined(rows, inner, "pool", groups, max_groups).mapInArrow(_sum_inner, _SUMS).groupBy("key", "k").agg(total)
        moved = sums.groupBy("key").applyInPandas(_estimate, f"key string, {_ESTIMATE}").withColumnsRenamed({c: f"new_{c}" for c in ("centre", "cov", "inverse", "logdet")})
        fell = F.coalesce(F.col("open") & (F.col("new_logdet") < F.col("logdet") - 1e-9), F.lit(False))
        state = state.join(moved, "key", "left").select(
            "key", *(F.when(fell, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in ("centre", "cov", "inverse", "logdet")), fell.alias("open")
        )
        if step + 1 == trials:
            place = F.row_number().over(Window.partitionBy(pool_of("key")).orderBy("logdet", "key"))  # four rows a pool
            state = state.withColumn("place", place).where(F.col("place") <= finalists).drop("place")
        state = settled(state)
        if not state.where("open").take(1):
            break
    widen = _consistency(kept_share)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [_row(g, np.array(c, float), widen * np.array(v, float).reshape(_D, _D), d) for g, c, v, d in zip(pdf["pool"], pdf["centre"], pdf["cov"], pdf["logdet"], strict=True)]
            yield pd.DataFrame(out, columns=["key", "centre", "cov", "inverse", "logdet"])

    least = state.groupBy(pool_of("key").alias("pool")).agg(F.min(F.struct("logdet", "key", "centre", "cov")).alias("b")).select("pool", "b.centre", "b.cov", "b.logdet")
    final = least.mapInPandas(finish, f"key string, {_ESTIMATE}").withColumnRenamed("key", "pool")
    found = lookup(pools.select("grp", "pool"), final, ["pool"], "inner")
    p = F.struct("centre", "inverse", F.lit(None).cast("long").alias("most")).alias("p")
    return settled(found.select("grp", "centre", "cov", "logdet", p)), groups


def chi_square(x: float, freedom: int) -> float:
    """The share of a chi-square distribution up to x; an even number of degrees of freedom has a closed form."""
    return 1.0 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))


def cutoff_of(quantile: float) -> float:
    """The squared distance up to which that share of a normal cloud lies, by bisection."""
    low, high = 0.0, 400.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, _D) < quantile else (low, middle)
    return high


def _consistency(share: float) -> float:
    """By how much the inner ``share`` of a normal cloud understates its covariance."""
    return share / chi_square(cutoff_of(share), _D + 2)


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in returning(batches):
        if batch.num_rows:
            distance = _distances(_values(batch), batch.column("p"))
            names = [c for c in batch.schema.names if c != "p"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(distance, from_pandas=True)], [*names, "distance"])


def _groups(rows: DataFrame, lang: str, source: str) -> DataFrame:
    """Rows with the names of their language and of their language and source; NULL is a name of its own."""
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    return rows.withColumn("lang_grp", F.concat(F.lit("lang "), key(lang))).withColumn("grp", F.concat_ws(" ", "lang_grp", F.lit("source"), key(source)))


def _prepared(documents: DataFrame, text: str, keep: list[str], lang: str, source: str) -> tuple[DataFrame, list[str]]:
    """COUNTS and FEATURES of all rows, with their groups and the columns ``keep`` under names of our own."""
    names = [f"_in_{i}" for i in range(len(keep))]
    renamed = documents.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)), F.col(f"`{lang}`").alias("_lang"), F.col(f"`{source}`").alias("_source"), F.col(text).alias("text"))
    measured = text_statistics(renamed, "text", (*names, "_lang", "_source"))
    return _groups(measured, "_lang", "_source").drop("_lang", "_source"), names


def _judged(vectors: DataFrame, names: list[str], keep: list[str], estimates: DataFrame, groups: int, cutoff: float, max_groups: int) -> DataFrame:
    joined = _joined(vectors, estimates.select("grp", "p"), "grp", groups, max_groups, "left")
    columns = [*names, *COUNTS, *FEATURES, "p"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.select(*columns[:-1]).schema), "distance double"])
    scored = joined.select(*columns).mapInArrow(_score, schema)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.select(
        *(F.col(n).alias(c) for n, c in zip(names, keep, strict=True)),
        *COUNTS,
        base.alias("base_failed"),
        "distance",
        (~base & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"),
    )


def robust_rules(
    documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", quantile: float = 0.9999, kept_share: float = 0.75, least_rows: int = 200, max_groups: int = 2000
) -> DataFrame:
    """All columns of documents but the text, with COUNTS, ``base_failed``, ``distance`` (squared) and ``kept``.

    A column of documents that is named like one of these gives way to it.
    """
    keep = [c for c in documents.columns if c not in (text, *COUNTS, "base_failed", "distance", "kept")]
    prepared, names = _prepared(documents, text, keep, lang, source)
    vectors = settled(prepared)
    estimates, groups = fit(vectors.where("n_words > 0"), kept_share, least_rows, max_groups)
    return _judged(vectors, names, keep, estimates, groups, cutoff_of(quantile), max_groups)


def keep_good(
    documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", quantile: float = 0.9999, kept_share: float = 0.75, least_rows: int = 200, max_groups: int = 2000
) -> DataFrame:
    """The rows of documents that the rules keep. Texts are measured again in the pass that filters them, not shuffled."""
    thin, _ = _prepared(documents, text, [], lang, source)
    estimates, groups = fit(settled(thin).where("n_words > 0"), kept_share, least_rows, max_groups)
    names = {c: f"_in_{i}" for i, c in enumerate(documents.columns)}
    cutoff = cutoff_of(quantile)
    rows = documents.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    grouped = _groups(rows, names[lang], names[source]).drop("lang_grp")
    joined = _joined(grouped, estimates.select("grp", "p"), "grp", groups, max_groups, "left").drop("grp")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, names[text]):
            got = statistics(texts_of(batch.column(names[text])))
            distance = _distances(np.stack([got[f] for f in FEATURES], 1), batch.column("p"))
            good = (got["n_words"] >= 10) & (100 * got["n_repeat_words"] <= 20 * got["n_words"]) & (np.nan_to_num(distance) <= cutoff)
            yield batch.select(list(names.values())).filter(pa.array(good))

    kept = joined.mapInArrow(sift, rows.schema)
    return kept.select(*(F.col(n).alias(c) for c, n in names.items()))
