"""Host and path rules over URLs, looked up in Bloom filter cascades instead of a join.

A rule is ``host/path`` with a verdict. It fits its host and all subdomains, if the path of the URL begins with the rule's;
of several that fit the longest decides (most characters, then the longer host), of none the default. So a URL has a few
possible keys: each trailing part of its host that has as many labels as some rule, before each beginning of its path that
is as long as some rule's. Together the keys of all URLs are the universe.

For each verdict a cascade answers "is this key listed" without error for every key of the universe:

1. Level 1 is a Bloom filter of the listed keys, sized so that about 0.7 false positives come with each listed key.
2. All keys of the universe are sent through it (a narrow pass; only what gets through is shuffled and made distinct).
   What gets through and is not listed is encoded by level 2; listed keys that pass level 2 are encoded by level 3, and so
   on, each level holding what the level before wrongly lets through, until nothing is.
3. A key leaves the cascade at the first level that does not hold it: a listed one at an even level, or never where their
   number is odd.

A look-up is a few bit tests in a narrow pass over the pages: no page is shuffled and no join is made, whatever the
host's share of the pages.

Scale: a cascade takes some ``1.44 * log2(universe / listed) + 6`` bits a listed key. Past ``max_bytes`` the keys are cut
into slices by hash, each with its own cascades and its own pass, so that a broadcast never grows with the lists. Rules
may be any number of rows; the driver holds the bits of one slice, and the shapes of rules (labels, path length).

Edge cases: a NULL url, or one without ``://``, has an empty host and path and the default verdict. Hosts are compared
with A-Z lowered, ports and user names are part of them, paths are compared as they are. Repeated rules count once; a rule
under both verdicts, another verdict, or a rule without a host is refused; NULL rules are ignored. Repeated pages are
judged alike. Without pages the result is empty, without rules all pages get the default. Columns named in ``carry`` stay
beside the result; others, whatever their names, are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.storage import settled
from vitrine.llm.text import mix

VERDICTS = ("allow", "block")
#: Levels shrink by half or more; so many are not needed unless two keys agree in 128 bits of hash.
MOST_LEVELS = 100


def lowered(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return lowered(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key), F.xxhash64(F.lit(1), key)]


class Level:
    """A Bloom filter: ``probes`` bits of ``size`` for each key, chosen by the key's two hashes and the level's number."""

    def __init__(self, number: int, keys: int, false_positives: float):
        self.number = number
        self.probes = max(1, round(math.log2(1 / false_positives)))
        self.size = 64 * math.ceil(max(1, keys) * self.probes / math.log(2) / 64)
        self.words = np.zeros(self.size // 64, np.uint64)

    def places(self, h1: np.ndarray, h2: np.ndarray) -> Iterator[np.ndarray]:
        at = mix(h1 + np.uint64((2 * self.number + 1) * 0x9E3779B97F4A7C15 % 2**64))
        step = mix(h2 ^ at) | np.uint64(1)
        for _ in range(self.probes):
            yield at % np.uint64(self.size)
            at = at + step

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.ones(len(h1), bool)
        for at in self.places(h1, h2):
            found &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def listed(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key is a listed one, by the level at which it leaves the cascade."""
    answer = np.zeros(len(h1), bool)
    inside = np.arange(len(h1))
    for number, level in enumerate(levels, 1):
        holds = level.holds(h1[inside], h2[inside])
        answer[inside[~holds]] = number % 2 == 0
        inside = inside[holds]
    answer[inside] = len(levels) % 2 == 1
    return answer


def _of(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _encode(keys: DataFrame, number: int, count: int, false_positives: float) -> Level:
    """The filter of all keys (h1, h2): bits are gathered to words in tasks, merged by Spark, and laid out by the driver."""
    level = Level(number, count, false_positives)

    def run(batches: Iterator[pa.RecordBatch], level: Level) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate([np.zeros(0, np.uint64), *level.places(_of(batch.column("h1")), _of(batch.column("h2")))])
            word, inverse = np.unique((at >> np.uint64(6)).astype(np.int64), return_inverse=True)
            bits = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(bits, inverse, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], ["word", "bits"])

    blank = Level(number, count, false_positives)
    blank.words = np.zeros(0, np.uint64)  # tasks need places only
    words = keys.select("h1", "h2").mapInArrow(partial(run, level=blank), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    level.words[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return level


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    """Keys that the filter holds, rightly or not."""
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.holds(_of(batch.column("h1")), _of(batch.column("h2")))))

    return keys.mapInArrow(run, keys.schema)


def cascade(members: DataFrame, universe: DataFrame, estimate: int) -> list[Level]:
    """The levels that tell ``members`` (key, h1, h2) from all other keys of ``universe``, of about ``estimate`` keys."""
    count = members.count()
    if not count:
        return []
    levels = [_encode(members, 1, count, min(0.5, max(1e-9, count / max(1, 2 * estimate))))]
    through = _passing(universe, levels[0]).distinct()
    inside, outside = members, settled(through.join(members.select("key"), "key", "left_anti"))
    while wrong := outside.count():
        if len(levels) == MOST_LEVELS:
            raise ValueError("keys of equal hashes cannot be told apart")
        levels.append(_encode(outside, len(levels) + 1, wrong, 0.5))
        inside, outside = outside, settled(_passing(inside, levels[-1]))
    return levels


def _keys(pages: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """Pages with the keys they may be listed under, the longest first."""
    if not shapes:
        return pages.withColumn("_keys", F.array().cast("array<string>"))
    labels = F.when(F.col("host") == "", 0).otherwise(F.size(F.split("host", r"\.")))
    known = F.array(*(F.struct(F.lit(a).alias("labels"), F.lit(b).alias("chars")) for a, b in shapes))
    fits = F.filter(known, lambda s: (s.labels <= F.col("_labels")) & (s.chars <= F.col("_chars")))

    def key(s: Column) -> Column:
        tail = F.array_join(F.slice(F.col("_parts"), F.col("_labels") - s.labels + 1, s.labels), ".")
        return F.struct((F.length(tail) + s.chars).alias("size"), F.length(tail).alias("host"), F.concat(tail, F.substring(F.col("path"), F.lit(1), s.chars)).alias("key"))

    ready = pages.withColumns({"_labels": labels, "_chars": F.length("path"), "_parts": F.split("host", r"\.")})
    return ready.withColumn("_keys", F.transform(F.sort_array(F.transform(fits, key), asc=False), lambda s: s.key)).drop("_labels", "_chars", "_parts")


def read_rules(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "rule string, verdict string")


def _settled_rules(rules: DataFrame) -> DataFrame:
    cut = F.instr("rule", "/")
    host = F.when(cut > 0, F.substring("rule", F.lit(1), cut - 1)).otherwise(F.col("rule"))
    path = F.when(cut > 0, F.substring(F.col("rule"), cut, F.length("rule"))).otherwise(F.lit(""))
    split = rules.where("rule is not null").select(lowered(host).alias("host"), path.alias("path"), "verdict")
    known = settled(split.select(F.concat("host", "path").alias("key"), "host", "path", "verdict").distinct())
    for wrong, why in ((known.where(~F.coalesce(F.col("verdict").isin(*VERDICTS), F.lit(False))), "verdict"), (known.where("host = ''"), "host"), (known.groupBy("key").count().where("count > 1"), "two verdicts")):
        if (row := wrong.first()) is not None:
            raise ValueError(f"rule {row['key']!r}: {why}")
    return known


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", carry: tuple[str, ...] = (), default: str = "allow", max_bytes: int = 16 << 20) -> DataFrame:
    """``carry`` columns of pages with host, path, rule (NULL if none fits) and verdict."""
    spark = pages.sparkSession
    names = {c: f"_carry{i}" for i, c in enumerate(carry)}
    split = pages.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    known = _settled_rules(rules)
    shapes = sorted({(r[0], r[1]) for r in known.select(F.size(F.split("host", r"\.")), F.length("path")).distinct().collect()})
    keyed = _keys(split, shapes)
    universe = keyed.select(F.explode("_keys").alias("key")).select("key", *(h.alias(n) for h, n in zip(_hashes(F.col("key")), ("h1", "h2"), strict=True)))
    members = settled(known.select("key", "verdict", *(h.alias(n) for h, n in zip(_hashes(F.col("key")), ("h1", "h2"), strict=True))))
    count = members.count()
    found = keyed.withColumns({"_at": F.lit(None).cast("int"), "_verdict": F.lit(None).cast("string")})
    if count:
        estimate = universe.agg(F.approx_count_distinct("h1")).first()[0] + count
        bits = count * (1.44 * math.log2(max(2, 2 * estimate / count)) + 6)
        slices = max(1, math.ceil(bits / 8 / max_bytes))
        whole = universe.union(members.select(*universe.columns))
        for number in range(slices):
            if number:  # so that a stage holds the cascades of one slice
                found = settled(found)
            here = F.pmod("h2", F.lit(slices)) == number
            lists = {v: cascade(members.where((F.col("verdict") == v) & here).select("key", "h1", "h2"), whole.where(here), estimate) for v in VERDICTS}
            found = _look_up(found, lists, slices, number)
    # element_at takes no notice of a NULL place where neither the array nor its entries can be NULL
    rule = F.when(F.col("_at").isNotNull(), F.element_at("_keys", F.col("_at") + 1))
    back = [F.col(n).alias(c) for c, n in names.items()]
    return found.select(*back, "host", "path", rule.alias("rule"), F.coalesce("_verdict", F.lit(default)).alias("verdict"))


def _look_up(pages: DataFrame, lists: dict[str, list[Level]], slices: int, number: int) -> DataFrame:
    """The place of the first listed key of each page and its verdict, where this slice has one before that found so far."""
    shared = pages.sparkSession.sparkContext.broadcast(lists)
    hashed = pages.withColumns({"_h0": F.transform("_keys", lambda k: _hashes(k)[0]), "_h1": F.transform("_keys", lambda k: _hashes(k)[1])})
    schema = pages.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("_h0")).to_numpy(zero_copy_only=False).astype(np.int64)
            h1, h2 = (_of(batch.column(c).flatten()) for c in ("_h0", "_h1"))
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            best = pc.fill_null(batch.column("_at"), 2**31 - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            verdict = batch.column("_verdict").to_pylist()
            mine = np.flatnonzero(h2.view(np.int64) % slices == number)
            for name, levels in shared.value.items():
                hit = mine[listed(levels, h1[mine], h2[mine])] if levels else mine[:0]
                first = np.full(len(sizes), 2**31 - 1)
                np.minimum.at(first, row[hit], place[hit])
                for i in np.flatnonzero(first < best).tolist():
                    best[i], verdict[i] = first[i], name
            at = pa.array(best.astype(np.int32), mask=best == 2**31 - 1)
            columns = {**{n: batch.column(n) for n in schema.names}, "_at": at, "_verdict": pa.array(verdict, pa.string())}
            yield pa.RecordBatch.from_arrays([columns[n] for n in schema.names], schema.names)

    return hashed.mapInArrow(run, T.StructType(list(schema)))
