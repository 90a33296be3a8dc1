"""Operators over texts against plain versions, and their edge rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import os
import platform
import random
import re
import subprocess
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from vitrine.llm import decontamination, near_dups, packing, robust_rules, suffix_dedup, text
from vitrine.llm.components import components
from vitrine.llm.text import Words, rolling, shingles, sliding, texts_of, words_of
from vitrine.operators.joins import lookup

LOWER = {i: i + 32 for i in range(65, 91)}
SPACES = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"wort{i}" for i in range(40_000))
#: NULL, empty, blank, tied, repeated and very long texts.
EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One  two"), (6, LONG), (7, LONG), (8, "é" * 300), (9, "x" * 1000), (10, "ab " * 400), (11, "�\x00 a b")]


def frame(spark, rows, schema="doc_id long, text string", parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def with_extras(df):
    """Extra columns whose names the operators use themselves."""
    for name in ("doc", "id", "n", "value", "codes", "grp", "kept", "spans", "n_words", "label", "host", "part", "p", "n_bytes"):
        df = df.withColumn(name, F.lit("x"))
    return df


# ---------------------------------------------------------------- helpers


def test_words_are_those_of_the_pattern_and_stay_in_their_text():
    texts = [None, "", " a", "b ", "a\tb\nc", "é é", "\x1fa\x85b", "w" * 9000 + " x", "A", "a"]
    for pattern, ends, lower in ((SPACES, None, False), (ALNUM, "alnum", True)):
        from vitrine.llm import text as module

        words = words_of(texts_of(pa.array(texts)), module.NON_ALNUM if ends else module.SPACE, lower)
        for i, t in enumerate(texts):
            want = pattern.findall((t or "").translate(LOWER) if lower else (t or ""))
            assert words.last[i] - words.first[i] == len(want)
        names = [w for t in texts for w in pattern.findall((t or "").translate(LOWER) if lower else (t or ""))]
        for a in range(len(names)):
            for b in range(a):
                assert (names[a] == names[b]) == (words.hash[a] == words.hash[b])


def test_rolling_and_sliding():
    buf = np.frombuffer(b"abcabcabd" * 9000, np.uint8)
    h = rolling(buf, 6)
    assert len(h) == len(buf) - 5 and h[0] == h[9] and h[0] != h[3] and len(rolling(buf[:3], 6)) == 0
    values = np.random.default_rng(1).integers(0, 50, 200)
    for width in (1, 2, 5, 51):
        assert sliding(values, width, np.minimum).tolist() == [values[i : i + width].min() for i in range(200 - width + 1)]
    w = Words(np.zeros(0), np.zeros(0), h[:10], np.array([0]), np.array([10]))
    assert shingles(w, 3)[1].tolist() == [True] * 8 + [False] * 2


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    random.Random(1).shuffle(links)
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200 + i: 200 for i in range(3)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- quality rules


def plain_counts(text):
    words = SPACES.findall(text or "")
    seen = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if SPACES.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def ordinary(n, seed=3, repeat=0.0):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randrange(2, 9))) for _ in range(900)]
    return [" ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", "."]) for _ in range(rng.randrange(40, 200))) for _ in range(n)]


def test_base_counts_of_edge_rows_and_repeats(spark):
    rows = EDGE + [(20, "a b c d e " * 5), (21, "l1\nl1\n\nl2\nl1"), (22, "## ** x|y <b>"), (4, "one two")]
    df = frame(spark, [(d, t, None, "s") for d, t in rows], "doc_id long, text string, lang string, source string")
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in robust_rules.robust_rules(with_extras(df)).collect())
    want = collections.Counter()
    for d, t in rows:
        c = plain_counts(t)
        want[(d, *c, c[0] < 10 or 100 * c[4] > 20 * c[0])] += 1
    assert got == want
    assert robust_rules.robust_rules(df.limit(0)).count() == 0 and robust_rules.keep_good(df.limit(0)).count() == 0


def test_outliers_go_and_ordinary_rows_stay(spark):
    good = ordinary(600)
    odd = [" ".join(w + "###" for w in t.split()) for t in ordinary(30, 8)] + [t.upper() for t in ordinary(30, 9)] + [" ".join(["zz"] + [w for w in t.split() for _ in range(4)]) for t in ordinary(20, 4)]
    rows = [(i, t, "en" if i % 3 else None, "s0") for i, t in enumerate(good + odd)]
    df = frame(spark, rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in robust_rules.robust_rules(df).where("kept").select("doc_id").collect()}
    assert len(kept & set(range(600))) >= 599 and not kept & set(range(600, len(rows)))
    again = with_extras(df)
    left = robust_rules.keep_good(again)
    assert left.columns == again.columns and {r.doc_id for r in left.collect()} == kept


def vectors_of(spark, groups):
    rows = [(lang, f"{lang}/{name}", *(int(v) for v in x)) for (lang, name), table in groups.items() for x in table]
    schema = ", ".join(["lang_grp string", "grp string", *(f"{f} long" for f in robust_rules.FEATURES)])
    return spark.createDataFrame(rows, schema).repartition(3)


def plain_mcd(x, share):
    """Centre and covariance of the inner share: four starts, each concentrated until its determinant stops falling."""
    n, floor = len(x), np.array(robust_rules.FLOOR, float)
    middle = np.median(x, 0)
    spread = np.maximum(1.4826 * np.median(np.abs(x - middle), 0), floor)
    z = (x - middle) / spread
    starts = [(middle, np.diag(spread**2))]
    for y in (np.tanh(z), z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)):
        r = 0.9 * np.corrcoef(y.T) + 0.1 * np.eye(len(floor))
        starts.append((middle, r * np.outer(spread, spread)))
    starts.append((x.mean(0), np.cov(x.T, bias=True)))
    best = (np.inf,)
    for c, v in starts:
        last, own = np.inf, None
        while True:
            bins = robust_rules._bins(np.einsum("ni,ij,nj->n", x - c, np.linalg.inv(robust_rules.regular(v)), x - c))
            inner = x[bins <= np.sort(bins)[int(np.ceil(share * n)) - 1]]
            c, v = inner.mean(0), np.cov(inner.T, bias=True)
            now = np.linalg.slogdet(robust_rules.regular(v))[1]
            if not now < last - 1e-9:
                break
            last, own = now, (c, v)
        best = min(best, (last, *own), key=lambda b: b[0])
    return best


@pytest.mark.parametrize("max_groups", [2000, 0])
def test_estimates_are_those_of_a_plain_search(spark, max_groups):
    """Groups of their own, groups that borrow from their language, and a language that borrows from all."""
    rng = np.random.default_rng(3)
    scale = 3 * np.array(robust_rules.FLOOR)
    cloud = lambda n, shift: np.rint(np.concatenate([rng.normal(shift, 1, (n, 10)), rng.normal(shift + 9, 0.3, (n // 6, 10))]) * scale + 5 * scale)
    groups = {("en", "a"): cloud(120, 0), ("en", "b"): cloud(90, 2), ("en", "c"): cloud(20, 1), ("de", "a"): cloud(25, 0)}
    estimates, n = robust_rules.fit(vectors_of(spark, groups), least_rows=60, max_groups=max_groups, finalists=4)
    got = {r.grp: r for r in estimates.collect()}
    assert n == len(got) == 4
    en = np.concatenate([groups["en", k] for k in "abc"])
    for grp, x in {"en/a": groups["en", "a"], "en/b": groups["en", "b"], "en/c": en, "de/a": np.concatenate([en, groups["de", "a"]])}.items():
        logdet, centre, cov = plain_mcd(x, 0.75)
        assert abs(got[grp].logdet - logdet) < 1e-6 and np.allclose(got[grp].centre, centre)
        assert np.allclose(np.array(got[grp].cov).reshape(10, 10), cov * robust_rules._consistency(0.75))


def test_estimate_is_the_least_of_all_shares(spark):
    """A group small enough to try each share of its rows: the determinant found is the least there is."""
    rng = np.random.default_rng(11)
    scale = 3 * np.array(robust_rules.FLOOR)
    x = np.rint(np.concatenate([rng.normal(0, 1, (12, 10)), rng.normal(8, 1, (4, 10))]) * scale + 20 * scale)
    logdet = lambda rows: np.linalg.slogdet(robust_rules.regular(np.cov(x[list(rows)].T, bias=True)))[1]
    best = min(itertools.combinations(range(16), 12), key=logdet)
    estimates, _ = robust_rules.fit(vectors_of(spark, {("en", "a"): x}), least_rows=10)
    (got,) = estimates.collect()
    assert set(best) == set(range(12)) and abs(got.logdet - logdet(best)) < 1e-6 and np.allclose(got.centre, x[:12].mean(0))


def test_quantiles_and_widening_are_those_of_a_normal_cloud():
    squared = np.sort(np.random.default_rng(7).chisquare(10, 400_000))
    for q in (0.5, 0.75, 0.99):
        assert abs(robust_rules.cutoff_of(q) - squared[int(q * len(squared))]) < 0.15
        assert abs(robust_rules._consistency(q) - 10 / squared[: int(q * len(squared))].mean()) < 0.01
    assert abs(robust_rules.cutoff_of(0.9999) - 35.564) < 1e-3


# ---------------------------------------------------------------- near-duplicates


def plain_components(rows, percent):
    sets = {}
    for d, t in rows:
        w = SPACES.findall((t or "").translate(LOWER))
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


@pytest.mark.parametrize(("percent", "tile"), [(85, 256), (80, 4)])
def test_near_duplicates_are_those_of_all_pairs(spark, percent, tile):
    rng = random.Random(percent)
    vocabulary = [f"w{i}" for i in range(500)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([2, 6, 40, 60, 80, 300]))] for _ in range(15)]
    rows = list(EDGE)
    for i in range(220):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((1000 + i, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dups.near_duplicates(with_extras(frame(spark, rows)), percent=percent, tile=tile).collect()}
    assert got == plain_components(rows, percent)


def test_near_duplicates_with_null_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(50))
    df = frame(spark, [(None, text), (3, text), (3, text), (3, "quite another text of more than five words"), (9, text), (2, "quite another text of more than five words")])
    got = sorted(tuple(r) for r in near_dups.near_duplicates(df).collect() if r.doc_id is not None)
    assert got == [(2, 4, 2, True), (3, 4, 2, False), (3, 46, 2, False), (3, 46, 2, False), (9, 46, 2, False)]
    assert [tuple(r)[1:] for r in near_dups.near_duplicates(df).where("doc_id is null").collect()] == [(46, None, True)]
    assert near_dups.near_duplicates(df.limit(0)).count() == 0


def test_ids_that_are_no_numbers(spark):
    rows = [("a", "one two three four five six seven eight nine ten"), ("b", "nothing")]
    docs = frame(spark, rows, "doc_id string, text string")
    with pytest.raises(TypeError, match="whole numbers"):
        near_dups.near_duplicates(docs)
    pieces = packing.pack(docs, TOKENIZER).collect()
    assert sorted(r.doc_id for r in pieces) == ["a", "b"]
    items = frame(spark, [("i10", rows[0][1]), ("i9", "three four five six seven eight nine ten one two"), (None, rows[0][1])], "item_id string, text string")
    found = decontamination.contamination(docs, items)
    assert {r.doc_id: r.item_ids for r in found.collect()} == {"a": ["i10"], "b": []}
    assert {r.doc_id: r.items_sha256 for r in decontamination.digest(found).collect()}["a"] == hashlib.sha256(b"i10").hexdigest()


def test_tiles_estimate_and_count_like_plain_sets():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 90, n)).astype(np.uint32) for n in (3, 5, 40, 60, 60, 80, 80, 200)]
    tile, k = near_dups.Tile(sets), 64
    plain = [set(x.tolist()) for x in sets]
    assert [[x for j, x in enumerate(row) if j != i] for i, row in enumerate(tile.overlaps().tolist())] == [[len(a & b) for j, b in enumerate(plain) if j != i] for i, a in enumerate(plain)]
    for lots in (1, 8, 500):
        share, size, whole = tile.estimates(k, lots)
        for i, a in enumerate(plain):
            for j, b in enumerate(plain):
                if i != j and whole[i, j]:
                    assert len(a | b) == size[i, j] <= k and share[i, j] == np.float32(len(a & b) / len(a | b))
                assert i == j or size[i, j] <= k and (lots < 500 or whole[i, j] or size[i, j] >= k - 2)
    links = rng.random((30, 30)) < 0.04
    links |= links.T
    label = near_dups.connected(links)
    for i in range(30):
        seen, todo = {i}, [i]
        while todo:
            todo += (new := set(np.flatnonzero(links[todo.pop()]).tolist()) - seen)
            seen |= new
        assert label[i] == min(seen)


@pytest.mark.parametrize("shape", ["copies", "chain", "families", "strangers", "few strangers"])
def test_long_groups_are_connected_in_rows_that_grow_with_their_members(spark, monkeypatch, shape):
    """Members in tiles of eight, linked by number, against all pairs; two keys of 400 and 30 members."""
    rng = random.Random(shape)
    place = {
        "copies": lambda d: 0,
        "chain": lambda d: d,
        "families": lambda d: 1000 * (d % 23) + rng.randrange(3),
        "strangers": lambda d: 1000 * d + (rng.randrange(40) == 0) * 1000,
        "few strangers": lambda d: 1000 * d if d % 40 == 0 else rng.randrange(2),
    }[shape]
    rows = [(key, -(-m // 8), d, place(d)) for key, m, first in ((7, 400, 0), (8, 30, 390)) for d in range(first, first + m)]
    index = spark.createDataFrame(rows, "grp long, blocks long, doc long, x long").repartition(3)

    def linked(table):
        assert table.num_rows <= 60
        x = table.column("x").to_numpy()
        return np.abs(x[:, None] - x[None, :]) <= 1

    dealt, work_off = [], near_dups._work_off
    monkeypatch.setattr(near_dups, "_work_off", lambda rows, *rest: (dealt.append(rows.count()), work_off(rows, *rest))[1])
    links = near_dups._links_within(index, "grp", lambda r: r, linked)
    got = {r.node: r.component for r in components(links).collect()}
    parent = {d: d for _, _, d, _ in rows}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for key in (7, 8):
        members = [(d, x) for k, _, d, x in rows if k == key]
        for i, (d, x) in enumerate(members):
            for e, y in members[:i]:
                if abs(x - y) <= 1:
                    a, b = root(d), root(e)
                    parent[max(a, b)] = min(a, b)
    assert {d: got.get(d, d) for d in parent} == {d: root(d) for d in parent}
    assert dealt[0] <= 2 * len(rows)
    if shape in ("copies", "few strangers"):
        assert sum(dealt) <= 6 * len(rows)


def test_hubs_are_split_in_the_joins_of_components(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {c: spark.conf.get(c, None) for c in small}
    for c, v in small.items():
        spark.conf.set(c, v)
    try:
        edges = spark.range(1, 60_000).select(F.col("id").alias("b"), F.when(F.col("id") < 30_000, 0).otherwise(F.col("id") - 1).alias("a"))
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        joined = lookup(edges, least, ["a"], "inner")
        assert joined.count() == 59_999
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


def test_a_passage_in_every_document_links_none(spark):
    rng = random.Random(5)
    passage = " ".join(f"common{i}" for i in range(30))
    rows = [(i, passage + " " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(80))) for i in range(300)]
    assert near_dups.near_duplicates(frame(spark, rows)).where("kept").count() == 300


# ---------------------------------------------------------------- repeated passages


def plain_repeats(rows, threshold=100):
    seen, out = set(), []
    for d, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - threshold + 1):
            w = data[p : p + threshold]
            if w in seen:
                gone[p : p + threshold] = b"\1" * threshold
            seen.add(w)
        spans = [(m.start(), m.end()) for m in re.finditer(rb"\x01+", bytes(gone))]
        out.append((d, len(data), sum(gone), len(spans), hashlib.sha256(bytes(x for x, g in zip(data, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("options", [{}, {"most_votes": 1, "fold_bytes": 3000}, {"fold_bytes": 300}])
def test_repeats_are_those_of_a_set_of_windows(spark, options):
    rng = random.Random(3)
    passages = ["".join(rng.choice("ab c") for _ in range(rng.choice([60, 100, 130, 300]))) for _ in range(6)]
    rows = [(i, "".join(rng.choice([*passages, "x" * rng.randrange(250), "abab" * rng.randrange(60), str(rng.random())]) for _ in range(rng.randrange(6)))) for i in range(150)]
    rows += [(1000 + i, rows[i % 50][1]) for i in range(60)] + [(2000 + d, t[:3000] if t else t) for d, t in EDGE]
    got = sorted(tuple(r) for r in suffix_dedup.digest(suffix_dedup.remove_repeats(with_extras(frame(spark, rows)), **options)).collect())
    assert got == sorted(plain_repeats(rows))


def test_repeats_with_other_thresholds_null_and_repeated_ids(spark):
    rows = [(7, "0123456789" * 3 + "tail of seven"), (None, "start " + "0123456789" * 2), (7, "another 0123456789"), (7, "another 0123456789")]
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    df = frame(spark, rows)
    for threshold in (9, 10, 13):
        got = collections.Counter(tuple(r) for r in suffix_dedup.digest(suffix_dedup.remove_repeats(df, threshold=threshold)).collect())
        assert got == collections.Counter(plain_repeats(order, threshold)), threshold
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_text_left_behind_has_no_broken_characters(spark):
    text = "é" * 120 + "a"
    got = {r.doc_id: r.kept for r in suffix_dedup.remove_repeats(frame(spark, [(1, text), (2, "b" + text + "c")]), as_text=True).collect()}
    assert got[2] == "bc" and set(got[1]) <= {"é", "a"}


# ---------------------------------------------------------------- decontamination


def plain_hits(documents, items, size=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i : i + size])].add(item)
    lengths = {len(w) for w in windows}
    out = collections.Counter()
    for d, text in documents:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        names = ",".join(sorted(str(x) for x in found if x is not None))
        out[(d, len(w), len(hit), len(found - {None}), hashlib.sha256(names.encode()).hexdigest(), bool(hit))] += 1
    return out


@pytest.mark.parametrize("broadcast_bytes", [16 << 20, 0])
def test_contamination_is_that_of_all_windows(spark, broadcast_bytes):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(12)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([12, 15, 40]))) for i in range(12)] + [(50, "w1 w2"), (51, "W3"), (52, "w4-w5, w6"), (53, None), (54, "..."), (55, "w1 w2"), (None, text(11)), (12, "é é é")]
    documents = [(i, text(rng.randrange(5, 300))) for i in range(60)]
    documents += [(100 + i, f"a b c {items[i % 12][1].upper()} d e") for i in range(24)] + EDGE[:6] + [(100, "é, É é! é")] * 2
    got = decontamination.digest(decontamination.contamination(with_extras(frame(spark, documents)), spark.createDataFrame(items, "item_id long, text string"), broadcast_bytes=broadcast_bytes, filter_bits=1 << 12))
    assert collections.Counter(tuple(r) for r in got.collect()) == plain_hits(documents, items)


def test_contamination_without_items_or_documents(spark):
    documents, items = frame(spark, EDGE[:5]), spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontamination.contamination(documents, items.limit(0)).where("size(spans) > 0").count() == 0
    assert decontamination.contamination(documents.limit(0), items).count() == 0


# ---------------------------------------------------------------- packing


def check_packing(rows, pieces, capacity):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = collections.Counter(tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for _, t in rows)
    by_sequence = collections.defaultdict(list)
    total = 0
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
        assert 0 < p.length <= capacity and p.start % capacity == 0
        total += p.length
    assert total == sum(len(ids) * n for ids, n in want.items())
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    crcs = collections.Counter()
    for ids, n in want.items():
        for at in range(0, len(ids), capacity):
            part = np.array(ids[at : at + capacity], "<u4")
            crcs[(at, len(part), zlib.crc32(part.tobytes()), len(ids))] += n
    assert crcs == collections.Counter((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces)
    return sum(capacity - sum(n for _, n in parts) for parts in by_sequence.values()), total


def test_pieces_hold_every_token_once(spark):
    rows = EDGE + [(4, "one two"), (None, "no id <|endoftext|> here")] + [(100 + i, t) for i, t in enumerate(ordinary(120))]
    for capacity in (1024, 64):
        pieces = packing.pack(with_extras(frame(spark, rows)), TOKENIZER, capacity=capacity).collect()
        slack, total = check_packing(rows, pieces, capacity)
        assert slack <= 0.02 * total + capacity
    assert packing.pack(frame(spark, rows).limit(0), TOKENIZER).count() == 0


def test_best_fill_is_the_best_of_all():
    rng = random.Random(1)
    for _ in range(300):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        capacity = rng.randrange(1, 70)
        sums = {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1)}
        used = packing.best_fill(counts, capacity)
        assert all(used[n] <= counts[n] for n in used)
        assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= capacity)


def test_plan_uses_every_length_as_often_as_it_occurs():
    histogram = {1: 5000, 7: 3, 500: 1000, 512: 17, 523: 999, 1023: 2}
    plan = packing.plan_windows(histogram, 1024)
    used = collections.Counter()
    for parts, times in plan:
        assert sum(n * k for n, k in parts.items()) <= 1024
        for n, k in parts.items():
            used[n] += k * times
    assert used == histogram and len(plan) < 50


def test_units_give_the_ids_of_whole_texts():
    units, rng = packing.Units(TOKENIZER), random.Random(1)
    alphabet = [" ", "  ", "\n", "\n\n", "\t", " ", "a", "B", "é", "中", "1", ".", ",", "'s", "'", "!!", "-", "<|endoftext|>", "\x1c", "\x85", "🙂", "ll", "́", "\r\n"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(25))) for _ in range(8000)]
    ids, ends = units.encode(texts_of(pa.array(texts)))
    low = 0
    for want, high in zip(units.tokenizer.encode_batch(texts, add_special_tokens=False), ends.tolist(), strict=True):
        assert ids[low:high].tolist() == want.ids
        low = high


# ---------------------------------------------------------------- pipeline


def test_stages_against_plain_versions(spark, tmp_path):
    bases = ordinary(260, 6)
    rng = random.Random(4)
    passage = " ".join(ordinary(1, 77)[0].split()[:30])
    item = " ".join(f"item{i}" for i in range(14))
    texts = list(bases)
    texts += [bases[i] for i in range(20)] + [bases[i].replace(bases[i].split()[9], "changed", 1) for i in range(20, 40)]
    texts += [t + "\n" + passage for t in ordinary(20, 12)] + [t + " " + item for t in ordinary(10, 13)] + ["short", None, ""]
    rows = [(i, t, rng.choice(["en", "de"]), "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("spans", F.lit("x"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    before, counts = docs, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        given = sorted(before.select("doc_id", "text").collect())
        kept = {r.doc_id: r for r in after.collect()}
        if name == "quality_rules":
            assert not {i for i in (len(texts) - 3, len(texts) - 2, len(texts) - 1)} & set(kept) and len(kept) >= len(texts) - 6
        if name == "near_duplicates":
            assert set(kept) == {d for d, x in plain_components(given, 80).items() if x[2]}
        if name == "repeated_passages":
            want = {d: h for d, _, _, _, h in plain_repeats(given)}
            assert all(hashlib.sha256(r.text.encode()).hexdigest() == want[d] and r.n_chars == len(r.text) for d, r in kept.items())
            assert sum(passage in r.text for r in kept.values()) <= 1
        if name == "benchmark_leaks":
            assert set(kept) == {x[0] for x in plain_hits(given, [(1, item)]) if not x[5]}
        if name == "packed_sequences":
            check_packing(given, after.collect(), 1024)
        else:
            assert after.columns == docs.columns
        counts.append(len(kept))
        before = after
    assert counts[0] > counts[1] >= counts[2] > counts[3]


def test_run_writes_and_reads_every_stage(spark, tmp_path):
    duckdb.sql(f"copy (select * from '/root/testdata/sf0.001/documents.parquet') to '{tmp_path}/documents.parquet'")
    duckdb.sql(f"copy (select * from '/root/testdata/sf0.001/benchmark.parquet') to '{tmp_path}/benchmark.parquet'")
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


HELD = """
import re
import pyarrow as pa
from vitrine.llm.near_dups import sketch

def used():
    return sum(int(x) for x in re.findall("Pss_Anon: +([0-9]+)", open("/proc/self/smaps_rollup").read())) >> 10

def batches():
    words = " ".join(f"w{i}" for i in range(400))
    for k in range(6):
        yield pa.RecordBatch.from_arrays([pa.array(range(6000)), pa.array([f"{k} {i} {words}" for i in range(6000)])], ["doc", "text"])

for _ in range(2):
    rows = sum(out.num_rows for out in sketch(5, 64)(batches()))
after = used()
pa.default_memory_pool().release_unused()
print(rows, after - used())
"""


def test_a_worker_gives_back_the_room_of_its_batches():
    """A Python worker outlives its tasks; Arrow's pool does not keep the largest batches of each."""
    if not os.path.exists("/proc/self/smaps_rollup"):
        pytest.skip("needs /proc")
    out = subprocess.run([sys.executable, "-c", HELD], cwd=os.path.dirname(corpus_pipeline.__file__), capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) == 36000 and int(out[1]) < 20, out


GIVEN_BACK = """
import ctypes, gc, random, re, sys
import pyarrow as pa
from vitrine.llm import near_dups, packing, robust_rules, text

def used():
    return sum(int(x) for x in re.findall("Pss_Anon: +([0-9]+)", open("/proc/self/smaps_rollup").read())) >> 10

def batches():
    pick = random.Random(5)
    words = [f"w{pick.randrange(10**5)}" for _ in range(10**5)]
    for k in range(3):
        at = [pick.randrange(90_000) for _ in range(8000)]
        texts = [" ".join(words[i : i + pick.randrange(20, 900)]) for i in at]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(texts)], ["doc", "text"])

def statistics(batches):
    for batch in text.slices(batches):
        robust_rules.statistics(text.texts_of(batch.column("text")))
        yield batch

task = {"sketch": near_dups.sketch(5, 64), "statistics": statistics, "pieces": packing.cut_pieces(sys.argv[2], 1024, 0)}[sys.argv[1]]
rows = sum(out.num_rows for out in task(batches()))
after = used()
gc.collect()
ctypes.CDLL(None).malloc_trim(0)
print(rows, after - used())
"""


@pytest.mark.parametrize("task", ["sketch", "statistics", "pieces"])
def test_a_worker_gives_back_the_room_of_its_arrays(task):
    """NumPy's arrays come from the C library, which does not keep for an idle worker what a task has freed."""
    if not os.path.exists("/proc/self/smaps_rollup") or platform.libc_ver()[0] != "glibc":
        pytest.skip("needs /proc and GNU's C library")
    here = os.path.dirname(corpus_pipeline.__file__)
    out = subprocess.run([sys.executable, "-c", GIVEN_BACK, task, TOKENIZER], cwd=here, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= 24000 and int(out[1]) < 40, out


def test_a_task_of_another_kind_drops_what_packing_keeps():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some words of a text", None])], ["doc", "text"])
    cut = packing.cut_pieces(TOKENIZER, 1024, 0)
    first = [x.to_pydict() for x in cut(iter([batch]))]
    units = text.kept[TOKENIZER]
    assert [x.to_pydict() for x in cut(iter([batch]))] == first and text.kept[TOKENIZER] is units  # the next task of its kind goes on with them
    mixed = cut(near_dups_then(batch))  # even while it runs
    assert [x.to_pydict() for x in mixed] == first
    list(near_dups.sketch(5, 64)(iter([batch])))
    assert not text.kept


def near_dups_then(batch):
    list(near_dups.sketch(5, 64)(iter([batch])))
    yield batch
