"""The Merkle manifest, URL rules and periodic runs against plain versions, and their edge rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import merkle, periodic, queries, url_rules

FIELDS = queries.LEAF_FIELDS
DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- Merkle manifest


def plain_leaf(row: dict) -> str:
    return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def plain_way(nodes: list[str], place: int, fanout: int) -> tuple[str, list[tuple[list[str], list[str]]]]:
    way = []
    while len(nodes) > 1:
        start = place // fanout * fanout
        way.append((nodes[start:place], nodes[place + 1 : start + fanout]))
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        place //= fanout
    return nodes[0], way


def plain_manifest(rows: list[dict], fanout: int) -> list[tuple]:
    groups: dict[bytes, list] = {}
    for row in rows:
        groups.setdefault(b"" if row["lang"] is None else b"=" + row["lang"].encode(), []).append(row)
    names = sorted(groups)
    first = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r))
    ordered = [sorted(groups[n], key=first) for n in names]
    leaves = [[plain_leaf(r) for r in group] for group in ordered]
    subroots = [plain_way(group, 0, fanout)[0] for group in leaves]
    out = []
    for g, group in enumerate(ordered):
        root, upper = plain_way(subroots, g, fanout)
        for i, row in enumerate(group):
            subroot, lower = plain_way(leaves[g], i, fanout)
            way = lower + upper
            changed = row["doc_id"] is not None and row["n_chars"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            node = plain_leaf(row | {"n_chars": row["n_chars"] + 1}) if changed else leaves[g][i]
            for before, after in way:
                node = sha("".join([*before, node, *after]))
            out.append((row["doc_id"], leaves[g][i], subroot, root, sha("".join(s for b, a in way for s in b + a)), node, node == root))
    return out


def some_documents(n: int, seed: int) -> list[dict]:
    rnd = random.Random(seed)
    langs = ["en"] * 12 + ["de", None, "", "é", "zz"]
    return [
        {"doc_id": rnd.choice([i, i, i, i // 2, None]), "source": rnd.choice(["s", None]), "lang": rnd.choice(langs), "n_chars": rnd.choice([i, None]), "text": rnd.choice([None, "", "é" * i])}
        for i in range(n)
    ]


def audited(spark, rows: list[dict], **options):
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")) for r in rows], DOCS).repartition(3)
    for name in ("grp", "key", "digest", "place", "block", "root", "proof", "leaf", "size"):
        docs = docs.withColumn(name, F.lit("x"))
    docs = docs.withColumn("_tampered", merkle.tampered(FIELDS, "n_chars"))
    found = merkle.audit(merkle.manifest(docs, FIELDS, carry=("_tampered",), **options))
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("n, fanout, height", [(300, 2, 2), (157, 3, 1), (90, 2, 0), (41, 2, 10), (1, 2, 3), (2, 2, 0), (3, 2, 1), (33, 4, 2)])
def test_manifest_is_that_of_the_plain_tree(spark, n, fanout, height):
    rows = some_documents(n, n)
    assert audited(spark, rows, fanout=fanout, height=height) == sorted(plain_manifest(rows, fanout), key=str)


def test_manifest_of_repeated_rows_and_of_an_empty_table(spark):
    rows = [{"doc_id": 7, "source": None, "lang": "en", "n_chars": 1, "text": "a"}] * 40 + some_documents(9, 3)
    assert audited(spark, rows, height=2, parts=5) == sorted(plain_manifest(rows, 2), key=str)
    assert audited(spark, []) == []
    with pytest.raises(ValueError, match="fanout"):
        merkle.manifest(spark.range(1), ["id"], "id", "id", fanout=1)


def test_a_manifest_finds_each_change(spark):
    rows = [{"doc_id": i, "source": "s", "lang": "en" if i % 3 else "de", "n_chars": i, "text": f"t{i}"} for i in range(200)]
    changed = {r[0] for r in audited(spark, rows, height=3) if not r[6]}
    assert changed == {i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 0}


# ---------------------------------------------------------------- URL rules


URLS = [
    None, "", "no scheme", "http://", "://", "http://a.net", "http://a.net/", "HTTP://A.Example.NET/en/x?y#z", "http://example.net/en", "http://example.net/en/", "http://xexample.net/en/",
    "http://example.com/de/1", "http://m.example.com/de/", "http://example.com/DE/", "http://example.org/fr/?a=/de/", "http://org/fr/", "http://org.com/fr/", "http://a.net:80/", "http://u@a.net/",
    "http://a.net?x/", "http://a.net#/", "x://y://z.net/", "http://.net/", "http://net./", "http://a..net/", "http://é.net/é", "http://" + "a." * 300 + "net/" + "x" * 5000,
]


def plain_verdict(url: str | None, rules: list[tuple[str, str]], default: str = "allow") -> tuple:
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1].translate({i: i + 32 for i in range(65, 91)}), found[2]) if found else ("", "")
    fits = []
    for rule, verdict in rules:
        cut = rule.find("/") if "/" in rule else len(rule)
        domain, prefix = rule[:cut], rule[cut:]
        if host and (host == domain or host.endswith("." + domain)) and path.startswith(prefix):
            fits.append((len(rule), len(domain), rule, verdict))
    return (host, path, *(max(fits)[2:] if fits else (None, default)))


def judged(spark, urls, rules, **options):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").withColumns({c: F.lit("x") for c in ("host", "path", "rule", "_keys", "key", "verdict")}).repartition(3)
    found = url_rules.judge(pages, url_rules.read_rules(spark, rules) if rules else spark.createDataFrame([], "rule string, verdict string"), carry=("page_id",), **options)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    return [tuple(r)[1:] for r in sorted(found.collect())]


def test_urls_are_judged_as_by_looking_at_every_rule(spark):
    assert judged(spark, URLS + URLS, queries.URL_RULES) == [plain_verdict(u, queries.URL_RULES) for u in URLS + URLS]
    assert judged(spark, URLS, []) == [plain_verdict(u, []) for u in URLS]
    assert judged(spark, [], queries.URL_RULES) == []


@pytest.mark.parametrize("max_bytes", [16 << 20, 60])
def test_cascades_tell_listed_keys_from_all_others(spark, max_bytes):
    rnd = random.Random(5)
    word = lambda: rnd.choice("abcdefgh") + rnd.choice("abcdefgh")
    rules = {f"{'.'.join(word() for _ in range(rnd.randint(1, 3)))}/{'/'.join(word() for _ in range(rnd.randint(0, 2)))}": rnd.choice(url_rules.VERDICTS) for _ in range(300)}
    rules |= {"noslash": "block"}
    urls = [f"https://{'.'.join(word() for _ in range(rnd.randint(1, 4)))}/{'/'.join(word() for _ in range(rnd.randint(0, 3)))}" for _ in range(1500)] + ["http://a.noslash", "http://a.noslash/x"]
    listed = list(rules.items())
    assert judged(spark, urls, listed, max_bytes=max_bytes, default="block") == [plain_verdict(u, listed, "block") for u in urls]


def test_levels_alternate_until_nothing_is_wrong(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    keys = keys.select("key", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    members = keys.where("cast(key as int) % 37 = 0")
    levels = url_rules.cascade(members, keys, 500)  # an estimate far too low gives more levels, not errors
    assert len(levels) > 3
    rows = keys.collect()
    h1, h2 = (np.array([r[c] for r in rows], np.int64).view(np.uint64) for c in ("h1", "h2"))
    assert url_rules.listed(levels, h1, h2).tolist() == [int(r["key"]) % 37 == 0 for r in rows]
    assert url_rules.cascade(members.limit(0), keys, 500) == []


@pytest.mark.parametrize("rules", [[("a/", "allow"), ("A/", "block")], [("a/", "maybe")], [("/x", "block")], [("a/", None)]])
def test_wrong_rules_are_refused(spark, rules):
    with pytest.raises(ValueError, match="rule"):
        judged(spark, URLS, rules)


# ---------------------------------------------------------------- periodic runs


def plain_runs(w: list, least: int = 24, repeats: int = 3) -> list[tuple[int, int, int]]:
    out = []
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            unit = w[i : i + q]
            if j - i + q >= max(least, repeats * q) and not any(q % r == 0 and unit == unit[:r] * (q // r) for r in range(1, q)):
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id: int | None, text: str | None) -> tuple:
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = (None,) * 4
    for s, length, q in runs:
        if best[0] is None or length * best[2] > best[1] * q:
            best = (s, length, q, 1000 * length // q)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return (doc_id, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def repetitive_text(rnd: random.Random) -> str:
    words: list[str] = []
    while rnd.random() < 0.85:
        unit = [rnd.choice("ab") if rnd.random() < 0.7 else str(rnd.randrange(99)) for _ in range(rnd.randint(1, rnd.choice([3, 20, 90])))]
        words += (unit * rnd.randint(1, 40 // len(unit) + 5))[: rnd.randint(1, 400)]
        words += [rnd.choice("abc") for _ in range(rnd.randint(0, 30))]
    return rnd.choice([" ", "\n", "\t \x0b", "\r\n"]).join(words)


def test_runs_are_those_of_trying_every_period(spark):
    rnd = random.Random(11)
    texts = [repetitive_text(rnd) for _ in range(120)]
    texts += [None, "", " \n", "a", "a " * 23, "a " * 24, "a " * 25, "ab " * 900, "a b " * 12, ("a b c d e f g h i " * 3).strip(), "é\u2003 é\x85 " * 30, "x" * 100_000]
    texts += [" ".join(str(i % 500) for i in range(1501)), " ".join(map(str, range(2500)))]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(5, texts[5]), (40, "x y"), (49, " ".join(map(str, range(500))))] + [(i, " ".join(map(str, range(i)))) for i in range(1000, 1040)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("runs", "n_words", "collapsed", "_words", "start")}).repartition(4)
    got = periodic.digest(periodic.periodic_runs(periodic.repeating(docs))).collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain_row(*r) for r in rows), key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i is not None)


def test_runs_with_periods_beyond_the_largest_block():
    rnd = random.Random(3)
    unit = [str(rnd.randrange(10**6)).encode() for _ in range(20_011)]
    text = [b"<"] + (unit * 4)[:70_000] + [b">"] + [b"z"] * 1000
    assert periodic._found([text, [b"q"] * 30], 24, 3) == [[(1, 70_000, 20_011), (70_002, 1000, 1)], [(0, 30, 1)]]


def test_the_transform_is_exact():
    rng = np.random.default_rng(1)
    for size in (16, 64, 128, 4096, 8192):
        x = rng.integers(-periodic.PRIME // 2, periodic.PRIME // 2, (2, size)).astype(float)
        back = periodic.ntt(periodic.ntt(x), inverse=True) * pow(size, -1, periodic.PRIME)
        assert not periodic._reduced(periodic._reduced(back) - x).any()
    a, b = rng.integers(-1000, 1000, (2, 8))
    both = periodic.ntt(periodic._reduced(periodic.ntt(np.pad(a, (0, 8))[None].astype(float)) * periodic.ntt(np.pad(b, (0, 8))[None].astype(float))), inverse=True)
    assert (np.convolve(a, b) - periodic._reduced(both * pow(16, -1, periodic.PRIME))[0, :15].astype(int)).tolist() == [0] * 15 or not (
        (np.convolve(a, b) - periodic._reduced(both * pow(16, -1, periodic.PRIME))[0, :15].astype(int)) % periodic.PRIME
    ).any()


def test_runs_of_an_empty_table_and_the_parameters(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.digest(periodic.periodic_runs(periodic.repeating(none))).count() == 0
    with pytest.raises(ValueError, match="three periods"):
        periodic.periodic_runs(none, repeats=2)
