"""Operators against plain loops on random rows with many ties, NULLs and duplicates."""

import datetime as dt
import random
from collections import defaultdict
from statistics import median

import pytest
from conftest import ts

from vitrine import operators as op

START = ts("2024-01-01")


def instants(rng, n, days=6, step=3600 * 4):
    """Random instants on a coarse grid, so that many coincide."""
    return [START + dt.timedelta(seconds=step * rng.randrange(days * 86400 // step)) for _ in range(n)]


def utc(v):
    return None if v is None else v.astimezone(dt.timezone.utc) if v.tzinfo else v.replace(tzinfo=dt.timezone.utc)


def by_text(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_trailing_distinct(spark, seed):
    rng = random.Random(seed)
    data = [(START.date() + dt.timedelta(days=rng.randrange(40)), rng.randrange(6)) for _ in range(60)]
    out = op.trailing_distinct(spark.createDataFrame(data, "d date, u int"), date="d", member="u", days=5)
    want = []
    for d in {d for d, _ in data}:
        near = {u for e, u in data if d - dt.timedelta(days=4) <= e <= d}
        want.append((d, len({u for e, u in data if e == d}), len(near)))
    assert by_text(tuple(r) for r in out.collect()) == by_text(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_conversion(spark, seed):
    rng = random.Random(seed)
    starts = [(rng.randrange(4), rng.randrange(3), a) for a in instants(rng, 120)]
    ends = [(rng.randrange(4), rng.randrange(3), a) for a in instants(rng, 30)]
    out = op.conversion(
        spark.createDataFrame(starts, "u int, g int, at timestamp"),
        spark.createDataFrame(ends, "u int, g int, got timestamp"),
        keys=["u", "g"],
        start_ts="at",
        end_ts="got",
        group=["g"],
    )
    per_group = defaultdict(list)
    for u, g, a in starts:
        later = [e for v, h, e in ends if (v, h) == (u, g) and e > a]
        per_group[g].append((min(later).date() - a.date()).days if later else None)
    want = []
    for g, waits in per_group.items():
        done = [w for w in waits if w is not None]
        want.append((g, len(waits), len(done), float(median(done)) if done else None, len(done) / len(waits)))
    assert by_text(tuple(r) for r in out.collect()) == by_text(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_scd2_replay(spark, seed):
    rng = random.Random(seed)
    keys = [(g, r) for g in range(5) for r in "ab"]
    changes = [
        (i, *rng.choice(keys[:7]), rng.choice([None, i]), i + 1000, a) for i, a in enumerate(instants(rng, 60))
    ]
    entities = {g: START + dt.timedelta(days=rng.randrange(-3, 3)) for g in range(4)}
    current = [(g, r, 5) for g, r in keys]
    out = op.scd2_replay(
        spark.createDataFrame(changes, "id int, g int, r string, old long, new long, at timestamp"),
        spark.createDataFrame(list(entities.items()), "g int, born timestamp"),
        spark.createDataFrame(current, "g int, r string, price long"),
        entity="g",
        keys=["g", "r"],
        ts="at",
        tie_break="id",
        old="old",
        new="new",
        value="price",
        origin="born",
        attrs=[],
    )
    want = []
    for g, r in keys:
        if g not in entities:
            continue
        log = sorted((c for c in changes if (c[1], c[2]) == (g, r)), key=lambda c: (c[5], c[0]))
        if not log:
            want.append((g, r, 5, entities[g], None, True))
            continue
        if log[0][3] is not None:
            want.append((g, r, log[0][3], entities[g], log[0][5], False))
        for c, after in zip(log, [*log[1:], None]):
            begin = entities[g] if log[0][3] is None and c[5] == log[0][5] else c[5]
            end = after[5] if after else None
            want.append((g, r, c[4], begin, end, end is None))
    got = [
        (r["g"], r["r"], r["price"], utc(r["valid_from"]), utc(r["valid_to"]), r["is_current"]) for r in out.collect()
    ]
    assert by_text(got) == by_text(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_previous_end(spark, seed):
    rng = random.Random(seed)
    data = []
    for a, b in zip(instants(rng, 80), instants(rng, 80)):
        data.append((rng.randrange(4), min(a, b), None if rng.random() < 0.1 else max(a, b)))
    out = op.previous_end(spark.createDataFrame(data, "k int, valid_from timestamp, valid_to timestamp"), ["k"])
    want = []
    far = ts("9999-12-31")
    for k in {d[0] for d in data}:
        own = sorted((d for d in data if d[0] == k), key=lambda d: (d[1], d[2] or far))
        want += [(*d, p[2] if p else None) for d, p in zip(own, [None, *own])]
    got = [(r[0], utc(r[1]), utc(r[2]), utc(r[3])) for r in out.collect()]
    assert by_text(got) == by_text(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_stage_order(spark, seed):
    rng = random.Random(seed)
    stages = ["a", "b", "c"]
    data = [(rng.randrange(8), *(rng.choice([None, i]) for i in instants(rng, 3))) for _ in range(16)]
    df = spark.createDataFrame(data, "k int, a_at timestamp, b_at timestamp, c_at timestamp")
    out = op.stage_order_violations(df, session_key="k", stages=stages)
    want = []
    for k in {d[0] for d in data}:
        seen = sorted((i, d[i]) for d in data if d[0] == k for i in (1, 2, 3) if d[i] is not None)
        want += [(k, i, at, prev) for (i, at), (_, prev) in zip(seen[1:], seen) if at < prev]
    got = [(r[0], r[1], utc(r[2]), utc(r[3])) for r in out.collect()]
    assert by_text(got) == by_text(want)
