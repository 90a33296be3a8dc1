"""State kept from build to build against full builds, on random batches with late, equal and deleted rows."""

import datetime as dt
import random
import uuid

import pytest
from conftest import day, rows, ts
from pyspark.sql import functions as F

from harness.testdata import warehouse
from vitrine import operators as op
from vitrine import sinks
from vitrine.operators import quality
from vitrine.plans.staging import stage
from vitrine.sources import LANDING

START = ts("2024-01-01")
SCD2 = dict(entity="g", ts="at", tie_break="id", old="old", new="new", value="v", origin="born", attrs=["cur"])
CHANGES = "g int, r string, cur string, at timestamp, id int, old int, new int"


@pytest.fixture()
def prefix(spark):
    name = "t" + uuid.uuid4().hex[:8]
    yield name
    for db in spark.catalog.listDatabases():
        if db.name.startswith(name):
            spark.sql(f"DROP DATABASE `{db.name}` CASCADE")


def test_newest_versions_read_new_files_only(spark, prefix, tmp_path):
    rng = random.Random(3)
    schema = "k int, offset long, part int, gone boolean, v string"
    source, landed = f"{tmp_path}/landing", []
    spark.createDataFrame([], schema).write.parquet(source)
    order = ["offset", "part"]
    assert sinks.update_newest(spark, source, schema, prefix, "newest", ["k"], order, buckets=4).count() == 0
    for batch in range(2):
        # offsets of all batches overlap: late, equal and repeated versions; NULL keys and offsets
        new = [(rng.choice([None, *range(12)]), o, p, rng.random() < 0.2, f"v{o}-{p}") for o, p in {(rng.choice([None, rng.randrange(60)]), rng.randrange(3)) for _ in range(40)}]
        landed += new
        spark.createDataFrame(new + rng.sample(landed, 3), schema).repartition(2).write.mode("append").parquet(source)
        got = sinks.update_newest(spark, source, schema, prefix, "newest", ["k"], order, buckets=4)
        want = op.latest_by(spark.read.schema(schema).parquet(source), ["k"], order)
        # rows with equal offsets may differ in their key's other columns; versions decide here
        assert rows(got, "k", "offset", "part") == rows(want, "k", "offset", "part")
    before = rows(got)
    for f in tmp_path.joinpath("landing").glob("*.parquet"):
        f.write_bytes(b"unreadable")  # files that were read are not opened again
    assert rows(sinks.update_newest(spark, source, schema, prefix, "newest", ["k"], order, buckets=4)) == before
    late = [(5, 10_000, 0, True, "last")]
    spark.createDataFrame(late, schema).write.mode("append").parquet(source)
    got = sinks.update_newest(spark, source, schema, prefix, "newest", ["k"], order, buckets=4)
    assert got.where("k = 5").first()["v"] == "last"
    assert rows(got.where("k != 5 or k is null")) == [r for r in before if r[0] != 5]
    sinks.forget_newest(spark, prefix, "newest")
    assert not spark.catalog.tableExists(f"{prefix}.newest")


def test_a_failed_build_of_newest_versions_is_taken_up(spark, prefix, tmp_path, monkeypatch):
    from vitrine.sinks import incremental, tables

    source = f"{tmp_path}/landing"
    spark.range(50).select(F.col("id").alias("k"), F.col("id").alias("o")).write.parquet(source)
    update = lambda: sinks.update_newest(spark, source, "k long, o long", prefix, "n", ["k"], "o", buckets=3)
    for step in ("_apply", "upsert"):
        with monkeypatch.context() as m:
            if step == "upsert":
                m.setattr(incremental, "newest_of", lambda *a: 1 / 0)
                spark.range(60).select(F.col("id").alias("k"), (F.col("id") + 1).alias("o")).write.mode("append").parquet(source)
            else:
                m.setattr(tables, step, lambda *a: 1 / 0)
            with pytest.raises(Exception, match="ZeroDivisionError|division by zero"):
                update()
        got = update()
        assert rows(got) == rows(op.latest_by(spark.read.parquet(source), ["k"], "o"))
    assert got.count() == 60


def test_staging_of_stored_newest_versions_is_that_of_all(spark, prefix, tmp_path):
    wh = warehouse(spark, "/root/testdata/sf0.001")
    for name in ("users", "price_changes"):
        source = f"{tmp_path}/{name}"
        landed = wh.landing(name).repartition(4)
        landed.write.parquet(source)
        table = LANDING[name]
        kept = sinks.update_newest(spark, source, table.schema, prefix, name, [table.key], "record_metadata.offset", bytes_per_batch=20_000)
        assert rows(stage(kept, name, reduced=True)) == rows(stage(spark.read.schema(table.schema).parquet(source), name))
    wh.newest = lambda name: sinks.newest_versions(spark, prefix, name)
    assert rows(wh["stg_users"]) == rows(warehouse(spark, "/root/testdata/sf0.001")["stg_users"])


def some_changes(rng, n, first_id, low, high):
    out = []
    for i in range(n):
        g, r = rng.choice([1, 2, 3, 4, 5, 9, None]), rng.choice(["A", "B", None])
        out.append((g, r, rng.choice("xy"), START + dt.timedelta(hours=6 * rng.randrange(low, high)), first_id + i, rng.choice([None, 1, 2]), rng.randrange(9)))
    return out


def test_splicing_is_replaying(spark):
    rng = random.Random(1)
    entities = spark.createDataFrame([(g, START + dt.timedelta(days=g - 3)) for g in (1, 2, 3, 4, 5)], "g int, born timestamp")
    current = spark.createDataFrame([(g, r, "z", 7) for g in (1, 2, 3, 5, 6, None) for r in ("A", "B", "C", None)], "g int, r string, cur string, v int")
    frame = lambda data: spark.createDataFrame(data, CHANGES)
    replay = lambda data: op.scd2_replay(frame(data), entities, current, keys=["g", "r"], **SCD2)
    known = some_changes(rng, 12, 0, 0, 30)
    stored = replay(known).cache()
    for batch in (1,):
        # later ones, late ones, ones at known instants; keys without changes so far
        new = some_changes(rng, 6, 100 * (batch + 1), 30 + 20 * batch, 50 + 20 * batch) + some_changes(rng, batch, 1000 * (batch + 1), 0, 30)
        dropped = [c for c in known if rng.random() < 0.1]  # withdrawn
        known = [c for c in known if c not in dropped] + new
        again = spark.createDataFrame([(c[0], c[1]) for c in dropped], "g int, r string")
        got = op.scd2_splice(stored, frame(known), frame(new), entities, current, again, keys=["g", "r"], **SCD2)
        want = replay(known)
        assert got.columns == want.columns
        assert rows(got) == rows(want)


def test_later_changes_are_spliced_without_reading_older_ones(spark):
    entities = spark.createDataFrame([(1, START)], "g int, born timestamp")
    current = spark.createDataFrame([], "g int, r string, cur string, v int")
    at = lambda h: START + dt.timedelta(hours=h)
    first = [(1, "A", "x", at(5), 1, 3, 4), (1, "A", "x", at(9), 2, 4, 5)]
    stored = op.scd2_replay(spark.createDataFrame(first, CHANGES), entities, current, keys=["g", "r"], **SCD2)
    new = [(1, "A", "x", at(20), 4, 5, 6), (1, "A", "y", at(20), 3, 6, 7), (1, "A", "x", at(50), 5, 6, 8)]
    got = op.scd2_splice(stored, spark.createDataFrame([], CHANGES), spark.createDataFrame(new, CHANGES), entities, current, keys=["g", "r"], **SCD2)
    want = op.scd2_replay(spark.createDataFrame(first + new, CHANGES), entities, current, keys=["g", "r"], **SCD2)
    assert rows(got) == rows(want)


def test_stored_intervals_follow_their_inputs(spark, prefix):
    rng = random.Random(5)
    entities = [(g, START + dt.timedelta(days=g - 3)) for g in (1, 2, 3)]
    current = [(g, r, "z", 7) for g in (1, 2, 3, 4) for r in ("A", "B")]
    known: list = []
    for batch in range(5):
        known += some_changes(rng, 5, 100 * batch, 10 * batch, 10 * batch + 12)
        if batch == 2:
            known = [c[:-1] + (99,) if i == 1 else c for i, c in enumerate(known) if i != 0]  # one withdrawn, one altered
        if batch == 3:
            entities.append((4, START))
            current[0] = (1, "A", "z", 8)
        if batch == 4:
            known.append(known[-1])  # the same change twice
        frames = (spark.createDataFrame(known, CHANGES), spark.createDataFrame(entities, "g int, born timestamp"), spark.createDataFrame(current, "g int, r string, cur string, v int"))
        got = sinks.update_intervals(spark, prefix, "prices", *frames, keys=["g", "r"], **SCD2)
        assert rows(got) == rows(op.scd2_replay(*frames, keys=["g", "r"], **SCD2))


@pytest.mark.parametrize("days", [7, 28])
def test_masks_count_as_the_full_query(spark, prefix, days):
    rng = random.Random(days)
    seen, marts = [], {}
    as_of = START.date()
    for step in (0, 1, 3, 0, 70, 2) if days == 7 else (0, 30, 40):
        as_of += dt.timedelta(days=step)
        last = as_of - dt.timedelta(days=min(step, 30))
        new = [(last + dt.timedelta(days=rng.randrange((as_of - last).days + 1)), rng.choice([None, *range(9)])) for _ in range(8)]
        new += [(max(as_of - dt.timedelta(days=rng.randrange(20)), START.date()), 3)]  # late
        new += [(None, 1)]
        if step > 62 - days:  # masks do not tell so many days: the state starts anew, on the rows of the masks' reach
            with pytest.raises(ValueError, match="masks"):
                sinks.update_activity(spark.createDataFrame(new, "d date, u int"), prefix, "act", date="d", member="u", as_of=as_of, days=days)
            sinks.drop_table(spark, prefix, "act")
            seen, marts = [], {}
        seen += new
        got = sinks.update_activity(spark.createDataFrame(new + rng.sample(new, 2), "d date, u int"), prefix, "act", date="d", member="u", as_of=as_of, days=days)
        for r in got.collect():
            marts[r["d"]] = (r["daily"], r["trailing"])
        want = op.trailing_distinct(spark.createDataFrame(seen, "d date, u int"), date="d", member="u", days=days)
        assert marts == {r["d"]: (r["daily"], r["trailing"]) for r in want.collect()}
    with pytest.raises(ValueError, match="forward"):
        sinks.update_activity(spark.createDataFrame([(START.date(), 1)], "d date, u int"), prefix, "act", date="d", member="u", as_of=START.date(), days=days)


def test_masks_of_the_wrong_length_are_refused(spark):
    none = spark.createDataFrame([], "d date, u int")
    with pytest.raises(ValueError, match="62"):
        op.activity_masks(none, date="d", member="u", as_of=day("2024-01-01"), bits=63)
    masks = op.activity_masks(none, date="d", member="u", as_of=day("2024-01-01"))
    assert op.trailing_of_masks(masks, as_of=day("2024-01-01"), date="d", days=7, back=5).count() == 0
    with pytest.raises(ValueError, match="forward"):
        op.roll_masks(masks, masks, -1)


def test_checksums_find_the_same_differences(spark):
    rng = random.Random(0)
    base = [(i if i > 2 else None, (None, "x", "y")[i % 3] if i < 3 else rng.choice([None, "x", "y"]), i % 5, rng.choice([None, 2])) for i in range(200)]
    frame = lambda data, kind="int": spark.createDataFrame(data, f"k int, t string, a {kind}, b long")
    for changed in (0, 1, 60):
        other = [r[:2] + (r[2] + 1, r[3]) if i < changed and i % 2 else r for i, r in enumerate(base) if not (i < changed and i % 2 == 0 and changed > 1)]
        other += [(1000 + i, "x", i, None) for i in range(3)]
        for null_safe in ([], ["t"], ["k", "t"]):
            given = dict(keys=["k", "t"], measures=["a", "b"], null_safe=null_safe)
            args = frame(base), frame(other, "long")
            assert rows(op.diff_by_checksum(*args, fanout=4, levels=3, **given)) == rows(op.diff_by_key(frame(base, "long"), frame(other, "long"), **given))
    with pytest.raises(TypeError, match="against"):
        op.diff_by_checksum(frame(base), frame(base).withColumn("a", F.col("a").cast("double")), keys=["k"], measures=["a"])


def test_equal_leaves_are_not_joined(spark):
    """Only rows of one leaf reach the join when one row differs."""
    n = 50_000
    a = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).alias("m"))
    b = a.withColumn("m", F.when(F.col("k") == 17, 100).otherwise(F.col("m")))
    joined, plain = [], quality.diff_by_key

    def spy(e, a_, **kw):
        joined.extend([e.count(), a_.count()])
        return plain(e, a_, **kw)

    quality.diff_by_key = spy
    try:
        assert rows(quality.diff_by_checksum(a, b, keys=["k"], measures=["m"])) == [(17, 3, 100)]
        assert 1 <= max(joined) <= 20
        joined.clear()
        assert quality.diff_by_checksum(a, a, keys=["k"], measures=["m"]).count() == 0 and joined == [0, 0]
    finally:
        quality.diff_by_key = plain
