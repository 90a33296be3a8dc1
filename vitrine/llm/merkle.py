"""Merkle manifest of a dataset, with every row's proof, by a butterfly exchange.

Rows of a group (a language, say) are leaves in the order of a key; every ``fanout`` consecutive nodes become the hash of
their digests, the last run however short, until one is left: the group's root. Groups, in the order of their names, are the
leaves of the tree above. A digest is the lower-case hex SHA-256 of its inputs, put together as text.

1. A leaf digest is made by the JVM, next to the scan; texts go no further.
2. Leaves are range-partitioned by group, key and digest; places come from the counts of the (partition, group) pieces.
3. Aligned blocks of ``fanout ** height`` consecutive leaves are what a partition of the exchange owns. Each hashes its own
   subtree, level by level, in one task.
4. Butterfly: in round r the ``fanout`` blocks whose numbers differ in digit r alone swap the roots of their subtrees. Each
   hashes the common ancestor itself, so that after the round every block holds the root over ``fanout ** (r + 1)`` blocks
   and has put the others' digests to its own upper proof. After ``log(blocks)`` rounds all blocks of a group hold its root
   and a whole upper proof; nothing is ever passed down. A group's blocks are padded with empty ones to a power of the
   fanout, so that every partner exists: an empty block beside full ones holds their ancestor like any other.
5. The groups' roots are leaves of a second exchange of the same kind.
6. Blocks meet their upper proofs, and each leaf gets its own: siblings within the block, above it, above the group.

Scale: a block's rows are bounded by ``fanout ** height`` whatever the group's share, and only digests are shuffled: leaves
by range and twice by block, and one row per block in each round. A round's groups have ``fanout`` rows. Nothing is collected, and no window runs over
a group: places are summed over pieces of partitions.

Edge cases: a NULL group comes first, other groups by their UTF-8 bytes. NULL keys come first in a group; equal keys are
ordered by their digest, and wholly equal rows are leaves of their own with equal digests. NULL fields are hashed as ``-``
and differ from empty ones. Without rows the result is empty; a single leaf is the root itself, with an empty proof.
Columns in ``carry`` stay beside the result; others, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.near_dups import _groups
from vitrine.llm.storage import settled

STEP = "struct<before: string, after: string>"
PROOF = f"array<{STEP}>"


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of all fields, each as its UTF-8 byte count, a colon and its value, ``-`` if NULL."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.sha2(F.concat(*parts), 256)


def parent(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def levels_of(leaves: list[str], fanout: int, height: int | None = None) -> list[list[str]]:
    """All levels of a tree from its leaves up: ``height`` levels of parents, by default until one node is left."""
    levels = [leaves]
    while len(levels[-1]) > 1 if height is None else len(levels) <= height:
        below = levels[-1]
        levels.append([parent(below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def proofs_of(levels: list[list[str]], fanout: int, upper: list[dict[str, str]]) -> pa.ListArray:
    """For each leaf the digests left and right of the node above it, in its run, level by level; then the ``upper`` steps.

    A node's step is put together once and shared by all leaves below it.
    """
    before, after, columns, first = [], [], [], 0
    leaf = np.arange(len(levels[0]))
    for number, level in enumerate(levels[:-1]):
        for i in range(len(level)):
            start = i - i % fanout
            before.append("".join(level[start:i]))
            after.append("".join(level[i + 1 : start + fanout]))
        columns.append(first + leaf // fanout**number)
        first += len(level)
    columns += [np.full(len(leaf), first + i) for i in range(len(upper))]
    before += [step["before"] for step in upper]
    after += [step["after"] for step in upper]
    at = pa.array(np.stack(columns, 1).ravel() if columns else np.zeros(0, np.int64))
    steps = pa.StructArray.from_arrays([pa.array(x, pa.string()).take(at) for x in (before, after)], ["before", "after"])
    return pa.ListArray.from_arrays(pa.array((np.arange(len(leaf) + 1) * len(columns)).astype(np.int32)), steps)


def _placed(rows: DataFrame, parts: int | None) -> DataFrame:
    """Rows (grp, key, digest, ...) with ``place``, their number in their group by key and digest.

    The rows' own numbers break ties, so that copies of one row are dealt to several tasks too.
    """
    order = ["grp", "key", "digest", "tie"]
    rows = settled(rows.withColumn("tie", F.monotonically_increasing_id()))
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    ordered = settled(dealt.sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    piece = F.shiftright("at", 33)
    pieces = ordered.groupBy("grp", piece.alias("piece")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("grp").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    whole = F.sum("n").over(Window.partitionBy("grp"))
    pieces = pieces.select("grp", "piece", "first", F.coalesce(before, F.lit(0)).alias("before"), whole.alias("size"))
    joined = ordered.withColumn("piece", piece).join(pieces, ["grp", "piece"])
    return joined.withColumn("place", F.col("at") - F.col("first") + F.col("before")).drop("at", "piece", "first", "before", "tie")


def _block_roots(leaves: DataFrame, fanout: int, height: int) -> DataFrame:
    """(grp, block, size, digest): the node that each block's own subtree ends in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["grp", "block"]):
            size = table.column("size")[0].as_py()
            top = levels_of(table.column("digest").to_pylist(), fanout, height if size > fanout**height else None)[-1][0]
            yield pa.RecordBatch.from_arrays([table.column(c).slice(0, 1).combine_chunks() for c in ("grp", "block", "size")] + [pa.array([top])], ["grp", "block", "size", "digest"])

    return leaves.mapInArrow(run, "grp string, block long, size long, digest string")


def _together(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda m: m.digest), "")


def _butterfly(blocks: DataFrame, fanout: int, height: int, settle_every: int = 6) -> DataFrame:
    """(grp, block, root, proof): for every block the root over all blocks of its group, and the way up to it."""
    count = F.ceil(F.col("size") / fanout**height).cast("long")
    most = blocks.agg(F.max(count)).first()[0] or 1
    powers = [1]
    while powers[-1] < most:
        powers.append(powers[-1] * fanout)
    wide = F.element_at(F.filter(F.array(*(F.lit(p).cast("long") for p in powers)), lambda p: p >= F.col("count")), 1)
    state = blocks.select("grp", "block", "digest", count.alias("count")).withColumn("wide", wide)
    # The last block of a group also stands for the empty ones behind it.
    empty = state.where("block = count - 1 and wide > count").select("grp", F.explode(F.sequence("count", F.col("wide") - 1)).alias("block"), F.lit(None).cast("string").alias("digest"), "count", "wide")
    state = state.union(empty).withColumn("proof", F.array().cast(PROOF))
    for number, power in enumerate(powers[:-1]):
        digit = F.floor(F.col("block") / power) % fanout
        swap = Window.partitionBy("grp", F.col("block") - digit * power)
        met = F.array_sort(F.collect_list(F.when(F.col("digest").isNotNull(), F.struct(digit.alias("digit"), "digest"))).over(swap))
        state = state.withColumns({"_met": met, "_digit": digit})
        before = _together(F.filter("_met", lambda m: m.digit < F.col("_digit")))
        after = _together(F.filter("_met", lambda m: m.digit > F.col("_digit")))
        step = F.struct(before.alias("before"), after.alias("after")).cast(STEP)
        ancestor = F.when(F.size("_met") > 0, F.sha2(_together(F.col("_met")), 256))
        going = F.col("wide") > power
        state = state.select(
            "grp", "block", F.when(going, ancestor).otherwise(F.col("digest")).alias("digest"), "count", "wide", F.when(going, F.concat("proof", F.array(step))).otherwise(F.col("proof")).alias("proof")
        )
        if number % settle_every == settle_every - 1:
            state = settled(state)
    return state.where("block < count").select("grp", "block", F.col("digest").alias("root"), "proof")


def _with_proofs(leaves: DataFrame, above: DataFrame, fanout: int, height: int, carried: list[str]) -> DataFrame:
    """Leaves (grp, block, place, size, digest) with root and proof: their own block's steps, then those of ``above``."""
    none = [F.lit(None).cast(leaves.schema[c].dataType).alias(c) for c in carried]
    up = above.select("grp", "block", F.lit(-1).cast("long").alias("place"), F.lit(0).cast("long").alias("size"), F.col("root").alias("digest"), F.col("proof").alias("upper"), *none)
    both = leaves.select("grp", "block", "place", "size", "digest", F.lit(None).cast(PROOF).alias("upper"), *carried).union(up)
    kept = ["grp", "place", "digest", "root", "proof", *carried]
    schema = both.select("grp", "place", "digest", F.col("digest").alias("root"), F.col("upper").alias("proof"), *carried).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["grp", "block"]):
            root, upper = table.column("digest")[0].as_py(), table.column("upper")[0].as_py()
            rows = table.slice(1).combine_chunks()
            size = rows.column("size")[0].as_py()
            levels = levels_of(rows.column("digest").to_pylist(), fanout, height if size > fanout**height else None)
            columns = {"root": pa.array([root] * rows.num_rows), "proof": proofs_of(levels, fanout, upper)}
            yield pa.RecordBatch.from_arrays([columns[c] if c in columns else rows.column(c).combine_chunks() for c in kept], kept)

    return both.repartition("grp", "block").sortWithinPartitions("grp", "block", "place").mapInArrow(run, schema)


def _in_blocks(rows: DataFrame, fanout: int, height: int) -> DataFrame:
    return rows.withColumn("block", F.floor(F.col("place") / fanout**height).cast("long"))


def _tree(rows: DataFrame, fanout: int, height: int, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Leaves of all groups in their blocks, and (grp, block, root, proof)."""
    leaves = settled(_in_blocks(_placed(rows, parts), fanout, height))
    blocks = _block_roots(leaves.select("grp", "block", "place", "size", "digest").repartition("grp", "block").sortWithinPartitions("grp", "block", "place"), fanout, height)
    return leaves, settled(_butterfly(settled(blocks), fanout, height))


def manifest(
    documents: DataFrame, fields: list[str], group: str = "lang", key: str = "doc_id", carry: tuple[str, ...] = (), fanout: int = 2, height: int = 10, parts: int | None = None
) -> DataFrame:
    """For each row: key, leaf, subroot, root, proof and the ``carry`` columns.

    ``proof`` has a step for each level up to the root: the digests before and after the node in its run, put together.
    """
    if fanout < 2 or height < 0:
        raise ValueError("a tree needs a fanout of 2 or more")
    carried = {c: f"_carry{i}" for i, c in enumerate(carry)}
    name = F.col(f"`{group}`").cast("string")
    rows = documents.select(
        # a name that is never NULL and sorts as the groups do
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("grp"),
        F.col(f"`{key}`").alias("key"),
        leaf_digest([F.col(f"`{c}`") for c in fields]).alias("digest"),
        *(F.col(f"`{c}`").alias(n) for c, n in carried.items()),
    )
    leaves, above = _tree(rows, fanout, height, parts)
    tops = above.where("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("root").alias("digest"))
    groups, over = _tree(tops, fanout, height, 1 if parts is None else parts)
    higher = _with_proofs(groups, over, fanout, height, ["key"]).select(F.col("key").alias("grp"), F.col("root").alias("whole"), F.col("proof").alias("higher"))
    state = above.join(settled(higher), "grp").select("grp", "block", F.concat("root", F.lit(" "), "whole").alias("root"), F.concat("proof", "higher").alias("proof"))
    found = _with_proofs(leaves, state, fanout, height, ["key", *carried.values()])
    roots = F.split("root", " ")
    return found.select(F.col("key").alias(key), F.col("digest").alias("leaf"), roots[0].alias("subroot"), roots[1].alias("root"), "proof", *(F.col(n).alias(c) for c, n in carried.items()))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf digest and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step.before, node, step.after), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings, level by level."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step.before, step.after)), ""), 256)


def tampered(fields: list[str], changed: str, doc_id: str = "doc_id", every: int = 7) -> Column:
    """The leaf digest with 1 added to a field, for rows whose id's CRC-32 is divisible by ``every``; else NULL."""
    picked = F.crc32(F.col(doc_id).cast("string").cast("binary")) % every == 0
    return F.when(picked, leaf_digest([F.col(c) + (1 if c == changed else 0) if c == changed else F.col(c) for c in fields]))


def audit(found: DataFrame, doc_id: str = "doc_id", other: str = "_tampered") -> DataFrame:
    """What the proofs say of a manifest's rows, where ``other`` is the digest of a row as it is met now (NULL: unchanged)."""
    seen = found.withColumn("folded_root", folded(F.coalesce(F.col(other), F.col("leaf")), F.col("proof")))
    return seen.select(doc_id, "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
