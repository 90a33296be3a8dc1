"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct 5-word shingles (all its words as one, if fewer), hashed once. Its sketch is the ``k``
smallest hashes. Two documents are linked when the Jaccard similarity of their sets is ``similarity`` or more; linked
documents form components, whose smallest id is kept.

1. Equal sets form classes; the smallest id of a class represents it from here on, copies are never compared.
2. Inverted lists of the values that sketches retain generate overlaps. Two similar sets share so many retained values
   that they meet in the list of one of the few rarest values of each ("prefix": ordering a sketch's values by how many
   documents retain them, those beyond the least overlap). A passage that a third of the documents share is among the
   frequent values, which have no list to themselves unless documents consist of little else.
3. Within a list, the overlap of two sketches and the estimate from their union sketch (its ``k`` smallest values: what
   share of them both retain) turn away pairs that cannot reach the similarity. Of the others a spanning forest leaves
   the list: at most one row for each member. Its components are candidate groups.
4. Within a candidate group the exact Jaccard of the full sets verifies; again a spanning forest of links is left.

Least overlap and estimate allow for ``sigmas`` standard deviations of a sketch: at 7, less than one link in 10^9 right at
the threshold is passed over; sets of up to ``similarity * k`` shingles are compared without any such margin.

Scale: copies are folded before anything else; values are counted with partial aggregation and joined by a join that
splits hot keys. Lists and groups of any length are worked off in tiles of bounded size, never as a whole:

* Members are dealt to blocks. A tile holds a block and the group's representatives, the members of one block, so that a
  group of m members makes 2 m rows. Each tile finds the same largest part of the representatives, and which of its own
  members are connected with it: no two of those need be compared again, in whatever blocks they are.
* Members that are outside this part meet all blocks in a second pass, whose rows grow with m times their number by ``tile``.
  Near copies of one text are settled by the first pass. Only groups of several large families, and members that
  are linked with next to none of a long group though they share most of their text with it, take the second.

Texts are read twice, a third time where there is a second pass; only documents in candidate groups stay behind the join.

Edge cases: NULL, empty and word-free texts have the empty set and no links. Rows with the same id are one document
with several sets, and each row gets its own n_shingles. Rows with a NULL id are never linked: component NULL, kept.
An empty table gives an empty result. Other columns are ignored. Ids are whole numbers; other types are refused.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.components import components
from vitrine.llm.storage import release, settled
from vitrine.llm.text import ORDER_VALUES, Texts, mix, returning, shingles, slices, texts_of, words_of
from vitrine.operators.joins import lookup


def sets_of(texts: Texts, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and where each text's begin (and the end)."""
    words = words_of(texts, lower=True)
    hashes, inside = shingles(words, size)
    at = np.flatnonzero(inside)
    text, value = words.text[at], hashes[at]
    count = words.last - words.first
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            more = count[short] > j
            whole[more] += words.hash[words.first[short[more]] + j] * ORDER_VALUES[j + size]
        text, value = np.concatenate([text, short]), np.concatenate([value, mix(whole + count[short].astype(np.uint64))])
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    text, value = text[new], value[new]
    return value, np.searchsorted(text, np.arange(len(texts) + 1))


def _by_value(rows: DataFrame, per_value: DataFrame) -> DataFrame:
    """Rows with what is known of their value. As in ``lookup`` a second column makes Spark exchange both sides, so that it can split a hot value; a value's
    own remainder takes next to no room in the exchange."""
    slot = F.pmod("value", F.lit(7)).cast("byte")
    return rows.withColumn("slot", slot).join(per_value.withColumn("slot", slot), ["value", "slot"]).drop("slot")


SKETCHES = "doc long, n long, p1 long, p2 long, sketch array<long>"


def sketch(size: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            value, at = sets_of(texts_of(batch.column("text")), size)
            n = np.diff(at)
            # prints of the set: sums, which depend on the members alone
            total = lambda x: np.where(n > 0, np.add.reduceat(np.append(x, np.uint64(0)), np.minimum(at[:-1], len(x))), 0).astype(np.uint64)  # noqa: E731, B023
            taken = np.minimum(n, k)
            ends = np.cumsum(taken)
            keep = np.repeat(at[:-1] - (ends - taken), taken) + np.arange(ends[-1] if len(ends) else 0)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(value[keep].view(np.int64)))
            p1, p2 = total(mix(value)), total(mix(value ^ np.uint64(0x5851F42D4C957F2D)))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(n), pa.array(p1.view(np.int64)), pa.array(p2.view(np.int64)), lists], ["doc", "n", "p1", "p2", "sketch"])

    return run


def least_overlap(s: int, k: int, similarity: float, sigmas: float) -> int:
    """Of a sketch of ``s`` values, how many any similar set's sketch retains too."""
    if s <= similarity * k:  # any partner's set is retained as a whole
        return max(1, math.ceil(similarity * s - 1e-9))
    return max(1, math.floor(similarity * s - sigmas * math.sqrt(s * similarity * (1 - similarity))))


class Tile:
    """Incidence of members and values, some columns of shared values at a time, in the order of the values."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        self.sizes = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(self.n), self.sizes)
        value = np.concatenate(sets)
        order = np.argsort(value, kind="stable")
        self.value, self.owner = value[order], owner[order]
        new = np.ones(len(value), bool)
        new[1:] = self.value[1:] != self.value[:-1]
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(value)))
        several = np.repeat(size > 1, size)
        self.code = np.cumsum(new & several) - 1
        self.several = several
        self.shared = int(self.code[-1]) + 1 if len(self.code) else 0

    def steps(self, columns: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """After each lot of columns: all overlaps so far, and how many values of each member lie in what was covered."""
        total = np.zeros((self.n, self.n), np.float32)
        have = np.zeros(self.n, np.int64)
        done = 0
        for c in range(0, max(1, self.shared), columns):
            end = len(self.code) if c + columns >= self.shared else int(np.searchsorted(self.code, c + columns))
            own, code = self.owner[done:end], self.code[done:end]
            have = have + np.bincount(own, minlength=self.n)
            some = self.several[done:end]
            there = np.zeros((self.n, columns), np.float32)
            there[own[some], code[some] - c] = 1
            total = total + there @ there.T
            done = end
            yield total, have

    def overlaps(self) -> np.ndarray:
        """Sizes of the intersections of all members with all."""
        for total, _ in self.steps(4096):
            pass
        return total

    def estimates(self, k: int, lots: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Share of the union sketch that both retain, for all pairs, the union sketch's size, and whether it is the union.

        The union sketch is taken as far as the last lot of values that leaves it at ``k`` values or fewer.
        """
        both, union = np.zeros((self.n, self.n), np.float32), np.ones((self.n, self.n), np.float32)
        for total, have in self.steps(max(1, -(-self.shared // lots))):
            size = have[:, None] + have[None, :] - total
            fits = (size <= k) & (size > 0)
            both[fits], union[fits] = total[fits], size[fits]
        return both / union, union, fits


def connected(linked: np.ndarray) -> np.ndarray:
    """For each member of a symmetric matrix of links the smallest member that it is connected with."""
    label = np.arange(len(linked))
    linked = linked | np.eye(len(linked), dtype=bool)
    while True:
        least = np.where(linked, label[None, :], len(label)).min(1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, of batches sorted by them."""
    held: pa.Table | None = None
    for batch in returning(batches):
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        columns = [table.column(c).to_numpy() for c in keys]
        new = np.zeros(table.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cut = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(cut, cut[1:], strict=False):
            yield table.slice(a, b - a)
        held = table.slice(cut[-1]).combine_chunks() if table.num_rows else None
    if held is not None and held.num_rows:
        yield held


def _spanning(table: pa.Table, linked: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that connect a tile's members as their links do: one less than there are members in a connected part.

    In a tile of two blocks only what joins the blocks is returned, a pair for each part that a block's own tile gives.
    """
    doc, block = table.column("doc").to_numpy(), table.column("block").to_numpy()
    whole = connected(linked)
    single = table.column("bi")[0].as_py() == table.column("bj")[0].as_py()
    parts = np.arange(len(doc)) if single else np.unique(connected(linked & (block[:, None] == block[None, :])))
    return [(a, b) for a, b in zip(doc[parts].tolist(), doc[whole[parts]].tolist(), strict=True) if a != b]


def _one_sided(table: pa.Table) -> bool:
    """Whether a tile of two blocks has members of but one."""
    block = table.column("block").to_numpy()
    return table.column("bi")[0].as_py() != table.column("bj")[0].as_py() and bool((block == block[0]).all())


def _outside(table: pa.Table, linked: np.ndarray) -> list[int]:
    """Members of a tile's block that are not connected with the largest part of the representatives, block 0.

    Every tile of a group has all representatives, so that each finds the same part.
    """
    doc, block = table.column("doc").to_numpy(), table.column("block").to_numpy()
    own = table.column("bi")[0].as_py()
    reps = np.flatnonzero(block == 0)
    if own <= 0 or own != table.column("bj")[0].as_py() or not len(reps):
        return doc[block == own].tolist() if own > 0 and own == table.column("bj")[0].as_py() else []
    parts = connected(linked[np.ix_(reps, reps)])
    largest = int(np.bincount(parts).argmax())
    whole = connected(linked)
    return doc[(block == own) & (whole != whole[reps[largest]])].tolist()


def _candidates(table: pa.Table, k: int, similarity: float, sigmas: float) -> np.ndarray:
    """Which members of a tile have sketches alike enough."""
    n = table.column("n").to_numpy()
    tops = table.column("top")
    at = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(tops).to_numpy())])
    flat = tops.combine_chunks().flatten().to_numpy().view(np.uint32)
    share, size, whole = Tile([np.unique(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]).estimates(k)
    exact = whole & (n[:, None] <= k) & (n[None, :] <= k)
    slack = np.where(exact, 1e-6, sigmas * np.sqrt(similarity * (1 - similarity) / size))
    alike = np.minimum(n[:, None], n[None, :]) >= similarity * np.maximum(n[:, None], n[None, :]) - 1e-9
    return alike & (share >= similarity - slack)


def _links(table: pa.Table, percent: int) -> np.ndarray:
    """Which members of a tile have sets of that similarity."""
    n = table.column("n").to_numpy()
    both = Tile([np.frombuffer(x, "<u8") for x in table.column("members").to_pylist()]).overlaps().astype(np.int64)
    return 100 * both >= percent * (n[:, None] + n[None, :] - both)


def _work_off(dealt: DataFrame, key: str, linked) -> DataFrame:
    """Written down: links (a, b) of each tile (key, bi, bj), and rows (a, NULL, key) for members outside their group's largest part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int | None, int]] = []
        for table in _groups(batches, [key, "bi", "bj"]):
            alone = table.num_rows < 2
            if not alone and _one_sided(table):
                continue
            number = table.column(key)[0].as_py()
            matrix = np.ones((1, 1), bool) if alone else linked(table)
            out += [(a, b, number) for a, b in _spanning(table, matrix)]
            out += [(a, None, number) for a in _outside(table, matrix)]
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b", "key"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b", "key"])

    # As many partitions as were asked for: work goes with the square of a tile's members, which sizes in bytes do not show.
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settled(dealt.repartition(parts, key, "bi", "bj").sortWithinPartitions(key, "bi", "bj", "doc").mapInArrow(run, "a long, b long, key long"))


def _spread(rows: DataFrame, blocks: str) -> DataFrame:
    """Each row once for every block."""
    return rows.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))


def _links_within(index: DataFrame, key: str, attach, linked) -> DataFrame:
    """Links (a, b) that connect the members of each key as ``linked`` says of the members of a tile.

    ``index`` has (key, blocks, doc, ...), ``attach`` adds what ``linked`` looks at to rows dealt to tiles.
    """
    index = settled(index.withColumn("block", F.pmod(F.xxhash64("doc", key), F.col("blocks"))))
    columns = [c for c in index.columns if c != "blocks"] + ["bi", "bj"]
    own = index.withColumns({"bi": F.col("block"), "bj": F.col("block")})
    first = _spread(index.where("block = 0 and blocks > 1"), "blocks").where("at > 0").withColumns({"bi": F.col("at"), "bj": F.col("at")})
    found = _work_off(attach(own.select(columns).union(first.select(columns))), key, linked)
    links, outside = found.where("b is not null").select("a", "b"), found.where("b is null").select(F.col("a").alias("doc"), F.col("key").alias(key)).distinct()
    if outside.isEmpty():
        return links
    counts = outside.groupBy(key).agg(F.count("*").alias("r"))
    sizes = index.where("blocks > 1").groupBy(key, "blocks").agg(F.count("*").alias("m"))
    turns = counts.join(sizes, key).select(key, F.ceil(F.col("r") * F.col("blocks") / F.col("m")).cast("long").alias("turns"))
    members = settled(lookup(index.where("blocks > 1"), turns, [key], "inner"))
    # Members outside meet all blocks: tiles of a block and a turn, told apart by the sign.
    there = _spread(members, "turns").withColumns({"bi": F.col("block"), "bj": -1 - F.col("at")})
    few = members.join(outside, [key, "doc"], "left_semi").withColumn("block", -1 - F.pmod(F.xxhash64("doc", key, F.lit(1)), F.col("turns")))
    here = _spread(few, "blocks").withColumns({"bi": F.col("at"), "bj": F.col("block")})
    return links.union(_work_off(attach(there.select(columns).union(here.select(columns))), key, linked).where("b is not null").select("a", "b"))


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            value, at = sets_of(texts_of(batch.column("text")), size)
            members = [value[a:b].astype("<u8").tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("grp", "doc", "block", "bi", "bj")), pa.array(np.diff(at)), pa.array(members, pa.binary())],
                ["grp", "doc", "block", "bi", "bj", "n", "members"],
            )

    return run


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80, size: int = 5, k: int = 64, sigmas: float = 7.0, tile: int = 256, tile_shingles: int = 500_000, few_rows: int = 100_000
) -> DataFrame:
    """For each row of documents: its id, n_shingles, component (smallest id reachable over links) and kept."""
    if not isinstance(documents.schema[doc_id].dataType, T.IntegralType):
        raise TypeError(f"{doc_id}: near-duplicates need whole numbers as ids, not {documents.schema[doc_id].dataType.simpleString()}")
    similarity = percent / 100
    docs = documents.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    rows = settled(docs.mapInArrow(sketch(size, k), SKETCHES))
    sets = rows.where((F.col("n") > 0) & F.col("doc").isNotNull())
    classes = sets.groupBy("n", "p1", "p2").agg(F.min("doc").alias("rep"), F.count("*").alias("copies")).where("copies > 1")
    copies = lookup(sets.select("doc", "n", "p1", "p2"), classes, ["n", "p1", "p2"], "inner").where("doc != rep").select(F.col("doc").alias("a"), F.col("rep").alias("b"))
    reps = sets.groupBy("n", "p1", "p2").agg(F.min("doc").alias("doc"), F.first("sketch").alias("sketch"))
    # the rarest retained values of each set that two similar ones cannot both be without
    postings = reps.select("doc", "p1", F.size("sketch").alias("s"), F.explode("sketch").alias("value"))
    counts = postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = _by_value(postings, counts).groupBy("doc", "p1", "s").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"))  # at most k
    necessary = F.element_at(F.array(*(F.lit(s - least_overlap(s, k, similarity, sigmas) + 1) for s in range(1, k + 1))), F.col("s"))
    take = F.greatest(necessary - (F.col("s") - F.size("values")), F.lit(0))
    prefix = settled(shared.select("doc", "p1", F.slice("values", F.lit(1), take)["value"].alias("prefix")).where(F.size("prefix") > 0))
    lists = prefix.select(F.explode("prefix").alias("value")).groupBy("value").agg(F.count("*").alias("m")).where("m > 1")
    lists = lists.select("value", F.ceil(F.col("m") / tile).cast("long").alias("blocks"))
    top = F.transform("sketch", lambda x: F.shiftright(x, 32).cast("int"))
    tops = settled(prefix.select("doc", "p1").join(reps.select("doc", "p1", "n", top.alias("top")), ["doc", "p1"]))
    members = _by_value(prefix.select("doc", "p1", F.explode("prefix").alias("value")), lists)
    found = _links_within(members, "value", lambda dealt: dealt.join(tops, ["doc", "p1"]).drop("p1"), lambda tile: _candidates(tile, k, similarity, sigmas))
    group = components(found)
    release(documents.sparkSession)
    grouped = group.select(F.col("node").alias("doc"), F.col("component").alias("grp"))
    sizes = rows.select("doc", "n").join(grouped, "doc").groupBy("grp").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
    sizes = sizes.select("grp", F.greatest(F.ceil(F.col("m") / tile), F.ceil(F.col("total") / tile_shingles)).cast("long").alias("blocks"))
    wanted = lookup(grouped, sizes, ["grp"], "inner")

    def full(dealt: DataFrame) -> DataFrame:
        # Few rows go to the texts, rather than all texts to the rows.
        few = dealt.limit(few_rows + 1).count() <= few_rows
        sets_again = docs.join(F.broadcast(dealt) if few else dealt, "doc").select("grp", "doc", "block", "bi", "bj", "text")
        return sets_again.mapInArrow(_full_sets(size), "grp long, doc long, block long, bi long, bj long, n long, members binary").where("n > 0")

    links = _links_within(wanted, "grp", full, lambda tile: _links(tile, percent))
    component = components(links.union(copies))
    whole = rows.select("doc", "n").join(component, F.col("doc") == F.col("node"), "left")
    reached = F.coalesce("component", "doc")
    return whole.select(F.col("doc").alias(doc_id), F.col("n").alias("n_shingles"), reached.alias("component_id"), F.coalesce(reached == F.col("doc"), F.lit(True)).alias("kept"))
