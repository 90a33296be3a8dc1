"""Data-quality checks. Each returns the violations; no rows means the check passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.joins import lookup


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Non-NULL values that occur more than once."""
    counted = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("unique_field"))
    return counted.agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where the column is NULL."""
    return df.filter(F.col(col).isNull())


def check_accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Values outside the list with their row counts. NULL passes."""
    bad = df.filter(~F.col(col).isin(values))
    return bad.groupBy(F.col(col).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def check_relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-NULL child values without a parent, with the number of child rows that hold each.

    Child rows are counted per value first: a value held by most rows reaches the join once.
    """
    held = (
        child.filter(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("from_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    known = parent.select(F.col(field).alias("from_field"))
    return held.join(known, "from_field", "left_anti")


def check_unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    """Combinations that occur more than once. NULLs count as equal."""
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(F.col("n_records") > 1)


def fingerprint(value: Column) -> Column:
    """64 bits of a value."""
    return F.xxhash64(value)


def second_fingerprint(value: Column) -> Column:
    """32 further bits of a value, by another function."""
    return F.hash(value)


def value_counts(df: DataFrame, cells: dict[int, Column]) -> DataFrame:
    """(c, p, q, n): how often each value of each of the numbered columns occurs, NULLs left out.

    Values are told apart by 96 bits of fingerprints, 12 bytes instead of their text; two of 10^11 values agree in all of them
    with a chance of 1 in 10^7. Counted in each task first, so that a value held by most rows is sent once.
    """
    parts = [F.struct(F.lit(c).alias("c"), fingerprint(v).alias("p"), second_fingerprint(v).alias("q"), v.isNotNull().alias("there")) for c, v in cells.items()]
    exploded = df.select(F.explode(F.array(*parts)).alias("_cell")).select("_cell.*").filter("there")
    return exploded.groupBy("c", "p", "q").agg(F.count(F.lit(1)).alias("n"))


def diff_by_checksum(
    expected: DataFrame,
    actual: DataFrame,
    *,
    keys: list[str],
    measures: list[str],
    null_safe: list[str] = (),
    fanout: int = 256,
    levels: int = 2,
) -> DataFrame:
    """What ``diff_by_key`` gives, for two stored sides that are mostly equal.

    A key's hash names a path of ``levels`` steps through a tree of that ``fanout``; a leaf's checksum is the sum of the
    hashes of its rows, a node's the sum of its leaves. Nodes of both sides are compared from the top, only below unequal
    ones the next level is looked at, and only rows of unequal leaves are joined. Rows with a NULL in a key that matches
    no NULL always are. Checksums are summed in each task; per level at most ``fanout ** levels`` rows meet.
    """
    strict = [k for k in keys if k not in null_safe]
    lost = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in strict], F.lit(False))
    leaves = fanout**levels
    alike = {c: _common_type(expected, actual, c) for c in [*keys, *measures]}
    sides = []
    for df in (expected, actual):
        typed = df.select(*[F.col(c).cast(kind).alias(c) for c, kind in alike.items()])
        sides.append(typed.withColumns({"_leaf": F.pmod(F.xxhash64(*keys), F.lit(leaves)), "_lost": lost}))
    total = F.sum(F.xxhash64(*keys, *measures).cast("decimal(38,0)"))
    sums = [side.filter(~F.col("_lost")).groupBy("_leaf").agg(total.alias("_sum"), F.count(F.lit(1)).alias("_n")) for side in sides]
    both = [s.select("_leaf", (F.col("_sum") * sign).alias("_sum"), (F.col("_n") * sign).alias("_n")) for s, sign in zip(sums, (1, -1), strict=True)]
    tree = both[0].unionByName(both[1]).groupBy("_leaf").agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))
    unequal = tree
    for level in range(1, levels):
        width = fanout ** (levels - level)
        node = F.floor(F.col("_leaf") / width)
        open_nodes = unequal.groupBy(node.alias("_node")).agg(F.sum("_sum").alias("_s"), F.sum("_n").alias("_m")).filter("_s != 0 or _m != 0").select("_node")
        unequal = unequal.withColumn("_node", node).join(open_nodes, "_node", "left_semi").drop("_node")
    unequal = unequal.filter("_sum != 0 or _n != 0").select("_leaf")
    opened = []
    for side in sides:
        inside = lookup(side.filter(~F.col("_lost")), unequal, ["_leaf"], "left_semi", spread=keys)
        opened.append(inside.unionByName(side.filter("_lost")).drop("_leaf", "_lost"))
    return diff_by_key(*opened, keys=keys, measures=measures, null_safe=list(null_safe))


def _common_type(a: DataFrame, b: DataFrame, column: str) -> str:
    """A type in which equal values of both sides have equal hashes."""
    kinds = {df.schema[column].dataType.simpleString() for df in (a, b)}
    if len(kinds) == 1:
        return kinds.pop()
    if kinds <= {"tinyint", "smallint", "int", "bigint"}:
        return "bigint"
    raise TypeError(f"{column}: {' against '.join(sorted(kinds))}")


def diff_by_key(
    expected: DataFrame,
    actual: DataFrame,
    *,
    keys: list[str],
    measures: list[str],
    null_safe: list[str] = (),
) -> DataFrame:
    """Keys whose measures differ between two aggregates; a missing side counts as 0.

    Keys in ``null_safe`` match NULL with NULL, the others do not.
    """
    e, a = expected.alias("e"), actual.alias("a")
    matches = [
        F.col(f"e.{k}").eqNullSafe(F.col(f"a.{k}")) if k in null_safe else F.col(f"e.{k}") == F.col(f"a.{k}")
        for k in keys
    ]
    both = e.join(a, reduce(lambda x, y: x & y, matches), "full")
    zero = F.lit(0).cast("long")
    out = both.select(
        *[F.coalesce(F.col(f"e.{k}"), F.col(f"a.{k}")).alias(k) for k in keys],
        *[F.coalesce(F.col(f"e.{m}"), zero).alias(f"expected_{m}") for m in measures],
        *[F.coalesce(F.col(f"a.{m}"), zero).alias(f"actual_{m}") for m in measures],
    )
    differs = [F.col(f"expected_{m}") != F.col(f"actual_{m}") for m in measures]
    return out.filter(reduce(lambda x, y: x | y, differs))
