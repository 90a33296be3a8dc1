"""Sharding by a permutation-filled lookup table.

Every shard prefers the slots of a table of prime size in an order of its own: slot (offset + j * skip) mod size for
j = 0, 1, ..., a permutation because the size is prime. Shards take turns, each claiming the first slot in its order that is
still free, until the table is full. A row's key is hashed to a slot, and the slot names the shard: one look-up, whatever the
number of shards. Shards differ by one slot at most, and when a shard comes or goes only about its share of rows moves.

Scale: the table has ``size`` entries whatever the corpus; it goes to the tasks as one broadcast array literal, and
placement is a narrow projection in the JVM. A key that holds a third of all rows would fill its shard; ``spread`` adds the
row's own identity to the hash, so that such rows go to many shards (give the key alone to keep its rows together).
``write_shards`` shuffles by shard and sub-divides each shard's partition into ``files_per_shard`` files; ``stored_shards`` reads
them back, the shard from the folder a row was found in.

Edge cases: a NULL key is hashed like any value; equal keys meet in one shard; an empty table gives an empty result; more
shards than slots, no shards, repeated names, or a size that is no prime are refused. An input column named like an output
gives way to it, also where it is part of the key.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], size: int = 4099) -> list[int]:
    """For each slot, the number of the shard that claims it."""
    if not shards or len(set(shards)) < len(shards) or len(shards) > size or not is_prime(size):
        raise ValueError("a lookup table needs different shards, at most as many as slots, and a prime number of slots")
    offset = [_number(s, "offset") % size for s in shards]
    skip = [_number(s, "skip") % (size - 1) + 1 for s in shards]
    table, turn = [-1] * size, [0] * len(shards)
    left = size
    while True:
        for k in range(len(shards)):
            while table[slot := (offset[k] + turn[k] * skip[k]) % size] >= 0:
                turn[k] += 1
            table[slot] = k
            turn[k] += 1
            left -= 1
            if not left:
                return table


def slot_of(key: list[str], size: int):
    """The slot of a row: 60 bits of the MD5 of its key columns, each as text with its length (NULL differs from '')."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in key]
    return F.conv(F.substring(F.md5(F.concat_ws(",", *parts)), 1, 15), 16, 10).cast("long") % size


def place(rows: DataFrame, key: list[str], shards: list[str], size: int = 4099, spread: list[str] | None = None, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """Rows with their ``slot`` and the name of their ``shard``."""
    table = lookup_table(shards, size)
    numbers, names = F.lit(table), F.lit(shards)
    placed = rows.withColumn(slot, slot_of([*key, *(spread or [])], size))
    return placed.withColumn(shard, F.element_at(names, F.element_at(numbers, F.col(slot).cast("int") + 1) + 1))


def write_shards(placed: DataFrame, folder: str, files_per_shard: int = 1, slot: str = "slot", shard: str = "shard") -> None:
    """Parquet in a folder for each shard. Every file comes from one task, and a shard's slots are dealt over its files."""
    part = F.pmod(F.col(slot), F.lit(files_per_shard))
    shards = placed.sparkSession.conf.get("spark.sql.shuffle.partitions")
    placed.repartition(int(shards), F.col(shard), part).write.partitionBy(shard).mode("errorifexists").parquet(folder)


def stored_shards(placed: DataFrame, folder: str, files_per_shard: int = 1, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """The placed rows, written to ``folder`` and read from there. Runs when it is called."""
    write_shards(placed, folder, files_per_shard, slot, shard)
    return placed.sparkSession.read.schema(placed.schema).parquet(folder).select(*placed.columns)


def next_place(placed: DataFrame, shards: list[str], size: int = 4099, slot: str = "slot", next_shard: str = "next_shard") -> DataFrame:
    """Placed rows with the shard of their slot once the shards have changed."""
    numbers, names = F.lit(lookup_table(shards, size)), F.lit(shards)
    return placed.withColumn(next_shard, F.element_at(names, F.element_at(numbers, F.col(slot).cast("int") + 1) + 1))


def moved(rows: DataFrame, key: list[str], before: list[str], after: list[str], size: int = 4099) -> DataFrame:
    """Rows with ``slot``, ``shard`` and ``next_shard``, their place once the shards have changed."""
    return next_place(place(rows, key, before, size), after, size)
