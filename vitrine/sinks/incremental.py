"""State that is stored between builds: newest versions, price intervals, activity masks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.operators import activity_masks, latest_by, newest_of, roll_masks, scd2_splice, trailing_of_masks
from vitrine.operators.incremental import MASK_DAYS
from vitrine.sinks.tables import Folder, _database_folder, drop_table, merge_table, write_table

BUCKET = "_bucket"


def _progress(spark: SparkSession, namespace: str, name: str) -> str:
    return f"{_database_folder(spark, namespace)}/{name}__progress"


def update_newest(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    namespace: str,
    name: str,
    keys: list[str],
    order_col: str | list[str],
    *,
    nulls: str = "first",
    buckets: int = 64,
    bytes_per_batch: int = 64 << 30,
) -> DataFrame:
    """Brings the table of newest versions up to date with the landed parquet files of ``source``, and returns it.

    The table holds one row per key, partitioned by a hash of the key. Spark's file stream keeps the list of files that
    have been read, in the folder ``<name>__progress`` beside the table: a build lists the source and reads only files that
    are new, however late they come and whatever offsets they hold. Their rows are reduced to one per key before they
    meet the stored rows of the buckets they fall into; each batch of files is one two-phase merge.

    A build that fails is taken up again by the next: files of a batch count as read once the merge is done, and as the
    greatest version wins, merging one twice changes nothing. Files are never read again, so a file that is rewritten
    under its old name is not seen; ``forget_newest`` starts from the beginning.
    """
    order = [order_col] if isinstance(order_col, str) else order_col

    def merge(batch: DataFrame, _: int) -> None:
        newest = latest_by(batch, keys, order, nulls).withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        merge_table(batch.sparkSession, namespace, name, newest, [*keys, BUCKET], BUCKET, combine=lambda old, new: newest_of(old, new, keys, order, nulls))

    landed = spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_batch).parquet(source)
    query = landed.writeStream.foreachBatch(merge).option("checkpointLocation", _progress(spark, namespace, name)).trigger(availableNow=True).start()
    query.awaitTermination()
    if not spark.catalog.tableExists(f"{namespace}.{name}"):  # nothing has landed yet
        shape = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        merge(spark.createDataFrame([], shape), 0)
    spark.catalog.refreshTable(f"`{namespace}`.`{name}`")
    return newest_versions(spark, namespace, name)


def newest_versions(spark: SparkSession, namespace: str, name: str) -> DataFrame:
    """The rows that ``update_newest`` keeps."""
    return spark.table(f"`{namespace}`.`{name}`").drop(BUCKET)


def forget_newest(spark: SparkSession, namespace: str, name: str) -> None:
    """Drops the table with all it knows, so that the next build reads every file."""
    drop_table(spark, namespace, name)
    for part in ("__merges", "__progress"):
        Folder(spark, f"{_database_folder(spark, namespace)}/{name}{part}").delete()


def update_intervals(
    spark: SparkSession,
    namespace: str,
    name: str,
    changes: DataFrame,
    entities: DataFrame,
    current: DataFrame,
    *,
    keys: list[str],
    **columns,
) -> DataFrame:
    """Brings stored intervals up to date with ``changes``, ``entities`` and ``current``, and returns them.

    Beside the intervals the table ``<name>__seen`` holds what they were made from: a print of each key's changes and of its
    entity and present value. Keys that only have more changes are spliced, keys where anything else differs are replayed;
    all others keep their rows. The prints are replaced after the intervals: a build that fails in between does the same
    keys again.
    """
    ts, tie, entity = columns["ts"], columns["tie_break"], columns["entity"]
    used = [*keys, ts, tie, columns["old"], columns["new"], *columns["attrs"]]
    mark = changes.select(*used, F.xxhash64(*used).alias("_print"), F.lit(0).alias("_kind"))
    held = current.select(*keys, F.xxhash64(*keys, *columns["attrs"], columns["value"]).alias("_own"))
    born = entities.select(entity, F.xxhash64(entity, columns["origin"]).alias("_born"))
    # One print per change, one per present value and one per entity; the last two make their keys be replayed.
    now = mark.select(*keys, "_print", "_kind").unionByName(held.select(*keys, F.col("_own").alias("_print"), F.lit(1).alias("_kind")))
    others = born.select(*[F.col(k) if k == entity else F.lit(None).cast(changes.schema[k].dataType).alias(k) for k in keys], F.col("_born").alias("_print"), F.lit(2).alias("_kind"))
    now = now.unionByName(others)
    if not spark.catalog.tableExists(f"{namespace}.{name}") or not spark.catalog.tableExists(f"{namespace}.{name}__seen"):
        from vitrine.operators import scd2_replay

        write_table(scd2_replay(changes, entities, current, keys=keys, **columns), namespace, name)
        write_table(now, namespace, f"{name}__seen")
        return spark.table(f"`{namespace}`.`{name}`")
    seen = spark.table(f"`{namespace}`.`{name}__seen`")
    counted = now.withColumn("_n", F.lit(1)).unionByName(seen.withColumn("_n", F.lit(-1)))
    differ = counted.groupBy(*keys, "_print", "_kind").agg(F.sum("_n").alias("_n")).filter("_n != 0").checkpoint()
    more = differ.filter("_kind = 0 and _n > 0").select(*keys, F.col("_print").alias("_fresh")).distinct()
    fresh_rows = changes.withColumn("_print", F.xxhash64(*used)).alias("c").join(
        more.select(F.col("_fresh")).distinct(), F.col("_print") == F.col("_fresh"), "left_semi"
    )
    again = differ.filter("(_kind = 0 and (_n < 0 or _n > 1)) or _kind = 1").select(*keys)
    new_entities = differ.filter("_kind = 2").select(entity).distinct()
    of_entities = changes.select(*keys).unionByName(current.select(*keys)).join(new_entities, entity, "left_semi")
    spliced = scd2_splice(
        spark.table(f"`{namespace}`.`{name}`"), changes, fresh_rows.drop("_print"), entities, current, again.unionByName(of_entities).distinct(), keys=keys, **columns
    )
    write_table(spliced, namespace, name)
    write_table(now, namespace, f"{name}__seen")
    return spark.table(f"`{namespace}`.`{name}`")


def update_activity(
    df: DataFrame,
    namespace: str,
    name: str,
    *,
    date: str,
    member: str,
    as_of: dt.date,
    days: int = 7,
    bits: int = MASK_DAYS,
) -> DataFrame:
    """Moves the stored masks to ``as_of`` by the rows ``df`` that are new, and returns the days whose counts they change.

    ``df`` holds the rows of the days after the last call, and late ones of days before it; rows that were given
    already change nothing. The result has (date, daily, trailing) for every active day from the earliest one given to
    ``as_of``; its rows replace those of their date (``merge_table``). The masks are read and written, older rows are not. A
    row too old for the masks to tell its days is refused.
    """
    spark = df.sparkSession
    table = f"`{namespace}`.`{name}`"
    lag = F.datediff(F.lit(as_of), F.col(date))
    ahead, late = df.agg(F.min(lag), F.max(lag)).first()
    exists = spark.catalog.tableExists(f"{namespace}.{name}")
    before = spark.table(table).agg(F.max("as_of")).first()[0] if exists else None
    gap = (as_of - before).days if before else 0
    if gap < 0 or (ahead is not None and ahead < 0):
        raise ValueError(f"{namespace}.{name} is at {before}; rows and builds go forward from there to {as_of}")
    back = max(late or 0, gap - 1, 0)
    if days + back > bits:
        raise ValueError(f"rows of {back} days before {as_of}: masks of {bits} days do not tell {days} days on each")
    batch = activity_masks(df, date=date, member=member, as_of=as_of, bits=bits)
    old = spark.table(table).select("member", "mask") if before else batch.limit(0)
    masks = roll_masks(old, batch, gap, bits).withColumn("as_of", F.lit(as_of))
    stored = write_table(masks, namespace, name)
    return trailing_of_masks(stored, as_of=as_of, date=date, days=days, back=back, bits=bits)
