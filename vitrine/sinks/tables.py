"""Where models end up: tables that are replaced in one step, merged in two phases, and stored views."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from urllib.parse import unquote

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.operators import upsert
from vitrine.session import ensure_checkpoint_dir

# The targets that build into the plain layer names.
DEPLOYED_TARGETS = ("prod", "staging")
# Fixed value: the folder name that stands for a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Replaced files stay this long, for readers that planned on them.
KEEP_HOURS = 24.0


def layer_namespace(layer: str | None, target: str, prefix: str | None) -> str:
    """Namespace of a layer: its own name on deployed targets, ``prefix_layer`` everywhere else.

    Without a layer the prefix itself is the namespace. Outside the deployed targets an empty prefix
    is refused, since it would write over the deployed names.
    """
    name = layer.strip() if layer is not None else None
    if target in DEPLOYED_TARGETS:
        return name if name is not None else prefix
    stem = (prefix or "").strip()
    if not stem:
        raise ValueError(f"target '{target}' needs a prefix: an empty one would write the deployed namespaces")
    return stem if name is None else f"{stem}_{name}"


class Folder:
    """A folder on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, name: str = "") -> JavaObject:
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    @property
    def _fs(self) -> JavaObject:
        return self._at().getFileSystem(self._conf)

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at())) if self._fs.exists(self._at()) else []

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def write(self, name: str, text: str) -> None:
        """A small file that is there as a whole or not at all."""
        out = self._fs.create(self._at(f"_{name}.tmp"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not self._fs.rename(self._at(f"_{name}.tmp"), self._at(name)):
            raise OSError(f"{self.path}/{name} is there already")

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def _database_folder(spark: SparkSession, namespace: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")
    return spark.catalog.getDatabase(namespace).locationUri.rstrip("/")


def _version() -> str:
    """A folder name that sorts by the time it was taken."""
    return f"{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex}"


@contextmanager
def _conf(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect() if r["data_type"]}


def _layout(df: DataFrame, partition_by: list[str]) -> list[tuple[str, str]]:
    inside = [f for f in df.schema if f.name not in partition_by]
    return [(f.name, f.dataType.simpleString()) for f in [*inside, *(df.schema[c] for c in partition_by)]]


def _create(spark: SparkSession, table: str, df: DataFrame, partition_by: list[str], folder: str) -> None:
    fields = [f for f in df.schema if f.name not in partition_by] + [df.schema[c] for c in partition_by]
    ddl = T.StructType([T.StructField(f.name, f.dataType) for f in fields]).toDDL()
    parted = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    # Partitions are found by listing the folder, so that one change of location moves them all.
    with _conf(spark, {"spark.sql.hive.manageFilesourcePartitions": "false"}):
        spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet {parted} LOCATION '{folder}'")


def _switch(spark: SparkSession, table: str, folder: str) -> None:
    """The one change of the catalog that makes a version the table."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def _clean(versions: Folder, keep_hours: float) -> None:
    """Deletes versions that were replaced longer ago than that, but never the last two."""
    names = versions.names()
    limit = time.time() * 1000 - keep_hours * 3_600_000
    for old, successor in zip(names[:-2], names[1:], strict=False):
        if int(successor.partition("-")[0]) < limit:
            versions.delete(old)


def write_table(df: DataFrame, namespace: str, name: str, partition_by: list[str] | None = None, keep_hours: float = KEEP_HOURS) -> DataFrame:
    """Rebuild ``namespace.name`` from ``df`` and return the written table.

    1. The rows are written to a folder of their own, a version, beside the versions before it.
    2. One change of the table's location in the catalog makes that version the table, all partitions at once.
    3. Versions replaced more than ``keep_hours`` ago are deleted, never the one before the present one.

    Readers see the old rows whole until 2 and the new ones whole after it; a query that was planned on the old ones
    ends on them. A failure before 2 leaves the old table, one after it the new one, and folders of failed attempts go
    with the versions of their time. ``df`` may read the table it replaces. Sessions that have read the table see the new
    version when they refresh it.

    Only where columns, their types or the partitioning change is the table dropped and created, which readers can meet;
    if creating fails, the old one is put back. An empty ``df`` gives an empty table.
    """
    spark = df.sparkSession
    parted = partition_by or []
    versions = Folder(spark, f"{_database_folder(spark, namespace)}/{name}__versions")
    table, version = f"`{namespace}`.`{name}`", _version()
    folder = f"{versions.path}/{version}"
    try:
        df.write.mode("errorifexists").partitionBy(*parted).parquet(folder)
    except Exception:
        versions.delete(version)
        raise
    if not spark.catalog.tableExists(f"{namespace}.{name}"):
        _create(spark, table, df, parted, folder)
    else:
        old = spark.table(table)
        described = _described(spark, table)
        old_parts = [c.name for c in spark.catalog.listColumns(f"{namespace}.{name}") if c.isPartition]
        switchable = described.get("Type") == "EXTERNAL" and described.get("Partition Provider") is None
        if switchable and old_parts == parted and _layout(old, old_parts) == _layout(df, parted):
            _switch(spark, table, folder)
        else:
            _recreate(spark, table, df, parted, folder, old, old_parts, described, switchable)
    _clean(versions, keep_hours)
    return spark.table(table)


def _recreate(spark, table, df, parted, folder, old, old_parts, described, switchable) -> None:
    spark.sql(f"DROP TABLE {table}")
    try:
        _create(spark, table, df, parted, folder)
    except Exception:
        if switchable:
            _create(spark, table, old, old_parts, described["Location"])
        raise


def drop_table(spark: SparkSession, namespace: str, name: str) -> None:
    """Drops a table with all its versions."""
    spark.sql(f"DROP TABLE IF EXISTS `{namespace}`.`{name}`")
    Folder(spark, f"{_database_folder(spark, namespace)}/{name}__versions").delete()


def append_table(df: DataFrame, namespace: str, name: str) -> DataFrame:
    """Add the rows of ``df`` to ``namespace.name``, which is made if need be, and return the table."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")
    table = f"`{namespace}`.`{name}`"
    if spark.catalog.tableExists(f"{namespace}.{name}"):
        df = df.select(*spark.table(table).columns)
    df.write.mode("append").format("parquet").saveAsTable(table)
    return spark.table(table)


def write_view(spark: SparkSession, namespace: str, name: str, query: str) -> DataFrame:
    """Store ``query``, SQL text over stored tables, as the view ``namespace.name`` and return it.

    The view belongs to the namespace: other sessions read it, and it goes with the namespace. Replacing it is one change of
    the catalog. A table of that name is refused.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")
    spark.sql(f"CREATE OR REPLACE VIEW `{namespace}`.`{name}` AS {query}")
    return spark.table(f"`{namespace}`.`{name}`")


def _partition_value(text: str) -> str:
    return "null" if text == NULL_PARTITION else "'" + unquote(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _locations(spark: SparkSession, table: str, partition: str) -> dict[str, str]:
    """Where the partitions of a table are, by their folder name."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        value = _partition_value(row[0].partition("=")[2])
        described = spark.sql(f"DESCRIBE FORMATTED {table} PARTITION (`{partition}` = {value})").collect()
        found[row[0]] = next(r["data_type"] for r in described if r["col_name"] == "Location")
    return found


def _apply(spark: SparkSession, table: str, partition: str, record: dict) -> None:
    """Points the partitions of a commit record to their merged files. Doing so again changes nothing."""
    for name, folder in record["partitions"].items():
        spec = f"PARTITION (`{partition}` = {_partition_value(name.partition('=')[2])})"
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def recover_table(spark: SparkSession, namespace: str, name: str, partition: str, keep_hours: float = KEEP_HOURS) -> int:
    """Carries out commit records that a failure left behind, oldest first, and returns their number.

    Then merged files that no record and no partition refers to, and that are older than ``keep_hours``, are deleted.
    """
    table = f"`{namespace}`.`{name}`"
    merges = Folder(spark, f"{_database_folder(spark, namespace)}/{name}__merges")
    names = merges.names()
    waiting = [n for n in names if n.endswith(".commit")]
    for n in waiting:
        _apply(spark, table, partition, json.loads(merges.read(n)))
        merges.delete(n)
    limit = time.time() * 1000 - keep_hours * 3_600_000
    old = [n for n in names if not n.startswith("_") and not n.endswith(".commit") and int(n.partition("-")[0]) < limit]
    if old:
        used = set(_locations(spark, table, partition).values())
        for n in old:
            if not any(f"/{n}/" in u for u in used):
                merges.delete(n)
    return len(waiting)


def merge_table(
    spark: SparkSession,
    namespace: str,
    name: str,
    incoming: DataFrame,
    keys: list[str],
    partition: str,
    keep_hours: float = KEEP_HOURS,
    combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Upsert ``incoming`` into ``namespace.name`` on ``keys``; ``partition`` is one of the keys, or follows from them.

    Parquet has no MERGE. The partitions that ``incoming`` touches are read, rows with new versions are replaced, and the
    result is written in two phases:

    1. The merged partitions are written beside the table, which does not know of them. A failure here changes nothing.
    2. A commit record names them: from that file on, written whole or not at all, the merge is done. Each partition
       is then pointed to its merged files, one change of the catalog each, and the record goes. What a failure in
       between leaves undone is done by ``recover_table``, with which every merge begins.

    Other partitions keep their files, and rows of a touched one that have no new version stay. A merge that is repeated
    gives the same table. Readers never see half a partition; one that comes while several partitions are switched may see
    some of them merged already. Merged files that were replaced are kept for ``keep_hours``.

    Two incoming rows of one key are refused, as no order says which of them should stay. Without incoming rows nothing
    changes, but the table is made if need be. ``combine`` gives the rows of a touched partition from the stored and the
    incoming ones, where that is not an upsert.
    """
    table = f"`{namespace}`.`{name}`"
    database = _database_folder(spark, namespace)
    exists = spark.catalog.tableExists(f"{namespace}.{name}")
    ensure_checkpoint_dir(spark)
    if exists:
        recover_table(spark, namespace, name, partition, keep_hours)
    columns = spark.table(table).columns if exists else [c for c in incoming.columns if c != partition] + [partition]
    fresh = incoming.select(*columns).checkpoint()
    twice = fresh.groupBy(*keys).count().filter("count > 1").first()
    if twice is not None:
        raise ValueError(f"{namespace}.{name}: {twice['count']} incoming rows with the key {[twice[k] for k in keys]}")
    if not exists:
        fresh.limit(0).write.format("parquet").partitionBy(partition).saveAsTable(table)
    merges, version = Folder(spark, f"{database}/{name}__merges"), _version()
    days = fresh.select(F.col(partition).alias("_touched")).distinct()
    touched = spark.table(table).join(days, F.col(partition).eqNullSafe(F.col("_touched")), "left_semi").select(*columns)
    try:
        merged = combine(touched, fresh) if combine else upsert(touched, fresh, keys)
        merged.select(*columns).write.partitionBy(partition).parquet(f"{merges.path}/{version}")
        names = [n for n in Folder(spark, f"{merges.path}/{version}").names() if "=" in n]
    except Exception:
        merges.delete(version)
        raise
    if names:
        record = {"partitions": {n: f"{merges.path}/{version}/{n}" for n in names}}
        merges.write(f"{version}.commit", json.dumps(record))
        _apply(spark, table, partition, record)
        merges.delete(f"{version}.commit")
    return spark.table(table)


def namespace_tables(spark: SparkSession, namespaces: list[str], excluded: tuple[str, ...] = ()) -> dict:
    """{(namespace, table): DataFrame} of the stored tables, without views and excluded namespaces."""
    found = {}
    for namespace in namespaces:
        if namespace in excluded:
            continue
        for t in spark.catalog.listTables(namespace):
            if t.tableType != "VIEW" and not t.isTemporary:
                found[(namespace, t.name)] = spark.table(f"`{namespace}`.`{t.name}`")
    return found


def stored_row_count(spark: SparkSession, namespace: str, name: str) -> int:
    """Rows of a stored table, from the footers of its parquet files; no column is read.

    The count is pushed down to the second version of the parquet source, which the catalog does not use, so that the
    files are read from where the catalog says they are. Tables in other formats are scanned.
    """
    df = footer_count(spark, namespace, name)
    return (spark.table(f"`{namespace}`.`{name}`").count() if df is None else _counted(spark, df)) or 0


#: The parquet source that takes counts from footers. Both settings are read when a plan is made.
FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def _counted(spark: SparkSession, df: DataFrame) -> int:
    with _conf(spark, FOOTERS):
        return df.first()[0]


def footer_count(spark: SparkSession, namespace: str, name: str) -> DataFrame | None:
    """The count over a table's files as one row, NULL where it has none; None if they are no parquet."""
    table = f"`{namespace}`.`{name}`"
    described = _described(spark, table)
    if described.get("Provider", "").lower() != "parquet":
        return None
    parts = [c.name for c in spark.catalog.listColumns(f"{namespace}.{name}") if c.isPartition]
    folders = [described["Location"]]
    if parts and described.get("Partition Provider") is not None:
        if len(parts) > 1:
            return None
        folders = list(_locations(spark, table, parts[0]).values())
    schema = T.StructType([f for f in spark.table(table).schema if f.name not in parts])
    if not folders or not len(schema):
        return None
    with _conf(spark, FOOTERS):
        return spark.read.schema(schema).parquet(*folders).agg(F.count(F.lit(1)).alias("row_count"))
