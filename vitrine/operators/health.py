"""Facts about the pipeline itself."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions import ratio_or_null


def pass_rate(results: DataFrame, tests: DataFrame, models: DataFrame) -> DataFrame:
    """Check runs and passes per (day, namespace of the checked model).

    Results are counted per (day, check) before they meet the registries.
    """
    per_test = (
        results.filter(F.col("resource_type") == "test")
        .groupBy("unique_id", F.to_date("created_at").alias("run_date"))
        .agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("status") == "pass").alias("_pass"))
    )
    owners = tests.select("unique_id", F.col("parent_model_unique_id").alias("_model"))
    namespaces = models.select(F.col("unique_id").alias("_model"), "schema_name")
    return (
        per_test.join(owners, "unique_id", "inner")
        .join(namespaces, "_model", "inner")
        .groupBy("run_date", "schema_name")
        .agg(F.sum("_n").alias("test_count"), F.sum("_pass").alias("pass_count"))
        .withColumn("pass_rate", ratio_or_null("pass_count", "test_count"))
    )


def freshness(
    sources: dict[str, DataFrame],
    thresholds: dict[str, tuple[float, float]],
    as_of: dt.datetime,
    *,
    loaded_ms: str = "__source_ts_ms",
    prefix: str = "source",
) -> DataFrame:
    """Age of the newest change in each source against (warn, error) hours: pass, warn or error.

    One narrow aggregate per source. An empty source has no newest change and is an error.
    """
    newest = [
        df.agg(F.max(loaded_ms).alias("_ms")).select(
            F.lit(f"{prefix}.{name}").alias("unique_id"),
            F.lit(float(thresholds[name][0]) * 3600).alias("_warn_s"),
            F.lit(float(thresholds[name][1]) * 3600).alias("_error_s"),
            "_ms",
        )
        for name, df in sources.items()
    ]
    now = F.lit(as_of).cast("timestamp")
    aged = reduce(DataFrame.unionByName, newest).withColumn(
        "_age", (F.unix_millis(now) - F.col("_ms")).cast("double") / F.lit(1000.0)
    )
    status = (
        F.when(F.col("_age").isNull() | (F.col("_age") > F.col("_error_s")), "error")
        .when(F.col("_age") > F.col("_warn_s"), "warn")
        .otherwise("pass")
    )
    return aged.select(
        F.md5(F.concat_ws("-", "unique_id", F.unix_millis(now).cast("string"))).alias("source_freshness_execution_id"),
        "unique_id",
        status.alias("status"),
        F.timestamp_millis("_ms").alias("max_loaded_at"),
        F.col("_age").alias("max_loaded_at_time_ago_in_s"),
        now.alias("snapshotted_at"),
        F.when(F.col("_ms").isNull(), "no rows").alias("error"),
        now.alias("created_at"),
    )


def row_counts(tables: dict[str, DataFrame], schema_name: str, snapshot_date: dt.date) -> DataFrame:
    """(schema_name, table_name, snapshot_date, row_count), one row per table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(schema_name).alias("schema_name"),
            F.lit(name).alias("table_name"),
            F.lit(snapshot_date).cast("date").alias("snapshot_date"),
            "row_count",
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` with ``incoming`` rows replacing those of equal key."""
    return existing.join(incoming.select(*keys), keys, "left_anti").unionByName(incoming)
