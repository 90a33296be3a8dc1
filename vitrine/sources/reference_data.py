"""Small reference inputs and the tables the check runner leaves behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FX_RATES_SCHEMA = "date date, currency string, rate_to_usd double"

HEALTH_SCHEMAS = {
    "run_results": "unique_id string, resource_type string, status string, created_at timestamp",
    "tests": "unique_id string, parent_model_unique_id string",
    "models": "unique_id string, schema_name string",
    "source_freshness_results": (
        "source_freshness_execution_id string, unique_id string, status string, max_loaded_at timestamp, "
        "max_loaded_at_time_ago_in_s double, snapshotted_at timestamp, error string, created_at timestamp"
    ),
    "sources": "unique_id string, source_name string, name string, schema_name string, generated_at timestamp",
}


def read_fx_rates(spark: SparkSession, path: str) -> DataFrame:
    """Daily rates from a CSV with a header. Its file size decides whether it is broadcast."""
    return spark.read.schema(FX_RATES_SCHEMA).csv(path, header=True)


def read_health(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the health tables from ``root/name`` parquet."""
    return spark.read.schema(HEALTH_SCHEMAS[name]).parquet(f"{root.rstrip('/')}/{name}")
