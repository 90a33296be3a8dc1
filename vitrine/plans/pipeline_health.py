"""Facts about checks, source freshness and table sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vitrine.operators import freshness, latest_by, lookup, pass_rate
from vitrine.plans.core import CORE
from vitrine.plans.warehouse import Warehouse, model
from vitrine.sources import FRESHNESS_HOURS, LANDING


@model(CORE)
def fct_dbt_test_results(wh: Warehouse) -> DataFrame:
    rates = pass_rate(wh.health("run_results"), wh.health("tests"), wh.health("models"))
    return rates.select("run_date", "schema_name", "test_count", "pass_count", "pass_rate")


@model(CORE)
def fct_source_freshness(wh: Warehouse) -> DataFrame:
    """Every freshness result ever taken, named by the newest registry row of its source."""
    registry = latest_by(wh.health("sources"), ["unique_id"], ["generated_at", "source_name", "name", "schema_name"]).selectExpr(
        "unique_id", "source_name", "name as table_name", "schema_name"
    )
    results = wh.health("source_freshness_results")
    return lookup(results, registry, ["unique_id"], "inner").select(
        "source_freshness_execution_id",
        "unique_id",
        "source_name",
        "table_name",
        "schema_name",
        "status",
        "max_loaded_at",
        "max_loaded_at_time_ago_in_s",
        "snapshotted_at",
        "error",
        "created_at",
    )


def source_freshness(wh: Warehouse) -> DataFrame:
    """Freshness of all landing tables at ``wh.as_of``, in the shape ``fct_source_freshness`` reads."""
    return freshness({name: wh.landing(name) for name in LANDING}, FRESHNESS_HOURS, wh.as_of)
