"""Write every model to its namespace, then record what was written."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from vitrine.plans.checks import check_registry, source_registry
from vitrine.plans.pipeline_health import source_freshness
from vitrine.plans.views import view_query
from vitrine.plans.warehouse import LAYER_OF, MODELS, Warehouse
from vitrine.sinks import append_table, layer_namespace, merge_table, namespace_tables, stored_row_count, write_table, write_view

# Event-scale facts are laid out by day, so that readers of a period skip the other files.
PARTITIONED = {
    "fct_playtime_sessions": "started_date",
    "fct_concurrent_player_snapshots": "snapshot_date",
    "fct_product_funnel_sessions": "session_date",
}

HEALTH_NAMESPACE = "elementary"
#: Where exchange rates are stored on a deployed target that names no base namespace.
RATES_NAMESPACE = "seeds"


def publish(
    wh: Warehouse,
    target: str,
    prefix: str | None,
    *,
    views: tuple[str, ...] = ("int",),
    models: list[str] | None = None,
    partitioned: bool = True,
) -> dict[str, str]:
    """Build models in dependency order; returns {model: namespace}.

    Layers in ``views`` are not materialised: a model with a SQL text becomes a stored view over the stored
    tables it reads, the exchange rates among them; others, and views over inputs that are not stored, are
    built into the models that read them and leave nothing in the catalog. Staging is written by default although it could be a view
    (``views=("stg", "int")``): most staging tables feed several marts, and the newest-row reduction of a
    landing table, which holds every version ever emitted, should run once per build. Written models
    are read back by the models after them.
    """
    placed: dict[str, str] = {}
    stored: dict[str, str] = {}

    def place(table: str) -> str | None:
        if table == "fx_rates" and table not in stored:
            home = layer_namespace(None, target, prefix) or RATES_NAMESPACE
            write_table(wh.fx_rates, home, table)
            stored[table] = home
        return f"`{stored[table]}`.`{table}`" if table in stored else None

    for name in MODELS if models is None else models:
        layer = LAYER_OF[name]
        namespace = layer_namespace(layer, target, prefix)
        df = wh[name]
        if layer in views:
            query = view_query(name, place)
            if query is not None:
                write_view(wh.spark, namespace, name, query)
        else:
            day = PARTITIONED.get(name) if partitioned else None
            if day:
                # One or a few files per day; AQE splits a heavy day and merges light ones.
                df = df.hint("rebalance", day)
            wh.settle(name, write_table(df, namespace, name, [day] if day else None))
            stored[name] = namespace
        placed[name] = namespace
    return placed


def record_row_counts(wh: Warehouse, namespaces: list[str], target: str, prefix: str | None) -> DataFrame:
    """Merge today's row count of every stored table into ``fct_row_counts``.

    Only the namespace literally named after the health tables is left out, so prefixed copies of it
    are counted, and so is the history table itself.
    """
    today: dt.date = wh.as_of.date()
    names = sorted(namespace_tables(wh.spark, namespaces, excluded=(HEALTH_NAMESPACE,)))
    # A row per table; the counts come from file footers, not from scans.
    counts = [(ns, t, today, stored_row_count(wh.spark, ns, t)) for ns, t in names]
    counted = wh.spark.createDataFrame(counts, "schema_name string, table_name string, snapshot_date date, row_count long")
    home = layer_namespace("marts_core", target, prefix)
    keys = ["schema_name", "table_name", "snapshot_date"]
    wh.settle("fct_row_counts", merge_table(wh.spark, home, "fct_row_counts", counted, keys, partition="snapshot_date"))
    return wh["fct_row_counts"]


def record_health(wh: Warehouse, results: DataFrame, target: str, prefix: str | None) -> str:
    """Add check results, freshness of the sources and the source registry to the history of the health namespace.

    The registries of tests and models describe the present and are replaced. Returns the namespace.
    """
    home = layer_namespace(HEALTH_NAMESPACE, target, prefix)
    append_table(results, home, "run_results")
    append_table(source_freshness(wh), home, "source_freshness_results")
    append_table(source_registry(wh), home, "sources")
    tests, models = check_registry(wh)
    write_table(tests, home, "tests")
    write_table(models, home, "models")
    return home


def stored_health(wh: Warehouse, namespace: str) -> None:
    """Let the health marts read what ``record_health`` has stored in ``namespace``, and forget what they held."""
    wh.health = lambda name: wh.spark.table(f"`{namespace}`.`{name}`")
    for name in ("fct_dbt_test_results", "fct_source_freshness"):
        wh.forget(name)
