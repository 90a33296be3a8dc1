"""First-touch attribution and per-campaign ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions import ratio_or_null
from vitrine.operators.joins import lookup


def first_touch(
    users: DataFrame,
    campaigns: DataFrame,
    *,
    fk: str,
    pk: str,
    label: str,
    default: str,
) -> DataFrame:
    """Users with their campaign's columns; ``label`` is ``default`` where there is no campaign."""
    keyed = campaigns.withColumnRenamed(pk, fk)
    found = lookup(users, keyed, [fk])
    return found.withColumn(label, F.coalesce(F.col(label), F.lit(default)))


def ratio_per_entity(
    entities: DataFrame,
    events: DataFrame,
    *,
    key: str,
    numerator: str,
    count_out: str,
    ratio_out: str,
    scale: float = 1.0,
) -> DataFrame:
    """Entities with their number of events and numerator / scale / count; NULL for no events.

    Events are counted per key before the join.
    """
    counts = events.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(count_out))
    joined = entities.join(counts, key, "left").withColumn(
        count_out, F.coalesce(F.col(count_out), F.lit(0).cast("long"))
    )
    scaled = F.col(numerator).cast("double") / F.lit(float(scale))
    return joined.withColumn(ratio_out, ratio_or_null(scaled, count_out))


def rollup_via_bridge(
    measures: DataFrame,
    bridge: DataFrame,
    *,
    member: str,
    entity: str,
    value: str,
    out: str,
) -> DataFrame:
    """Sum of ``value`` per entity, where ``bridge`` (member, entity) says whose member each row is.

    Measures are summed per member first, so both join inputs have one row per member.
    """
    per_member = measures.groupBy(member).agg(F.sum(value).alias("_sum"))
    owned = bridge.filter(F.col(entity).isNotNull()).select(member, entity)
    return owned.join(per_member, member, "inner").groupBy(entity).agg(F.sum("_sum").alias(out))
