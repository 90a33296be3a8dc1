from vitrine.operators.activity import cohort_percentiles, daily_count, date_spine, peak_of_totals, trailing_distinct
from vitrine.operators.attribution import first_touch, ratio_per_entity, rollup_via_bridge
from vitrine.operators.health import freshness, pass_rate, row_counts, upsert
from vitrine.operators.journeys import conversion, converted_counts, funnel, stage_order_violations
from vitrine.operators.incremental import activity_masks, newest_of, roll_masks, scd2_splice, trailing_of_masks
from vitrine.operators.joins import lookup
from vitrine.operators.latest import latest_by
from vitrine.operators.money import fx_convert, refund_valuation, refunded_daily, signed_daily
from vitrine.operators.quality import (
    check_accepted_values,
    check_not_null,
    check_relationships,
    check_unique,
    check_unique_combination,
    diff_by_checksum,
    diff_by_key,
    fingerprint,
    value_counts,
)
from vitrine.operators.scd2 import previous_end, scd2_replay

__all__ = [
    "activity_masks",
    "check_accepted_values",
    "check_not_null",
    "check_relationships",
    "check_unique",
    "check_unique_combination",
    "cohort_percentiles",
    "conversion",
    "converted_counts",
    "daily_count",
    "date_spine",
    "diff_by_checksum",
    "diff_by_key",
    "fingerprint",
    "first_touch",
    "freshness",
    "funnel",
    "fx_convert",
    "latest_by",
    "lookup",
    "newest_of",
    "pass_rate",
    "peak_of_totals",
    "previous_end",
    "ratio_per_entity",
    "refund_valuation",
    "refunded_daily",
    "rollup_via_bridge",
    "roll_masks",
    "row_counts",
    "scd2_replay",
    "scd2_splice",
    "signed_daily",
    "stage_order_violations",
    "trailing_distinct",
    "trailing_of_masks",
    "upsert",
    "value_counts",
]
