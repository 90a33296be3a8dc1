from vitrine.functions.scalar import (
    KEY_NULL_TEXT,
    days_between,
    minutes_between,
    ratio_or_null,
    ratio_or_zero,
    surrogate_key,
    timestamp_text,
)

__all__ = [
    "KEY_NULL_TEXT",
    "days_between",
    "minutes_between",
    "ratio_or_null",
    "ratio_or_zero",
    "surrogate_key",
    "timestamp_text",
]
