from vitrine.sources.landing import FRESHNESS_HOURS, LANDING, read_landing
from vitrine.sources.reference_data import FX_RATES_SCHEMA, HEALTH_SCHEMAS, read_fx_rates, read_health

__all__ = [
    "FRESHNESS_HOURS",
    "FX_RATES_SCHEMA",
    "HEALTH_SCHEMAS",
    "LANDING",
    "read_fx_rates",
    "read_health",
    "read_landing",
]
