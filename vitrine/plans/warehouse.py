"""The inputs of one run, and the models built from them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

# Model name -> function of a Warehouse. Filled by the modules of this package.
MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {}
# Model name -> layer it is written to.
LAYER_OF: dict[str, str] = {}


def model(layer: str, name: str | None = None):
    """Register a function as a model of ``layer`` under its own name."""

    def register(fn):
        MODELS[name or fn.__name__] = fn
        LAYER_OF[name or fn.__name__] = layer
        return fn

    return register


@dataclass
class Warehouse:
    """``wh["dim_users"]`` is the model as a lazy DataFrame.

    Inputs are functions, called when a model first needs them. A model that ``publish`` has written is
    read back from its table by everything that follows.
    """

    spark: SparkSession
    landing: Callable[[str], DataFrame]
    fx: Callable[[], DataFrame]
    as_of: dt.datetime
    health: Callable[[str], DataFrame] | None = None
    # Newest versions of a landing table where they are kept from build to build (``sinks.update_newest``).
    newest: Callable[[str], DataFrame] | None = None
    # First day and the day after the last, or a function giving them as a one-row DataFrame.
    calendar: tuple[dt.date, dt.date] | Callable[[], DataFrame] = (dt.date(2023, 1, 1), dt.date(2027, 1, 1))
    written: dict[str, DataFrame] = field(default_factory=dict)
    _lazy: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        if self.as_of.tzinfo is None:
            self.as_of = self.as_of.replace(tzinfo=dt.timezone.utc)

    @cached_property
    def fx_rates(self) -> DataFrame:
        return self.fx()

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.written:
            return self.written[name]
        if name not in self._lazy:
            self._lazy[name] = MODELS[name](self)
        return self._lazy[name]

    def settle(self, name: str, table: DataFrame) -> None:
        """Read ``name`` from ``table`` from now on; lazy models built on the old plan are forgotten."""
        self.written[name] = table
        self._lazy.clear()

    def forget(self, name: str) -> None:
        """Build ``name`` anew when it is next asked for, although it has been written."""
        self.written.pop(name, None)
        self._lazy.clear()


from vitrine.plans import core, finance, intermediate, marketing, pipeline_health, product, staging  # noqa: E402,F401
