"""Column expressions shared by the models. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for NULL inside a hashed key.
KEY_NULL_TEXT = "_dbt_utils_surrogate_key_null_"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: str | Column) -> Column:
    """md5 over the text of the parts, joined by '-'; NULL parts hash as a fixed text."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit(KEY_NULL_TEXT)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def timestamp_text(ts: str | Column) -> Column:
    """Text of an instant with all six fractional digits, so that key text never varies in width."""
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Minute boundaries crossed: 00:00:59 to 00:01:01 is one minute."""
    first = F.unix_seconds(F.date_trunc("minute", _col(start)))
    last = F.unix_seconds(F.date_trunc("minute", _col(end)))
    return ((last - first) / F.lit(60)).cast("long")


def days_between(start: str | Column, end: str | Column) -> Column:
    """Midnights crossed: 23:00 to 01:00 the next day is one day."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def ratio_or_zero(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator as double; 0 for a zero denominator, NULL for a NULL one."""
    n, d = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(d == 0, F.lit(0.0)).otherwise(n / d)


def ratio_or_null(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator as double; NULL for a zero or NULL denominator."""
    n, d = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(d != 0, n / d)
