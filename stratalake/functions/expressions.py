"""Scalar column expressions (F1-F13).  All are built-in Spark functions, so
they compile into whole-stage codegen; none needs a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
UNKNOWN_CITY = "UNKNOWN"
OPEN_END = "9999-12-31 00:00:00"           # upper bound of an open validity window
KEY_SEPARATOR = "|"
HASH_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# -----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_code(c) -> Column:
    """``upper(trim(s))``; trims spaces only, like SQL TRIM."""
    return F.upper(F.trim(_c(c)))


def fill_unknown(c, value: str = UNKNOWN_CITY) -> Column:
    """null becomes ``value``; an empty string is kept."""
    return F.coalesce(_c(c), F.lit(value))


def zero_if_null(c) -> Column:
    """``coalesce(agg, 0)`` guard for aggregates over empty tables."""
    return F.coalesce(_c(c), F.lit(0))


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def valid_to_or_open(c) -> Column:
    """``coalesce(valid_to, timestamp '9999-12-31')``; without it every
    current version fails the upper bound of a point-in-time lookup."""
    return F.coalesce(_c(c), open_end())


def line_amount(quantity, unit_price, precision: int = 14, scale: int = 2) -> Column:
    """exact decimal ``quantity * unit_price`` cast to decimal(14,2)."""
    return (_c(quantity) * _c(unit_price)).cast(f"decimal({precision},{scale})")


def to_timestamp_ntz(c) -> Column:
    """string to zone-less timestamp."""
    return _c(c).cast("timestamp_ntz")


def to_day(c) -> Column:
    """timestamp to date."""
    return F.to_date(_c(c))


def weekday_name(c) -> Column:
    """full English day name (``Monday`` ...)."""
    return F.date_format(_c(c), "EEEE")


def version_key(key, valid_from) -> Column:
    """stable, unique surrogate key of one SCD2 version:
    md5 of ``<key>|<valid_from to the microsecond>``."""
    return F.md5(F.concat_ws(KEY_SEPARATOR, _c(key).cast("string"),
                             F.date_format(_c(valid_from), HASH_TS_FORMAT)))


def cents_drift(a, b) -> Column:
    """``abs(round(a - b, 2))``."""
    return F.abs(F.round(_c(a) - _c(b), 2))


def exact_total(c) -> Column:
    """Decimal sum widened to decimal(38,2): never passes through float."""
    return zero_if_null(F.sum(_c(c))).cast("decimal(38,2)")
