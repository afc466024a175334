"""Dense calendar spine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import weekday_name


def date_spine(df: DataFrame, ts_col: str, out: str = "date_day") -> DataFrame:
    """Every calendar day from the first to the last day of ``ts_col``.

    The bounds are one partial/final aggregate; the spine is generated from a
    single row with ``sequence`` + ``explode`` (inclusive on both ends).  Its
    size is the number of days in the range, not the number of input rows.
    No input rows (or only nulls) yield an empty spine.
    """
    bounds = df.agg(F.min(F.to_date(ts_col)).alias("lo"), F.max(F.to_date(ts_col)).alias("hi"))
    return bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias(out))


def calendar_attributes(spine: DataFrame, day: str = "date_day") -> DataFrame:
    d = F.col(day)
    return spine.select(
        d.alias(day),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        weekday_name(d).alias("weekday"),
    )
