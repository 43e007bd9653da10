"""Calendar columns of ``dim_date``.

``date_id`` is deterministic (``yyyyMMdd`` as an integer) instead of a
sequence, so every writer agrees on it without coordination.

Day-of-week conventions differ between the reference's SQL path (0 = Sunday)
and its Python path (1 = Monday .. 7 = Sunday); ``dow`` picks one:
``'iso'`` (default) or ``'sunday0'``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_id_of(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_of_id(date_id: Column) -> Column:
    return F.to_date(date_id.cast("string"), "yyyyMMdd")


def day_of_week(d: Column, dow: str = "iso") -> Column:
    if dow == "iso":
        return (F.weekday(d) + 1).cast("int")
    if dow == "sunday0":
        return (F.dayofweek(d) - 1).cast("int")
    raise ValueError(f"unknown day-of-week convention {dow!r}")


def calendar_columns(d: Column, dow: str = "iso") -> list[Column]:
    """All ``dim_date`` columns derived from a DATE column."""
    dw = day_of_week(d, dow)
    weekend = dw.isin(6, 7) if dow == "iso" else dw.isin(0, 6)
    return [
        date_id_of(d).alias("date_id"),
        d.alias("date_value"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        F.dayofmonth(d).cast("int").alias("day"),
        dw.alias("day_of_week"),
        F.dayofyear(d).cast("int").alias("day_of_year"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        weekend.alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    ]
