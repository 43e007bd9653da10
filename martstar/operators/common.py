"""Shared building blocks of the analytic operators.

Size bounds used for broadcast decisions:

* ``dim_date``: one row per calendar day (36.5k rows per century);
* ``dim_currency``: one row per currency code (ISO 4217 has < 200);
* rates of one currency pair: one row per day, bounded like ``dim_date``.

These are broadcast explicitly. ``dim_stocks`` grows with the listed universe
and is left to the planner / AQE, which broadcasts it only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from typing import Iterable, Optional, Sequence, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.calendar import date_of_id
from ..tables import PAIR, Tables

Symbols = Optional[Union[Sequence[str], DataFrame]]


def bounded(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by the calendar or a code list."""
    return F.broadcast(df)


def currency_id(t: Tables, code: str) -> Column:
    """Uncorrelated scalar subquery: the id of a currency code."""
    return (t.dim_currency.where(F.col("currency_code") == F.lit(code))
            .select("currency_id").scalar())


def pair_rates(t: Tables, pair: tuple[str, str] = PAIR) -> DataFrame:
    """Rates of one currency pair: ``date_id, exchange_rate`` (one row per day)."""
    return (t.rates
            .where((F.col("from_currency_id") == currency_id(t, pair[0]))
                   & (F.col("to_currency_id") == currency_id(t, pair[1])))
            .select("date_id", "exchange_rate"))


def star(t: Tables, active_only: bool = True, columns: Iterable[str] | None = None) -> DataFrame:
    """Fact rows joined to stock and date dimensions (inner, as in the reference)."""
    stocks = t.dim_stocks
    if active_only:
        stocks = stocks.where(F.col("is_active"))
    stocks = stocks.select("stock_id", "symbol", "company_name")
    dates = bounded(t.dim_date.select("date_id", "date_value"))
    prices = t.prices
    if columns is not None:
        prices = prices.select("stock_id", "date_id", *columns)
    return prices.join(stocks, "stock_id").join(dates, "date_id")


def latest_stock_date(t: Tables) -> Column:
    """Scalar subquery: the latest date that has any stock price."""
    return _last_days(t).agg(date_of_id(F.max("date_id"))).scalar()


def restrict_symbols(df: DataFrame, symbols: Symbols, col: str = "symbol") -> DataFrame:
    """IN-list filter on a tracked set given as a list or as a one-column table."""
    if symbols is None:
        return df
    if isinstance(symbols, DataFrame):
        tracked = symbols.select(F.col(symbols.columns[0]).alias(col)).distinct()
        return df.join(tracked, col, "left_semi")
    return df.where(F.col(col).isin(list(symbols)))


def converted(price: Column, rate: Column, scale: int = 4) -> Column:
    """ROUND(price * rate, 4) in decimal arithmetic (half-up, as PostgreSQL)."""
    return F.round(price * rate, scale).cast(S.CONVERTED)


def latest_stock_date_id(t: Tables) -> Column:
    """Scalar subquery: ``date_id`` of the latest price row.

    ``date_id`` is ``yyyyMMdd`` (see ``functions.calendar``), so its maximum is
    the latest date; only the ``date_id`` column of the fact is read, and the
    value then filters the fact scan itself (a runtime pushed filter that
    skips the date-sorted row groups of other days). Where the fact is
    partitioned only the last year in the listing is read.
    """
    return _last_days(t).agg(F.max("date_id")).scalar()


def _last_days(t: Tables) -> DataFrame:
    return t.prices if t.last_year is None else t.prices_where(low=t.last_year * 10000)


def latest_rate_date_id(t: Tables, pair: tuple[str, str] = PAIR) -> Column:
    """Scalar subquery: ``date_id`` of the latest rate of the pair."""
    return pair_rates(t, pair).agg(F.max("date_id")).scalar()


def day_id(d) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def on_day(t: Tables, date_id) -> Tables:
    """The warehouse restricted to the prices of one day (filter at the scan)."""
    return t.with_(prices=t.prices_where(date_id, date_id))


def since(t: Tables, first_day) -> Tables:
    """The warehouse restricted to prices on or after ``first_day`` (a date):
    the ``date_id`` range reaches the fact scan as a pushed filter."""
    return t.with_(prices=t.prices_where(low=day_id(first_day)))
