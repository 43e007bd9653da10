"""Dimension maintenance: seeds, calendar rows, retention, dims from raw rows.

Every "insert if absent" is a ``left_anti`` join on the natural key followed
by a union, so re-running a step is idempotent.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns
from ..tables import Tables
from .merge import insert_absent

# Fixed values that must equal the reference's seed rows.
SEED_STOCKS = [
    ("AAPL", "Apple Inc.", "Technology", "Large Cap"),
    ("MSFT", "Microsoft Corporation", "Technology", "Large Cap"),
    ("AMZN", "Amazon.com Inc.", "Consumer Discretionary", "Large Cap"),
    ("GOOGL", "Alphabet Inc.", "Technology", "Large Cap"),
    ("META", "Meta Platforms Inc.", "Technology", "Large Cap"),
    ("NVDA", "NVIDIA Corporation", "Technology", "Large Cap"),
    ("TSLA", "Tesla Inc.", "Consumer Discretionary", "Large Cap"),
]
SEED_CURRENCIES = [("USD", "US Dollar", True), ("GBP", "British Pound", False)]


def _with_new_ids(target: DataFrame, new: DataFrame, id_col: str, order_col: str) -> DataFrame:
    """Sequence-like ids for new rows: max existing id + rank by ``order_col``.

    ``new`` holds the few absent seed/dimension rows, so the window over it
    is small by construction.
    """
    top = target.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_top"))
    return (new.join(top, how="cross")
            .withColumn(id_col, (F.col("_top") + F.row_number().over(Window.orderBy(order_col)))
                        .cast("int")).drop("_top"))


def seed_stocks(spark: SparkSession, dim_stocks: DataFrame, seeds=SEED_STOCKS) -> DataFrame:
    rows = spark.createDataFrame(seeds, "symbol string, company_name string, sector string, "
                                        "market_cap_category string")
    new = rows.join(dim_stocks.select("symbol"), "symbol", "left_anti")
    new = _with_new_ids(dim_stocks, new, "stock_id", "symbol").select(
        "stock_id", "symbol", "company_name", "sector", "market_cap_category",
        F.lit(True).alias("is_active"), F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"))
    return dim_stocks.unionByName(new.select(*dim_stocks.columns))


def seed_currencies(spark: SparkSession, dim_currency: DataFrame, seeds=SEED_CURRENCIES) -> DataFrame:
    rows = spark.createDataFrame(seeds, "currency_code string, currency_name string, is_base_currency boolean")
    new = rows.join(dim_currency.select("currency_code"), "currency_code", "left_anti")
    new = _with_new_ids(dim_currency, new, "currency_id", "currency_code").select(
        "currency_id", "currency_code", "currency_name", "is_base_currency",
        F.lit(True).alias("is_active"), F.lit(None).cast("timestamp").alias("created_at"))
    return dim_currency.unionByName(new.select(*dim_currency.columns))


def seed_dims(spark: SparkSession, t: Tables) -> Tables:
    return t.with_(dim_stocks=seed_stocks(spark, t.dim_stocks),
                   dim_currency=seed_currencies(spark, t.dim_currency))


def date_rows(dates: DataFrame, col: str = "date", dow: str = "iso") -> DataFrame:
    """Calendar rows of the distinct dates of ``dates[col]``."""
    d = dates.select(F.col(col).cast("date").alias("_d")).where(F.col("_d").isNotNull()).distinct()
    return d.select(*calendar_columns(F.col("_d"), dow=dow),
                    F.lit(None).cast("timestamp").alias("created_at"))


def ensure_dates(dim_date: DataFrame, dates: DataFrame, col: str = "date", dow: str = "iso") -> DataFrame:
    """Add a calendar row for every date not yet in ``dim_date``."""
    return insert_absent(dim_date, date_rows(dates, col, dow), ["date_value"])


def calendar_range(spark: SparkSession, start, end, dow: str = "iso") -> DataFrame:
    """Calendar rows of every day in [start, end] (Column or date bounds)."""
    s = start if isinstance(start, F.Column) else F.lit(start)
    e = end if isinstance(end, F.Column) else F.lit(end)
    days = spark.range(1).select(F.explode(F.sequence(s.cast("date"), e.cast("date"))).alias("date"))
    return date_rows(days, "date", dow)


def calendar(spark: SparkSession, dim_date: DataFrame, as_of: _dt.date, ahead: int = 30,
             dow: str = "iso") -> DataFrame:
    """The current year's days plus the next ``ahead`` days, inserted if absent."""
    year = F.trunc(F.lit(as_of), "year")
    rows = calendar_range(spark, year, F.date_sub(F.add_months(year, 12), 1), dow).unionByName(
        calendar_range(spark, F.date_add(F.lit(as_of), 1), F.date_add(F.lit(as_of), ahead), dow))
    return insert_absent(dim_date, rows.dropDuplicates(["date_value"]), ["date_value"])


def calendar_retention(spark: SparkSession, t: Tables, as_of: _dt.date, years: int = 5,
                       dow: str = "iso") -> DataFrame:
    """Drop calendar rows older than ``years`` that no fact uses; ensure ``as_of`` exists."""
    used = (t.prices.select("date_id").union(t.rates.select("date_id")).distinct())
    old = t.dim_date.where(F.col("date_value") < F.add_months(F.lit(as_of), -12 * years))
    drop = old.join(used, "date_id", "left_anti").select("date_id")
    kept = t.dim_date.join(drop, "date_id", "left_anti")
    return insert_absent(kept, calendar_range(spark, as_of, as_of, dow), ["date_value"])


def dims_from_raw(raw: DataFrame, dim_stocks: DataFrame, dim_date: DataFrame,
                  symbol_col: str = "symbol", date_col: str = "date") -> tuple[DataFrame, DataFrame]:
    """Distinct symbols and dates of raw rows that the dimensions do not know yet."""
    syms = (raw.select(F.col(symbol_col).alias("symbol")).distinct()
            .join(dim_stocks.select("symbol"), "symbol", "left_anti"))
    dates = (raw.select(F.col(date_col).cast("date").alias("date_value")).distinct()
             .join(dim_date.select("date_value"), "date_value", "left_anti"))
    return syms, dates