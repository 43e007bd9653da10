"""Data-quality checks over the warehouse.

All price checks share one scan of the fact (conditional counts in one
aggregate); duplicates need one ``groupBy`` on the key (partial aggregation
first); the rate check is one scan of the rate fact. The one-row results are
stacked into ``(check_name, violation_count, severity)`` rows.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import date_of_id
from ..tables import Tables
from .common import bounded, day_id, on_day


def _price_measures(t: Tables, as_of: _dt.date, tracked: Sequence[str]) -> DataFrame:
    """All measures of the price fact as one row, from one pass over it.

    Rows are combined by key first (the duplicate check needs that), so the
    tracked stocks are joined to one row per key.
    """
    o, h, lo, c, r = (F.col(x) for x in ("opening_price", "high_price", "low_price",
                                         "closing_price", "daily_return"))
    keys = t.prices.groupBy("stock_id", "date_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((o <= 0) | (h <= 0) | (lo <= 0) | (c <= 0)).alias("negative"),
        F.count_if((h < lo) | (c > h) | (c < lo) | (o > h) | (o < lo)).alias("invalid"),
        F.count_if((r < -50) | (r > 50)).alias("extreme"))
    wanted = t.dim_stocks.where(F.col("symbol").isin(list(tracked))).select("stock_id", F.lit(True).alias("tracked"))
    recent = F.col("tracked") & (F.col("date_id") >= day_id(as_of - _dt.timedelta(days=30)))
    zero = F.lit(0).cast("bigint")
    return keys.join(bounded(wanted), "stock_id", "left").agg(
        F.count_if(F.col("n") > 1).alias("duplicates"),
        F.coalesce(F.sum("negative"), zero).alias("negative_prices"),
        F.coalesce(F.sum("invalid"), zero).alias("invalid_relationships"),
        F.coalesce(F.sum("extreme"), zero).alias("extreme_returns"),
        date_of_id(F.max("date_id")).alias("max_date"),
        F.count_distinct(F.when(recent, F.col("stock_id"))).alias("tracked_present"))


def _rows(df: DataFrame, rows) -> DataFrame:
    """One-row aggregate -> one output row per (check_name, count, severity)."""
    arr = F.array(*[F.struct(F.lit(n).alias("check_name"), v.cast("bigint").alias("violation_count"),
                             F.lit(s).alias("severity")) for n, v, s in rows])
    return df.select(F.inline(arr))


def quality_checks(t: Tables, as_of: _dt.date, tracked: Sequence[str]) -> DataFrame:
    """The seven checks of the daily ETL as rows, from one row of measures per fact."""
    bad_rates = t.rates.agg(F.count_if(F.col("exchange_rate") <= 0).alias("bad_rates"))
    measures = _price_measures(t, as_of, tracked).join(bad_rates, how="cross")  # one row each
    missing_recent = F.when(F.col("max_date") < F.date_sub(F.lit(as_of), 7), 1).otherwise(0)
    # fixed output values: names and severities
    return _rows(measures, [
        ("Duplicate stock prices", F.col("duplicates"), "CRITICAL"),
        ("Negative stock prices", F.col("negative_prices"), "CRITICAL"),
        ("Invalid price relationships", F.col("invalid_relationships"), "CRITICAL"),
        ("Extreme daily returns", F.col("extreme_returns"), "WARNING"),
        ("Invalid currency rates", F.col("bad_rates"), "CRITICAL"),
        ("Missing recent data", missing_recent, "WARNING"),
        ("Missing stock data", F.lit(len(tracked)) - F.col("tracked_present"), "WARNING")])


def quality_score(t: Tables) -> DataFrame:
    """OVERALL_QUALITY_SCORE: 0.0 with critical issues, 0.7 with > 5 warnings,
    0.9 with any warning, else 1.0 (counts price sign and extreme returns only)."""
    o, h, lo, c, r = (F.col(x) for x in ("opening_price", "high_price", "low_price",
                                         "closing_price", "daily_return"))
    m = t.prices.agg(
        F.count_if((o <= 0) | (h <= 0) | (lo <= 0) | (c <= 0)).alias("critical"),
        F.count_if((r < -50) | (r > 50)).alias("warnings"))
    score = (F.when(F.col("critical") > 0, 0.0).when(F.col("warnings") > 5, 0.7)
             .when(F.col("warnings") > 0, 0.9).otherwise(1.0))
    return m.select(F.lit("OVERALL_QUALITY_SCORE").alias("metric_name"),
                    score.cast("double").alias("quality_score"))


def quality_status(t: Tables, date: _dt.date, expected: int = 7) -> DataFrame:
    """PASS / WARN / FAIL status of one day's loads."""
    p = on_day(t, day_id(date)).prices
    m = p.agg(F.count(F.lit(1)).alias("total_records"),
              F.count_distinct("stock_id").alias("unique_stocks"),
              F.count_if(F.col("daily_return").isNull()).alias("null_returns"),
              F.count_if(F.col("volume") == 0).alias("zero_volume_records"))
    status = (F.when(F.col("unique_stocks") < expected, "FAIL: Missing stock data")
              .when(F.col("total_records") < expected, "FAIL: Insufficient records")
              .when(F.col("null_returns") > 1, "WARN: High null return rate")
              .when(F.col("zero_volume_records") > 0, "WARN: Zero volume detected")
              .otherwise("PASS: Data quality acceptable"))
    return m.select(status.alias("quality_status"), "total_records", "unique_stocks",
                    "null_returns", "zero_volume_records")
