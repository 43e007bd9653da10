"""Ingestion status: inventory, freshness, staleness, missing days, latest rate,
archive split and table statistics."""

from __future__ import annotations

import datetime as _dt
from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_of_id
from ..tables import PAIR, Tables
from .common import bounded, pair_rates


def table_inventory(spark: SparkSession, t: Tables, landing_dir: Optional[str] = None) -> DataFrame:
    """Row count per table plus emptiness and health flags (one small union of counts)."""
    parts = []
    for name, df in (("dim_stocks", t.dim_stocks), ("dim_date", t.dim_date),
                     ("dim_currency", t.dim_currency), ("fact_stock_prices", t.prices),
                     ("fact_currency_rates", t.rates)):
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("table_name"), "row_count"))
    if landing_dir:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
                 .option("recursiveFileLookup", "true").load(landing_dir).select("path"))
        parts.append(files.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit("landing_files").alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    facts = out.where(F.col("table_name").startswith("fact_")).agg(
        F.sum("row_count").alias("_fact_rows"), F.min("row_count").alias("_min_fact"))
    return out.join(facts, how="cross").select(
        "table_name", "row_count",
        (F.col("_fact_rows") == 0).alias("is_database_empty"),
        (F.col("_min_fact") > 0).alias("healthy"))


WORD = 63  # days in one number


def freshness(t: Tables, symbols: Optional[Sequence[str]] = None) -> DataFrame:
    """Latest price date per symbol (joined through ``dim_stocks``)."""
    # date_id orders as the dates do, so the fact needs no join for its maximum
    p = t.prices.groupBy("stock_id").agg(date_of_id(F.max("date_id")).alias("latest_date"))
    out = p.join(t.dim_stocks.select("stock_id", "symbol"), "stock_id").select("symbol", "latest_date")
    if symbols is not None:
        out = out.where(F.col("symbol").isin(list(symbols)))
    return out


def stale_symbols(t: Tables, as_of: _dt.date, days: int = 2,
                  symbols: Optional[Sequence[str]] = None) -> DataFrame:
    return freshness(t, symbols).where(F.col("latest_date") < F.date_sub(F.lit(as_of), days))


def missing_dates(t: Tables, as_of: _dt.date, days: int = 10,
                  symbols: Optional[Sequence[str]] = None) -> DataFrame:
    """Non-weekend calendar days in [as_of - days, as_of] without a price row, per symbol.

    The days that a stock has are one bit each, gathered with ``bit_or`` (combined before
    the shuffle) into one number per stock and ``WORD`` days; absent bits are expanded.
    """
    first = as_of - _dt.timedelta(days=days)
    day = F.datediff(date_of_id(F.col("date_id")), F.lit(first))
    held = (t.prices_where(low=first.year * 10000 + first.month * 100 + first.day).select("stock_id", day.alias("day"))
            .where(F.col("day") <= days)
            .groupBy("stock_id", F.floor(F.col("day") / WORD).alias("word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("day") % WORD).cast("int"))).alias("bits")))
    stocks = t.dim_stocks.select("stock_id", "symbol")
    if symbols is not None:
        stocks = stocks.where(F.col("symbol").isin(list(symbols)))
    words = stocks.withColumn("word", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(days // WORD).cast("long"))))
    places = F.sequence(F.lit(0), F.least(F.lit(WORD - 1), F.lit(days) - F.col("word") * WORD).cast("int"))
    absent = F.filter(places, lambda i: F.getbit(F.coalesce("bits", F.lit(0).cast("long")), i) == 0)
    out = words.join(held, ["stock_id", "word"], "left").select("symbol", "word", F.explode(absent).alias("place"))
    out = out.select("symbol", F.date_add(F.lit(first), (F.col("word") * WORD + F.col("place")).cast("int")).alias("missing_date"))
    cal = bounded(t.dim_date.where(~F.col("is_weekend")).select(F.col("date_value").alias("missing_date")))
    return out.join(cal, "missing_date", "left_semi").select("symbol", "missing_date")


def missing_counts(t: Tables, as_of: _dt.date, days: int = 5,
                   symbols: Optional[Sequence[str]] = None) -> DataFrame:
    return (missing_dates(t, as_of, days, symbols).groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("missing_days")))


def latest_rate(t: Tables, pair: tuple[str, str] = PAIR, quotes: Optional[DataFrame] = None) -> DataFrame:
    """Latest date and rate of the pair (``max_by``).

    Where the series has no rate (or a zero), the latest of ``quotes`` (records of
    ``conform.conform_quote``) of the pair takes its place.
    """
    r = pair_rates(t, pair).join(bounded(t.dim_date.select("date_id", "date_value")), "date_id")
    series = r.agg(F.max("date_value").alias("rate_date"), F.max_by("exchange_rate", "date_value").alias("exchange_rate"))
    name = F.lit(f"{pair[0]}/{pair[1]}").alias("currency_pair")
    if quotes is None:
        return series.select(name, "rate_date", "exchange_rate")
    own = quotes.where((F.col("from_currency") == pair[0]) & (F.col("to_currency") == pair[1]) & (F.col("exchange_rate") != 0))
    order = F.struct("data_date", "created_at", "exchange_rate")
    quote = own.agg(F.max(F.col("data_date").cast("date")).alias("q_date"), F.max_by("exchange_rate", order).alias("q_rate"))
    has = F.coalesce(F.col("exchange_rate") != 0, F.lit(False))
    return series.join(quote, how="cross").select(
        name, F.when(has, F.col("rate_date")).otherwise(F.col("q_date")).alias("rate_date"),
        F.when(has, F.col("exchange_rate")).otherwise(F.col("q_rate").cast("decimal(10,6)")).alias("exchange_rate"))


def ingestion_status(spark: SparkSession, t: Tables, as_of: _dt.date, symbols: Sequence[str],
                     pair: tuple[str, str] = PAIR, stale_days: int = 2, missing_window: int = 5) -> DataFrame:
    """One row per tracked symbol: freshness, staleness, recent missing days,
    plus the pair's latest rate and the database health."""
    tracked = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    fr = tracked.join(freshness(t, symbols), "symbol", "left")
    mc = missing_counts(t, as_of, missing_window, symbols)
    inv = table_inventory(spark, t).agg(F.max("is_database_empty").alias("is_database_empty"),
                                         F.min(F.col("healthy").cast("int")).cast("boolean").alias("database_healthy"))
    out = (fr.join(mc, "symbol", "left").join(latest_rate(t, pair), how="cross").join(inv, how="cross"))
    return out.select(
        "symbol", "latest_date",
        (F.col("latest_date").isNull() | (F.col("latest_date") < F.date_sub(F.lit(as_of), stale_days)))
        .alias("is_stale"),
        F.coalesce(F.col("missing_days"), F.lit(0)).alias("missing_recent_days"),
        "currency_pair", "rate_date", "exchange_rate", "is_database_empty", "database_healthy")


def archive_split(t: Tables, as_of: _dt.date, years: int = 2) -> tuple[DataFrame, DataFrame]:
    """Price rows to keep and to archive (older than ``years``)."""
    # a constant on the fact's own column, so it reaches the scan
    cut = F.date_format(F.add_months(F.lit(as_of), -12 * years), "yyyyMMdd").cast("int")
    keep, archive = t.prices_where(low=cut), t.prices_where(high=cut - 1)
    return keep, archive
