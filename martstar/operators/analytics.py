"""User-facing analytic queries and views (all lazy DataFrames).

Every function takes the warehouse ``Tables`` and explicit parameters; nothing
reads the clock (``as_of`` replaces CURRENT_DATE).
"""

from __future__ import annotations

import datetime as _dt
from typing import Optional

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.numeric import mean_half_up, rounded_mean, scaled
from ..functions.ranking import grouped_rank
from ..tables import PAIR, Tables
from .merge import staged
from .common import (Symbols, bounded, converted, day_id, latest_rate_date_id, latest_stock_date,
                     latest_stock_date_id, on_day, pair_rates, restrict_symbols, since, star)


def _with_pair(t: Tables, rows: DataFrame, pair, how: str = "inner") -> DataFrame:
    return rows.join(bounded(pair_rates(t, pair)), "date_id", how)


# -- Q1 / Q2 ---------------------------------------------------------------

def top_performers(t: Tables, k: int = 5, symbols: Symbols = None,
                   pair: tuple[str, str] = PAIR) -> DataFrame:
    """Top-k daily returns on the latest stock date (rate row required).

    The top-k is taken first (``TakeOrderedAndProject``: per-partition top-k,
    no global sort); the rank is then computed over those k rows, which is the
    same as over all rows of the day because every row ranked above a top-k
    row is itself in the top-k.
    """
    rows = star(on_day(t, latest_stock_date_id(t)), columns=["closing_price", "daily_return", "volume"])
    rows = _with_pair(t, rows, pair)
    rows = restrict_symbols(rows, symbols)
    rows = rows.where(F.col("daily_return").isNotNull())
    top = rows.orderBy(F.col("daily_return").desc(), F.col("symbol")).limit(k)
    return top.select(
        "symbol", "company_name", F.col("date_value").alias("trade_date"),
        F.col("closing_price").alias("price_usd"), "daily_return", "volume",
        converted(F.col("closing_price"), F.coalesce(F.col("exchange_rate"), F.lit(1))).alias("price_gbp"),
        F.rank().over(Window.orderBy(F.col("daily_return").desc())).alias("performance_rank"))


def tracked_top_performers(t: Tables, symbols: Symbols, k: int = 3,
                           pair: tuple[str, str] = PAIR) -> DataFrame:
    return top_performers(t, k=k, symbols=symbols, pair=pair)


# -- Q3 ------------------------------------------------------------------

def rank_desc_nulls_first(history: DataFrame, targets: DataFrame, value: str,
                          key: str) -> DataFrame:
    """All-time ``RANK() OVER (ORDER BY value DESC NULLS FIRST)`` of some rows.

    ``rank(x) = 1 + #(value IS NULL) + #(value > x)`` for non-null x, 1 for null.
    The history is first combined into counts per distinct value (map-side,
    then by value). Values are grouped into buckets of a thousandth: counts of
    the buckets above, plus counts of the values above within the bucket. The
    running sum over buckets is over at most 2 * 10^5 rows, as a return is a
    ``DECIMAL(8,6)``; the one within a bucket over at most 1,000. No sort of the
    history, no pairs of rows, and any number of targets. The counts are kept
    (checkpointed), so the history is read once.
    """
    counts = staged(history.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
                    .withColumn("b", F.floor(F.col(value) * 1000)))
    nulls = counts.agg(F.coalesce(F.sum(F.when(F.col(value).isNull(), F.col("n"))), F.lit(0)).alias("nulls"))
    known = counts.where(F.col(value).isNotNull())

    def before(w):
        return w.rowsBetween(Window.unboundedPreceding, -1)

    buckets = known.groupBy("b").agg(F.sum("n").alias("n")).select(
        "b", F.coalesce(F.sum("n").over(before(Window.orderBy(F.col("b").desc()))), F.lit(0)).alias("above"))
    within = F.coalesce(F.sum("n").over(before(Window.partitionBy("b").orderBy(F.col(value).desc()))), F.lit(0))
    ranked = (known.select(value, "b", within.alias("within")).join(bounded(buckets), "b")
              .select(F.col(value).alias("_value"), (F.col("above") + F.col("within")).alias("above")))
    joined = targets.join(ranked, F.col(value) == F.col("_value"), "left").join(bounded(nulls), how="cross")
    return joined.select(
        key, F.when(F.col(value).isNull(), F.lit(1))
        .otherwise(F.col("nulls") + F.col("above") + 1).cast("int").alias("performance_rank"))


def _last_rows(t: Tables, history, n: int) -> Tables:
    """The warehouse from the first of the last years in which every stock of ``history``
    that trades in the last one has ``n`` rows. The last two years are looked at, then
    twice as many as before, one count each."""
    if t.prices_by_year is None or t.last_year is None:
        return t
    span = 2
    while t.last_year - span + 1 > t.first_year:
        low = (t.last_year - span + 1) * 10000
        counts = history(t.with_(prices=t.prices_where(low=low)), []).groupBy("symbol").agg(
            F.count(F.lit(1)).alias("n"), F.max("date_id").alias("last"))
        if counts.where((F.col("last") >= t.last_year * 10000) & (F.col("n") < n)).isEmpty():
            return t.with_(prices=t.prices_where(low=low))
        span *= 2
    return t


def performance_details(t: Tables, symbols: Symbols, window: int = 30,
                        pair: tuple[str, str] = PAIR) -> DataFrame:
    """30-row rolling metrics of each tracked symbol on the latest stock date.

    Frames are rows (``ROWS 29 PRECEDING``); the 30-rows-ago close needs 31
    rows. Only the last ``window + 1`` rows per symbol are kept
    (``row_number <= 31`` plans as a WindowGroupLimit, applied before the
    shuffle), then ordinary conditional aggregates give the frame values of
    the latest row.
    """
    def history(tables: Tables, columns: list[str]) -> DataFrame:
        return restrict_symbols(_with_pair(t, star(tables, columns=columns), pair), symbols)

    rows = history(_last_rows(t, history, window + 1), ["closing_price", "daily_return", "volume"])
    rn = F.row_number().over(Window.partitionBy("symbol").orderBy(F.col("date_value").desc()))
    last = rows.withColumn("rn", rn).where(F.col("rn") <= window + 1)
    inw = F.col("rn") <= window
    per = last.groupBy("symbol").agg(
        F.max(F.when(F.col("rn") == 1, F.col("date_value"))).alias("trade_date"),
        F.max(F.when(F.col("rn") == 1, F.col("closing_price"))).alias("price_usd"),
        F.max(F.when(F.col("rn") == 1, F.col("exchange_rate"))).alias("exchange_rate"),
        F.max(F.when(F.col("rn") == 1, F.col("daily_return"))).alias("daily_return"),
        F.max(F.when(F.col("rn") == 1, F.col("volume"))).alias("volume"),
        rounded_mean(F.sum(F.when(inw, scaled(F.col("closing_price"), 4))),
                     F.count(F.when(inw, F.col("closing_price"))), 4, 4).alias("avg_price"),
        rounded_mean(F.sum(F.when(inw, scaled(F.col("volume"), 0))),
                     F.count(F.when(inw, F.col("volume"))), 0, 0).alias("avg_volume"),
        F.stddev_samp(F.when(inw, F.col("daily_return").cast("double"))).alias("vol"),
        F.max(F.when(F.col("rn") == window + 1, F.col("closing_price"))).alias("p_ago"))
    per = staged(per.where(F.col("trade_date") == latest_stock_date(t)))  # one row per symbol, read twice
    ranks = rank_desc_nulls_first(history(t, ["daily_return"]).select("daily_return"), per.select("symbol", "daily_return"),
                                  "daily_return", "symbol")
    p, p0 = F.col("price_usd"), F.col("p_ago")
    change = F.when(p0.isNotNull() & (p0 > 0),
                    F.round((p.cast("double") - p0.cast("double")) / p0.cast("double") * 100, 4))
    names = t.dim_stocks.select("symbol", "company_name")
    return per.join(ranks, "symbol").join(names, "symbol").select(
        "symbol", "company_name", "trade_date", "price_usd",
        converted(p, F.coalesce(F.col("exchange_rate"), F.lit(1))).alias("price_gbp"),
        "daily_return", "volume", "performance_rank",
        F.col("avg_price").alias("avg_price_30d_usd"),
        F.col("avg_volume").cast("bigint").alias("avg_volume_30d"),
        F.round(F.col("vol"), 6).alias("volatility_30d"),
        change.alias("price_change_30d_pct"))


# -- Q4 / X4 -------------------------------------------------------------

def price_range(t: Tables, lo, hi, date: Optional[_dt.date] = None,
                pair: tuple[str, str] = PAIR) -> DataFrame:
    """Stocks whose close lies in [lo, hi] on ``date`` (default: latest stock date)."""
    day = day_id(date) if date is not None else latest_stock_date_id(t)
    rows = star(on_day(t, day), columns=["closing_price", "daily_return", "volume", "opening_price",
                                         "high_price", "low_price"])
    rows = _with_pair(t, rows, pair)
    rows = rows.where(F.col("closing_price").between(F.lit(lo), F.lit(hi)))
    return rows.select(
        "symbol", "company_name", F.col("date_value").alias("trade_date"),
        F.col("closing_price").alias("price_usd"), "daily_return", "volume",
        "opening_price", "high_price", "low_price",
        converted(F.col("closing_price"), F.coalesce(F.col("exchange_rate"), F.lit(1))).alias("price_gbp"))


def price_range_on(t: Tables, lo, hi, date: Optional[_dt.date] = None,
                   pair: tuple[str, str] = PAIR) -> DataFrame:
    return price_range(t, lo, hi, date=date, pair=pair)


# -- Q5 ------------------------------------------------------------------

def currency_conversion(t: Tables, symbol: Optional[str] = None,
                        pair: tuple[str, str] = PAIR) -> DataFrame:
    """Prices converted at the latest date that has a rate of the pair."""
    rows = star(on_day(t, latest_rate_date_id(t, pair)), columns=["closing_price"])
    rows = _with_pair(t, rows, pair)
    if symbol is not None:
        rows = rows.where(F.col("symbol") == F.lit(symbol))
    return rows.select(
        "symbol", "company_name", F.col("date_value").alias("rate_date"),
        F.col("closing_price").alias("price_usd"),
        F.col("exchange_rate").alias("usd_to_gbp_rate"),
        converted(F.col("closing_price"), F.col("exchange_rate")).alias("price_gbp"))


# -- Q6 / X3 -------------------------------------------------------------

def prices_with_currency(t: Tables, symbols=None, date: Optional[_dt.date] = None,
                         pair: tuple[str, str] = PAIR) -> DataFrame:
    """Prices with the day's rate when there is one (genuine left join).

    ``shares_outstanding`` is an optional fact column; without it market caps
    are NULL.
    """
    cols = ["closing_price", "volume", "daily_return"]
    has_shares = "shares_outstanding" in t.prices.columns
    if has_shares:
        cols.append("shares_outstanding")
    rows = star(t if date is None else on_day(t, day_id(date)), columns=cols)
    if isinstance(symbols, str):
        symbols = [symbols]
    rows = restrict_symbols(rows, symbols)
    rows = _with_pair(t, rows, pair, how="left")
    c, r = F.col("closing_price"), F.col("exchange_rate")
    shares = F.col("shares_outstanding") if has_shares else F.lit(None).cast("bigint")
    return rows.select(
        "symbol", "company_name", F.col("date_value").alias("trade_date"),
        c.alias("price_usd"), converted(c, r).alias("price_gbp"),
        r.alias("usd_to_gbp_rate"), "volume", "daily_return",
        # 15 digits: the product with both factors stays exact within 38
        F.round(c * shares.cast("decimal(15,0)"), 2).alias("market_cap_usd"),
        F.round(c * shares.cast("decimal(15,0)") * r, 2).alias("market_cap_gbp"))


def gbp_prices(t: Tables, symbols=None, date: Optional[_dt.date] = None,
               pair: tuple[str, str] = PAIR) -> DataFrame:
    """Prices that have a rate, converted by multiplication."""
    rows = star(t if date is None else on_day(t, day_id(date)), columns=["closing_price"])
    rows = restrict_symbols(rows, [symbols] if isinstance(symbols, str) else symbols)
    rows = _with_pair(t, rows, pair)
    return rows.select("symbol", "company_name", F.col("date_value").alias("trade_date"),
                       F.col("closing_price").alias("price_usd"),
                       F.col("exchange_rate").alias("usd_to_gbp_rate"),
                       converted(F.col("closing_price"), F.col("exchange_rate")).alias("price_gbp"))


# -- Q7 / X5 -------------------------------------------------------------

def daily_summary(t: Tables, as_of: _dt.date, days: int = 30, limit: int = 30,
                  pair: tuple[str, str] = PAIR) -> DataFrame:
    """Per (date, rate) summary of the last ``days`` calendar days, newest first."""
    rows = star(since(t, as_of - _dt.timedelta(days=days)), columns=["closing_price", "daily_return", "volume"])
    rows = _with_pair(t, rows, pair)
    rows = rows.where(F.col("date_value") >= F.date_sub(F.lit(as_of), days))
    c, r = F.col("closing_price"), F.col("daily_return")
    agg = rows.groupBy("date_value", "exchange_rate").agg(
        F.count("stock_id").alias("stocks_count"),
        F.sum("volume").alias("total_volume"),
        mean_half_up(c, 4, 4).alias("avg_closing_price_usd"),
        F.round(F.min(c), 4).alias("min_closing_price_usd"),
        F.round(F.max(c), 4).alias("max_closing_price_usd"),
        mean_half_up(r, 6, 6).alias("avg_daily_return_pct"),
        F.round(F.min(r), 6).alias("min_daily_return_pct"),
        F.round(F.max(r), 6).alias("max_daily_return_pct"),
        mean_half_up(F.col("volume"), 0, 0).alias("avg_volume"),
        mean_half_up(c * F.coalesce(F.col("exchange_rate"), F.lit(1)), 10, 4)
        .alias("avg_closing_price_gbp"))
    top = agg.orderBy(F.col("date_value").desc()).limit(limit)
    return top.select(F.col("date_value").alias("summary_date"),
                      F.col("exchange_rate").alias("usd_to_gbp_rate"),
                      *[c for c in agg.columns if c not in ("date_value", "exchange_rate")])


def summary_on(t: Tables, date: Optional[_dt.date] = None) -> DataFrame:
    """Market summary of one date (default: the latest stock date)."""
    day = day_id(date) if date is not None else latest_stock_date_id(t)
    rows = star(on_day(t, day), columns=["closing_price", "daily_return", "volume"])
    c, r = F.col("closing_price"), F.col("daily_return")
    return rows.groupBy(F.col("date_value").alias("summary_date")).agg(
        F.count("stock_id").alias("stocks_count"),
        F.sum("volume").alias("total_volume"),
        mean_half_up(c, 4, 4).alias("avg_closing_price_usd"),
        mean_half_up(r, 6, 6).alias("avg_daily_return_pct"),
        F.max(r).alias("max_daily_return_pct"),
        F.min(r).alias("min_daily_return_pct"))


# -- views ---------------------------------------------------------------

def latest_prices(t: Tables, pair: tuple[str, str] = PAIR) -> DataFrame:
    """View: full price history of active stocks, GBP price where a rate exists."""
    rows = star(t, columns=["closing_price", "volume", "daily_return", "opening_price",
                            "high_price", "low_price"])
    rows = _with_pair(t, rows, pair, how="left")
    return rows.select("symbol", "company_name", "date_value",
                       F.col("closing_price").alias("price_usd"), "volume", "daily_return",
                       "opening_price", "high_price", "low_price",
                       converted(F.col("closing_price"), F.col("exchange_rate")).alias("price_gbp"))


def daily_performance(t: Tables, digits: Optional[int] = None) -> DataFrame:
    """View: per-date aggregates over active stocks.

    ``digits`` rounds the averages exactly (half away from zero); ``None``
    keeps Spark's decimal averages.
    """
    rows = star(t, columns=["closing_price", "volume", "daily_return"])

    def mean(c: str, scale: int):
        return F.avg(c) if digits is None else mean_half_up(F.col(c), scale, digits)

    return rows.groupBy("date_value").agg(
        F.count("stock_id").alias("stocks_traded"),
        mean("daily_return", 6).alias("avg_daily_return"),
        F.max("daily_return").alias("max_daily_return"),
        F.min("daily_return").alias("min_daily_return"),
        F.sum("volume").alias("total_volume"),
        mean("closing_price", 4).alias("avg_closing_price"))


def stock_rankings(t: Tables) -> DataFrame:
    """View: return and volume ranks within each date (DESC = NULLS FIRST)."""
    rows = star(t, columns=["closing_price", "daily_return", "volume"])
    rows = rows.select("symbol", "company_name", "date_value", "closing_price", "daily_return", "volume")
    ranked = grouped_rank(rows, "date_value", "daily_return", "return_rank", ["symbol"], few=bounded)
    return grouped_rank(ranked, "date_value", "volume", "volume_rank", ["symbol"], few=bounded, counted=rows)


def latest_per_stock(t: Tables) -> DataFrame:
    """Latest price row of every stock (``DISTINCT ON (stock) ... ORDER BY date DESC``).

    A hash aggregate finds each stock's latest ``date_id`` (fixed-width
    buffers, partial aggregation before the shuffle); the few latest rows
    are then joined back and named through the dimensions.
    """
    latest = t.prices.groupBy("stock_id").agg(F.max("date_id").alias("date_id"))
    rows = t.prices.select("stock_id", "date_id", "closing_price", "volume").join(latest, ["stock_id", "date_id"],
                                                                                   "left_semi")
    stocks = t.dim_stocks.select("stock_id", "symbol", "company_name")
    dates = bounded(t.dim_date.select("date_id", "date_value"))
    return rows.join(stocks, "stock_id").join(dates, "date_id").select(
        "stock_id", "symbol", "company_name", F.col("closing_price").alias("current_price"),
        F.col("volume").alias("current_volume"), F.col("date_value").alias("price_date"))


def stock_performance(t: Tables, weekdays_only: bool = True) -> DataFrame:
    """Per-row performance: previous close, return, change, daily rank, 7/30-row averages."""
    rows = star(t, columns=["closing_price", "volume"])
    if weekdays_only:
        rows = rows.where(F.dayofweek("date_value").between(2, 6))
    ws = Window.partitionBy("symbol").orderBy("date_value")
    prev = F.lag("closing_price").over(ws)
    c = F.col("closing_price")
    out = rows.select(
        "symbol", "company_name", "date_value", "closing_price", "volume",
        prev.alias("prev_close"),
        rounded_mean(F.sum(scaled(c, 4)).over(ws.rowsBetween(-6, 0)),
                     F.count(c).over(ws.rowsBetween(-6, 0)), 4, 6).alias("ma_7_day"),
        rounded_mean(F.sum(scaled(c, 4)).over(ws.rowsBetween(-29, 0)),
                     F.count(c).over(ws.rowsBetween(-29, 0)), 4, 6).alias("ma_30_day"))
    pc = F.col("prev_close")
    out = out.withColumn("price_change_usd", c - pc).withColumn(
        "daily_return_pct",
        F.round((c.cast("double") - pc.cast("double")) / pc.cast("double") * 100, 4))
    return grouped_rank(out, "date_value", "daily_return_pct", "daily_rank", ["symbol"], few=bounded)


def top_returns_all_time(t: Tables, k: int = 5) -> DataFrame:
    """Top-k daily returns over all dates (no latest-date filter)."""
    rows = star(t, columns=["closing_price", "daily_return"])
    return (rows.where(F.col("daily_return").isNotNull())
            .orderBy(F.col("daily_return").desc(), F.col("date_value").desc(), F.col("symbol"))
            .limit(k)
            .select("symbol", "company_name", F.col("date_value").alias("trade_date"),
                    F.col("closing_price").alias("price_usd"), "daily_return"))
