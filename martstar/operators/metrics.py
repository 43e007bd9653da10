"""Per-bar and per-rate metrics, summaries and conversions (column expressions)."""

from __future__ import annotations

import datetime as _dt
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import mean_half_up

BAR_COLS = {"open": "opening_price", "high": "high_price", "low": "low_price",
            "close": "closing_price", "volume": "volume"}


def _d(c: Column) -> Column:
    return c.cast("double")


def bar_metrics(bars: DataFrame, gap_pct: float = 2.0, cols: dict | None = None,
                digits: Optional[int] = 6) -> DataFrame:
    """Intraday return %, volatility %, gap-up / gap-down flags of each bar.

    gap-up compares the open with the day's low and gap-down the high with the
    open (the reference never looks at the previous close).
    """
    n = {**BAR_COLS, **(cols or {})}
    o, h, lo, c = (_d(F.col(n[k])) for k in ("open", "high", "low", "close"))
    mid = (h + lo) / 2
    ret = F.when(o != 0, (c - o) / o * 100)
    vol = F.when(mid == 0, F.lit(0.0)).otherwise((h - lo) / mid * 100)
    rnd = (lambda x: F.round(x, digits)) if digits is not None else (lambda x: x)
    return bars.select(
        "*", rnd(ret).alias("intraday_return_pct"), rnd(vol).alias("volatility_pct"),
        (F.try_divide(o - lo, lo) * 100 > gap_pct).alias("is_gap_up"),
        (F.try_divide(h - o, o) * 100 > gap_pct).alias("is_gap_down"))


def points_frame(bars: DataFrame, source: str = "alpha_vantage", data_type: str = "daily",
                 cols: dict | None = None, date_col: str = "date_value",
                 symbol_col: str = "symbol") -> DataFrame:
    """Validated bars as the reference's analysis frame (returns null -> 0)."""
    m = bar_metrics(bars, cols=cols, digits=None)
    n = {**BAR_COLS, **(cols or {})}
    return m.select(
        F.col(date_col).alias("Date"), F.col(symbol_col).alias("Symbol"),
        _d(F.col(n["open"])).alias("Open"), _d(F.col(n["high"])).alias("High"),
        _d(F.col(n["low"])).alias("Low"), _d(F.col(n["close"])).alias("Close"),
        F.col(n["volume"]).cast("bigint").alias("Volume"),
        F.round(F.coalesce(F.col("intraday_return_pct"), F.lit(0.0)), 6).alias("Daily_Return_Pct"),
        F.round(F.col("volatility_pct"), 6).alias("Volatility_Pct"),
        F.lit(source).alias("Source"), F.lit(data_type).alias("Data_Type"))


def symbol_summary(bars: DataFrame, symbol_col: str = "symbol", date_col: str = "date_value",
                   close_col: str = "closing_price", volume_col: str = "volume",
                   close_scale: int = 4, digits: int = 6) -> DataFrame:
    """Per-symbol summary: counts, close and volume statistics, date range.

    Means are exact and rounded half away from zero to ``digits`` places.
    """
    c, v = F.col(close_col), F.col(volume_col)
    return bars.groupBy(symbol_col).agg(
        F.count(F.lit(1)).alias("point_count"),
        F.min(date_col).alias("start_date"), F.max(date_col).alias("end_date"),
        F.min(c).alias("min_close"), F.max(c).alias("max_close"),
        mean_half_up(c, close_scale, digits).alias("avg_close"),
        F.max_by(c, F.col(date_col)).alias("latest_close"),
        F.min(v).alias("min_volume"), F.max(v).alias("max_volume"),
        mean_half_up(v, 0, digits).alias("avg_volume"), F.sum(v).alias("total_volume"))


def _inv6(rate: Column) -> Column:
    """1 / rate quantized to 6 places, half-to-even, in exact integer arithmetic.

    rate has 6 places (R = rate * 10^6), so 1/rate * 10^6 = 10^12 / R.
    """
    r = (rate * F.lit(10 ** 6)).cast("decimal(38,0)")
    num = F.lit(10 ** 12).cast("decimal(38,0)")
    q = F.floor(num / r).cast("decimal(38,0)")
    q = F.when(q * r > num, q - 1).otherwise(q)
    q = F.when((q + 1) * r <= num, q + 1).otherwise(q)
    rem2 = (num - q * r) * 2
    q = (F.when(rem2 > r, q + 1)
         .when((rem2 == r) & (F.pmod(q, F.lit(2)) == 1), q + 1).otherwise(q))
    return F.when(r > 0, (q / F.lit(10 ** 6)).cast("decimal(18,6)"))


def inverse_rates(rates: DataFrame, from_col: str = "from_currency",
                  to_col: str = "to_currency", rate_col: str = "rate",
                  bid_col: Optional[str] = "bid_rate", ask_col: Optional[str] = "ask_rate") -> DataFrame:
    """Inverse quotes: currencies swapped, 1/rate at 6 places; the inverse bid
    comes from the ask and the inverse ask from the bid."""
    keep = [c for c in rates.columns if c not in {from_col, to_col, rate_col, bid_col, ask_col}]
    out = [F.col(to_col).alias(from_col), F.col(from_col).alias(to_col),
           _inv6(F.col(rate_col)).alias(rate_col)]
    if bid_col in rates.columns and ask_col in rates.columns:
        out += [_inv6(F.col(ask_col)).alias(bid_col), _inv6(F.col(bid_col)).alias(ask_col)]
    return rates.select(*keep, *out)


def convert_amounts(df: DataFrame, amount_col: str = "amount", rate_col: str = "rate",
                    bid_col: str = "bid_rate", use_bid: bool = False) -> DataFrame:
    """amount * rate, or amount * bid when asked for and a bid exists."""
    r = F.col(rate_col)
    if use_bid and bid_col in df.columns:
        r = F.coalesce(F.col(bid_col), r)
    return df.withColumn("converted_amount", F.col(amount_col) * r)


def rate_metrics(rates: DataFrame, as_of_ts: _dt.datetime, max_age_hours: int = 24,
                 from_col: str = "from_currency", to_col: str = "to_currency",
                 rate_col: str = "rate", bid_col: str = "bid_rate", ask_col: str = "ask_rate",
                 ts_col: str = "timestamp") -> DataFrame:
    """Spread %, staleness flag and pair name of each quote."""
    bid, ask, rate = F.col(bid_col), F.col(ask_col), F.col(rate_col)
    spread = F.when(bid.isNotNull() & ask.isNotNull(),
                    F.try_divide(_d(ask) - _d(bid), _d(rate)) * 100)
    age_s = F.lit(as_of_ts).cast("timestamp").cast("long") - F.col(ts_col).cast("timestamp").cast("long")
    return rates.select(
        "*", spread.alias("spread_pct"),
        (age_s > max_age_hours * 3600).alias("is_stale"),
        F.concat(F.col(from_col), F.col(to_col)).alias("pair_name"))
