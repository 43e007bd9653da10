"""Presentation edge: response rows, query parameters and paging."""

from __future__ import annotations

import datetime as _dt
from typing import Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import PAIR, Tables
from .common import day_id, pair_rates, star

def _num(c: str):
    """``float(x) if x else None``: the reference's row builders turn 0 into NULL."""
    return F.nullif(F.col(c).cast("double"), F.lit(0.0))


def present_top(df: DataFrame) -> DataFrame:
    return df.select("symbol", "company_name", _num("price_usd").alias("price_usd"),
                     _num("price_gbp").alias("price_gbp"), _num("daily_return").alias("daily_return"),
                     F.col("volume").cast("bigint").alias("volume"), "trade_date",
                     "performance_rank")


def present_details(df: DataFrame) -> DataFrame:
    return df.select("symbol", "company_name", _num("price_usd").alias("price_usd"),
                     _num("price_gbp").alias("price_gbp"), _num("daily_return").alias("daily_return"),
                     F.col("volume").cast("bigint").alias("volume"), "trade_date", "performance_rank",
                     _num("avg_price_30d_usd").alias("avg_price_30d_usd"),
                     F.col("avg_volume_30d").cast("bigint").alias("avg_volume_30d"),
                     _num("volatility_30d").alias("volatility_30d"),
                     _num("price_change_30d_pct").alias("price_change_30d_pct"))


def present_currency(df: DataFrame) -> DataFrame:
    return df.select("symbol", "company_name", "trade_date", _num("price_usd").alias("price_usd"),
                     _num("price_gbp").alias("price_gbp"), _num("usd_to_gbp_rate").alias("usd_to_gbp_rate"),
                     F.col("volume").cast("bigint").alias("volume"), _num("daily_return").alias("daily_return"),
                     _num("market_cap_usd").alias("market_cap_usd"), _num("market_cap_gbp").alias("market_cap_gbp"))


def normalize_symbols(symbols: Sequence[str], max_count: int = 50, extra_chars: str = ".-") -> list[str]:
    """Upper-case, trim, validate and de-duplicate in order (request parameters).

    A symbol is alphanumeric apart from ``extra_chars`` (dots and hyphens by
    default, as the reference accepts).
    """
    out: list[str] = []
    for s in symbols:
        s = s.upper().strip()
        if not s:
            raise ValueError("Empty symbol not allowed")
        bare = s
        for ch in extra_chars:
            bare = bare.replace(ch, "")
        if not bare.isalnum():
            raise ValueError(f"Invalid symbol format: {s}")
        if s not in out:
            out.append(s)
    if not 1 <= len(out) <= max_count:
        raise ValueError(f"between 1 and {max_count} symbols required")
    return out


def check_dates(start: Optional[_dt.date], end: Optional[_dt.date], as_of: _dt.date) -> None:
    if start and end:
        if start > end:
            raise ValueError("start_date cannot be after end_date")
        if end > as_of:
            raise ValueError("end_date cannot be in the future")
    if start and start.year < 1980:
        raise ValueError("start_date cannot be before 1980")


def price_history(t: Tables, symbols: Sequence[str], as_of: _dt.date, start: Optional[_dt.date] = None,
                  end: Optional[_dt.date] = None, convert: bool = True,
                  pair: tuple[str, str] = PAIR, extra_chars: str = ".-") -> DataFrame:
    """Prices of the requested symbols in [start, end], optionally with GBP."""
    syms = normalize_symbols(symbols, extra_chars=extra_chars)
    check_dates(start, end, as_of)
    # the date range also filters the fact scan (date_id is yyyyMMdd)
    if start or end:
        t = t.with_(prices=t.prices_where(day_id(start) if start else None, day_id(end) if end else None))
    # symbols compare case-insensitively, as the request normalises them
    rows = (star(t, columns=["closing_price", "volume", "daily_return"])
            .where(F.upper(F.col("symbol")).isin(syms)))
    if start:
        rows = rows.where(F.col("date_value") >= F.lit(start))
    if end:
        rows = rows.where(F.col("date_value") <= F.lit(end))
    out = rows.select("symbol", "company_name", F.col("date_value").alias("trade_date"),
                      F.col("closing_price").alias("price_usd"), "volume", "daily_return", "date_id")
    if convert:
        out = out.join(pair_rates(t, pair), "date_id", "left").withColumn(
            "price_gbp", F.round(F.col("price_usd") * F.col("exchange_rate"), 4)).withColumnRenamed(
            "exchange_rate", "usd_to_gbp_rate")
    return out.drop("date_id")


def page(df: DataFrame, sort_by: str, order: str = "desc", page_no: int = 1, size: int = 50,
         tie_break: Sequence[str] = ()) -> DataFrame:
    """One page of a sorted result (``ORDER BY .. OFFSET .. LIMIT``)."""
    if not (1 <= page_no <= 1000 and 1 <= size <= 1000):
        raise ValueError("page and page_size must be between 1 and 1000")
    key = F.col(sort_by).desc() if order == "desc" else F.col(sort_by).asc()
    return df.orderBy(key, *[F.col(c) for c in tie_break]).offset((page_no - 1) * size).limit(size)


def page_info(df: DataFrame, page_no: int, size: int) -> DataFrame:
    """Paging totals of a result: items, pages, has next / previous."""
    n = df.agg(F.count(F.lit(1)).alias("total_items"))
    pages = ((F.col("total_items") + size - 1) / size).cast("bigint")
    return n.select(F.lit(page_no).alias("current_page"), F.lit(size).alias("page_size"), "total_items",
                    pages.alias("total_pages"), (F.lit(page_no) < pages).alias("has_next"),
                    F.lit(page_no > 1).alias("has_previous"))
