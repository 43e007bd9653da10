"""Conforming vendor frames into landing records (stock and FX), lenient casts,
last-N selection and the prepare steps of the ingestion jobs."""

from __future__ import annotations

import datetime as _dt
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.checks import errors_array, rule

# Fixed values that must equal the reference's (column preferences).
STOCK_REQUIRED = ("Date", "Open", "High", "Low", "Close", "Volume")
FX_RATE_COLUMNS = ("Close", "4. close", "close")
FX_NON_RATE = ("Date", "DateTime", "From_Symbol", "To_Symbol", "FromCurrency", "ToCurrency")
SOURCE = "alpha_vantage"


def require_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Missing required columns (schema check on the driver; no data is read)."""
    return [c for c in required if c not in df.columns]


def check_frames(spark, frames: dict[str, DataFrame], required: Sequence[str]) -> DataFrame:
    """(frame, missing, has_rows, usable): a frame is usable with all required columns and a row.

    One row of each frame is looked for, in one job for all.
    """
    out = None
    for name, df in frames.items():
        missing = ", ".join(require_columns(df, required))
        found = df.select(F.lit(1).alias("x")).limit(1).agg(F.count(F.lit(1)).alias("n"))
        row = found.select(F.lit(name).alias("frame"), F.lit(missing).alias("missing"), (F.col("n") > 0).alias("has_rows"),
                           ((F.col("n") > 0) & F.lit(not missing)).alias("usable"))
        out = row if out is None else out.unionByName(row)
    return out if out is not None else spark.createDataFrame([], "frame string, missing string, has_rows boolean, usable boolean")


def _c(name: str) -> Column:
    """Column by exact name (vendor names contain dots and spaces)."""
    return F.col(f"`{name}`")


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def lenient_float(df: DataFrame, name: str) -> Column:
    c = _c(name)
    v = F.trim(c).try_cast("double") if _is_text(df, name) else c.cast("double")
    return v


def lenient_int(df: DataFrame, name: str) -> Column:
    """``int(x)``: text must be an integer literal; numbers are truncated."""
    c = _c(name)
    return F.trim(c).try_cast("bigint") if _is_text(df, name) else c.cast("double").cast("bigint")


def lenient_date(df: DataFrame, name: str) -> Column:
    c = _c(name)
    if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    return F.try_to_date(c.cast("string"), "yyyy-MM-dd")


def lenient_cast(df: DataFrame, as_of: _dt.date, floats: Sequence[str] = (), ints: Sequence[str] = (),
                 dates: Sequence[str] = ()) -> DataFrame:
    """Casts that never fail: bad floats -> 0.0, ints -> 0, dates -> ``as_of``.

    The reference silently writes these defaults; here the names of the
    fields that fell back are kept in ``conversion_errors``.
    """
    vals, errs = {}, []
    for n in floats:
        v = lenient_float(df, n)
        vals[n] = F.coalesce(v, F.lit(0.0))
        errs.append(rule(v.isNull(), f"{n}: not a number, using 0.0"))
    for n in ints:
        v = lenient_int(df, n)
        vals[n] = F.coalesce(v, F.lit(0).cast("bigint"))
        errs.append(rule(v.isNull(), f"{n}: not an integer, using 0"))
    for n in dates:
        v = lenient_date(df, n)
        vals[n] = F.coalesce(v, F.lit(as_of))
        errs.append(rule(v.isNull(), f"{n}: not a date, using as_of"))
    out = df.select(*[vals[c].alias(c) if c in vals else _c(c) for c in df.columns],
                    errors_array(*errs).alias("conversion_errors"))
    return out


def conform_stock(raw: DataFrame, as_of: _dt.date, as_of_ts: _dt.datetime, symbol_col: str = "Symbol",
                  source: str = SOURCE) -> DataFrame:
    """(Date, Open, High, Low, Close, Volume, Symbol) -> landing stock records."""
    missing = require_columns(raw, STOCK_REQUIRED)
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    c = lenient_cast(raw, as_of, floats=["Open", "High", "Low", "Close"], ints=["Volume"], dates=["Date"])
    return c.select(F.col(symbol_col).alias("symbol"), F.col("Date").alias("data_date"),
                    F.col("Open").alias("open_price"), F.col("High").alias("high_price"),
                    F.col("Low").alias("low_price"), F.col("Close").alias("close_price"),
                    F.col("Volume").alias("volume"), F.lit(source).alias("source"),
                    F.lit(as_of_ts).cast("timestamp").alias("created_at"), "conversion_errors")


def fx_rate_column(raw: DataFrame) -> Optional[str]:
    """The rate column: first of Close / 4. close / close, else the first
    numeric column that is not a date or currency column."""
    for c in FX_RATE_COLUMNS:
        if c in raw.columns:
            return c
    for f in raw.schema.fields:
        if f.name not in FX_NON_RATE and isinstance(f.dataType, T.NumericType):
            return f.name
    return None


def _codes(df: DataFrame, names: tuple[str, str], pair: tuple[str, str]) -> list[Column]:
    """The frame's own currency codes; the pair where it has none."""
    return [(F.coalesce(F.col(n), F.lit(code)) if n in df.columns else F.lit(code)).alias(out)
            for n, code, out in zip(names, pair, ("from_currency", "to_currency"))]


def conform_fx(raw: DataFrame, as_of: _dt.date, as_of_ts: _dt.datetime,
               pair: tuple[str, str] = ("USD", "GBP"), source: str = SOURCE) -> DataFrame:
    """FX frame -> landing rate records; a frame without a rate column yields no rows."""
    rc = fx_rate_column(raw)
    if rc is None:
        return raw.limit(0).select(
            F.lit(pair[0]).alias("from_currency"), F.lit(pair[1]).alias("to_currency"),
            F.lit(None).cast("date").alias("data_date"), F.lit(None).cast("double").alias("exchange_rate"),
            F.lit(source).alias("source"), F.lit(None).cast("timestamp").alias("created_at"))
    date_cols = [c for c in ("Date", "DateTime") if c in raw.columns]
    d = (F.coalesce(*[_c(c).cast("date") for c in date_cols]) if date_cols else F.lit(None).cast("date"))
    rate = lenient_float(raw, rc)
    return raw.select(
        *_codes(raw, ("FromCurrency", "ToCurrency"), pair),
        F.coalesce(d, F.lit(as_of)).alias("data_date"),
        F.coalesce(rate, F.lit(0.0)).alias("exchange_rate"),
        F.lit(source).alias("source"), F.lit(as_of_ts).cast("timestamp").alias("created_at"))


def conform_quote(quotes: DataFrame, as_of: _dt.date, as_of_ts: _dt.datetime,
                  pair: tuple[str, str] = ("USD", "GBP"), source: str = SOURCE) -> DataFrame:
    """Parsed realtime quotes -> rate records (rate <= 0 dropped; date from
    the first token of last_refreshed, else ``as_of``)."""
    first = F.split(F.trim(F.col("last_refreshed")), r"\s+").getItem(0)
    d = F.try_to_date(first, "yyyy-MM-dd")
    return quotes.where(F.col("exchange_rate") > 0).select(
        *_codes(quotes, ("from_currency", "to_currency"), pair),
        F.coalesce(d, F.lit(as_of)).alias("data_date"), F.col("exchange_rate"),
        F.lit(source).alias("source"), F.lit(as_of_ts).cast("timestamp").alias("created_at"))


def last_n(df: DataFrame, partition: Sequence[str], order: str, n: int) -> DataFrame:
    """The last ``n`` rows of each partition by ``order`` (``n <= 0``: all rows)."""
    if n <= 0:
        return df
    w = Window.partitionBy(*partition).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def prepare_stocks(frames: DataFrame, tracked: Sequence[str], n: int, as_of: _dt.date,
                   as_of_ts: _dt.datetime) -> DataFrame:
    """Last ``n`` daily rows of every tracked symbol, conformed; symbols
    without data are simply absent."""
    rows = frames.where(F.col("Symbol").isin(list(tracked)))
    return conform_stock(last_n(rows, ["Symbol"], "Date", n), as_of, as_of_ts)


def prepare_fx(series_records: DataFrame, quote_records: DataFrame, min_rows: int = 2) -> DataFrame:
    """Series records, plus the latest quote when the series has fewer than
    ``min_rows`` rows and the quote's date is not already there. Of several
    quotes the latest counts."""
    stats = series_records.agg(F.count(F.lit(1)).alias("_n"))
    latest = quote_records.orderBy(F.col("data_date").desc(), F.col("created_at").desc_nulls_last(),
                                   "exchange_rate").limit(1)
    extra = (latest.join(F.broadcast(stats), how="cross").where(F.col("_n") < min_rows).drop("_n")
             .join(series_records.select("data_date").distinct(), "data_date", "left_anti"))
    return series_records.unionByName(extra.select(*series_records.columns))
