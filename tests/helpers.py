"""Small hand-made warehouses for unit tests."""

import datetime as dt
from decimal import Decimal as D

from martstar import schemas as S
from martstar.functions.calendar import calendar_columns
from martstar.tables import Tables, empty_tables
from pyspark.sql import functions as F


def dim_date_for(spark, dates, dow="iso"):
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    return df.select(*calendar_columns(F.col("d"), dow), F.lit(None).cast("timestamp").alias("created_at"))


def did(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def make_tables(spark, prices, rates=(), stocks=None, extra_dates=()):
    """prices: (symbol, date, open, high, low, close, volume, daily_return or None)."""
    t = empty_tables(spark)
    symbols = stocks or sorted({p[0] for p in prices})
    dim_stocks = spark.createDataFrame(
        [(i + 1, s, f"{s} Inc.", None, None, True, None, None) for i, s in enumerate(symbols)], S.DIM_STOCKS)
    sid = {s: i + 1 for i, s in enumerate(symbols)}
    dates = sorted({p[1] for p in prices} | {r[0] for r in rates} | set(extra_dates))
    rows = [(sid[s], did(d), D(str(o)), D(str(h)), D(str(lo)), D(str(c)), v, D(str(c)),
             None if r is None else D(str(r)), None, None) for s, d, o, h, lo, c, v, r in prices]
    fsp = spark.createDataFrame(rows, S.FACT_STOCK_PRICES)
    fcr = spark.createDataFrame([(1, 2, did(d), D(str(x)), None, None) for d, x in rates], S.FACT_CURRENCY_RATES)
    cur = spark.createDataFrame([(1, "USD", "US Dollar", True, True, None),
                                 (2, "GBP", "British Pound", False, True, None)], S.DIM_CURRENCY)
    return t.with_(dim_stocks=dim_stocks, dim_date=dim_date_for(spark, dates) if dates else t.dim_date,
                   dim_currency=cur, prices=fsp, rates=fcr)
