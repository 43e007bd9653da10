"""Binding of the driver's TPC-H-like tables to the market warehouse.

This is the only module that knows the driver's tables. One trade per line
item: a block of ``PARTS`` part keys is a stock, so stocks, bars and facts grow
with the data; the ship date is the trading day and ``retailprice * (1 -
discount)`` the trade price. Daily bars are aggregated per (symbol, day). The
exchange rate of a day is derived from the orders placed ``RATE_LAG`` days
before, so rates reach to the last trading day and the first days have none.
All rows of the tables are read.

Scale notes: ``lineitem`` is the only large input. A build deals its rows out by
stock once for each of the two tables of their size, and all that follows stays
where the rows are: the join with ``part`` (hashed, as a task holds few parts), the
bars, the returns and the write. A stock's day has hardly more than one trade, so
combining before the shuffle would only fill memory and spill. Bars are bounded by
symbols x trading days.

The same derivation exists as SQL text (``BINDING_SQL``) for the DuckDB
oracle.
"""

from __future__ import annotations

import datetime as _dt
from typing import Optional

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import schemas as S
from .functions.calendar import calendar_columns, date_id_of
from .tables import Tables, buckets_for

# Fixed values of the test binding (FIXTURES.md section 1).
AS_OF = _dt.date(2001, 11, 4)  # the last ship date
PARTS = 8  # part keys of one stock
RATE_LAG = 95  # days from the last order date to AS_OF
INACTIVE = (50, 13)  # stocks whose id leaves 13 modulo 50 are delisted
TRACKED = ("Stock#4", "Stock#5", "Stock#11", "Stock#12", "Stock#17", "Stock#22", "Stock#25")
CURRENCIES = [(1, "USD", "US Dollar", True, True), (2, "GBP", "British Pound", False, True)]
# base of the synthetic created_at / updated_at stamps of the backfill tables
STAMP_BASE = _dt.datetime(2001, 1, 1)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str, buckets: Optional[int] = None) -> DataFrame:
    """One trade per line item: stock, d, price, qty and the ordering key.

    With ``buckets`` the rows are dealt out by stock as the buckets of a table are, and
    the parts come to them.
    """
    def keyed(df: DataFrame, partkey: str) -> DataFrame:
        return df.withColumn("stock_id", stock_id_of(symbol_of(F.col(partkey))))

    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("qty"),
        "l_discount", F.to_date("l_shipdate").alias("d"))
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    on = li["l_partkey"] == part["p_partkey"]
    if buckets:
        li = keyed(li, "l_partkey").where(F.col("l_partkey").isNotNull()).repartition(buckets, "stock_id")
        part = keyed(part, "p_partkey").repartition(buckets, "stock_id").hint("shuffle_hash")
        on = (li["stock_id"] == part["stock_id"]) & (li["l_partkey"] == part["p_partkey"])
    disc = F.col("l_discount").cast("decimal(5,2)")
    price = (F.col("p_retailprice").cast("decimal(10,2)")
             * (F.lit(1).cast("decimal(5,2)") - disc)).cast(S.PRICE)
    symbol = symbol_of(F.col("p_partkey"))
    return (li.join(part, on)
            .select((li["stock_id"] if buckets else stock_id_of(symbol)).alias("stock_id"), symbol.alias("symbol"),
                    "d", price.alias("price"), "qty",
                    # order of trades within a day: (order, line, part, discount)
                    # packed into one 38-digit decimal (room for order keys < 1e13
                    # and part keys < 1e12); a fixed-width key keeps the bar
                    # aggregation hash-based with partial aggregation
                    trade_seq().alias("seq"),
                    "l_orderkey", "l_linenumber", "l_partkey",
                    F.round(F.col("l_discount") * 100).cast("bigint").alias("disc")))


def buckets_of(spark: SparkSession, sf_dir: str) -> int:
    """Buckets that hold the trades of the input, counted in the files' footers."""
    return buckets_for(_read(spark, sf_dir, "lineitem").count())


def symbol_of(partkey) -> "F.Column":
    return F.concat(F.lit("Stock#"), (F.floor(partkey / PARTS) + 1).cast("string"))


def trade_seq() -> "F.Column":
    d38 = "decimal(38,0)"
    disc = F.round(F.col("l_discount") * 100).cast("bigint")
    return (((F.col("l_orderkey").cast(d38) * 10 + F.col("l_linenumber")) * F.lit(10 ** 12).cast(d38)
             + F.col("l_partkey")) * 100 + disc).cast(d38)


def bars(tk: DataFrame, dealt: bool = False) -> DataFrame:
    """Daily bars of trades, combined before the shuffle.

    Trades that lie ``dealt`` out by stock need no shuffle: they are aggregated in the
    order of one sort, which the returns use too, so a task's memory holds trades only
    and no map of bars that spills. The order of a day's trades is ``seq`` as longs.
    """
    first, last = F.min_by("price", "seq"), F.max_by("price", "seq")
    if dealt:
        trade = F.when(F.col("l_orderkey").isNotNull() & F.col("l_linenumber").isNotNull() & F.col("disc").isNotNull(), F.struct(
            F.col("l_orderkey") * 10 + F.col("l_linenumber"), F.col("l_partkey") * 100 + F.col("disc"), F.col("price").alias("price")))
        first, last = F.min(trade)["price"], F.max(trade)["price"]
    return (tk.groupBy("stock_id", "d")
            .agg(first.alias("o"), F.max("price").alias("h"),
                 F.min("price").alias("lo"), last.alias("c"),
                 F.sum("qty").cast("bigint").alias("v")))


def stock_id_of(symbol) -> "F.Column":
    return F.substring(symbol, 7, 100).cast("int")


def calendar_of(spark: SparkSession, sf_dir: str, days: DataFrame) -> DataFrame:
    """``dim_date``: the trading days (column ``d``) and the days that have a rate."""
    dates = days.union(_rate_orders(spark, sf_dir).select("d")).distinct()
    return dates.select(*calendar_columns(F.col("d"), dow="sunday0"),
                        F.lit(None).cast("timestamp").alias("created_at"))


def _rate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_add(F.to_date("o_orderdate"), RATE_LAG).alias("d"))


def build(spark: SparkSession, sf_dir: str, buckets: Optional[int] = None) -> Tables:
    """The whole warehouse as lazy DataFrames derived from ``sf_dir``.

    With ``buckets`` the rows of ``prices`` and ``stock_prices`` come dealt out by stock as
    the buckets of ``prices`` are, so that their writes shuffle nothing again.
    """
    tk = ticks(spark, sf_dir, buckets)
    br = bars(tk, dealt=bool(buckets))
    orders = _rate_orders(spark, sf_dir)
    part = _read(spark, sf_dir, "part").select(symbol_of(F.col("p_partkey")).alias("symbol"))
    dim_date = calendar_of(spark, sf_dir, br.select("d"))

    dim_stocks = (part.distinct().select(
        stock_id_of(F.col("symbol")).alias("stock_id"), "symbol",
        F.concat(F.col("symbol"), F.lit(" Inc.")).alias("company_name"),
        F.lit(None).cast("string").alias("sector"),
        F.lit(None).cast("string").alias("market_cap_category"),
        (stock_id_of(F.col("symbol")) % INACTIVE[0] != INACTIVE[1]).alias("is_active"),
        F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at")))

    dim_currency = spark.createDataFrame(
        [(i, c, n, b, a, None) for i, c, n, b, a in CURRENCIES], S.DIM_CURRENCY)

    rates = (orders.groupBy("d")
             .agg(F.sum(F.col("o_orderkey") % 2000).alias("s"))  # residues: the sum stays far from 2**63
             .select(F.lit(1).alias("from_currency_id"), F.lit(2).alias("to_currency_id"),
                     date_id_of(F.col("d")).alias("date_id"),
                     ((F.lit(7000) + F.col("s") % 2000).cast("decimal(10,0)") / 10000)
                     .cast(S.RATE).alias("exchange_rate"),
                     F.lit(None).cast("timestamp").alias("created_at"),
                     F.lit(None).cast("timestamp").alias("updated_at")))

    w = Window.partitionBy("stock_id").orderBy("d")
    pc = F.lag("c").over(w).cast("double")
    ret = F.round(F.try_divide(F.col("c").cast("double") - pc, pc) * 100, 6).try_cast(S.RETURN_PCT)
    prices = br.select(
        "stock_id", date_id_of(F.col("d")).alias("date_id"),
        F.col("o").alias("opening_price"), F.col("h").alias("high_price"),
        F.col("lo").alias("low_price"), F.col("c").alias("closing_price"),
        F.col("v").alias("volume"), F.col("c").alias("adjusted_close"),
        ret.alias("daily_return"),
        F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"))

    return Tables(dim_stocks=dim_stocks, dim_date=dim_date, dim_currency=dim_currency,
                  prices=prices, rates=rates,
                  stock_prices=backfill_stock_prices(tk),
                  exchange_rates=backfill_exchange_rates(orders))


def _stamp(micros) -> "F.Column":
    base = int((STAMP_BASE - _dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    return F.timestamp_micros(F.lit(base) + micros)


def backfill_stock_prices(tk: DataFrame) -> DataFrame:
    """Every trade as a record of the natural-keyed ``stock_prices`` table.

    Many records share a (symbol, date) key; ``updated_at`` / ``created_at``
    order them totally (order key, line, part, discount, quantity).
    """
    return tk.select(
        "symbol", F.col("d").alias("date"),
        F.col("price").alias("open_price"), F.col("price").alias("high_price"),
        F.col("price").alias("low_price"), F.col("price").alias("close_price"),
        F.col("qty").alias("volume"), F.col("price").alias("adjusted_close"),
        _stamp((F.col("l_partkey") * 100 + F.col("disc")) * 100 + F.col("qty")).alias("created_at"),
        _stamp(F.col("l_orderkey") * 1_000_000 + F.col("l_linenumber")).alias("updated_at"))


def backfill_exchange_rates(orders: DataFrame) -> DataFrame:
    """One USD->GBP quote per order; many per day, ordered by order key."""
    stamp = _stamp(F.col("o_orderkey") * 1_000_000)
    return orders.select(
        F.lit("USD").alias("from_currency"), F.lit("GBP").alias("to_currency"),
        F.col("d").alias("date"),
        ((F.lit(7000) + F.col("o_orderkey") % 2000).cast("decimal(10,0)") / 10000)
        .cast(S.RATE).alias("rate"),
        stamp.alias("created_at"), stamp.alias("updated_at"))


# --------------------------------------------------------------------------
# The same binding as SQL text for the DuckDB oracle. Query texts append
# ``, more AS (...) SELECT ...`` or ``SELECT ...`` to it.
BINDING_SQL = """
WITH ticks AS (
  SELECT concat('Stock#', p.p_partkey // 8 + 1) AS symbol, CAST(l.l_shipdate AS DATE) AS d,
    CAST(CAST(p.p_retailprice AS DECIMAL(10,2))
         * (CAST(1 AS DECIMAL(5,2)) - CAST(l.l_discount AS DECIMAL(5,2))) AS DECIMAL(10,4)) AS price,
    CAST(l.l_quantity AS BIGINT) AS qty,
    ((CAST(l.l_orderkey AS HUGEINT)*10 + l.l_linenumber)*1000000000000 + l.l_partkey)*100
      + CAST(round(l.l_discount*100) AS BIGINT) AS seq,
    l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(round(l.l_discount*100) AS BIGINT) AS disc
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
rate_orders AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) + 95 AS d FROM orders),
bars AS (SELECT symbol, d, min_by(price, seq) AS o, max(price) AS h, min(price) AS lo,
                max_by(price, seq) AS c, CAST(sum(qty) AS BIGINT) AS v
         FROM ticks GROUP BY symbol, d),
dim_date AS (SELECT DISTINCT dd AS date_value,
                    CAST(year(dd)*10000+month(dd)*100+day(dd) AS INT) AS date_id,
                    CAST(year(dd) AS INT) AS year, CAST(quarter(dd) AS INT) AS quarter,
                    CAST(month(dd) AS INT) AS month, CAST(day(dd) AS INT) AS day,
                    CAST(dayofweek(dd) AS INT) AS day_of_week,
                    CAST(dayofyear(dd) AS INT) AS day_of_year,
                    CAST(weekofyear(dd) AS INT) AS week_of_year,
                    dayofweek(dd) IN (0, 6) AS is_weekend, FALSE AS is_holiday
             FROM (SELECT d AS dd FROM bars UNION SELECT d FROM rate_orders) u),
dim_stocks AS (SELECT stock_id, concat('Stock#', stock_id) AS symbol,
                      concat('Stock#', stock_id, ' Inc.') AS company_name, stock_id % 50 <> 13 AS is_active
               FROM (SELECT DISTINCT CAST(p_partkey // 8 + 1 AS INT) AS stock_id FROM part) s),
dim_currency AS (SELECT * FROM (VALUES (1,'USD','US Dollar',TRUE,TRUE),(2,'GBP','British Pound',FALSE,TRUE))
                 t(currency_id, currency_code, currency_name, is_base_currency, is_active)),
fact_currency_rates AS (
  SELECT 1 AS from_currency_id, 2 AS to_currency_id,
         CAST(year(d)*10000+month(d)*100+day(d) AS INT) AS date_id,
         CAST(CAST(7000 + sum(o_orderkey % 2000) % 2000 AS DECIMAL(10,0))/10000 AS DECIMAL(10,6)) AS exchange_rate
  FROM rate_orders GROUP BY d),
ret AS (SELECT symbol, d, o, h, lo, c, v, lag(c) OVER (PARTITION BY symbol ORDER BY d) AS pc FROM bars),
fact_stock_prices AS (
  SELECT CAST(substr(symbol,7) AS INT) AS stock_id, CAST(year(d)*10000+month(d)*100+day(d) AS INT) AS date_id,
         o AS opening_price, h AS high_price, lo AS low_price, c AS closing_price, v AS volume,
         c AS adjusted_close,
         CAST(round((CAST(c AS DOUBLE) - CAST(pc AS DOUBLE)) / CAST(pc AS DOUBLE) * 100, 6)
              AS DECIMAL(8,6)) AS daily_return FROM ret),
stock_prices AS (
  SELECT symbol, d AS date, price AS open_price, price AS high_price, price AS low_price,
         price AS close_price, qty AS volume, price AS adjusted_close,
         make_timestamp(CAST(978307200000000 + (l_partkey*100 + disc)*100 + qty AS BIGINT)) AS created_at,
         make_timestamp(CAST(978307200000000 + l_orderkey*1000000 + l_linenumber AS BIGINT)) AS updated_at
  FROM ticks),
exchange_rates AS (
  SELECT 'USD' AS from_currency, 'GBP' AS to_currency, d AS date,
         CAST(CAST(7000 + o_orderkey % 2000 AS DECIMAL(10,0))/10000 AS DECIMAL(10,6)) AS rate,
         make_timestamp(CAST(978307200000000 + o_orderkey*1000000 AS BIGINT)) AS created_at,
         make_timestamp(CAST(978307200000000 + o_orderkey*1000000 AS BIGINT)) AS updated_at
  FROM rate_orders)
"""


def with_binding(body: str) -> str:
    """Prefix a query body with the binding CTEs."""
    body = body.strip()
    if not body.startswith(","):
        body = "\n" + body
    return BINDING_SQL.rstrip() + body


# --------------------------------------------------------------------------
# Dirty variant: the clean binding has no quality violations, so the checks
# run on a deterministic corruption of the whole fact tables.

def dirt_key():
    return (F.col("stock_id") * 31 + F.col("date_id")) % 97


def dirty(t: Tables) -> Tables:
    """k = (stock_id*31 + date_id) % 97: k=1 high below low, k=2 negative
    close, k=3 return 60 %, k=4 row twice; rates with date_id % 89 = 1 are 0."""
    k = dirt_key()
    p = t.prices.select(
        "stock_id", "date_id", "opening_price",
        F.when(k == 1, F.col("low_price") - 1).otherwise(F.col("high_price")).cast(S.PRICE).alias("high_price"),
        "low_price",
        F.when(k == 2, -F.col("closing_price")).otherwise(F.col("closing_price")).cast(S.PRICE)
        .alias("closing_price"),
        "volume", "adjusted_close",
        F.when(k == 3, F.lit(60)).otherwise(F.col("daily_return")).cast(S.RETURN_PCT).alias("daily_return"),
        "created_at", "updated_at")
    p = p.unionByName(p.where(dirt_key() == 4))
    r = t.rates.withColumn("exchange_rate", F.when(F.col("date_id") % 89 == 1, F.lit(0))
                           .otherwise(F.col("exchange_rate")).cast(S.RATE))
    return t.with_(prices=p, rates=r)


def quotes(t: Tables) -> DataFrame:
    """Daily quotes with bid/ask from the per-order rates of the day:
    bid = lowest, ask = highest, rate = the last quote of the day."""
    return (t.exchange_rates.groupBy("from_currency", "to_currency", "date")
            .agg(F.max_by("rate", "updated_at").alias("rate"),
                 F.min("rate").alias("bid_rate"), F.max("rate").alias("ask_rate"))
            .select("from_currency", "to_currency", "date", "rate", "bid_rate", "ask_rate",
                    F.col("date").cast("timestamp").alias("timestamp"),
                    F.lit("alpha_vantage").alias("source")))


DIRTY_SQL = """,
dirty_prices0 AS (
  SELECT stock_id, date_id, opening_price,
         CAST(CASE WHEN (stock_id*31 + date_id) % 97 = 1 THEN low_price - 1 ELSE high_price END AS DECIMAL(10,4)) AS high_price,
         low_price,
         CAST(CASE WHEN (stock_id*31 + date_id) % 97 = 2 THEN -closing_price ELSE closing_price END AS DECIMAL(10,4)) AS closing_price,
         volume, adjusted_close,
         CAST(CASE WHEN (stock_id*31 + date_id) % 97 = 3 THEN 60 ELSE daily_return END AS DECIMAL(8,6)) AS daily_return
  FROM fact_stock_prices),
dirty_prices AS (SELECT * FROM dirty_prices0 UNION ALL
                 SELECT * FROM dirty_prices0 WHERE (stock_id*31 + date_id) % 97 = 4),
dirty_rates AS (
  SELECT from_currency_id, to_currency_id, date_id,
         CAST(CASE WHEN date_id % 89 = 1 THEN 0 ELSE exchange_rate END AS DECIMAL(10,6)) AS exchange_rate
  FROM fact_currency_rates),
quotes AS (
  SELECT from_currency, to_currency, date, max_by(rate, updated_at) AS rate,
         min(rate) AS bid_rate, max(rate) AS ask_rate, CAST(date AS TIMESTAMP) AS timestamp,
         'alpha_vantage' AS source
  FROM exchange_rates GROUP BY from_currency, to_currency, date)
"""
