"""Record and batch validation as column expressions.

Each check adds ``errors array<string>`` (empty = valid); ``split_valid``
routes rows to valid / rejects in one pass. Nothing is validated one Python
object at a time.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.checks import errors_array, rule
from ..tables import Tables

# Fixed values that must equal the reference's (accepted codes and lists).
SYMBOL_PATTERN = r"^[A-Z0-9.-]+$"
INVALID_SYMBOLS = ("", "NULL", "NONE", "N/A")
BAR_SOURCES = ("alpha_vantage", "yahoo", "polygon", "iex", "manual")
BAR_TYPES = ("daily", "intraday", "weekly", "monthly")
RATE_SOURCES = ("alpha_vantage", "yahoo", "xe", "fixer", "manual")
KNOWN_CURRENCIES = ("USD", "EUR", "GBP", "JPY", "CHF", "CAD", "AUD", "NZD", "CNY", "INR", "BRL",
                    "MXN", "ZAR", "SGD", "HKD", "NOK", "SEK", "DKK", "PLN", "CZK", "HUF", "RUB",
                    "TRY", "KRW")


def _txt(c: Column) -> Column:
    return c.cast("double").cast("string")


def _places(c: Column) -> Column:
    """Number of digits after the decimal point of a decimal value (trailing zeros ignored)."""
    s = F.regexp_replace(F.abs(c).cast("decimal(38,10)").cast("string"), r"0+$", "")
    return F.length(F.substring_index(s, ".", -1)) * F.when(F.instr(s, ".") > 0, 1).otherwise(0)


def _int_digits(c: Column) -> Column:
    return F.length(F.floor(F.abs(c)).cast("decimal(38,0)").cast("string"))


def _too_many_digits(c: Column, places: int, digits: int) -> Column:
    """More than ``digits`` digits in all; only odd values are written out."""
    odd = (c != F.round(c, places)) | (F.abs(c) >= 10 ** (digits - places))
    return F.when(odd, _places(c) + _int_digits(c) > digits).otherwise(F.lit(False))


def split_valid(df: DataFrame, errors_col: str = "errors") -> tuple[DataFrame, DataFrame]:
    ok = F.size(F.col(errors_col)) == 0
    return df.where(ok), df.where(~ok)


def price_rules(name: str, raw: Column, places: int = 2, digits: int = 10) -> list[Column]:
    """Bounds on the double, so any value can be tested; digits on the decimal
    where it has one. Text that is no number counts as missing."""
    x, c = raw.try_cast("double"), raw.try_cast("decimal(20,6)")
    return [
        rule(x.isNull(), f"{name} is required"),
        rule(x <= 0, f"{name} must be greater than 0"),
        rule((x > 0) & (x < 0.01), "Price must be at least $0.01"),
        rule(x > 100000, "Price cannot exceed $100,000"),
        rule(c != F.round(c, places), f"{name} must have at most {places} decimal places"),
        rule(_too_many_digits(c, places, digits), f"{name} must have at most {digits} digits"),
    ]


def validate_bars(df: DataFrame, as_of_ts: _dt.datetime, symbol: str = "symbol",
                  ts: str = "timestamp", open_: str = "open", high: str = "high",
                  low: str = "low", close: str = "close", volume: str = "volume") -> DataFrame:
    """Field, range and OHLC-relationship rules of one bar per row."""
    s = F.col(symbol)
    o, h, lo, c = (F.col(x).try_cast("decimal(20,6)") for x in (open_, high, low, close))
    v = F.col(volume)
    t = F.col(ts).cast("timestamp")
    norm = F.upper(F.trim(s))
    rules = [
        rule(s.isNull() | (F.length(s) < 1) | (F.length(s) > 10),
             "symbol must have 1 to 10 characters"),
        rule(~s.rlike(SYMBOL_PATTERN), "symbol must match ^[A-Z0-9.-]+$"),
        rule(norm.isin(*INVALID_SYMBOLS), "Invalid symbol"),
        rule(t.isNull(), "timestamp is required"),
        rule(F.year(t) < 1980, "Timestamp cannot be before 1980"),
        rule(t > F.lit(as_of_ts).cast("timestamp"), "Timestamp cannot be in the future"),
        *price_rules("open", F.col(open_)), *price_rules("high", F.col(high)),
        *price_rules("low", F.col(low)), *price_rules("close", F.col(close)),
        rule(v.isNull(), "volume is required"),
        rule(v < 0, "volume must be greater than or equal to 0"),
        rule(v > 10_000_000_000, "volume must be less than or equal to 10000000000"),
        rule(h < lo, F.format_string("High price (%s) cannot be less than low price (%s)", _txt(h), _txt(lo))),
        rule(h < o, F.format_string("High price (%s) cannot be less than open price (%s)", _txt(h), _txt(o))),
        rule(h < c, F.format_string("High price (%s) cannot be less than close price (%s)", _txt(h), _txt(c))),
        rule(lo > o, F.format_string("Low price (%s) cannot be greater than open price (%s)", _txt(lo), _txt(o))),
        rule(lo > c, F.format_string("Low price (%s) cannot be greater than close price (%s)", _txt(lo), _txt(c))),
        rule((v == 0) & (o != c), "Cannot have price movement with zero volume"),
    ]
    return df.withColumn("errors", errors_array(*rules))


def validate_batches(df: DataFrame, symbol: str = "symbol", ts: str = "timestamp",
                     source: str = "source", data_type: str = "data_type",
                     batch_symbol: str | None = None) -> DataFrame:
    """Batch rules per (batch, source, data_type): 1..10000 points, no duplicate
    timestamps, every point of the batch's symbol, allowed source and type.

    ``batch_symbol`` names the column with the symbol a batch was asked for; without
    it the points' own symbol is the batch and that rule cannot fail.
    """
    batch = batch_symbol or symbol
    g = df.groupBy(batch, source, data_type).agg(
        F.count(F.lit(1)).alias("point_count"),
        F.count_distinct(ts).alias("distinct_ts"),
        F.count_distinct(symbol).alias("symbols"),
        F.count_if(~F.col(symbol).eqNullSafe(F.col(batch))).alias("foreign_points"))
    rules = [
        rule(F.col("point_count") > 10000, "at most 10000 data points"),
        rule(F.col("distinct_ts") < F.col("point_count"), "Duplicate timestamps found in data points"),
        rule(F.col("foreign_points") > 0, "Data point symbol does not match the batch symbol"),
        rule(~F.col(source).isin(*BAR_SOURCES), "source is not an accepted source"),
        rule(~F.col(data_type).isin(*BAR_TYPES), "data_type is not an accepted type"),
    ]
    return g.withColumn("errors", errors_array(*rules))


def batch_warnings(df: DataFrame, symbol: str = "symbol", ts: str = "timestamp",
                   volume: str = "volume", high: str = "high", low: str = "low",
                   data_type: str | None = None, max_gap_days: int = 10,
                   volume_factor: float = 100.0, range_pct: float = 50.0) -> DataFrame:
    """Warnings the reference computes and then ignores: gaps > 10 days in daily
    data, volume > 100x the batch mean (batches of more than 2 points),
    daily range > 50 % of the mid price."""
    w = Window.partitionBy(symbol).orderBy(ts)
    wb = Window.partitionBy(symbol)
    gap = F.datediff(F.col(ts).cast("date"), F.lag(F.col(ts).cast("date")).over(w))
    mean_v = F.avg(F.col(volume).cast("double")).over(wb)
    n = F.count(F.lit(1)).over(wb)
    h, lo = F.col(high).cast("double"), F.col(low).cast("double")
    daily = F.col(data_type) == "daily" if data_type else F.lit(True)
    return df.withColumn("warnings", errors_array(
        rule(daily & (gap > max_gap_days), F.format_string("gap of %d days", gap)),
        rule((n > 2) & (mean_v > 0) & (F.col(volume) > mean_v * volume_factor), "volume outlier"),
        rule((h - lo) > (h + lo) / 2 * (range_pct / 100), "suspicious daily range"),
    ))


def validate_rates(df: DataFrame, as_of_ts: _dt.datetime, from_: str = "from_currency",
                   to: str = "to_currency", rate: str = "rate", bid: str = "bid_rate",
                   ask: str = "ask_rate", ts: str = "timestamp", source: str | None = "source") -> DataFrame:
    """Currency codes, date range, rate/bid/ask bounds and bid < rate < ask rules."""
    f, t_ = F.col(from_), F.col(to)
    t = F.col(ts).cast("timestamp")

    def bounds(name: str, raw: Column, required: bool) -> list[Column]:
        x, c = raw.try_cast("double"), raw.try_cast("decimal(20,8)")
        out = [rule(x.isNull(), f"{name} is required")] if required else []
        return out + [
            rule(x <= 0, f"{name} must be greater than 0"),
            rule((x > 0) & (x < 0.000001), "Exchange rate too small (minimum 0.000001)"),
            rule(x > 1000000, "Exchange rate too large (maximum 1,000,000)"),
            rule(c != F.round(c, 6), f"{name} must have at most 6 decimal places"),
            rule(_too_many_digits(c, 6, 12), f"{name} must have at most 12 digits"),
        ]

    none = F.lit(None).cast("decimal(20,8)")
    raw_b = F.col(bid) if bid in df.columns else none
    raw_a = F.col(ask) if ask in df.columns else none
    b, a, r = (x.try_cast("decimal(20,8)") for x in (raw_b, raw_a, F.col(rate)))
    rules = [
        rule(f.isNull() | ~f.rlike("^[A-Z]{3}$"), "from_currency must be 3 upper-case letters"),
        rule(t_.isNull() | ~t_.rlike("^[A-Z]{3}$"), "to_currency must be 3 upper-case letters"),
        rule(t.isNull(), "timestamp is required"),
        rule(F.year(t) < 1990, "Currency rate timestamp cannot be before 1990"),
        rule(t > F.lit(as_of_ts).cast("timestamp"), "Currency rate timestamp cannot be in the future"),
        *bounds("rate", F.col(rate), True), *bounds("bid_rate", raw_b, False), *bounds("ask_rate", raw_a, False),
        rule(f == t_, "Cannot convert currency to itself"),
        rule(b.isNotNull() & a.isNotNull() & (b >= a), "Bid rate must be less than ask rate"),
        rule(b.isNotNull() & a.isNotNull() & (b < a) & ((r < b) | (r > a)),
             "Exchange rate must be between bid and ask rates"),
    ]
    if source and source in df.columns:
        rules.append(rule(~F.col(source).isin(*RATE_SOURCES), "source is not an accepted source"))
    return df.withColumn("errors", errors_array(*rules))


def rate_warnings(df: DataFrame, from_: str = "from_currency", to: str = "to_currency",
                  rate: str = "rate", bid: str = "bid_rate", ask: str = "ask_rate",
                  max_spread_pct: float = 10.0) -> DataFrame:
    """Unknown currency codes and wide spreads (warnings only)."""
    spread = F.try_divide(F.col(ask).cast("double") - F.col(bid).cast("double"),
                          F.col(rate).cast("double")) * 100
    return df.withColumn("warnings", errors_array(
        rule(~F.col(from_).isin(*KNOWN_CURRENCIES), F.format_string("Unknown currency code: %s", F.col(from_))),
        rule(~F.col(to).isin(*KNOWN_CURRENCIES), F.format_string("Unknown currency code: %s", F.col(to))),
        rule(spread > max_spread_pct, "wide spread"),
    ))


def check_response(df: DataFrame) -> DataFrame:
    """Response-row rules of the prices-with-currency endpoint."""
    has = set(df.columns)

    def c(n):
        return F.col(n) if n in has else F.lit(None)

    return df.withColumn("errors", errors_array(
        rule(c("price_usd") <= 0, "price_usd must be positive"),
        rule(c("volume") < 0, "volume must be non-negative"),
        rule(c("price_gbp").isNotNull() & (c("price_gbp") <= 0), "price_gbp must be positive if provided"),
        rule(c("usd_to_gbp_rate").isNotNull() & (c("usd_to_gbp_rate") <= 0),
             "usd_to_gbp_rate must be positive if provided"),
    ))


def check_conversion(df: DataFrame, as_of_ts: _dt.datetime, tol: float = 1e-4,
                     max_age_hours: int = 24, rate_ts: str = "rate_date") -> DataFrame:
    """|gbp - usd * rate| within 0.01 % of the product; rate age and staleness."""
    expected = F.col("price_usd").cast("decimal(20,6)") * F.col("usd_to_gbp_rate").cast("decimal(20,6)")
    diff = F.abs(F.col("price_gbp").cast("decimal(20,6)") - expected)
    age_h = F.floor((F.lit(as_of_ts).cast("timestamp").cast("long")
                     - F.col(rate_ts).cast("timestamp").cast("long")) / 3600).cast("int")
    return df.select(
        "*", age_h.alias("rate_age_hours"), (age_h > max_age_hours).alias("is_rate_stale"),
        errors_array(
            rule(F.col("price_usd") <= 0, "price_usd must be greater than 0"),
            rule(F.col("usd_to_gbp_rate") <= 0, "usd_to_gbp_rate must be greater than 0"),
            rule(F.col("price_gbp") <= 0, "price_gbp must be greater than 0"),
            rule(diff > expected * F.lit(tol), "GBP price doesn't match conversion within tolerance"),
            rule(age_h < 0, "rate_age_hours must be greater than or equal to 0"),
        ).alias("errors"))


def check_performance(df: DataFrame, as_of: _dt.date) -> DataFrame:
    """Bounds of an enhanced performance row (optional fields checked when present)."""
    has = set(df.columns)

    def c(n):
        return F.col(n) if n in has else F.lit(None)

    ret = c("daily_return_pct") if "daily_return_pct" in has else c("daily_return")
    return df.withColumn("errors", errors_array(
        rule(~F.regexp_replace(F.upper(F.trim(c("symbol"))), r"[.-]", "").rlike("^[A-Z0-9]+$"),
             "Invalid symbol format"),
        rule(c("price_usd") <= 0, "price_usd must be greater than 0"),
        rule(c("price_gbp") <= 0, "price_gbp must be greater than 0"),
        rule((ret < -100) | (ret > 1000), "daily_return_pct must be between -100 and 1000"),
        rule(c("volume") < 0, "volume must be greater than or equal to 0"),
        rule(c("trade_date") > F.lit(as_of), "Trade date cannot be in the future"),
        rule(c("market_cap_usd") <= 0, "market_cap_usd must be greater than 0"),
        rule(c("pe_ratio") <= 0, "pe_ratio must be greater than 0"),
        rule((c("performance_rank") < 1) | (c("performance_rank") > 10),
             "performance_rank must be between 1 and 10"),
        rule((c("rsi") < 0) | (c("rsi") > 100), "rsi must be between 0 and 100"),
        rule(c("moving_avg_20d") <= 0, "moving_avg_20d must be greater than 0"),
        rule(c("volatility_30d") < 0, "volatility_30d must be greater than or equal to 0"),
    ))


def _fact_audit(fact: DataFrame, keys: Sequence[str], refs, not_null: Column, names) -> DataFrame:
    """Uniqueness, foreign keys and NOT NULL of one fact table in one pass:
    the reference keys are left-joined (dimensions are small), then one
    ``groupBy`` on the table key (partial aggregation before the shuffle)
    counts duplicates, dangling references and null rows together."""
    rows = fact
    flags = []
    for i, (col, dim, dim_col, bounded_dim) in enumerate(refs):
        k = dim.select(F.col(dim_col).alias(col)).distinct().withColumn(f"_r{i}", F.lit(True))
        rows = rows.join(F.broadcast(k) if bounded_dim else k, col, "left")
        flags.append(F.count_if(F.col(f"_r{i}").isNull()).alias(f"_m{i}"))
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if(not_null).alias("_nn"), *flags)
    one = per_key.agg(
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).alias("dup"),
        *[F.coalesce(F.sum(f"_m{i}"), F.lit(0)).alias(f"m{i}") for i in range(len(refs))],
        F.coalesce(F.sum("_nn"), F.lit(0)).alias("nn"))
    table, dup_rule, ref_rules, nn_rule = names
    arr = F.array(F.struct(F.lit(dup_rule).alias("rule"), F.col("dup").alias("v")),
                  *[F.struct(F.lit(r).alias("rule"), F.col(f"m{i}").alias("v")) for i, r in enumerate(ref_rules)],
                  F.struct(F.lit(nn_rule).alias("rule"), F.col("nn").alias("v")))
    return one.select(F.inline(arr)).select(F.lit(table).alias("table_name"), "rule",
                                            F.col("v").cast("bigint").alias("violations"))


def constraint_audit(t: Tables) -> DataFrame:
    """Violations of the DDL's keys and constraints, one row per rule.

    Each fact is audited in one pass (keys, references and NOT NULL
    together); the small dimensions by ``groupBy`` and conditional counts.
    """
    def dup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return (df.groupBy(*keys).count().where(F.col("count") > 1)
                .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("v")))

    def cnt(df: DataFrame, cond: Column) -> DataFrame:
        return df.agg(F.count_if(cond).alias("v"))

    p, r = t.prices, t.rates
    items = [
        ("dim_stocks", "unique symbol", dup(t.dim_stocks, ["symbol"])),
        ("dim_stocks", "unique stock_id", dup(t.dim_stocks, ["stock_id"])),
        ("dim_stocks", "symbol not null, length <= 10",
         cnt(t.dim_stocks, F.col("symbol").isNull() | (F.length("symbol") > 10))),
        ("dim_date", "unique date_value", dup(t.dim_date, ["date_value"])),
        ("dim_date", "calendar parts not null", cnt(t.dim_date, F.col("year").isNull()
                                                    | F.col("month").isNull() | F.col("day").isNull()
                                                    | F.col("is_weekend").isNull())),
        ("dim_currency", "unique currency_code", dup(t.dim_currency, ["currency_code"])),
        ("dim_currency", "currency_code length = 3",
         cnt(t.dim_currency, F.col("currency_code").isNull() | (F.length("currency_code") != 3))),
    ]
    out = None
    for table, name, df in items:
        row = df.select(F.lit(table).alias("table_name"), F.lit(name).alias("rule"),
                        F.col("v").cast("bigint").alias("violations"))
        out = row if out is None else out.unionByName(row)
    prices = _fact_audit(
        p, ["stock_id", "date_id"],
        [("stock_id", t.dim_stocks, "stock_id", False), ("date_id", t.dim_date, "date_id", True)],
        F.col("opening_price").isNull() | F.col("high_price").isNull() | F.col("low_price").isNull()
        | F.col("closing_price").isNull() | F.col("volume").isNull(),
        ("fact_stock_prices", "unique (stock_id, date_id)",
         ["stock_id references dim_stocks", "date_id references dim_date"], "prices and volume not null"))
    rates = _fact_audit(
        r, ["from_currency_id", "to_currency_id", "date_id"],
        [("from_currency_id", t.dim_currency, "currency_id", True),
         ("to_currency_id", t.dim_currency, "currency_id", True), ("date_id", t.dim_date, "date_id", True)],
        F.col("exchange_rate").isNull(),
        ("fact_currency_rates", "unique (from, to, date_id)",
         ["from_currency_id references dim_currency", "to_currency_id references dim_currency",
          "date_id references dim_date"], "exchange_rate not null"))
    return out.unionByName(prices).unionByName(rates)
