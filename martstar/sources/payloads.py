"""Vendor payloads (stored JSON response bodies) -> rows.

Input is a DataFrame with one stored response per row: a ``body`` text column
plus identifying columns (symbol, interval, currency pair ...). One row per
payload replaces the reference's per-symbol request loop; every function is
a projection + ``explode`` of a parsed map, so payloads are parsed in
parallel and never pass through the driver.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.checks import errors_array, rule
from ..functions.numeric import lenient_double

# Fixed values that must equal the reference's (vendor keys and keywords).
DAILY_KEY = "Time Series (Daily)"
FX_DAILY_KEY = "Time Series FX (Daily)"
CRYPTO_KEY = "Time Series (Digital Currency Daily)"
QUOTE_KEY = "Realtime Currency Exchange Rate"
OPEN, HIGH, LOW, CLOSE, VOLUME = "1. open", "2. high", "3. low", "4. close", "5. volume"
INTERVALS = ("1min", "5min", "15min", "30min", "60min")
ERROR_KEYS = ("Error Message", "error", "message")
NOTICE_KEYS = ("Note", "note", "Information")
NOTICE_WORDS = ("rate limit", "frequency", "calls per", "thank you for using")
DAILY_LIMIT_WORDS = ("25 requests per day", "daily rate limit", "requests per day")
ERROR_LIMIT_WORDS = ("rate limit", "requests per minute")
AUTH_WORDS = ("invalid api", "authentication")
STANDARD_NAMES = {"1. open": "Open", "2. high": "High", "3. low": "Low", "4. close": "Close",
                  "5. volume": "Volume", "datetime": "DateTime", "date": "Date"}


def top_level(body: Column) -> Column:
    """Body text -> ``map<string,string>``; nested objects stay JSON text."""
    return F.from_json(body, "map<string,string>")


def series(body: Column, key) -> Column:
    """The ``{timestamp -> {field -> text}}`` map stored under ``key``."""
    k = key if isinstance(key, Column) else F.lit(key)
    return F.from_json(F.try_element_at(top_level(body), k), S.SERIES_MAP)


def _explode_series(payloads: DataFrame, m: Column, keep: list[str]) -> DataFrame:
    return payloads.select(*keep, F.explode(m).alias("_ts", "_v"))


def _num(field: str) -> Column:
    return F.try_element_at(F.col("_v"), F.lit(field)).try_cast("double")


def flatten_daily(payloads: DataFrame, symbol_col: str = "symbol", body_col: str = "body") -> DataFrame:
    """Daily series -> Date, Open, High, Low, Close, Volume, Symbol.

    Payloads without the series key yield no rows (``check_structure`` reports them).
    """
    rows = _explode_series(payloads, series(F.col(body_col), DAILY_KEY), [symbol_col])
    vol = F.try_element_at(F.col("_v"), F.lit(VOLUME))
    return rows.select(
        F.to_date("_ts").alias("Date"), _num(OPEN).alias("Open"), _num(HIGH).alias("High"),
        _num(LOW).alias("Low"), _num(CLOSE).alias("Close"),
        F.coalesce(vol.try_cast("bigint"), vol.try_cast("double").cast("bigint")).alias("Volume"),
        F.col(symbol_col).alias("Symbol"))


def flatten_intraday(payloads: DataFrame, symbol_col: str = "symbol",
                     interval_col: str = "interval", body_col: str = "body") -> DataFrame:
    """Intraday series under ``Time Series (<interval>)`` -> DateTime, OHLCV, Symbol, Interval."""
    key = F.concat(F.lit("Time Series ("), F.col(interval_col), F.lit(")"))
    rows = _explode_series(payloads.where(F.col(interval_col).isin(*INTERVALS)),
                           series(F.col(body_col), key), [symbol_col, interval_col])
    vol = F.try_element_at(F.col("_v"), F.lit(VOLUME))
    return rows.select(
        F.to_timestamp("_ts").alias("DateTime"), _num(OPEN).alias("Open"), _num(HIGH).alias("High"),
        _num(LOW).alias("Low"), _num(CLOSE).alias("Close"),
        F.coalesce(vol.try_cast("bigint"), vol.try_cast("double").cast("bigint")).alias("Volume"),
        F.col(symbol_col).alias("Symbol"), F.col(interval_col).alias("Interval"))


def flatten_fx(payloads: DataFrame, from_col: str = "from_currency", to_col: str = "to_currency",
               body_col: str = "body") -> DataFrame:
    """Daily FX series -> DateTime, Open, High, Low, Close, FromCurrency, ToCurrency."""
    rows = _explode_series(payloads, series(F.col(body_col), FX_DAILY_KEY), [from_col, to_col])
    return rows.select(
        F.to_timestamp("_ts").alias("DateTime"), _num(OPEN).alias("Open"), _num(HIGH).alias("High"),
        _num(LOW).alias("Low"), _num(CLOSE).alias("Close"),
        F.col(from_col).alias("FromCurrency"), F.col(to_col).alias("ToCurrency"))


def flatten_crypto(payloads: DataFrame, code_col: str = "currency_code",
                   market_col: str = "market_code", body_col: str = "body") -> DataFrame:
    """Digital-currency series; field names carry the market code; missing -> 0."""
    rows = _explode_series(payloads, series(F.col(body_col), CRYPTO_KEY), [code_col, market_col])

    def fld(prefix: str) -> Column:
        k = F.concat(F.lit(prefix + " ("), F.col(market_col), F.lit(")"))
        return lenient_double(F.coalesce(F.try_element_at(F.col("_v"), k), F.lit("0")))

    return rows.select(
        F.to_timestamp("_ts").alias("DateTime"), fld("1a. open").alias("Open"),
        fld("2a. high").alias("High"), fld("3a. low").alias("Low"), fld("4a. close").alias("Close"),
        lenient_double(F.coalesce(F.try_element_at(F.col("_v"), F.lit(VOLUME)), F.lit("0"))).alias("Volume"),
        fld("6. market cap").alias("MarketCap"),
        F.col(code_col).alias("CurrencyCode"), F.col(market_col).alias("MarketCode"))


def parse_quote(payloads: DataFrame, body_col: str = "body",
                pair: tuple[str, str] = ("USD", "GBP")) -> DataFrame:
    """Realtime quote -> from/to codes, rate, last_refreshed, timezone, bid, ask."""
    q = F.from_json(F.try_element_at(top_level(F.col(body_col)), F.lit(QUOTE_KEY)), "map<string,string>")

    def g(k: str) -> Column:
        return F.try_element_at(q, F.lit(k))

    return payloads.where(q.isNotNull() & (F.size(q) > 0)).select(
        F.coalesce(g("1. From_Currency Code"), F.lit(pair[0])).alias("from_currency"),
        F.coalesce(g("3. To_Currency Code"), F.lit(pair[1])).alias("to_currency"),
        lenient_double(F.coalesce(g("5. Exchange Rate"), F.lit("0"))).alias("exchange_rate"),
        F.coalesce(g("6. Last Refreshed"), F.lit("")).alias("last_refreshed"),
        F.coalesce(g("7. Time Zone"), F.lit("UTC")).alias("timezone"),
        lenient_double(F.coalesce(g("8. Bid Price"), F.lit("0"))).alias("bid_price"),
        lenient_double(F.coalesce(g("9. Ask Price"), F.lit("0"))).alias("ask_price"))


def parse_overview(payloads: DataFrame, body_col: str = "body") -> DataFrame:
    """Company overview: the flat string map, plus typed key fields."""
    m = top_level(F.col(body_col))

    def g(k: str) -> Column:
        return F.try_element_at(m, F.lit(k))

    return payloads.select(
        m.alias("overview"), g("Symbol").alias("symbol"), g("Name").alias("company_name"),
        g("Sector").alias("sector"), g("Industry").alias("industry"),
        g("MarketCapitalization").try_cast("bigint").alias("market_cap"),
        g("PERatio").try_cast("double").alias("pe_ratio"),
        g("SharesOutstanding").try_cast("bigint").alias("shares_outstanding"))


def _first_key(m: Column, keys) -> Column:
    return F.coalesce(*[F.try_element_at(m, F.lit(k)) for k in keys])


def _has_any(text: Column, words) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for w in words:
        out = out | low.contains(w)
    return out


def triage(payloads: DataFrame, body_col: str = "body") -> DataFrame:
    """Classify stored responses: ok / error / rate_limited / daily_limit / auth / empty / invalid."""
    m = top_level(F.col(body_col))
    err = _first_key(m, ERROR_KEYS)
    notice_raw = [F.try_element_at(m, F.lit(k)) for k in NOTICE_KEYS]
    notice = F.coalesce(*[F.when(_has_any(n, NOTICE_WORDS), n) for n in notice_raw])
    status = (F.when(m.isNull(), "invalid")
              .when(err.isNotNull() & _has_any(err, ERROR_LIMIT_WORDS) & _has_any(err, DAILY_LIMIT_WORDS),
                    "daily_limit")
              .when(err.isNotNull() & _has_any(err, ERROR_LIMIT_WORDS), "rate_limited")
              .when(err.isNotNull() & _has_any(err, AUTH_WORDS), "auth")
              .when(err.isNotNull(), "error")
              .when(notice.isNotNull() & _has_any(notice, DAILY_LIMIT_WORDS), "daily_limit")
              .when(notice.isNotNull(), "rate_limited")
              .when(F.size(m) == 0, "empty")
              .otherwise("ok"))
    return payloads.withColumn("status", status).withColumn("message", F.coalesce(err, notice))


def check_structure(payloads: DataFrame, key, body_col: str = "body") -> DataFrame:
    """Series-structure errors: missing, not a map, empty, entries not non-empty maps."""
    k = key if isinstance(key, Column) else F.lit(key)
    raw = F.try_element_at(top_level(F.col(body_col)), k)
    as_map = F.from_json(raw, "map<string,string>")
    entries = F.map_values(as_map)
    bad_entry = F.exists(entries, lambda v: F.coalesce(F.size(F.from_json(v, "map<string,string>")),
                                                       F.lit(-1)) <= 0)
    return payloads.withColumn("errors", errors_array(
        rule(raw.isNull(), F.format_string("Expected key '%s' not found in response", k)),
        rule(raw.isNotNull() & as_map.isNull(), "Time series data must be a dictionary"),
        rule(as_map.isNotNull() & (F.size(as_map) == 0), "Time series data is empty"),
        rule(as_map.isNotNull() & bad_entry, "Values for every date must be a non-empty dictionary"),
    ))


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename vendor columns by their lower-case name (e.g. ``1. open`` -> ``Open``)."""
    return df.toDF(*[STANDARD_NAMES.get(c.lower(), c) for c in df.columns])


def series_payloads(rows: DataFrame, key_cols: list[str], ts: Column, fields: dict,
                    series_key, meta: dict | None = None) -> DataFrame:
    """Build vendor-shaped payload texts from rows, one per group of ``key_cols``.

    ``fields`` maps vendor field names to columns. Choose a group that is the
    payload's natural unit (e.g. one symbol-month) so its size stays bounded. Groups hold
    plain values; names and texts come when a payload is written.
    """
    entry = F.struct(ts.alias("k"), *[v.alias(f"_{i}") for i, v in enumerate(fields.values())])
    names = F.array(*[F.lit(k) for k in fields])
    key = series_key if isinstance(series_key, Column) else F.lit(series_key)
    meta = meta or {"1. Information": "Daily Prices"}
    meta_json = F.to_json(F.create_map(*[x for kv in meta.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]))
    g = rows.groupBy(*key_cols).agg(F.collect_list(entry).alias("_entries"), F.first(key).alias("_key"))
    g = g.withColumn("_series", F.map_from_entries(F.transform("_entries", lambda e: F.struct(e["k"], F.map_from_arrays(
        names, F.array(*[e[f"_{i}"].cast("string") for i in range(len(fields))]))))))
    body = F.concat(F.lit('{"Meta Data":'), meta_json, F.lit(',"'), F.col("_key"), F.lit('":'),
                    F.to_json("_series"), F.lit("}"))
    return g.select(*key_cols, body.alias("body"))


def bounded_chunks(rows: DataFrame, size: int = 100) -> DataFrame:
    """Tag rows with ``_chunk`` so that a payload group never exceeds ``size``
    rows: consecutive rows of one partition share a chunk (no shuffle, no
    window), whatever the total volume or its skew."""
    return rows.withColumn("_chunk", F.floor(F.monotonically_increasing_id() / size))


def quote_payloads(quotes: DataFrame, refreshed: Column) -> DataFrame:
    """Realtime-quote payload text per quote row (for round trips and tests)."""
    q = F.create_map(
        F.lit("1. From_Currency Code"), F.col("from_currency"),
        F.lit("3. To_Currency Code"), F.col("to_currency"),
        F.lit("5. Exchange Rate"), F.col("rate").cast("string"),
        F.lit("6. Last Refreshed"), refreshed,
        F.lit("7. Time Zone"), F.lit("UTC"),
        F.lit("8. Bid Price"), F.col("bid_rate").cast("string"),
        F.lit("9. Ask Price"), F.col("ask_rate").cast("string"))
    return quotes.select("*", F.concat(F.lit('{"' + QUOTE_KEY + '":'), F.to_json(q), F.lit("}")).alias("body"))