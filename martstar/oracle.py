"""DuckDB oracle SQL for the registered queries.

Each text is the binding CTEs (``binding.BINDING_SQL``) plus the query, written
from its description: ranks by counting, checks as one aggregate, days from the
date keys. NULLs rank first where PostgreSQL's descending order puts them,
result types are explicit, ties are broken before a limit, and decimals are
presented as DOUBLE.
"""

from __future__ import annotations

from .binding import with_binding
from .functions.numeric import rounded_mean_sql as RM

TRACKED_SQL = "('Stock#4','Stock#5','Stock#11','Stock#12','Stock#17','Stock#22','Stock#25')"
AS_OF_SQL = "DATE '2001-11-04'"

CUR = "(SELECT currency_id FROM dim_currency WHERE currency_code = '{}')"
USD, GBP = CUR.format("USD"), CUR.format("GBP")
STAR_T1 = f"""
FROM fact_stock_prices f JOIN dim_stocks ds USING (stock_id) JOIN dim_date dd USING (date_id)
JOIN fact_currency_rates r USING (date_id)
WHERE r.from_currency_id = {USD} AND r.to_currency_id = {GBP} AND ds.is_active
"""

# quoted: every bar of an active stock with its calendar day and, where there is
# one, the day's USD -> GBP rate; priced: those that have a rate; last_day: the
# newest day of any bar, as the key itself.
MARKET = """
, pound AS (
  SELECT r.date_id, r.exchange_rate AS gbp_per_usd
  FROM fact_currency_rates r
  JOIN dim_currency base ON base.currency_id = r.from_currency_id AND base.currency_code = 'USD'
  JOIN dim_currency quote ON quote.currency_id = r.to_currency_id AND quote.currency_code = 'GBP'),
quoted AS (
  SELECT bar.*, stock.symbol, stock.company_name, gbp_per_usd, closing_price * gbp_per_usd AS exact_gbp,
         make_date(date_id // 10000, date_id // 100 % 100, date_id % 100) AS day
  FROM fact_stock_prices bar
  JOIN dim_stocks stock ON stock.stock_id = bar.stock_id AND stock.is_active
  LEFT JOIN pound USING (date_id)),
priced AS (SELECT * FROM quoted WHERE gbp_per_usd IS NOT NULL),
last_day AS (SELECT MAX(date_id) AS date_id FROM fact_stock_prices)"""


def D(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


NAMED = "symbol, company_name"
USD_PRICE, GBP_PRICE = f"{D('closing_price')} AS price_usd", f"{D('ROUND(exact_gbp, 4)')} AS price_gbp"
RETURN = f"{D('daily_return')} AS daily_return"


def market(select: str) -> str:
    return with_binding(MARKET + select)


SQL: dict[str, str] = {}


# a rank is one more than the number of better rows
def _top(k: int, only: str = "TRUE") -> str:
    return f"""
, field AS (SELECT * FROM priced SEMI JOIN last_day USING (date_id) WHERE daily_return IS NOT NULL AND {only}),
top AS (
  SELECT {NAMED}, day AS trade_date, {USD_PRICE}, {RETURN}, volume, {GBP_PRICE},
         CAST(1 + (SELECT COUNT(*) FROM field better WHERE better.daily_return > field.daily_return) AS INT)
           AS performance_rank
  FROM field QUALIFY ROW_NUMBER() OVER (ORDER BY field.daily_return DESC, symbol) <= {k})"""


SQL["top_performers"] = market(_top(5) + " SELECT * FROM top")
SQL["tracked_top_performers"] = market(_top(3, f"symbol IN {TRACKED_SQL}") + " SELECT * FROM top")

# counted back from each tracked stock's newest bar: 1 is the newest, 31 the
# price 30 bars before; rows without a return rank before all others
_B30 = "CASE WHEN back <= 30 THEN {} END"
_DETAILS = f"""
, history AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY stock_id ORDER BY date_id DESC) AS back
              FROM priced WHERE symbol IN {TRACKED_SQL}),
month AS (
  SELECT stock_id, {RM(_B30.format('closing_price'), 4, 4)} AS mean_price,
         CAST({RM(_B30.format('volume'), 0, 0)} AS BIGINT) AS mean_volume,
         ROUND(STDDEV_SAMP({_B30.format(D('daily_return'))}), 6) AS spread,
         {D('MAX(CASE WHEN back = 31 THEN closing_price END)')} AS old_price
  FROM history GROUP BY stock_id),
details AS (
  SELECT {NAMED}, day AS trade_date, {USD_PRICE}, {GBP_PRICE}, {RETURN}, volume,
         CAST(1 + (SELECT COUNT(*) FROM history h WHERE h.daily_return > now.daily_return
                   OR (h.daily_return IS NULL AND now.daily_return IS NOT NULL)) AS INT) AS performance_rank,
         mean_price AS avg_price_30d_usd, mean_volume AS avg_volume_30d, spread AS volatility_30d,
         CASE WHEN old_price > 0 THEN ROUND(({D('closing_price')} - old_price) / old_price * 100, 4) END
           AS price_change_30d_pct
  FROM history now JOIN month USING (stock_id) SEMI JOIN last_day USING (date_id))"""
SQL["performance_details"] = market(_DETAILS + " SELECT * FROM details")


def _between(low: int, high: int, when: str) -> str:
    return market(f"""
SELECT {NAMED}, day AS trade_date, {USD_PRICE}, {RETURN}, volume, {D('opening_price')} AS opening_price,
       {D('high_price')} AS high_price, {D('low_price')} AS low_price, {GBP_PRICE}
FROM priced WHERE closing_price >= {low} AND closing_price <= {high} AND {when}""")


SQL["price_range"] = _between(850, 950, "date_id = (FROM last_day)")
SQL["price_range_on"] = _between(800, 1000, "date_id = 20011002")

SQL["currency_conversion"] = market(f"""
SELECT {NAMED}, day AS rate_date, {USD_PRICE}, {D('gbp_per_usd')} AS usd_to_gbp_rate, {GBP_PRICE}
FROM priced WHERE date_id >= ALL (SELECT date_id FROM pound)""")

_CURRENCY = f"""
, shown AS (SELECT {NAMED}, day AS trade_date, {USD_PRICE}, {GBP_PRICE}, {D('gbp_per_usd')} AS usd_to_gbp_rate, volume,
                   {RETURN}, CAST(NULL AS DOUBLE) AS market_cap_usd, CAST(NULL AS DOUBLE) AS market_cap_gbp
            FROM quoted)"""
SQL["prices_with_currency"] = market(_CURRENCY + " SELECT * FROM shown")

SQL["prices_with_currency_on"] = market(_CURRENCY + " SELECT * FROM shown WHERE trade_date = DATE '2001-10-02'")

SQL["daily_summary"] = market(f"""
SELECT day AS summary_date, ANY_VALUE({D('gbp_per_usd')}) AS usd_to_gbp_rate, COUNT(*) AS stocks_count,
       CAST(SUM(volume) AS BIGINT) AS total_volume, {RM('closing_price', 4, 4)} AS avg_closing_price_usd,
       {D('MIN(closing_price)')} AS min_closing_price_usd, {D('MAX(closing_price)')} AS max_closing_price_usd,
       {RM('daily_return', 6, 6)} AS avg_daily_return_pct, {D('MIN(daily_return)')} AS min_daily_return_pct,
       {D('MAX(daily_return)')} AS max_daily_return_pct, {RM('volume', 0, 0)} AS avg_volume,
       {RM('exact_gbp', 10, 4)} AS avg_closing_price_gbp
FROM priced WHERE day BETWEEN {AS_OF_SQL} - 30 AND DATE '9999-12-31'
GROUP BY day QUALIFY ROW_NUMBER() OVER (ORDER BY day DESC) <= 30""")

SQL["v_latest_prices"] = market(f"""
SELECT {NAMED}, day AS date_value, {USD_PRICE}, volume, {RETURN}, {D('opening_price')} AS opening_price,
       {D('high_price')} AS high_price, {D('low_price')} AS low_price, {GBP_PRICE} FROM quoted""")

SQL["v_daily_performance"] = market(f"""
SELECT day AS date_value, COUNT(*) AS stocks_traded, {RM('daily_return', 6, 6)} AS avg_daily_return,
       {D('MAX(daily_return)')} AS max_daily_return, {D('MIN(daily_return)')} AS min_daily_return,
       CAST(SUM(volume) AS BIGINT) AS total_volume, {RM('closing_price', 4, 6)} AS avg_closing_price
FROM quoted GROUP BY day""")

SQL["v_stock_rankings"] = market(f"""
SELECT {NAMED}, day AS date_value, {D('closing_price')} AS closing_price, {RETURN}, volume,
       CAST(RANK() OVER by_return AS INT) AS return_rank, CAST(RANK() OVER by_volume AS INT) AS volume_rank
FROM quoted
WINDOW by_return AS (PARTITION BY date_id ORDER BY COALESCE(quoted.daily_return, 1e9) DESC),
       by_volume AS (PARTITION BY date_id ORDER BY COALESCE(volume, 9e18) DESC)""")

SQL["latest_per_stock"] = with_binding(f"""
, newest AS (SELECT stock_id, MAX(date_id) AS date_id FROM fact_stock_prices GROUP BY stock_id)
SELECT stock_id, {NAMED}, {D('closing_price')} AS current_price, volume AS current_volume, date_value AS price_date
FROM newest JOIN fact_stock_prices USING (stock_id, date_id) JOIN dim_stocks USING (stock_id)
JOIN dim_date USING (date_id)""")

SQL["v_stock_performance"] = with_binding(f"""
, base AS (
  SELECT ds.symbol, ds.company_name, dd.date_value, f.closing_price, f.volume,
         LAG(f.closing_price) OVER (PARTITION BY ds.symbol ORDER BY dd.date_value) AS prev_close,
         {RM('f.closing_price', 4, 6, ' OVER w7')} AS ma_7_day,
         {RM('f.closing_price', 4, 6, ' OVER w30')} AS ma_30_day
  FROM fact_stock_prices f JOIN dim_stocks ds ON f.stock_id = ds.stock_id
  JOIN dim_date dd ON f.date_id = dd.date_id
  WHERE ds.is_active AND isodow(dd.date_value) <= 5
  WINDOW w7 AS (PARTITION BY ds.symbol ORDER BY dd.date_value ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w30 AS (PARTITION BY ds.symbol ORDER BY dd.date_value ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
perf AS (SELECT *, closing_price - prev_close AS price_change_usd,
               ROUND((CAST(closing_price AS DOUBLE) - CAST(prev_close AS DOUBLE))
                     / CAST(prev_close AS DOUBLE) * 100, 4) AS daily_return_pct FROM base)
SELECT symbol, company_name, date_value, CAST(closing_price AS DOUBLE) AS closing_price, volume,
       CAST(prev_close AS DOUBLE) AS prev_close, ma_7_day, ma_30_day,
       CAST(price_change_usd AS DOUBLE) AS price_change_usd, daily_return_pct,
       CAST(RANK() OVER (PARTITION BY date_value ORDER BY daily_return_pct DESC NULLS FIRST) AS INT) AS daily_rank
FROM perf
""")

SQL["gbp_prices"] = market(f"""
SELECT {NAMED}, day AS trade_date, {USD_PRICE}, {D('gbp_per_usd')} AS usd_to_gbp_rate, {GBP_PRICE} FROM priced""")

SQL["summary_on"] = market(f"""
SELECT day AS summary_date, COUNT(*) AS stocks_count, CAST(SUM(volume) AS BIGINT) AS total_volume,
       {RM('closing_price', 4, 4)} AS avg_closing_price_usd, {RM('daily_return', 6, 6)} AS avg_daily_return_pct,
       {D('MAX(daily_return)')} AS max_daily_return_pct, {D('MIN(daily_return)')} AS min_daily_return_pct
FROM quoted SEMI JOIN last_day USING (date_id) GROUP BY day""")

SQL["top_returns_all_time"] = market(f"""
SELECT {NAMED}, day AS trade_date, {USD_PRICE}, {RETURN} FROM quoted WHERE daily_return IS NOT NULL
QUALIFY ROW_NUMBER() OVER (ORDER BY quoted.daily_return DESC, date_id DESC, symbol) <= 5""")


# -- returns, metrics, quality, validation -------------------------------
from .binding import DIRTY_SQL  # noqa: E402

RESET = """, p0 AS (SELECT stock_id, date_id, closing_price, volume,
   CASE WHEN date_id >= 20011001 THEN NULL ELSE daily_return END AS daily_return FROM fact_stock_prices)"""

SQL["daily_returns"] = with_binding(RESET + """,
calc AS (SELECT p0.*, LAG(closing_price) OVER (PARTITION BY stock_id ORDER BY dd.date_value) AS prev
         FROM p0 JOIN dim_date dd ON p0.date_id = dd.date_id)
SELECT stock_id, date_id,
       CAST(COALESCE(daily_return, CAST(ROUND((closing_price - prev) / prev * 100, 6) AS DECIMAL(8,6)))
            AS DOUBLE) AS daily_return
FROM calc
""")

SQL["daily_returns_null_only"] = with_binding(RESET.replace("p0 AS (", "p0 AS MATERIALIZED (") + """,
calc AS MATERIALIZED (SELECT p0.stock_id, p0.date_id, p0.closing_price,
                LAG(closing_price) OVER (PARTITION BY stock_id ORDER BY dd.date_value) AS prev
         FROM p0 JOIN dim_date dd ON p0.date_id = dd.date_id WHERE p0.daily_return IS NULL)
SELECT p0.stock_id, p0.date_id,
       CAST(COALESCE(p0.daily_return, CAST(ROUND((c.closing_price - c.prev) / c.prev * 100, 6) AS DECIMAL(8,6)))
            AS DOUBLE) AS daily_return
FROM p0 LEFT JOIN calc c ON p0.stock_id = c.stock_id AND p0.date_id = c.date_id
""")

SQL["moving_metrics"] = with_binding(f"""
, m AS (SELECT f.stock_id, f.date_id,
        {RM('f.closing_price', 4, 6, ' OVER w20')} AS moving_avg_20d,
        {RM('f.volume', 0, 6, ' OVER w10')} AS avg_volume_10d
  FROM fact_stock_prices f JOIN dim_date dd ON f.date_id = dd.date_id
  WINDOW w20 AS (PARTITION BY f.stock_id ORDER BY dd.date_value ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
         w10 AS (PARTITION BY f.stock_id ORDER BY dd.date_value ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT stock_id, date_id, moving_avg_20d, avg_volume_10d,
       CAST(to_json({{'moving_avg_20d': moving_avg_20d, 'avg_volume_10d': avg_volume_10d}}) AS VARCHAR)
         AS additional_metrics
FROM m
""")

BAR_D = """CAST(opening_price AS DOUBLE) AS o, CAST(high_price AS DOUBLE) AS h,
           CAST(low_price AS DOUBLE) AS lo, CAST(closing_price AS DOUBLE) AS c"""

SQL["bar_metrics"] = with_binding(f"""
, b AS (SELECT stock_id, date_id, {BAR_D} FROM fact_stock_prices)
SELECT stock_id, date_id,
       ROUND(CASE WHEN o <> 0 THEN (c - o) / o * 100 END, 6) AS intraday_return_pct,
       ROUND(CASE WHEN (h + lo) / 2 = 0 THEN 0.0 ELSE (h - lo) / ((h + lo) / 2) * 100 END, 6) AS volatility_pct,
       (o - lo) / lo * 100 > 2.0 AS is_gap_up, (h - o) / o * 100 > 2.0 AS is_gap_down
FROM b
""")

SQL["points_frame"] = with_binding(f"""
, b AS (SELECT dd.date_value, ds.symbol, {BAR_D}, f.volume
        FROM fact_stock_prices f JOIN dim_stocks ds ON f.stock_id = ds.stock_id
        JOIN dim_date dd ON f.date_id = dd.date_id WHERE ds.is_active)
SELECT date_value AS "Date", symbol AS "Symbol", o AS "Open", h AS "High", lo AS "Low", c AS "Close",
       CAST(volume AS BIGINT) AS "Volume",
       ROUND(COALESCE(CASE WHEN o <> 0 THEN (c - o) / o * 100 END, 0.0), 6) AS "Daily_Return_Pct",
       ROUND(CASE WHEN (h + lo) / 2 = 0 THEN 0.0 ELSE (h - lo) / ((h + lo) / 2) * 100 END, 6) AS "Volatility_Pct",
       'alpha_vantage' AS "Source", 'daily' AS "Data_Type"
FROM b
""")

SQL["symbol_summary"] = with_binding(f"""
SELECT ds.symbol, COUNT(*) AS point_count, MIN(dd.date_value) AS start_date, MAX(dd.date_value) AS end_date,
       CAST(MIN(f.closing_price) AS DOUBLE) AS min_close, CAST(MAX(f.closing_price) AS DOUBLE) AS max_close,
       {RM('f.closing_price', 4, 6)} AS avg_close,
       CAST(max_by(f.closing_price, dd.date_value) AS DOUBLE) AS latest_close,
       MIN(f.volume) AS min_volume, MAX(f.volume) AS max_volume,
       {RM('f.volume', 0, 6)} AS avg_volume, CAST(SUM(f.volume) AS BIGINT) AS total_volume
FROM fact_stock_prices f JOIN dim_stocks ds ON f.stock_id = ds.stock_id
JOIN dim_date dd ON f.date_id = dd.date_id WHERE ds.is_active
GROUP BY ds.symbol
""")


def INV(x: str) -> str:
    r = f"CAST({x} * 1000000 AS HUGEINT)"
    q = f"(1000000000000 // {r})"
    rem2 = f"(2 * (1000000000000 - {q} * {r}))"
    return (f"CAST(CASE WHEN {rem2} > {r} OR ({rem2} = {r} AND {q} % 2 = 1) THEN {q} + 1 ELSE {q} END"
            f" AS DOUBLE) / 1000000.0")


SQL["inverse_rates"] = with_binding(DIRTY_SQL + f"""
SELECT date, source, to_currency AS from_currency, from_currency AS to_currency,
       {INV('rate')} AS rate, {INV('ask_rate')} AS bid_rate, {INV('bid_rate')} AS ask_rate
FROM quotes
""")

SQL["convert_amounts"] = with_binding(DIRTY_SQL + """
SELECT from_currency, to_currency, date, CAST(1000 AS DOUBLE) AS amount,
       CAST(CAST(1000 AS DECIMAL(10,2)) * COALESCE(bid_rate, rate) AS DOUBLE) AS converted_amount
FROM quotes
""")

SQL["rate_metrics"] = with_binding(DIRTY_SQL + """
SELECT date, ROUND(CASE WHEN bid_rate IS NOT NULL AND ask_rate IS NOT NULL
                   THEN (CAST(ask_rate AS DOUBLE) - CAST(bid_rate AS DOUBLE)) / CAST(rate AS DOUBLE) * 100 END, 6)
         AS spread_pct,
       epoch(TIMESTAMP '2001-11-04 00:00:00') - epoch(timestamp) > 24 * 3600 AS is_stale,
       concat(from_currency, to_currency) AS pair_name
FROM quotes
""")

_BELOW_ZERO = "least(opening_price, high_price, low_price, closing_price) <= 0"
_OUTSIDE = ("greatest(opening_price, closing_price, low_price) > high_price "
            "OR least(opening_price, closing_price) < low_price")
_WILD = "abs(daily_return) > 50"

# Fixed output values: the names and severities of the checks.
SQL["quality_checks"] = with_binding(DIRTY_SQL + f"""
, bars_seen AS (
  SELECT COUNT(*) FILTER ({_BELOW_ZERO}) AS below, COUNT(*) FILTER ({_OUTSIDE}) AS outside,
         COUNT(*) FILTER ({_WILD}) AS wild, MAX(date_id) AS newest
  FROM dirty_prices),
twice AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT stock_id, date_id FROM
            (SELECT stock_id, date_id, ROW_NUMBER() OVER (PARTITION BY stock_id, date_id) AS nth FROM dirty_prices) x
            WHERE nth = 2) y),
recent AS (SELECT COUNT(DISTINCT stock_id) AS n FROM dirty_prices SEMI JOIN
             (SELECT stock_id FROM dim_stocks WHERE symbol IN {TRACKED_SQL}) USING (stock_id)
           WHERE make_date(date_id // 10000, date_id // 100 % 100, date_id % 100) >= {AS_OF_SQL} - 30),
zero_rates AS (SELECT COUNT(*) AS n FROM dirty_rates WHERE NOT exchange_rate > 0)
SELECT unnest(['Duplicate stock prices', 'Negative stock prices', 'Invalid price relationships',
               'Extreme daily returns', 'Invalid currency rates', 'Missing recent data', 'Missing stock data'])
         AS check_name,
       unnest([twice.n, below, outside, wild, zero_rates.n,
               CAST(make_date(newest // 10000, newest // 100 % 100, newest % 100) < {AS_OF_SQL} - 7 AS BIGINT),
               7 - recent.n]) AS violation_count,
       unnest(['CRITICAL', 'CRITICAL', 'CRITICAL', 'WARNING', 'CRITICAL', 'WARNING', 'WARNING']) AS severity
FROM bars_seen, twice, recent, zero_rates
""")

SQL["quality_score"] = with_binding(DIRTY_SQL + f"""
, found AS (SELECT bool_or({_BELOW_ZERO}) AS critical, COUNT(*) FILTER ({_WILD}) AS warnings FROM dirty_prices)
SELECT 'OVERALL_QUALITY_SCORE' AS metric_name,
       CAST(IF(critical, 0, 1 - 0.1 * (warnings > 0)::INT - 0.2 * (warnings > 5)::INT) AS DOUBLE) AS quality_score
FROM found
""")

SQL["quality_status"] = with_binding(DIRTY_SQL + """
, day AS (
  SELECT COUNT(*) AS total_records, COUNT(DISTINCT stock_id) AS unique_stocks,
         COUNT(*) - COUNT(daily_return) AS null_returns, COUNT(*) FILTER (volume = 0) AS zero_volume_records
  FROM dirty_prices WHERE date_id = 20011031)
SELECT list_filter([IF(unique_stocks < 7, 'FAIL: Missing stock data', NULL),
                    IF(total_records < 7, 'FAIL: Insufficient records', NULL),
                    IF(null_returns > 1, 'WARN: High null return rate', NULL),
                    IF(zero_volume_records > 0, 'WARN: Zero volume detected', NULL),
                    'PASS: Data quality acceptable'], lambda x: x IS NOT NULL)[1] AS quality_status,
       * FROM day
""")

BARS_IN = """, bi AS (
  SELECT f.stock_id, f.date_id, upper(replace(ds.symbol, '#', '')) AS symbol,
         CAST(dd.date_value AS TIMESTAMP) AS timestamp,
         CAST(CAST(f.opening_price AS DECIMAL(10,2)) AS DECIMAL(20,6)) AS o,
         CAST(CAST(f.high_price AS DECIMAL(10,2)) AS DECIMAL(20,6)) AS h,
         CAST(CAST(f.low_price AS DECIMAL(10,2)) AS DECIMAL(20,6)) AS lo,
         CAST(CAST(f.closing_price AS DECIMAL(10,2)) AS DECIMAL(20,6)) AS c,
         f.volume AS v, 'alpha_vantage' AS source, 'daily' AS data_type
  FROM dirty_prices f JOIN dim_stocks ds ON f.stock_id = ds.stock_id
  JOIN dim_date dd ON f.date_id = dd.date_id WHERE ds.is_active)"""


def PLACES(x: str) -> str:
    s = f"regexp_replace(CAST(CAST(abs({x}) AS DECIMAL(38,10)) AS VARCHAR), '0+$', '')"
    return f"(CASE WHEN strpos({s}, '.') > 0 THEN length(split_part({s}, '.', 2)) ELSE 0 END)"


def IDIG(x: str) -> str:
    return f"length(CAST(CAST(floor(abs({x})) AS DECIMAL(38,0)) AS VARCHAR))"


def PRICE_RULES(name: str, x: str) -> list[str]:
    return [
        f"CASE WHEN {x} IS NULL THEN '{name} is required' END",
        f"CASE WHEN {x} <= 0 THEN '{name} must be greater than 0' END",
        f"CASE WHEN {x} > 0 AND {x} < 0.01 THEN 'Price must be at least $0.01' END",
        f"CASE WHEN {x} > 100000 THEN 'Price cannot exceed $100,000' END",
        f"CASE WHEN {PLACES(x)} > 2 THEN '{name} must have at most 2 decimal places' END",
        f"CASE WHEN {PLACES(x)} + {IDIG(x)} > 10 THEN '{name} must have at most 10 digits' END",
    ]


def T(x: str) -> str:
    return f"CAST(CAST({x} AS DOUBLE) AS VARCHAR)"


BAR_RULES = [
    "CASE WHEN symbol IS NULL OR length(symbol) < 1 OR length(symbol) > 10 THEN 'symbol must have 1 to 10 characters' END",
    "CASE WHEN NOT regexp_matches(symbol, '^[A-Z0-9.-]+$') THEN 'symbol must match ^[A-Z0-9.-]+$' END",
    "CASE WHEN upper(trim(symbol)) IN ('', 'NULL', 'NONE', 'N/A') THEN 'Invalid symbol' END",
    "CASE WHEN timestamp IS NULL THEN 'timestamp is required' END",
    "CASE WHEN year(timestamp) < 1980 THEN 'Timestamp cannot be before 1980' END",
    "CASE WHEN timestamp > TIMESTAMP '2001-11-04 00:00:00' THEN 'Timestamp cannot be in the future' END",
    *PRICE_RULES("open", "o"), *PRICE_RULES("high", "h"), *PRICE_RULES("low", "lo"), *PRICE_RULES("close", "c"),
    "CASE WHEN v IS NULL THEN 'volume is required' END",
    "CASE WHEN v < 0 THEN 'volume must be greater than or equal to 0' END",
    "CASE WHEN v > 10000000000 THEN 'volume must be less than or equal to 10000000000' END",
    f"CASE WHEN h < lo THEN format('High price ({{}}) cannot be less than low price ({{}})', {T('h')}, {T('lo')}) END",
    f"CASE WHEN h < o THEN format('High price ({{}}) cannot be less than open price ({{}})', {T('h')}, {T('o')}) END",
    f"CASE WHEN h < c THEN format('High price ({{}}) cannot be less than close price ({{}})', {T('h')}, {T('c')}) END",
    f"CASE WHEN lo > o THEN format('Low price ({{}}) cannot be greater than open price ({{}})', {T('lo')}, {T('o')}) END",
    f"CASE WHEN lo > c THEN format('Low price ({{}}) cannot be greater than close price ({{}})', {T('lo')}, {T('c')}) END",
    "CASE WHEN v = 0 AND o <> c THEN 'Cannot have price movement with zero volume' END",
]


def ERRS(rules: list[str]) -> str:
    return "list_filter([" + ",\n  ".join(rules) + "], lambda x: x IS NOT NULL)"


SQL["validate_bars"] = with_binding(DIRTY_SQL + BARS_IN + f"""
, e AS (SELECT stock_id, date_id, {ERRS(BAR_RULES)} AS errs FROM bi)
SELECT stock_id, date_id, array_to_string(errs, '; ') AS errors, CAST(len(errs) AS INT) AS n_errors FROM e
""")

SQL["validate_batches"] = with_binding(DIRTY_SQL + BARS_IN + """
, points AS (SELECT symbol AS batch, CASE WHEN (stock_id * 31 + date_id) % 97 = 5 THEN 'ZZZ' ELSE symbol END AS own, source, data_type,
                  timestamp FROM bi),
g AS (SELECT batch, source, data_type, COUNT(*) AS point_count, COUNT(DISTINCT timestamp) AS distinct_ts,
             COUNT(DISTINCT own) AS symbols, COUNT(*) FILTER (own <> batch) AS foreign_points FROM points GROUP BY ALL),
e AS (SELECT *, list_filter([
   CASE WHEN point_count > 10000 THEN 'at most 10000 data points' END,
   CASE WHEN distinct_ts < point_count THEN 'Duplicate timestamps found in data points' END,
   CASE WHEN foreign_points > 0 THEN 'Data point symbol does not match the batch symbol' END,
   CASE WHEN source NOT IN ('alpha_vantage','yahoo','polygon','iex','manual') THEN 'source is not an accepted source' END,
   CASE WHEN data_type NOT IN ('daily','intraday','weekly','monthly') THEN 'data_type is not an accepted type' END
  ], lambda x: x IS NOT NULL) AS errs FROM g)
SELECT batch, source, data_type, point_count, distinct_ts, symbols, foreign_points,
       array_to_string(errs, '; ') AS errors, CAST(len(errs) AS INT) AS n_errors FROM e
""")

SQL["batch_warnings"] = with_binding(DIRTY_SQL + BARS_IN + """
, w AS (SELECT stock_id, date_id,
          date_diff('day', CAST(lag(timestamp) OVER (PARTITION BY symbol ORDER BY timestamp) AS DATE),
                    CAST(timestamp AS DATE)) AS gap,
          AVG(CAST(v AS DOUBLE)) OVER (PARTITION BY symbol) AS mean_v,
          COUNT(*) OVER (PARTITION BY symbol) AS n, v, CAST(h AS DOUBLE) AS hd, CAST(lo AS DOUBLE) AS lod,
          data_type
        FROM bi),
e AS (SELECT stock_id, date_id, list_filter([
   CASE WHEN data_type = 'daily' AND gap > 10 THEN format('gap of {} days', gap) END,
   CASE WHEN n > 2 AND mean_v > 0 AND v > mean_v * 100.0 THEN 'volume outlier' END,
   CASE WHEN (hd - lod) > (hd + lod) / 2 * 0.5 THEN 'suspicious daily range' END
  ], lambda x: x IS NOT NULL) AS ws FROM w)
SELECT stock_id, date_id, array_to_string(ws, '; ') AS warnings, CAST(len(ws) AS INT) AS n_warnings FROM e
""")


def RATE_BOUNDS(name: str, x: str, required: bool) -> list[str]:
    out = [f"CASE WHEN {x} IS NULL THEN '{name} is required' END"] if required else []
    return out + [
        f"CASE WHEN {x} <= 0 THEN '{name} must be greater than 0' END",
        f"CASE WHEN {x} > 0 AND {x} < 0.000001 THEN 'Exchange rate too small (minimum 0.000001)' END",
        f"CASE WHEN {x} > 1000000 THEN 'Exchange rate too large (maximum 1,000,000)' END",
        f"CASE WHEN {PLACES(x)} > 6 THEN '{name} must have at most 6 decimal places' END",
        f"CASE WHEN {PLACES(x)} + {IDIG(x)} > 12 THEN '{name} must have at most 12 digits' END",
    ]


RATE_RULES = [
    "CASE WHEN from_currency IS NULL OR NOT regexp_matches(from_currency, '^[A-Z]{3}$') THEN 'from_currency must be 3 upper-case letters' END",
    "CASE WHEN to_currency IS NULL OR NOT regexp_matches(to_currency, '^[A-Z]{3}$') THEN 'to_currency must be 3 upper-case letters' END",
    "CASE WHEN timestamp IS NULL THEN 'timestamp is required' END",
    "CASE WHEN year(timestamp) < 1990 THEN 'Currency rate timestamp cannot be before 1990' END",
    "CASE WHEN timestamp > TIMESTAMP '2001-11-04 00:00:00' THEN 'Currency rate timestamp cannot be in the future' END",
    *RATE_BOUNDS("rate", "r", True), *RATE_BOUNDS("bid_rate", "b", False), *RATE_BOUNDS("ask_rate", "a", False),
    "CASE WHEN from_currency = to_currency THEN 'Cannot convert currency to itself' END",
    "CASE WHEN b IS NOT NULL AND a IS NOT NULL AND b >= a THEN 'Bid rate must be less than ask rate' END",
    "CASE WHEN b IS NOT NULL AND a IS NOT NULL AND b < a AND (r < b OR r > a) THEN 'Exchange rate must be between bid and ask rates' END",
    "CASE WHEN source NOT IN ('alpha_vantage','yahoo','xe','fixer','manual') THEN 'source is not an accepted source' END",
]

SQL["validate_rates"] = with_binding(DIRTY_SQL + f"""
, qi AS (SELECT *, CAST(rate AS DECIMAL(20,8)) AS r, CAST(bid_rate AS DECIMAL(20,8)) AS b,
                CAST(ask_rate AS DECIMAL(20,8)) AS a FROM quotes),
e AS (SELECT date, {ERRS(RATE_RULES)} AS errs FROM qi)
SELECT date, array_to_string(errs, '; ') AS errors, CAST(len(errs) AS INT) AS n_errors FROM e
""")

KNOWN_SQL = ("('USD','EUR','GBP','JPY','CHF','CAD','AUD','NZD','CNY','INR','BRL','MXN','ZAR','SGD','HKD',"
             "'NOK','SEK','DKK','PLN','CZK','HUF','RUB','TRY','KRW')")

SQL["rate_warnings"] = with_binding(DIRTY_SQL + f"""
, e AS (SELECT date, list_filter([
   CASE WHEN from_currency NOT IN {KNOWN_SQL} THEN format('Unknown currency code: {{}}', from_currency) END,
   CASE WHEN to_currency NOT IN {KNOWN_SQL} THEN format('Unknown currency code: {{}}', to_currency) END,
   CASE WHEN (CAST(ask_rate AS DOUBLE) - CAST(bid_rate AS DOUBLE)) / CAST(rate AS DOUBLE) * 100 > 10.0
        THEN 'wide spread' END], lambda x: x IS NOT NULL) AS ws FROM quotes)
SELECT date, array_to_string(ws, '; ') AS warnings, CAST(len(ws) AS INT) AS n_warnings FROM e
""")

SQL["check_response"] = with_binding(DIRTY_SQL + f"""
, pw AS (SELECT ds.symbol, dd.date_value AS trade_date, f.closing_price AS price_usd,
                ROUND(f.closing_price * r.exchange_rate, 4) AS price_gbp, r.exchange_rate AS usd_to_gbp_rate,
                f.volume
  FROM dirty_prices f JOIN dim_stocks ds ON f.stock_id = ds.stock_id
  JOIN dim_date dd ON f.date_id = dd.date_id
  LEFT JOIN dirty_rates r ON dd.date_id = r.date_id AND r.from_currency_id = {USD} AND r.to_currency_id = {GBP}
  WHERE ds.is_active),
e AS (SELECT symbol, trade_date, price_usd, list_filter([
   CASE WHEN price_usd <= 0 THEN 'price_usd must be positive' END,
   CASE WHEN volume < 0 THEN 'volume must be non-negative' END,
   CASE WHEN price_gbp IS NOT NULL AND price_gbp <= 0 THEN 'price_gbp must be positive if provided' END,
   CASE WHEN usd_to_gbp_rate IS NOT NULL AND usd_to_gbp_rate <= 0 THEN 'usd_to_gbp_rate must be positive if provided' END
  ], lambda x: x IS NOT NULL) AS errs FROM pw)
SELECT symbol, trade_date, CAST(price_usd AS DOUBLE) AS price_usd, array_to_string(errs, '; ') AS errors,
       CAST(len(errs) AS INT) AS n_errors FROM e
""")

SQL["check_conversion"] = with_binding(f"""
, cc AS (SELECT ds.symbol, dd.date_value AS rate_date, f.closing_price AS price_usd,
                r.exchange_rate AS usd_to_gbp_rate, ROUND(f.closing_price * r.exchange_rate, 4) AS price_gbp
  FROM fact_stock_prices f JOIN dim_stocks ds ON f.stock_id = ds.stock_id
  JOIN dim_date dd ON f.date_id = dd.date_id JOIN fact_currency_rates r ON dd.date_id = r.date_id
  WHERE r.from_currency_id = {USD} AND r.to_currency_id = {GBP} AND ds.is_active
    AND dd.date_value = (SELECT MAX(dd2.date_value) FROM dim_date dd2 JOIN fact_currency_rates r2
                         ON dd2.date_id = r2.date_id WHERE r2.from_currency_id = {USD} AND r2.to_currency_id = {GBP})),
a AS (SELECT *, CAST(floor((epoch(TIMESTAMP '2001-11-04 00:00:00') - epoch(CAST(rate_date AS TIMESTAMP))) / 3600) AS INT)
                AS rate_age_hours,
             CAST(price_usd AS DECIMAL(20,6)) * CAST(usd_to_gbp_rate AS DECIMAL(20,6)) AS expected FROM cc),
e AS (SELECT symbol, rate_date, rate_age_hours, rate_age_hours > 24 AS is_rate_stale, list_filter([
   CASE WHEN price_usd <= 0 THEN 'price_usd must be greater than 0' END,
   CASE WHEN usd_to_gbp_rate <= 0 THEN 'usd_to_gbp_rate must be greater than 0' END,
   CASE WHEN price_gbp <= 0 THEN 'price_gbp must be greater than 0' END,
   CASE WHEN abs(CAST(price_gbp AS DECIMAL(20,6)) - expected) > expected * 0.0001
        THEN 'GBP price doesn''t match conversion within tolerance' END,
   CASE WHEN rate_age_hours < 0 THEN 'rate_age_hours must be greater than or equal to 0' END
  ], lambda x: x IS NOT NULL) AS errs FROM a)
SELECT symbol, rate_date, rate_age_hours, is_rate_stale, array_to_string(errs, '; ') AS errors,
       CAST(len(errs) AS INT) AS n_errors FROM e
""")

SQL["check_performance"] = market(_DETAILS + """
, e AS (SELECT symbol, trade_date, performance_rank, list_filter([
   CASE WHEN NOT regexp_matches(regexp_replace(upper(trim(symbol)), '[.-]', '', 'g'), '^[A-Z0-9]+$')
        THEN 'Invalid symbol format' END,
   CASE WHEN price_usd <= 0 THEN 'price_usd must be greater than 0' END,
   CASE WHEN price_gbp <= 0 THEN 'price_gbp must be greater than 0' END,
   CASE WHEN daily_return < -100 OR daily_return > 1000 THEN 'daily_return_pct must be between -100 and 1000' END,
   CASE WHEN volume < 0 THEN 'volume must be greater than or equal to 0' END,
   CASE WHEN trade_date > DATE '2001-11-04' THEN 'Trade date cannot be in the future' END,
   CASE WHEN performance_rank < 1 OR performance_rank > 10 THEN 'performance_rank must be between 1 and 10' END,
   CASE WHEN volatility_30d < 0 THEN 'volatility_30d must be greater than or equal to 0' END
  ], lambda x: x IS NOT NULL) AS errs FROM details)
SELECT symbol, trade_date, performance_rank, array_to_string(errs, '; ') AS errors,
       CAST(len(errs) AS INT) AS n_errors FROM e
""")


def _dup(table: str, keys: str) -> str:
    return (f"(SELECT COALESCE(SUM(n - 1), 0) FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {keys}) g"
            f" WHERE n > 1)")


def _fk(table: str, col: str, dim: str, dim_col: str) -> str:
    return f"(SELECT COUNT(*) FROM {table} x WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dim_col} = x.{col}))"


_AUDIT = [
    ("dim_stocks", "unique symbol", _dup("dim_stocks", "symbol")),
    ("dim_stocks", "unique stock_id", _dup("dim_stocks", "stock_id")),
    ("dim_stocks", "symbol not null, length <= 10",
     "(SELECT COUNT(*) FROM dim_stocks WHERE symbol IS NULL OR length(symbol) > 10)"),
    ("dim_date", "unique date_value", _dup("dim_date", "date_value")),
    ("dim_date", "calendar parts not null",
     "(SELECT COUNT(*) FROM dim_date WHERE year IS NULL OR month IS NULL OR day IS NULL OR is_weekend IS NULL)"),
    ("dim_currency", "unique currency_code", _dup("dim_currency", "currency_code")),
    ("dim_currency", "currency_code length = 3",
     "(SELECT COUNT(*) FROM dim_currency WHERE currency_code IS NULL OR length(currency_code) <> 3)"),
    ("fact_stock_prices", "unique (stock_id, date_id)", _dup("dirty_prices", "stock_id, date_id")),
    ("fact_stock_prices", "stock_id references dim_stocks", _fk("dirty_prices", "stock_id", "dim_stocks", "stock_id")),
    ("fact_stock_prices", "date_id references dim_date", _fk("dirty_prices", "date_id", "dim_date", "date_id")),
    ("fact_stock_prices", "prices and volume not null",
     "(SELECT COUNT(*) FROM dirty_prices WHERE opening_price IS NULL OR high_price IS NULL OR low_price IS NULL"
     " OR closing_price IS NULL OR volume IS NULL)"),
    ("fact_currency_rates", "unique (from, to, date_id)",
     _dup("dirty_rates", "from_currency_id, to_currency_id, date_id")),
    ("fact_currency_rates", "from_currency_id references dim_currency",
     _fk("dirty_rates", "from_currency_id", "dim_currency", "currency_id")),
    ("fact_currency_rates", "to_currency_id references dim_currency",
     _fk("dirty_rates", "to_currency_id", "dim_currency", "currency_id")),
    ("fact_currency_rates", "date_id references dim_date", _fk("dirty_rates", "date_id", "dim_date", "date_id")),
    ("fact_currency_rates", "exchange_rate not null",
     "(SELECT COUNT(*) FROM dirty_rates WHERE exchange_rate IS NULL)"),
]
SQL["constraint_audit"] = with_binding(DIRTY_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{r}' AS rule, CAST({q} AS BIGINT) AS violations" for t, r, q in _AUDIT))


# -- payload round trips ----------------------------------------------------

SQL["payload_daily"] = with_binding("""
SELECT dd.date_value AS "Date", CAST(f.opening_price AS DOUBLE) AS "Open", CAST(f.high_price AS DOUBLE) AS "High",
       CAST(f.low_price AS DOUBLE) AS "Low", CAST(f.closing_price AS DOUBLE) AS "Close", f.volume AS "Volume",
       ds.symbol AS "Symbol"
FROM fact_stock_prices f JOIN dim_stocks ds ON f.stock_id = ds.stock_id JOIN dim_date dd ON f.date_id = dd.date_id
""")

SQL["standard_columns"] = SQL["payload_daily"].replace('AS "Symbol"', 'AS symbol').replace('f.volume AS "Volume"', 'CAST(f.volume AS DOUBLE) AS "Volume"')

SQL["payload_crypto"] = with_binding("""
SELECT CAST(dd.date_value AS TIMESTAMP) AS "DateTime", CAST(f.opening_price AS DOUBLE) AS "Open",
       CAST(f.high_price AS DOUBLE) AS "High", CAST(f.low_price AS DOUBLE) AS "Low",
       CAST(f.closing_price AS DOUBLE) AS "Close", CAST(f.volume AS DOUBLE) AS "Volume", CAST(0.0 AS DOUBLE) AS "MarketCap",
       ds.symbol AS "CurrencyCode", 'USD' AS "MarketCode"
FROM fact_stock_prices f JOIN dim_stocks ds ON f.stock_id = ds.stock_id JOIN dim_date dd ON f.date_id = dd.date_id
""")

SQL["payload_intraday"] = """
SELECT ts AS "DateTime", value AS "Open", value AS "High", value AS "Low", value AS "Close",
       CAST(user_id AS BIGINT) AS "Volume", event_type AS "Symbol", '5min' AS "Interval"
FROM (SELECT event_type, ts, max_by(value, event_id) AS value, max_by(user_id, event_id) AS user_id
      FROM events GROUP BY event_type, ts) e
"""

SQL["payload_fx_daily"] = with_binding("""
SELECT CAST(date AS TIMESTAMP) AS "DateTime", CAST(min_by(rate, updated_at) AS DOUBLE) AS "Open",
       CAST(max(rate) AS DOUBLE) AS "High", CAST(min(rate) AS DOUBLE) AS "Low",
       CAST(max_by(rate, updated_at) AS DOUBLE) AS "Close", from_currency AS "FromCurrency", to_currency AS "ToCurrency"
FROM exchange_rates GROUP BY from_currency, to_currency, date
""")

SQL["payload_fx_quote"] = with_binding(DIRTY_SQL + """
SELECT from_currency, to_currency, CAST(rate AS DOUBLE) AS exchange_rate,
       strftime(date, '%Y-%m-%d') || ' 16:00:00' AS last_refreshed, 'UTC' AS timezone,
       CAST(bid_rate AS DOUBLE) AS bid_price, CAST(ask_rate AS DOUBLE) AS ask_price
FROM quotes
""")

SQL["payload_overview"] = with_binding("""
, g AS (SELECT ds.symbol, SUM(f.volume) AS shares, max_by(f.closing_price, dd.date_value) AS last
        FROM fact_stock_prices f JOIN dim_stocks ds ON f.stock_id = ds.stock_id
        JOIN dim_date dd ON f.date_id = dd.date_id GROUP BY ds.symbol)
SELECT symbol, symbol || ' Inc.' AS company_name, 'TECHNOLOGY' AS sector, CAST(NULL AS VARCHAR) AS industry,
       CAST(ROUND(last * shares) AS BIGINT) AS market_cap, CAST(NULL AS DOUBLE) AS pe_ratio,
       CAST(shares AS BIGINT) AS shares_outstanding
FROM g
""")

def _event_bodies() -> str:
    from .registry import EVENT_BODIES

    kinds = ", ".join("'" + b.replace("'", "''") + "'" for b in EVENT_BODIES)
    return f"""
WITH texts AS (SELECT event_id, replace([{kinds}][1 + event_id % {len(EVENT_BODIES)}], '{{u}}', CAST(user_id AS VARCHAR))
                      AS body FROM events),
parsed AS (SELECT event_id, IF(json_valid(body), IF(json_type(body) = 'OBJECT', body, NULL), NULL) AS j FROM texts)"""


# The words that tell the classes apart, each list as one pattern.
_SAYS = {"notice": "rate limit|frequency|calls per|thank you for using", "limit": "rate limit|requests per minute",
         "daily": "25 requests per day|daily rate limit|requests per day", "auth": "invalid api|authentication"}


def _says(text: str, kind: str) -> str:
    return f"COALESCE(regexp_matches(lower({text}), '{_SAYS[kind]}'), FALSE)"


_KEY = lambda k: f"json_extract_string(j, '$.\"{k}\"')"
_NOTICES = ", ".join(f"IF({_says(_KEY(k), 'notice')}, {_KEY(k)}, NULL)" for k in ("Note", "note", "Information"))


def _triage() -> str:
    return f"""{_event_bodies()},
said AS (SELECT event_id, j, COALESCE({_KEY('Error Message')}, {_KEY('error')}, {_KEY('message')}) AS failure,
                COALESCE({_NOTICES}) AS notice FROM parsed)
SELECT event_id, COALESCE(failure, notice) AS message,
       CASE WHEN j IS NULL THEN 'invalid'
            WHEN failure IS NOT NULL AND {_says('failure', 'limit')}
            THEN IF({_says('failure', 'daily')}, 'daily_limit', 'rate_limited')
            WHEN failure IS NOT NULL THEN IF({_says('failure', 'auth')}, 'auth', 'error')
            WHEN notice IS NOT NULL THEN IF({_says('notice', 'daily')}, 'daily_limit', 'rate_limited')
            ELSE IF(len(json_keys(j)) = 0, 'empty', 'ok') END AS status
FROM said"""


def _structure() -> str:
    return f"""{_event_bodies()},
days AS (SELECT event_id, json_extract(j, '$."Time Series (Daily)"') AS d FROM parsed),
found AS (
  SELECT event_id, CASE
    WHEN d IS NULL THEN 'Expected key ''Time Series (Daily)'' not found in response'
    WHEN json_type(d) <> 'OBJECT' THEN 'Time series data must be a dictionary'
    WHEN len(json_keys(d)) = 0 THEN 'Time series data is empty'
    WHEN len(list_filter(json_extract(d, '$.*'), lambda e: json_type(e) <> 'OBJECT' OR len(json_keys(e)) = 0)) > 0
    THEN 'Values for every date must be a non-empty dictionary' END AS problem FROM days)
SELECT event_id, COALESCE(problem, '') AS errors, CAST(problem IS NOT NULL AS INT) AS n_errors FROM found"""


# -- dimensions, keyed writes, backfill, status, conform, presentation -----


def CAL(x: str) -> str:
    return (f"CAST(year({x})*10000+month({x})*100+day({x}) AS INT) AS date_id, CAST({x} AS DATE) AS date_value, "
            f"CAST(year({x}) AS INT) AS year, CAST(quarter({x}) AS INT) AS quarter, CAST(month({x}) AS INT) AS month, "
            f"CAST(day({x}) AS INT) AS day, CAST(dayofweek({x}) AS INT) AS day_of_week, "
            f"CAST(dayofyear({x}) AS INT) AS day_of_year, CAST(weekofyear({x}) AS INT) AS week_of_year, "
            f"dayofweek({x}) IN (0, 6) AS is_weekend, FALSE AS is_holiday")


DIMC = ("date_id, date_value, year, quarter, month, day, day_of_week, day_of_year, week_of_year, "
        "is_weekend, is_holiday")

SQL["seed_dims"] = with_binding("""
, seeds AS (SELECT * FROM (VALUES
    ('AAPL', 'Apple Inc.', 'Technology', 'Large Cap'),
    ('MSFT', 'Microsoft Corporation', 'Technology', 'Large Cap'),
    ('AMZN', 'Amazon.com Inc.', 'Consumer Discretionary', 'Large Cap'),
    ('GOOGL', 'Alphabet Inc.', 'Technology', 'Large Cap'),
    ('META', 'Meta Platforms Inc.', 'Technology', 'Large Cap'),
    ('NVDA', 'NVIDIA Corporation', 'Technology', 'Large Cap'),
    ('TSLA', 'Tesla Inc.', 'Consumer Discretionary', 'Large Cap')) s(symbol, company_name, sector, market_cap_category)),
new AS (SELECT * FROM seeds WHERE symbol NOT IN (SELECT symbol FROM dim_stocks))
SELECT stock_id, symbol, company_name, CAST(NULL AS VARCHAR) AS sector, CAST(NULL AS VARCHAR) AS market_cap_category,
       is_active FROM dim_stocks
UNION ALL
SELECT CAST((SELECT max(stock_id) FROM dim_stocks) + row_number() OVER (ORDER BY symbol) AS INT), symbol,
       company_name, sector, market_cap_category, TRUE FROM new
""")

SQL["ensure_dates"] = with_binding(f"""
, old AS (SELECT {DIMC} FROM dim_date WHERE date_value < DATE '2001-10-01'),
cand AS (SELECT {CAL('d')} FROM (SELECT DISTINCT d FROM bars) b)
SELECT {DIMC} FROM old
UNION ALL
SELECT {DIMC} FROM cand WHERE date_value NOT IN (SELECT date_value FROM old)
""")

SQL["calendar"] = with_binding(f"""
, gen AS (SELECT CAST(g AS DATE) AS g FROM generate_series(DATE '2001-01-01', DATE '2001-12-31', INTERVAL 1 DAY) t(g)
          UNION SELECT CAST(g AS DATE) FROM generate_series(DATE '2001-11-05', DATE '2001-12-04', INTERVAL 1 DAY) t(g)),
cand AS (SELECT {CAL('g')} FROM gen)
SELECT {DIMC} FROM dim_date
UNION ALL
SELECT {DIMC} FROM cand WHERE date_value NOT IN (SELECT date_value FROM dim_date)
""")

SQL["calendar_retention"] = with_binding(f"""
, gen AS (SELECT CAST(g AS DATE) AS g FROM generate_series((SELECT min(date_value) FROM dim_date),
                                                           (SELECT max(date_value) FROM dim_date), INTERVAL 1 DAY) t(g)),
full_dim AS (SELECT {DIMC} FROM dim_date
             UNION ALL SELECT {DIMC} FROM (SELECT {CAL('g')} FROM gen) c
             WHERE date_value NOT IN (SELECT date_value FROM dim_date)),
used AS (SELECT date_id FROM fact_stock_prices UNION SELECT date_id FROM fact_currency_rates),
kept AS (SELECT * FROM full_dim WHERE NOT (date_value < DATE '2001-11-04' - INTERVAL 5 YEAR
                                           AND date_id NOT IN (SELECT date_id FROM used)))
SELECT {DIMC} FROM kept
UNION ALL
SELECT {DIMC} FROM (SELECT {CAL("DATE '2001-11-04'")}) c WHERE date_value NOT IN (SELECT date_value FROM kept)
""")

SQL["dims_from_raw"] = with_binding(f"""
SELECT 'symbol' AS kind, symbol AS value FROM (SELECT DISTINCT symbol FROM stock_prices) s
WHERE symbol NOT IN (SELECT symbol FROM dim_stocks WHERE symbol IN {TRACKED_SQL})
UNION ALL
SELECT 'date', CAST(date AS VARCHAR) FROM (SELECT DISTINCT date FROM stock_prices) d
WHERE date NOT IN (SELECT date_value FROM dim_date WHERE date_value < DATE '2001-10-01')
""")

BATCH = """, tgt AS (SELECT * FROM fact_stock_prices WHERE date_id < 20011001),
bat AS (SELECT f.stock_id, f.date_id, f.opening_price, f.high_price, f.low_price,
               CAST(f.closing_price + CASE WHEN dd.date_value >= DATE '2001-10-15' THEN 2 ELSE 1 END
                    AS DECIMAL(10,4)) AS closing_price, f.volume
        FROM fact_stock_prices f JOIN dim_date dd ON f.date_id = dd.date_id
        WHERE dd.date_value >= DATE '2001-09-15')"""

SQL["upsert_prices"] = with_binding(BATCH + """
SELECT COALESCE(t.stock_id, b.stock_id) AS stock_id, COALESCE(t.date_id, b.date_id) AS date_id,
       CAST(CASE WHEN b.stock_id IS NOT NULL THEN b.opening_price ELSE t.opening_price END AS DOUBLE) AS opening_price,
       CAST(CASE WHEN b.stock_id IS NOT NULL THEN b.high_price ELSE t.high_price END AS DOUBLE) AS high_price,
       CAST(CASE WHEN b.stock_id IS NOT NULL THEN b.low_price ELSE t.low_price END AS DOUBLE) AS low_price,
       CAST(CASE WHEN b.stock_id IS NOT NULL THEN b.closing_price ELSE t.closing_price END AS DOUBLE) AS closing_price,
       CASE WHEN b.stock_id IS NOT NULL THEN b.volume ELSE t.volume END AS volume,
       CAST(CASE WHEN b.stock_id IS NOT NULL THEN b.closing_price ELSE t.adjusted_close END AS DOUBLE) AS adjusted_close,
       CASE WHEN b.stock_id IS NOT NULL THEN TIMESTAMP '2001-11-04 00:00:00' END AS updated_at
FROM tgt t FULL OUTER JOIN bat b ON t.stock_id = b.stock_id AND t.date_id = b.date_id
""")

SQL["insert_new_prices"] = with_binding(BATCH + """
SELECT stock_id, date_id, CAST(closing_price AS DOUBLE) AS closing_price, volume FROM tgt
UNION ALL
SELECT b.stock_id, b.date_id, CAST(b.closing_price AS DOUBLE), b.volume FROM bat b
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.stock_id = b.stock_id AND t.date_id = b.date_id)
""")

SQL["upsert_rates"] = with_binding("""
, tgt AS (SELECT * FROM fact_currency_rates WHERE date_id < 20011001),
bat AS (SELECT from_currency_id, to_currency_id, date_id,
               CAST(exchange_rate + CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,6)) AS exchange_rate
        FROM fact_currency_rates WHERE date_id >= 20010915)
SELECT COALESCE(t.from_currency_id, b.from_currency_id) AS from_currency_id,
       COALESCE(t.to_currency_id, b.to_currency_id) AS to_currency_id,
       COALESCE(t.date_id, b.date_id) AS date_id,
       CAST(CASE WHEN b.date_id IS NOT NULL THEN b.exchange_rate ELSE t.exchange_rate END AS DOUBLE) AS exchange_rate,
       CASE WHEN b.date_id IS NOT NULL THEN TIMESTAMP '2001-11-04 00:00:00' END AS updated_at
FROM tgt t FULL OUTER JOIN bat b ON t.from_currency_id = b.from_currency_id
  AND t.to_currency_id = b.to_currency_id AND t.date_id = b.date_id
""")

LOADS = """, sp_latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date
                                   ORDER BY updated_at DESC, created_at DESC) AS rn FROM stock_prices) x
                   WHERE rn = 1),
st_stage AS (SELECT symbol, d AS date, o AS open_price, h AS high_price, lo AS low_price, c AS close_price,
                    v AS volume, c AS adjusted_close FROM bars WHERE d >= DATE '2001-09-01'),
er_latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY from_currency, to_currency, date
                                   ORDER BY updated_at DESC, created_at DESC) AS rn FROM exchange_rates) x
              WHERE rn = 1),
fx_days AS (SELECT from_currency, to_currency, date, max_by(rate, updated_at) AS c
            FROM exchange_rates GROUP BY from_currency, to_currency, date),
rt_stage AS (SELECT from_currency, to_currency, date, c AS exchange_rate FROM fx_days WHERE date >= DATE '2001-09-01')"""

SQL["backfill_load_prices"] = with_binding(LOADS + """
, ins AS (SELECT * FROM st_stage WHERE date BETWEEN DATE '2001-10-01' AND DATE '2001-10-31')
SELECT COALESCE(t.symbol, s.symbol) AS symbol, COALESCE(t.date, s.date) AS date,
       CAST(CASE WHEN s.symbol IS NOT NULL THEN s.open_price ELSE t.open_price END AS DOUBLE) AS open_price,
       CAST(CASE WHEN s.symbol IS NOT NULL THEN s.high_price ELSE t.high_price END AS DOUBLE) AS high_price,
       CAST(CASE WHEN s.symbol IS NOT NULL THEN s.low_price ELSE t.low_price END AS DOUBLE) AS low_price,
       CAST(CASE WHEN s.symbol IS NOT NULL THEN s.close_price ELSE t.close_price END AS DOUBLE) AS close_price,
       CASE WHEN s.symbol IS NOT NULL THEN s.volume ELSE t.volume END AS volume,
       CAST(CASE WHEN s.symbol IS NOT NULL THEN s.adjusted_close ELSE t.adjusted_close END AS DOUBLE) AS adjusted_close,
       CASE WHEN t.symbol IS NOT NULL THEN t.created_at ELSE TIMESTAMP '2001-11-04 00:00:00' END AS created_at,
       CASE WHEN s.symbol IS NOT NULL THEN TIMESTAMP '2001-11-04 00:00:00' ELSE t.updated_at END AS updated_at
FROM sp_latest t FULL OUTER JOIN ins s ON t.symbol = s.symbol AND t.date = s.date
""")

SQL["backfill_load_rates"] = with_binding(LOADS + """
, ins AS (SELECT * FROM rt_stage WHERE date BETWEEN DATE '2001-10-01' AND DATE '2001-10-31')
SELECT COALESCE(t.from_currency, s.from_currency) AS from_currency, COALESCE(t.to_currency, s.to_currency) AS to_currency,
       COALESCE(t.date, s.date) AS date,
       CAST(CASE WHEN s.date IS NOT NULL THEN s.exchange_rate ELSE t.rate END AS DOUBLE) AS rate,
       CASE WHEN t.date IS NOT NULL THEN t.created_at ELSE TIMESTAMP '2001-11-04 00:00:00' END AS created_at,
       CASE WHEN s.date IS NOT NULL THEN TIMESTAMP '2001-11-04 00:00:00' ELSE t.updated_at END AS updated_at
FROM er_latest t FULL OUTER JOIN ins s ON t.from_currency = s.from_currency AND t.to_currency = s.to_currency
  AND t.date = s.date
""")

SQL["etl_log"] = with_binding(LOADS + """
SELECT 'BACKFILL' AS operation_type, 'stock_prices' AS table_name, TIMESTAMP '2001-11-04 00:00:00' AS operation_timestamp,
       (SELECT COUNT(*) FROM st_stage) AS records_affected, 'COMPLETED' AS status,
       'Historical stock data backfill for 2001-10-01 to 2001-10-31' AS details,
       (SELECT COUNT(*) FROM st_stage WHERE date BETWEEN DATE '2001-10-01' AND DATE '2001-10-31') AS records_loaded
UNION ALL
SELECT 'BACKFILL', 'exchange_rates', TIMESTAMP '2001-11-04 00:00:00', (SELECT COUNT(*) FROM rt_stage), 'COMPLETED',
       'Historical exchange rate backfill for 2001-10-01 to 2001-10-31',
       (SELECT COUNT(*) FROM rt_stage WHERE date BETWEEN DATE '2001-10-01' AND DATE '2001-10-31')
UNION ALL
SELECT 'DEDUPLICATION', 'stock_prices,exchange_rates', TIMESTAMP '2001-11-04 00:00:00', 0, 'COMPLETED',
       'Deduplication completed for backfill period 2001-10-01 to 2001-10-31', NULL
""")

IN_P = "date BETWEEN DATE '2001-10-01' AND DATE '2001-10-31'"

SQL["dedupe_prices"] = with_binding(f"""
, r AS (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY updated_at DESC, created_at DESC) AS rn
        FROM stock_prices WHERE {IN_P})
SELECT symbol, date, CAST(close_price AS DOUBLE) AS close_price, volume, updated_at FROM stock_prices
WHERE NOT ({IN_P}) OR date IS NULL
UNION ALL
SELECT symbol, date, CAST(close_price AS DOUBLE), volume, updated_at FROM r WHERE rn = 1
""")

SQL["dedupe_prices_literal"] = with_binding(f"""
, r AS (SELECT *, COUNT(*) OVER (PARTITION BY symbol, date) AS n FROM stock_prices WHERE {IN_P})
SELECT symbol, date, CAST(close_price AS DOUBLE) AS close_price, volume, updated_at FROM stock_prices
WHERE NOT ({IN_P}) OR date IS NULL
UNION ALL
SELECT symbol, date, CAST(close_price AS DOUBLE), volume, updated_at FROM r WHERE n = 1
""")

SQL["dedupe_rates"] = with_binding(f"""
, r AS (SELECT *, row_number() OVER (PARTITION BY from_currency, to_currency, date
                                     ORDER BY updated_at DESC, created_at DESC) AS rn
        FROM exchange_rates WHERE {IN_P})
SELECT from_currency, to_currency, date, CAST(rate AS DOUBLE) AS rate, updated_at FROM exchange_rates
WHERE NOT ({IN_P}) OR date IS NULL
UNION ALL
SELECT from_currency, to_currency, date, CAST(rate AS DOUBLE), updated_at FROM r WHERE rn = 1
""")

_HAS = "MIN(date) AS earliest_{0}_date, MAX(date) AS latest_{0}_date"
SQL["backfill_validate_period"] = with_binding(f"""
, asked AS (SELECT DATE '2001-10-01' AS lo, DATE '2001-10-31' AS hi, {AS_OF_SQL} AS today),
bars_there AS (SELECT COUNT(*) AS existing_stock_records, {_HAS.format('stock')} FROM stock_prices WHERE {IN_P}),
rates_there AS (SELECT COUNT(*) AS existing_exchange_records, {_HAS.format('exchange')}
                FROM exchange_rates WHERE {IN_P})
SELECT CAST(lo AS VARCHAR) AS requested_start_date, CAST(hi AS VARCHAR) AS requested_end_date,
       today AS validation_date,
       COALESCE(IF(lo < today, NULL, 'ERROR: Start date cannot be in the future'),
                IF(hi <= today, NULL, 'ERROR: End date cannot be in the future'),
                IF(lo < hi, NULL, 'ERROR: Start date must be before end date'), 'VALID') AS validation_status,
       CAST(hi - lo AS INT) AS backfill_days, bars_there.*, rates_there.*,
       IF(existing_stock_records + existing_exchange_records = 0, 'READY_FOR_BACKFILL',
          'WARNING: Existing data found in range') AS final_status
FROM asked, bars_there, rates_there
""")

# Fixed output values: the names of the counts, each with what it counts.
_BAR_COUNTS = {
    **{f"invalid_{c}_prices": f"{c}_price <= 0" for c in ("open", "high", "low", "close")},
    "invalid_volumes": "volume < 0", "high_less_than_low": "low_price > high_price",
    "high_less_than_open": "open_price > high_price", "high_less_than_close": "close_price > high_price",
    "low_greater_than_open": "open_price < low_price", "low_greater_than_close": "close_price < low_price"}
_RATE_COUNTS = {"invalid_rates": "rate <= 0", "suspicious_high_rates": "rate > 1000",
                "self_conversions": "from_currency = to_currency"}
_counts = lambda rules: ", ".join(f"COUNT(*) FILTER ({what}) AS {name}" for name, what in rules.items())
_ISSUES = " + ".join([*_BAR_COUNTS, "invalid_rates", "self_conversions"])
SQL["backfill_validate_data"] = with_binding(f"""
, bars_in AS (SELECT COUNT(*) AS total_stock_records, COUNT(DISTINCT symbol) AS unique_symbols,
                     COUNT(DISTINCT date) AS unique_dates, MIN(date) AS earliest_date, MAX(date) AS latest_date,
                     {_counts(_BAR_COUNTS)} FROM stock_prices WHERE {IN_P}),
rates_in AS (SELECT COUNT(*) AS total_exchange_records, COUNT(DISTINCT from_currency) AS unique_from_currencies,
                    COUNT(DISTINCT to_currency) AS unique_to_currencies, COUNT(DISTINCT date) AS unique_exchange_dates,
                    {_HAS.format('exchange')}, {_counts(_RATE_COUNTS)} FROM exchange_rates WHERE {IN_P}),
absent AS (SELECT COUNT(*) AS missing_symbol_count, string_agg(symbol, ', ' ORDER BY symbol) AS missing_symbols
           FROM (SELECT unnest([{TRACKED_SQL.strip('()')}]) AS symbol
                 EXCEPT SELECT symbol FROM stock_prices WHERE {IN_P}) x)
SELECT '2001-10-01' AS backfill_start, '2001-10-31' AS backfill_end, bars_in.*, rates_in.*,
       ['EXCELLENT', 'GOOD', 'FAIR', 'POOR'][1 + ({_ISSUES} > 0)::INT + ({_ISSUES} > 5)::INT + ({_ISSUES} > 20)::INT]
         AS data_quality_score, absent.*
FROM bars_in, rates_in, absent
""")

# every record meets every quote of its day, so the counts below are of pairs
SQL["backfill_report"] = with_binding(LOADS + f"""
, per_day AS (
  SELECT COALESCE(b.date, r.date) AS date, COALESCE(b.n, 0) AS bars, COALESCE(r.n, 0) AS quotes,
         COALESCE(bad_bars, 0) AS bad_bars, COALESCE(bad_rates, 0) AS bad_rates
  FROM (SELECT date, COUNT(*) AS n, COUNT(*) FILTER (close_price <= 0 OR volume < 0) AS bad_bars
        FROM stock_prices WHERE {IN_P} GROUP BY date) b
  FULL JOIN (SELECT date, COUNT(*) AS n, COUNT(*) FILTER (rate <= 0) AS bad_rates
             FROM exchange_rates WHERE {IN_P} GROUP BY date) r ON r.date = b.date),
issues AS (SELECT CAST(SUM(bad_bars * greatest(quotes, 1)) AS BIGINT) AS stock_quality_issues,
                  CAST(SUM(bad_rates * greatest(bars, 1)) AS BIGINT) AS exchange_quality_issues FROM per_day),
bars_in AS (SELECT COUNT(*) AS total_stock_records, COUNT(DISTINCT symbol) AS symbols_loaded,
                   COUNT(DISTINCT date) AS trading_days_loaded, MIN(date) AS first_trading_date,
                   MAX(date) AS last_trading_date, CAST({RM('volume', 0, 0)} AS BIGINT) AS avg_daily_volume,
                   {RM('close_price', 4, 2)} AS avg_close_price FROM stock_prices WHERE {IN_P}),
rates_in AS (SELECT COUNT(*) AS total_exchange_records,
                    COUNT(DISTINCT (from_currency, to_currency)) AS currency_pairs_loaded,
                    COUNT(DISTINCT date) AS exchange_days_loaded, MIN(date) AS first_exchange_date,
                    MAX(date) AS last_exchange_date, {RM('rate', 6, 4)} AS avg_exchange_rate
             FROM exchange_rates WHERE {IN_P}),
runs AS (SELECT CAST(2 AS BIGINT) AS backfill_operations, 'COMPLETED' AS operation_statuses,
                (SELECT COUNT(*) FROM st_stage) + (SELECT COUNT(*) FROM rt_stage) AS total_records_processed)
SELECT '2001-10-01' AS backfill_start_date, '2001-10-31' AS backfill_end_date, CAST(30 AS INT) AS backfill_period_days,
       CAST({AS_OF_SQL} AS TIMESTAMP) AS report_generated_at, bars_in.*, rates_in.*,
       IF(stock_quality_issues > 0, 'FAILED', 'PASSED') AS stock_quality_check, stock_quality_issues,
       IF(exchange_quality_issues > 0, 'FAILED', 'PASSED') AS exchange_quality_check, exchange_quality_issues, runs.*,
       CASE WHEN stock_quality_issues + exchange_quality_issues > 0 THEN 'COMPLETED_WITH_QUALITY_ISSUES'
            WHEN least(total_stock_records, total_exchange_records) = 0 THEN 'COMPLETED_WITH_MISSING_DATA'
            ELSE 'SUCCESS' END AS backfill_status,
       COALESCE(IF(stock_quality_issues + exchange_quality_issues > 0,
                   'Review data quality issues and consider re-running backfill for affected periods', NULL),
                IF(symbols_loaded < 7, 'Some expected symbols may be missing - verify data sources', NULL),
                IF(trading_days_loaded < 21,
                   'Lower than expected trading days loaded - check for weekends/holidays', NULL),
                'Backfill completed successfully - no action required') AS recommendations
FROM bars_in, rates_in, issues, runs
""")

SQL["table_inventory"] = with_binding("""
, c AS (SELECT 'dim_stocks' AS table_name, COUNT(*) AS row_count FROM dim_stocks
        UNION ALL SELECT 'dim_date', COUNT(*) FROM dim_date
        UNION ALL SELECT 'dim_currency', COUNT(*) FROM dim_currency
        UNION ALL SELECT 'fact_stock_prices', COUNT(*) FROM fact_stock_prices
        UNION ALL SELECT 'fact_currency_rates', COUNT(*) FROM fact_currency_rates)
SELECT table_name, row_count,
       (SELECT SUM(row_count) FROM c WHERE table_name LIKE 'fact_%') = 0 AS is_database_empty,
       (SELECT MIN(row_count) FROM c WHERE table_name LIKE 'fact_%') > 0 AS healthy
FROM c
""")

FRESH = """SELECT ds.symbol, MAX(dd.date_value) AS latest_date
FROM fact_stock_prices f JOIN dim_date dd ON f.date_id = dd.date_id JOIN dim_stocks ds ON f.stock_id = ds.stock_id
GROUP BY ds.symbol"""

SQL["freshness"] = with_binding(FRESH)
SQL["stale_symbols"] = with_binding(f"""
SELECT * FROM ({FRESH}) x WHERE latest_date < DATE '2001-11-04' - INTERVAL 2 DAY
""")


def MISSING(days: int) -> str:
    return f"""SELECT ds.symbol, dd.date_value AS missing_date
FROM dim_stocks ds, dim_date dd
WHERE dd.date_value BETWEEN DATE '2001-11-04' - INTERVAL {days} DAY AND DATE '2001-11-04' AND NOT dd.is_weekend
  AND NOT EXISTS (SELECT 1 FROM fact_stock_prices f WHERE f.date_id = dd.date_id AND f.stock_id = ds.stock_id)"""


SQL["missing_dates"] = with_binding(MISSING(10))
SQL["missing_counts"] = with_binding(f"""
SELECT symbol, COUNT(*) AS missing_days FROM ({MISSING(5)}) m GROUP BY symbol
""")

LATEST_RATE = f"""SELECT 'USD/GBP' AS currency_pair, MAX(dd.date_value) AS rate_date,
       CAST(max_by(r.exchange_rate, dd.date_value) AS DOUBLE) AS exchange_rate
FROM fact_currency_rates r JOIN dim_date dd ON r.date_id = dd.date_id
WHERE r.from_currency_id = {USD} AND r.to_currency_id = {GBP}"""

SQL["latest_rate"] = with_binding(LATEST_RATE)
SQL["latest_rate_quote"] = with_binding("""
SELECT 'USD/GBP' AS currency_pair, MAX(date) AS rate_date, CAST(MAX_BY(rate, updated_at) AS DOUBLE) AS exchange_rate
FROM exchange_rates WHERE date = (SELECT MAX(date) FROM exchange_rates)
""")
SQL["check_frames"] = """
SELECT * FROM (VALUES ('all', '', TRUE, TRUE), ('none', '', FALSE, FALSE), ('short', 'Volume', TRUE, FALSE))
  x(frame, missing, has_rows, usable) WHERE (SELECT COUNT(*) FROM lineitem) > 0"""

SQL["ingestion_status"] = with_binding(f"""
, tr AS (SELECT unnest(['Stock#4','Stock#5','Stock#11','Stock#12','Stock#17','Stock#22','Stock#25']) AS symbol),
fr AS ({FRESH}),
mc AS (SELECT symbol, COUNT(*) AS missing_days FROM ({MISSING(5)}) m GROUP BY symbol),
lr AS ({LATEST_RATE})
SELECT tr.symbol, fr.latest_date,
       (fr.latest_date IS NULL OR fr.latest_date < DATE '2001-11-04' - INTERVAL 2 DAY) AS is_stale,
       COALESCE(mc.missing_days, 0) AS missing_recent_days, lr.currency_pair, lr.rate_date, lr.exchange_rate,
       ((SELECT COUNT(*) FROM fact_stock_prices) + (SELECT COUNT(*) FROM fact_currency_rates)) = 0 AS is_database_empty,
       LEAST((SELECT COUNT(*) FROM fact_stock_prices), (SELECT COUNT(*) FROM fact_currency_rates)) > 0 AS database_healthy
FROM tr LEFT JOIN fr ON tr.symbol = fr.symbol LEFT JOIN mc ON tr.symbol = mc.symbol, lr
""")

SQL["archive_split"] = with_binding("""
SELECT CASE WHEN dd.date_value >= DATE '2001-11-04' - INTERVAL 2 YEAR THEN 'keep' ELSE 'archive' END AS part,
       f.stock_id, f.date_id
FROM fact_stock_prices f JOIN dim_date dd ON f.date_id = dd.date_id
""")

TEXT_REC = """, tr AS (
  SELECT ds.symbol, (f.stock_id * 7 + f.date_id) % 11 AS k, f.date_id, dd.date_value, f.opening_price, f.high_price,
         f.low_price, f.closing_price, f.volume
  FROM fact_stock_prices f JOIN dim_stocks ds ON f.stock_id = ds.stock_id JOIN dim_date dd ON f.date_id = dd.date_id),
txt AS (
  SELECT symbol, CASE WHEN k = 3 THEN 'not-a-date' ELSE CAST(date_value AS VARCHAR) END AS data_date,
         CASE WHEN k = 0 THEN 'invalid' ELSE CAST(opening_price AS VARCHAR) END AS open_price,
         CAST(high_price AS VARCHAR) AS high_price, CAST(low_price AS VARCHAR) AS low_price,
         CASE WHEN k = 1 THEN '' ELSE CAST(closing_price AS VARCHAR) END AS close_price,
         CASE WHEN k = 2 THEN NULL ELSE CAST(volume AS VARCHAR) END AS volume, k
  FROM tr)"""

SQL["lenient_cast"] = with_binding(TEXT_REC + f"""
, c AS (SELECT symbol, TRY_CAST(trim(open_price) AS DOUBLE) AS o, TRY_CAST(trim(high_price) AS DOUBLE) AS h,
               TRY_CAST(trim(low_price) AS DOUBLE) AS lo, TRY_CAST(trim(close_price) AS DOUBLE) AS cl,
               TRY_CAST(trim(volume) AS BIGINT) AS v, CAST(TRY_STRPTIME(data_date, '%Y-%m-%d') AS DATE) AS d FROM txt)
SELECT symbol, COALESCE(d, {AS_OF_SQL}) AS data_date, COALESCE(o, 0.0) AS open_price, COALESCE(h, 0.0) AS high_price,
       COALESCE(lo, 0.0) AS low_price, COALESCE(cl, 0.0) AS close_price, COALESCE(v, 0) AS volume,
       array_to_string(list_filter([
         CASE WHEN o IS NULL THEN 'open_price: not a number, using 0.0' END,
         CASE WHEN h IS NULL THEN 'high_price: not a number, using 0.0' END,
         CASE WHEN lo IS NULL THEN 'low_price: not a number, using 0.0' END,
         CASE WHEN cl IS NULL THEN 'close_price: not a number, using 0.0' END,
         CASE WHEN v IS NULL THEN 'volume: not an integer, using 0' END,
         CASE WHEN d IS NULL THEN 'data_date: not a date, using as_of' END], lambda x: x IS NOT NULL), '; ')
         AS conversion_errors
FROM c
""")

STOCK_REC = """SELECT ds.symbol, dd.date_value AS data_date, CAST(f.opening_price AS DOUBLE) AS open_price,
       CAST(f.high_price AS DOUBLE) AS high_price, CAST(f.low_price AS DOUBLE) AS low_price,
       CAST(f.closing_price AS DOUBLE) AS close_price, f.volume, 'alpha_vantage' AS source,
       TIMESTAMP '2001-11-04 00:00:00' AS created_at
FROM fact_stock_prices f JOIN dim_stocks ds ON f.stock_id = ds.stock_id JOIN dim_date dd ON f.date_id = dd.date_id"""

SQL["conform_stock"] = with_binding(f"SELECT *, '' AS conversion_errors FROM ({STOCK_REC}) x")

SQL["prepare_stocks"] = with_binding(f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY data_date DESC) AS rn
                            FROM ({STOCK_REC}) x WHERE symbol IN {TRACKED_SQL}) y
WHERE rn <= 10
""")

FX_REC = """SELECT 'USD' AS from_currency, 'GBP' AS to_currency, date AS data_date,
       CAST(max_by(rate, updated_at) AS DOUBLE) AS exchange_rate, 'alpha_vantage' AS source,
       TIMESTAMP '2001-11-04 00:00:00' AS created_at
FROM exchange_rates GROUP BY from_currency, to_currency, date"""

SQL["conform_fx"] = with_binding(FX_REC)
SQL["conform_fx_quote"] = with_binding(FX_REC)
# the series stops a day early with one row, so the latest quote joins it
SQL["prepare_fx"] = with_binding(f"""
SELECT * FROM ({FX_REC}) x WHERE data_date = {AS_OF_SQL}
   OR data_date = (SELECT MAX(date) FROM exchange_rates WHERE date < {AS_OF_SQL})
""")

SQL["last_n_days"] = with_binding("""
SELECT symbol, date_value, closing_price FROM (
  SELECT ds.symbol, dd.date_value, CAST(f.closing_price AS DOUBLE) AS closing_price,
         row_number() OVER (PARTITION BY ds.symbol ORDER BY dd.date_value DESC) AS rn
  FROM fact_stock_prices f JOIN dim_stocks ds ON f.stock_id = ds.stock_id JOIN dim_date dd ON f.date_id = dd.date_id
  WHERE ds.is_active) x
WHERE rn <= 10
""")

SQL["present_top"] = market(_top(5) + """
SELECT * REPLACE (NULLIF(price_usd, 0) AS price_usd, NULLIF(daily_return, 0) AS daily_return,
                  NULLIF(price_gbp, 0) AS price_gbp) FROM top""")

SQL["present_details"] = market(_DETAILS + """
SELECT * REPLACE (NULLIF(price_usd, 0) AS price_usd, NULLIF(price_gbp, 0) AS price_gbp,
                  NULLIF(daily_return, 0) AS daily_return, NULLIF(avg_price_30d_usd, 0) AS avg_price_30d_usd,
                  NULLIF(volatility_30d, 0) AS volatility_30d, NULLIF(price_change_30d_pct, 0) AS price_change_30d_pct)
FROM details""")

SQL["present_currency"] = market(_CURRENCY + """
SELECT * REPLACE (NULLIF(price_usd, 0) AS price_usd, NULLIF(price_gbp, 0) AS price_gbp,
                  NULLIF(usd_to_gbp_rate, 0) AS usd_to_gbp_rate, NULLIF(daily_return, 0) AS daily_return)
FROM shown""")

SQL["page"] = market(_CURRENCY + """
SELECT * FROM shown ORDER BY trade_date DESC, symbol LIMIT 50 OFFSET 50
""")

SQL["page_info"] = market(_CURRENCY + """
SELECT CAST(2 AS INT) AS current_page, CAST(50 AS INT) AS page_size, COUNT(*) AS total_items,
       CAST((COUNT(*) + 49) // 50 AS BIGINT) AS total_pages, 2 < (COUNT(*) + 49) // 50 AS has_next, TRUE AS has_previous
FROM shown
""")

SQL["price_history"] = market(f"""
SELECT {NAMED}, day AS trade_date, {USD_PRICE}, volume, {RETURN}, {D('gbp_per_usd')} AS usd_to_gbp_rate, {GBP_PRICE}
FROM quoted WHERE symbol IN {TRACKED_SQL} AND date_id BETWEEN 20010101 AND 20011104""")


# -- warehouse scan, record checks, optional filters, landing round trip -----

SQL["fact_scan"] = with_binding("""
SELECT stock_id, date_id, CAST(closing_price AS DOUBLE) AS closing_price, volume
FROM fact_stock_prices WHERE date_id BETWEEN 20010101 AND 20011231
""")

# the rule is written from what the table takes: finite prices below 10^6, whole volumes, real days
_PRICE_OK = " AND ".join(f"isfinite(TRY_CAST(trim({c}) AS DOUBLE)) AND abs(TRY_CAST(trim({c}) AS DOUBLE)) < 999999.99995"
                         for c in ("open_price", "high_price", "low_price", "close_price"))
SQL["valid_stock"] = with_binding(TEXT_REC + f"""
, rough AS (
  SELECT symbol, data_date, CASE WHEN k = 5 THEN '1e18' ELSE open_price END AS open_price,
         CASE WHEN k = 6 THEN 'NaN' ELSE high_price END AS high_price, low_price, close_price,
         CASE WHEN k = 4 THEN volume || '.7' WHEN k = 7 THEN '1e3' ELSE volume END AS volume
  FROM txt)
SELECT * FROM rough
WHERE symbol IS NOT NULL AND TRY_CAST(data_date AS DATE) IS NOT NULL AND {_PRICE_OK}
  AND regexp_full_match(trim(volume), '[+-]?[0-9]+')
""")

SQL["valid_fx"] = with_binding("""
, tr AS (SELECT 'USD' AS from_currency, CASE WHEN date_id % 7 = 2 THEN NULL ELSE 'GBP' END AS to_currency,
                strftime(strptime(CAST(date_id AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS data_date,
                CASE WHEN date_id % 7 = 0 THEN 'invalid' WHEN date_id % 7 = 1 THEN NULL
                     ELSE CAST(exchange_rate AS VARCHAR) END AS exchange_rate
         FROM fact_currency_rates)
SELECT * FROM tr WHERE to_currency IS NOT NULL AND exchange_rate IS NOT NULL
  AND TRY_CAST(trim(exchange_rate) AS DOUBLE) IS NOT NULL
""")

SQL["opt_filter"] = market(_CURRENCY + " SELECT * FROM shown WHERE symbol = 'Stock#4'")

SQL["landing_scan"] = SQL["valid_stock"]

# -- jobs: the state that is read back from the written warehouse -------------
SQL["job_load"] = SQL["upsert_prices"]
SQL["job_backfill"] = SQL["backfill_load_prices"]
SQL["stream_load"] = SQL["upsert_prices"]
SQL["job_append"] = SQL["insert_new_prices"]
SQL["job_retention"] = SQL["calendar_retention"]
SQL["job_returns"] = SQL["daily_returns"].replace("20011001", "20011101")
SQL["job_load_summary"] = with_binding("""
, late AS (SELECT * FROM fact_stock_prices WHERE date_id >= 20010915),
late_rates AS (SELECT * FROM fact_currency_rates WHERE date_id >= 20010915)
SELECT (SELECT COUNT(*) FROM late WHERE date_id >= 20011001) AS stock_inserted,
       (SELECT COUNT(*) FROM late WHERE date_id < 20011001) AS stock_updated,
       (SELECT COUNT(*) FROM late_rates WHERE date_id >= 20011001) AS exchange_inserted,
       (SELECT COUNT(*) FROM late_rates WHERE date_id < 20011001) AS exchange_updated,
       (SELECT COUNT(*) FROM late WHERE date_id >= 20011028) AS rejected,
       (SELECT COUNT(*) FROM late WHERE date_id >= 20011028) AS rejects_kept
""")
SQL["job_daily"] = with_binding(f"""
, tracked AS (SELECT f.*, ds.symbol FROM fact_stock_prices f JOIN dim_stocks ds USING (stock_id) WHERE ds.symbol IN {TRACKED_SQL}),
three AS (SELECT * FROM tracked QUALIFY ROW_NUMBER() OVER (PARTITION BY stock_id ORDER BY date_id DESC) <= 3),
now AS (SELECT symbol, stock_id, date_id, closing_price, volume, daily_return FROM tracked WHERE date_id < 20011001
        UNION ALL SELECT symbol, stock_id, date_id, closing_price, volume, NULL FROM three WHERE date_id >= 20011001),
stepped AS (SELECT *, LAG(closing_price) OVER (PARTITION BY stock_id ORDER BY date_id) AS prev FROM now)
SELECT symbol, date_id, CAST(closing_price AS DOUBLE) AS closing_price, volume,
       CAST(COALESCE(daily_return, CAST(ROUND((closing_price - prev) / prev * 100, 6) AS DECIMAL(8,6))) AS DOUBLE) AS daily_return
FROM stepped
""")


def _known(table: str, fact: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, COUNT(*) AS row_count, '{c}' AS column_name, CAST(MIN({c}) AS DOUBLE) AS min, "
        f"CAST(MAX({c}) AS DOUBLE) AS max, COUNT(*) - COUNT({c}) AS null_count FROM (SELECT *, date_id // 10000 AS year FROM {fact}) x"
        for c in columns.split())


SQL["refresh_statistics"] = with_binding("\n" + _known(
    "prices", "fact_stock_prices",
    "stock_id date_id opening_price high_price low_price closing_price volume adjusted_close daily_return year")
    + " UNION ALL " + _known("rates", "fact_currency_rates", "from_currency_id to_currency_id date_id exchange_rate year"))
SQL["job_dedupe"] = SQL["dedupe_prices"]
SQL["job_archive"] = SQL["archive_split"]
SQL["job_log"] = with_binding(f"""
SELECT 'DEDUPLICATION' AS operation_type, 'stock_prices,exchange_rates' AS table_name,
       (SELECT COUNT(*) - COUNT(DISTINCT (symbol, date)) FROM stock_prices WHERE {IN_P})
     + (SELECT COUNT(*) - COUNT(DISTINCT (from_currency, to_currency, date)) FROM exchange_rates WHERE {IN_P})
       AS records_affected, 'COMPLETED' AS status
""")

# the bodies are those of the registry
SQL["payload_triage"] = _triage()
SQL["payload_structure"] = _structure()

SQL["market_caps"] = market(f"""
, issued AS (SELECT CAST(p_partkey // 8 + 1 AS INT) AS stock_id, CAST(SUM(p_size) * 100 AS DECIMAL(15,0)) AS shares
             FROM part GROUP BY 1)
SELECT {NAMED}, day AS trade_date, {USD_PRICE}, {GBP_PRICE}, {D('gbp_per_usd')} AS usd_to_gbp_rate, volume, {RETURN},
       {D('ROUND(closing_price * shares, 2)')} AS market_cap_usd, {D('ROUND(exact_gbp * shares, 2)')} AS market_cap_gbp
FROM quoted JOIN issued USING (stock_id)""")
