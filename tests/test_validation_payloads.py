"""Validation rules and vendor payloads on the reference's documented cases."""

import datetime as dt
import json

import pytest

from martstar.operators import conform as CF
from martstar.operators import validate as V
from martstar.sources import payloads as PL

NOW = dt.datetime(2025, 9, 1)
BAR = "symbol string, timestamp timestamp, open double, high double, low double, close double, volume long"


def _errors(spark, o, h, lo, c, v, sym="AAPL"):
    df = spark.createDataFrame([(sym, dt.datetime(2025, 8, 1), o, h, lo, c, v)], BAR)
    return V.validate_bars(df, NOW).first().errors


def test_bar_cases(spark):
    assert _errors(spark, 61.5, 64.0, 60.25, 63.75, 70010) == []
    assert "High price (60.75) cannot be less than low price (61.5)" in _errors(spark, 61.5, 60.75, 61.5, 61.0, 1)
    assert "High price (64.25) cannot be less than close price (65.5)" in _errors(spark, 61.5, 64.25, 60.25, 65.5, 1)
    assert "Low price (60.25) cannot be greater than close price (58.5)" in _errors(spark, 61.5, 64.0, 60.25, 58.5, 1)
    assert "volume must be greater than or equal to 0" in _errors(spark, 61.5, 64.0, 60.25, 63.75, -3)
    assert "open must be greater than 0" in _errors(spark, -61.5, 64.0, 60.25, 63.75, 1)
    assert "Cannot have price movement with zero volume" in _errors(spark, 61.5, 64.0, 60.25, 63.75, 0)


def test_rate_cases(spark):
    day = dt.datetime(2024, 3, 1)
    df = spark.createDataFrame([("CHF", "SEK", -11.6, None, None, day, "alpha_vantage"),
                                ("SEK", "SEK", 1.0, 0.97, 1.02, day, "alpha_vantage"),
                                ("CHF", "SEK", 12.4, 11.5, 11.7, day, "alpha_vantage")],
                               "from_currency string, to_currency string, rate double, bid_rate double, "
                               "ask_rate double, timestamp timestamp, source string")
    errs = [r.errors for r in V.validate_rates(df, NOW).collect()]
    assert "rate must be greater than 0" in errs[0]
    assert "Cannot convert currency to itself" in errs[1]
    assert "Exchange rate must be between bid and ask rates" in errs[2]


def test_response_checks(spark):
    df = spark.createDataFrame([(-10.0, 1, None, None), (10.0, -1000, None, None)],
                               "price_usd double, volume long, price_gbp double, usd_to_gbp_rate double")
    errs = [r.errors for r in V.check_response(df).collect()]
    assert errs == [["price_usd must be positive"], ["volume must be non-negative"]]


def test_lenient_conversions(spark):
    df = spark.createDataFrame([("0.7865",), ("",), ("invalid",)], "x string")
    out = CF.lenient_cast(df, dt.date(2025, 8, 1), floats=["x"]).collect()
    assert [r.x for r in out] == [0.7865, 0.0, 0.0]
    assert [len(r.conversion_errors) for r in out] == [0, 1, 1]
    num = spark.createDataFrame([(0.7865,)], "x double")
    assert CF.lenient_cast(num, dt.date(2025, 8, 1), floats=["x"]).first().x == 0.7865


def test_fx_rate_column_priority(spark):
    both = spark.createDataFrame([(dt.date(2025, 8, 1), 0.7850, 0.7900)], "Date date, `1. open` double, `4. close` double")
    assert CF.fx_rate_column(both) == "4. close"
    only_open = spark.createDataFrame([(dt.date(2025, 8, 1), 0.7850)], "Date date, `1. open` double")
    assert CF.fx_rate_column(only_open) == "1. open"
    assert CF.conform_fx(only_open, dt.date(2025, 8, 2), NOW).first().exchange_rate == 0.785


def _bar(o, h, lo, c, v):
    """One day or tick under the vendor's key names."""
    return dict(zip(("1. open", "2. high", "3. low", "4. close", "5. volume"), (o, h, lo, c, v)))


DAILY = {"Meta Data": {"2. Symbol": "KLM"}, "Time Series (Daily)": {
    "2024-02-29": _bar("61.5", "64", "60.25", "63.75", "70010"),
    "2024-03-01": _bar("63.8", "63.9", "58", "59.05", "81234")}}
INTRADAY = {"Meta Data": {}, "Time Series (5min)": {"2024-03-01 09:35:00": _bar("63.8", "64.1", "63.7", "64", "512")}}
QUOTE = {"Realtime Currency Exchange Rate": {
    "1. From_Currency Code": "USD", "3. To_Currency Code": "GBP", "5. Exchange Rate": "0.5125",
    "6. Last Refreshed": "2024-03-03 23:59:59", "7. Time Zone": "UTC", "8. Bid Price": "0.512", "9. Ask Price": "0.513"}}


def test_payload_parsing(spark):
    p = spark.createDataFrame([("KLM", "5min", json.dumps(DAILY))], "symbol string, interval string, body string")
    rows = PL.flatten_daily(p).orderBy("Date").collect()
    assert [(r.Date, r.Close, r.Volume) for r in rows] == [
        (dt.date(2024, 2, 29), 63.75, 70010), (dt.date(2024, 3, 1), 59.05, 81234)]
    i = spark.createDataFrame([("KLM", "5min", json.dumps(INTRADAY))], "symbol string, interval string, body string")
    r = PL.flatten_intraday(i).first()
    assert (r.DateTime, r.Interval, r.Close) == (dt.datetime(2024, 3, 1, 9, 35), "5min", 64.0)
    quotes = PL.parse_quote(spark.createDataFrame([(json.dumps(QUOTE),)], "body string"))
    q = quotes.first()
    assert (q.exchange_rate, q.bid_price, q.ask_price, q.timezone) == (0.5125, 0.512, 0.513, "UTC")
    assert CF.conform_quote(quotes, dt.date(2025, 9, 1), NOW).first().data_date == dt.date(2024, 3, 3)


@pytest.mark.parametrize("body,status", [
    ({"Error Message": "Invalid API call"}, "auth"),
    ({"error": "Something failed"}, "error"),
    ({"Note": "Thank you for using the API! 5 calls per minute"}, "rate_limited"),
    ({"Information": "You reached 25 requests per day. Thank you for using the API"}, "daily_limit"),
    ({"Note": "Just a note"}, "ok"),
    ({}, "empty"),
    (DAILY, "ok"),
])
def test_triage(spark, body, status):
    df = spark.createDataFrame([(json.dumps(body),)], "body string")
    assert PL.triage(df).first().status == status


def test_structure_and_names(spark):
    bad = {"Time Series (Daily)": {"2025-08-08": {}}}
    df = spark.createDataFrame([(json.dumps(DAILY),), (json.dumps(bad),), ("{}",)], "body string")
    errs = [r.errors for r in PL.check_structure(df, PL.DAILY_KEY).collect()]
    assert errs[0] == [] and errs[1] == ["Values for every date must be a non-empty dictionary"]
    assert errs[2] == ["Expected key 'Time Series (Daily)' not found in response"]
    raw = spark.createDataFrame([(1.0, 2.0, "2025-08-08")], "`1. open` double, `4. close` double, date string")
    assert PL.standardize_columns(raw).columns == ["Open", "Close", "Date"]
    assert CF.require_columns(raw, ["Open", "Volume"]) == ["Open", "Volume"]


def test_symbol_parameters():
    from martstar.operators.presentation import normalize_symbols
    assert normalize_symbols([" aapl", "MSFT", "aapl", "brk.b"]) == ["AAPL", "MSFT", "BRK.B"]
    with pytest.raises(ValueError):
        normalize_symbols(["brand#4"])
    assert normalize_symbols(["brand#4"], extra_chars=".-#") == ["BRAND#4"]
    with pytest.raises(ValueError):
        normalize_symbols([])
