"""Ingestion jobs: initial setup, daily update and the full-run branch."""

import datetime as dt
import json

from pyspark.sql import functions as F

from martstar import schemas as S
from martstar.operators import dims as DM
from martstar.plans import jobs, loads
from martstar.sources.catalog import Warehouse
from martstar.sources import payloads as PL
from martstar.tables import empty_tables

AS_OF, TS = dt.date(2025, 8, 9), dt.datetime(2025, 8, 9, 18)


def _daily(symbol, closes):
    series = {f"2025-08-{d:02d}": {"1. open": str(c - 1), "2. high": str(c + 1), "3. low": str(c - 2),
                                   "4. close": str(c), "5. volume": "1000"} for d, c in closes}
    return (symbol, json.dumps({"Meta Data": {}, PL.DAILY_KEY: series}))


def _fx(days):
    series = {f"2025-08-{d:02d}": {"1. open": str(r), "2. high": str(r), "3. low": str(r), "4. close": str(r)}
              for d, r in days}
    return ("USD", "GBP", json.dumps({PL.FX_DAILY_KEY: series}))


def test_run_full_takes_initial_then_daily(spark):
    t = empty_tables(spark)
    t = DM.seed_dims(spark, t)
    stocks = spark.createDataFrame([_daily("AAPL", [(4, 100), (5, 101), (6, 102), (7, 103), (8, 104)]),
                                    _daily("MSFT", [(7, 300), (8, 303)])], "symbol string, body string")
    fx = spark.createDataFrame([_fx([(8, 0.785)])], "from_currency string, to_currency string, body string")
    quote = spark.createDataFrame([(json.dumps({PL.QUOTE_KEY: {"5. Exchange Rate": "0.79",
                                                              "6. Last Refreshed": "2025-08-09 10:00:00"}}),)],
                                  "body string")
    tracked = ["AAPL", "MSFT", "NVDA"]
    t1, summary, _ = jobs.run_full(t, stocks, fx, quote, tracked, AS_OF, TS)
    s = summary.first()
    assert (s.run, s.stock_records, s.companies_updated, s.success) == ("initial", 7, 2, True)
    assert s.fx_records == 2  # one series row < 2 rows, so the quote of another day is added
    aapl = t1.dim_stocks.where(F.col("symbol") == "AAPL").first().stock_id
    rets = {r.date_id: r.daily_return for r in t1.prices.where(F.col("stock_id") == aapl).collect()}
    assert rets[20250804] is None and float(rets[20250805]) == 1.0
    # facts are now present: the daily branch keeps the last 3 rows per symbol
    t1 = t1.with_(prices=spark.createDataFrame(t1.prices.collect(), S.FACT_STOCK_PRICES),
                  rates=spark.createDataFrame(t1.rates.collect(), S.FACT_CURRENCY_RATES),
                  dim_date=spark.createDataFrame(t1.dim_date.collect(), t1.dim_date.schema))
    t2, summary2, rejects = jobs.run_full(t1, stocks, fx, None, tracked, AS_OF, TS)
    s2 = summary2.first()
    assert (s2.run, s2.stock_records) == ("daily", 5)
    assert t2.prices.count() == 7 and rejects.count() == 0


def test_runs_on_a_warehouse_match_the_plans(spark, tmpdir_path):
    """The run that writes touched partitions gives the rows of the run that is a plan."""
    stocks = spark.createDataFrame([_daily("AAPL", [(4, 100), (5, 101), (6, 102), (7, 103), (8, 104)]), _daily("ZZZZ", [(8, 1)]),
                                    _daily("MSFT", [(7, 300), (8, 303)])], "symbol string, body string")
    fx = spark.createDataFrame([_fx([(7, 0.78), (8, 0.785)])], "from_currency string, to_currency string, body string")
    tracked = ["AAPL", "MSFT", "NVDA", "ZZZZ"]
    t = DM.seed_dims(spark, empty_tables(spark))
    w = Warehouse(spark, "jobs_runs", f"{tmpdir_path}/w")
    w.create(t)
    for kind in ("initial", "daily"):
        with w.change() as c:
            got = loads.ingest(c, stocks, fx, None, tracked, AS_OF, TS)
        t, summary, rejects = jobs.run_full(t, stocks, fx, None, tracked, AS_OF, TS)
        s = summary.first()
        assert (got["run"], got["stock_inserted"] + got["stock_updated"]) == (s.run, s.stock_records) and s.run == kind
        assert got["rejected"] == rejects.count() == spark.read.json(f"{w.root}/rejects/v={w.version()}").count() == 1
        now = w.open()
        for name in ("prices", "rates"):
            a, b = getattr(now, name), getattr(t, name)
            assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
        t = t.with_(**{n: spark.createDataFrame(getattr(t, n).collect(), getattr(t, n).schema) for n in ("prices", "rates", "dim_date")})
