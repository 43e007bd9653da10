"""Bad values go to the rejects and never end a job; writes leave a whole state."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from martstar import registry
from martstar.functions.numeric import mean_half_up
from martstar.operators import conform as CF
from martstar.operators import merge as MG
from martstar.operators import validate as V
from martstar.plans import jobs
from martstar.sources import landing as L
from martstar.streaming.landing_stream import stream_landing
from martstar.plans import loads
from martstar.sources.catalog import Warehouse
from martstar.tables import read_warehouse, write_warehouse
from tests.helpers import make_tables

DAY, NEXT = dt.date(2025, 3, 4), dt.date(2025, 3, 5)
TS = dt.datetime(2025, 3, 6)


def rec(symbol="KLM", day="2025-03-04", price=10.5, volume=300, **more):
    return {"symbol": symbol, "data_date": day, "open_price": price, "high_price": 12, "low_price": 9,
            "close_price": 11, "volume": volume, **more}


def put(root, name, records, kind="stocks"):
    os.makedirs(f"{root}/{kind}", exist_ok=True)
    with open(f"{root}/{kind}/{name}", "w") as f:
        json.dump(records, f)


def two_stocks(spark):
    return make_tables(spark, [("KLM", DAY, 1, 1, 1, 1, 1, None)], stocks=["KLM", "NOP"])


def test_default_reader_keeps_every_record_of_a_run(spark, tmpdir_path):
    rows = spark.createDataFrame([rec(volume=i) for i in range(10)])
    L.write_landing(rows.coalesce(1), tmpdir_path, "stocks", TS)
    put(tmpdir_path, "collector.json", [rec(volume=77), rec(volume=78)])
    back = L.read_landing(spark, f"{tmpdir_path}/stocks", "stocks")
    assert sorted(int(r.volume) for r in back.collect()) == [*range(10), 77, 78]


def test_volume_text_with_a_fraction_is_rejected(spark, tmpdir_path):
    put(tmpdir_path, "a.json", [rec("A", volume="12.7"), rec("B", volume=12.7), rec("C", volume="12"),
                                rec("D", volume=None), rec("E", volume=True)])
    valid, bad = L.split_valid(L.read_landing(spark, f"{tmpdir_path}/stocks", "stocks"), "stocks")
    assert {r.symbol for r in valid.collect()} == {"B", "C"}
    assert {r.symbol: r.errors for r in bad.collect()}["D"] == ["missing volume"]


def test_one_bad_record_does_not_end_the_load(spark, tmpdir_path):
    put(tmpdir_path, "a.json", [rec(), rec(day="not-a-date"), rec("NOP", price="1e18"), rec("NOP", price="NaN"),
                                rec("XYZ")])
    put(tmpdir_path, "r.json", [{"from_currency": "USD", "to_currency": "GBP", "data_date": "2025-13-01",
                                 "exchange_rate": 0.8}], "exchange")
    new, summary, rejects = jobs.load_landing(spark, tmpdir_path, two_stocks(spark), TS)
    s = summary.first()
    assert (s.stock_inserted, s.stock_updated, s.rejected) == (0, 1, 5)
    kept = {json.loads(r.record).get("symbol") or "rate": r.reason for r in rejects.collect()}
    assert set(kept) == {"KLM", "NOP", "XYZ", "rate"} and "unknown key" in kept["XYZ"]
    assert new.prices.count() == 1 and new.rates.count() == 0


def test_conform_rejects_what_the_table_cannot_hold(spark):
    rows = spark.createDataFrame([("KLM", "2025-03-04", 1e18, 1.0), ("KLM", "2025-03-05", 2.0, float("nan")),
                                  ("KLM", "2025-03-06", 2.0, 5.0)],
                                 "symbol string, data_date string, open_price double, volume double")
    rows = rows.select("*", *[F.col("open_price").alias(c) for c in ("high_price", "low_price", "close_price")])
    good, bad = MG.conform_price_batch(two_stocks(spark), rows, TS)
    assert [r.date_id for r in good.collect()] == [20250306] and bad.count() == 2


def test_validators_report_extreme_values(spark):
    bars = spark.createDataFrame(
        [("KLM", TS, 1e18, 2.0, 1.0, 1.5, 5), ("KLM", TS, float("nan"), 2.0, 1.0, 1.5, 5), ("KLM", TS, 1.125, 2.0, 1.0, 1.5, 5),
         ("KLM", TS, 1.5, 2.0, 1.0, 1.5, 5), ("k/m", TS, 1.5, 2.0, 1.0, 1.5, 5)],
        "symbol string, timestamp timestamp, open double, high double, low double, close double, volume long")
    e = [r.errors for r in V.validate_bars(bars, TS).collect()]
    assert "Price cannot exceed $100,000" in e[0] and "Price cannot exceed $100,000" in e[1]
    assert e[2] == ["open must have at most 2 decimal places"]
    assert e[3] == [] and e[4] == ["symbol must match ^[A-Z0-9.-]+$"]
    rates = spark.createDataFrame([("USD", "GBP", 1e18, TS)], "from_currency string, to_currency string, rate double, timestamp timestamp")
    assert "Exchange rate too large (maximum 1,000,000)" in V.validate_rates(rates, TS).first().errors


def test_sums_of_many_wide_values(spark):
    df = spark.range(2000).select(F.lit("560000.0000000000").cast("decimal(20,10)").alias("x"))
    assert df.agg(mean_half_up(F.col("x"), 10, 4).alias("m")).first().m == 560000.0


def test_full_rewrite_leaves_no_old_year(spark, tmpdir_path):
    t = make_tables(spark, [("KLM", DAY, 1, 1, 1, 1, 1, None), ("KLM", dt.date(2023, 1, 2), 1, 1, 1, 1, 1, None)])
    write_warehouse(t, tmpdir_path)
    write_warehouse(t.with_(prices=t.prices.where("date_id > 20240000")), tmpdir_path)
    assert read_warehouse(spark, tmpdir_path).prices.count() == 1


def test_stream_adds_days_and_keeps_rejects(spark, tmpdir_path):
    w = Warehouse(spark, "rejects_stream", f"{tmpdir_path}/wh")
    w.create(two_stocks(spark))
    put(f"{tmpdir_path}/in", "a.json", [rec(day="2025-03-05"), rec("NOP", day="2025-03-05"), rec("XYZ"), rec(day="x")])
    stream_landing(spark, f"{tmpdir_path}/in", w, f"{tmpdir_path}/ckpt", as_of_ts=TS).awaitTermination(120)
    t = w.open()
    assert t.prices.where("date_id = 20250305").count() == 2
    assert t.dim_date.where("date_id = 20250305").count() == 1
    rejects = [json.loads(r.record)["symbol"] for r in spark.read.json(f"{w.root}/rejects/v=2").collect()]
    assert sorted(rejects) == ["KLM", "XYZ"]


def test_fx_fallback_takes_the_latest_quote(spark):
    series = spark.createDataFrame([("USD", "GBP", DAY, 0.8, "s", TS)],
                                   "from_currency string, to_currency string, data_date date, exchange_rate double, source string, created_at timestamp")
    quotes = spark.createDataFrame([("USD", "GBP", d, x, "s", TS) for d, x in ((NEXT, 0.81), (dt.date(2025, 3, 9), 0.83))], series.schema)
    assert sorted(r.exchange_rate for r in CF.prepare_fx(series, quotes).collect()) == [0.8, 0.83]


def test_other_pairs_keep_their_codes(spark):
    raw = spark.createDataFrame([("EUR", "JPY", "2025-03-04", 160.0)], "FromCurrency string, ToCurrency string, Date string, Close double")
    r = CF.conform_fx(raw, DAY, TS).first()
    assert (r.from_currency, r.to_currency) == ("EUR", "JPY")


def test_load_keeps_rejects_and_publishes_a_version(spark, tmpdir_path):
    w = Warehouse(spark, "rejects_load", f"{tmpdir_path}/w")
    w.create(two_stocks(spark))
    put(f"{tmpdir_path}/in", "a.json", [rec(day="2025-03-05"), rec(day="bad"), rec("XYZ")])
    put(f"{tmpdir_path}/in", "r.json", [{"from_currency": "USD", "to_currency": c, "data_date": "2025-03-05",
                                         "exchange_rate": 0.8} for c in ("GBP", "ZZZ")], "exchange")
    with w.change() as c:
        s = loads.load_landing(c, f"{tmpdir_path}/in", TS)
    assert s == {"rejected": 3, "days_added": 1, "stock_inserted": 1, "stock_updated": 0, "exchange_inserted": 1, "exchange_updated": 0}
    assert w.version() == 2 and w.open().prices.count() == 2 and w.open().dim_date.count() == 2
    kept = spark.read.json(f"{w.root}/rejects/v=2").collect()
    assert sorted(r.kind for r in kept) == ["exchange", "stocks", "stocks"] and all(r.reason for r in kept)


def test_changed_input_has_another_signature(spark, tmpdir_path):
    for name in ("lineitem", "part", "orders"):
        spark.range(3).coalesce(1).write.parquet(f"{tmpdir_path}/{name}.parquet")
    first = registry._input_signature(spark, tmpdir_path)
    assert first == registry._input_signature(spark, tmpdir_path)
    time.sleep(1.1)
    spark.range(4).coalesce(1).write.mode("overwrite").parquet(f"{tmpdir_path}/part.parquet")
    assert first != registry._input_signature(spark, tmpdir_path)
