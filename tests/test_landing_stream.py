"""Landing files, keyed table writes and the streaming load (file-system behaviour)."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from martstar.plans import jobs
from martstar.sources import landing as L
from martstar.sources.catalog import Warehouse
from martstar.streaming.landing_stream import stream_landing
from tests.helpers import make_tables

D1, D2 = dt.date(2025, 8, 16), dt.date(2025, 8, 17)
TS = dt.datetime(2025, 8, 18)


def _stock(sym, day, close, volume=45000000):
    return {"symbol": sym, "data_date": day, "open_price": 220.5, "high_price": 231.0, "low_price": 219.25,
            "close_price": close, "volume": volume, "source": "alpha_vantage", "created_at": "2025-08-17T10:00:00Z"}


def _write_landing(root):
    os.makedirs(f"{root}/stocks", exist_ok=True)
    os.makedirs(f"{root}/exchange", exist_ok=True)
    with open(f"{root}/stocks/stocks_1.json", "w") as f:
        json.dump([_stock("AAPL", "2025-08-16", 229.35), _stock("MSFT", "2025-08-17", 360.25),
                   {"symbol": "AAPL", "data_date": "2025-08-17", "open_price": 1}], f)  # missing fields
    with open(f"{root}/stocks/stocks_2.json", "w") as f:
        json.dump(_stock("AAPL", "2025-08-16", 230.00), f)  # one object; later file wins
    with open(f"{root}/stocks/broken.json", "w") as f:
        f.write("{not json")
    with open(f"{root}/exchange/exchange_1.json", "w") as f:
        json.dump([{"from_currency": "USD", "to_currency": "GBP", "data_date": "2025-08-17", "exchange_rate": 0.785},
                   {"from_currency": "USD", "to_currency": "GBP", "data_date": "2025-08-16",
                    "exchange_rate": "invalid"}], f)


def test_read_and_split_landing(spark, tmpdir_path):
    _write_landing(tmpdir_path)
    raw = L.read_landing(spark, f"{tmpdir_path}/stocks", "stocks")
    valid, rejects = L.split_valid(raw, "stocks")
    assert valid.count() == 3
    reasons = [r.errors for r in rejects.collect()]
    assert any("unreadable record" in e for e in reasons)
    assert any("missing volume" in e for e in reasons)
    fx_valid, fx_rej = L.split_valid(L.read_landing(spark, f"{tmpdir_path}/exchange", "exchange"), "exchange")
    assert fx_valid.count() == 1 and fx_rej.count() == 1


def test_write_landing_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([_stock("AAPL", "2025-08-16", 229.35), _stock("MSFT", "2025-08-16", 360.25)])
    out = L.write_landing(df.coalesce(1), tmpdir_path, "stocks", dt.datetime(2025, 8, 17, 10))
    assert out.endswith("run_ts=20250817T100000Z")
    back = L.read_landing(spark, f"{tmpdir_path}/stocks", "stocks")
    assert sorted(r.close_price for r in back.collect()) == ["229.35", "360.25"]


def test_load_landing_is_idempotent(spark, tmpdir_path):
    _write_landing(tmpdir_path)
    t = make_tables(spark, [("AAPL", D1, 1, 1, 1, 1, 1, None)], stocks=["AAPL", "MSFT"])
    new, summary, rejects = jobs.load_landing(spark, tmpdir_path, t, TS)
    s = summary.first()
    assert (s.stock_inserted, s.stock_updated, s.exchange_inserted) == (1, 1, 1)
    closes = {(r.stock_id, r.date_id): float(r.closing_price) for r in new.prices.collect()}
    assert closes[(1, 20250816)] == 230.0  # the later file wins
    again, summary2, _ = jobs.load_landing(spark, tmpdir_path, new, TS)
    assert sorted(map(tuple, again.prices.collect())) == sorted(map(tuple, new.prices.collect()))
    assert summary2.first().stock_inserted == 0
    assert new.dim_date.where(F.col("date_id") == 20250817).count() == 1


def test_stream_landing_upserts_new_files(spark, tmpdir_path):
    land = f"{tmpdir_path}/landing"
    _write_landing(land)
    w = Warehouse(spark, "stream_files", f"{tmpdir_path}/wh")
    w.create(make_tables(spark, [("AAPL", D1, 1, 1, 1, 1, 1, None)], stocks=["AAPL", "MSFT"]))
    stream_landing(spark, land, w, f"{tmpdir_path}/ckpt", once=True, as_of_ts=TS).awaitTermination(120)
    prices = w.open().prices
    assert prices.count() == 2 and {r.stock_id for r in prices.collect()} == {1, 2}
    assert w.applied("stocks") == 0 and w.applied("exchange") == -1
    # nothing new: no batch, no version
    n = w.version()
    stream_landing(spark, land, w, f"{tmpdir_path}/ckpt", once=True, as_of_ts=TS).awaitTermination(120)
    assert w.version() == n


def test_a_replayed_batch_changes_nothing(spark, tmpdir_path):
    """The stream's own log is lost after the publish, so the batch comes again."""
    land = f"{tmpdir_path}/landing"
    _write_landing(land)
    w = Warehouse(spark, "stream_replay", f"{tmpdir_path}/wh")
    w.create(make_tables(spark, [("AAPL", D1, 1, 1, 1, 1, 1, None)], stocks=["AAPL", "MSFT"]))
    for checkpoint in ("ckpt", "other"):
        stream_landing(spark, land, w, f"{tmpdir_path}/{checkpoint}", once=True, as_of_ts=TS).awaitTermination(120)
        assert (w.version(), w.open().prices.count()) == (2, 2)
    stream_landing(spark, land, w, f"{tmpdir_path}/fx", "exchange", as_of_ts=TS).awaitTermination(120)
    assert w.version() == 3 and w.applied("stocks") == 0 == w.applied("exchange") and w.open().rates.count() == 1
