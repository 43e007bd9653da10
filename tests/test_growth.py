"""Tables of the input's size are dealt out once: plans that name no second shuffle."""

import datetime as dt
import re

from martstar import binding, registry
from martstar.operators import merge as MG
from martstar.session import build_session
from martstar.sources.catalog import Warehouse
from martstar.tables import buckets_for
from tests.conftest import SF_SMALL
from tests.helpers import make_tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(df) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(df))


def test_build_deals_trades_out_once(spark):
    own = build_session(spark, 5)
    t = binding.build(own, SF_SMALL, 5)
    for df in (t.prices.repartition(5, "stock_id"), t.stock_prices):
        got = _shuffles(df)
        assert len(got) == 2 and all(re.fullmatch(r"stock_id#\d+, 5", x) for x in got), got  # trades and parts
    assert "HashAggregate" not in _plan(t.prices)  # no map of bars beside the trades


def test_dealt_build_has_the_same_rows(spark):
    own = build_session(spark, 5)
    dealt, plain = binding.build(own, SF_SMALL, 5), binding.build(spark, SF_SMALL)
    for name in ("prices", "stock_prices"):
        a, b = ([tuple(r) for r in getattr(t, name).collect()] for t in (dealt, plain))
        assert a and sorted(map(str, a)) == sorted(map(str, b))


def test_payloads_group_where_the_bars_lie(spark):
    for key in ("payload_crypto", "payload_daily"):
        assert not _shuffles(registry.QUERIES[key](spark, SF_SMALL)), key


def test_upsert_leaves_the_target_where_it_is(spark):
    got = _shuffles(registry.QUERIES["upsert_prices"](spark, SF_SMALL))
    assert not [x for x in got if "date_id" in x], got


def test_a_copy_keeps_the_buckets(spark, tmp_path):
    t = registry.tables(spark, SF_SMALL)
    few = t.with_(prices=t.prices.where("date_id < 20010101"), stock_prices=None, exchange_rates=None)
    assert few.buckets == t.buckets
    src = Warehouse(spark, "growth_src", str(tmp_path / "src"))
    src.create(few, 11)
    own = src.open()
    dst = Warehouse(spark, "growth_dst", str(tmp_path / "dst"))
    dst.create(own.with_(prices=own.prices.where("date_id < 20000101")))
    assert dst.open().buckets == 11


def test_a_bucket_holds_no_more_rows_of_a_larger_table():
    small, large = (n / buckets_for(n) for n in (3_600_000, 36_000_000))  # sf0.1 x6 and x60
    assert large <= 1.1 * small  # what a task sorts must not grow until it spills
    assert buckets_for(216_000_000) == 200 and buckets_for(1_000_000_000) == 800 and buckets_for(0) == 8


def test_a_batch_sorts_its_own_days_of_the_target(spark):
    for key in ("upsert_prices", "insert_new_prices"):
        plan = _plan(registry.QUERIES[key](spark, SF_SMALL))
        for part in plan.split("Join [stock_id")[1:]:
            scans = part.count("FileScan parquet")
            assert not scans or "LeftSemi, BuildRight" in part.split("FileScan parquet")[0], (key, part[:800])


def test_a_batch_reads_its_own_days(spark):
    t = registry.tables(spark, SF_SMALL)
    for df in (registry._price_records(t), registry._stock_staging(t)):
        scans = [s for s in re.findall(r"FileScan parquet .*", _plan(df)) if ".prices[" in s]
        assert scans and all("GreaterThanOrEqual(date_id" in s for s in scans), scans


def test_upsert_of_late_and_new_days(spark):
    days = [dt.date(2025, 8, d) for d in (11, 12, 13)]
    t = make_tables(spark, [(s, d, 10, 11, 9, 10, 5, None) for s in ("AAA", "BBB") for d in days])
    names = ["symbol", "data_date", "open_price", "high_price", "low_price", "close_price", "volume"]
    cols = ", ".join(f"{c} string" for c in names)

    def run(rows):
        rec = spark.createDataFrame([(s, d, "1", "2", "0.5", "1.5", "7") for s, d in rows], cols)
        state, counts, _, _ = MG.upsert_prices(t, rec, dt.datetime(2025, 8, 15))
        new = MG.insert_new_prices(t, rec, dt.datetime(2025, 8, 15))
        assert state.columns == new.columns == t.prices.columns
        got = [{(r.stock_id, r.date_id): r.volume for r in df.collect()} for df in (state, new)]
        assert (state.count(), new.count()) == (len(got[0]), len(got[1]))
        return got, counts.first()

    old = {(s, 20250811 + i): 5 for s in (1, 2) for i in range(3)}
    (up, ins), c = run([("AAA", "2025-08-11"), ("BBB", "2025-08-13"), ("BBB", "2025-08-14"), ("AAA", "1999-01-04")])
    fresh = {(2, 20250814): 7, (1, 19990104): 7}
    assert up == {**old, (1, 20250811): 7, (2, 20250813): 7, **fresh} and ins == {**old, **fresh}
    assert (c.inserted, c.updated) == (2, 2)
    (up, ins), c = run([])
    assert up == ins == old and c.affected == 0
