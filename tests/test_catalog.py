"""The catalog warehouse: touched partitions, versions, plans, returns across years."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martstar.operators import analytics as A
from martstar.operators import merge as MG
from martstar.operators import returns as R
from martstar.operators import status as ST
from martstar.plans import loads
from martstar.sources.catalog import Warehouse, refresh_statistics
from tests.helpers import make_tables

TS = dt.datetime(2025, 3, 6)


def bars(n_stocks=6, days=("2022-12-29", "2022-12-30", "2023-01-03", "2023-06-01", "2024-01-02", "2024-12-31"), seed=1):
    r = random.Random(seed)
    out = []
    for s in range(n_stocks):
        for d in days:
            if r.random() < 0.8:
                out.append((f"S{s}", dt.date.fromisoformat(d), 10, 12, 9, r.randint(900, 1100) / 100, 100 + s, None))
    return out


def warehouse(spark, path, rows=None, name="catalog_test"):
    w = Warehouse(spark, f"{name}_{os.path.basename(path)}".replace("-", "_").lower(), path)
    t = make_tables(spark, rows or bars(), rates=[(dt.date(2022, 12, 29), 0.8), (dt.date(2024, 1, 2), 0.81)],
                    stocks=[f"S{s}" for s in range(6)])
    w.create(t)
    return w, t


def records(spark, rows):
    return spark.createDataFrame([(s, str(d), 10.0, 12.0, 9.0, float(c), 7) for s, d, c in rows],
                                 "symbol string, data_date string, open_price double, high_price double, low_price double, close_price double, volume long")


def load(w, spark, rows):
    with w.change() as c:
        batch, _ = MG.conform_price_batch(c.tables, records(spark, rows), TS)
        got = loads.load_prices(c, MG.staged(batch), TS)
    return c, got


def state(t):
    return {(r.stock_id, r.date_id): r.daily_return for r in t.prices.collect()}


def full(t):
    """Returns of all rows against the whole history."""
    w = Window.partitionBy("stock_id").orderBy("date_id")
    out = t.prices.withColumn("x", R.return_pct(F.col("closing_price"), F.lag("closing_price").over(w)))
    return {(r.stock_id, r.date_id): r.x for r in out.collect()}


def test_tables_come_back(spark, tmpdir_path):
    w, t = warehouse(spark, tmpdir_path)
    now = w.open()
    for name in ("prices", "rates", "dim_date", "dim_stocks", "dim_currency"):
        a, b = getattr(now, name), getattr(t, name)
        assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect())), name
    assert now.last_year == 2024 and now.prices_where(low=20240000).count() == t.prices.where("date_id > 20240000").count()


def test_a_load_writes_the_years_it_touches(spark, tmpdir_path):
    w, t = warehouse(spark, tmpdir_path)
    before = w.folders(1, "prices")
    old_reader = w.open().prices
    n = old_reader.count()
    c, got = load(w, spark, [("S1", "2024-01-03", 11.0), ("S2", "2024-12-31", 12.0)])
    after = w.folders(2, "prices")
    assert {y for y in after if after[y] != before.get(y)} == {"2024"}
    assert {name for name, _ in c.written} == {"prices", "year_ends"}
    held = t.prices.where("date_id = 20241231 and stock_id = 3").count()
    assert got == {"inserted": 2 - held, "updated": held}
    # who opened the version before keeps it
    assert old_reader.count() == n and w.open().prices.count() == n + 2 - held
    # nothing of the other tables was written
    assert w.folders(1, "rates") == w.folders(2, "rates")


@pytest.mark.parametrize("seed", range(3))
def test_returns_equal_the_window_over_the_history(spark, tmpdir_path, seed):
    """Loads in date order, late ones, and ones that become a stock's first row."""
    rows = [x for x in bars(seed=seed) if x[0] != "S5"]
    w, _ = warehouse(spark, tmpdir_path, rows)
    with w.change() as c:
        c.put_partitions("prices", R.fill_returns(c.tables.prices, c.spark.createDataFrame([], "stock_id int, date_id int, closing_price decimal(10,4)"),
                                                  TS), [2022, 2023, 2024])
    assert state(w.open()) == full(w.open())
    r = random.Random(seed)
    for days in (["2025-01-02"], ["2025-01-03", "2026-02-02"], ["2024-12-30", "2025-01-02"]):
        have = state(w.open())
        new = [(f"S{s}", d, r.randint(900, 1100) / 100) for s in range(6) for d in days if r.random() < 0.9]
        load(w, spark, new)
        got, want = state(w.open()), full(w.open())
        # rows that had a return keep it; all that had none now have the right one
        assert got == {k: (have[k] if have.get(k) is not None else v) for k, v in want.items()}
    # a row before all others: the one that was first gets its return, years later
    load(w, spark, [("S0", "2021-05-05", 10.0), ("S4", "2021-05-05", 10.0)])
    firsts = [k for k, v in state(w.open()).items() if v is None]
    assert len(firsts) == len({s for s, _ in firsts}) and sum(d == 20210505 for _, d in firsts) == 2


def test_a_daily_load_reads_its_year_and_the_year_ends(spark, tmpdir_path):
    w, _ = warehouse(spark, tmpdir_path)
    plans = []
    write = type(w.change())._write

    def seen(self, name, df):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString(), df.inputFiles()))
        return write(self, name, df)

    try:
        type(w.change())._write = seen
        load(w, spark, [("S1", "2024-02-02", 11.0)])
    finally:
        type(w.change())._write = write
    files = next(f for name, _, f in plans if name == "prices")
    prices = [f for f in files if "/prices/" in f]
    assert prices and all("year=2024" in f for f in prices)


def test_a_lost_job_leaves_the_version(spark, tmpdir_path):
    w, _ = warehouse(spark, tmpdir_path)
    with pytest.raises(ValueError):
        with w.change() as c:
            c.drop_partitions("prices", [2022])
            raise ValueError
    assert w.version() == 1 and len(w.folders(1, "prices")) == 3
    load(w, spark, [("S1", "2024-02-02", 11.0)])  # the number is free again
    assert w.version() == 2


def test_two_writers_cannot_both_publish(spark, tmpdir_path):
    w, _ = warehouse(spark, tmpdir_path)
    with w.change() as c:
        with pytest.raises(Exception, match="ALREADY_EXISTS"):
            with w.change():
                pass
        c.drop_partitions("prices", [2022])
    assert w.version() == 2 and set(w.folders(2, "prices")) == {"2023", "2024"} == set(w.folders(2, "year_ends"))
    with pytest.raises(ValueError, match="2024"):
        with w.change() as c:
            c.put_partitions("prices", c.tables.prices, [2023])


def test_appends_write_one_file(spark, tmpdir_path):
    w, _ = warehouse(spark, tmpdir_path)
    for i in range(2):
        with w.change() as c:
            loads.log(c, MG.etl_log(spark, "X", "t", TS, i, "COMPLETED", "d"))
        assert [name for name, _ in c.written] == ["etl_logs"]
    assert sorted(r.records_affected for r in w.open().etl_logs.collect()) == [0, 1]


def test_archive_rewrites_the_year_of_the_cut_only(spark, tmpdir_path):
    w, t = warehouse(spark, tmpdir_path)
    with w.change() as c:
        n = loads.archive(c, f"{tmpdir_path}/old", dt.date(2025, 3, 1), years=2)
    old, now = spark.read.parquet(f"{tmpdir_path}/old"), w.open().prices
    assert n == old.count() == t.prices.where("date_id < 20230301").count()
    assert now.count() == t.prices.count() - n and now.where("date_id < 20230301").count() == 0
    assert w.folders(1, "prices")["2024"] == w.folders(2, "prices")["2024"] and "2022" not in w.folders(2, "prices")


def test_dedupe_and_retention(spark, tmpdir_path):
    rows = [("A", dt.date(2024, 1, 2), i) for i in range(5)] + [("A", dt.date(2023, 1, 2), i) for i in range(3)]
    sp = spark.createDataFrame(rows, "symbol string, date date, v int").select(
        "symbol", "date", *[F.lit(1).cast("decimal(10,4)").alias(c) for c in ("open_price", "high_price", "low_price", "close_price")],
        F.col("v").cast("long").alias("volume"), F.lit(1).cast("decimal(10,4)").alias("adjusted_close"),
        F.timestamp_micros(F.col("v").cast("long")).alias("created_at"), F.timestamp_micros(F.col("v").cast("long")).alias("updated_at"))
    _, t = warehouse(spark, f"{tmpdir_path}/a")
    w = Warehouse(spark, "dedupe_test_" + os.path.basename(tmpdir_path).replace("-", "_").lower(), f"{tmpdir_path}/b")
    w.create(t.with_(stock_prices=sp, prices=t.prices))
    with w.change() as c:
        assert loads.dedupe(c, dt.date(2024, 1, 1), dt.date(2024, 2, 1), TS) == 4
    assert w.folders(1, "stock_prices")["2023"] == w.folders(2, "stock_prices")["2023"]
    assert [r.volume for r in w.open().stock_prices.where("date > '2024-01-01'").collect()] == [4]
    assert w.open().etl_logs.first().records_affected == 4
    with w.change() as c:
        n = loads.retention(c, dt.date(2025, 3, 1), years=1)
    assert n == w.open().dim_date.count()
    with w.change() as c:
        assert loads.append_absent(c, w.open().prices.limit(3)) == 0


def test_windows_per_stock_need_no_shuffle(spark, tmpdir_path):
    w, _ = warehouse(spark, tmpdir_path)
    t = w.open()
    for df in (R.moving_metrics(t), R.daily_returns(t, "all", TS)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        above = plan[:plan.index("FileScan parquet")]
        assert "Window" in above and "Exchange hashpartitioning" not in above, plan
    one = t.prices_by_year.where("stock_id = 3").select("closing_price").groupBy().sum()
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = t.prices_by_year.where("stock_id = 3")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in plan and one.count() == 1


def test_statistics_reach_the_optimizer(spark, tmpdir_path):
    w, t = warehouse(spark, tmpdir_path)
    rows = {(r.table_name, r.column_name): r for r in refresh_statistics(spark, w.database(1)).collect()}
    assert rows["prices", "stock_id"].row_count == t.prices.count()
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        stats = w.open().prices.where("stock_id = 1")._jdf.queryExecution().optimizedPlan().stats()
    finally:
        spark.conf.set("spark.sql.cbo.enabled", "false")
    assert stats.rowCount().isDefined()


def test_views_on_a_catalog_warehouse(spark, tmpdir_path):
    w, t = warehouse(spark, tmpdir_path)
    a, b = (sorted(map(str, A.stock_rankings(x).collect())) for x in (w.open(), t))
    assert a == b
    assert ST.freshness(w.open()).count() == ST.freshness(t).count()
