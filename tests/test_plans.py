"""Plan-shape checks: pruning, pushdown and the scale rewrites stay in place."""

from martstar import binding, registry
from martstar.operators import analytics as A
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lineitem_scan_is_pruned_and_filtered(spark):
    p = _plan(binding.ticks(spark, SF_SMALL))
    scan = [line for line in p.split("\n") if "FileScan" in line and "l_shipdate" in line][0]
    assert "LessThan(l_shipdate" not in scan  # all trades are read
    assert "l_extendedprice" not in scan and "l_comment" not in scan  # only the needed columns


def test_top_k_before_rank(spark):
    p = _plan(registry.QUERIES["top_performers"](spark, SF_SMALL))
    assert "TakeOrderedAndProject(limit=5" in p
    # the unpartitioned rank window sits above the top-k, so it sees k rows only
    assert p.index("Window [rank(") < p.index("TakeOrderedAndProject")


def test_rolling_metrics_trim_before_shuffle(spark, monkeypatch):
    t = registry.tables(spark, SF_SMALL)
    monkeypatch.setattr(A, "staged", lambda df: df)  # one plan to look at
    p = _plan(A.performance_details(t, binding.TRACKED))
    assert "WindowGroupLimit" in p
    assert "rank(" not in p  # all-time rank is computed by counting, not by a global window


def test_rolling_metrics_read_the_last_years(spark):
    from martstar.operators.common import star

    t = registry.tables(spark, SF_SMALL)
    rows = lambda tables, columns: star(tables, columns=columns)
    last = A._last_rows(t, rows, 3).prices
    years = {f.split("year=")[1][:4] for f in last.inputFiles()}
    assert max(years) == str(t.last_year) and len(years) < 7
    held = rows(t.with_(prices=last), []).groupBy("symbol").count().where("count < 3")
    # whoever has fewer rows there trades no more in the last year
    traded = star(t.with_(prices=t.prices_where(low=t.last_year * 10000)), columns=[]).select("symbol").distinct()
    assert held.join(traded, "symbol").count() == 0


def test_fact_scan_prunes_partitions(spark):
    df = registry.QUERIES["fact_scan"](spark, SF_SMALL)
    scan = [line for line in _plan(df).split("\n") if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(year" in scan and "2001" in scan
    assert "GreaterThanOrEqual(date_id,20010101)" in scan
    assert df.inputFiles() and all("year=2001" in f for f in df.inputFiles())


def test_a_date_reaches_the_scan(spark):
    for key in ("prices_with_currency_on", "price_range_on"):
        scans = [line for line in _plan(registry.QUERIES[key](spark, SF_SMALL)).split("\n") if "FileScan" in line and "closing_price" in line]
        assert scans and all("EqualTo(date_id,20011002)" in s and "year" in s.split("PartitionFilters")[1][:40] for s in scans)


def test_dimension_joins_broadcast(spark):
    p = _plan(registry.QUERIES["v_latest_prices"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_no_python_udfs_anywhere(spark):
    for key in ("top_performers", "validate_bars", "payload_daily", "backfill_report", "quality_checks"):
        p = _plan(registry.QUERIES[key](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_dedupe_limits_before_the_shuffle(spark):
    p = _plan(registry.QUERIES["dedupe_prices"](spark, SF_SMALL))
    assert p.count("WindowGroupLimit") >= 2  # partial (map side) and final


def test_bar_aggregation_is_hash_based(spark):
    p = _plan(binding.bars(binding.ticks(spark, SF_SMALL)))
    assert "HashAggregate" in p and "SortAggregate" not in p


def test_backfill_period_prunes_years(spark):
    p = _plan(registry.QUERIES["backfill_validate_data"](spark, SF_SMALL))
    scans = [line for line in p.split("\n") if "FileScan" in line and ",date#" in line]
    assert scans and all("PartitionFilters: [isnotnull(year" in s and "2001" in s for s in scans)


def test_days_prune_years(spark):
    """Latest-day and period queries name the year of the fact."""
    for key in ("top_performers", "price_range", "price_range_on", "daily_summary", "summary_on", "quality_status",
                "price_history", "missing_dates", "archive_split", "freshness"):
        p = _plan(registry.QUERIES[key](spark, SF_SMALL))
        scans = [line for line in p.split("\n") if "FileScan" in line
                 and "stock_id#" in line.split("] Batched")[0] and "date_id#" in line.split("] Batched")[0]]
        if key == "freshness":  # all days are its feature
            assert scans and "date_value#" not in p
        elif key != "quality_status":  # its dirty fact is derived
            assert scans and all("PartitionFilters: [isnotnull(year" in s for s in scans), key
