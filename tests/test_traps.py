"""One test per semantic trap of the reference, on
hand-made warehouses, checked against brute force where it matters."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from martstar import schemas as S
from martstar.functions.numeric import mean_half_up
from martstar.operators import analytics as A
from martstar.operators import backfill as B
from martstar.operators import merge as MG
from martstar.operators import presentation as PR
from martstar.operators import quality as Q
from martstar.operators import returns as R
from martstar.operators import status as ST
from martstar.operators import validate as V
from martstar.tables import empty_tables
from tests.helpers import did, dim_date_for, make_tables

D1, D2, D3 = dt.date(2025, 8, 13), dt.date(2025, 8, 14), dt.date(2025, 8, 15)


def test_t1_rate_row_required_for_top_performers(spark):
    t = make_tables(spark, [("AAA", D2, 10, 11, 9, 10, 5, 2.5), ("BBB", D2, 10, 11, 9, 10, 5, 3.5)],
                    rates=[(D1, 0.8)])
    assert A.top_performers(t).count() == 0  # no rate on the latest day: inner join


def test_t2_left_join_keeps_rows_without_rate(spark):
    t = make_tables(spark, [("AAA", D1, 10, 11, 9, 10, 5, None), ("AAA", D2, 10, 11, 9, 12, 5, 20)],
                    rates=[(D1, 0.8)])
    got = {r.trade_date: r.price_gbp for r in A.prices_with_currency(t).collect()}
    assert got[D1] == D("8.0000") and got[D2] is None


def test_t3_desc_puts_nulls_first(spark):
    t = make_tables(spark, [("AAA", D2, 10, 11, 9, 10, 5, None), ("BBB", D2, 10, 11, 9, 10, 5, 3.0)])
    ranks = {r.symbol: r.return_rank for r in A.stock_rankings(t).collect()}
    assert ranks == {"AAA": 1, "BBB": 2}


def test_t4_return_overflow_is_null_not_failure(spark):
    t = make_tables(spark, [("AAA", D1, 1, 1, 1, 1, 5, None), ("AAA", D2, 5, 5, 5, 5, 5, None)])
    out = R.daily_returns(t).collect()
    assert all(r.daily_return is None for r in out)  # +400 % does not fit DECIMAL(8,6)
    assert R.return_overflows(t).count() == 1


def test_t5_null_only_history_compares_with_first_day(spark):
    t = make_tables(spark, [("AAA", D1, 100, 100, 100, 100, 5, None),
                            ("AAA", D2, 110, 110, 110, 110, 5, 10),
                            ("AAA", D3, 121, 121, 121, 121, 5, None)])
    full = {r.date_id: r.daily_return for r in R.daily_returns(t, "all").collect()}
    literal = {r.date_id: r.daily_return for r in R.daily_returns(t, "null_only").collect()}
    assert full[did(D3)] == D("10.000000")
    assert literal[did(D3)] == D("21.000000")
    assert full[did(D1)] is None and full[did(D2)] == D("10.000000")


def test_t7_all_time_rank_by_counting_equals_window_rank(spark):
    rows, rets = [], [5.0, None, 1.0, 7.5, 3.0, 7.5, -2.0, None, 4.0]
    for i, r in enumerate(rets):
        rows.append(("S%d" % (i % 3), dt.date(2025, 7, 1) + dt.timedelta(days=i), 10, 11, 9, 10, 5, r))
    t = make_tables(spark, rows)
    hist = t.prices.select("daily_return")
    targets = t.prices.select(F.concat_ws("-", "stock_id", "date_id").alias("k"), "daily_return")
    got = {r.k: r.performance_rank for r in
           A.rank_desc_nulls_first(hist, targets, "daily_return", "k").collect()}
    # brute force: 1 + #null + #greater for values, 1 for nulls
    vals = [r for r in rets]
    for row in targets.collect():
        x = row.daily_return
        expect = 1 if x is None else 1 + sum(1 for v in vals if v is None or v > float(x))
        assert got[row.k] == expect


def test_t8_thirty_row_frames(spark):
    rows = [("AAA", dt.date(2025, 1, 1) + dt.timedelta(days=i), 10 + i, 10 + i, 10 + i, 10 + i, 100 + i,
             None if i == 0 else 1.0) for i in range(40)]
    t = make_tables(spark, rows, rates=[(r[1], 1.0) for r in rows])
    r = A.performance_details(t, ["AAA"]).collect()[0]
    closes = [10 + i for i in range(40)]
    assert r.avg_price_30d_usd == round(sum(closes[-30:]) / 30, 4)
    assert float(r.price_change_30d_pct) == round((49 - 19) / 19 * 100, 4)  # 30 rows back


def test_t9_rounding_half_away_from_zero(spark):
    df = spark.createDataFrame([(2,), (3,)], "v bigint")
    assert df.agg(mean_half_up(F.col("v"), 0, 0).alias("m")).first().m == 3.0
    neg = spark.createDataFrame([(D("-0.000001"),), (D("-0.000002"),)], "v decimal(8,6)")
    assert neg.agg(mean_half_up(F.col("v"), 6, 6).alias("m")).first().m == -0.000002


def test_t10_day_of_week_conventions(spark):
    sunday = dt.date(2024, 1, 7)
    iso = dim_date_for(spark, [sunday], "iso").first()
    s0 = dim_date_for(spark, [sunday], "sunday0").first()
    assert (iso.day_of_week, iso.is_weekend) == (7, True)
    assert (s0.day_of_week, s0.is_weekend) == (0, True)
    assert iso.date_id == 20240107 and iso.week_of_year == 1


def test_t11_dedupe_literal_drops_every_copy(spark):
    rows = [("AAA", D2, D("1"), None, None, D("1"), 1, None, dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1)),
            ("AAA", D2, D("2"), None, None, D("2"), 1, None, dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 2)),
            ("BBB", D2, D("3"), None, None, D("3"), 1, None, dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1))]
    sp = spark.createDataFrame(rows, S.STOCK_PRICES)
    order = [F.col("updated_at").desc(), F.col("created_at").desc()]
    kept = {(r.symbol, r.close_price) for r in MG.dedupe(sp, ["symbol", "date"], order, D1, D3).collect()}
    assert kept == {("AAA", D("2.0000")), ("BBB", D("3.0000"))}
    literal = {r.symbol for r in MG.dedupe(sp, ["symbol", "date"], order, D1, D3, literal=True).collect()}
    assert literal == {"BBB"}


def test_t17_report_counts_match_brute_force_pairs(spark):
    t = empty_tables(spark)
    sp_rows = [("AAA", D1, None, None, None, D(c), v, None, None, None)
               for c, v in (("-1", 5), ("2", 5), ("3", -1))] + \
              [("AAA", D2, None, None, None, D("-4"), 1, None, None, None)]
    er_rows = [("USD", "GBP", D1, D(x), None, None) for x in ("0.7", "0", "0.8")] + \
              [("USD", "GBP", D3, D("0"), None, None)]
    t = t.with_(stock_prices=spark.createDataFrame(sp_rows, S.STOCK_PRICES),
                exchange_rates=spark.createDataFrame(er_rows, S.EXCHANGE_RATES))
    out = B.backfill_report(spark, t, D1, D3, D3).first()
    # brute-force full outer join on date
    pairs = []
    for s in sp_rows:
        m = [r for r in er_rows if r[2] == s[1]]
        pairs += [(s, r) for r in m] or [(s, None)]
    pairs += [(None, r) for r in er_rows if not any(s[1] == r[2] for s in sp_rows)]
    bad_s = sum(1 for s, r in pairs if s is not None and (s[5] <= 0 or s[6] < 0))
    bad_r = sum(1 for s, r in pairs if r is not None and r[3] <= 0)
    assert (out.stock_quality_issues, out.exchange_quality_issues) == (bad_s, bad_r)
    assert out.backfill_status == "COMPLETED_WITH_QUALITY_ISSUES"


def test_t18_missing_recent_data_is_zero_for_empty_facts(spark):
    t = empty_tables(spark)
    rows = {r.check_name: r.violation_count for r in Q.quality_checks(t, D3, ["AAA"]).collect()}
    assert rows["Missing recent data"] == 0 and rows["Missing stock data"] == 1


def test_t19_period_days_is_an_integer(spark):
    t = empty_tables(spark)
    r = B.validate_period(spark, t, D1, D3, dt.date(2025, 9, 1)).first()
    assert r.backfill_days == 2 and r.final_status == "READY_FOR_BACKFILL"
    r = B.validate_period(spark, t, D3, D1, dt.date(2025, 9, 1)).first()
    assert r.final_status == "ERROR: Start date must be before end date"


def test_t20_score_counts_two_checks_only(spark):
    t = make_tables(spark, [("AAA", D2, 10, 9, 11, 10, 5, 60)])  # bad OHLC + extreme return
    assert Q.quality_score(t).first().quality_score == 0.9


def test_t16_presentation_turns_zero_into_null(spark):
    df = spark.createDataFrame([("AAA", "A", 10.0, 0.0, 0.0, 5, D1, 1)],
                               "symbol string, company_name string, price_usd double, price_gbp double, "
                               "daily_return double, volume long, trade_date date, performance_rank int")
    r = PR.present_top(df).first()
    assert r.price_gbp is None and r.daily_return is None and r.price_usd == 10.0


def test_t23_t24_unknown_symbols_rejected_and_counts_split(spark):
    t = make_tables(spark, [("AAA", D1, 10, 11, 9, 10, 5, None)])
    rec = spark.createDataFrame(
        [("AAA", "2025-08-13", "1", "2", "0.5", "1.5", "7"), ("AAA", "2025-08-14", "1", "2", "0.5", "1.5", "7"),
         ("ZZZ", "2025-08-14", "1", "2", "0.5", "1.5", "7")],
        "symbol string, data_date string, open_price string, high_price string, low_price string, "
        "close_price string, volume string")
    state, counts, rejects, _ = MG.upsert_prices(t, rec, dt.datetime(2025, 8, 15))
    c = counts.first()
    assert (c.inserted, c.updated, c.affected) == (1, 1, 2)
    assert [r.symbol for r in rejects.collect()] == ["ZZZ"]
    assert state.count() == 2
    # re-running the same batch changes nothing
    state2, _, _, _ = MG.upsert_prices(t.with_(prices=state), rec, dt.datetime(2025, 8, 15))
    assert sorted(map(tuple, state2.collect())) == sorted(map(tuple, state.collect()))


def test_t26_latest_rate(spark):
    t = make_tables(spark, [("AAA", D1, 10, 11, 9, 10, 5, None)], rates=[(D1, 0.78), (D2, 0.79)])
    r = ST.latest_rate(t).first()
    assert r.rate_date == D2 and r.exchange_rate == D("0.790000")


def test_t27_lower_case_symbol_is_rejected(spark):
    df = spark.createDataFrame([("aapl", dt.datetime(2025, 8, 1), 150.0, 155.0, 149.0, 154.0, 1000000)],
                               "symbol string, timestamp timestamp, open double, high double, low double, "
                               "close double, volume long")
    errs = V.validate_bars(df, dt.datetime(2025, 9, 1)).first().errors
    assert "symbol must match ^[A-Z0-9.-]+$" in errs


def test_t28_backfill_log_counts_whole_staging(spark):
    target = spark.createDataFrame([], S.STOCK_PRICES)
    staging = spark.createDataFrame(
        [("AAA", d, D("1"), D("1"), D("1"), D("1"), 1, D("1"), dt.datetime(2025, 9, 1)) for d in (D1, D2, D3)],
        "symbol string, date date, open_price decimal(10,4), high_price decimal(10,4), "
        "low_price decimal(10,4), close_price decimal(10,4), volume long, adjusted_close decimal(10,4), "
        "backfill_timestamp timestamp")
    state, counts, log = MG.backfill_load_prices(spark, target, staging, D1, D2, dt.datetime(2025, 9, 1))
    row = log.first()
    assert (row.records_affected, row.records_loaded) == (3, 2)
    assert state.count() == 2 and counts.first().inserted == 2


def test_t29_top_k_breaks_ties_by_symbol(spark):
    rows = [(s, D2, 10, 11, 9, 10, 5, 1.5) for s in ("CCC", "AAA", "BBB")]
    t = make_tables(spark, rows, rates=[(D2, 0.8)])
    out = A.top_performers(t, k=2).collect()
    assert [r.symbol for r in out] == ["AAA", "BBB"]
    assert {r.performance_rank for r in out} == {1}
