"""Job-level compositions as plans: load the landing directory, initial setup, daily
update and the full run.

The functions take ``Tables``, return new ones and write nothing; ``plans.loads`` runs
the same steps on a catalog warehouse and writes only what they touch.
"""

from __future__ import annotations

import datetime as _dt
from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checks import errors_array, rule
from ..operators import conform as CF
from ..operators import dims as DM
from ..operators import merge as MG
from ..operators import returns as RT
from ..sources import landing as L
from ..sources import payloads as PL
from ..tables import Tables


def _counted(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def as_rejects(rows: DataFrame, kind: str, reason: str) -> DataFrame:
    """(kind, reason, file, record): rejected rows as JSON text."""
    file = F.col("_file") if "_file" in rows.columns else F.lit(None).cast("string")
    shown = [c for c in rows.columns if c not in ("_pos", "_file")]
    why = F.array_join("errors", "; ") if "errors" in rows.columns else F.lit(reason)
    return rows.select(F.lit(kind).alias("kind"), why.alias("reason"), file.alias("_file"),
                       F.to_json(F.struct(*[c for c in shown if c != "errors"])).alias("record"))


def conformed(t: Tables, kind: str, records: DataFrame, as_of_ts: _dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Landing records of a kind as (fact rows, rejects). Rejects are records that fail a
    check, that the table cannot hold, or whose symbol or currency is unknown."""
    valid, bad = L.split_valid(records, kind)
    rows, unfit = (MG.conform_price_batch if kind == "stocks" else MG.conform_rate_batch)(t, valid, as_of_ts)
    reason = "unknown key, or a value that the table cannot hold"
    return rows, as_rejects(bad, kind, "").unionByName(as_rejects(unfit, kind, reason))


def landing_batches(spark: SparkSession, landing_dir: str, t: Tables, as_of_ts: _dt.datetime):
    """Landing files as (price rows, rate rows, rejects)."""
    base = landing_dir.rstrip("/")
    prices, p_bad = conformed(t, "stocks", L.read_landing(spark, f"{base}/stocks", "stocks"), as_of_ts)
    fx, r_bad = conformed(t, "exchange", L.read_landing(spark, f"{base}/exchange", "exchange"), as_of_ts)
    return prices, fx, p_bad.unionByName(r_bad)


def _summed(t: Tables, prices: DataFrame, fx: DataFrame, as_of_ts, dow: str):
    """(new tables, price counts, rate counts) after both upserts; returns are not filled."""
    prices, fx = MG.staged(prices), MG.staged(fx)
    p, p_counts = MG.merge(t.prices, prices.select(*t.prices.columns), ["stock_id", "date_id"], MG.PRICE_SET)
    r, r_counts = MG.merge(t.rates, fx.select(*t.rates.columns), ["from_currency_id", "to_currency_id", "date_id"], MG.RATE_SET)
    days = prices.select(F.col("date_value").alias("date")).unionByName(fx.select(F.col("date_value").alias("date")))
    return t.with_(prices=p, rates=r, dim_date=DM.ensure_dates(t.dim_date, days, "date", dow)), p_counts, r_counts


def load_landing(spark: SparkSession, landing_dir: str, t: Tables, as_of_ts: _dt.datetime,
                 dow: str = "iso"):
    """Landing files -> validated records -> dates -> upserted facts.

    Returns (new Tables, summary DataFrame, rejects DataFrame). The summary
    row has stock/exchange records inserted and updated, and all rejected.
    """
    prices, fx, rejects = landing_batches(spark, landing_dir, t, as_of_ts)
    new, p_counts, r_counts = _summed(t, prices, fx, as_of_ts, dow)
    summary = (p_counts.select(F.col("inserted").alias("stock_inserted"), F.col("updated").alias("stock_updated"))
               .join(r_counts.select(F.col("inserted").alias("exchange_inserted"),
                                     F.col("updated").alias("exchange_updated")), how="cross")
               .join(_counted(rejects, "rejected"), how="cross"))
    return new, summary, rejects


def prepared(stock_payloads: DataFrame, fx_payloads: DataFrame, quote_payloads: Optional[DataFrame],
             tracked: Sequence[str], n: int, as_of: _dt.date, as_of_ts: _dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Records of the last ``n`` rows of every tracked symbol, and of the FX series
    with the quote as its fallback."""
    stocks = CF.prepare_stocks(PL.flatten_daily(stock_payloads), tracked, n, as_of, as_of_ts)
    fx = CF.conform_fx(CF.last_n(PL.flatten_fx(fx_payloads), ["FromCurrency", "ToCurrency"], "DateTime", n), as_of, as_of_ts)
    if quote_payloads is not None:
        fx = CF.prepare_fx(fx, CF.conform_quote(PL.parse_quote(quote_payloads), as_of, as_of_ts))
    return stocks, fx


def run_ingestion(t: Tables, stock_payloads: DataFrame, fx_payloads: DataFrame,
                  quote_payloads: Optional[DataFrame], tracked: Sequence[str], n: int,
                  as_of: _dt.date, as_of_ts: _dt.datetime, kind: str, dow: str = "iso"):
    """Prepare the last ``n`` rows of every tracked symbol and of the
    FX series (with the quote fallback), upsert both, fill returns.

    Returns (new Tables, one-row summary, rejects). ``errors`` names the feeds that
    brought no usable row and ``success`` means that there are none.
    """
    frames = PL.flatten_daily(stock_payloads)
    stocks, fx = prepared(stock_payloads, fx_payloads, quote_payloads, tracked, n, as_of, as_of_ts)
    prices, p_bad = MG.conform_price_batch(t, stocks.drop("conversion_errors"), as_of_ts)
    rates, r_bad = MG.conform_rate_batch(t, fx, as_of_ts)
    rejects = as_rejects(p_bad, "stocks", "unfit").unionByName(as_rejects(r_bad, "exchange", "unfit"))
    new, p_counts, r_counts = _summed(t, prices, rates, as_of_ts, dow)
    new = new.with_(prices=RT.daily_returns(new, "all", as_of_ts))
    feeds = _counted(frames, "_stock_rows").join(_counted(fx, "_fx_rows"), how="cross")
    errors = errors_array(rule(F.col("_stock_rows") == 0, "no stock data"), rule(F.col("_fx_rows") == 0, "no FX data"))
    summary = (p_counts.select(F.col("affected").alias("stock_records"))
               .join(r_counts.select(F.col("affected").alias("fx_records")), how="cross")
               .join(stocks.agg(F.count_distinct("symbol").alias("companies_updated")), how="cross")
               .join(feeds, how="cross").withColumn("errors", errors)
               .select(F.lit(kind).alias("run"), "stock_records", "fx_records", "companies_updated",
                       F.col("_stock_rows").alias("stock_fetched"), F.col("_fx_rows").alias("fx_fetched"),
                       "errors", (F.size("errors") == 0).alias("success")))
    return new, summary, rejects


def run_initial(t: Tables, stock_payloads, fx_payloads, quote_payloads, tracked, as_of, as_of_ts, n: int = 10):
    return run_ingestion(t, stock_payloads, fx_payloads, quote_payloads, tracked, n, as_of, as_of_ts, "initial")


def run_daily(t: Tables, stock_payloads, fx_payloads, quote_payloads, tracked, as_of, as_of_ts, n: int = 3):
    return run_ingestion(t, stock_payloads, fx_payloads, quote_payloads, tracked, n, as_of, as_of_ts, "daily")


def run_full(t: Tables, stock_payloads, fx_payloads, quote_payloads, tracked, as_of, as_of_ts):
    """Empty facts -> initial setup, else daily update (one driver-side branch)."""
    if t.prices.isEmpty() and t.rates.isEmpty():
        return run_initial(t, stock_payloads, fx_payloads, quote_payloads, tracked, as_of, as_of_ts)
    return run_daily(t, stock_payloads, fx_payloads, quote_payloads, tracked, as_of, as_of_ts)
