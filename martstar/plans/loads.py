"""Jobs that write: each changes a catalog warehouse (``sources.catalog``) by the
partitions it touches.

A job takes a ``Change`` and writes into it; the new version is published when the
``with`` block of the change ends. Counts come from the writes themselves
(``DataFrame.observe``), so no plan runs twice for them. Rejects are written before
anything else.

    with Warehouse(spark, "market", root).change() as c:
        summary = load_landing(c, "/landing", now)
"""

from __future__ import annotations

import datetime as _dt
from typing import Optional, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import dims as DM
from ..operators import merge as MG
from ..operators import returns as RT
from ..operators import status as ST
from ..sources.catalog import Change, with_partition
from ..tables import FACT_PARTITION
from . import jobs as JB


def years_of(name: str, batch: DataFrame) -> list[int]:
    """The years of a batch: calendar years, a handful."""
    rows = with_partition(name, batch).select(FACT_PARTITION).distinct().collect()
    return sorted(r[0] for r in rows if r[0] is not None)


def _of_years(c: Change, name: str, years: Sequence[int]) -> DataFrame:
    df = c.tables.prices_by_year if name == "prices" else c.spark.table(f"{c.w.database(c.base)}.{name}")
    return df.where(F.col(FACT_PARTITION).isin([int(y) for y in years]))


def _merged(c: Change, name: str, batch: DataFrame, keys, set_cols, years) -> tuple[DataFrame, Observation]:
    seen = Observation()
    state, _ = MG.merge(_of_years(c, name, years).drop(FACT_PARTITION), batch, keys, set_cols, seen)
    return state, seen


def _counts(seen: Optional[Observation]) -> dict[str, int]:
    return {"inserted": 0, "updated": 0} if seen is None else dict(seen.get)


def load_prices(c: Change, batch: DataFrame, as_of_ts: _dt.datetime) -> dict[str, int]:
    """Upsert price rows and fill the returns that are NULL.

    ``batch``: checkpointed rows of the price fact, one per key. Only the years of the
    batch are read and written. A return may also become known behind the batch, where
    a stock's first row was until now; later years are looked at for such rows, unless
    the batch is in the last year.
    """
    t, years = c.tables, years_of("prices", batch)
    if not years:
        return _counts(None)
    if t.last_year is not None and max(years) < t.last_year:
        behind = (t.prices_by_year.where((F.col(FACT_PARTITION) > max(years)) & F.col("daily_return").isNull())
                  .join(batch.select("stock_id").distinct(), "stock_id", "left_semi").select(FACT_PARTITION).distinct())
        years = sorted({*years, *(r[0] for r in behind.collect())})
    state, seen = _merged(c, "prices", batch.select(*t.prices.columns), ["stock_id", "date_id"], MG.PRICE_SET, years)
    # one row per stock and year of all other years before the last one that is written
    ends = c.spark.table(f"{c.w.database(c.base)}.year_ends").where(
        (F.col(FACT_PARTITION) < max(years)) & ~F.col(FACT_PARTITION).isin(years)) if t.year_ends is not None else \
        c.spark.createDataFrame([], batch.select("stock_id", "date_id", "closing_price").schema)
    c.put_partitions("prices", RT.fill_returns(state, ends, as_of_ts), years)
    return _counts(seen)


def load_rates(c: Change, batch: DataFrame) -> dict[str, int]:
    """Upsert rate rows into the years of the batch."""
    years = years_of("rates", batch)
    if not years:
        return _counts(None)
    keys = ["from_currency_id", "to_currency_id", "date_id"]
    state, seen = _merged(c, "rates", batch.select(*c.tables.rates.columns), keys, MG.RATE_SET, years)
    c.put_partitions("rates", state, years)
    return _counts(seen)


def add_days(c: Change, dates: DataFrame, dow: str = "iso") -> int:
    """Calendar rows for the days of ``dates.date`` that have none."""
    new = DM.date_rows(dates, "date", dow).join(c.tables.dim_date.select("date_value"), "date_value", "left_anti")
    new = MG.staged(new)  # counted and written
    n = new.count()
    if n:
        c.append("dim_date", new.select(*c.tables.dim_date.columns))
    return n


def keep_rejects(c: Change, rejects: DataFrame) -> int:
    """Write rejects (kind, reason, record) under ``rejects/v=<version>``; how many."""
    seen = Observation()
    (rejects.observe(seen, F.count(F.lit(1)).alias("n"))
     .write.mode("overwrite").json(f"{c.w.root}/rejects/v={c.version}"))
    return seen.get["n"]


def load_landing(c: Change, landing_dir: str, as_of_ts: _dt.datetime, dow: str = "iso") -> dict[str, int]:
    """Landing files -> validated records -> rejects, days, facts."""
    prices, rates, rejects = JB.landing_batches(c.spark, landing_dir, c.tables, as_of_ts)
    return _load(c, prices, rates, rejects, as_of_ts, dow)


def load_records(c: Change, kind: str, records: DataFrame, as_of_ts: _dt.datetime, dow: str = "iso") -> dict[str, int]:
    """The landing records of one kind ('stocks' or 'exchange'): a micro-batch of the stream."""
    rows, rejects = JB.conformed(c.tables, kind, records, as_of_ts)
    out = {"rejected": keep_rejects(c, rejects)}
    rows = MG.staged(rows)
    out["days_added"] = add_days(c, rows.select(F.col("date_value").alias("date")), dow)
    rows = rows.drop("date_value")
    return out | (load_prices(c, rows, as_of_ts) if kind == "stocks" else load_rates(c, rows))


def _load(c: Change, prices: DataFrame, rates: DataFrame, rejects: DataFrame, as_of_ts, dow: str) -> dict[str, int]:
    out = {"rejected": keep_rejects(c, rejects)}
    prices, rates = MG.staged(prices), MG.staged(rates)
    out["days_added"] = add_days(c, prices.select(F.col("date_value").alias("date"))
                                 .unionByName(rates.select(F.col("date_value").alias("date"))), dow)
    out |= {f"stock_{k}": v for k, v in load_prices(c, prices.drop("date_value"), as_of_ts).items()}
    out |= {f"exchange_{k}": v for k, v in load_rates(c, rates.drop("date_value")).items()}
    return out


def ingest(c: Change, stock_payloads: DataFrame, fx_payloads: DataFrame, quote_payloads: Optional[DataFrame],
           tracked: Sequence[str], as_of: _dt.date, as_of_ts: _dt.datetime, kind: str = "full", dow: str = "iso") -> dict:
    """The last rows of each tracked symbol and of the FX series.

    ``initial`` takes 10 rows of each, ``daily`` 3; ``full`` is ``initial`` where both facts
    are empty, else ``daily``.
    """
    t = c.tables
    if kind == "full":
        kind = "initial" if t.prices.isEmpty() and t.rates.isEmpty() else "daily"
    n = {"initial": 10, "daily": 3}[kind]
    stocks, fx = JB.prepared(stock_payloads, fx_payloads, quote_payloads, tracked, n, as_of, as_of_ts)
    prices, p_bad = MG.conform_price_batch(t, stocks.drop("conversion_errors"), as_of_ts)
    rates, r_bad = MG.conform_rate_batch(t, fx, as_of_ts)
    out = _load(c, prices, rates, JB.as_rejects(p_bad, "stocks", "unfit").unionByName(JB.as_rejects(r_bad, "exchange", "unfit")),
                as_of_ts, dow)
    return {"run": kind, **out}


def append_absent(c: Change, rows: DataFrame, name: str = "prices") -> int:
    """Append fact rows whose key is absent; the years of the rows are rewritten."""
    keys = ["stock_id", "date_id"] if name == "prices" else ["from_currency_id", "to_currency_id", "date_id"]
    columns = getattr(c.tables, name).columns
    rows = MG.staged(MG.latest_per_key(rows.select(*columns), keys, [F.lit(1)]))
    years = years_of(name, rows)
    if not years:
        return 0
    old, seen = _of_years(c, name, years).drop(FACT_PARTITION), Observation()
    new = rows.join(MG.held_keys(old, rows, keys), keys, "left_anti").observe(seen, F.count(F.lit(1)).alias("n"))
    c.put_partitions(name, old.unionByName(new.select(*columns)), years)
    return seen.get["n"]


def backfill(c: Change, prices: DataFrame, rates: DataFrame, start: _dt.date, end: _dt.date, as_of_ts: _dt.datetime) -> dict[str, int]:
    """Staging rows of the period into the record tables; the years of the period are
    read and written, and one batch of the log has a row for each table."""
    years, out, logs = range(start.year, end.year + 1), {}, []
    for name, staging, into in (("stock_prices", prices, MG.backfill_load_prices), ("exchange_rates", rates, MG.backfill_load_rates)):
        seen = Observation()
        state, _, row = into(c.spark, _of_years(c, name, years), staging, start, end, as_of_ts, seen)
        c.put_partitions(name, state, years)
        out |= {f"{name}_{k}": v for k, v in seen.get.items()}
        logs.append(row.drop("records_loaded"))
    log(c, logs[0].unionByName(logs[1]))
    return out


def dedupe(c: Change, start: _dt.date, end: _dt.date, as_of_ts: _dt.datetime) -> int:
    """B5 on both record tables in the years of the period, with a log row; rows removed."""
    years, gone = range(start.year, end.year + 1), 0
    for name, keys in (("stock_prices", ["symbol", "date"]), ("exchange_rates", ["from_currency", "to_currency", "date"])):
        if getattr(c.tables, name) is None:
            continue
        rows = _of_years(c, name, years)
        if not set(map(str, years)) & set(c.new[name][2]):
            continue
        before, after = Observation(), Observation()
        order = [F.col("updated_at").desc(), F.col("created_at").desc()]
        c.put_partitions(name, MG.dedupe(rows, keys, order, start, end, seen=(before, after)), years)
        gone += before.get["n"] - after.get["n"]
    log(c, MG.dedupe_log(c.spark, as_of_ts, start, end, gone))
    return gone


def log(c: Change, row: DataFrame) -> None:
    """One more file of the run log, nothing else."""
    c.append("etl_logs", row)


def retention(c: Change, as_of: _dt.date, years: int = 5, dow: str = "iso") -> int:
    """The calendar without old unused days; days that stay."""
    seen = Observation()
    kept = DM.calendar_retention(c.spark, c.tables, as_of, years, dow).observe(seen, F.count(F.lit(1)).alias("n"))
    c.put("dim_date", kept.select(*c.tables.dim_date.columns))
    return seen.get["n"]


def archive(c: Change, archive_root: str, as_of: _dt.date, years: int = 2) -> int:
    """Old prices move to ``archive_root``; rows moved.

    Years that are old as a whole leave the table without being rewritten, only the
    year of the cut is. The archive is written first, under the day of the run.
    """
    stay, old = ST.archive_split(c.tables, as_of, years)
    seen, cut = Observation(), as_of.year - years
    columns = c.tables.prices.columns
    (with_partition("prices", old.select(*columns)).observe(seen, F.count(F.lit(1)).alias("n"))
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(FACT_PARTITION)
     .parquet(f"{archive_root.rstrip('/')}/as_of={as_of.isoformat()}"))
    have = [int(v) for v in c.new["prices"][2]]
    c.drop_partitions("prices", [v for v in have if v < cut])
    if cut in have:
        c.put_partitions("prices", stay.where(F.col("date_id") < (cut + 1) * 10000).select(*columns), [cut])
    return seen.get["n"]
