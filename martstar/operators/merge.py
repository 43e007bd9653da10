"""Keyed writes as plans: upsert, insert-if-absent, dedupe, logs.

``merge`` is a pure DataFrame function (latest batch row per key, then joins on
the key) so a ``MERGE INTO`` back end could replace it; ``plans.loads`` applies it
to the partitions that a batch touches.
"""

from __future__ import annotations

import datetime as _dt
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.calendar import date_id_of
from ..tables import Tables, period_predicate
from .common import bounded


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order`` (``row_number() = 1``, planned
    as a WindowGroupLimit that also trims before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def merge(target: DataFrame, batch: DataFrame, keys: Sequence[str],
          set_cols: Optional[Sequence[str]] = None, seen: Optional[Observation] = None) -> tuple[DataFrame, DataFrame]:
    """Upsert ``batch`` (one row per key) into ``target``.

    Existing keys get ``set_cols`` from the batch and keep their other
    columns; new keys are inserted whole. Returns (new state, counts) where
    counts has ``inserted``, ``updated`` and ``affected``.

    Plan: the batch keys drive a semi join (the target rows being replaced)
    and an anti join (the untouched rest). A daily batch is small, so AQE
    turns both into broadcast joins that stream the target without
    shuffling it; a large batch falls back to shuffled joins. Keys are NOT
    NULL, as in the table definitions. With ``seen`` the state's own write counts
    ``inserted`` and ``updated``, so that no part of the plan runs again for them.
    """
    keys = list(keys)
    cols = target.columns
    set_cols = list(set_cols) if set_cols is not None else [c for c in cols if c not in keys]
    batch = batch.select(*cols)
    bkeys = batch.select(*keys)
    untouched = target.join(bkeys, keys, "left_anti")
    matched = target.join(bkeys, keys, "left_semi").select(
        *keys, *[F.col(c).alias(f"t_{c}") for c in cols if c not in keys]).withColumn("_t", F.lit(True))
    j = batch.join(matched, keys, "left")
    has_t = F.col("_t").isNotNull()
    counted = j if seen is None else j.observe(seen, F.count_if(~has_t).alias("inserted"), F.count_if(has_t).alias("updated"))
    changed = counted.select(*[F.col(c) if c in keys or c in set_cols
                         else F.when(has_t, F.col(f"t_{c}")).otherwise(F.col(c)).alias(c) for c in cols])
    state = untouched.unionByName(changed)
    counts = (j.agg(F.count_if(F.col("_t").isNull()).alias("inserted"),
                    F.count_if(F.col("_t").isNotNull()).alias("updated"))
              .withColumn("affected", F.col("inserted") + F.col("updated")))
    return state, counts


def staged(batch: DataFrame) -> DataFrame:
    """The conformed batch, computed once: a merge and its counts read it several times."""
    from ..session import checkpoint_dir

    checkpoint_dir(batch.sparkSession)
    return batch.checkpoint()


def held_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the batch that the target has; they choose the target's rows, so a small
    batch never moves the whole target."""
    return target.select(*keys).join(batch.select(*keys).distinct(), list(keys), "left_semi")


def split_by_days(target: DataFrame, batch: DataFrame, col: str = "date_id") -> tuple[DataFrame, DataFrame]:
    """The target's rows on the days of the batch, and its rows on all other days.

    Only the former can hold a key of the batch: a join on the keys sorts those and not
    the whole history, which streams past the days (bounded by the calendar).
    """
    days = bounded(staged(batch.select(col).distinct()))
    return tuple(target.join(days, col, how).select(*target.columns) for how in ("left_semi", "left_anti"))


def insert_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert only rows whose key is absent (``ON CONFLICT DO NOTHING``)."""
    new = batch.join(held_keys(target, batch, keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def conform_price_batch(t: Tables, records: DataFrame, as_of_ts: _dt.datetime,
                        order: Sequence[Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Landing stock records -> fact rows (stock id looked up, date id derived).

    The latest record of a key wins (``order`` defaults to file name and
    position, newest first). Unknown symbols, and values that the table cannot
    hold (a bad date, NaN, a price out of range), go to the rejects instead of
    vanishing or ending the load.
    """
    order = order or [F.col("_file").desc_nulls_last(), F.col("_pos").desc_nulls_last()]
    rec = records
    for c in ("_file", "_pos"):
        if c not in rec.columns:
            rec = rec.withColumn(c, F.lit(None).cast("string" if c == "_file" else "long"))
    d = F.col("data_date").try_cast("date")
    prices = {"opening_price": "open_price", "high_price": "high_price", "low_price": "low_price",
              "closing_price": "close_price"}
    volume = F.coalesce(F.col("volume").try_cast("bigint"), F.col("volume").try_cast("double").try_cast("bigint"))
    bad = d.isNull() | volume.isNull()
    for c in prices.values():
        bad = bad | F.col(c).try_cast(S.PRICE).isNull()
    unfit, rec = rec.where(bad), rec.where(~bad)
    stocks = t.dim_stocks.select("stock_id", "symbol")
    rejects = unfit.unionByName(rec.join(stocks, "symbol", "left_anti").select(*unfit.columns))
    rows = rec.join(stocks, "symbol").select(
        "stock_id", date_id_of(d).alias("date_id"), d.alias("date_value"),
        *[F.col(c).try_cast(S.PRICE).alias(name) for name, c in prices.items()],
        volume.alias("volume"), F.col("close_price").try_cast(S.PRICE).alias("adjusted_close"),
        F.lit(None).cast(S.RETURN_PCT).alias("daily_return"),
        F.lit(as_of_ts).cast("timestamp").alias("created_at"),
        F.lit(as_of_ts).cast("timestamp").alias("updated_at"), "_file", "_pos")
    rows = latest_per_key(rows, ["stock_id", "date_id"], order)
    return rows.drop("_file", "_pos"), rejects


PRICE_SET = ["opening_price", "high_price", "low_price", "closing_price", "volume",
             "adjusted_close", "updated_at"]
RATE_SET = ["exchange_rate", "updated_at"]


def upsert_prices(t: Tables, records: DataFrame, as_of_ts: _dt.datetime):
    """Returns (new price fact, counts, rejects, new dates for dim_date)."""
    rows, rejects = conform_price_batch(t, records, as_of_ts)
    rows = staged(rows)
    near, far = split_by_days(t.prices, rows)
    state, counts = merge(near, rows.select(*t.prices.columns), ["stock_id", "date_id"], PRICE_SET)
    return state.unionByName(far), counts, rejects, rows.select(F.col("date_value").alias("date"))


def conform_rate_batch(t: Tables, records: DataFrame, as_of_ts: _dt.datetime,
                       order: Sequence[Column] | None = None) -> tuple[DataFrame, DataFrame]:
    order = order or [F.col("_file").desc_nulls_last(), F.col("_pos").desc_nulls_last()]
    rec = records
    for c in ("_file", "_pos"):
        if c not in rec.columns:
            rec = rec.withColumn(c, F.lit(None).cast("string" if c == "_file" else "long"))
    d = F.col("data_date").try_cast("date")
    bad = d.isNull() | F.col("exchange_rate").try_cast(S.RATE).isNull()
    unfit, rec = rec.where(bad), rec.where(~bad)
    cur = t.dim_currency.select("currency_id", "currency_code")
    fc = cur.select(F.col("currency_id").alias("from_currency_id"), F.col("currency_code").alias("from_currency"))
    tc = cur.select(F.col("currency_id").alias("to_currency_id"), F.col("currency_code").alias("to_currency"))
    known = rec.join(F.broadcast(fc), "from_currency").join(F.broadcast(tc), "to_currency")
    rejects = rec.join(known.select("from_currency", "to_currency").distinct(),
                       ["from_currency", "to_currency"], "left_anti")
    rejects = unfit.unionByName(rejects.select(*unfit.columns))
    rows = known.select(
        "from_currency_id", "to_currency_id", date_id_of(d).alias("date_id"), d.alias("date_value"),
        F.col("exchange_rate").try_cast(S.RATE).alias("exchange_rate"),
        F.lit(as_of_ts).cast("timestamp").alias("created_at"),
        F.lit(as_of_ts).cast("timestamp").alias("updated_at"), "_file", "_pos")
    rows = latest_per_key(rows, ["from_currency_id", "to_currency_id", "date_id"], order)
    return rows.drop("_file", "_pos"), rejects


def upsert_rates(t: Tables, records: DataFrame, as_of_ts: _dt.datetime):
    """Returns (new rate fact, counts, rejects, new dates)."""
    rows, rejects = conform_rate_batch(t, records, as_of_ts)
    rows = staged(rows)
    state, counts = merge(t.rates, rows.select(*t.rates.columns),
                          ["from_currency_id", "to_currency_id", "date_id"], RATE_SET)
    return state, counts, rejects, rows.select(F.col("date_value").alias("date"))


def insert_new_prices(t: Tables, records: DataFrame, as_of_ts: _dt.datetime) -> DataFrame:
    """D3: the insert-if-absent variant of the price load."""
    rows, _ = conform_price_batch(t, records, as_of_ts)
    rows, keys = staged(rows).select(*t.prices.columns), ["stock_id", "date_id"]
    near, _ = split_by_days(t.prices, rows)
    return t.prices.unionByName(rows.join(held_keys(near, rows, keys), keys, "left_anti").select(*t.prices.columns))


def etl_log(spark: SparkSession, operation_type: str, table_name: str, ts: _dt.datetime,
            records_affected, status: str, details: str) -> DataFrame:
    """One ``etl_logs`` row; ``records_affected`` may be a one-row count DataFrame."""
    if isinstance(records_affected, DataFrame):
        base = records_affected.select(F.col(records_affected.columns[0]).cast("bigint").alias("records_affected"))
    else:
        base = spark.range(1).select(F.lit(records_affected).cast("bigint").alias("records_affected"))
    return base.select(F.lit(operation_type).alias("operation_type"), F.lit(table_name).alias("table_name"),
                       F.lit(ts).cast("timestamp").alias("operation_timestamp"), "records_affected",
                       F.lit(status).alias("status"), F.lit(details).alias("details"))


def _period(col: str, start: _dt.date, end: _dt.date) -> Column:
    return F.col(col).between(F.lit(start), F.lit(end))


def backfill_load(spark: SparkSession, target: DataFrame, staging: DataFrame, keys: Sequence[str],
                  set_cols: Sequence[str], start: _dt.date, end: _dt.date, ts: _dt.datetime,
                  table_name: str, what: str, seen: Optional[Observation] = None):
    """Upsert the staging rows of the period; log row counts the whole staging table."""
    in_period = staging.where(_period("date", start, end))
    if "year" in target.columns and "year" not in in_period.columns:
        in_period = in_period.withColumn("year", F.year("date"))
    state, counts = merge(target, in_period.select(*target.columns), keys, set_cols, seen)
    log = etl_log(spark, "BACKFILL", table_name, ts, staging.agg(F.count(F.lit(1))), "COMPLETED",
                  f"Historical {what} backfill for {start.isoformat()} to {end.isoformat()}")
    log = log.join(in_period.agg(F.count(F.lit(1)).alias("records_loaded")), how="cross")
    return state, counts, log


def backfill_load_prices(spark, stock_prices: DataFrame, staging: DataFrame, start, end, ts, seen=None):
    """Staging columns: symbol, date, open/high/low/close_price, volume, adjusted_close,
    backfill_timestamp."""
    st = staging.select("symbol", "date", "open_price", "high_price", "low_price", "close_price",
                        "volume", "adjusted_close",
                        F.col("backfill_timestamp").alias("created_at"),
                        F.col("backfill_timestamp").alias("updated_at"))
    return backfill_load(spark, stock_prices, st, ["symbol", "date"],
                         ["open_price", "high_price", "low_price", "close_price", "volume",
                          "adjusted_close", "updated_at"], start, end, ts, "stock_prices", "stock data", seen)


def backfill_load_rates(spark, exchange_rates: DataFrame, staging: DataFrame, start, end, ts, seen=None):
    """Staging columns: from_currency, to_currency, date, exchange_rate, backfill_timestamp."""
    st = staging.select("from_currency", "to_currency", "date", F.col("exchange_rate").alias("rate"),
                        F.col("backfill_timestamp").alias("created_at"),
                        F.col("backfill_timestamp").alias("updated_at"))
    return backfill_load(spark, exchange_rates, st, ["from_currency", "to_currency", "date"],
                         ["rate", "updated_at"], start, end, ts, "exchange_rates", "exchange rate", seen)


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column], start: _dt.date,
           end: _dt.date, date_col: str = "date", literal: bool = False,
           seen: Optional[tuple[Observation, Observation]] = None) -> DataFrame:
    """Inside [start, end] keep one row per key (the first by ``order``).

    With ``seen`` the rows (``n``) of the period are counted before and after it
    while the result is computed.

    ``literal=True`` reproduces the reference's statement, which deletes every
    row of a duplicated key, the one meant to be kept included.
    """
    inside = period_predicate(df, date_col, start, end)
    outside_rows = df.where(~inside | F.col(date_col).isNull())
    rows = df.where(inside)
    if literal:
        dup = rows.groupBy(*keys).count().where(F.col("count") > 1).select(*keys)
        kept = rows.join(dup, list(keys), "left_anti")
    else:
        n = F.count(F.lit(1)).alias("n")
        kept = latest_per_key(rows if seen is None else rows.observe(seen[0], n), keys, order)
        kept = kept if seen is None else kept.observe(seen[1], n)
    return outside_rows.unionByName(kept)


def dedupe_log(spark, ts: _dt.datetime, start: _dt.date, end: _dt.date, removed=0) -> DataFrame:
    return etl_log(spark, "DEDUPLICATION", "stock_prices,exchange_rates", ts, removed, "COMPLETED",
                   f"Deduplication completed for backfill period {start.isoformat()} to {end.isoformat()}")
