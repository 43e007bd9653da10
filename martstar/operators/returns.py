"""Daily returns (ETL step) and rolling metrics.

Windows are partitioned by stock and ordered by date, so they run in
parallel over stocks and each partition holds one stock's trading days.
"""

from __future__ import annotations

import datetime as _dt
from typing import Optional

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.numeric import rounded_mean, scaled
from ..tables import Tables
from .common import bounded


def _dated(t: Tables) -> DataFrame:
    return t.prices.join(bounded(t.dim_date.select("date_id", "date_value")), "date_id")


def return_pct(close, prev) -> "F.Column":
    """ROUND((close - prev) / prev * 100, 6) in decimal arithmetic.

    A zero previous close gives NULL (``try_divide``) and a value beyond
    DECIMAL(8,6) gives NULL (``try_cast``) instead of failing the whole job.
    """
    return F.round(F.try_divide(close - prev, prev) * 100, 6).try_cast(S.RETURN_PCT)


def daily_returns(t: Tables, history: str = "all",
                  as_of_ts: Optional[_dt.datetime] = None) -> DataFrame:
    """Fill NULL ``daily_return`` values of the price fact.

    ``history='all'`` (default) compares each row with the previous trading
    row of the stock over the full history; ``'null_only'`` reproduces the
    reference literally: the window only sees rows whose return is NULL, so
    an incremental load compares a new day with the stock's first day.
    Returns the whole fact table; changed rows get ``updated_at = as_of_ts``.
    """
    rows = _dated(t)
    w = Window.partitionBy("stock_id").orderBy("date_value")
    if history == "all":
        calc = return_pct(F.col("closing_price"), F.lag("closing_price").over(w))
        out = rows.withColumn("_calc", F.when(F.col("daily_return").isNull(), calc))
    elif history == "null_only":
        # the literal statement's window only sees NULL-return rows: the
        # previous row of a NULL row is the last earlier NULL row (one pass)
        prev_null = F.last(F.when(F.col("daily_return").isNull(), F.col("closing_price")), ignorenulls=True) \
            .over(w.rowsBetween(Window.unboundedPreceding, -1))
        out = rows.withColumn("_calc", F.when(F.col("daily_return").isNull(),
                                              return_pct(F.col("closing_price"), prev_null)))
    else:
        raise ValueError("history must be 'all' or 'null_only'")
    stamp = F.lit(as_of_ts).cast("timestamp") if as_of_ts else F.current_timestamp()
    changed = F.col("daily_return").isNull() & F.col("_calc").isNotNull()
    return out.select(
        *[F.col(c) for c in t.prices.columns if c not in ("daily_return", "updated_at")],
        F.coalesce(F.col("daily_return"), F.col("_calc")).alias("daily_return"),
        F.when(changed, stamp).otherwise(F.col("updated_at")).alias("updated_at"),
    ).select(*t.prices.columns)


def fill_returns(rows: DataFrame, earlier: DataFrame, as_of_ts: _dt.datetime) -> DataFrame:
    """NULL returns of ``rows`` (price rows of whole years) against the row before each.

    ``earlier`` holds one row per stock for every year outside ``rows``, its last
    (stock_id, date_id, closing_price), so the first row of a year finds the row
    before it without the history. Equal to ``daily_returns`` over all rows.
    """
    both = rows.withColumn("_own", F.lit(True)).unionByName(
        earlier.select("stock_id", "date_id", "closing_price").withColumn("_own", F.lit(False)), allowMissingColumns=True)
    prev = F.lag("closing_price").over(Window.partitionBy("stock_id").orderBy("date_id"))
    calc = F.when(F.col("daily_return").isNull(), return_pct(F.col("closing_price"), prev))
    out = both.withColumn("_calc", calc).where("_own")
    return out.withColumns({
        "daily_return": F.coalesce("daily_return", "_calc"),
        "updated_at": F.when(F.col("_calc").isNotNull(), F.lit(as_of_ts).cast("timestamp")).otherwise(F.col("updated_at")),
    }).select(*rows.columns)


def return_overflows(t: Tables) -> DataFrame:
    """Rows whose return does not fit DECIMAL(8,6) (a quality issue, not a crash)."""
    rows = _dated(t)
    w = Window.partitionBy("stock_id").orderBy("date_value")
    prev = F.lag("closing_price").over(w)
    raw = F.round(F.try_divide(F.col("closing_price") - prev, prev) * 100, 6)
    return (rows.select("stock_id", "date_id", raw.alias("raw_return"))
            .where(F.col("raw_return").isNotNull() & F.col("raw_return").try_cast(S.RETURN_PCT).isNull()))


def moving_metrics(t: Tables, price_n: int = 20, volume_n: int = 10,
                   date: Optional[_dt.date] = None, digits: int = 6) -> DataFrame:
    """Moving average of the close over ``price_n`` rows and of the volume over
    ``volume_n`` rows, also as one JSON column.

    The window runs over the full history and the date filter is applied
    afterwards (filtering first would average each row with itself).
    """
    rows = _dated(t)
    w = Window.partitionBy("stock_id").orderBy("date_value")
    wp, wv = w.rowsBetween(-(price_n - 1), 0), w.rowsBetween(-(volume_n - 1), 0)
    c, v = F.col("closing_price"), F.col("volume")
    out = rows.select(
        "stock_id", "date_id", "date_value",
        rounded_mean(F.sum(scaled(c, 4)).over(wp), F.count(c).over(wp), 4, digits)
        .alias(f"moving_avg_{price_n}d"),
        rounded_mean(F.sum(scaled(v, 0)).over(wv), F.count(v).over(wv), 0, digits)
        .alias(f"avg_volume_{volume_n}d"))
    if date is not None:
        out = out.where(F.col("date_value") == F.lit(date))
    return out.withColumn("additional_metrics", F.to_json(F.struct(
        f"moving_avg_{price_n}d", f"avg_volume_{volume_n}d"))).drop("date_value")
