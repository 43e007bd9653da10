"""The warehouse as a record of DataFrames, plus Parquet read/write.

Facts are stored partitioned by ``year`` (derived from ``date_id``) and sorted
by key inside each file, so date filters prune directories and row groups.
Dimensions are small by construction (calendar days, listed symbols,
currency codes) and are stored unpartitioned.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, fields, replace
from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S

PAIR = ("USD", "GBP")


@dataclass(frozen=True)
class Tables:
    dim_stocks: DataFrame
    dim_date: DataFrame
    dim_currency: DataFrame
    prices: DataFrame  # fact_stock_prices
    rates: DataFrame  # fact_currency_rates
    stock_prices: Optional[DataFrame] = None  # backfill table, natural keys
    exchange_rates: Optional[DataFrame] = None
    etl_logs: Optional[DataFrame] = None
    year_ends: Optional[DataFrame] = None
    # of a written warehouse: the price fact with its year partition, and its last year
    prices_by_year: Optional[DataFrame] = None
    last_year: Optional[int] = None
    first_year: Optional[int] = None
    buckets: Optional[int] = None  # of the price fact; rows chosen from it lie in the same ones

    def with_(self, **kw) -> "Tables":
        if "prices" in kw:  # another fact is not the one on disk
            kw = {"prices_by_year": None, "last_year": None, "first_year": None, "year_ends": None, **kw}
        return replace(self, **kw)

    def prices_where(self, low=None, high=None) -> DataFrame:
        """Prices with ``low <= date_id <= high``; whole years are pruned where
        the fact is partitioned. Bounds are ids or scalar subqueries."""
        def lit(v):
            return v if isinstance(v, Column) else F.lit(v)

        def year(v):
            return F.floor(lit(v) / 10000).cast("int")

        df = self.prices if self.prices_by_year is None else self.prices_by_year
        if low is not None and low is high:
            cond, years = F.col("date_id") == lit(low), F.col(FACT_PARTITION) == year(low)
        else:
            cond = years = F.lit(True)
            if low is not None:
                cond, years = F.col("date_id") >= lit(low), F.col(FACT_PARTITION) >= year(low)
            if high is not None:
                cond, years = cond & (F.col("date_id") <= lit(high)), years & (F.col(FACT_PARTITION) <= year(high))
        if self.prices_by_year is None:
            return df.where(cond)
        return df.where(years & cond).drop(FACT_PARTITION)


FACT_PARTITION = "year"
BUCKET_ROWS, MOST_BUCKET_ROWS = 250_000, 1_250_000
DIRECT_BUCKETS = 200  # a shuffle to more (spark.shuffle.sort.bypassMergeThreshold) holds a map's rows in memory first
LEAST_BUCKETS = 8
RECORD_TABLES = ("stock_prices", "exchange_rates")
TABLE_SCHEMAS = {"dim_stocks": S.DIM_STOCKS, "dim_date": S.DIM_DATE, "dim_currency": S.DIM_CURRENCY,
            "prices": S.FACT_STOCK_PRICES, "rates": S.FACT_CURRENCY_RATES, "stock_prices": S.STOCK_PRICES,
            "exchange_rates": S.EXCHANGE_RATES, "etl_logs": S.ETL_LOGS, "year_ends": S.YEAR_ENDS}
TABLE_NAMES = [f.name for f in fields(Tables) if f.name in TABLE_SCHEMAS]


def buckets_for(rows: int) -> int:
    """Buckets of a table: a task that sorts one, or joins it with a row per stock, stays in memory."""
    return max(LEAST_BUCKETS, min(DIRECT_BUCKETS, math.ceil(rows / BUCKET_ROWS)), math.ceil(rows / MOST_BUCKET_ROWS))


def write_warehouse(t: Tables, path: str, mode: str = "overwrite") -> None:
    """Write every present table as Parquet under ``path/<name>``.

    Facts get a ``year`` partition column (``date_id // 10000``) and are
    clustered by key within each partition.
    """
    for name in TABLE_NAMES:
        df = getattr(t, name)
        if df is None:
            continue
        out = f"{path.rstrip('/')}/{name}"
        if name in ("prices", "rates"):
            keys = ["stock_id", "date_id"] if name == "prices" else [
                "from_currency_id", "to_currency_id", "date_id"]
            # hash on (year, first key) so one year is spread over many tasks;
            # sorted by date inside each file so date predicates (the common
            # filter: latest day, last N days, a backfill period) skip row groups
            (df.withColumn(FACT_PARTITION, (F.col("date_id") / 10000).cast("int"))
               .repartition(FACT_PARTITION, keys[0])
               .sortWithinPartitions(FACT_PARTITION, "date_id", *[k for k in keys if k != "date_id"])
               .write.mode(mode).option("maxRecordsPerFile", 5_000_000)
               .option("partitionOverwriteMode", "static")  # a full rewrite leaves no old year
               .partitionBy(FACT_PARTITION).parquet(out))
        elif name in RECORD_TABLES:
            # record-level tables grow with the input: partitioned by year so a
            # period filter prunes directories; AQE sizes and splits the
            # rebalanced partitions, however many rows a year holds
            (df.withColumn(FACT_PARTITION, F.year("date"))
               .hint("rebalance", FACT_PARTITION)
               .sortWithinPartitions(FACT_PARTITION, "date")
               .write.mode(mode).option("maxRecordsPerFile", 5_000_000)
               .option("partitionOverwriteMode", "static")  # a full rewrite leaves no old year
               .partitionBy(FACT_PARTITION).parquet(out))
        else:
            df.write.mode(mode).parquet(out)


def period_predicate(df: DataFrame, col: str, start, end):
    """``col BETWEEN start AND end``, plus the same range on the ``year``
    partition column when the table has one, so whole years are pruned."""
    cond = F.col(col).between(F.lit(start), F.lit(end))
    if FACT_PARTITION in df.columns:
        cond = F.col(FACT_PARTITION).between(F.lit(start.year), F.lit(end.year)) & cond
    return cond


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def rename_path(spark: SparkSession, src: str, dst: str) -> bool:
    jvm = spark.sparkContext._jvm
    s, d = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    return s.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(s, d)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, none if it does not exist."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def listing(spark: SparkSession, path: str) -> list[str]:
    """Every file under a path as name, length and modification time."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    out = []
    while files.hasNext():
        f = files.next()
        out.append(f"{f.getPath().toString()}:{f.getLen()}:{f.getModificationTime()}")
    return sorted(out)


def read_warehouse(spark: SparkSession, path: str) -> Tables:
    """Read a warehouse written by :func:`write_warehouse`."""
    base = path.rstrip("/")
    got = {}
    for name in TABLE_NAMES:
        p = f"{base}/{name}"
        if not path_exists(spark, p):
            got[name] = None
            continue
        try:
            df = spark.read.parquet(p)
        except Exception as e:  # an empty table has no file to take a schema from
            if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            df = empty(spark, TABLE_SCHEMAS[name])
        if FACT_PARTITION in df.columns and name in ("prices", "rates"):
            if name == "prices":
                years = [int(n.split("=")[1]) for n in list_names(spark, p) if n.startswith(f"{FACT_PARTITION}=")
                         and n.split("=")[1].isdigit()]
                got["prices_by_year"], got["last_year"] = df, max(years, default=None)
                got["first_year"] = min(years, default=None)
            df = df.drop(FACT_PARTITION)
        got[name] = df
    return Tables(**got)


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def empty_tables(spark: SparkSession) -> Tables:
    return Tables(
        dim_stocks=empty(spark, S.DIM_STOCKS),
        dim_date=empty(spark, S.DIM_DATE),
        dim_currency=empty(spark, S.DIM_CURRENCY),
        prices=empty(spark, S.FACT_STOCK_PRICES),
        rates=empty(spark, S.FACT_CURRENCY_RATES),
        stock_prices=empty(spark, S.STOCK_PRICES),
        exchange_rates=empty(spark, S.EXCHANGE_RATES),
        etl_logs=empty(spark, S.ETL_LOGS),
    )
