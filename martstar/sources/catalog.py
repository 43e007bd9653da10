"""A warehouse in Spark's catalog: bucketed facts, published by touched partitions.

The tables are external Parquet tables. ``prices`` is partitioned by year, bucketed
by ``stock_id`` and sorted by date: windows per stock need no shuffle, a filter on
one stock reads one bucket, and Bloom filters skip row groups inside it. Rates
and the record tables are partitioned by year; ``dim_date`` and ``etl_logs`` grow by
appended batches; the other dimensions are replaced as a whole.

Each version of a warehouse is a database of table definitions; the view
``<name>.current`` says which one readers open. A job writes only the partitions
it changes, into new folders, defines the next version over the new and the old
folders together and moves the view last. A reader that has opened a version
keeps it, whatever is published meanwhile, and a lost job leaves the view as it
was. ``CREATE DATABASE`` fails where the version exists, so of two writers of a
version one gives up before it writes anything. The view also names the last
batch of every feed that the version holds, so a replayed batch is recognised.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass
from typing import Callable, Iterable, Mapping, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import FACT_PARTITION, LEAST_BUCKETS, RECORD_TABLES, TABLE_NAMES, Tables, buckets_for, list_names

BATCH = "batch"  # partition of the tables that grow by appended batches


@dataclass(frozen=True)
class Layout:
    partition: Optional[str] = None
    bucket: Optional[str] = None
    sort: Optional[str] = None


LAYOUTS = {
    "prices": Layout(FACT_PARTITION, "stock_id", "date_id"),
    "year_ends": Layout(FACT_PARTITION, None, "stock_id"),
    "rates": Layout(FACT_PARTITION, None, "date_id"),
    "stock_prices": Layout(FACT_PARTITION, None, "date"),
    "exchange_rates": Layout(FACT_PARTITION, None, "date"),
    "dim_date": Layout(BATCH),
    "etl_logs": Layout(BATCH),
}


def layout(name: str) -> Layout:
    return LAYOUTS.get(name, Layout())


def with_partition(name: str, df: DataFrame, batch: int = 0) -> DataFrame:
    """``df`` with the partition column of table ``name``."""
    part = layout(name).partition
    if part == BATCH:
        return df.withColumn(BATCH, F.lit(batch))
    if part is None or part in df.columns:
        return df
    year = (F.col("date_id") / 10000).cast("int") if "date_id" in df.columns else F.year("date")
    return df.withColumn(part, year)


def write_files(spark: SparkSession, name: str, df: DataFrame, path: str, buckets: int, dealt: bool = False) -> None:
    """Write rows of table ``name``, its partition column included, to a new folder.

    Rows that lie ``dealt`` out evenly over tasks stay there: a task writes a file per year.
    """
    lay = layout(name)
    if lay.bucket:
        # one task per bucket, as the writer hashes alike: a bucket has a file per year
        holder = f"writer_{uuid.uuid4().hex}"
        (df.repartition(buckets, lay.bucket).write.partitionBy(lay.partition).bucketBy(buckets, lay.bucket).sortBy(lay.sort)
         .option("path", path).option("maxRecordsPerFile", 5_000_000)
         .option(f"parquet.bloom.filter.enabled#{lay.bucket}", "true").saveAsTable(holder))
        spark.sql(f"DROP TABLE {holder}")  # an external table: its files stay
    elif lay.partition == FACT_PARTITION:
        # AQE sizes and splits the rebalanced partitions, however many rows a year holds
        rows = df if dealt else df.hint("rebalance", lay.partition)
        (rows.sortWithinPartitions(lay.partition, lay.sort)
         .write.option("maxRecordsPerFile", 5_000_000).partitionBy(lay.partition).parquet(path))
    elif lay.partition:
        df.write.partitionBy(lay.partition).parquet(path)
    else:
        df.write.parquet(path)


def year_ends(prices: DataFrame) -> DataFrame:
    """The last row of each stock in each year of a price table with its year column."""
    last = F.max_by(F.struct("date_id", "closing_price"), "date_id").alias("last")
    return prices.groupBy("stock_id", FACT_PARTITION).agg(last).select("stock_id", "last.*", FACT_PARTITION)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def define(spark: SparkSession, db: str, name: str, columns: str, path: str, buckets: int) -> None:
    lay = layout(name)
    parts = f"PARTITIONED BY ({lay.partition})" if lay.partition else ""
    clustered = f"CLUSTERED BY ({lay.bucket}) SORTED BY ({lay.sort}) INTO {buckets} BUCKETS" if lay.bucket else ""
    spark.sql(f"CREATE TABLE {db}.{name} ({columns}) USING parquet {parts} {clustered} LOCATION '{path}'")


def add_partitions(spark: SparkSession, db: str, name: str, folders: dict[str, str]) -> None:
    """Partitions (value -> folder) of a defined table, in one statement."""
    if folders:
        part = layout(name).partition
        spark.sql(f"ALTER TABLE {db}.{name} ADD " + " ".join(
            f"PARTITION ({part}={v}) LOCATION '{p}'" for v, p in sorted(folders.items())))


def written_folders(spark: SparkSession, name: str, path: str) -> dict[str, str]:
    """Partition value -> folder of what ``write_files`` wrote."""
    part = layout(name).partition
    return {n.split("=", 1)[1]: f"{path}/{n}" for n in list_names(spark, path) if n.startswith(f"{part}=")}


def _location(info: str) -> str:
    return re.search(r"^Location: (.*)$", info, re.M)[1].strip()


class Warehouse:
    """A named warehouse: its versions and the one that is current."""

    def __init__(self, spark: SparkSession, name: str, root: str):
        self.spark, self.name, self.root = spark, name, root.rstrip("/")

    def database(self, version: int) -> str:
        return f"{self.name}_v{version}"

    def version(self) -> int:
        """The version that readers open; 0 if nothing was published."""
        if not self.spark.catalog.tableExists(f"{self.name}.current"):
            return 0
        return self.spark.table(f"{self.name}.current").first()["version"]

    def applied(self, feed: str) -> int:
        """The last batch of a feed that the current version holds, -1 if none."""
        if not self.version():
            return -1
        return json.loads(self.spark.table(f"{self.name}.current").first()["applied"]).get(feed, -1)

    def open(self, version: Optional[int] = None) -> Tables:
        """The tables of a version, which stay what they are."""
        n = self.version() if version is None else version
        got: dict = {}
        for name in TABLE_NAMES:
            full = f"{self.database(n)}.{name}"
            if not n or not self.spark.catalog.tableExists(full):
                got[name] = None
                continue
            df, part = self.spark.table(full), layout(name).partition
            if part == FACT_PARTITION and name == "prices":
                years = [int(v) for v in self.folders(n, name)]
                got["prices_by_year"], got["last_year"], got["first_year"] = df, max(years, default=None), min(years, default=None)
                got["buckets"] = self.buckets_of(n, name)
            # the record tables show their year, by which periods are pruned
            got[name] = df if part is None or name in RECORD_TABLES else df.drop(part)
        return Tables(**got)

    def folders(self, version: int, name: str) -> dict[str, str]:
        """Partition value -> folder of a table of a version."""
        db = self.database(version)
        out = {}
        for r in self.spark.sql(f"SHOW PARTITIONS {db}.{name}").collect():
            part, value = r[0].split("=", 1)
            info = self.spark.sql(f"SHOW TABLE EXTENDED IN {db} LIKE '{name}' PARTITION ({part}={value})").first()["information"]
            out[value] = _location(info)
        return out

    def buckets_of(self, version: int, name: str) -> int:
        info = self.spark.sql(f"SHOW TABLE EXTENDED IN {self.database(version)} LIKE '{name}'").first()["information"]
        return int(re.search(r"^Num Buckets: (\d+)$", info, re.M)[1])

    def create(self, t: Tables, buckets: Optional[int] = None,
               derived: Optional[Mapping[str, Callable[[DataFrame], DataFrame]]] = None, dealt: Iterable[str] = ()) -> int:
        """Publish all tables of ``t`` as the first version; the ``derived`` ones are made from
        the prices as they were written, so that the plan of the prices runs once. The rows of
        the tables ``dealt`` lie evenly over tasks."""
        if buckets is None:
            buckets = t.buckets or buckets_for(t.prices.count())
        with self.change(buckets) as c:
            for name in sorted(TABLE_NAMES, key=lambda n: n != "prices"):
                df = getattr(t, name)
                if derived and name in derived:
                    df = derived[name](self.spark.read.schema(t.prices.schema).parquet(c.new["prices"][1]))
                if df is not None and name != "year_ends":
                    c.put(name, df, name in dealt)
        return c.version

    def change(self, buckets: Optional[int] = None) -> "Change":
        return Change(self, buckets)


class Change:
    """The next version in the making; published when the ``with`` block ends well.

    Nothing is copied: what is not changed is defined over the folders it lies in.
    """

    def __init__(self, warehouse: Warehouse, buckets: Optional[int] = None):
        self.w, self.spark = warehouse, warehouse.spark
        self.base = warehouse.version()
        self.version = self.base + 1
        self.db = warehouse.database(self.version)
        self.new: dict[str, tuple[str, str, dict[str, str]]] = {}  # table -> (columns, folder, partitions)
        self.written: list[tuple[str, str]] = []  # (table, folder): all that was written
        self.applied: dict[str, int] = {}  # feed -> batch that this version brings
        self.buckets = buckets

    def __enter__(self) -> "Change":
        home = f"{self.w.root}/_databases"
        self.spark.sql(f"CREATE DATABASE {self.db} LOCATION '{home}/{self.db}'")  # fails if another writer has it
        self.tables = self.w.open(self.base) if self.base else Tables(*[None] * 5)
        if self.base:
            for name in TABLE_NAMES:
                old = f"{self.w.database(self.base)}.{name}"
                if self.spark.catalog.tableExists(old):
                    info = self.spark.sql(f"SHOW TABLE EXTENDED IN {self.w.database(self.base)} LIKE '{name}'").first()["information"]
                    if layout(name).bucket:
                        self.buckets = self.w.buckets_of(self.base, name)
                    parts = self.w.folders(self.base, name) if layout(name).partition else {}
                    self.new[name] = (_ddl(self.spark.table(old)), _location(info), parts)
        return self

    def _write(self, name: str, df: DataFrame, dealt: bool = False) -> str:
        path = f"{self.w.root}/{name}/v{self.version}-{uuid.uuid4().hex[:8]}"
        write_files(self.spark, name, df, path, self.buckets or LEAST_BUCKETS, dealt)
        self.written.append((name, path))
        return path

    def put(self, name: str, df: DataFrame, dealt: bool = False) -> None:
        """A table as a whole."""
        df = with_partition(name, df, self.version)
        path = self._write(name, df, dealt)
        self.new[name] = (_ddl(df), path, written_folders(self.spark, name, path) if layout(name).partition else {})
        if name == "prices":  # from what was written, not from its plan again
            ends = year_ends(self.spark.read.parquet(path)) if self.new[name][2] else year_ends(df.limit(0))
            self.put("year_ends", ends.drop(FACT_PARTITION))

    def put_partitions(self, name: str, df: DataFrame, touched: Iterable[int]) -> None:
        """New content of the ``touched`` partitions; those that ``df`` has no row of go."""
        touched = {str(v) for v in touched}
        df = with_partition(name, df)
        path = self._write(name, df)
        folders = written_folders(self.spark, name, path)
        stray = set(folders) - touched
        if stray:
            raise ValueError(f"rows of partitions {sorted(stray)} of {name} are not among the touched ones")
        columns, home, parts = self.new[name]
        self.new[name] = (columns, home, {**{v: p for v, p in parts.items() if v not in touched}, **folders})
        if name == "prices":
            if folders:
                self.put_partitions("year_ends", year_ends(self.spark.read.parquet(path)).drop(FACT_PARTITION), touched)
            else:
                self.drop_partitions("year_ends", touched)

    def drop_partitions(self, name: str, gone: Iterable[int]) -> None:
        """Partitions leave the table; their files are not read."""
        gone = {str(v) for v in gone}
        columns, home, parts = self.new[name]
        self.new[name] = (columns, home, {v: p for v, p in parts.items() if v not in gone})
        if name == "prices":
            self.drop_partitions("year_ends", gone)

    def append(self, name: str, df: DataFrame) -> None:
        """Rows of one more batch of a table that grows by batches; one batch a version."""
        old = self.new.get(name)
        if old is None:
            self.put(name, df)
            return
        columns, home, parts = old
        if str(self.version) in parts:
            raise ValueError(f"{name} has its batch of version {self.version}")
        path = self._write(name, with_partition(name, df, self.version).select(*re.findall("`([^`]+)`", columns)))
        self.new[name] = (columns, home, {**parts, **written_folders(self.spark, name, path)})

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            self.spark.sql(f"DROP DATABASE {self.db} CASCADE")  # definitions only
            return
        for name, (columns, path, parts) in self.new.items():
            define(self.spark, self.db, name, columns, path, self.buckets or LEAST_BUCKETS)
            add_partitions(self.spark, self.db, name, parts)
            if parts:  # sizes by which the planner chooses joins; only file lists are read
                self.spark.sql(f"ANALYZE TABLE {self.db}.{name} COMPUTE STATISTICS NOSCAN")
        if self.w.version() != self.base:
            self.spark.sql(f"DROP DATABASE {self.db} CASCADE")
            raise RuntimeError(f"{self.w.name} was published by another writer")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.w.name} LOCATION '{self.w.root}/_databases/{self.w.name}'")
        applied = json.loads(self.spark.table(f"{self.w.name}.current").first()["applied"]) if self.base else {}
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.w.name}.current AS SELECT {self.version} AS version, "
                       f"'{json.dumps({**applied, **self.applied})}' AS applied")


def refresh_statistics(spark: SparkSession, database: str, tables: Iterable[str] = ("prices", "rates")) -> DataFrame:
    """``ANALYZE`` the tables for all columns; what the optimizer knows then.

    (table_name, row_count, column_name, min, max, null_count) as text; cost-based
    joins (``spark.sql.cbo.enabled``) plan by these figures.
    """
    out = []
    for name in tables:
        full = f"{database}.{name}"
        spark.sql(f"ANALYZE TABLE {full} COMPUTE STATISTICS FOR ALL COLUMNS")
        info = spark.sql(f"SHOW TABLE EXTENDED IN {database} LIKE '{name}'").first()["information"]
        rows = int(re.search(r"(\d+) rows", info)[1])
        for c in spark.table(full).columns:
            known = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {full} `{c}`").collect()}
            out.append((name, rows, c, *[None if known.get(k) in (None, "NULL") else known[k] for k in ("min", "max", "num_nulls")]))
    return spark.createDataFrame(out, "table_name string, row_count long, column_name string, min string, max string, null_count string")
