"""Landing directory: JSON record files written by the collectors.

Two layouts are read together. A collector's file holds one JSON document, an
array of records or a single record, possibly over many lines. A run written
by :func:`write_landing` is a folder ``run_ts=...`` of JSON lines, so large runs
are written and read in parallel. Files are read as all-text columns (nothing
is lost before validation), broken files come back as ``_corrupt_record`` rows
instead of failing the read, and the source file plus the position in it are
kept so that the last record of a batch can win.
"""

from __future__ import annotations

import datetime as _dt
from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.checks import errors_array, rule

STOCK_FIELDS = ("symbol", "data_date", "open_price", "high_price", "low_price", "close_price", "volume")
RATE_FIELDS = ("from_currency", "to_currency", "data_date", "exchange_rate")


RUN_FILE = r"/run_ts=[^/]+/[^/]+$"


def record_schema(kind: str):
    """Text columns; a stock's volume as variant, which tells 12.7 from "12.7"."""
    schema = S.LANDING_STOCK if kind == "stocks" else S.LANDING_RATE
    return T.StructType([T.StructField(f.name, T.VariantType(), True) if f.name == "volume" else f
                         for f in schema.fields])


def json_options(reader, kind: str, lines: bool):
    return (reader.schema(record_schema(kind)).option("multiLine", not lines).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("pathGlobFilter", "*.json").option("recursiveFileLookup", True))


def with_volume_text(df: DataFrame) -> DataFrame:
    """``volume`` as text, and whether the JSON value was a number."""
    if "volume" not in df.columns or not isinstance(df.schema["volume"].dataType, T.VariantType):
        return df
    kind = F.schema_of_variant("volume")
    return (df.withColumn("_volume_number", F.coalesce(~kind.isin("STRING", "BOOLEAN", "VOID"), F.lit(False)))
            .withColumn("volume", F.when(kind != "VOID", F.try_variant_get("volume", "$", "string"))))


def read_landing(spark: SparkSession, path: str, kind: str, lines: Optional[bool] = None) -> DataFrame:
    """All ``*.json`` files under ``path`` (``kind`` = 'stocks' or 'exchange').

    ``lines`` reads one layout only (True: JSON lines, False: a document per
    file); by default files in a ``run_ts=...`` folder are lines and all others
    documents. ``_pos`` orders the records of a file: the offset of the part of
    the file a task read, then the place in it.
    """
    def read(as_lines: bool) -> DataFrame:
        return (json_options(spark.read, kind, as_lines).json(path)
                .withColumn("_file", F.col("_metadata.file_path"))
                .withColumn("_pos", F.struct(F.col("_metadata.file_block_start").alias("block"),
                                             F.monotonically_increasing_id().alias("row"))))

    if lines is not None:
        return with_volume_text(read(lines))
    run = F.col("_file").rlike(RUN_FILE)
    return with_volume_text(read(True).where(run).unionByName(read(False).where(~run)))


def _num_ok(c: Column, kind) -> Column:
    """The table can hold it: a finite number in the column's range."""
    return F.trim(c).try_cast("double").isNotNull() & F.trim(c).try_cast(kind).isNotNull()


def _int_ok(df: DataFrame, c: Column) -> Column:
    """``int(x)``: integer text, or any JSON number."""
    text = F.trim(c).rlike(r"^[+-]?[0-9]+$") & F.trim(c).try_cast("bigint").isNotNull()
    if "_volume_number" not in df.columns:
        return text
    return text | (F.col("_volume_number") & F.trim(c).try_cast("double").try_cast("bigint").isNotNull())


def landing_errors(df: DataFrame, kind: str) -> Column:
    """Required fields present and non-null, date and numeric fields fit for the table."""
    fields = STOCK_FIELDS if kind == "stocks" else RATE_FIELDS
    rules = [rule(F.col("_corrupt_record").isNotNull(), "unreadable record")]
    rules += [rule(F.col(f).isNull(), f"missing {f}") for f in fields]
    rules.append(rule(F.col("data_date").isNotNull() & F.trim("data_date").try_cast("date").isNull(),
                      "data_date is not a date"))
    if kind == "stocks":
        rules += [rule(F.col(f).isNotNull() & ~_num_ok(F.col(f), S.PRICE), f"{f} is not a number")
                  for f in ("open_price", "high_price", "low_price", "close_price")]
        rules.append(rule(F.col("volume").isNotNull() & ~_int_ok(df, F.col("volume")), "volume is not an integer"))
    else:
        rules.append(rule(F.col("exchange_rate").isNotNull() & ~_num_ok(F.col("exchange_rate"), S.RATE),
                          "exchange_rate is not a number"))
    return errors_array(*rules)


def split_valid(df: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(valid records, rejects with their ``errors``) in one pass over the input."""
    checked = df.withColumn("errors", landing_errors(df, kind))
    ok = F.size("errors") == 0
    return checked.where(ok).drop("errors", "_corrupt_record", "_volume_number"), checked.where(~ok)


def write_landing(df: DataFrame, path: str, kind: str, run_ts: Optional[_dt.datetime] = None) -> str:
    """Write one run's records under ``path/<kind>/run_ts=<ts>/`` as JSON lines.

    Spark's commit protocol publishes the files only when the job commits,
    which replaces the reference's write-temp-then-rename. ``read_landing``
    knows the layout by the folder's name.
    """
    ts = (run_ts or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y%m%dT%H%M%SZ")
    out = f"{path.rstrip('/')}/{kind}/run_ts={ts}"
    fields = STOCK_FIELDS + ("source", "created_at") if kind == "stocks" else RATE_FIELDS + ("source", "created_at")
    cols = [F.col(c).cast("string").alias(c) for c in fields if c in df.columns]
    df.select(*cols).write.mode("errorifexists").json(out)
    return out
