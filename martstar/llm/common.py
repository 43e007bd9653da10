"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martstar.session import checkpoint_dir

LAST_RANK = 2**63 - 1  # the rank of a null id: after all others

# rows per Arrow batch sent to Python; texts can be long, so batches are short
ARROW_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def python_workers(spark: SparkSession) -> None:
    """Settings of Python tasks: short Arrow batches, and this package on their path.

    The path only helps where executors see the driver's code folder; elsewhere
    the package is shipped with ``--py-files`` as usual.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def keep(df: DataFrame) -> DataFrame:
    """Cut the lineage: a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def rank(col: str | Column) -> Column:
    """The order of ids, nulls last."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("long"), F.lit(LAST_RANK))


def id_text(col: str) -> Column:
    """An id for a trip through pandas, which would make numbers with nulls floats."""
    return F.col(col).cast("long").cast("string")


def with_id(df: DataFrame, name: str = "doc_id") -> DataFrame:
    return df.withColumn(name, F.col(name).cast("long"))


def text_of(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fold(col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; the empty string for a null id."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def named(docs: DataFrame, id_col: str, text_col: str, digest: Column | None = None) -> DataFrame:
    """(doc, r, sha): rows as a struct beside the rank of their id and the digest of
    their text, so that no name of theirs clashes with one used here."""
    sha = F.sha2(text_of(text_col).cast("binary"), 256) if digest is None else digest
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), rank(id_col).alias("r"), sha.alias("sha"))


def one_each(rows: DataFrame) -> DataFrame:
    """One of the ``named`` rows that have the same id and digest."""
    w = Window.partitionBy("r", "sha").orderBy(F.lit(1))
    return rows.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once.

    A column used inside a higher-order function is otherwise computed again
    for every element when Catalyst merges projections.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
