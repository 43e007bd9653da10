"""Exact dedup with a heavy-hitter split (built-in functions only).

1. every text is normalised (runs of ASCII white space become one space) and
   reduced to its SHA-256; the small (id, digest) table is checkpointed;
2. a Misra-Gries summary with ``counters`` counters (``freqItems``) names every
   digest held by more than 1/counters of the rows, possibly with false ones;
3. one aggregate over the candidates verifies them: exact count and first row.
   At most ``counters`` winners remain, so they may be broadcast, and their rows
   are resolved on the map side, however large the group;
4. the remaining digests, none of them frequent, take an ordinary shuffle.

Only ids and digests are shuffled. Rows with the same id and text are told
apart by their place in the checkpointed table, so exactly one of them stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martstar.llm.common import keep, named, one_each, rank, text_of

COUNTERS = 1024
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: str):
    return F.regexp_replace(text_of(text), SPACES, " ")


def digest_of(text: str):
    return F.sha2(normalised(text).cast("binary"), 256)


def winners(base: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified frequent digests: (digest, n, first); at most ``counters`` rows."""
    names = (base.select(F.col("digest").alias("d")).freqItems(["d"], 1.0 / counters)
             .select(F.explode("d_freqItems").alias("digest")).distinct())
    return (base.join(F.broadcast(names), "digest")
            .groupBy("digest")
            .agg(F.count(F.lit(1)).alias("n"), F.min("who").alias("first"))
            .where("n > 1"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Nulls: a null text equals the empty text; a null id ranks last and is only
    kept in a group that has no other. Repeated rows: one of them stays. An
    empty table gives an empty result.
    """
    base = keep(docs.select(F.col(id_col).alias("doc_id"), digest_of(text_col).alias("digest"),
                            F.monotonically_increasing_id().alias("uid"))
                .select("doc_id", "digest", "uid",
                        F.struct(rank("doc_id").alias("r"), F.col("uid").alias("u"),
                                 F.col("doc_id").alias("id")).alias("who")))
    heavy = keep(winners(base, counters))
    marked = base.drop("who").join(F.broadcast(heavy), "digest", "left")
    light = base.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    groups = keep(light.groupBy("digest")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("who").alias("first"))
                  .where("n > 1"))
    rest = light.drop("who").join(groups, "digest", "left")
    both = marked.where(F.col("n").isNotNull()).unionByName(rest)
    single = F.col("n").isNull()
    return both.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("first.u") == F.col("uid"))).alias("kept"),
        F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged.

    The dropped copies are taken out by (id, digest), so texts move once. Where
    a row that stays is repeated with its id, one of the repeats stays.
    """
    gone = (exact_groups(docs, id_col, text_col, counters)
            .groupBy(rank("doc_id").alias("r"), F.col("text_sha256").alias("sha"))
            .agg(F.max("kept").alias("kept")).where("not kept"))
    rows = named(docs, id_col, text_col, digest_of(text_col))
    # the window of one_each has the keys of the join, so texts move once
    return one_each(rows.join(gone, ["r", "sha"], "left_anti")).select("doc.*")
