"""RANK() within groups that grow with the data (all stocks of a day).

A window by group sorts a whole group in one task. That is done only while a count
says that no group has more than ``whole`` rows; beyond, groups are cut into ranges
of their value first:

1. ``parts`` values of each group, drawn by a hash (the least of each slot, combined
   before the shuffle), are its cut points;
2. every row falls into an open range between two cuts or on a cut. A value that
   many rows hold is drawn as a cut, so ranges stay near 1/parts of the group;
3. counts per (group, range), again combined before the shuffle, give the number
   of rows in the ranges before;
4. one shuffle by (group, range) ranks the rows inside. Rows on a cut are ties of
   each other, whose rank there is 1, so they are spread over many tasks.

Equal values are always in one range, so ranks are exact whatever was drawn.
"""

from __future__ import annotations

from typing import Callable, Optional, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTS = 16
WHOLE = 1_000_000


def grouped_rank(rows: DataFrame, group: str, value: str, name: str, spread: Sequence[str],
                 parts: int = PARTS, few: Callable[[DataFrame], DataFrame] = lambda df: df,
                 counted: Optional[DataFrame] = None, whole: int = WHOLE) -> DataFrame:
    """``rows`` with ``name`` = RANK() OVER (PARTITION BY group ORDER BY value DESC NULLS FIRST).

    ``spread``: columns whose hash deals out ties. ``few``: what to do with tables
    of one row per group before a join, a broadcast hint where groups are bounded.
    ``counted``: the same rows from a shorter plan, for cuts and counts. ``whole``: rows
    that one task may sort; both ways give the same ranks.
    """
    v = F.col(value)
    counted = (rows if counted is None else counted).select(group, value, *spread)
    most = counted.groupBy(group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= whole:
        return rows.withColumn(name, F.rank().over(Window.partitionBy(group).orderBy(v.desc_nulls_first())))
    drawn = (counted.where(v.isNotNull())
             .groupBy(group, F.pmod(F.xxhash64(F.lit("slot"), *spread), F.lit(parts)).alias("_slot"))
             .agg(F.min_by(value, F.xxhash64(*spread)).alias("_cut")))
    cuts = drawn.groupBy(group).agg(F.collect_set("_cut").alias("_cuts")).withColumnRenamed(group, "_group")
    same = F.col(group).eqNullSafe(F.col("_group"))

    def placed(df: DataFrame) -> DataFrame:
        """With ``_range``: -1 for nulls, odd numbers for cuts, even ones between, highest values first."""
        above = F.size(F.filter("_cuts", lambda c: c > v))
        at = F.array_contains("_cuts", v).cast("int")
        return (df.join(few(cuts), same, "left")
                .withColumn("_range", F.when(v.isNull(), F.lit(-1)).otherwise(2 * above + at)).drop("_group", "_cuts"))

    sizes = placed(counted).groupBy(group, "_range").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (sizes.withColumn("_before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
              .groupBy(group).agg(F.map_from_entries(F.collect_list(F.struct("_range", "_before"))).alias("_before"))
              .withColumnRenamed(group, "_group"))
    ties = F.col("_range") % 2 != 0  # -1 too
    deal = F.when(ties, F.pmod(F.xxhash64(*spread), F.lit(parts))).otherwise(0)
    inside = Window.partitionBy(group, "_range", "_deal").orderBy(v.desc_nulls_first())
    ranked = placed(rows).withColumn("_deal", deal).withColumn("_rank", F.rank().over(inside))
    return (ranked.join(few(before), same)
            .withColumn(name, (F.col("_rank") + F.element_at("_before", F.col("_range"))).cast("int"))
            .drop("_group", "_rank", "_range", "_deal", "_before"))

