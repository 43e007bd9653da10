"""Sharding by histogram sort: shards of near equal bytes, one exchange.

The rows have a total order (MD5 of the text, id, row number), so equal texts lie
side by side. A shard is a range of that order.

1. The rows are written once with their keys, so that a task that runs again
   meets the same keys.
2. Every round counts, in one pass over (key, size), the exact bytes and rows
   below a sorted list of candidate keys and draws new candidates from between
   them: map-side sums and minima, a fixed number per candidate. A splitter is
   found when a candidate lies within its tolerance, or when at most one row is
   left between the candidates around its target; the nearer one is taken.
   Elsewhere the keys drawn between the two are the next round's candidates.
3. Beside the splitters of the shards, looser ones by number of rows cut shards
   into parts that one task can sort. The counts below the final splitters
   give every part its shard and its first slot, so one exchange by part and a
   sort inside it finish the work.

The driver holds a few dozen keys per splitter, never one per row.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from dataclasses import dataclass, field
from fractions import Fraction
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martstar.llm.common import rank, text_of
from martstar.session import scratch_path

SHARDS = 16
TOLERANCE = 0.0        # of a shard's bytes; 0: no other place of a splitter is nearer
PART_ROWS = 1_000_000  # rows that one task sorts, roughly
LEAST_PARTS = 64
PART_TOLERANCE = 0.25  # of a part's rows
FIRST_DRAWS = 1024     # candidates of the first round
DRAWS = 16             # candidates drawn between two others later

START, END = "", "~"   # before and behind all keys


def size_of(text: str) -> Column:
    """UTF-8 bytes, and one for the row itself."""
    return F.octet_length(text_of(text)).cast("long") + F.lit(1)


def _digits(c: Column) -> Column:
    """A long as 16 characters that sort as it does."""
    return F.lpad(F.hex(c.bitwiseXOR(F.lit(-(2**63)))), 16, "0")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, size, doc): the rows and their keys, written to the shared folder."""
    spark = docs.sparkSession
    path = scratch_path(spark, f"shards-{uuid.uuid4().hex}")
    docs.select(
        F.concat(F.md5(text_of(text_col).cast("binary")), _digits(rank(id_col)),
                 _digits(F.monotonically_increasing_id())).alias("key"),
        size_of(text_col).alias("size"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
    ).write.parquet(path)
    return spark.read.parquet(path)


@dataclass
class Counts:
    """Exact bytes and rows below each of some sorted keys."""

    keys: list[str]
    bytes: list[int]
    rows: list[int]


@dataclass
class Target:
    """A splitter with ``at`` bytes (or rows) below it, give or take ``slack``."""

    measure: str
    at: Fraction
    slack: Fraction
    found: str | None = None
    near: list[str] = field(default_factory=list)  # the candidates around it

    def look(self, counts: Counts, drawn: dict[int, list[str]]) -> None:
        below = getattr(counts, self.measure)
        hi = min(bisect_right(below, self.at), len(below) - 1)  # the first with more than the target below it
        lo = max(hi - 1, 0)
        off, best = min((abs(below[i] - self.at), i) for i in (lo, hi))
        if off <= self.slack or counts.rows[hi] - counts.rows[lo] <= 1:
            self.found = counts.keys[best]
            self.near = [self.found]
        else:
            self.near = [counts.keys[lo], *drawn[hi], counts.keys[hi]]


def _count(rows: DataFrame, keys: list[str], draws: int, turn: int) -> tuple[Counts, dict[int, list[str]]]:
    """Counts below ``keys``; for each place before a key, some keys of the rows there."""
    probes = np.array(keys, dtype=object)

    @F.pandas_udf("int")
    def place(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(probes, key.to_numpy(), side="right"))

    got = (rows.select("key", "size", place("key").alias("place"), F.xxhash64(F.lit(turn), "key").alias("draw"))
           .groupBy("place", F.pmod("draw", F.lit(draws)).alias("slot"))
           .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
                F.min_by("key", "draw").alias("some"), F.max("key").alias("last")).collect())
    sums = {"bytes": [0] * len(keys), "rows": [0] * len(keys)}
    drawn: dict[int, set[str]] = {}
    last: dict[int, str] = {}
    for r in got:
        sums["bytes"][r.place] += r.bytes
        sums["rows"][r.place] += r.rows
        drawn.setdefault(r.place, set()).add(r.some)
        last[r.place] = max(last.get(r.place, START), r.last)
    counts = Counts(keys, list(accumulate(sums["bytes"])), list(accumulate(sums["rows"])))
    # with its last row among them, the keys drawn divide any place of two rows or more
    return counts, {p: sorted(drawn[p] | {last[p]}) for p in drawn}


def splitters(rows: DataFrame, targets_of, first_draws: int = FIRST_DRAWS,
              draws: int = DRAWS) -> tuple[list[Target], Counts]:
    """The targets that ``targets_of(bytes, rows)`` names, all found, and the counts below their keys."""
    counts, drawn = _count(rows, [START, END], first_draws, 0)
    targets = targets_of(counts.bytes[-1], counts.rows[-1])
    turn = 0
    while True:
        for t in targets:
            if t.found is None:
                t.look(counts, drawn)
        if all(t.found is not None for t in targets):
            return targets, counts
        turn += 1
        keys = sorted({START, END}.union(*(t.near for t in targets)))
        counts, drawn = _count(rows, keys, draws, turn)


def _targets(shards: int, tolerance: float, part_rows: int, least_parts: int):
    def of(n_bytes: int, n_rows: int) -> list[Target]:
        by_bytes = [Target("bytes", Fraction(n_bytes * j, shards), Fraction(tolerance) * n_bytes / shards)
                    for j in range(1, shards)]
        parts = max(least_parts, n_rows // part_rows)
        by_rows = [Target("rows", Fraction(n_rows * j, parts), Fraction(PART_TOLERANCE) * n_rows / parts)
                   for j in range(1, parts)]
        return by_bytes + by_rows
    return of


def shards(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, id_col: str = "doc_id",
           text_col: str = "text", part_rows: int = PART_ROWS, least_parts: int = LEAST_PARTS,
           first_draws: int = FIRST_DRAWS, draws: int = DRAWS) -> DataFrame:
    """One row per input row: doc (the row, all its columns), size, shard, slot.

    ``size`` is the text's UTF-8 bytes and one; shard j holds the rows between the
    places nearest to j and j + 1 times the mean (the lower of two as near), slots
    number a shard's rows from 0 in key order. Equal texts are neighbours: a
    group is cut only where a splitter falls into it.

    A null text has the size and the key of an empty one; a null id comes after
    all others. Repeated rows differ by row number, so a splitter can fall among
    them however many they are. A text longer than a shard leaves its neighbours
    empty. An empty table gives an empty result. The input's columns are inside
    ``doc``, so their names clash with nothing.
    """
    rows = keyed(docs, id_col, text_col)
    targets, counts = splitters(rows, _targets(shards, tolerance, part_rows, least_parts), first_draws, draws)
    borders = sorted(t.found for t in targets if t.measure == "bytes")
    starts = sorted({START, *(t.found for t in targets)})  # of the parts
    at = {k: n for k, n in zip(counts.keys, counts.rows)}
    shard = np.array([bisect_right(borders, k) for k in starts])
    slot = np.array([at[k] - at[borders[s - 1] if s else START] for k, s in zip(starts, shard)])
    probes = np.array(starts, dtype=object)

    @F.pandas_udf("part int, shard int, slot long")
    def place(key: pd.Series) -> pd.DataFrame:
        p = np.searchsorted(probes, key.to_numpy(), side="right") - 1
        return pd.DataFrame({"part": p, "shard": shard[p], "slot": slot[p]})

    in_part = Window.partitionBy("to.part").orderBy("key")
    return (rows.select("*", place("key").alias("to"))
            .select("doc", "size", F.col("to.shard").alias("shard"),
                    (F.col("to.slot") + F.row_number().over(in_part) - 1).alias("slot")))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """The rows as Parquet, one folder per shard, in slot order within a file."""
    (shards(docs, **options).select("doc.*", "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
