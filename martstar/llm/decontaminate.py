"""Benchmark decontamination by SimHash of item-sized windows (built-in functions only).

A document is contaminated by an item of m words when some window of m of its
words has a weighted Jaccard similarity of at least ``threshold`` with the
item, over word shingles counted with their repeats. A document of fewer than
m words is one window as a whole.

1. Shingle hashes are taken at every ``stride``-th word of a document and
   looked up among the item shingles; only hashes travel in this pass. The
   stride is derived from the item lengths so that no window of the wanted
   similarity can slip between two looked-up places (``safe_stride``). Places
   are gathered per block of words.
2. The documents with places are read again. In each block every window that
   overlaps it is tried. A window with fewer shingles of the item than the
   similarity needs is skipped: the count is an upper bound of the overlap, so
   nothing is lost.
3. Windows get a SimHash. It is cut into ``radius + 1`` blocks; by the
   pigeonhole principle two fingerprints within the radius share one, so an
   equi-join on (item, block number, block value) finds all of them. Each
   window and item meet in the first block they share, so no pair repeats.
4. The exact weighted similarity of the shingle texts decides.

Tables are broadcast only up to a checked number of rows and joined by shuffle
beyond: the item index to ``BROADCAST_ROWS`` shingles, the places found to as
many blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martstar.llm.common import keep, let, named, rank, text_of

SHINGLE = 5
THRESHOLD = 0.8
# at similarity 0.8 about 10 of 64 bits differ, 3 on either side as deviation;
# 23 is beyond four deviations
RADIUS = 23
BLOCK = 64  # words; places of one block are handled together
BROADCAST_ROWS = 200_000


def words(text: str) -> Column:
    """Runs of letters and digits in lower case."""
    line = F.trim(F.regexp_replace(F.lower(text_of(text)), r"[^\p{L}\p{N}]+", " "))
    return F.when(line == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(line, " "))


def _shingle(ws: Column, at: Column, k: int) -> Column:
    """k words from a place on; by element, as slice() would copy the whole array each time."""
    return F.concat_ws(" ", *[F.get(ws, at + i) for i in range(k)])


def _hash(ws: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(ws, at + i) for i in range(k)])


def _checked(df: DataFrame) -> DataFrame:
    """A table to broadcast, if a count says it is small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def safe_stride(lengths: list[int], k: int, threshold: float) -> int:
    """The widest step that still meets a shared shingle of every match.

    An item of n shingles and a window of v with similarity t share at least
    (n+v)t/(1+t), so at most (v-nt)/(1+t) of the window's shingles are foreign;
    a step s looks at floor(v/s) of them at least. v is n, or less in a
    document shorter than the item.
    """
    sides = {(m - k + 1, x - k + 1) for m in lengths for x in range(_least_words(m, k, threshold), m + 1)}
    best = 1
    for s in range(2, k + 2):
        if all(v // s > int((v - n * threshold) / (1 + threshold) + 1e-9) for n, v in sides):
            best = s
    return best


def _least_words(m: int, k: int, threshold: float) -> int:
    """The fewest words that reach the threshold with an item of m words."""
    return max(1, math.ceil((m - k + 1) * threshold - 1e-9)) + k - 1


def _simhash(values: Column) -> Column:
    """Bit b is set if it is set in more than half of the hashes."""
    def of(hashes: Column) -> Column:
        def bit(b: Column) -> Column:
            ones = F.aggregate(hashes, F.lit(0), lambda a, h: a + F.getbit(h, b).cast("int"))
            return F.when(ones * 2 > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)) \
                .otherwise(F.lit(0).cast("long"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(bit(b)))
    return let(values, of)


def _block_bounds(radius: int) -> list[tuple[int, int]]:
    n = radius + 1
    return [(64 * j // n, 64 * (j + 1) // n) for j in range(n)]


def _block_value(fp: Column, lo: int, hi: int) -> Column:
    return F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long"))


def _blocks(fp: Column, radius: int) -> Column:
    return F.array(*[_block_value(fp, lo, hi) for lo, hi in _block_bounds(radius)])


def _weighted(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two arrays with repeats: sum of minima over sum of maxima."""
    def times(arr: Column, x: Column) -> Column:
        return F.size(F.filter(arr, lambda y: y == x))
    both = F.aggregate(F.array_distinct(a), F.lit(0), lambda s, x: s + F.least(times(a, x), times(b, x)))
    return let(both, lambda n: n / (F.size(a) + F.size(b) - n))


def bench_items(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                k: int = SHINGLE) -> DataFrame:
    """(item_id, m, k, w, shingles, fp) of each distinct item with words.

    An item of fewer than k words has one shingle, its whole sequence. Null or
    empty items have no words, and an item without an id cannot be named; they
    match nothing.
    """
    it = benchmark.select(F.col(item_col).alias("item_id"), words(text_col).alias("w"))
    it = it.where("item_id is not null and size(w) > 0")
    it = it.withColumn("m", F.size("w")).withColumn("k", F.least(F.lit(k), "m"))
    it = it.withColumn("shingles", F.transform(F.sequence(F.lit(0), F.col("m") - F.col("k")),
                                               lambda i: F.array_join(F.slice("w", i + 1, F.col("k")), " ")))
    fp = _simhash(F.transform("shingles", lambda s: F.xxhash64(s)))
    return it.select("item_id", "m", "k", "w", "shingles", fp.alias("fp")).dropDuplicates(["item_id", "shingles"])


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", k: int = SHINGLE,
          threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity, n_windows): one row for each document and item that match.

    ``similarity`` is that of the best window, ``n_windows`` how many windows
    reach the threshold. A document shorter than an item is compared with it as
    a whole. Documents with no words or a null text match nothing. Rows that repeat a doc_id are searched each and
    reported together. An empty table on either side gives an empty result.
    """
    return (matches(docs, benchmark, id_col, text_col, item_col, item_text, k, threshold, radius)
            .groupBy("doc_id", "item_id")
            .agg(F.max("similarity").alias("similarity"), F.count(F.lit(1)).alias("n_windows")))


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text", k: int = SHINGLE,
            threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """(doc_id, th, item_id, similarity): a row for each window that matches; th is the text's hash."""
    items = keep(bench_items(benchmark, item_col, item_text, k))
    lens = [(r["k"], r["m"]) for r in items.select("k", "m").distinct().collect()]  # word counts, a few dozen values
    found = None
    for kk in sorted({a for a, _ in lens}):
        ms = [m for a, m in lens if a == kk]
        part = _leaks_of(docs, items.where(F.col("k") == kk), id_col, text_col, kk, ms, threshold, radius)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.select(F.col(id_col).alias("doc_id"), F.lit(None).cast("long").alias("th"),
                            F.lit(None).cast("long").alias("item_id"), F.lit(0.0).alias("similarity")).where("false")
    return found


def _leaks_of(docs, items, id_col, text_col, k, ms, threshold, radius) -> DataFrame:
    stride = safe_stride(ms, k, threshold)
    least = min(_least_words(m, k, threshold) for m in ms)
    per = max(1, BLOCK // stride)  # looked-up places in a block
    src = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")) \
        .withColumn("th", F.xxhash64("text"))

    # 1. blocks that hold a shared shingle at a looked-up place
    def looked_up(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - k, F.lit(stride))
        return F.when(F.size(w) >= least, F.transform(at, lambda p: _hash(w, p, k)))

    # outer: an inner explode makes Catalyst add a filter that computes the hashes twice
    places = src.select("doc_id", "th", F.posexplode_outer(let(words("text"), looked_up)).alias("j", "hash"))
    index = keep(items.select("item_id", "m", F.explode(F.array_distinct(let(F.col("w"), lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - k), lambda p: _hash(w, p, k))))).alias("hash")))
    blocks = keep(places.join(_checked(index), "hash")
                  .select("doc_id", "th", "item_id", "m", F.floor(F.col("j") / per).cast("int").alias("b"))
                  .distinct())
    # one row per document: its blocks, as many as its words and the items allow
    todo = keep(blocks.groupBy("doc_id", "th").agg(F.collect_list(F.struct("item_id", "m", "b")).alias("blocks")))

    # 2. the words around each block
    def around(w: Column) -> Column:
        def one(x: Column) -> Column:
            m = F.least(x["m"], F.size(w))  # words of a window
            lo = F.greatest(F.lit(0), x["b"] * per * stride - (m - k + 1) + 1)
            hi = F.least(F.size(w) - m, (x["b"] + 1) * per * stride - 1)  # last start of a window
            return F.struct(x["item_id"].alias("item_id"), x["m"].alias("m"),
                            F.slice(w, lo + 1, hi - lo + m).alias("w"))

        def able(x: Column) -> Column:
            # a shorter document is one window, tried in its first block only
            before = F.exists("blocks", lambda y: (y["item_id"] == x["item_id"]) & (y["b"] < x["b"]))
            long_enough = F.size(w) - (k - 1) >= F.greatest(F.lit(1), F.ceil((x["m"] - k + 1) * threshold - 1e-9))
            return (F.size(w) >= x["m"]) | (long_enough & ~before)
        return F.transform(F.filter("blocks", able), one)

    found = todo.select(F.col("doc_id").alias("id"), F.col("th").alias("h"), "blocks")
    hit = src.join(_checked(found), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("h"))) \
        .select("doc_id", "th", F.explode_outer(let(words("text"), around)).alias("x")) \
        .select("doc_id", "th", "x.item_id", "x.m", "x.w").where("item_id is not null")
    item_shingles = items.select("item_id", F.col("shingles").alias("own"))
    hit = hit.join(_checked(item_shingles), "item_id")
    n = F.col("m") - k + 1

    def windows(s: Column) -> Column:
        v = F.least(n, F.size(s))  # shingles of a window
        enough = F.ceil((n + v) * threshold / (1 + threshold) - 1e-9).cast("int")
        shared = F.transform(s, lambda x: F.array_contains("own", x).cast("int"))
        starts = let(shared, lambda f: F.filter(F.sequence(F.lit(0), F.size(f) - v), lambda p: F.aggregate(
            F.slice(f, p + 1, v), F.lit(0), lambda a, x: a + x) >= enough))
        return F.transform(starts, lambda p: F.slice(s, p + 1, v))

    shingled = let(F.col("w"), lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda p: _shingle(w, p, k)))
    win = hit.select("doc_id", "th", "item_id", F.explode_outer(let(shingled, windows)).alias("ws")).where("ws is not null")
    # 3. SimHash, blocks, all within the radius
    win = win.withColumn("wfp", _simhash(F.transform("ws", lambda x: F.xxhash64(x))))
    win = win.select("doc_id", "th", "item_id", "ws", "wfp", F.posexplode_outer(_blocks(F.col("wfp"), radius)).alias("b", "v"))
    side = items.select("item_id", "fp", "shingles", F.posexplode_outer(_blocks(F.col("fp"), radius)).alias("b", "v"))
    near = win.join(_checked(side), ["item_id", "b", "v"])
    x = F.col("wfp").bitwiseXOR(F.col("fp"))
    first = F.array_position(F.transform(_blocks(x, radius), lambda v: v == 0), True) - 1
    # 4. exact similarity; under the condition, as filters above may move into the join
    sure = (F.bit_count(x) <= radius) & (first == F.col("b"))
    near = near.select("doc_id", "th", "item_id", F.when(
        sure, _weighted(F.col("ws"), F.col("shingles"))).alias("similarity"))
    return near.where(F.col("similarity") >= threshold - 1e-12)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **kw) -> DataFrame:
    """The rows of ``docs`` whose text matches no item, all columns unchanged; a
    repeated or null id is no reason to go."""
    gone = keep(matches(docs, benchmark, id_col, text_col, **kw).select(rank("doc_id").alias("r"), "th").distinct())
    rows = named(docs, id_col, text_col, F.xxhash64(text_of(text_col)))
    return rows.join(gone, (rows["r"] == gone["r"]) & (rows["sha"] == gone["th"]), "left_anti").select("doc.*")
