"""Hard-negative mining by threshold joins in the manner of L2AP.

A search asks for all rows whose integer inner product with a query lies in a
window [low, high]. Rows lie in blocks by a hash of their number, and a block
answers by an inverted index over its dimensions:

* the suffix norms of every row say which dimensions to leave out: once the rest of
  a row times the longest query can't reach the least threshold, the row has
  no postings from there on;
* the postings of a few dimensions at a time add to the partial scores; a pair
  goes when its partial score and the product of the two remaining norms stay
  below the query's threshold, a row when it has no pair left;
* what is left is scored exactly, in integers.

Queries come in two steps. In its own block a query lowers its threshold until the
window is full (five rows), or down to the window's end. The fifth score found there
is a floor: five rows reach it, so the second step, over all blocks, asks for
nothing below. Positives come first; their scores are the windows of the negatives.

A block's rows and one batch of queries are all that a task holds; queries are
streamed past a block and never broadcast.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martstar.llm.common import id_text, keep, rank
from martstar.session import scratch_path

SCALE = 256
TOP = 5                       # positives of an anchor, negatives of a positive
LOW, HIGH = 80, 100           # window of the negatives, in hundredths of the positive's score
BLOCK_ROWS = 8192
BLOCK_NUMBERS = 1 << 20       # components of a block, so that wide vectors make smaller blocks
LEAST_BLOCKS = 32
BATCH = 256                   # queries searched together
CHUNK = 16                    # dimensions added between two prunings
LOWER_POSITIVE = 0.75         # from one threshold to the next
LOWER_NEGATIVE = 0.95
NORM_LIMIT = 2.0**62          # of a squared norm, so that every score is a long

NO_FLOOR = -(2**63)


# -- one block --------------------------------------------------------------
class Index:
    """Postings of a block's vectors, by groups of dimensions."""

    def __init__(self, vectors: np.ndarray):
        self.exact = vectors
        m, d = vectors.shape
        self.chunks = [(a, min(a + CHUNK, d)) for a in range(0, d, CHUNK)]
        v = vectors.astype(np.float64)
        self.values = [np.ascontiguousarray(v[:, a:b]) for a, b in self.chunks]
        self.suffix = self._suffix(v)

    def _suffix(self, v: np.ndarray) -> np.ndarray:
        """(row, chunk): norm of the dimensions from the chunk on."""
        squares = np.zeros((len(v), len(self.chunks) + 1))
        for k in range(len(self.chunks) - 1, -1, -1):
            a, b = self.chunks[k]
            squares[:, k] = squares[:, k + 1] + (v[:, a:b] ** 2).sum(axis=1)
        return np.sqrt(squares)

    def search(self, queries: np.ndarray, low: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of all pairs with score >= low; ``rows``: the rows to search."""
        q = queries.astype(np.float64)
        left = self._suffix(q)  # of the queries
        low = low.astype(np.float64)
        # partial sums are floats: leave room for their rounding
        low = low - 1 - 1e-9 * np.abs(low) - 1e-9 * left[:, 0] * self.suffix[:, 0].max(initial=0)
        norm = left[:, 0].max(initial=0)
        least = low.min(initial=np.inf) / norm if norm else -np.inf  # what a suffix must have to matter
        rows = rows[self.suffix[rows, 0] >= least]
        partial = np.zeros((len(q), len(rows)))
        alive = np.ones(partial.shape, dtype=bool)
        for k, (a, b) in enumerate(self.chunks):
            posted = self.suffix[rows, k] >= least
            if posted.all():
                partial += q[:, a:b] @ self.values[k][rows].T
                rest = left[:, k + 1:k + 2] * self.suffix[rows, k + 1]
            else:  # the others have no postings from here on: what they lack stays in their bound
                partial[:, posted] += q[:, a:b] @ self.values[k][rows[posted]].T
                rest = np.where(posted, left[:, k + 1:k + 2] * self.suffix[rows, k + 1], left[:, :1] * self._open(rows, k, least))
            alive = partial + rest >= low[:, None]
            some = alive.any(axis=0)
            if not some.all():
                rows, partial, alive = rows[some], partial[:, some], alive[:, some]
        qi, at = np.nonzero(alive)
        ri = rows[at]
        score = np.empty(len(qi), dtype=np.int64)
        for s in range(0, len(qi), 65536):
            e = slice(s, s + 65536)
            score[e] = (queries[qi[e]] * self.exact[ri[e]]).sum(axis=1)
        return qi, ri, score

    def _open(self, rows: np.ndarray, k: int, least: float) -> np.ndarray:
        """For rows without postings at chunk k: the norm of all that was left out."""
        s = self.suffix[rows, :k + 1]
        return np.where(s < least, s, 0).max(axis=1)


def best(score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the first n by score, highest first, ties by smaller id."""
    return np.lexsort((ids, -score))[:n]


class Block:
    """The rows of a block, by label."""

    def __init__(self, b: pd.DataFrame, width: int):
        self.number = b["number"].to_numpy()
        self.rank = b["rank"].to_numpy()
        self.vec_id = b["vec_id"].to_numpy()
        self.label = b["label"].to_numpy()
        self.index = Index(matrix(b["vec"], width))

    def rows(self, label: int, same: bool) -> np.ndarray:
        return np.flatnonzero((self.label == label) == same)

    def search(self, queries: pd.DataFrame, vectors: np.ndarray, low: np.ndarray, same: bool):
        """For each query its matches (places, scores): rows of its label but itself, or of the others."""
        out = [None] * len(queries)
        labels = queries["label"].to_numpy()
        number = queries["number"].to_numpy()
        for label in np.unique(labels):
            mine = np.flatnonzero(labels == label)
            qi, ri, score = self.index.search(vectors[mine], low[mine], self.rows(label, same))
            ok = score >= low[mine][qi]
            if same:
                ok &= self.number[ri] != number[mine][qi]
            qi, ri, score = qi[ok], ri[ok], score[ok]
            ends = np.searchsorted(qi, np.arange(len(mine) + 1))  # qi is sorted
            for i, (a, b) in enumerate(zip(ends, ends[1:])):
                out[mine[i]] = ri[a:b], score[a:b]
        return out


def matrix(vecs, width: int) -> np.ndarray:
    """Vectors as rows; missing dimensions are zero."""
    out = np.zeros((len(vecs), width), dtype=np.int64)
    for i, v in enumerate(vecs):
        out[i, :len(v)] = v
    return out


# -- the two steps of each search, for a batch of queries --------------------
def _lowered(block: Block, q: pd.DataFrame, x: np.ndarray, top: np.ndarray, by: float, end: np.ndarray, same: bool,
             full) -> list:
    """Matches of each query at the first threshold at which ``full(i, matches)``, or at ``end``."""
    found = [None] * len(q)
    open_, low = np.arange(len(q)), top.astype(np.float64)
    while len(open_):
        low = low * by
        at = np.where(low > 1, np.floor(low).astype(np.int64), NO_FLOOR)
        at = np.maximum(at, end[open_])
        got = block.search(q.iloc[open_], x[open_], at, same)
        for i, g in zip(open_, got):
            found[i] = g
        more = np.array([not full(i, found[i]) for i in open_]) & (at > end[open_])
        open_, low = open_[more], low[more]
    return found


def _nth(score: np.ndarray, n: int) -> int:
    return int(np.partition(score, len(score) - n)[len(score) - n]) if len(score) >= n else NO_FLOOR


def _positive_floor(block: Block, q: pd.DataFrame, x: np.ndarray, n: int):
    top = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) * block.index.suffix[:, 0].max(initial=0)
    found = _lowered(block, q, x, top, LOWER_POSITIVE, np.full(len(q), NO_FLOOR), True, lambda i, m: len(m[1]) >= n)
    for i, (_, score) in enumerate(found):
        yield i, (_nth(score, n),)


def _positives(block: Block, q: pd.DataFrame, x: np.ndarray, n: int):
    for i, (ri, score) in enumerate(block.search(q, x, q["floor"].to_numpy(), True)):
        for j in best(score, block.rank[ri], n):
            yield i, (int(block.number[ri[j]]), block.vec_id[ri[j]], int(block.rank[ri[j]]), int(score[j]))


def _ends(high: np.ndarray) -> np.ndarray:
    """The least score of each window: HIGH * score >= LOW * positive."""
    return np.array([-((-LOW * int(h)) // HIGH) for h in high], dtype=np.int64)


def _inside(score: np.ndarray, low: int, high: int) -> np.ndarray:
    return np.flatnonzero((score >= low) & (score <= high))


def _negative_floor(block: Block, q: pd.DataFrame, x: np.ndarray, n: int):
    """Floors of the windows of each query's positives."""
    highs = [np.array(h, dtype=np.int64) for h in q["highs"]]
    ends = [_ends(h) for h in highs]
    top = np.array([h.max() for h in highs])

    def scores(i, match, j):
        return match[1][_inside(match[1], ends[i][j], highs[i][j])]

    def full(i, match):
        return all(len(scores(i, match, j)) >= n for j in range(len(highs[i])))

    found = _lowered(block, q, x, top, LOWER_NEGATIVE, np.array([e.min() for e in ends]), False, full)
    for i, match in enumerate(found):
        yield i, ([_nth(scores(i, match, j), n) for j in range(len(highs[i]))],)


def _negatives(block: Block, q: pd.DataFrame, x: np.ndarray, n: int):
    highs = [np.array(h, dtype=np.int64) for h in q["highs"]]
    lows = [np.maximum(_ends(h), np.array(f, dtype=np.int64)) for h, f in zip(highs, q["floors"])]
    found = block.search(q, x, np.array([v.min() for v in lows]), False)
    for i, (ri, score) in enumerate(found):
        for j, (low, high) in enumerate(zip(lows[i], highs[i])):
            at = _inside(score, low, high)
            for k in best(score[at], block.rank[ri[at]], n):
                r = ri[at[k]]
                yield i, (j, int(block.number[r]), block.vec_id[r], int(block.rank[r]), int(score[at[k]]))


# -- Spark ------------------------------------------------------------------
def _anchors(every: int) -> Column:
    return F.coalesce(F.col("vec_id") % F.lit(every) == 0, F.lit(False))


def prepared(embeddings: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """number, vec_id, rank, label, vec (longs): the rows that take part."""
    v = F.transform(F.col(vec_col), lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("double"))
    bad = F.exists(F.col(vec_col), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    short = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x) <= F.lit(NORM_LIMIT)
    part = (F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & ~F.coalesce(bad, F.lit(True)))
    kept = embeddings.where(part).where(short).select(
        F.col(id_col).cast("long").alias("vec_id"), rank(id_col).alias("rank"), F.col(label_col).cast("long").alias("label"),
        F.transform(v, lambda x: x.cast("long")).alias("vec"), F.monotonically_increasing_id().alias("number"))
    path = scratch_path(embeddings.sparkSession, f"negatives-{uuid.uuid4().hex}")
    kept.write.parquet(path)
    return embeddings.sparkSession.read.parquet(path)


def _search(rows: DataFrame, queries: DataFrame, width: int, extra: str, step, out: str, n: int) -> DataFrame:
    """``step`` for every (block, query): rows of a block come first, its queries are streamed past them.

    ``extra``: the queries' columns beside number, label and vec; ``out``: what a
    step yields beside the query's number.
    """
    names = [f.strip().split()[0] for f in extra.split(",") if f.strip()]
    blank = [(F.array().cast(f.strip().split()[1]) if "array" in f else F.lit(0).cast("long")).alias(f.strip().split()[0])
             for f in extra.split(",") if f.strip()]  # no nulls: pandas would make the numbers floats
    both = rows.select("block", F.lit(0).alias("kind"), "number", id_text("vec_id").alias("vec_id"), "rank", "label", "vec", *blank)
    both = both.unionByName(queries.select(
        "block", F.lit(1).alias("kind"), "number", F.lit(None).cast("string").alias("vec_id"), F.lit(0).cast("long").alias("rank"),
        "label", "vec", *names))
    columns = ["query"] + [f.strip().split()[0] for f in out.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, of, held = None, None, []
        for b in batches:
            for (number, kind), g in b.groupby(["block", "kind"], sort=False):
                if number != of:
                    block, of, held = None, number, []
                if kind == 0:
                    held.append(g)
                    continue
                if not held:
                    continue
                if block is None:
                    block = Block(pd.concat(held), width)
                for a in range(0, len(g), BATCH):
                    q = g.iloc[a:a + BATCH]
                    ids = q["number"].tolist()
                    got = [(ids[i], *row) for i, row in step(block, q, matrix(q["vec"], width), n)]
                    if got:
                        yield pd.DataFrame(got, columns=columns, dtype=object)

    return both.repartition("block").sortWithinPartitions("block", "kind").mapInPandas(run, f"query long, {out}")


def _first(found: DataFrame, by: list[str], n: int) -> DataFrame:
    """The first n matches of each window, over all blocks."""
    w = Window.partitionBy(*by).orderBy(F.desc("score"), "rank", "match")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def positives_and_negatives(embeddings: DataFrame, label: Column | None = None, every: int = 100, n: int = TOP,
                            id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                            block_rows: int = BLOCK_ROWS, least_blocks: int = LEAST_BLOCKS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``; ``label`` replaces the
    label, as an expression of ``vec_id`` and ``label``. Per anchor the n best rows of
    its label are its positives, and per positive the n best rows of other labels
    within LOW to HIGH hundredths of its score are returned. Scores are inner
    products of ``floor(256 * x)``; ties go by smaller id, a null id last.

    Rows with a null label or vector, a null or non-finite component, or a squared
    norm above 2^62 (whose scores a long can't hold) take no part. Vectors of
    different lengths are filled up with zeros; an empty vector scores 0 with
    all. Rows that repeat an id are rows like any other, anchors too. A positive
    below 0 has an empty window. An empty table gives an empty result.
    """
    rows = prepared(embeddings, id_col, vec_col, label_col)
    if label is not None:
        rows = rows.withColumn("label", label)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width")).first()
    width = max(1, size["width"] or 0)
    blocks = max(least_blocks, math.ceil(size["n"] / max(1, min(block_rows, BLOCK_NUMBERS // width))))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(blocks)))
    anchors = rows.where(_anchors(every)).select("block", "number", "vec_id", "label", "vec")
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")

    floors = _search(rows, anchors, width, "", _positive_floor, "floor long", n)
    asked = keep(anchors.join(floors.withColumnRenamed("query", "number"), "number"))
    queries = asked.select(everywhere, "number", "label", "vec", "floor")
    match = "match long, match_id string, rank long, score long"
    found = keep(_first(_search(rows, queries, width, "floor long", _positives, match, n), ["query"], n))

    windows = (found.groupBy(F.col("query").alias("number"))
               .agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("p"))
               .select("number", F.transform("p", lambda p: p["score"]).alias("highs")))
    asked = anchors.join(windows, "number")
    floors = _search(rows, asked, width, "highs array<long>", _negative_floor, "floors array<long>", n)
    asked = keep(asked.join(floors.withColumnRenamed("query", "number"), "number"))
    queries = asked.select(everywhere, "number", "label", "vec", "highs", "floors")
    negatives = _search(rows, queries, width, "highs array<long>, floors array<long>", _negatives, f"positive int, {match}", n)
    negatives = _first(negatives, ["query", "positive"], n)

    return (negatives.alias("n")
            .join(found.alias("p"), (F.col("n.query") == F.col("p.query")) & (F.col("n.positive") + 1 == F.col("p.place")))
            .join(anchors.alias("a"), F.col("n.query") == F.col("a.number"))
            .select(F.col("a.vec_id").alias("anchor_id"), F.col("p.match_id").cast("long").alias("positive_id"),
                    F.col("n.place").alias("rank"), F.col("n.match_id").cast("long").alias("negative_id"),
                    F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score")))
