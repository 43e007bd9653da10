"""SimHash near-dedup with sharded BK-trees.

1. Fingerprints: XXH64 (seed 42) of every word shingle, bit by bit majority.
2. Distinct fingerprints are dealt to shards. Two fingerprints within radius r
   agree on one of r + 1 blocks of their bits, so a shard is one value of one
   block. A shard of more than ``shard_rows`` fingerprints is cut again by the
   blocks of its remaining bits, level by level, so shards stay small and no
   pair is lost.
3. Each shard is a BK-tree: a node's children are keyed by their Hamming
   distance to it, and a search follows only the keys within the radius of the
   query's own distance. The tree of a shard goes to the task that holds the
   shard's queries. A tree that is still large when no bits are left to cut is
   built in pieces of ``shard_rows``; each piece is sent to every piece of the
   queries, so what is broadcast has a bound.
   Trees of all fingerprints are never gathered in one place: their size grows
   with the documents.
4. A shard emits one link from each fingerprint to the smallest it is tied to
   within the shard, not all pairs; components of these links are the groups.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martstar.llm.common import id_text, keep, named, one_each, rank, text_of, with_id
from martstar.llm.components import components

SHINGLE = 3
RADIUS = 3
SHARD_ROWS = 1024
SPACE = b" \t\n\v\f\r"
BLOCK_SHINGLES = 1 << 16  # hashes held at a time
LEAST_BITS = 16  # no cut below this width


def fingerprint(text: str, k: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of one text; zero without words."""
    # bytes.lower and bytes.split know ASCII only, which is what the words need
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, BLOCK_SHINGLES):
        part = words[lo:min(n, lo + BLOCK_SHINGLES) + k - 1]
        line = b" ".join(part)
        ends = np.cumsum([len(w) + 1 for w in part]) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        ends = ends.tolist()
        m = max(1, len(part) - k + 1)
        last = min(k, len(part)) - 1
        h = np.array([digest(line[starts[i]:ends[i + last]], 42) for i in range(m)], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((ones * 2 > n).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """(doc_id, sha, fp): fp is the fingerprint as a signed 64-bit number, sha the text's digest."""

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "sha": b["sha"],
                                "fp": np.array([fingerprint(t, k) for t in b["text"]], dtype=np.int64)})

    text = text_of(text_col)
    src = docs.select(id_text(id_col).alias("doc_id"), F.sha2(text.cast("binary"), 256).alias("sha"), text.alias("text"))
    return with_id(src.mapInPandas(run, "doc_id string, sha string, fp long"))


class BKTree:
    """Nodes in insertion order; children of a node by their distance to it."""

    def __init__(self):
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, x: int) -> None:
        if not self.value:
            self.value.append(x)
            self.children.append({})
            return
        at = 0
        while True:
            d = (self.value[at] ^ x).bit_count()
            if d == 0:
                return
            child = self.children[at].get(d)
            if child is None:
                self.children[at][d] = len(self.value)
                self.value.append(x)
                self.children.append({})
                return
            at = child

    def within(self, x: int, radius: int):
        """Values at most ``radius`` bits from x; only edges within the radius are followed."""
        stack = [0] if self.value else []
        while stack:
            at = stack.pop()
            d = (self.value[at] ^ x).bit_count()
            if d <= radius:
                yield self.value[at]
            for key, child in self.children[at].items():
                if d - radius <= key <= d + radius:
                    stack.append(child)


def _tied(values: list[int], tree: BKTree, radius: int) -> list[tuple[int, int]]:
    """Links from values to the smallest they are tied to through the tree."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    for x in values:
        for y in tree.within(x, radius):
            a, b = root(x), root(y)
            if a != b:
                up[max(a, b)] = min(a, b)
                up.setdefault(min(a, b), min(a, b))
    return [(x, r) for x in up if (r := root(x)) != x]


def _shard_links(rows: DataFrame, radius: int) -> DataFrame:
    """Links within shards; rows (key, fp) with every shard in one task."""

    def run(batches):
        key, group = None, []

        def close():
            if len(group) < 2:
                return []
            tree = BKTree()
            for x in group:
                tree.add(x)
            return _tied(group, tree, radius)

        for b in batches:
            out = []
            for k, x in zip(b["key"].tolist(), b["fp"].tolist()):
                if k != key:
                    out += close()
                    key, group = k, []
                group.append(x & 0xFFFFFFFFFFFFFFFF)
            yield _frame(out)
        yield _frame(close())

    return (rows.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
            .mapInPandas(run, "a long, b long"))


def _frame(links: list[tuple[int, int]]) -> pd.DataFrame:
    a = np.array([x for x, _ in links], dtype=np.uint64).view(np.int64)
    b = np.array([y for _, y in links], dtype=np.uint64).view(np.int64)
    return pd.DataFrame({"a": a, "b": b})


def _piece_links(rows: DataFrame, radius: int, shard_rows: int) -> DataFrame:
    """Links in shards that no cut makes small: every tree piece meets every query piece."""
    n = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("n"))
    order = Window.partitionBy("key").orderBy("fp")  # 2 ** LEAST_BITS rows of a key at most, all distinct
    cut = keep(rows.join(n, "key").select("key", "fp", "n", (F.row_number().over(order) % F.col("n")).alias("piece")))
    both = cut.select("key", "fp", "piece", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    trees = both.select("key", F.col("piece").alias("t"), F.col("other").alias("q"), F.lit(0).alias("side"), "fp")
    asks = both.where("piece >= other").select("key", F.col("other").alias("t"), F.col("piece").alias("q"),
                                               F.lit(1).alias("side"), "fp")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = BKTree()
        u = pdf["fp"].to_numpy().view(np.uint64)
        side = pdf["side"].to_numpy()
        for x in u[side == 0].tolist():
            tree.add(x)
        return _frame(_tied(u[side == 1].tolist(), tree, radius))

    return trees.where("t <= q").unionByName(asks).groupBy("key", "t", "q").applyInPandas(run, "a long, b long")


def links(fps: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b): links whose components join all distinct fingerprints within the radius."""
    parts = radius + 1
    level = fps.select("fp", F.col("fp").alias("rest"), F.lit(64).alias("w"), F.lit(0).cast("long").alias("key"))
    found = []
    while True:
        # the next cut: one row per block of the remaining bits
        lo = (F.col("w") * F.col("j") / parts).cast("int")
        hi = (F.col("w") * (F.col("j") + 1) / parts).cast("int")
        ones = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n) - 1
        cut = level.select("fp", "rest", "w", "key", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("j"))
        right = lambda x, n: F.call_function("shiftrightunsigned", x, n)
        upper = F.when(hi < 64, F.call_function("shiftleft", right(F.col("rest"), hi), lo)).otherwise(F.lit(0).cast("long"))
        cut = keep(cut.select(
            "fp", upper.bitwiseOR(F.col("rest").bitwiseAND(ones(lo))).alias("rest"), (F.col("w") - (hi - lo)).alias("w"),
            F.xxhash64("key", "j", right(F.col("rest"), lo).bitwiseAND(ones(hi - lo))).alias("key")))
        sizes = keep(cut.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        cut = keep(cut.join(sizes, "key"))
        found.append(_shard_links(cut.where(F.col("n") <= shard_rows), radius))
        level = cut.where(F.col("n") > shard_rows).drop("n")
        if level.isEmpty():
            break
        last = level.where(F.col("w") <= LEAST_BITS)
        if not last.isEmpty():
            found.append(_piece_links(last.select("key", "fp"), radius, shard_rows))
        level = level.where(F.col("w") > LEAST_BITS)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _groups(docs: DataFrame, id_col: str, text_col: str, k: int, radius: int, shard_rows: int) -> DataFrame:
    """(doc_id, sha, fp, first): ``first`` is the (rank, sha, id) that stays of the row's component."""
    base = keep(fingerprints(docs, id_col, text_col, k))
    who = F.struct(rank("doc_id").alias("r"), F.col("sha").alias("sha"), F.col("doc_id").alias("id"))
    fps = keep(base.groupBy("fp").agg(F.min(who).alias("first")))
    roots = components(links(fps.select("fp"), radius, shard_rows))
    roots = keep(fps.join(roots, fps["fp"] == roots["node"], "left")
                 .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    best = roots.groupBy("root").agg(F.min("first").alias("low"))
    firsts = keep(roots.join(best, "root").select("fp", F.col("low").alias("first")))
    return base.join(firsts, "fp")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, fingerprint, component_id: one row per input row.

    Texts without words (null, empty, white space) have fingerprint zero and
    are linked like any other. Rows that repeat a doc_id are rows of one id. A
    null id ranks last, so it names a component only if all its ids are null.
    An empty table gives an empty result.
    """
    return _groups(docs, id_col, text_col, k, radius, shard_rows).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                     radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row of ``docs`` for each component, all columns unchanged: the smallest
    doc_id (nulls last), of its texts the one with the smallest digest.

    Rows are told apart by id and text, so a repeated or null id is no reason to
    go. Of rows equal in both one stays.
    """
    own = F.struct(rank("doc_id").alias("r"), F.col("sha").alias("sha"))
    gone = (_groups(docs, id_col, text_col, k, radius, shard_rows)
            .where(own != F.struct(F.col("first.r").alias("r"), F.col("first.sha").alias("sha")))
            .select(rank("doc_id").alias("r"), "sha").distinct())
    return one_each(named(docs, id_col, text_col).join(gone, ["r", "sha"], "left_anti")).select("doc.*")
