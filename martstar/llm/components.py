"""Connected components of an edge table by hooking and pointer jumping.

Every round is a few joins and map-side combined minima over checkpointed
tables; labels, edges and components stay distributed. A component with a
large hub is no problem: minima are combined before the shuffle and the joins
read plain tables, so adaptive execution can split a skewed side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martstar.llm.common import keep


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node that each node of an edge reaches."""
    e = keep(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    nodes = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
    tree = keep(nodes.select("node", F.col("node").alias("root")))
    while True:
        # roots at both ends of every edge that still joins two trees
        live = (e.join(tree.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
                .join(tree.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
                .where("ra <> rb")
                .select(F.greatest("ra", "rb").alias("node"), F.least("ra", "rb").alias("low")))
        hook = keep(live.groupBy("node").agg(F.min("low").alias("low")))
        if hook.isEmpty():
            return tree
        roots = _flat(hook)
        tree = keep(tree.join(roots.select(F.col("node").alias("root"), F.col("low")), "root", "left")
                    .select("node", F.coalesce("low", "root").alias("root")))


def _flat(hook: DataFrame) -> DataFrame:
    """Follow (node -> low) links to their end; low is always smaller, so there is one."""
    while True:
        up = hook.select(F.col("node").alias("low"), F.col("low").alias("up"))
        step = hook.join(up, "low", "left").select("node", F.coalesce("up", "low").alias("low"),
                                                   F.col("up").isNotNull().alias("moved"))
        step = keep(step)
        if step.where("moved").isEmpty():
            return step.drop("moved")
        hook = step.drop("moved")
