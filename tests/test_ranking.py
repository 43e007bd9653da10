"""RANK within groups by ranges of the value, against the plain window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from martstar.functions.ranking import grouped_rank


def _rows(spark, kind, value):
    r = random.Random(3)
    rows = [(g, i, None if r.random() < 0.1 else value(r)) for g in (1, 2, 3) for i in range(900)]
    rows += [(4, 0, None), (5, 0, value(r)), (6, 0, value(r)), (6, 1, None), (None, 1, value(r))]
    return spark.createDataFrame(rows, f"g int, id int, v {kind}")


def _plain(df):
    return df.withColumn("rank", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_first())))


def _both(df, **kw):
    kw = {"whole": 0, **kw}
    a = {(x.g, x.id): x["rank"] for x in grouped_rank(df, "g", "v", "rank", ["id"], **kw).collect()}
    b = {(x.g, x.id): x["rank"] for x in _plain(df).collect()}
    assert a == b and len(a) > 2000


def test_ranks_equal_the_plain_window(spark):
    _both(_rows(spark, "double", lambda r: r.gauss(0, 1)))
    _both(_rows(spark, "double", lambda r: round(r.gauss(0, 1), 1)), parts=4)
    _both(_rows(spark, "bigint", lambda r: r.choice([1, 2, 3, 2**62, -(2**62)])))
    # groups that one task may sort; a limit between the sizes of the groups
    _both(_rows(spark, "int", lambda r: r.randrange(50)), whole=10_000)
    _both(_rows(spark, "int", lambda r: r.randrange(50)), whole=500)
    # a third of a group has one value
    _both(_rows(spark, "int", lambda r: 7 if r.random() < 0.34 else r.randrange(10_000)), parts=8)


def test_decimals_and_other_columns(spark):
    df = _rows(spark, "double", lambda r: r.uniform(-99, 99)).withColumn("v", F.col("v").cast("decimal(8,6)"))
    out = grouped_rank(df, "g", "v", "rank", ["id"], whole=0)
    assert out.columns == ["g", "id", "v", "rank"]
    _both(df)


def test_no_window_holds_a_group(spark):
    df = _rows(spark, "int", lambda r: 7 if r.random() < 0.34 else r.randrange(10_000)).where("g = 1")
    cuts = grouped_rank(df, "g", "v", "rank", ["id"], parts=16, whole=0)
    tasks = cuts._jdf.queryExecution().optimizedPlan().toString()
    ranks = [x for x in tasks.splitlines() if "Window [rank(" in x]
    assert ranks and all("_range" in x and "_deal" in x for x in ranks)


def test_empty(spark):
    df = spark.createDataFrame([], "g int, id int, v double")
    assert grouped_rank(df, "g", "v", "rank", ["id"]).count() == 0
    assert grouped_rank(df, "g", "v", "rank", ["id"], whole=-1).count() == 0
