"""Threshold joins against all scores by hand; the index against plain products."""

import math
import random

import __spark_entry__ as E
import duckdb
import numpy as np
from martstar.llm import hard_negatives as H
from scripts.oracle_check import digest

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, number int, block int, score int, vec string"


def by_hand(rows, every=100, n=5):
    """[(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)]"""
    v = []
    for i, e, label in rows:
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        ints = [math.floor(256.0 * float(np.float32(x))) for x in e]
        if sum(float(x) * x for x in ints) <= 2.0**62:
            v.append((i, ints, label))
    key = lambda s: (-s[0], math.inf if s[1] is None else s[1])
    out = []
    for at, (i, e, label) in enumerate(v):
        if i is None or i % every:
            continue
        scores = [(sum(a * b for a, b in zip(e, f)), j, g) for k, (j, f, g) in enumerate(v) if k != at]
        positives = sorted([s for s in scores if s[2] == label], key=key)[:n]
        for ps, p, _ in positives:
            inside = sorted([s for s in scores if s[2] != label and 80 * ps <= 100 * s[0] <= 100 * ps], key=key)[:n]
            out += [(i, p, k + 1, s[1], ps, s[0]) for k, s in enumerate(inside)]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "v") for r in rows], SCHEMA)


def got(spark, rows, every=100, **options):
    df = H.positives_and_negatives(frame(spark, rows).repartition(3), every=every, **options)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(seed, n, d, spread=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(0, spread) for _ in range(d)], r.randrange(3)) for i in range(n)]


def test_index_finds_all_pairs_over_a_threshold():
    r = np.random.default_rng(3)
    v = np.floor(r.normal(0, 100, (300, 50)) * np.linspace(2, 0.1, 50) * r.uniform(0.01, 1, (300, 1))).astype(np.int64)
    q = np.vstack([v[:20], np.zeros((1, 50), dtype=np.int64), v[20:21] * 50])
    exact = q @ v.T
    index = H.Index(v)
    for low in (np.quantile(exact, 0.999), np.quantile(exact, 0.9), 1, 0, -1000, H.NO_FLOOR):
        for rows in (np.arange(300), np.arange(50, 120), np.arange(0)):
            qi, ri, score = index.search(q, np.full(len(q), int(low)), rows)
            assert (score == exact[qi, ri]).all() and (np.diff(qi) >= 0).all()
            need = {(i, j) for i in range(len(q)) for j in rows if exact[i, j] >= int(low)}
            assert need <= set(zip(qi.tolist(), ri.tolist()))
    # a high threshold leaves most of the postings out
    assert (index.suffix[:, 2] * np.linalg.norm(v[0]) < 0.9 * exact[0, 0]).mean() > 0.5


def test_small_tables_by_hand(spark):
    for seed, d, options in ((1, 8, {"least_blocks": 1}), (2, 40, {"least_blocks": 5}), (3, 3, {"block_rows": 40, "least_blocks": 1})):
        rows = vectors(seed, 300, d)
        assert got(spark, rows, every=20, **options) == by_hand(rows, every=20)


def test_ties_repeats_nulls_and_odd_vectors(spark):
    r = random.Random(9)
    rows = [(i, [float(r.randint(0, 1)) for _ in range(4)], r.randrange(2)) for i in range(150)]  # many equal scores
    rows += [(100, [1.0, 1.0, 1.0, 1.0], 0), (100, [1.0, 1.0, 1.0, 1.0], 1)]  # a repeated id
    rows += [(None, [1.0, 1.0, 1.0, 1.0], 0), (None, [1.0, 0.0, 1.0, 1.0], 1), (200, None, 1), (300, [1.0], None)]
    rows += [(400, [1.0, None], 1), (401, [float("nan")], 1), (402, [float("inf")], 0), (500, [], 1), (600, [1.0, 1.0], 0)]
    rows += [(700, [1e30, 0.0], 0), (701, [3e6, 1.0, -2.0], 0), (702, [2.5e6, 7.0], 1), (800, [-1.0] * 4, 0)]
    assert got(spark, rows, least_blocks=4) == by_hand(rows)


def test_a_third_of_all_rows_is_one_vector(spark):
    same = [0.5] * 16
    rows = [(i, same, 1) if i % 3 == 0 else v for i, v in enumerate(vectors(4, 600, 16, 0.5))]
    assert got(spark, rows, every=50) == by_hand(rows, every=50)


def test_few_rows_and_empty(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0], 1)]) == []
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)]
    assert got(spark, rows) == by_hand(rows) == [(0, 1, 1, 2, 65536, 256 * 230)]


def test_query_matches_sql(spark):
    d = "/root/testdata/sf0.001"
    rows = E.queries()["op11_hard_negatives"](spark, d)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{d}/embeddings.parquet')")
    cur = con.execute(E.oracle_sql()["op11_hard_negatives"])
    cols = [c[0] for c in cur.description]
    assert digest(rows.columns, [tuple(r) for r in rows.collect()])[0] == digest(cols, cur.fetchall())[0]
