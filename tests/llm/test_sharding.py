"""Histogram sort against sorting by hand: exact splitters, hot rows, slots, files."""

import hashlib
import zlib

import __spark_entry__ as E
import duckdb
from martstar.llm import sharding as S
from scripts.oracle_check import digest
from tests.llm.helpers import SCHEMA, awkward, prose, table

LAST = 2**63 - 1


def by_hand(texts, n):
    """[(id, size, shard, slot)]: sort, then put every splitter at the nearest place."""
    rows = sorted(((hashlib.md5((t or "").encode()).hexdigest(), LAST if d is None else d, len((t or "").encode()) + 1, d)
                   for d, t in texts), key=lambda r: r[:2])
    places = [0]
    for r in rows:
        places.append(places[-1] + r[2])
    cut = [min(places, key=lambda p: (abs(n * p - j * places[-1]), p)) for j in range(1, n)]
    out, slots = [], {}
    for r, below in zip(rows, places):
        shard = sum(c <= below for c in cut)
        out.append((r[3], r[2], shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
    return sorted(out, key=str)


def got(df, n, **options):
    return sorted(((r.doc.doc_id, r.size, r.shard, r.slot) for r in S.shards(df, n, **options).collect()), key=str)


def test_awkward_rows_by_hand(spark):
    texts = awkward() + [(100 + i, prose(i, 5 + i % 40)) for i in range(60)]
    for n, draws in ((1, 16), (4, 2), (16, 1)):
        assert got(table(spark, texts).repartition(3), n, first_draws=draws, draws=draws) == by_hand(texts, n)


def test_a_third_of_all_rows_is_one_row(spark):
    # identical rows, ids included: only their row numbers tell them apart
    texts = [(None, None) if i % 3 == 0 else (i, prose(i, 1 + i % 9)) for i in range(2000)]
    df = table(spark, texts).repartition(5)
    assert got(df, 8, first_draws=4, draws=3) == by_hand(texts, 8)
    # and no part that a task sorts holds them together
    targets, counts = S.splitters(S.keyed(df, "doc_id", "text"), S._targets(8, 0.0, 100, 16), 4, 3)
    at = dict(zip(counts.keys, counts.rows))
    borders = sorted(at[t.found] for t in targets) + [2000]
    assert max(b - a for a, b in zip([0] + borders, borders)) <= 2 * 100


def test_tolerance_takes_a_candidate_that_is_near_enough(spark):
    texts = [(i, prose(i, 20)) for i in range(500)]
    rows = S.shards(table(spark, texts), 4, tolerance=0.1, first_draws=8, draws=4).collect()
    size = [sum(r.size for r in rows if r.shard == j) for j in range(4)]
    assert max(abs(s - sum(size) / 4) for s in size) <= 2 * 0.1 * sum(size) / 4
    assert sorted(r.slot for r in rows if r.shard == 2) == list(range(sum(r.shard == 2 for r in rows)))


def test_equal_texts_are_neighbours(spark):
    texts = [(i, f"text {i % 50}") for i in range(400)]
    rows = sorted(S.shards(table(spark, texts), 4).collect(), key=lambda r: (r.shard, r.slot))
    order = [r.doc.text for r in rows]
    assert sum(a != b for a, b in zip(order, order[1:])) == 49


def test_files_and_clashing_columns(spark, tmpdir_path):
    texts = [(i, prose(i, 30)) for i in range(100)]
    df = table(spark, texts).withColumnsRenamed({"fp": "key", "w": "part", "words": "doc"}).withColumn("size", S.F.lit(3))
    S.write_shards(df, f"{tmpdir_path}/s", shards=4)
    back = spark.read.parquet(f"{tmpdir_path}/s")
    assert set(back.columns) == set(df.columns) | {"shard", "slot"}
    assert sorted((r.doc_id, r.text, r.key, r.size) for r in back.collect()) == sorted((i, t, 1, 3) for i, t in texts)


def test_empty(spark):
    e = spark.createDataFrame([], SCHEMA)
    assert S.shards(e).count() == 0 and S.shards(e).columns == ["doc", "size", "shard", "slot"]


def test_query_matches_sql_and_checksums(spark):
    d = "/root/testdata/sf0.001"
    rows = E.queries()["op12_sharding"](spark, d)
    out = [tuple(r) for r in rows.collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet')")
    cur = con.execute(E.oracle_sql()["op12_sharding"])
    cols = [c[0] for c in cur.description]
    assert digest(rows.columns, out)[0] == digest(cols, cur.fetchall())[0]
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    assert all(r[2] == zlib.crc32((texts[r[0]] or "").encode()) for r in out)
