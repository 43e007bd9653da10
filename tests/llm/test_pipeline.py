"""The pipeline against a brute-force version of its stages, and the registry."""

import re

import __spark_entry__ as E
import corpus_pipeline as P
from martstar.llm import toxicity as X
from martstar.llm.common import python_workers, table
from martstar.llm.queries import QUERIES, SQL
from tests.llm.test_decontaminate import brute, words
from tests.llm.test_simhash import brute_fp, roots

SF = "/root/testdata/sf0.001"


def kept_by_hand(spark):
    docs = table(spark, SF, "documents")
    model = X.train(docs, table(spark, SF, "labels"))
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    rows = [(d, t) for d, t in rows if model.score([t])[0] < 0.5]
    seen: dict = {}
    for d, t in rows:
        seen.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), d)
    rows = [(d, t) for d, t in rows if d in set(seen.values())]
    fp = {d: brute_fp(t) for d, t in rows}
    root = roots(sorted(fp), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 3)
    rows = [(d, t) for d, t in rows if root[d] == d]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    # a window that matches shares shingles, so documents without any are clean
    grams = {" ".join(w[i:i + 5]) for _, t in items for w in [words(t)] for i in range(len(w) - 4)}
    near = [(d, t) for d, t in rows if any(" ".join(w[i:i + 5]) in grams for w in [words(t)] for i in range(len(w) - 4))]
    bad = {d for d, _ in brute(near, items)}
    return {d for d, _ in rows if d not in bad}


def test_pipeline_is_brute_force(spark):
    out = P.run(spark, SF).collect()
    assert {r.doc_id for r in out} == kept_by_hand(spark)
    used: dict = {}
    for r in out:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 1024


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF, "documents")
    assert len(P.STAGES) == 5
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name


def test_stages_take_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_registry(spark):
    queries, sql = E.queries(), E.oracle_sql()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in queries) == 1
    assert "pipeline" in queries and set(SQL) <= set(sql) and set(QUERIES) <= set(queries)


def test_workers_find_the_package(spark):
    python_workers(spark)
    python_workers(spark)
    path = spark.sparkContext.environment["PYTHONPATH"].split(":")
    assert len(path) == len(set(path))
