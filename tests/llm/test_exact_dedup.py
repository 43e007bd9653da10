"""Exact dedup against grouping by hand; the heavy-hitter path; the filter."""

import hashlib
import re

from martstar.llm import exact_dedup as X
from tests.llm.helpers import SCHEMA, awkward, kept_rows, stage_table, table

LAST = 2**63 - 1


def expected(texts):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in texts]
    rank = lambda d: LAST if d is None else d
    groups = {}
    for (d, _), t in zip(texts, norm):
        groups.setdefault(t, []).append(d)
    return sorted(((d, min(groups[t], key=rank), len(groups[t]), hashlib.sha256(t.encode()).hexdigest())
                   for (d, _), t in zip(texts, norm)), key=str)


def test_groups_by_hand(spark):
    texts = awkward()
    for counters in (1024, 2):
        rows = X.exact_groups(table(spark, texts).repartition(3), counters=counters).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str) == expected(texts)
        kept = {}
        for r in rows:
            kept.setdefault(r.text_sha256, []).append(r)
        # exactly one row of a group stays, one with the smallest id
        for g in kept.values():
            stay = [r for r in g if r.kept]
            assert len(stay) == 1 and stay[0].doc_id == stay[0].keep_id


def test_a_third_of_all_rows_is_one_text(spark):
    texts = [(i, "same text" if i % 3 == 0 else f"own {i}") for i in range(3000, 0, -1)]
    d = table(spark, texts).repartition(5)
    base = d.select(X.digest_of("text").alias("digest"), X.F.struct(X.F.col("doc_id").alias("r")).alias("who"))
    assert [r.n for r in X.winners(base, 64).collect()] == [1000]
    assert sum(r.kept for r in X.exact_groups(d).collect()) == 2001


def test_drop_copies_keeps_columns_and_one_row(spark):
    d = table(spark, awkward())
    out = X.drop_copies(d)
    assert out.columns == d.columns
    rows = [(r.doc_id, r.text) for r in out.collect()]
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    assert len(norm) == len(set(norm)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in awkward()})
    assert 3 in {i for i, _ in rows} and 5 not in {i for i, _ in rows}


def test_empty(spark):
    e = spark.createDataFrame([], SCHEMA)
    assert X.exact_groups(e).count() == 0 and X.drop_copies(e).count() == 0


def test_drop_copies_tells_repeated_and_null_ids_apart(spark):
    texts = [(1, "a text"), (7, "own"), (7, "a  text"), (7, "own"), (None, "a text"), (None, "null's own"), (None, None),
             (None, ""), (9, " "), (2, "")]
    d = stage_table(spark, texts)
    for counters in (1024, 2):
        assert kept_rows(X.drop_copies(d.repartition(3), counters=counters), d) in (
            sorted([(1, "a text"), (7, "own"), (None, "null's own"), (9, " "), (2, "")], key=str),)
