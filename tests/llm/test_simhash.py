"""SimHash near-dedup against all pairs; the shard levels; the trees."""

import random
import re

import pytest
import xxhash

from martstar.llm import simhash_dedup as S
from martstar.llm.components import components
from tests.llm.helpers import SCHEMA, awkward, kept_rows, prose, stage_table, table

LAST = 2**63 - 1


def brute_fp(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def roots(values, linked):
    up = {v: v for v in values}

    def root(v):
        while up[v] != v:
            up[v] = up[up[v]]
            v = up[v]
        return v
    for i, a in enumerate(values):
        for b in values[:i]:
            if linked(a, b):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {v: root(v) for v in values}


def near(texts, n, seed=0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        w = texts[i % len(texts)].split()
        w[r.randrange(len(w))] = f"new{r.randrange(9)}"
        out.append(" ".join(w))
    return out


def test_groups_are_brute_force(spark):
    texts = awkward() + list(enumerate(near([prose(8, 900), prose(9, 700)], 60), 100))
    fps = [brute_fp(t) for _, t in texts]
    distinct = sorted(set(fps))
    root = roots(distinct, lambda a, b: (a ^ b).bit_count() <= 3)
    low = {}
    for (d, _), f in zip(texts, fps):
        low.setdefault(root[f], []).append(d)
    want = sorted(((d, f"{f:016x}", min(low[root[f]], key=lambda x: LAST if x is None else x))
                   for (d, _), f in zip(texts, fps)), key=str)
    got = S.near_groups(table(spark, texts).repartition(3)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want
    assert len(distinct) > len(set(root.values()))


@pytest.mark.parametrize("shard_rows, least", [(1024, 16), (4, 16), (4, 60)])
def test_links_join_all_pairs_at_every_level(spark, monkeypatch, shard_rows, least):
    """Tiny shards force several cuts and, with little to cut, tree pieces."""
    r = random.Random(3)
    seeds = [r.getrandbits(64) for _ in range(40)]
    values = set(seeds)
    for s in seeds[:6]:
        for _ in range(60):
            x = s
            for _ in range(r.randint(1, 4)):
                x ^= 1 << r.randrange(64)
            values.add(x)
    values = sorted(values)
    monkeypatch.setattr(S, "LEAST_BITS", least)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = S.links(spark.createDataFrame(signed, "fp long").repartition(3), 3, shard_rows).collect()
    pairs = {(x.a % (1 << 64), x.b % (1 << 64)) for x in found}
    have = roots(values, lambda a, b: (a, b) in pairs or (b, a) in pairs)
    want = roots(values, lambda a, b: (a ^ b).bit_count() <= 3)
    assert have == want


def test_tree_finds_what_a_scan_finds():
    r = random.Random(5)
    values = [r.getrandbits(16) for _ in range(400)]
    t = S.BKTree()
    for v in values:
        t.add(v)
    for q in values[:50] + [r.getrandbits(16) for _ in range(50)]:
        assert sorted(t.within(q, 3)) == sorted({v for v in values if (v ^ q).bit_count() <= 3})


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(200))


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    t = prose(4, 500)
    whole = S.fingerprint(t)
    monkeypatch.setattr(S, "BLOCK_SHINGLES", 7)
    assert S.fingerprint(t) == whole == (brute_fp(t) - (1 << 64) if brute_fp(t) >> 63 else brute_fp(t))


def test_drop_and_empty(spark):
    d = table(spark, awkward())
    out = S.drop_near_copies(d)
    assert out.columns == d.columns
    ids = [r.doc_id for r in out.collect()]
    assert 3 in ids and 5 not in ids and 9 not in ids and 21 not in ids and 11 in ids and 12 not in ids
    e = spark.createDataFrame([], SCHEMA)
    assert S.near_groups(e).count() == 0 and S.drop_near_copies(e).count() == 0


def test_drop_tells_repeated_and_null_ids_apart(spark):
    a = prose(8, 900)
    b = next(x for x in near([a], 40) if 0 < (brute_fp(x) ^ brute_fp(a)).bit_count() <= 3)
    own, other = prose(31, 300), prose(32, 300)
    texts = [(1, a), (7, own), (7, b), (7, b), (None, a), (None, other), (8, prose(33, 200)), (8, prose(33, 200)), (5, None), (5, " "), (6, "")]
    d = stage_table(spark, texts)
    got = kept_rows(S.drop_near_copies(d.repartition(3)), d)
    # by hand: per component the smallest (id, digest), once
    import hashlib
    root = roots(sorted({brute_fp(t) for _, t in texts}), lambda x, y: (x ^ y).bit_count() <= 3)
    best = {}
    for i, t in texts:
        key = (LAST if i is None else i, hashlib.sha256((t or "").encode()).hexdigest())
        best[root[brute_fp(t)]] = min(best.get(root[brute_fp(t)], (key, i, t)), (key, i, t), key=lambda x: x[0])
    assert [(i, t or "") for i, t in got] == sorted(((i, t or "") for _, i, t in best.values()), key=str)
    assert (7, own) in got and (None, other) in got and (7, b) not in got
