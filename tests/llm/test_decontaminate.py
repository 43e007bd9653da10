"""Benchmark decontamination against every window of every document."""

import random
import re
from collections import Counter

import pytest

from martstar.llm import decontaminate as D
from tests.llm.helpers import SCHEMA, awkward, kept_rows, prose, stage_table, table


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute(texts, items, k=5, threshold=0.8):
    out = {}
    for item, text in items:
        w = words(text)
        if not w:
            continue
        kk = min(k, len(w))
        sh = lambda x: Counter(" ".join(x[i:i + kk]) for i in range(len(x) - kk + 1))
        own = sh(w)
        for d, t in texts:
            dw = words(t)
            for p in range(len(dw) - len(w) + 1):
                s = sh(dw[p:p + len(w)])
                sim = sum((s & own).values()) / sum((s | own).values())
                if sim >= threshold - 1e-12:
                    out[(d, item)] = max(out.get((d, item), 0), sim)
    return out


def changed(text, n, seed):
    r = random.Random(seed)
    w = text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"zz{r.randrange(99)}"
    return " ".join(w)


ITEMS = [(1, prose(1, 40)), (2, prose(2, 16)), (3, prose(3, 59)), (4, prose(4, 7)), (5, "two words"), (6, None), (7, ""),
         (8, prose(1, 40)), (9, "one " * 30)]


def documents():
    long = prose(21, 400)
    out = [(0, long)]
    for i, (item, text) in enumerate(ITEMS[:5]):
        out.append((10 + i, long[:300] + " " + text.upper() + ". " + long[300:]))
        out.append((20 + i, long + " " + changed(text, 1, i)))
        w = text.split()
        out.append((30 + i, " ".join(w[:len(w) // 2] + ["inserted"] + w[len(w) // 2:]) + " " + long))
        out.append((40 + i, text + " " + text))
    out.append((50, " ".join(ITEMS[2][1].split()[:30])))
    out.append((51, "one " * 100))
    out.append((52, ITEMS[2][1].replace(" ", ", ") + " end"))
    return out + awkward()


def test_pairs_are_brute_force(spark):
    texts = documents()
    want = brute(texts, ITEMS)
    got = D.leaks(table(spark, texts).repartition(3), spark.createDataFrame(ITEMS, "item_id long, text string"))
    rows = {(r.doc_id, r.item_id): r.similarity for r in got.collect()}
    # items 1 and 8 are the same text: one row names it
    same = {(d, 1 if i == 8 else i): s for (d, i), s in want.items()}
    assert {(d, 1 if i == 8 else i): pytest.approx(s) for (d, i), s in rows.items()} == same
    assert len(rows) > 20


def test_stride_meets_every_match():
    for lens in ([16, 30], [5], [9, 59], [7, 8], [40]):
        s = D.safe_stride(lens, 5, 0.8)
        for m in lens:
            n = m - 4
            foreign = int(n * 0.2 / 1.8 + 1e-9)
            for first in range(s):  # the looked-up places of a window cannot all be foreign
                assert len(range(first, n, s)) > foreign or n < s and s == 1


def test_joins_by_shuffle_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    texts = documents()[:12]
    got = D.leaks(table(spark, texts), spark.createDataFrame(ITEMS[:3], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == set(brute(texts, ITEMS[:3]))


def test_drop_and_empty(spark):
    texts = documents()
    items = spark.createDataFrame(ITEMS[:4], "item_id long, text string")
    d = table(spark, texts)
    out = D.drop_leaks(d, items)
    bad = {n for n, _ in brute([(n, t) for n, (_, t) in enumerate(texts)], ITEMS[:4])}  # rows, not ids
    assert out.columns == d.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted((i for n, (i, _) in enumerate(texts) if n not in bad), key=str)
    e = spark.createDataFrame([], SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    unnamed = spark.createDataFrame([(None, ITEMS[0][1])], "item_id long, text string")
    assert D.leaks(d, unnamed).count() == 0
    assert D.leaks(e, items).count() == 0 and D.leaks(d, none).count() == 0 and D.drop_leaks(d, none).count() == len(texts)


def brute_short(texts, items, k=5, threshold=0.8):
    """As brute, and a document shorter than an item is one window."""
    out = brute(texts, items, k, threshold)
    for d, t in texts:
        dw = words(t)
        for item, text in items:
            w = words(text)
            kk = min(k, len(w))
            if kk <= len(dw) < len(w):
                a, b = (Counter(" ".join(x[i:i + kk]) for i in range(len(x) - kk + 1)) for x in (dw, w))
                sim = sum((a & b).values()) / sum((a | b).values())
                if sim >= threshold - 1e-12:
                    out[(d, item)] = max(out.get((d, item), 0), sim)
    return out


def test_documents_shorter_than_an_item(spark):
    items = [(1, prose(1, 38)), (2, prose(2, 15)), (3, prose(3, 59)), (4, prose(4, 7)), (5, "two words"), (6, prose(6, 300))]
    texts = []
    for item, text in items:
        w = text.split()
        for cut in range(1, 14 if len(w) < 100 else 66):
            for j, part in enumerate((w[cut:], w[:-cut], w[cut // 2:len(w) - (cut - cut // 2)])):
                texts.append((item * 1000 + cut * 10 + j, " ".join(part)))
        texts.append((item * 1000 + 990, changed(" ".join(w[:-1]), 1, item)))
    want = brute_short(texts, items)
    docs = table(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in D.leaks(docs, bench).collect()}
    assert {x: r.similarity for x, r in got.items()} == {x: pytest.approx(s) for x, s in want.items()}
    assert len(want) > 150 and {i for _, i in want} == {1, 2, 3, 6}
    # one window a document, however many blocks it has
    assert {r.n_windows for r in got.values()} == {1}
    assert {r.doc_id for r in D.drop_leaks(docs, bench).collect()} == {d for d, _ in texts} - {d for d, _ in want}


def test_stride_meets_every_shorter_match():
    for lens in ([15, 59], [16], [7, 8], [30, 38], [40]):
        s = D.safe_stride(lens, 5, 0.8)
        for m in lens:
            n = m - 4
            for v in range(1, n + 1):
                shared = next((x for x in range(v + 1) if x >= 0.8 * (n + v - x) - 1e-9), None)
                assert shared is None or len(range(0, v, s)) > v - shared


def test_drop_tells_repeated_and_null_ids_apart(spark):
    leak = "before " + ITEMS[0][1] + " after"
    texts = [(3, leak), (3, prose(41, 50)), (None, leak), (None, prose(42, 50)), (None, None), (4, prose(43, 50)), (4, prose(43, 50))]
    d = stage_table(spark, texts)
    items = spark.createDataFrame(ITEMS[:4], "item_id long, text string")
    assert kept_rows(D.drop_leaks(d.repartition(3), items), d) == sorted([x for x in texts if x[1] != leak], key=str)


def test_radius_keeps_the_matches(spark):
    """The share of windows of the wanted similarity whose fingerprints lie within the radius."""
    import xxhash

    def fp(x):
        h = [xxhash.xxh64_intdigest(" ".join(x[i:i + 5]).encode(), 42) for i in range(len(x) - 4)]
        return sum(1 << b for b in range(64) if sum(v >> b & 1 for v in h) * 2 > len(h))

    far = []
    for i in range(1500):
        r = random.Random(i)
        w = prose(i, r.randint(16, 59), 5000).split()
        x = list(w)
        for _ in range(r.randint(1, 3)):
            x[r.randrange(len(x))] = "changed"
        a, b = (Counter(" ".join(y[j:j + 5]) for j in range(len(y) - 4)) for y in (w, x))
        if sum((a & b).values()) / sum((a | b).values()) >= 0.8:
            far.append((fp(w) ^ fp(x)).bit_count())
    assert len(far) > 100 and sum(d <= D.RADIUS for d in far) / len(far) >= 0.99
