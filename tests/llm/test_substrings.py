"""Suffix-array and chunk dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest

from martstar.llm import chunk_dedup, suffix_dedup

SCHEMA = "doc_id long, text string, bucket string, did string, lang string"


def fixture(seed=0, n=60):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(2, 7))) for _ in range(80)]
    prose = lambda k: " ".join(r.choice(words) for _ in range(k))
    common, passage = prose(14), prose(60)
    rows = []
    for i in range(n):
        t = prose(r.randint(0, 120))
        if i % 3 == 0:
            t = t[: len(t) // 2] + common + t[len(t) // 2:]
        if i % 7 == 0:
            t = prose(3) + passage + prose(5)
        if i % 11 == 5:
            t = rows[i - 3][1] or ""
        if i % 13 == 6:  # a near copy
            w = (rows[i - 1][1] or "").split()
            t = " ".join(x if r.random() > 0.05 else r.choice(words) for x in w)
        rows.append((i * 3 + 1, t, "b", "d", None))
    rows += [(1000, None, None, None, None), (1001, "", None, None, None), (1002, "x" * 49, None, None, None),
             (1003, "x" * 300, None, None, None), (1004, "x" * 60, None, None, None),
             (4, rows[1][1], None, None, None), (4, passage, None, None, None),
             (2**60 + 1, passage, None, None, None), (None, passage + common, None, None, None), (None, passage, None, None, None)]
    r.shuffle(rows)
    return rows


def brute_suffix(rows, length=50):
    """Per row: removed byte mask, by looking every string up in all smaller documents."""
    key = lambda d: 2**63 - 1 if d is None else d
    first: dict[bytes, int] = {}
    raws = [(key(d), (t or "").encode()) for d, t, *_ in rows]
    for d, b in raws:
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            first[s] = min(first.get(s, d), d)
    out = []
    for d, b in raws:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < d:
                gone[p:p + length] = True
        left = bytes(np.frombuffer(b, np.uint8)[~gone]) if len(b) else b""
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((rows[len(out)][0], len(b), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()],
                  key=str)


@pytest.mark.parametrize("hot", [4096, 2])
def test_suffix_dedup_is_brute_force(spark, monkeypatch, hot):
    """With a tiny limit common anchors take the split path."""
    rows = fixture()
    find = suffix_dedup._compare

    def compare(*columns):
        suffix_dedup.HOT = hot  # in the worker as well
        return find(*columns)

    monkeypatch.setattr(suffix_dedup, "_compare", compare)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = collected(suffix_dedup.suffix_dedup(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert got == brute_suffix(rows)


def test_texts_with_equal_polynomial_hashes_stay(spark):
    """Two texts whose hashes modulo 2**64 are equal in every prefix that matters, found by lattice reduction."""
    a = "nnnnnnnnnnnnnnnnnnvtepnaysiactdnxygbmvqbqiflwzdotg"
    b = "lilnmonqnplnqtshjlvtepnaysiactdnxygbmvqbqiflwzdotg"
    h = suffix_dedup.PrefixHash(np.frombuffer((a + b).encode(), np.uint8))
    assert h.of(np.array([0]), 50) == h.of(np.array([50]), 50)
    rows = [(1, a, 0), (2, b, 0), (3, b + " tail " * 12, 0), (4, "x " + a, 0), (5, a, 0)]
    rows = [(i, t) for i, t, _ in rows]
    got = collected(suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)))
    assert got == brute_suffix(rows)
    assert [g[2] for g in got] == [0, 0, 50, 50, 50]


def test_digests_depend_on_the_salt():
    raw = [bytes(range(97, 122)) * 4]
    a, b = (suffix_dedup.segments(raw, salt=x)[4] for x in (b"1" * 16, b"2" * 16))
    assert len(a) == len(b) > 0 and (a != b).all()


def test_suffix_sort_matches_plain_sort():
    r = random.Random(4)
    raw = bytes(r.choice(b"ab") for _ in range(400)) + b"ab" * 200 + bytes(r.choice(b"ab") for _ in range(60))
    raw = raw + raw[100:400]
    b = np.frombuffer(raw, np.uint8)
    at = np.arange(len(raw) - 50 + 1)
    order, same = suffix_dedup.sort_suffixes(b, suffix_dedup.PrefixHash(b), at)
    strings = [raw[at[i]:at[i] + 50] for i in order]
    assert strings == sorted(strings)
    assert same.tolist() == [False] + [x == y for x, y in zip(strings, strings[1:])]


def test_suffix_sort_survives_hash_collisions():
    class Blind(suffix_dedup.PrefixHash):
        def of(self, start, length):
            return np.zeros(len(start), np.uint64)

    raw = bytes(random.Random(1).choice(b"ab") for _ in range(300)) * 2
    raw = b"c" * 20 + raw
    b = np.frombuffer(raw, np.uint8)
    at = np.arange(len(raw) - 49)
    order, same = suffix_dedup.sort_suffixes(b, Blind(b), at)
    strings = [raw[at[i]:at[i] + 50] for i in order]
    assert strings == sorted(strings)
    assert same.tolist() == [False] + [x == y for x, y in zip(strings, strings[1:])]


def test_suffix_dedup_empty(spark):
    assert suffix_dedup.suffix_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_text_in_blocks(spark, monkeypatch):
    r = random.Random(9)
    t = "".join(r.choice("abcdefghij ") for _ in range(6000))
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 700)
    rows = [(1, t, None, None, None), (2, t[1234:4567] + "zz" + t[10:400], None, None, None)]
    parts = list(suffix_dedup._long_texts([(1, 0, 0, t.encode())]))
    assert len(parts) > 5
    assert collected(suffix_dedup.suffix_dedup(spark.createDataFrame(rows, SCHEMA))) == brute_suffix(rows)


# -- chunks ------------------------------------------------------------------
def plain_gear(b):
    h, out = 0, []
    for x in b:
        h = ((h << 1) + int(chunk_dedup.GEAR[x])) & 0xFFFF
        out.append(h)
    return out


def plain_ends(b):
    h, k, ends, at = plain_gear(b), chunk_dedup.REACH, [], 0
    for i in range(k, len(b)):
        if h[i] < min(h[i - k:i]) and h[i] <= min(h[i + 1:i + 1 + k], default=1 << 16):
            ends.append(i + 1)
    out = []
    for m in sorted({*ends, len(b)} - {0}):
        while m - at > chunk_dedup.MOST:
            at += chunk_dedup.MOST
            out.append(at)
        out.append(m)
        at = m
    return out


def brute_chunks(rows):
    key = lambda d: 2**63 - 1 if d is None else d
    first, cut = {}, []
    for d, t, *_ in rows:
        b = (t or "").encode()
        ends = plain_ends(b)
        chunks = [b[s:e] for s, e in zip([0, *ends], ends)]
        cut.append((d, b, chunks))
        for c in chunks:
            first[c] = min(first.get(c, key(d)), key(d))
    out = []
    for d, b, chunks in cut:
        seen, groups = set(), []
        for c in chunks:
            drop = first[c] < key(d) or c in seen
            seen.add(c)
            if groups and groups[-1][0] == drop:
                groups[-1][1].append(c)
            else:
                groups.append((drop, [c]))
        goes = lambda drop, cs: drop and (sum(map(len, cs)) >= chunk_dedup.LEAST_RUN or len(groups) == 1)
        runs = [b"".join(cs) for drop, cs in groups if goes(drop, cs)]
        left = [b"".join(cs) for drop, cs in groups if not goes(drop, cs)]
        copied = sum(len(c) for drop, cs in groups if drop for c in cs)
        out.append((d, len(b), sum(map(len, runs)), len(runs), hashlib.sha256(b"".join(left)).hexdigest(), copied))
    return sorted(out, key=str)


def collected_chunks(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_copied").collect()],
                  key=str)


def test_chunk_dedup_is_brute_force(spark, monkeypatch):
    rows = fixture(3)
    rows += [(900 + i, t) + rows[0][2:] for i, t in enumerate(["a short copy, whole", "a short copy, whole", "x", "x", "", None])]
    got = collected_chunks(chunk_dedup.chunk_dedup(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert got == brute_chunks(rows)
    assert sum(r[2] for r in got) > 1000
    assert [r[2] for r in got if r[0] in (900, 901, 902, 903)] == [0, 19, 0, 1]
    assert sum(r[5] for r in got) > sum(r[2] for r in got)


def test_chunk_blocks_do_not_move_cuts(monkeypatch):
    b = fixture(5)[0][1].encode() * 3 or b"x"
    b = " ".join(t or "" for _, t, *_ in fixture(5)).encode()
    whole = chunk_dedup.chunk_ends(b)
    monkeypatch.setattr(chunk_dedup, "BLOCK_BYTES", 333)
    assert chunk_dedup.chunk_ends(b) == whole


def test_insertion_moves_only_near_cuts():
    b = " ".join(t or "" for _, t, *_ in fixture(6)).encode()
    cut = lambda x: {x[s:e] for s, e in zip([0, *chunk_dedup.chunk_ends(x)], chunk_dedup.chunk_ends(x))}
    assert len(cut(b) - cut(b[:500] + b"inserted" + b[500:])) <= 12


def test_chunk_dedup_empty(spark):
    assert chunk_dedup.chunk_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
