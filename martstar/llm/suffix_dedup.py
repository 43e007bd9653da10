"""Suffix-array dedup: bytes of ``length``-byte strings that start in an earlier document.

1. Anchors. Of every string of ``length`` bytes the smallest hash among its
   ``GRAM``-byte substrings marks an anchor, so equal strings have equal
   anchors at equal places. The starts that share an anchor form a segment;
   a document is covered by its segments, one per 16 bytes or so.
2. Segments are compared by (hash of the anchor's gram, BLAKE2b digest of the
   segment's bytes, 96 bits under a salt drawn for the run). A segment whose equal
   occurs in an earlier document goes as a whole. Polynomial hashes choose
   anchors and order suffixes but never decide that bytes are equal: nobody can
   write texts whose digests collide under a salt they don't know. Only where an
   anchor is shared but the segments differ (the ends of a repeat) are bytes
   brought together.
3. The bytes of those segments are brought together by anchor and their
   suffixes are sorted: by the first 16 bytes, then by a mergesort that finds
   the common extension of two suffixes with prefix polynomial hashes and
   binary search. Neighbours that share ``length`` bytes by hash are verified
   byte by byte; a collision sends its run to a plain sort. In each run the
   smallest document stays.
4. A last shuffle brings the spans to their texts.

An anchor shared by more than ``HOT`` segments of one task or bucket (a line
that very many documents hold) is split: its strings of ``length`` bytes are
sorted where they are and sent on by their own hash, once per task.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from martstar.llm.common import keep
from martstar.llm.spans import (
    BLOB_TYPE, Pieces, batches_of_bytes, by_bucket, cut_out, least_of, pack_strings, packed_texts, runs_of,
    sources, split_kinds, texts_of, unpack, unpack_strings)

LENGTH = 50
GRAM = 19
WIDTH = LENGTH - GRAM + 1  # grams in a string; a power of two
BASE = 0x9E3779B97F4A7C15
BLOCK_BYTES = 1 << 18
# of the gram's hash (besides the bucket, whose number grows with the data) and the segment's digest
KEY_BYTES = (4, 8, 4)
SALT_BYTES = 16
HOT = 4096
HEAD = 16  # bytes compared before the mergesort

KEYS, SPANS, ASKED, HOT_ASKED = 0, 1, 2, 3


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class PrefixHash:
    """Polynomial hashes of all substrings, modulo 2**64, from prefix sums."""

    def __init__(self, b: np.ndarray):
        n = len(b)
        self.up = _powers(BASE, n + 1)
        terms = (b.astype(np.uint64) + np.uint64(1)) * _powers(pow(BASE, -1, 1 << 64), n + 1)[:n]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.up[start]


_memo: dict = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _memo.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, 1 << 16), base, np.uint64)
        p[0] = 1
        have = _memo[base] = np.cumprod(p)
    return have[:n]


def segments(raws: list[bytes], salt: bytes = b""):
    """(document number, first start, last start, gram hash, digest in two parts) over texts laid end to end."""
    lens = np.array([len(r) for r in raws], np.int64)
    joined = b"".join(raws)
    b = np.frombuffer(joined, np.uint8)
    n = len(b)
    none = np.empty(0, np.int64)
    nothing = (none, none, none, *[none.astype(np.uint64)] * 3)
    if n < LENGTH:
        return nothing
    ph = PrefixHash(b)
    at = np.arange(n - GRAM + 1)
    gram = _mix(ph.of(at, GRAM))
    # the smallest hash, the leftmost of equals: places grow from left to right
    low = (gram & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    step = 1
    while step < WIDTH:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    ends = np.cumsum(lens)
    doc = np.repeat(np.arange(len(raws)), lens)[:len(low)]
    p = np.flatnonzero(np.arange(len(low)) + LENGTH <= ends[doc])
    if not len(p):
        return nothing
    anchor = (low[p] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.r_[True, anchor[1:] != anchor[:-1]]
    i = np.flatnonzero(new)
    s, e = p[i], p[np.r_[i[1:], len(p)] - 1]
    d = doc[s]
    digest = hashlib.blake2b
    whole = np.frombuffer(bytearray().join(
        [digest(joined[x:y], digest_size=12, salt=salt).digest() for x, y in zip(s.tolist(), (e + LENGTH).tolist())]),
        dtype=[("a", "<u8"), ("b", "<u4")])
    base = (ends - lens)[d]
    return d, s - base, e - base, gram[anchor[i]], whole["a"].copy(), whole["b"].astype(np.uint64)


def _long_texts(rows):
    """Rows cut into blocks that overlap by length - 1 bytes: (row, offset, bytes)."""
    for r in rows:
        raw = r[3]
        for lo in range(0, max(1, len(raw)), BLOCK_BYTES):
            if lo == 0 or len(raw) - lo >= LENGTH:
                yield r, lo, raw[lo:lo + BLOCK_BYTES + LENGTH - 1]


def _compare(k1, k2, k3, did, hot):
    """(goes, asked, hot): per segment, after a look at all with the same anchor gram."""
    o, runs = runs_of(k1, k2, k3)
    goes = did > least_of(did, o, runs)
    # a gram whose remaining segments belong to several documents
    rest = np.flatnonzero(~goes)
    o, runs = runs_of(k1[rest])
    low, high = least_of(did[rest], o, runs), -least_of(-did[rest], o, runs)
    n = np.diff(np.r_[runs, len(o)])
    size = np.empty(len(rest), np.int64)
    size[o] = np.repeat(n, n)
    many = -least_of(-(hot[rest] | (size > HOT)).astype(np.int64), o, runs) > 0
    asked = np.zeros(len(did), bool)
    is_hot = np.zeros(len(did), bool)
    asked[rest] = low < high
    is_hot[rest] = many & (low < high)
    return goes, asked, is_hot


def whole_segments(docs: DataFrame, n_buckets: int) -> DataFrame:
    """Packed rows by document bucket: spans that go, and segments asked for."""

    salt = os.urandom(SALT_BYTES)  # drawn once, so that a task that runs again finds the same digests

    def find(batches):
        def send(k1, k2, k3, did, th, bucket, s, e):
            no = np.zeros(len(did), bool)
            goes, _, hot = _compare(k1, k2, k3, did, no)
            g, h = np.flatnonzero(goes), np.flatnonzero(hot)
            # of a hot gram two segments go on, those of its first and last document
            stay = ~goes & ~hot
            o, runs = runs_of(k1[h], did[h])
            k = k1[h][o]
            edge = np.r_[True, k[1:] != k[:-1]] | np.r_[k[1:] != k[:-1], True] if len(h) else np.empty(0, bool)
            stay[h[o[edge]]] = True
            t = np.flatnonzero(stay)
            to = ((k1[t] >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.int64)
            return [by_bucket(bucket[g], SPANS, [did[g], th[g], s[g], e[g] + LENGTH]),
                    by_bucket(bucket[h], HOT_ASKED, [did[h], th[h], s[h], e[h] + LENGTH, 0 * s[h]]),
                    by_bucket(to, KEYS, [x[t] for x in (did, th, bucket, s, e - s, hot)],
                              [(k[t], w) for k, w in zip((k1, k2, k3), KEY_BYTES)])]

        pieces = Pieces(send)
        for rows in batches_of_bytes(batches, BLOCK_BYTES):
            parts = list(_long_texts(rows))
            d, s, e, *keys = segments([x for _, _, x in parts], salt)
            own = [np.array([r[i] for r, _, _ in parts], np.int64)[d] for i in range(3)]
            off = np.array([lo for _, lo, _ in parts], np.int64)[d]
            yield from pieces.add(*keys, *own, s + off, e + off)
        yield from pieces.flush()

    def one(bucket, blobs):
        rows = [unpack(x, 6, KEY_BYTES) for x in blobs]
        did, th, own, s, n, hot, *keys = [np.concatenate(c) for c in zip(*rows)]
        goes, asked, is_hot = _compare(*keys, did, hot > 0)
        e = s + n + LENGTH
        i = np.flatnonzero(goes)
        yield by_bucket(own[i], SPANS, [did[i], th[i], s[i], e[i]])
        for kind, mask in ((ASKED, asked & ~is_hot), (HOT_ASKED, is_hot)):
            i = np.flatnonzero(mask)
            yield by_bucket(own[i], kind, [did[i], th[i], s[i], e[i], np.full(len(i), bucket, np.int64)])

    def compare(batches):
        yield from split_kinds(batches, KEYS, one)

    return (docs.select("did", "th", "bucket", "text").mapInPandas(find, BLOB_TYPE)
            .repartition(n_buckets, "bucket").mapInPandas(compare, BLOB_TYPE))


# -- the sort ---------------------------------------------------------------
def _extension(ph: PrefixHash, a: np.ndarray, b: np.ndarray, known: int) -> np.ndarray:
    """Common extension of suffixes a and b up to LENGTH, ``known`` bytes being equal."""
    lo = np.full(len(a), known, np.int64)
    hi = np.full(len(a), LENGTH, np.int64)
    while (lo < hi).any():
        mid = (lo + hi + 1) >> 1
        same = ph.of(a, mid) == ph.of(b, mid)
        lo = np.where(same, mid, lo)
        hi = np.where(same, hi, mid - 1)
    return lo


def _before(b, ph, x, y, known, ties) -> np.ndarray:
    """Suffix x sorts before y; equal ones by ``ties``."""
    n = _extension(ph, x, y, known)
    differ = n < LENGTH
    end = len(b) - 1
    return np.where(differ, b[np.minimum(x + n, end)] < b[np.minimum(y + n, end)], ties)


def sort_suffixes(b: np.ndarray, ph: PrefixHash, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the suffixes by LENGTH bytes, whether each equals the one before it).

    Only suffixes that share their first HEAD bytes with another go through the
    mergesort; all runs are merged together, level by level.
    """
    words = [np.zeros(len(at), np.uint64) for _ in range(HEAD // 8)]
    for i in range(HEAD):
        words[i // 8] = (words[i // 8] << np.uint64(8)) | b[at + i].astype(np.uint64)
    order, starts = runs_of(*words)
    size = np.diff(np.r_[starts, len(order)])
    run = np.repeat(np.arange(len(size)), size)
    multi = size[run] > 1
    pos = np.flatnonzero(multi)  # places in ``order`` that still need sorting
    first, last = starts[run[pos]], starts[run[pos]] + size[run[pos]]
    width, top = 1, int(size.max(initial=1))
    while width < top:
        block = (pos - first) // width
        left = block % 2 == 0
        sib_lo = np.where(left, first + (block + 1) * width, first + (block - 1) * width)
        sib_lo = np.minimum(sib_lo, last)
        sib_hi = np.minimum(sib_lo + width, last)
        lo, hi = sib_lo.copy(), sib_hi.copy()
        mine = at[order[pos]]
        while True:  # how many of the sibling block come before each suffix
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            other = at[order[mid]]
            # the left block wins ties
            ahead = _before(b, ph, other, mine[open_], HEAD, ~left[open_])
            lo[open_] = np.where(ahead, mid + 1, lo[open_])
            hi[open_] = np.where(ahead, hi[open_], mid)
        pair = first + (block - block % 2) * width
        target = pair + (pos - first - block * width) + (lo - sib_lo)
        merged_order = order.copy()
        merged_order[target] = order[pos]
        order = merged_order
        width *= 2
    same = np.zeros(len(order), bool)
    inner = pos[pos > first]
    x, y = at[order[inner - 1]], at[order[inner]]
    hit = _extension(ph, x, y, HEAD) >= LENGTH
    inner, x, y = inner[hit], x[hit], y[hit]
    true = np.ones(len(inner), bool)  # verification of the bytes themselves
    for i in range(HEAD, LENGTH):
        true &= b[x + i] == b[y + i]
    same[inner[true]] = True
    for r in np.unique(run[inner[~true]]):  # a collision: sort the run by its bytes
        lo, hi = starts[r], starts[r] + size[r]
        raw = b.tobytes()
        keyed = sorted((raw[at[i]:at[i] + LENGTH], i) for i in order[lo:hi].tolist())
        order[lo:hi] = [i for _, i in keyed]
        same[lo + 1:hi] = [k[0] == j[0] for k, j in zip(keyed, keyed[1:])]
    return order, same


def _later(strings: list[bytes], did: np.ndarray):
    """(string number, start, goes) of every start of LENGTH bytes in the strings."""
    lens = np.array([len(x) for x in strings], np.int64)
    b = np.frombuffer(b"".join(strings), np.uint8)
    per = lens - LENGTH + 1
    own = np.repeat(np.arange(len(strings)), per)
    off = np.arange(len(own)) - np.repeat(np.cumsum(per) - per, per)
    at = (np.cumsum(lens) - lens)[own] + off
    order, same = sort_suffixes(b, PrefixHash(b), at)
    starts = np.flatnonzero(~same)
    return own, off, at, b, order, starts, did[own] > least_of(did[own], order, starts)


STRINGS = 4


def partial_segments(docs: DataFrame, asked: DataFrame, n_buckets: int) -> DataFrame:
    """Packed spans by document bucket from the segments asked for."""

    def fetch(own: pd.DataFrame, blobs: pd.DataFrame) -> pd.DataFrame:
        if not len(blobs) or not len(own):
            return by_bucket(np.empty(0, np.int64), SPANS, [])
        text = {(d, h): raw for d, h, _, raw in texts_of(own["data"])}
        bucket = int(own["bucket"].iloc[0])

        def read(kind: int):
            """(did, th, start, to bucket) and the bytes of the segments asked for."""
            rows = [unpack(x, 5) for k, x in zip(blobs["kind"], blobs["data"]) if k == kind]
            if not rows:
                return None
            did, th, s, e, to = [np.concatenate(c) for c in zip(*rows)]
            return did, th, s, to, [text[(d, h)][a:z] for d, h, a, z in zip(
                did.tolist(), th.tolist(), s.tolist(), e.tolist())]

        frames = []

        def send(did, th, s, to, strings):
            o = np.argsort(to, kind="stable")
            cut = np.flatnonzero(np.r_[True, to[o][1:] != to[o][:-1]])
            for a, z in zip(cut.tolist(), np.r_[cut[1:], len(o)].tolist()):
                i = o[a:z]
                data = pack_strings([did[i], th[i], np.full(len(i), bucket, np.int64), s[i]], [strings[j] for j in i])
                frames.append(pd.DataFrame({"bucket": [np.int32(to[i[0]])], "kind": [np.int32(STRINGS)], "data": [data]}))

        plain, hot = read(ASKED), read(HOT_ASKED)
        if plain:  # to the bucket of the anchor's gram
            send(*plain)
        if hot:  # sorted here; one copy of each string goes on, by its own hash
            did, th, s, _, strings = hot
            o, off, at, b, order, runs, goes = _later(strings, did)
            to = ((_mix(PrefixHash(b).of(at, LENGTH)) >> np.uint64(33)) % np.uint64(n_buckets)).astype(np.int64)
            run = np.empty(len(order), np.int64)
            run[order] = np.repeat(np.arange(len(runs)), np.diff(np.r_[runs, len(order)]))
            place = s[o] + off
            i = np.flatnonzero(goes)
            frames.append(by_bucket(np.full(len(i), bucket, np.int64), SPANS,
                                    [did[o[i]], th[o[i]], place[i], place[i] + LENGTH]))
            i = np.flatnonzero(~goes)
            sort, starts = runs_of(run[i], did[o[i]], th[o[i]], place[i])  # overlapping segments repeat places
            i = i[sort[starts]]
            raw = b.tobytes()
            send(did[o[i]], th[o[i]], place[i], to[i], [raw[x:x + LENGTH] for x in at[i].tolist()])
        return pd.concat(frames, ignore_index=True)

    def one(_, blobs):
        rows, strings = [], []
        for x in blobs:
            columns, own = unpack_strings(x, 4)
            rows.append(columns)
            strings += own
        did, th, own, start = [np.concatenate(c) for c in zip(*rows)]
        o, off, _, _, _, _, goes = _later(strings, did)
        i = np.flatnonzero(goes)
        if not len(i):
            return
        k, s = o[i], start[o[i]] + off[i]
        # neighbouring starts of a segment leave as one span
        a = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (s[1:] != s[:-1] + 1)])
        z = np.r_[a[1:], len(i)] - 1
        yield by_bucket(own[k[a]], SPANS, [did[k[a]], th[k[a]], s[a], s[z] + LENGTH])

    def sort(batches):
        yield from split_kinds(batches, STRINGS, one)

    return (packed_texts(docs).groupBy("bucket").cogroup(asked.groupBy("bucket"))
            .applyInPandas(fetch, BLOB_TYPE)
            .repartition(n_buckets, "bucket").mapInPandas(sort, BLOB_TYPE))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 [, kept]: one row per input row.

    Bytes are those of the UTF-8 text; null is empty, texts of fewer than 50
    bytes keep all. Rows that repeat a doc_id don't remove from each other. A
    null id ranks last. An empty table gives an empty result.
    """
    src, n = sources(docs, id_col, text_col)
    found = keep(whole_segments(src, n))  # read twice
    asked = found.where(f"kind in ({ASKED}, {HOT_ASKED})")
    spans = found.where(f"kind = {SPANS}").select("bucket", "data").unionByName(
        partial_segments(src, asked, n).select("bucket", "data"))
    return cut_out(src, spans, with_text)
