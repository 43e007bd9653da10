"""Substring dedup by content-defined chunking.

A gear hash rolls over the bytes of a text: each step shifts the hash by one
bit and adds a random number of the byte, so its low 16 bits depend on the last
16 bytes. A chunk ends where these bits are smaller than at any of the ``REACH``
bytes before and no larger than at the ``REACH`` bytes behind, so chunks have
more than ``REACH`` bytes, ``MOST`` at the latest, and a cut depends on nothing
but the bytes around it: an insertion moves only the cuts next to it, and the
copies of a passage are cut alike from their first bytes on.

Chunks are deduplicated by their BLAKE2b digest: the chunk of the smallest
doc_id stays, the first within it, all others are taken out. Runs of copied
chunks of fewer than ``LEAST_RUN`` bytes stay, unless such a run is the whole text:
they are common phrases rather than passages. Their bytes are counted beside it. Copies within a task are settled there; what is left is packed
by digest and settled after one shuffle; a second one brings the spans to their
texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from martstar.llm.spans import (
    BLOB_TYPE, Pieces, batches_of_bytes, by_bucket, cut_out, least_of, runs_of, sources, split_kinds, unpack)

REACH = 8
MOST = 256
LEAST_RUN = 50
WINDOW = 16
KEY_BYTES = (8, 8)
BLOCK_BYTES = 1 << 20

GEAR = np.random.default_rng(20240229).integers(0, 1 << 16, 256, dtype=np.uint16)

KEYS, SPANS = 0, 1


def gear_hash(b: np.ndarray) -> np.ndarray:
    """The rolling hash behind every byte, by doubling the window; 16 bits hold 16 bytes."""
    h = GEAR[b]
    width = 1
    while width < WINDOW:
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint16(width)
        h, width = longer, width * 2
    return h


def _marks(h: np.ndarray) -> np.ndarray:
    """Places whose hash is below the REACH before and not above the REACH behind."""
    inf = np.full(REACH, 1 << 16, np.int32)
    low = np.concatenate([inf, h.astype(np.int32), inf])
    step = 1
    while step < REACH:  # smallest of REACH neighbours
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    n = len(h)
    return np.flatnonzero((h < low[:n]) & (h <= low[REACH + 1:REACH + 1 + n]))


def chunk_ends(b: bytes) -> list[int]:
    """Ends of the chunks of one text; the last is its length."""
    n = len(b)
    parts = []
    for lo in range(0, n, BLOCK_BYTES):  # long texts in blocks that overlap by all a cut depends on
        back = min(lo, WINDOW - 1 + REACH)
        size = min(BLOCK_BYTES, n - lo)
        h = gear_hash(np.frombuffer(b, np.uint8, min(size + REACH, n - lo) + back, lo - back))
        m = _marks(h) - back
        parts.append(m[(m >= 0) & (m < size)] + lo)
    marks = np.concatenate(parts) if parts else np.empty(0, np.int64)
    ends = (marks[marks >= REACH] + 1).tolist()
    if not ends or ends[-1] < n:
        ends += [n] * (n > 0)
    out, at = [], 0
    for m in ends:
        while m - at > MOST:
            at += MOST
            out.append(at)
        out.append(m)
        at = m
    return out


def _settle(k1, k2, did):
    """Mask of chunks of which a smaller document holds a copy."""
    o, runs = runs_of(k1, k2)
    return did > least_of(did, o, runs)


def removed_chunks(docs: DataFrame, n_buckets: int) -> DataFrame:
    """Packed spans (did, th, start, end) by document bucket."""

    def cut(batches):
        def send(k1, k2, did, th, bucket, start, end, again):
            gone = again | _settle(k1, k2, did)
            stay = np.flatnonzero(~gone)
            to = (k1[stay] >> np.uint64(20)) % np.uint64(n_buckets)
            g = np.flatnonzero(gone)
            return [by_bucket(bucket[g], SPANS, [did[g], th[g], start[g], end[g]]),
                    by_bucket(to.astype(np.int64), KEYS,
                              [x[stay] for x in (did, th, bucket, start, end - start)],
                              [(k1[stay], KEY_BYTES[0]), (k2[stay], KEY_BYTES[1])])]

        pieces = Pieces(send)
        for rows in batches_of_bytes(batches, BLOCK_BYTES):
            ends = [chunk_ends(raw) for _, _, _, raw in rows]
            n = [len(e) for e in ends]
            digests, again = [], []
            for (_, _, _, raw), es in zip(rows, ends):
                seen, s = set(), 0
                for e in es:
                    d = hashlib.blake2b(raw[s:e], digest_size=16).digest()
                    again.append(d in seen)
                    seen.add(d)
                    digests.append(d)
                    s = e
            k = np.frombuffer(bytearray().join(digests), "<u8").reshape(-1, 2)
            end = np.array([e for es in ends for e in es], np.int64)
            start = np.r_[np.int64(0), end[:-1]] if len(end) else end
            first = np.cumsum([0, *n[:-1]])[np.array(n) > 0]
            start[first] = 0
            own = [np.repeat(np.array([r[i] for r in rows], np.int64), n) for i in range(3)]
            yield from pieces.add(k[:, 0], k[:, 1], *own, start, end, np.array(again, bool))
        yield from pieces.flush()

    def one(_, blobs):
        rows = [unpack(x, 5, KEY_BYTES) for x in blobs]
        did, th, bucket, start, size, k1, k2 = [np.concatenate(c) for c in zip(*rows)]
        g = np.flatnonzero(_settle(k1, k2, did))
        yield by_bucket(bucket[g], SPANS, [did[g], th[g], start[g], start[g] + size[g]])

    def settle(batches):
        yield from split_kinds(batches, KEYS, one)

    return (docs.select("did", "th", "bucket", "text").mapInPandas(cut, BLOB_TYPE)
            .repartition(n_buckets, "bucket").mapInPandas(settle, BLOB_TYPE).select("bucket", "data"))


def chunk_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_copied [, kept]: one row per input row.

    Bytes are those of the UTF-8 text; null is empty. Of equal chunks the first
    of the smallest doc_id stays; rows that repeat a doc_id don't remove from
    each other. Removed runs have LEAST_RUN bytes at least or are the whole text;
    n_copied counts the bytes of all copied chunks. A null id ranks last. An empty table gives an empty result.
    """
    src, n = sources(docs, id_col, text_col)
    return cut_out(src, removed_chunks(src, n), with_text, LEAST_RUN)
