"""Keyed pieces of documents, packed for the shuffle, and spans to cut out.

The substring operators make one key per few dozen bytes of text. Keys travel
as columns of numbers packed per bucket, not as a row each: a task first
resolves what it can among its own documents and sends on only the pieces of
the smallest document for each key, so the copies of a passage, however many,
arrive once per task.

Documents are named by (rank of the id, 32 bits of the text's hash), so rows
that repeat an id with other text keep their own spans.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martstar.llm.common import rank, text_of

BUCKET_BYTES = 16 << 20  # text per bucket
FLUSH = 500_000  # pieces a task holds before it sends them on

BLOB_TYPE = "bucket int, kind int, data binary"


def sources(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(doc_id, did, th, text, bucket) and the number of buckets, which follows the text's bytes."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), rank(id_col).alias("did"),
                      text_of(text_col).alias("text"))
    total = src.agg(F.sum(F.octet_length("text").cast("double"))).first()[0] or 0.0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(least, math.ceil(total / BUCKET_BYTES))
    th = F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF))
    return src.select("doc_id", "did", th.alias("th"), "text",
                      F.pmod(F.xxhash64("did", th), F.lit(n)).cast("int").alias("bucket")), n



# -- packing ----------------------------------------------------------------
def _wave(x: np.ndarray) -> bytes:
    """Differences, byte plane by byte plane: sorted numbers pack well."""
    d = np.diff(x.astype(np.int64), prepend=np.int64(0)).astype("<i8")
    return d.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unwave(b: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(b, np.uint8).reshape(8, n).T.copy().view("<i8")[:, 0])


def pack(columns: list[np.ndarray], keys: list[tuple[np.ndarray, int]] = ()) -> bytes:
    """Number columns by difference; key columns as their low ``bytes`` as they are."""
    n = len(columns[0])
    parts = [_wave(c) for c in columns]
    parts += [k.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :b].tobytes() for k, b in keys]
    return n.to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes, n_columns: int, keys: list[int] = ()) -> list[np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    raw = zstandard.ZstdDecompressor().decompress(blob[8:])
    out, at = [], 0
    for _ in range(n_columns):
        out.append(_unwave(raw[at:at + 8 * n], n))
        at += 8 * n
    for b in keys:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :b] = np.frombuffer(raw[at:at + b * n], np.uint8).reshape(n, b)
        out.append(wide.view("<u8")[:, 0])
        at += b * n
    return out


def by_bucket(bucket: np.ndarray, kind: int, columns: list[np.ndarray],
              keys: list[tuple[np.ndarray, int]] = ()) -> pd.DataFrame:
    """One packed row per bucket; rows keep their order within a bucket."""
    if len(bucket) == 0:
        return pd.DataFrame({"bucket": [], "kind": [], "data": []}).astype({"bucket": "int32", "kind": "int32"})
    o = np.argsort(bucket, kind="stable")
    b = bucket[o]
    cut = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
    ends = np.r_[cut[1:], len(b)]
    data = [pack([c[o[s:e]] for c in columns], [(k[o[s:e]], w) for k, w in keys]) for s, e in zip(cut, ends)]
    return pd.DataFrame({"bucket": b[cut].astype(np.int32), "kind": np.int32(kind), "data": data})


def pack_strings(columns: list[np.ndarray], strings: list[bytes]) -> bytes:
    """Number columns and one byte string a row."""
    head = pack([*columns, np.array([len(x) for x in strings], np.int64)])
    return len(head).to_bytes(8, "little") + head + zstandard.ZstdCompressor(level=1).compress(b"".join(strings))


def unpack_strings(blob: bytes, n_columns: int) -> tuple[list[np.ndarray], list[bytes]]:
    cut = 8 + int.from_bytes(blob[:8], "little")
    *columns, lens = unpack(blob[8:cut], n_columns + 1)
    raw = zstandard.ZstdDecompressor().decompress(blob[cut:])
    ends = np.cumsum(lens).tolist()
    return columns, [raw[s:e] for s, e in zip([0, *ends], ends)]


def split_kinds(batches: Iterator[pd.DataFrame], kind: int, work: Callable[[int, list[bytes]], Iterator[pd.DataFrame]]):
    """Pass on rows of other kinds; then ``work(bucket, blobs)`` for one bucket at a time."""
    held: dict[int, list[bytes]] = {}
    for b in batches:
        own = (b["kind"] == kind).to_numpy()
        if not own.all():
            yield b[~own]
        for bucket, x in zip(b["bucket"][own].tolist(), b["data"][own]):
            held.setdefault(bucket, []).append(x)
    for bucket in sorted(held):
        yield from work(bucket, held.pop(bucket))


def runs_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by the keys, starts of runs of equal keys); the first key leads."""
    o = np.lexsort(keys[::-1])
    new = np.zeros(len(o), bool)
    new[:1] = True
    for k in keys:
        s = k[o]
        new[1:] |= s[1:] != s[:-1]
    return o, np.flatnonzero(new)


def least_of(values: np.ndarray, o: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each row the smallest value of its run."""
    out = np.empty_like(values)
    if len(o):
        out[o] = np.repeat(np.minimum.reduceat(values[o], starts), np.diff(np.r_[starts, len(o)]))
    return out


TEXT_BYTES = 32 << 20  # text a task packs at a time


def packed_texts(docs: DataFrame) -> DataFrame:
    """(bucket, data): the documents of ``sources`` by bucket, many in one compressed row."""

    def run(batches):
        rows, size = [], 0

        def send():
            rows.sort(key=lambda r: r[0])
            at = 0
            while at < len(rows):
                z = at
                while z < len(rows) and rows[z][0] == rows[at][0]:
                    z += 1
                part = rows[at:z]
                cols = [np.array([r[i] for r in part], np.int64) for i in (1, 2, 3)]
                yield int(part[0][0]), pack_strings(cols, [r[4] for r in part])
                at = z
            rows.clear()

        for b in batches:
            for bucket, did, th, null, text in zip(b["bucket"].tolist(), b["did"].tolist(), b["th"].tolist(),
                                                   b["doc_id"].isna().tolist(), b["text"]):
                raw = text.encode("utf-8", "surrogatepass")
                rows.append((bucket, did, th, null, raw))
                size += len(raw)
            if size >= TEXT_BYTES:
                yield pd.DataFrame(list(send()), columns=["bucket", "data"])
                size = 0
        yield pd.DataFrame(list(send()), columns=["bucket", "data"])

    return docs.select("doc_id", "did", "th", "text", "bucket").mapInPandas(run, "bucket int, data binary")


def texts_of(blobs) -> Iterator[tuple[int, int, int, bytes]]:
    """(did, th, whether the id is null, bytes) of packed documents."""
    for x in blobs:
        (did, th, null), raws = unpack_strings(x, 3)
        yield from zip(did.tolist(), th.tolist(), null.tolist(), raws)


# -- taking spans out ---------------------------------------------------------
def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as maximal runs; touching ones are one run."""
    o = np.argsort(start, kind="stable")
    s, e = start[o], np.maximum.accumulate(end[o])
    new = np.r_[True, s[1:] > e[:-1]]
    at = np.flatnonzero(new)
    return s[at], e[np.r_[at[1:], len(s)] - 1]


RESULT_TYPE = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def cut_out(docs: DataFrame, spans: DataFrame, with_text: bool = False, least_run: int = 1) -> DataFrame:
    """Remove spans (packed rows of did, th, start, end by document bucket) from
    each text. Merged runs of fewer than ``least_run`` bytes stay, unless such a run
    is the whole text; with a ``least_run`` the result has the bytes of all runs
    beside it, as n_copied."""

    more = least_run > 1

    def run(own: pd.DataFrame, blobs: pd.DataFrame) -> pd.DataFrame:
        cols = [unpack(b, 4) for b in blobs["data"]]
        did, th, s, e = [np.concatenate(c) for c in zip(*cols)] if cols else [np.empty(0, np.int64)] * 4
        o, starts = runs_of(did, th)
        ends = np.r_[starts[1:], len(o)]
        where = {(int(did[o[a]]), int(th[o[a]])): o[a:z] for a, z in zip(starts, ends)} if len(o) else {}
        out = []
        for d, h, null, b in texts_of(own["data"]):
            doc_id = None if null else d
            rows = where.get((d, h))
            left, gone, n, copied = b, 0, 0, 0
            if rows is not None:
                a, z = merged(s[rows], e[rows])
                copied = int((z - a).sum())
                go = (z - a >= least_run) | (z - a == len(b))
                a, z = a[go], z[go]
                edges = np.r_[0, np.c_[a, z].ravel(), len(b)].reshape(-1, 2)
                left = b"".join(b[x:y] for x, y in edges.tolist())
                gone, n = int((z - a).sum()), len(a)
            out.append((doc_id, len(b), gone, n, hashlib.sha256(left).hexdigest()) + (copied,) * more + (left,) * with_text)
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["n_copied"] * more + ["kept"] * with_text
        df = pd.DataFrame(out, columns=names)
        df["doc_id"] = pd.array([r[0] for r in out], dtype="Int64")  # a list with None would pass as floats
        return df

    return (packed_texts(docs).groupBy("bucket").cogroup(spans.groupBy("bucket"))
            .applyInPandas(run, RESULT_TYPE + ", n_copied long" * more + ", kept binary" * with_text))


def batches_of_bytes(batches: Iterator[pd.DataFrame], most: int) -> Iterator[list[tuple]]:
    """Rows (did, th, bucket, bytes) in lists of about ``most`` bytes."""
    rows, size = [], 0
    for b in batches:
        for did, th, bucket, text in zip(b["did"].tolist(), b["th"].tolist(), b["bucket"].tolist(), b["text"]):
            raw = text.encode("utf-8", "surrogatepass")
            rows.append((did, th, bucket, raw))
            size += len(raw)
            if size >= most:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


class Pieces:
    """Columns of pieces gathered over a task; ``send`` is called when FLUSH is reached."""

    def __init__(self, send: Callable[..., list[pd.DataFrame]]):
        self.send, self.columns, self.size = send, [], 0

    def add(self, *columns: np.ndarray) -> list[pd.DataFrame]:
        self.columns.append(columns)
        self.size += len(columns[0])
        return self.flush() if self.size >= FLUSH else []

    def flush(self) -> list[pd.DataFrame]:
        if not self.size:
            return []
        whole = [np.concatenate(c) for c in zip(*self.columns)]
        self.columns, self.size = [], 0
        return self.send(*whole)
