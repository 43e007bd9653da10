"""Best-fit packing of tokenised documents into sequences.

1. Documents are tokenised where they lie; each leaves one small row with its
   length, its piece lengths and their checksums. A document of more than
   ``size`` tokens is cut into pieces of ``size``; the remainder is piece 0.
2. Full pieces are sequences of their own. The short ones are dealt to tasks by
   a hash and within a task, by another, to rounds of about ``open_bins`` pieces.
   A round goes longest first, so no bin waits for small pieces longer than a
   round. Pieces are placed by bounded-space best-fit: ``open_bins`` bins at most
   are open, kept in one bitset per task whose bit f says that some open bin has
   f tokens free. The fitting bin with the least free space is the next set bit
   at or above the piece's length. When all bins are taken, the fullest closes
   first. Open bins pass from round to round.

A task holds ``open_bins`` bins and one batch of rows, whatever the input is.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martstar.llm.common import id_text, keep, rank, text_of, with_id

SIZE = 1024
END = 2
OPEN_BINS = 2048
PIECES_PER_TASK = 100_000

PIECE_TYPE = "doc_id string, piece int, start long, length long, ids_crc32 long"

# beyond these code points the two tokenizer libraries may class characters by
# different Unicode versions; such texts take the slower library
_COMMON = "ɏ"
_encoders: dict = {}


def _encoder(name: str):
    """text -> token ids of a public vocabulary, loaded once a worker."""
    if name not in _encoders:
        import base64
        import re

        import public_tokenizers as vocab
        import tiktoken
        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(vocab.path(f"{name}.json"))
        slow.encode_special_tokens = True  # their names in a text are ordinary text
        with open(vocab.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding(name, pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={})
        rare = re.compile(f"[^\\x00-{_COMMON}]")

        def encode(text: str) -> np.ndarray:
            if not rare.search(text):
                try:
                    return np.asarray(fast.encode_to_numpy(text)).astype("<u4")
                except ValueError:  # its pattern gives up on very long runs of white space
                    pass
            return np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")

        _encoders[name] = encode
    return _encoders[name]


def cuts(n: int, size: int) -> list[int]:
    """Starts of the pieces of n tokens, then n: full pieces after a shorter first one."""
    if n <= size:
        return [0, n]
    first = n % size or size
    return [0, *range(first, n, size), n]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
           vocabulary: str = "byte_bpe_50k", end: int = END, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 [, ids]: the token pieces of each row."""

    def run(batches):
        encode = _encoder(vocabulary)
        for b in batches:
            out = []
            for d, t in zip(b["doc_id"], b["text"]):
                ids = np.append(encode(t), np.uint32(end)).astype("<u4")
                at = cuts(len(ids), size)
                for i, (s, e) in enumerate(zip(at, at[1:])):
                    row = (d, i, s, e - s, zlib.crc32(ids[s:e].tobytes()))
                    out.append(row + (ids[s:e].astype("int32"),) if with_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            yield pd.DataFrame(out, columns=names)

    src = docs.select(id_text(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return with_id(src.mapInPandas(run, PIECE_TYPE + (", ids array<int>" if with_ids else "")))


class OpenBins:
    """Bounded-space best-fit over bins of one size."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.free: list[list[int]] = [[] for _ in range(size + 1)]  # bins by free space
        self.bits = 0  # bit f: some open bin has f free
        self.open = 0
        self.made = 0

    def put(self, n: int) -> tuple[int, int]:
        """Place n tokens; (bin, offset)."""
        above = self.bits >> n
        if above:
            f = n + (above & -above).bit_length() - 1  # least free space that fits
            b = self._take(f)
        else:
            if self.open >= self.most:  # the fullest closes first
                self._take((self.bits & -self.bits).bit_length() - 1)
            f, b = self.size, self.made
            self.made += 1
        if f - n:
            self.free[f - n].append(b)
            self.bits |= 1 << (f - n)
            self.open += 1
        return b, self.size - f

    def _take(self, f: int) -> int:
        b = self.free[f].pop()
        if not self.free[f]:
            self.bits &= ~(1 << f)
        self.open -= 1
        return b


def place(short: DataFrame, n_rows: int, size: int = SIZE, open_bins: int = OPEN_BINS) -> DataFrame:
    """sequence_id and offset for rows of fewer than ``size`` tokens each."""

    def run(batches):
        from pyspark import TaskContext

        base = (TaskContext.get().partitionId() + 1) << 36
        bins = OpenBins(size, open_bins)
        for b in batches:
            at = [bins.put(int(n)) for n in b["length"]]
            b["sequence_id"] = [base + x for x, _ in at]
            b["offset"] = [o for _, o in at]
            yield b

    tasks = max(1, math.ceil(n_rows / PIECES_PER_TASK))
    rounds = max(1, math.ceil(n_rows / (tasks * open_bins)))
    turn = F.pmod(F.xxhash64(F.lit("round"), "doc_id", "piece", "ids_crc32"), F.lit(rounds))
    key = [turn, F.col("length").desc(), rank("doc_id"), F.col("piece"), F.col("ids_crc32")]
    dealt = (short.repartition(tasks, F.xxhash64("doc_id", "piece", "ids_crc32")).sortWithinPartitions(*key)
             .withColumn("doc_id", id_text("doc_id")))
    return with_id(dealt.mapInPandas(run, PIECE_TYPE + ", sequence_id long, offset long"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
         open_bins: int = OPEN_BINS, vocabulary: str = "byte_bpe_50k", end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    An empty or null text is the end token alone. Rows that repeat a doc_id are
    packed each, with the same id and piece numbers. A null id is packed like
    any other. An empty table gives an empty result.
    """
    cut = keep(pieces(docs, id_col, text_col, size, vocabulary, end))
    full = cut.where(F.col("length") == size).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = cut.where(F.col("length") < size)
    return full.unionByName(place(short, short.count(), size, open_bins))
