"""Packing: exact round trip of the tokens, no overlap, few sequences."""

import random
import zlib

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from martstar.llm import packing as P
from tests.llm.helpers import SCHEMA, awkward, prose, table


def reference_ids():
    import public_tokenizers as vocab
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocab.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda x: [*t.encode(x or "", add_special_tokens=False).ids, 2]


def check(rows, texts, size):
    ids = reference_ids()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for d in {d for d, _ in texts}:
        want = sorted(ids(t) for x, t in texts if x == d)
        pieces = []
        for full in want:
            at = P.cuts(len(full), size)
            pieces += [(i, a, z - a, zlib.crc32(np.array(full[a:z], "<u4").tobytes()))
                       for i, (a, z) in enumerate(zip(at, at[1:]))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[d]) == sorted(pieces)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at and n > 0
            at += n
        assert at <= size
    return len(bins)


def test_round_trip_and_layout(spark):
    texts = awkward() + [(100 + i, prose(i, 5 + 37 * i % 600)) for i in range(80)]
    rows = P.pack(table(spark, texts).repartition(4)).collect()
    n = check(rows, texts, 1024)
    assert n <= sum(r.length for r in rows) / 1024 * 1.02 + 2


def test_pieces_carry_the_ids(spark):
    r = P.pieces(table(spark, [(1, prose(1, 900))]), with_ids=True).collect()
    assert [x for p in sorted(r, key=lambda x: x.piece) for x in p.ids] == reference_ids()(prose(1, 900))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 5000), st.integers(1, 64))
def test_cuts(n, size):
    at = P.cuts(n, size)
    lens = [b - a for a, b in zip(at, at[1:])]
    assert at[0] == 0 and at[-1] == n and all(x == size for x in lens[1:]) and 0 < lens[0] <= size


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 31), max_size=200), st.integers(1, 6))
def test_best_fit_takes_the_least_free_space(lengths, most):
    bins, free = P.OpenBins(32, most), {}
    for n in lengths:
        fits = [f for f in free.values() if f >= n]
        b, o = bins.put(n)
        if fits:
            assert free[b] == min(fits) and o == 32 - free[b]
            free[b] -= n
        else:
            if len(free) >= most:  # the fullest closed
                low = min(free.values())
                closed = [x for x, f in free.items() if f == low]
                assert b not in free
                # bins with equal room are told apart by age
                free.pop(closed[-1])
            assert o == 0
            free[b] = 32 - n
        if free[b] == 0:
            del free[b]
        assert len(free) <= most == bins.most and sorted(f for f in free.values()) == sorted(
            f for f, bs in enumerate(bins.free) for _ in bs)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_both_libraries_agree(t):
    t = t.encode("utf-8", "ignore").decode()
    assert P._encoder("byte_bpe_50k")(t).tolist() == reference_ids()(t)[:-1]


def test_names_of_special_tokens_are_text():
    assert 50256 not in P._encoder("byte_bpe_50k")("a <|endoftext|> b").tolist()


def test_few_open_bins_still_pack(spark):
    r = random.Random(2)
    texts = [(i, prose(i, r.randint(1, 300))) for i in range(60)]
    check(P.pack(table(spark, texts), open_bins=1).collect(), texts, 1024)


def test_empty(spark):
    assert P.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_few_sequences_beyond_the_open_bins(spark):
    r = np.random.default_rng(4)
    lengths = r.integers(1, 1024, 60_000)
    short = spark.createDataFrame(pd.DataFrame({"doc_id": np.arange(60_000), "piece": np.zeros(60_000, "int32"),
                                                "start": 0, "length": lengths, "ids_crc32": lengths * 7}),
                                  "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = P.place(short, 60_000).select("doc_id", "sequence_id", "offset", "length").toPandas()
    assert sorted(rows["doc_id"]) == list(range(60_000))
    ends = (rows["offset"] + rows["length"]).groupby(rows["sequence_id"]).max()
    assert ends.max() <= 1024 and (rows.groupby("sequence_id")["length"].sum() == ends).all()
    assert len(ends) <= lengths.sum() / 1024 * 1.01


def test_a_million_characters_of_one_kind(spark):
    texts = [(1, " " * 1_000_000), (2, "\n" * 1_000_000), (3, "x" + " \t\n" * 400_000 + "y"), (4, "a" * 1_000_000), (5, "!" * 1_000_000)]
    check(P.pack(table(spark, texts)).collect(), texts, 1024)
