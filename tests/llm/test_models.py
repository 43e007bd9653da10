"""Toxicity and language ID: held-out accuracy, and that labels never leak into a score."""

import random
import zlib

import numpy as np
import pytest

from martstar.llm import lang_id as G
from martstar.llm import toxicity as X
from martstar.llm.common import table
from tests.llm.helpers import SCHEMA, awkward, prose
from tests.llm.helpers import table as docs_of

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"
BAD = ("blorg", "snarfle", "grizzt")


def insults(spark, n=500):
    r = random.Random(7)
    texts, labels = [], []
    for i in range(n):
        w = prose(i, 60, 400).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(BAD))
        texts.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return docs_of(spark, texts), spark.createDataFrame(labels, LABELS)


def test_toxicity_learns_and_holds_out(spark):
    docs, labels = insults(spark)
    rows = X.scores(docs, X.train(docs, labels)).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(500) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == (r.doc_id % 5 == 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_labels_change_nothing(spark):
    docs, labels = insults(spark, 200)
    flipped = spark.createDataFrame(
        [(r.doc_id, r.quality, 1 - r.toxic if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else r.toxic)
         for r in labels.collect()], LABELS)
    a, b = X.train(docs, labels), X.train(docs, flipped)
    assert a.score([prose(1, 30)]) == b.score([prose(1, 30)]) and (a.emb == b.emb).all()


def test_toxicity_of_long_texts_is_whole(spark, monkeypatch):
    docs, labels = insults(spark, 200)
    m = X.train(docs, labels)
    t = [prose(3, 900) + " blorg snarfle grizzt " + prose(4, 900), "", prose(5, 10), "blorg blorg"]
    whole = m.score(t)
    monkeypatch.setattr(X, "BLOCK_WORDS", 50)
    assert m.score(t) == pytest.approx(whole)
    assert whole[0] >= 0.5 > whole[1]


def test_toxicity_gradients():
    """Training steps lower the loss, and a class that is missing gives a constant."""
    ids = [X.word_ids(prose(i, 20, 50) + (" blorg" if i % 2 else "")) for i in range(200)]
    y = np.arange(200) % 2
    m = X.Model().fit(ids, y, ["a"] * 200)
    p, _ = m.raw(ids)
    assert ((p > 0.5) == (y == 1)).mean() > 0.98
    one = X.Model().fit(ids, np.zeros(200, int), ["a"] * 200)
    assert (one.score([prose(1, 5)]) < 0.5).all() and (X.Model().fit([], np.zeros(0, int), []).score([""]) < 0.5).all()


def test_toxicity_edges(spark):
    docs = docs_of(spark, awkward())
    labels = spark.createDataFrame([(5, 1, 1), (7, 1, 0), (None, 1, 1), (8, None, None), (99, 1, 1)], LABELS)
    m = X.train(docs, labels)
    assert X.scores(docs, m).count() == len(awkward())
    out = X.drop_toxic(docs, docs, labels)
    assert out.columns == docs.columns
    empty = spark.createDataFrame([], SCHEMA)
    assert X.scores(empty, X.train(empty, spark.createDataFrame([], LABELS))).count() == 0
    # columns of any kind, with nulls, pass as they are
    wide = 2**60 + 1
    typed = spark.createDataFrame([(wide, "fine text", 1.5, [1, None], {"a": None}), (None, None, None, None, None)],
                                  "doc_id long, text string, x double, y array<int>, z map<string,int>")
    kept = X.drop_toxic(typed, docs, labels).collect()
    assert [(r.doc_id, r.y, r.z) for r in kept] == [(wide, [1, None], {"a": None}), (None, None, None)]
    # without anything to learn from nothing is toxic
    assert X.drop_toxic(docs, empty, labels).count() == len(awkward())


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    rows = G.languages(docs, G.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_language_edges(spark):
    docs = table(spark, SF, "documents").limit(300)
    net = G.train(docs)
    odd = docs_of(spark, awkward() + [(300, "123 456 --"), (301, "😀".encode("utf-16", "surrogatepass").decode("utf-16"))])
    got = {(r.doc_id, r.lang_pred, r.score) for r in G.languages(odd, net).collect()}
    assert {(12, "und", 0.0), (13, "und", 0.0), (11, "und", 0.0), (300, "und", 0.0), (301, "und", 0.0)} <= got
    assert all(lang in {*net.langs, "und"} and 0 <= s <= 1 for _, lang, s in got)
    empty = spark.createDataFrame([], SCHEMA)
    none = G.train(empty)
    assert G.languages(empty, none).count() == 0
    assert {r.lang_pred for r in G.languages(odd, none).collect()} == {"und"}


def test_language_of_a_text_does_not_depend_on_its_neighbours():
    r = np.random.default_rng(0)
    x = np.concatenate([G.windows(prose(i, 30)) for i in range(40)])
    net = G.Network(["a", "b"]).fit(x, r.integers(0, 2, len(x)))
    seen = np.zeros(256, bool)
    seen[np.unique(x)] = True
    net.freeze(seen)
    t = [prose(9, 5000, 900), "short", "é ü ß", prose(2, 50)]
    alone = [net.predict([x]) for x in t]
    together = net.predict(t)
    assert together[0] == [a[0][0] for a in alone]
    assert together[1] == pytest.approx([a[1][0] for a in alone])


def test_frozen_tables_equal_the_network():
    x = np.concatenate([G.windows(prose(i, 30)) for i in range(20)])
    net = G.Network(["a", "b", "c"])
    seen = np.zeros(256, bool)
    seen[np.unique(x)] = True
    net.freeze(seen)
    want = []
    for row in x:
        h = []
        for w, f in net.conv.items():
            c = np.stack([sum(f[j][row[i + j]] for j in range(w)) for i in range(G.WINDOW - w + 1)]).max(0)
            h.append(np.maximum(c + net.bias[w], 0))
        want.append(net._softmax((np.concatenate(h) @ net.out + net.out_bias)[None])[0])
    assert net.probabilities(x) == pytest.approx(np.array(want), abs=1e-5)


def by_hand(monkeypatch):
    """Weights without training: blorg scores 0.5, snarfle 0.88, other words 0.05."""
    def odds(self, ids, toxic):
        self.emb[:] = 0
        for f in self.conv.values():
            f[:] = 0
        for b in self.bias.values():
            b[:] = 0
        self.out[:] = 0
        self.conv[1][0, 0, 0] = self.out[0] = 1
        self.out_bias = np.float32(-3)
        for word, z in (("blorg", 3), ("snarfle", 5)):
            self.emb[np.concatenate(X._rows(X.word_ids(word))), 0] = z / 2
    monkeypatch.setattr(X.Model, "_odds", odds)
    monkeypatch.setattr(X.Model, "_step", lambda *a, **k: None)


def test_toxicity_thresholds_come_from_all_labelled_rows(spark, monkeypatch):
    by_hand(monkeypatch)
    words = {"a": "red green blue black white", "b": "rojo verde azul negro blanco"}
    docs, labels = [], []
    for i in range(1200):
        lang = "b" if i % 4 == 3 else "a"  # blorg is an insult in a alone
        word, toxic = [("", 0), ("blorg", int(lang == "a")), ("snarfle", 1)][i // 4 % 3]
        docs.append((i, f"{words[lang]} {word}" + " red" * (5000 if i % 400 == 0 else 0), lang))
        labels.append((i, 1, toxic))
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    m = X.train(docs, spark.createDataFrame(labels, LABELS), fit_rows=120)
    assert m.langs == ["a", "b"] and m.cut[0] <= 0.5 < m.cut[1] <= 0.89
    said = {g: [x >= 0.5 for x in m.score([f"{words[g]} {w}" for w in ("", "blorg", "snarfle")])] for g in words}
    assert said == {"a": [False, True, True], "b": [False, False, True]}


def test_toxicity_place_counts_are_whole(spark, monkeypatch):
    by_hand(monkeypatch)
    docs, labels = insults(spark, 200)
    docs = docs.withColumn("lang", docs.source).union(docs.withColumn("lang", docs.source)).repartition(3)
    m = X.Model().fit([X.word_ids("red blue")] * 5 + [X.word_ids("blorg")], np.array([0, 0, 0, 0, 0, 1]), ["s"] * 6)
    known = labels.selectExpr("doc_id label_id", "toxic").where("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0")
    seen = np.array([x for x in range(0, 200, 3)])
    got = X.place_counts(docs, known, seen, m)
    left = [i for i in range(200) if i % 3 and zlib.crc32(str(i).encode()) % 5]
    assert got.sum() == len(left) and got[:, 1].sum() == sum(i % 5 == 0 for i in left)


def test_toxicity_few_rows_lean_on_all():
    m = X.Model()
    m.langs, m.cut = ["a", "b", "c", "d"], np.full(4, 0.5)
    n = np.zeros((4, 2, len(X.CUTS) + 1), int)
    n[0, 0, 10], n[0, 1, 30] = 10_000, 10_000  # cuts 10 to 29
    n[1, 0, 50], n[1, 1, 60] = 400, 25  # its own cut, with few toxic rows
    n[2, 0, 50] = 2
    m.calibrate(n)
    at = np.searchsorted(X.CUTS, m.cut - 1e-9)
    assert 10 <= at[0] < 30 and 50 <= at[1] < 60 and 10 <= at[2] < 30 and 10 <= at[3] < 30


def _early_id(spark, column="id"):
    """The id outside the held-out folds that comes first in the order the samples are drawn in."""
    ids = spark.range(4000).where(G.fold("id", 4) != 2).where(X.fold("id", 5) != 0)
    return ids.orderBy(G.F.xxhash64("id")).first()[0]


def test_a_hot_id_does_not_fill_the_language_sample(spark):
    hot = _early_id(spark)
    alphabets = {"en": "abcdefgh", "de": "ijklmnäö", "fr": "opqrsté", "es": "uvwxyzñ"}
    r = random.Random(2)
    word = lambda a: "".join(r.choice(a) for _ in range(5))
    rows = [(i, " ".join(word(alphabets[g]) for _ in range(60)), g) for i in range(400) for g in [list(alphabets)[i % 4 if i % 40 else 3]]]
    rows = [x for x in rows if x[0] != hot] + [(hot, rows[1][1], rows[1][2])] * 3000 + [(hot, "other text " * 20, "xx")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    net = G.train(df, fit_docs=120)
    assert {"en", "de", "fr", "es"} <= set(net.langs)
    seen = {}
    for i, t, g in rows[:200]:
        seen[g] = seen.get(g, 0) + (net.predict([t])[0][0] == g)
    assert sum(seen.values()) >= 190


def test_a_hot_id_reaches_the_driver_once(spark, monkeypatch):
    hot = _early_id(spark)
    ids = [i for i in range(300) if i != hot] + [hot]
    texts = {i: prose(i, 30) + (" awful words" if i % 3 == 0 else " kind words") for i in ids}
    docs = [(i, texts[i]) for i in ids] + [(hot, texts[hot] + f" {n % 7}") for n in range(2000)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in ids] + [(hot, 1, int(hot % 3 == 0))] * 500,
                                   "doc_id long, quality int, toxic int")
    sizes = []
    fit = X.Model.fit
    monkeypatch.setattr(X.Model, "fit", lambda self, x, *a, **k: (sizes.append(len(x)), fit(self, x, *a, **k))[1])
    X.train(docs_of(spark, docs).repartition(4), labels, fit_rows=100)
    X.train(docs_of(spark, docs).repartition(2), labels, fit_rows=100)
    assert sizes == [100, 100]


def test_scores_are_those_of_the_plain_network(spark):
    """Every score again, text by text, as plain sums over the words, without the batches of the operator."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = X.train(docs, table(spark, "/root/testdata/sf0.001", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in X.scores(docs, model).collect()[:60]:
        assert r.score == pytest.approx(float(model.score([texts[r.doc_id]])[0]), abs=1e-6)
        assert r.predicted == int(r.score >= 0.5)
