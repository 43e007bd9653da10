"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of two, looked up by two hashes in tables of
``BUCKETS`` rows, so words that share one row with a telling word differ from it
in the other. Filters of several widths slide over the embeddings, each keeps its
largest answer in the text, and a logistic unit reads those maxima. The first
embedding column starts from how far a row's share of toxic documents stands
out, the rest from small noise; all weights are then trained in numpy.

Thresholds are calibrated per language on all labelled rows of the training
folds that the fit did not see, of any length: Spark scores them and counts them
by language, label and place of the score on a fixed grid of cuts. A language's
cut has the fewest errors on its own rows and ``SHRINK`` rows more that err as
all rows do, so few rows lean on the rest and many speak for themselves.
The language of a text is guessed from its words (a table learned from the same
rows), so a score depends on the text alone. Scores are stretched so that a
language's threshold falls on 0.5.

Only the fit reads a bounded sample of labelled rows: at most ``FIT_ROWS``, chosen
by a hash of the id, of documents with at most ``FIT_WORDS`` words. Scoring reads every whole text, in blocks of words.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martstar.llm.common import fold, id_text, text_of, with_id

BUCKETS = 1 << 16
DIM = 8
FILTERS = {1: 8, 2: 6, 3: 6}
FIT_ROWS = 12_000
FIT_WORDS = 4096
EPOCHS = 6
BATCH = 64
BLOCK_WORDS = 1 << 17
FOLDS, HELD_OUT = 5, 0
CUTS = np.linspace(0.05, 0.95, 91)
SHRINK = 60

_word = re.compile(r"[^\W\d_]+")


class _Ids(dict):
    """word -> its two buckets in one number, remembered; bucket 0 is padding. Bounded by a reset."""

    def __missing__(self, w: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 7)
        v = self[w] = (1 + (h & 0xFFFFFFFF) % (BUCKETS - 1)) | (1 + (h >> 32) % (BUCKETS - 1)) << 16
        return v


_ids = _Ids()


def word_ids(text: str) -> np.ndarray:
    return np.array([_ids[w] for w in _word.findall(text.lower())], dtype=np.uint32)


def _rows(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers in the two tables laid end to end."""
    return (ids & np.uint32(0xFFFF)).astype(np.int64), (ids >> np.uint32(16)).astype(np.int64) + BUCKETS


PAD = np.zeros(max(FILTERS) - 1, dtype=np.uint32)


class Model:
    """Weights, scoring and training."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.emb = r.normal(0, 0.02, (2 * BUCKETS, DIM)).astype(np.float32)
        self._no_padding()
        self.conv = {w: r.normal(0, 0.3, (w, DIM, n)).astype(np.float32) for w, n in FILTERS.items()}
        for w, f in self.conv.items():
            f[:, 0, :] = np.abs(f[:, 0, :]) + 0.3 / w  # answer to the first column
        # one row alone is not enough for an answer, both are
        self.bias = {w: np.full(n, -0.7 / w, np.float32) for w, n in FILTERS.items()}
        self.out = np.full(sum(FILTERS.values()), 0.1, np.float32)
        self.out_bias = np.float32(-1.0)
        self.langs: list[str] = []
        self.lang_odds = np.zeros((2 * BUCKETS, 1), np.float32)
        self.cut = np.array([0.5], np.float64)  # by language

    def _no_padding(self) -> None:
        self.emb[[0, BUCKETS]] = 0

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "look"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.freeze()

    # -- scoring -----------------------------------------------------------
    def freeze(self) -> "Model":
        """Products of embeddings and filters, so a filter is a sum of look-ups."""
        self.look = {w: [self.emb @ f[j] for j in range(w)] for w, f in self.conv.items()}
        return self

    def _segments(self, ids: list[np.ndarray]):
        """Runs of about BLOCK_WORDS words as (document numbers, starts, flat ids)."""
        docs, starts, flat, size = [], [], [], 0
        for i, x in enumerate(ids):
            for lo in range(0, max(1, len(x)), BLOCK_WORDS):
                part = x[lo:lo + BLOCK_WORDS + len(PAD)]
                docs.append(i)
                starts.append(size)
                flat += [part, PAD]
                size += len(part) + len(PAD)
                if size >= BLOCK_WORDS:
                    yield np.array(docs), np.array(starts), np.concatenate([*flat, PAD])
                    docs, starts, flat, size = [], [], [], 0
        if docs:
            yield np.array(docs), np.array(starts), np.concatenate([*flat, PAD])

    def raw(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(probability before calibration, language number) of each document."""
        pool = np.full((len(ids), len(self.out)), -np.inf, np.float32)
        lang = np.zeros((len(ids), self.lang_odds.shape[1]), np.float64)
        for docs, starts, flat in self._segments(ids):
            n, col = len(flat) - len(PAD), 0
            one, two = _rows(flat)
            for w, tables in self.look.items():
                c = tables[0][one[:n]]
                c += tables[0][two[:n]]
                for j in range(1, w):
                    c += tables[j][one[j:n + j]]
                    c += tables[j][two[j:n + j]]
                k = c.shape[1]
                np.maximum.at(pool[:, col:col + k], docs, np.maximum.reduceat(c, starts, axis=0) + self.bias[w])
                col += k
            odds = self.lang_odds[one[:n]] + self.lang_odds[two[:n]]
            np.add.at(lang, docs, np.add.reduceat(odds, starts, axis=0))
        z = np.maximum(pool, 0) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-z.astype(np.float64))), lang.argmax(1)

    def score(self, texts) -> np.ndarray:
        p, lang = self.raw([word_ids(t) for t in texts])
        cut = self.cut[lang]
        return np.where(p < cut, 0.5 * p / cut, 0.5 + 0.5 * (p - cut) / (1 - cut)).clip(0, 1)

    # -- training ----------------------------------------------------------
    def fit(self, ids: list[np.ndarray], toxic: np.ndarray, langs: list) -> "Model":
        """Train on documents as word numbers, but every fifth (``spared``), which is left to calibrate."""
        if len(ids) == 0 or toxic.min() == toxic.max():
            self.out_bias = np.float32(3.0 if len(ids) and toxic.max() == 1 else -3.0)
            return self.freeze()
        self._languages(ids, langs)
        train = np.flatnonzero(~spared(len(ids)))
        self._odds([ids[i] for i in train], toxic[train])
        r = np.random.default_rng(5)
        state: dict = {}
        step = 0
        for _ in range(EPOCHS):
            r.shuffle(train)
            for lo in range(0, len(train), BATCH):
                step += 1
                some = train[lo:lo + BATCH]
                self._step([ids[i] for i in some], toxic[some], state, step)
        return self.freeze()

    def _languages(self, ids, langs) -> None:
        self.langs = sorted({x for x in langs if x is not None}) or [""]
        seen = np.full((2 * BUCKETS, len(self.langs)), 0.5)
        for x, g in zip(ids, langs):
            if g is not None:
                for rows in _rows(x):
                    np.add.at(seen[:, self.langs.index(g)], rows, 1)
        seen /= seen.sum(0)
        self.lang_odds = np.log(seen / seen.mean(1, keepdims=True)).astype(np.float32)
        self.lang_odds[[0, BUCKETS]] = 0
        self.cut = np.full(len(self.langs), 0.5)

    def _odds(self, ids, toxic) -> None:
        """Column 0: the signed root of the likelihood ratio of a bucket's share of toxic documents."""
        n = np.zeros((2 * BUCKETS, 2))
        for x, t in zip(ids, toxic):
            for rows in _rows(np.unique(x)):
                n[np.unique(rows), int(t)] += 1
        share = np.bincount(toxic, minlength=2) / len(toxic)
        want = n.sum(1, keepdims=True) * share
        with np.errstate(divide="ignore", invalid="ignore"):
            g = 2 * np.where(n > 0, n * np.log(n / want), 0).sum(1)
        root = np.sign(n[:, 1] - want[:, 1]) * np.sqrt(np.maximum(g, 0))
        # chance alone passes three in tables of this size; a word needs both rows
        self.emb[:, 0] = np.where(np.abs(root) > 4, np.clip(root / 6, -1, 1), 0)
        self._no_padding()

    def _step(self, ids, y, state, t, rate=0.01) -> None:
        flat = np.concatenate([a for x in ids for a in (x, PAD)] + [PAD])
        lens = np.array([len(x) + len(PAD) for x in ids])
        starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
        one, two = _rows(flat)
        n, x = len(flat) - len(PAD), self.emb[one] + self.emb[two]
        pool, at = [], []
        for w, f in self.conv.items():
            c = sum(x[j:n + j] @ f[j] for j in range(w)) + self.bias[w]
            best = np.stack([s + c[s:s + m].argmax(0) for s, m in zip(starts, lens)])
            at.append(best)
            pool.append(np.take_along_axis(c, best, 0))
        h = np.maximum(np.concatenate(pool, 1), 0)
        p = 1 / (1 + np.exp(-(h @ self.out + self.out_bias)))
        g = ((p - y) / len(y)).astype(np.float32)
        grads = {"out": h.T @ g + 1e-4 * self.out, "out_bias": g.sum()}
        gh = np.outer(g, self.out) * (h > 0)
        ge, col = np.zeros_like(self.emb), 0
        for (w, f), best in zip(self.conv.items(), at):
            k = f.shape[2]
            gw = gh[:, col:col + k]
            col += k
            gf = np.zeros_like(f)
            for j in range(w):
                gf[j] = np.einsum("bk,bkd->dk", gw, x[best + j])
                for rows in (one, two):
                    np.add.at(ge, rows[best + j], gw[..., None] * f[j].T[None])
            grads[f"c{w}"], grads[f"b{w}"] = gf + 1e-4 * f, gw.sum(0)
        ge[[0, BUCKETS]] = 0
        grads["emb"] = ge
        own = {"out": self.out, "emb": self.emb, **{f"c{w}": f for w, f in self.conv.items()},
               **{f"b{w}": b for w, b in self.bias.items()}}
        for k, gr in grads.items():  # Adam
            m, v = state.setdefault(k, (np.zeros_like(gr), np.zeros_like(gr)))
            m = 0.9 * m + 0.1 * gr
            v = 0.999 * v + 0.001 * gr * gr
            state[k] = m, v
            d = rate * (0.02 if k == "emb" else 1) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            if k == "out_bias":
                self.out_bias = np.float32(self.out_bias - d)
            else:
                own[k] -= d.astype(np.float32)

    # -- calibration -------------------------------------------------------
    def places(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(language number, how many of CUTS the score reaches) of each text."""
        p, lang = self.raw([word_ids(t) for t in texts])
        return lang, np.searchsorted(CUTS, p, side="right")

    def calibrate(self, counts: np.ndarray) -> "Model":
        """Cuts by language from counts of rows by (language, label, place)."""
        # at cut i the clean rows of a place above i and the toxic ones of the others are wrong
        clean, toxic = counts[:, 0].astype(np.float64), counts[:, 1].astype(np.float64)
        wrong = clean.sum(1, keepdims=True) - clean.cumsum(1)[:, :-1] + toxic.cumsum(1)[:, :-1]
        if counts.sum():
            rate = wrong.sum(0) / counts.sum()
            for g, w in enumerate(wrong + SHRINK * rate):
                low = np.flatnonzero(w <= w.min() + 1e-9)
                self.cut[g] = CUTS[low[len(low) // 2]]
        return self


def spared(n: int) -> np.ndarray:
    """Which of n rows of the sample the fit leaves out."""
    return np.arange(n) % 5 == 4


def place_counts(docs: DataFrame, known: DataFrame, seen: np.ndarray, model: Model) -> np.ndarray:
    """Ids of ``known`` that are not ``seen``, counted by (language, label, place).

    Texts are scored where they lie and only numbers are joined to the labels. An
    id counts once; of rows that repeat it the smallest (language, place) counts.
    """
    spark = docs.sparkSession

    def run(batches):
        for b in batches:
            lang, place = model.places(b["text"])
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang": lang, "place": place})

    out = spark.createDataFrame(pd.DataFrame({"seen_id": np.asarray(seen, dtype="int64")}), "seen_id long")
    src = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
           .where("doc_id is not null").where(fold("doc_id", FOLDS) != HELD_OUT)
           .join(F.broadcast(out), F.col("doc_id") == F.col("seen_id"), "left_anti"))
    placed = (src.mapInPandas(run, "doc_id long, lang int, place int")
              .groupBy("doc_id").agg(F.min(F.col("lang") * 1000 + F.col("place")).alias("at")))
    rows = (placed.join(known, F.col("doc_id") == F.col("label_id"))
            .groupBy("at", "toxic").agg(F.count(F.lit(1)).alias("n")).collect())  # languages x places x 2 at most
    counts = np.zeros((len(model.langs), 2, len(CUTS) + 1), dtype=np.int64)
    for r in rows:
        counts[r["at"] // 1000, r["toxic"], r["at"] % 1000] += r["n"]
    return counts


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model from labelled rows whose id is not in the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("label_id is not null and toxic in (0, 1)").where(fold("label_id", FOLDS) != HELD_OUT)
             .groupBy("label_id").agg(F.max("toxic").alias("toxic")))  # labelled both ways is toxic
    order = F.xxhash64("label_id")
    some = known.orderBy(order, "label_id").limit(fit_rows)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"),
                      F.col("lang").cast("string").alias("lang"))

    def run(batches):
        for b in batches:
            ids = [word_ids(t) for t in b["text"]]
            ok = [len(x) <= FIT_WORDS for x in ids]
            yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "lang": b["lang"],
                                "ids": [x.tobytes() for x in ids]})[ok]

    # a repeated id brings the text with the smallest hash, so at most fit_rows rows of at most FIT_WORDS
    # numbers reach the driver
    rows = (src.join(F.broadcast(some), F.col("doc_id") == F.col("label_id"))
            .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "lang", "text", "toxic")).alias("row"))
            .select("doc_id", "row.toxic", "row.lang", "row.text")
            .mapInPandas(run, "doc_id long, toxic int, lang string, ids binary").toPandas())
    rows = rows.sort_values("doc_id")
    rows = rows.sample(frac=1, random_state=11)
    model = Model().fit([np.frombuffer(x, dtype=np.uint32) for x in rows["ids"]], rows["toxic"].to_numpy(),
                        [x if isinstance(x, str) else None for x in rows["lang"]])
    if not model.langs:  # nothing could be learned
        return model
    return model.calibrate(place_counts(docs, known, rows["doc_id"].to_numpy()[~spared(len(rows))], model))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row.

    Null and empty texts get the score of a text without words. Repeated rows
    get the same score each. An empty table gives an empty result.
    """

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": model.score(b["text"])})

    src = docs.select(id_text(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return with_id(src.mapInPandas(run, "doc_id string, score double")).select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` predicted 0, all columns unchanged."""
    model = train(train_docs, labels)

    def run(batches):  # Arrow rows pass as they are, whatever their columns hold
        for b in batches:
            texts = [t or "" for t in b.column(text_col).to_pylist()]
            yield b.filter(pa.array(model.score(texts) < 0.5))

    return docs.mapInArrow(run, docs.schema)
