"""Language identification by a byte convolutional network.

Texts are cut into windows of ``WINDOW`` bytes (the last one padded). Filters
of several widths slide over the bytes of a window, each keeps its largest
answer, and a softmax over the learned languages reads those maxima. A text's
probabilities are the means over all its windows, weighted by their bytes.

The network is trained in numpy on a bounded sample: at most ``FIT_DOCS``
documents, chosen by a hash of the id, and of each at most ``FIT_WINDOWS``
windows spread evenly over the text. Prediction reads every byte.

A filter over one-hot bytes is a sum of table look-ups; for prediction two
neighbouring bytes are looked up at once, over the byte classes in use.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martstar.llm.common import fold, id_text, text_of, with_id

WINDOW = 128
FILTERS = {2: 16, 3: 16, 4: 16}
FIT_DOCS = 4000
DEALS = 64
FIT_WINDOWS = 8
EPOCHS = 4
BATCH = 128
BLOCK = 1 << 12  # windows scored at a time
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"

_letter = re.compile(r"[^\W\d_]")
_CASE = np.arange(256, dtype=np.uint8)
_CASE[65:91] += 32  # A-Z
_CASE[[9, 10, 11, 12, 13]] = 32


def windows(text: str) -> np.ndarray:
    """All bytes of a text as rows of WINDOW bytes, padded with zero bytes."""
    b = _CASE[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    n = max(1, -(-len(b) // WINDOW))
    out = np.zeros(n * WINDOW, dtype=np.uint8)
    out[:len(b)] = b
    return out.reshape(n, WINDOW)


def spread(w: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` rows, evenly spaced."""
    return w if len(w) <= most else w[np.linspace(0, len(w) - 1, most).astype(int)]


class Network:
    def __init__(self, langs: list[str], seed: int = 1):
        r = np.random.default_rng(seed)
        self.langs = langs
        self.conv = {w: r.normal(0, 0.1, (w, 256, n)).astype(np.float32) for w, n in FILTERS.items()}
        self.bias = {w: np.zeros(n, np.float32) for w, n in FILTERS.items()}
        self.out = r.normal(0, 0.1, (sum(FILTERS.values()), len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), np.float32)

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    # -- training ----------------------------------------------------------
    def fit(self, x: np.ndarray, y: np.ndarray) -> "Network":
        r = np.random.default_rng(2)
        state: dict = {}
        step = 0
        for _ in range(EPOCHS if len(self.langs) > 1 else 0):
            order = r.permutation(len(x))
            for lo in range(0, len(x), BATCH):
                step += 1
                some = order[lo:lo + BATCH]
                self._step(x[some], y[some], state, step)
        return self

    def _step(self, x, y, state, t, rate=0.01) -> None:
        rows = np.arange(len(x))
        pool, at = [], []
        for w, f in self.conv.items():
            n = WINDOW - w + 1
            c = sum(f[j][x[:, j:n + j]] for j in range(w))
            best = c.argmax(1)
            at.append(best)
            pool.append(np.take_along_axis(c, best[:, None, :], 1)[:, 0] + self.bias[w])
        h = np.maximum(np.concatenate(pool, 1), 0)
        p = self._softmax(h @ self.out + self.out_bias)
        p[rows, y] -= 1
        p /= len(x)
        grads = {"out": h.T @ p + 1e-4 * self.out, "out_bias": p.sum(0)}
        gh, col = (p @ self.out.T) * (h > 0), 0
        for (w, f), best in zip(self.conv.items(), at):
            k = f.shape[2]
            g = gh[:, col:col + k]
            col += k
            gf = 1e-4 * f
            for j in range(w):
                byte = x[rows[:, None], best + j]
                np.add.at(gf[j], (byte, np.arange(k)[None]), g)
            grads[f"c{w}"], grads[f"b{w}"] = gf, g.sum(0)
        own = {"out": self.out, "out_bias": self.out_bias, **{f"c{w}": f for w, f in self.conv.items()},
               **{f"b{w}": b for w, b in self.bias.items()}}
        for k, gr in grads.items():  # Adam
            m, v = state.get(k, (0.0, 0.0))
            m, v = 0.9 * m + 0.1 * gr, 0.999 * v + 0.001 * gr * gr
            state[k] = m, v
            own[k] -= (rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)

    # -- prediction --------------------------------------------------------
    def freeze(self, seen: np.ndarray) -> "Network":
        """Tables over pairs of byte classes: bytes that occur in training, and one for the rest."""
        used = np.flatnonzero(seen)
        self.classes = np.full(256, len(used), dtype=np.int32)
        self.classes[used] = np.arange(len(used))
        n = self.n = len(used) + 1
        self.tables = []
        for w, f in self.conv.items():
            own = np.concatenate([f[:, used], f[:, ~seen].mean(1, keepdims=True) if (~seen).any() else 0 * f[:, :1]], 1)
            steps = []
            for j in range(0, w, 2):
                if j + 1 < w:
                    pair = (own[j][:, None] + own[j + 1][None]).reshape(n * n, -1)
                else:
                    pair = np.repeat(own[j], n, axis=0)
                steps.append((j, np.ascontiguousarray(pair, dtype=np.float32)))
            self.tables.append((w, steps))
        return self

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Per window, BLOCK windows at a time."""
        out = np.empty((len(x), len(self.langs)))
        for lo in range(0, len(x), BLOCK):
            part = self.classes[x[lo:lo + BLOCK]]
            pair = part * self.n
            pair[:, :-1] += part[:, 1:]
            pair = np.ascontiguousarray(pair.T)  # position by position: the maximum is kept in place
            pool = []
            for w, steps in self.tables:
                best = None
                for i in range(WINDOW - w + 1):
                    c = steps[0][1][pair[i]]
                    for j, table in steps[1:]:
                        c += table[pair[i + j]]
                    best = c if best is None else np.maximum(best, c, out=best)
                pool.append(best + self.bias[w])
            h = np.maximum(np.concatenate(pool, 1), 0)
            out[lo:lo + BLOCK] = self._softmax((h @ self.out + self.out_bias).astype(np.float64))
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(language, probability) of whole texts."""
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        todo, rows, size = [], [], 0

        def flush():
            if not todo:
                return
            x = np.concatenate(rows)
            p = self.probabilities(x) * (x != 0).sum(1)[:, None]
            ends = np.cumsum([len(r) for r in rows])
            total = np.add.reduceat(p, np.concatenate([[0], ends[:-1]]), axis=0)
            total /= np.maximum(total.sum(1, keepdims=True), 1e-12)
            for i, t in zip(todo, total):
                k = int(t.argmax())
                lang[i], score[i] = self.langs[k], min(1.0, float(t[k]))
            todo.clear()
            rows.clear()

        for i, t in enumerate(texts):
            if not self.langs or not _letter.search(t):
                continue
            w = windows(t)
            todo.append(i)
            rows.append(w)
            size += len(w)
            if size >= 2 * BLOCK:
                flush()
                size = 0
        flush()
        return lang, score


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          fit_docs: int = FIT_DOCS) -> Network:
    """A network from documents whose language is known and whose id is not in the held-out fold."""
    known = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"),
                         F.col(lang_col).cast("string").alias("lang"))
             .where("lang is not null and doc_id is not null").where(fold("doc_id", FOLDS) != HELD_OUT))
    # the ids are chosen first, so texts are never sorted: one row per id, however often it is
    # repeated, and the languages in turn, so that a rare one is learned too; a language is dealt
    # to DEALS windows, so that a large one is no task of its own
    ids = known.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    deal = F.pmod(F.xxhash64(F.lit("deal"), "doc_id"), F.lit(DEALS))
    some = (ids.withColumn("deal", deal)
            .withColumn("nth", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order)))
            .where(F.col("nth") <= fit_docs).orderBy("nth", *order).limit(fit_docs).select("doc_id"))
    # a repeated id brings the text of its first language with the smallest hash
    chosen = (known.join(F.broadcast(some), "doc_id").groupBy("doc_id")
              .agg(F.min(F.struct("lang", F.xxhash64("text").alias("h"), "text")).alias("row"))
              .select("doc_id", "row.lang", "row.text"))

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang": b["lang"], "x": [
                spread(windows(t), FIT_WINDOWS).tobytes() if _letter.search(t) else None for t in b["text"]]})

    # at most fit_docs rows of at most FIT_WINDOWS windows reach the driver
    rows = (chosen.mapInPandas(run, "doc_id long, lang string, x binary").where("x is not null").toPandas()
            .sort_values("doc_id"))
    langs = sorted(set(rows["lang"]))
    if not langs:
        return Network([]).freeze(np.zeros(256, dtype=bool))
    x = [np.frombuffer(b, dtype=np.uint8).reshape(-1, WINDOW) for b in rows["x"]]
    y = np.repeat([langs.index(g) for g in rows["lang"]], [len(w) for w in x])
    x = np.concatenate(x)
    seen = np.zeros(256, dtype=bool)
    seen[np.unique(x)] = True
    return Network(langs).fit(x, y).freeze(seen)


def languages(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per input row.

    A null or empty text, or one without a letter, is ``und`` with score 0, and
    so is every text if nothing could be learned. Repeated rows get the same
    answer each. An empty table gives an empty result.
    """

    def run(batches):
        for b in batches:
            lang, score = net.predict(list(b["text"]))
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": lang, "score": score})

    src = docs.select(id_text(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return with_id(src.mapInPandas(run, "doc_id string, lang_pred string, score double")).select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
