"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of `PASSAGE` words. Every passage is encoded by a small network over its surface
statistics; gated attention weighs the encodings, and the weighted mean is scored. Weights are learned from
document labels alone.
"""

from __future__ import annotations

from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import bounded_batches, is_held_out, kept, read
from .labelled import training_sample
from .tokens import in_steps

PASSAGE = 80
#: Most labelled documents that the model is fitted on.
TRAIN_DOCS = 8_000
MEMO_WORDS, TRAITS = 250_000, 12
_SYMBOLS = frozenset("#$%&*!@^~=+<>{}[]\\/|_")


class _Words(dict):
    """word -> number; the traits of word n are row n of the table."""

    def __init__(self):
        self.forget()

    def forget(self):
        self.clear()
        self.traits, self.known = array("f"), 0

    def __missing__(self, w):
        n = self[w] = self.known
        self.known += 1
        alpha = sum(map(str.isalpha, w))
        digit = sum(map(str.isdigit, w))
        symbol = sum(c in _SYMBOLS for c in w)
        self.traits.extend((min(len(w), 40), alpha > 1 and w.upper() == w, symbol >= 2 and alpha > 0, alpha == 0, digit > 0,
                            len(w) - alpha - digit, symbol, w[-1] in ".!?", w[-1] in ",;:", len(w) == 1, w[0].isupper(), len(w) > 18))
        return n


NAMES = ("length", "spread", "caps", "symbol_end", "no_letter", "digit", "other_share", "symbol_share", "stop", "pause", "single", "capital", "long",
         "distinct", "repeat", "seen", "pair_seen", "size", "words", "lines", "first")


def passage_features(texts) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every text, in order, and the number of passages of each; an empty text has one."""
    words = kept("quality words", _Words)
    if len(words) > MEMO_WORDS:
        words.forget()
    texts = [t or "" for t in texts]
    ids, sizes, lines = [], [], []
    for t in texts:
        w = t.split()
        sizes.append(len(w))
        lines.append(t.count("\n"))
        ids.extend(map(words.__getitem__, w))
    n = np.array(sizes, dtype=np.int64)
    bags = np.maximum(-(-n // PASSAGE), 1)
    out = np.zeros((bags.sum(), len(NAMES)), np.float32)
    w = np.array(ids, dtype=np.int64)
    doc = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)
    first_bag = np.cumsum(bags) - bags
    bag = first_bag[doc] + inside // PASSAGE
    size = np.bincount(bag, minlength=len(out)).astype(np.float32)
    if len(w):
        t = np.frombuffer(words.traits, np.float32).reshape(-1, TRAITS)[w]
        some = np.maximum(size, 1)[:, None]
        sums = np.stack([np.bincount(bag, t[:, j], len(out)) for j in range(t.shape[1])], axis=1)
        squares = np.bincount(bag, t[:, 0] ** 2, len(out))
        chars = np.maximum(sums[:, 0], 1)
        mean = sums[:, 0] / some[:, 0]
        out[:, 0], out[:, 1] = mean / 10, np.sqrt(np.maximum(squares / some[:, 0] - mean**2, 0)) / 5
        out[:, 2:6] = sums[:, 1:5] / some
        out[:, 6:8] = sums[:, 5:7] / chars[:, None]
        out[:, 8:13] = sums[:, 7:12] / some
        span = np.int64(words.known + 1)

        def new(keys):
            """Whether each key stands here for the first time."""
            order = np.argsort(keys, kind="stable")
            fresh = np.ones(len(keys), bool)
            fresh[order[1:]] = keys[order][1:] != keys[order][:-1]
            return fresh

        def share(flags):
            return np.bincount(bag, flags, len(out)) / some[:, 0]

        out[:, 13] = share(new(bag * span + w))
        same = np.zeros(len(w), bool)
        same[1:] = (w[1:] == w[:-1]) & (doc[1:] == doc[:-1])
        out[:, 14] = share(same)
        out[:, 15] = share(~new(doc * span + w))
        with np.errstate(over="ignore"):
            pair = (doc[1:] * span + w[1:]) * np.int64(1_000_003) + w[:-1]
        seen = np.zeros(len(w), bool)
        seen[1:] = ~new(pair) & (doc[1:] == doc[:-1])
        out[:, 16] = share(seen)
    out[:, 17] = size / PASSAGE
    own = np.repeat(np.arange(len(n)), bags)
    out[:, 18] = np.log1p(n[own]) / 8
    out[:, 19] = np.array(lines)[own] / np.maximum(n[own], 1) * 5
    out[first_bag, 20] = 1
    return out, bags


class GatedAttention:
    """score(bag) = sigmoid(c . sum_k a_k h_k + b), h = tanh(W x), a = softmax(w . (tanh(V h) * sigmoid(U h)))."""

    def __init__(self, width: int, hidden: int = 24, gate: int = 12, seed: int = 3):
        rng = np.random.default_rng(seed)
        make = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {"W": make(width, hidden), "wb": np.zeros(hidden), "V": make(hidden, gate), "U": make(hidden, gate), "w": make(gate), "c": make(hidden), "b": np.zeros(1)}
        self.mean, self.scale = np.zeros(width), np.ones(width)

    def forward(self, x, bags):
        p = self.p
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["wb"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-np.clip(h @ p["U"], -30, 30)))
        e = (t * g) @ p["w"]
        at = np.cumsum(bags) - bags
        own = np.repeat(np.arange(len(bags)), bags)
        a = np.exp(e - np.maximum.reduceat(e, at)[own])
        a /= np.add.reduceat(a, at)[own]
        z = np.add.reduceat(a[:, None] * h, at)
        s = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))
        return s, (x, h, t, g, a, z, own, at)

    def scores(self, x, bags):
        return self.forward(x.astype(np.float64), bags)[0] if len(bags) else np.zeros(0)

    def gradients(self, x, bags, y):
        p = self.p
        s, (x, h, t, g, a, z, own, at) = self.forward(x, bags)
        d = (s - y) / len(y)
        dz = d[:, None] * p["c"]
        da = (dz[own] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, at)[own])
        dtg = de[:, None] * p["w"]
        dt, dg = dtg * g * (1 - t**2), dtg * t * g * (1 - g)
        dh = a[:, None] * dz[own] + dt @ p["V"].T + dg @ p["U"].T
        dx = dh * (1 - h**2)
        return {"W": x.T @ dx, "wb": dx.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": z.T @ d, "b": d.sum(keepdims=True)}

    def fit(self, x, bags, y, epochs: int = 40, batch: int = 128, rate: float = 4e-3, decay: float = 1e-4, seed: int = 5):
        x = x.astype(np.float64)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        at = np.cumsum(bags) - bags
        rng, m, v, k = np.random.default_rng(seed), {n: 0.0 for n in self.p}, {n: 0.0 for n in self.p}, 0
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), batch):
                pick = order[i : i + batch]
                rows = np.concatenate([np.arange(at[j], at[j] + bags[j]) for j in pick])
                grads, k = self.gradients(x[rows], bags[pick], y[pick]), k + 1
                step = rate * (1 - epoch / epochs)
                for n, grad in grads.items():
                    grad = grad + decay * self.p[n]
                    m[n] = 0.9 * m[n] + 0.1 * grad
                    v[n] = 0.999 * v[n] + 0.001 * grad**2
                    self.p[n] = self.p[n] - step * (m[n] / (1 - 0.9**k)) / (np.sqrt(v[n] / (1 - 0.999**k)) + 1e-8)
        return self


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = TRAIN_DOCS) -> GatedAttention:
    """A model fitted on at most `most` labelled documents; without any it scores 0.5."""

    def run(batches):
        for batch in batches:
            for pdf in in_steps(batch):
                x, bags = passage_features(pdf["text"])
                upto = np.cumsum(bags)
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"], "x": [x[e - n : e].ravel() for e, n in zip(upto, bags)]})

    rows = training_sample(bounded_batches(docs), labels, label, most).mapInPandas(run, "doc_id long, label int, x array<float>").toPandas()
    model = GatedAttention(len(NAMES))
    if not len(rows):
        model.p["c"][:] = 0
        return model
    rows = rows.sort_values("doc_id")
    bags = np.array([len(r) // len(NAMES) for r in rows["x"]])
    return model.fit(np.concatenate(rows["x"].tolist()).reshape(-1, len(NAMES)), bags, rows["label"].to_numpy(float))


def quality_score(model: GatedAttention, text):
    """Column with the model's score of a whole text; null and empty texts are scored as empty bags."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        out = [model.scores(*passage_features(part["text"])) for part in in_steps(texts.to_frame("text"))]
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return scored(text)


def op8_quality(spark, sf_dir):
    """Quality scores of all documents by a model fitted on rows that aren't held out."""
    docs = read(spark, sf_dir, "documents")
    model = fit_quality(docs, read(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", quality_score(model, F.col("text")).alias("score"))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
