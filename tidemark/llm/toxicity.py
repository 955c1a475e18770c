"""Toxicity: support vector machine over a gap-weighted subsequence string kernel with Nystroem landmarks.

A sentence is compared with landmark strings by the subsequence kernel of its words, so a word with letters
inserted or spread out still matches. The value is taken as a share of the landmark's own, at most 1, and chance
likeness below FLOOR is nought; landmarks are compared with one another by the same function. Landmarks are word
beginnings that mark toxic documents in the training sample. The values are mapped by the inverse root of the
landmarks' own matrix; a linear SVM is trained on sentences, where a toxic document counts through its most toxic
sentence. Words of fewer than four letters have no subsequence of four and count for nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import bounded_batches, is_held_out, kept, read
from .labelled import training_sample
from .tokens import in_steps

#: Most labelled documents of each class that the model is fitted on, landmarks, and words of a generation (a worker remembers two).
TRAIN_DOCS, LANDMARKS, MEMO_WORDS = 4_000, 64, 400_000
#: Subsequence length, gap decay, and the kernel value (of a landmark's own) below which a word doesn't count.
ORDER, DECAY, FLOOR = 4, 0.6, 0.4
#: Longest piece of a token; words or pairs that are computed at once.
WIDTH, BLOCK = 24, 2_048
_DROP, _DIGIT = re.compile(r"[\W_]+"), re.compile(r"\d+")
_SPACED = re.compile(r"(?<!\w)\w(?:[^\w\n]{1,3}\w(?!\w)){3,}")
_STOP = ".!?"


def _codes(strings: list[str], width: int) -> np.ndarray:
    """Code points of each string, cut or padded with 0 to the width."""
    return np.array(strings, dtype=f"<U{width}").view(np.uint32).reshape(len(strings), width)


def pair_kernel(codes: np.ndarray, others: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """For each row of codes and the same row of others (0 pads codes, 1 others) the sum over common subsequences of
    length `order`, each weighted by decay to the lengths it spans in both strings."""
    n, width, m = len(codes), codes.shape[1], others.shape[1]
    one, two = np.ascontiguousarray(codes.T), np.ascontiguousarray(others.T)
    prior = np.ones((m + 1, width + 1, n), np.float32)  # K'_0
    total, hit = np.zeros(n, np.float32), np.empty(n, np.float32)
    match = (two[:, None] == one[None]).astype(np.float32)
    for level in range(1, order):
        now = np.zeros_like(prior)
        for i in range(level, m + 1):
            row = np.zeros(n, np.float32)
            for j in range(level, width + 1):
                np.multiply(match[i - 1, j - 1], prior[i - 1, j - 1], out=hit)
                hit *= decay
                row += hit
                row *= decay
                np.multiply(now[i - 1, j], decay, out=hit)
                np.add(row, hit, out=now[i, j])
        prior = now
    for i in range(order, m + 1):
        for j in range(order, width + 1):
            np.multiply(match[i - 1, j - 1], prior[i - 1, j - 1], out=hit)
            total += hit
    return total * np.float32(decay * decay)


def subsequence_kernel(codes: np.ndarray, other: str, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """pair_kernel of each row of codes with one string."""
    return pair_kernel(codes, np.repeat(_codes([other], len(other)), len(codes), 0), order, decay)


@dataclass
class ToxicModel:
    landmarks: list[str]
    root: np.ndarray  # inverse root of the landmarks' normalised kernel matrix
    weights: np.ndarray
    bias: float
    slope: float = 4.0
    shift: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability for pooled kernel rows."""
        z = (x @ self.root) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -30, 30)))


class _Bounds:
    """What the letters that a word shares with a landmark allow at most.

    A common subsequence only uses places of the landmark whose letters the word has, so by Cauchy and Schwarz the
    kernel is at most the root of the word's own value times the landmark's own value over those places. That one is
    looked up by the set of places; letters are told apart by 64 classes, which can only make the set larger."""

    def __init__(self, landmarks: list[str]):
        self.own = np.array([float(subsequence_kernel(_codes([m], len(m)), m)[0]) for m in landmarks], np.float32)
        self.places = np.zeros((64, len(landmarks)), np.float32)  # of a letter in each landmark, as bits
        self.most = []
        for k, mark in enumerate(landmarks):
            for i, c in enumerate(mark):
                self.places[ord(c) % 64, k] += 1 << i
            sets = np.arange(1 << len(mark))[:, None] >> np.arange(len(mark)) & 1
            codes = np.where(sets > 0, _codes([mark], len(mark)), 0).astype(np.uint32)
            parts = [subsequence_kernel(codes[a : a + BLOCK], mark) for a in range(0, len(codes), BLOCK)]
            # over those places only: of the two strings, one has the others blanked
            self.most.append(np.sqrt(np.concatenate(parts)) / self.own[k])

    def possible(self, codes: np.ndarray) -> list[np.ndarray]:
        """For each landmark the rows of codes that can reach FLOOR."""
        word = np.sqrt(pair_kernel(codes, np.where(codes == 0, 1, codes)))
        letters = np.zeros((len(codes), 64), np.float32)
        for column in codes.T:
            letters[np.flatnonzero(column), column[column > 0] % 64] = 1
        sets = (letters @ self.places).astype(np.int64)
        return [np.flatnonzero(most[sets[:, k]] * word >= FLOOR * (1 - 1e-3)) for k, most in enumerate(self.most)]


def word_kernel(words: list[str], landmarks: list[str], spare: bool = True) -> np.ndarray:
    """(words, landmarks): the kernel as a share of the landmark's own, at most 1; below FLOOR it is 0.

    spare: pairs that a bound proves to lie below FLOOR aren't computed; the values are the same without it. Pairs
    are computed together with those of other landmarks of about that length."""
    out = np.zeros((len(words), len(landmarks)), np.float32)
    bounds = _bounds(tuple(landmarks))
    size = np.array([len(w) for w in words], dtype=np.int64)
    order = np.argsort(size, kind="stable")
    order = order[np.searchsorted(size[order], ORDER) :]
    groups = {n: [k for k, m in enumerate(landmarks) if len(m) == n] for n in {len(m) for m in landmarks}}
    marks = {n: _codes([landmarks[k] for k in ks], n) for n, ks in groups.items()}
    for a in range(0, len(order), BLOCK):
        at = order[a : a + BLOCK]  # words of about one length
        codes = _codes([words[i] for i in at], int(size[at[-1]]))
        able = bounds.possible(codes) if spare else [np.arange(len(at))] * len(landmarks)
        for n, ks in groups.items():
            row = np.concatenate([able[k] for k in ks])
            mark = np.repeat(np.arange(len(ks)), [len(able[k]) for k in ks])
            for b in range(0, len(row), BLOCK):
                r, m = row[b : b + BLOCK], mark[b : b + BLOCK]
                k = np.array(ks)[m]
                out[at[r], k] = np.minimum(pair_kernel(codes[r], marks[n][m]) / bounds.own[k], 1)
    out[out < FLOOR] = 0
    return out


@lru_cache(4)
def _bounds(landmarks: tuple[str, ...]) -> _Bounds:
    return _Bounds(list(landmarks))


def units(token: str) -> list[str]:
    """The letters and digits of a token, and its letters alone if it has both; long ones in overlapping windows, so
    that none is cut off."""
    if len(token) <= WIDTH and token.isalpha():
        return [token]
    w = _DROP.sub("", token)
    bare = _DIGIT.sub("", w)
    forms = [w] if bare == w or not bare else [w, bare]
    return [f[i : i + WIDTH] for f in forms for i in range(0, max(1, len(f) - WIDTH // 2), WIDTH // 2)]


class _Marks(dict):
    """token -> row of its kernel values, -1 if it matches no landmark, or -2 until it is settled."""

    def __init__(self, landmarks):
        self.landmarks, self.rows, self.waiting, self.old = landmarks, [], [], {}

    def turn(self):
        """A new generation; what is met again is taken over from the one so far."""
        self.old = {t: self.rows[n] if n >= 0 else None for t, n in self.items()}
        self.clear()
        self.rows = []

    def __missing__(self, token):
        n = -2
        if token in self.old:
            n = -1
            if (row := self.old[token]) is not None:
                n = len(self.rows)
                self.rows.append(row)
        else:
            self.waiting.append(token)
        self[token] = n
        return n

    def settle(self):
        parts, at = [], []
        self.update(dict.fromkeys(self.waiting, -1))
        for i, token in enumerate(self.waiting):
            for u in units(token) if len(token) >= ORDER else ():
                if len(u) >= ORDER:
                    parts.append(u)
                    at.append(i)
        x = word_kernel(parts, self.landmarks)
        for j in np.flatnonzero(x.any(1)):
            token = self.waiting[at[j]]
            if self[token] < 0:
                self[token] = len(self.rows)
                self.rows.append(x[j].copy())  # a view would keep all of x
            else:
                self.rows[self[token]] = np.maximum(self.rows[self[token]], x[j])
        self.waiting = []


def sentence_features(texts, landmarks: list[str]) -> list[np.ndarray]:
    """Per text the rows of its sentences that match some landmark (none: no rows): of each landmark the likest word."""
    marks = kept(("toxic words", tuple(landmarks)), lambda: _Marks(landmarks))
    if len(marks) > MEMO_WORDS:
        marks.turn()
    split = []
    for t in texts:
        t = (t or "").lower()
        if _SPACED.search(t):
            t = _SPACED.sub(lambda m: m.group() + " " + _DROP.sub("", m.group()), t)
        split.append(t.split())
    met = [np.fromiter(map(marks.__getitem__, tokens), np.int32, len(tokens)) for tokens in split]
    marks.settle()
    out, none = [], np.zeros((0, len(landmarks)), np.float32)
    for tokens, rows in zip(split, met):
        for i in np.flatnonzero(rows == -2):
            rows[i] = marks[tokens[i]]
        found = np.flatnonzero(rows >= 0)
        if not len(found):
            out.append(none)
            continue
        ends = np.cumsum([t[-1] in _STOP for t in tokens])  # the sentence of a token: stops before it
        sentence = np.where(found, ends[found - 1], 0)
        first = np.flatnonzero(np.r_[True, sentence[1:] != sentence[:-1]])
        out.append(np.maximum.reduceat(np.stack([marks.rows[r] for r in rows[found]]), first))
    return out


def pick_landmarks(sample: DataFrame, most: int = LANDMARKS) -> list[str]:
    """Word beginnings that toxic documents of the sample have and others lack, unlike one another."""
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return []
    word = F.explode(F.array_distinct(F.split(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}\s]", ""), r"\s+"))).alias("w")
    starts = F.explode(F.transform(F.sequence(F.lit(ORDER), F.least(F.length("w"), F.lit(12))), lambda n: F.substring("w", F.lit(1), n))).alias("s")
    rows = sample.select("doc_id", "label", word).where(F.length("w") >= ORDER).select("doc_id", "label", starts).distinct()
    counts = rows.groupBy("s").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q")).where(F.col("p") >= max(4, pos // 200))
    odds = F.log((F.col("p") + 0.1) / (pos + 0.2)) - F.log((F.col("q") + 0.1) / (neg + 0.2))
    # support counts, and at equal support the longer string
    best = counts.withColumn("odds", odds).where("odds > 2").withColumn("gain", F.col("p") * F.col("odds"))
    found = [r["s"] for r in best.orderBy(F.desc("gain"), F.desc(F.length("s")), "s").limit(12 * most).collect()]
    chosen: list[str] = []
    for s in found:
        if len(chosen) == most:
            break
        if not chosen or max(word_kernel([s], chosen).max(), word_kernel(chosen, [s]).max()) < 0.75:
            chosen.append(s)
    return chosen


def _svm(x, y, weight, rounds: int = 400, penalty: float = 1e-3):
    """Linear SVM with squared hinge loss, by accelerated gradient steps."""
    x = np.c_[x, np.ones(len(x))]
    step = 1 / (2 * np.linalg.norm(x * np.sqrt(weight)[:, None], 2) ** 2 / weight.sum() + penalty)
    w = z = np.zeros(x.shape[1])
    for k in range(rounds):
        slack = np.maximum(1 - y * (x @ z), 0)
        new = z - step * (-2 * (x * (weight * slack * y)[:, None]).sum(0) / weight.sum() + penalty * np.r_[z[:-1], 0])
        z, w = new + k / (k + 3) * (new - w), new
    return w[:-1], float(w[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = TRAIN_DOCS) -> ToxicModel:
    """A model fitted on at most `most` labelled documents of each class; without landmarks it scores the base rate."""
    sample = training_sample(bounded_batches(docs), labels, label, most, per_class=True)
    sample = sample.persist()
    landmarks = pick_landmarks(sample) or ["\0" * (ORDER + 1)]
    gram = word_kernel(landmarks, landmarks).astype(np.float64)
    val, vec = np.linalg.eigh((gram + gram.T) / 2)
    val = np.maximum(val, 1e-2)
    root = (vec / np.sqrt(val)) @ vec.T

    def run(batches):
        for batch in batches:
            for pdf in in_steps(batch):
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"], "x": [f.ravel() for f in sentence_features(pdf["text"], landmarks)]})

    rows = sample.mapInPandas(run, "doc_id long, label int, x array<float>").toPandas().sort_values("doc_id")
    sample.unpersist()
    model = ToxicModel(landmarks, root, np.zeros(len(landmarks)), -1.0)
    y = rows["label"].to_numpy()
    if not (y == 1).any() or not (y == 0).any():
        return model
    m = len(landmarks)
    bags = [np.asarray(x, np.float32).reshape(-1, m) if len(x) else np.zeros((1, m), np.float32) for x in rows["x"]]
    pick = [b[b.sum(1).argmax()] for b in bags]
    quiet = [b for b, k in zip(bags, y) if k == 0]
    for _ in range(3):
        x = np.concatenate([np.stack([p for p, k in zip(pick, y) if k == 1]), *quiet]) @ root
        t = np.r_[np.ones((y == 1).sum()), -np.ones(len(x) - (y == 1).sum())]
        # sentences of clean documents outnumber the toxic ones; both classes weigh the same
        model.weights, model.bias = _svm(x, t, np.where(t > 0, (t < 0).sum() / (t > 0).sum(), 1.0))
        pick = [b[((b @ root) @ model.weights).argmax()] for b in bags]
    margin = np.array([((b @ root) @ model.weights).max() + model.bias for b in bags])
    a, c = 1.0, 0.0  # a logistic curve over the margins (Platt)
    for _ in range(2000):
        p = 1 / (1 + np.exp(-(a * margin + c)))
        a, c = a - 0.5 * float(((p - y) * margin).mean()), c - 0.5 * float((p - y).mean())
    model.slope, model.shift = max(a, 0.1), c
    return model


def score_toxicity(docs: DataFrame, model: ToxicModel, column: str = "score", text: str = "text") -> DataFrame:
    """docs with the score of the most toxic sentence of every whole text; empty and null texts score as no match.
    A column of that name is replaced."""
    none = float(model.scores(np.zeros((1, len(model.landmarks)), np.float32))[0])

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        out = []
        for part in in_steps(texts.to_frame("text")):
            out += [max(none, float(model.scores(f).max())) if len(f) else none for f in sentence_features(part["text"], model.landmarks)]
        return pd.Series(out, dtype="float64")

    return docs.withColumn(column, scored(F.col(text)))


def op3_toxicity(spark, sf_dir):
    """Toxicity scores of all documents by a model fitted on rows that aren't held out."""
    docs = read(spark, sf_dir, "documents")
    model = fit_toxicity(docs, read(spark, sf_dir, "labels"))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
