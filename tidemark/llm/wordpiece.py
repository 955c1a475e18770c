"""Greedy longest-match token counts in linear time.

The vocabulary is a trie whose nodes have a failure link and the number of tokens popped when it is taken, so
a word is read byte by byte without backing up, and its pieces are counted without being built.
"""

from __future__ import annotations

import json
from collections import deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import bounded_batches, read
from .tokens import in_steps, tokenizer_path

#: Words whose counts a worker remembers before it starts afresh.
MEMO_WORDS = 400_000


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest for 256 onwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_vocabulary(name_or_path: str) -> list[bytes]:
    """The tokens of a byte-level tokenizer file as bytes, special tokens left out."""
    with open(tokenizer_path(name_or_path), encoding="utf-8") as f:
        model = json.load(f)
    special = {t["content"] for t in model.get("added_tokens", []) if t.get("special")}
    of = byte_alphabet()
    return [bytes(of[c] for c in t) for t in model["model"]["vocab"] if t not in special]


class LongestMatch:
    """count(word): number of pieces of the greedy longest-match segmentation, None if some part has no piece."""

    def __init__(self, vocabulary):
        self.child, ends = {}, set()
        parent, kids = [-1], [[]]
        for token in vocabulary:
            u = 0
            for b in token:
                v = self.child.get(u << 8 | b)
                if v is None:
                    v = self.child[u << 8 | b] = len(parent)
                    parent.append(u)
                    kids.append([])
                    kids[u].append((b, v))
                u = v
            if u:
                ends.add(u)
        self.fail, self.pops = [-1] * len(parent), [0] * len(parent)
        todo = deque([0])
        while todo:
            u = todo.popleft()
            for b, v in kids[u]:
                todo.append(v)
                if v in ends:  # all of it is one piece
                    self.fail[v], self.pops[v] = 0, 1
                    continue
                z, popped = self.fail[u], self.pops[u]
                while z >= 0 and (z << 8 | b) not in self.child:
                    popped += self.pops[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[v], self.pops[v] = self.child[z << 8 | b], popped

    def count(self, word: bytes) -> int | None:
        child, fail, pops, u, n = self.child, self.fail, self.pops, 0, 0
        for b in word:
            while (v := child.get(u << 8 | b)) is None:
                if fail[u] < 0:
                    return None
                n += pops[u]
                u = fail[u]
            u = v
        while u:
            if fail[u] < 0:
                return None
            n += pops[u]
            u = fail[u]
        return n


class _Counts(dict):
    def __init__(self, match):
        self.match = match

    def __missing__(self, word):
        n = self.match.count(b" " + word)
        # a part that no piece covers: its bytes count one each
        n = self[word] = len(word) + 1 if n is None else n
        return n


_WORKERS: dict[str, _Counts] = {}


def count_tokens(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_tokens. A word is a run of other than ASCII white space; it is read
    with a space before it. Null and empty texts have no words and no tokens."""

    def run(batches):
        for batch in batches:
            for pdf in in_steps(batch):
                counts = _WORKERS.get(vocabulary)
                if counts is None or len(counts) > MEMO_WORDS:
                    counts = _WORKERS[vocabulary] = _Counts(counts.match if counts else LongestMatch(byte_vocabulary(vocabulary)))
                words = [(t or "").encode("utf-8", "surrogatepass").split() for t in pdf["text"]]
                yield pd.DataFrame({"id": pdf["id"].astype("Int64"), "n_words": [len(w) for w in words], "n_tokens": [sum(map(counts.__getitem__, w)) for w in words]})

    src = bounded_batches(docs).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return src.mapInPandas(run, "id long, n_words long, n_tokens long").withColumnRenamed("id", id)


def op2_count_tokens(spark, sf_dir):
    """Word and token counts of all documents."""
    return count_tokens(read(spark, sf_dir, "documents"))
