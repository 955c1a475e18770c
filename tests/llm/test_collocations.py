"""Quotient filters, and collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import collocations
from tidemark.llm.quotient import Lookup, Packing, merged, read_filter, write_filter


@pytest.mark.parametrize("words,bits", [(1, 1), (2, 3), (2, 20), (3, 21), (4, 16), (4, 17), (5, 13), (5, 33), (3, 64)])
def test_permutation_and_filter(words, bits):
    rng = np.random.default_rng(words * 100 + bits)
    packing = Packing(words, bits)
    grams = rng.integers(0, 2**min(bits, 62), (500, words))
    grams = np.concatenate([grams, grams[:200], np.zeros((3, words), np.int64)])
    columns = [grams[:, j] for j in range(words)]
    lanes = packing.permute(packing.pack(columns))
    assert (packing.unpack(packing.permute(lanes, back=True)) == grams).all()
    half = [(([x[a:b] for x in lanes]), np.full(b - a, 120)) for a, b in ((0, 300), (300, len(grams)))]
    got, counts = merged([merged([h]) for h in half])
    want = Counter(map(tuple, grams.tolist()))
    told = lambda la, c: dict(zip(map(tuple, packing.unpack(packing.permute(la, back=True)).tolist()), c.tolist()))
    assert told(got, counts) == {g: 120 * n for g, n in want.items()} and len(counts) == len(want)
    for shard_bits in {0, min(4, packing.widths[0])}:
        top = (got[0] >> np.uint64(packing.widths[0] - shard_bits)).astype(int) if shard_bits else np.zeros(len(counts), int)
        again = {}
        for s in set(top.tolist()):
            mine = top == s
            raw = write_filter(packing, [x[mine] for x in got], counts[mine], shard_bits)
            back, n = read_filter(packing, raw, s, shard_bits)
            assert all((x[mine] == y).all() for x, y in zip(got, back))
            again |= told(back, n)
        assert again == told(got, counts)
    lookup = Lookup(packing, got)
    assert lookup(lanes).all()
    other = rng.integers(0, 2**min(bits, 62), (500, words))
    found = lookup(packing.permute(packing.pack([other[:, j] for j in range(words)])))
    assert found.tolist() == [tuple(g) in want for g in other.tolist()]


def brute(rows, least, absorb=100, top=2000):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                counts.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        cand = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        inside = {}
        for g, a in cand.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    inside[g[i : i + k]] = max(a, inside.get(g[i : i + k], 0))
        mine = []
        for g, a in cand.items():
            if 100 * inside.get(g, 0) < absorb * a:
                score, k = min((1000 * a * n[lang] // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
                mine.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(mine)[:top])]
    return sorted(out)


def corpus():
    rng = random.Random(11)
    some = "New York is big. the quick brown fox jumps over a lazy dog, the quick brown fox; ÉTÉ Straße x\x0by\tz 😀 a a a a a a!".split(" ")
    rows = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choice(some) if rng.random() < 0.4 else "the quick brown fox jumps" for _ in range(rng.randrange(40)))) for _ in range(120)]
    return rows + [("en", None), ("fr", ""), ("en", "a " * 3_000), ("en", "new york " * 2_500), ("en", "w x y " * 30)] + [("en", "same old story")] * 25


@pytest.mark.parametrize("sizes", [{}, {"gather": 64, "held": 100}, {"vocabulary_rows": 0}, {"prune_bytes": 0, "gather": 500, "held": 600}])
def test_collocations_against_brute_force(spark, sizes):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "w", 2) for r in rows], "lang string, text string, a long, word string, n long").repartition(3)
    got = collocations.collocations(df, least=20, **sizes).collect()
    assert sorted(map(tuple, got)) == brute(rows, 20)
    assert collocations.collocations(df, least=20, absorb=60, top=3, **sizes).count() == len(brute(rows, 20, 60, 3))


def test_collocations_edges(spark):
    schema = "lang string, text string"
    run = lambda rows: collocations.collocations(spark.createDataFrame(rows, schema)).collect()
    assert run([]) == [] and run([(None, None), ("en", "")]) == [] and run([("en", "one two three")]) == []
    (r,) = run([(None, "b a. " * 100)])
    assert tuple(r) == ("und", 1, "b a", 100, 100, 100, 200, 2000)


def test_scores_beyond_64_bits(spark):
    big = spark.sql("SELECT 9000000000000 AS a, 90000000000000 AS n, 9000000000001 AS l, 9000000000007 AS r")
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    got = big.selectExpr(f"(1000 * ({wide('a')} * {wide('n')})) div ({wide('l')} * {wide('r')})").first()[0]
    assert got == 1000 * 9000000000000 * 90000000000000 // (9000000000001 * 9000000000007)
