"""Edge cases and brute-force twins of the pipeline operators on small tables."""

import base64
import gzip
import itertools
import random
import re
import tracemalloc
import urllib.parse
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chosen_path, components, decontaminate, idcoder, idfiles, lattice, packing, quality, secrets, sharding, tokens, toxicity, wordpiece

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string"


def docs(spark, *texts, first=0):
    return spark.createDataFrame([(first + i, t, None, "s", None, "x") for i, t in enumerate(texts)], DOCS)


EDGE = ["", None, " \n ", "one", "a b", "Ünï çödé\tx", "same text here", "same text here", "long " * 30_000]


def edge(spark):
    """Empty, null and long texts, ties, a repeated row, a null id, and a column named like an internal one."""
    d = docs(spark, *EDGE)
    return d.union(d.where("doc_id = 6")).union(spark.createDataFrame([(None, "null id", None, None, None, None)], DOCS))


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_lattice_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 16))
    x = np.concatenate([base, base[:30] + rng.normal(scale=0.03, size=(30, 16)), base[:1] + rng.normal(scale=0.02, size=(900, 16)), base[:5]]).astype(np.float32)
    labels = np.r_[np.zeros(60), np.zeros(30), np.zeros(900), np.zeros(4), 1].astype(int)
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = (u @ u.T >= 0.98) & (labels[:, None] == labels)
    np.fill_diagonal(link, False)
    comp = np.arange(len(x))
    while True:
        new = np.array([min(comp[i], comp[link[i]].min(initial=len(x))) for i in range(len(x))])
        if (new == comp).all():
            break
        comp = new
    got = {r["vec_id"]: r for r in lattice.lattice_components(vectors(spark, [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, labels))])).collect()}
    assert [got[i]["n_links"] for i in range(len(x))] == link.sum(1).tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == comp.tolist()


def test_lattice_edges(spark):
    v = [1.0, 2.0]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [0.0, 0.0], 0), (7, [1.0, float("nan")], 0), (8, [1.0, None], 0), (9, [], 0), (None, v, 0), (10, [1.0, 2.0, 0.0], 0)]
    got = lattice.lattice_components(vectors(spark, rows)).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in got) == [(0, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False)] + [(i, 0, i, True) for i in range(3, 11)]
    assert lattice.lattice_components(vectors(spark, [])).count() == 0


def test_lattice_keeps_components_of_a_bin_apart(spark):
    pair, longer = [[1.0, 2.0, 3.0], [1.0, 2.0, 3.01]], [[1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 4.01]]
    rows = [(i, v, label) for i, (v, label) in enumerate([(v, 0) for v in pair] + [(v, 1) for v in pair] + [(v, 0) for v in longer])]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in lattice.lattice_components(vectors(spark, rows)).collect())
    assert got == [(i, 1, i // 2 * 2) for i in range(6)]
    got = lattice.lattice_components(vectors(spark, rows[:4])).collect()
    assert [r["n_links"] for r in got] == [1] * 4


def test_e8():
    r = lattice.roots()
    assert len(r) == 240 and np.allclose((r**2).sum(1), 2)
    y = np.random.default_rng(0).normal(size=(200, 8))
    p = lattice.nearest_e8(y)
    for k in r:  # no neighbour is nearer
        assert (((y - p) ** 2).sum(1) <= ((y - p - k) ** 2).sum(1) + 1e-9).all()


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 180)] + [(7, k) for k in range(300, 400)] + [(rng.randrange(500, 600), rng.randrange(500, 600)) for _ in range(70)]
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: find(i) for i in parent if any(i in e and e[0] != e[1] for e in links)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_near(texts, width, cents):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    comp = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        i = len(sets[a] & sets[b])
        if i and 100 * i >= cents * (len(sets[a]) + len(sets[b]) - i):
            lo, hi = sorted((comp[a], comp[b]))
            comp = [lo if c == hi else c for c in comp]
    return [len(s) for s in sets], comp


def test_chosen_path_against_all_pairs(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    make = lambda n: [rng.choice(vocab) for _ in range(n)]

    def edit(w, n):
        w = list(w)
        for _ in range(n):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        return w

    seed = make(60)
    texts = [make(40) for _ in range(20)] + [edit(seed, rng.randrange(5)) for _ in range(120)] + [make(3), make(1), [], ["A", "b"], ["a", "B"]]
    texts = [" ".join(t) for t in texts] + [None]
    for width in (2, 5):
        sizes, comp = brute_near(texts, width, 80)
        got = {r["doc_id"]: r for r in chosen_path.near_duplicates(docs(spark, *texts), width=width, leaf=8, depth=4).collect()}
        assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
        assert [got[i]["component_id"] for i in range(len(texts))] == comp
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_chosen_path_recall_at_every_depth(spark, monkeypatch):
    for depth in range(1, 9):
        trees = chosen_path.trees_for(0.999, 80, depth)
        assert 1 - (1 - 0.8**depth) ** trees >= 0.999 > 1 - (1 - 0.8**depth) ** (trees - 1)
    assert chosen_path.trees_for(0.999, 80, 4) == 14 and chosen_path.trees_for(0.999, 100, 6) == 1
    used = []
    real = chosen_path.candidates
    monkeypatch.setattr(chosen_path, "candidates", lambda sets, cents, trees, depth, leaf: used.append((trees, depth)) or real(sets, cents, trees, depth, leaf))
    assert chosen_path.near_duplicates(docs(spark, "a b c", "a b c", "d e f")).where("kept").count() == 2
    assert used == [(14, 4)]


def test_chosen_path_edges(spark):
    got = chosen_path.near_duplicates(edge(spark), width=2).collect()
    assert len(got) == len(EDGE) + 2
    by = {r["doc_id"]: r for r in got}
    assert by[0]["n_shingles"] == by[1]["n_shingles"] == by[2]["n_shingles"] == 0 and by[3]["n_shingles"] == 1
    assert by[7]["component_id"] == 6 and by[None]["component_id"] is None and by[None]["kept"]
    assert chosen_path.near_duplicates(docs(spark, "x").where("false")).count() == 0


def test_chosen_path_with_repeated_and_missing_ids(spark):
    """Rows that share an id keep their own links, rows without one take part, and one row of a component stays."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    c = " ".join(f"c{i}" for i in range(60))
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (None, c), (None, c + " more"), (9, c), (5, "alone"), (5, "alone"), (None, "none has one"), (None, "none has one"), (7, ""), (7, ""), (None, None), (4, a)]
    d = spark.createDataFrame([(*r, 1, "h", 2) for r in rows], "doc_id long, text string, n int, h string, component int").repartition(4)
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in chosen_path.near_duplicates(d, leaf=2).collect())
    comp = lambda i, t: "9" if "c1" in t else "1" if "a1" in t or "b1" in t else str(i)
    n = lambda t: max(0, len(t.split()) - 4) or int(bool(t.split()))
    want = [(str(i), n(t or ""), comp(i, t or ""), str(i) == comp(i, t or "")) for i, t in rows]
    assert got == sorted(want)
    one = chosen_path.keep_one(d, leaf=2)
    assert one.columns == d.columns
    kept = sorted((str(r["doc_id"]), r["text"] or "") for r in one.collect())
    # 1 and 3, and 1, 2 and 4, are two components of texts: a row of each stays
    assert kept == sorted([("1", a), ("1", b), ("9", c), ("5", "alone"), ("None", "none has one"), ("7", ""), ("7", ""), ("None", "")])


def brute_words(t):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_decontamination_against_scan(spark):
    rng = random.Random(4)
    vocab = list("abcdefgh") + ["ünï", "x1"]
    items = [" ".join(rng.choice(vocab) for _ in range(n)) for n in (25, 12, 10, 4, 1, 0)] + [None]
    texts = [" ".join(rng.choice(vocab) for _ in range(60)) for _ in range(8)] + ["Q. " + (items[0] or "").upper() + "!", items[1] + " " + items[1], "", None, "zz"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r["row"]["doc_id"]: r for r in decontaminate.contamination(docs(spark, *texts), bench, keep=("doc_id", "words")).collect()}
    for d, t in enumerate(texts):
        w, hit, found = brute_words(t), set(), set()
        for i, item in enumerate(items):
            v = brute_words(item)
            k = min(10, len(v))
            for a in range(len(v) - k + 1 if v else 0):
                for s in range(len(w) - k + 1):
                    if w[s : s + k] == v[a : a + k]:
                        hit.update(range(s, s + k))
                        found.add(str(i))
        assert (got[d]["n_words"], got[d]["n_hit"], got[d]["items"]) == (len(w), len(hit), sorted(found)), t
        assert got[d]["contaminated"] == bool(hit)
    near = decontaminate.proximity_matches(decontaminate.build_index(docs(spark, "a x b y c", "a x x x b c")), spark.createDataFrame([(["a", "b", "c"],)], "phrase array<string>"), slack=1)
    assert [(r["start"], r["end"]) for r in near.collect()] == [(0, 4)]


def test_proximity_against_all_walks(spark):
    rng = random.Random(5)
    texts = [[rng.choice("abcdq") for _ in range(25)] for _ in range(30)] + [list("abqbzzc"), list("abbxc")]
    phrases = [list("abc"), list("dab"), list("ac"), list("c"), list("az")]
    index = decontaminate.build_index(docs(spark, *map(" ".join, texts)))
    wanted = spark.createDataFrame([(p,) for p in phrases], "phrase array<string>")

    def ends(w, places, terms, slack):
        for t in terms:
            places = {q for p in places for q in range(p + 1, p + 2 + slack) if q < len(w) and w[q] == t}
        return places

    for slack in (0, 1, 2):
        want = {(d, "".join(p)) for d, w in enumerate(texts) for p in phrases if ends(w, {i for i, x in enumerate(w) if x == p[0]}, p[1:], slack)}
        for most in (200_000, 0):  # joined by broadcast, and by shuffle
            found = decontaminate.proximity_matches(index, wanted, slack, most).join(index.select("rid", "row.doc_id"), "rid").collect()
            assert {(r["doc_id"], "".join(r["phrase"])) for r in found} == want
            assert all(texts[r["doc_id"]][r["start"]] == r["phrase"][0] and texts[r["doc_id"]][r["end"]] == r["phrase"][-1] for r in found)
    near, far = (sorted(decontaminate.exact_matches(index, wanted, most).drop("phrase").collect()) for most in (200_000, 0))
    assert near == far and len(near)


def test_decontamination_edges(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(edge(spark), none).where("contaminated").count() == 0
    bench = spark.createDataFrame([(None, "one"), (1, "same text here")], "item_id long, text string")
    got = decontaminate.contamination(edge(spark), bench)
    assert got.count() == len(EDGE) + 2 and got.where("contaminated").count() == 4
    assert sorted((r["row"]["doc_id"], r["n_hit"], r["n_items"], r["items"]) for r in got.where("contaminated").collect())[0] == (3, 1, 1, [])


def test_sharding(spark):
    d = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 5).alias("text"))
    got = sharding.place(d.union(spark.createDataFrame([(None, None)], "doc_id long, text string")), {s: 1.0 for s in range(8)}).collect()
    assert len(got) == 3001
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert all(r["grown_shard"] in (r["shard"], 8) for r in got) and len({r["shard"] for r in got if r["doc_id"] == 7}) == 1
    assert all(r["text_crc32"] == zlib.crc32((f"t{r['doc_id'] % 5}").encode()) for r in got if r["doc_id"] not in (7, None))
    nothing = next(r for r in got if r["doc_id"] is None)
    assert (nothing["size"], nothing["text_crc32"]) == (1, 0)
    share = spark.range(20_000).select(sharding.rendezvous(F.col("id"), {0: 1.0, 1: 3.0}).alias("s")).where("s = 1").count()
    assert abs(share / 20_000 - 0.75) < 0.02
    assert sharding.place(d.where("false"), {0: 1.0}).count() == 0


def test_sharding_by_text_keys(spark):
    """25,000 text keys beside columns named like internal ones; slots follow the keys' own order."""
    d = spark.range(25_000).selectExpr("concat('k', id) AS name", "'x' AS text", "1 AS key", "2 AS size", "3 AS rid", "4 AS shard", "5 AS range")
    for weights in ({s: 1.0 for s in range(4)}, {0: 1.0}):
        got = sharding.place(d, weights, key="name").collect()
        for s in weights:
            mine = sorted((r for r in got if r["shard"] == s), key=lambda r: r["slot"])
            assert [r["slot"] for r in mine] == list(range(len(mine))) and [r["name"] for r in mine] == sorted(r["name"] for r in mine)
        assert len(got) == 25_000


SECRET = 'password="abcdefghijklmnop123"'


@pytest.mark.parametrize("wrap", [
    urllib.parse.quote, lambda s: base64.b64encode(s.encode()).decode(), lambda s: base64.urlsafe_b64encode(zlib.compress(s.encode())).decode(),
    lambda s: base64.b64encode(gzip.compress(s.encode())).decode(), lambda s: "".join(f"\\u{ord(c):04x}" for c in s), lambda s: "".join(f"\\x{ord(c):02x}" for c in s),
    lambda s: "".join(f"&#{ord(c)};" for c in s), lambda s: urllib.parse.quote(base64.b64encode(urllib.parse.quote(s).encode()).decode())])
def test_secrets_unwrap(wrap):
    text = "zz " + wrap(SECRET) + " yy"
    found = secrets.scan(text)[1]
    assert any(k == "assign" and 3 <= s < e <= len(text) - 3 and p for k, s, e, p in found)
    assert all(k != "assign" for k, *_ in secrets.scan("zz " + wrap("nothing to be seen here at all") + " yy")[1])


_B64 = lambda b: base64.b64encode(b).decode()


@pytest.mark.parametrize("text", [
    "zz " + _B64(gzip.compress(bytes(70 << 20) + SECRET.encode() + b" ")) + " yy",  # over 64 MiB
    "zz " + _B64(gzip.compress(b"nothing") + gzip.compress(SECRET.encode())) + " yy", "zz " + _B64(gzip.compress(SECRET[:9].encode()) + gzip.compress(SECRET[9:].encode())) + " yy",
    "zz " + _B64(gzip.compress((SECRET + " x").encode())[:-6]) + " yy", "zz " + _B64(zlib.compress(SECRET.encode())[:-4] + b"0000") + " yy",  # cut off, damaged
    "zz " + _B64(("\0\u200b\xad " + SECRET).encode()) + " yy", "zz " + _B64(b"\xff\xfe " + SECRET.encode()) + " yy",
    "zz %ff" + urllib.parse.quote(SECRET) + " yy", "zz \\xff" + "".join(f"\\x{b:02x}" for b in SECRET.encode()) + " yy", "zz \\ud800" + "".join(f"\\u{b:04x}" for b in SECRET.encode()) + " yy",
    "zz " + "".join(f"%{b:02x}" for b in gzip.compress(SECRET.encode())) + " yy", "zz " + urllib.parse.quote(zlib.compress(SECRET.encode())) + " yy",
    "zz http://h/a/" + _B64(SECRET.encode()) + " yy", "zz id_" + _B64(SECRET.encode()) + " yy", "zz k-1-" + _B64(gzip.compress(SECRET.encode())) + "/x yy",
    *["zz " + end.join(re.findall(f".{{1,{n}}}", _B64(gzip.compress((SECRET + " and more " * 9).encode(), mtime=0) if packed else (f"{SECRET} and more " * 4).encode()))) + " yy" for n, end, packed in ((64, "\n", False), (76, "\r\n", True), (12, "\n", False))]])
def test_secrets_in_whole_layers(text):
    found = secrets.scan(text)[1]
    assert any(k == "assign" and 3 <= s < e <= len(text) - 3 and p for k, s, e, p in found)


def test_secret_forms_of_unicode():
    secret = "password=abcdefghijklmnop"
    wide = lambda e: base64.b64encode(secret.encode(e)).decode()
    lines = base64.b64encode((secret + " ; ") .encode() * 3).decode()
    for way, coded in (
        ("/unicode", "".join(f"\\u{{{ord(c):x}}}" for c in secret)), ("/unicode", "".join(f"%u{ord(c):04x}" for c in secret)), ("/unicode", "".join(f"\\U{ord(c):08X}" for c in secret)),
        ("/unicode", "".join(f"&#{ord(c)}" for c in secret)), ("/unicode", "".join(f"&#x{ord(c):x};" for c in secret)), ("/base64/utf-16", wide("utf-16-le")), ("/base64/utf-16", wide("utf-16-be")),
    ):
        base, found = secrets.scan(f"so {coded} it")
        assert not base and [f[:1] + f[3:] for f in found] == [("assign", way)], coded
        assert found[0][1] in (3, 4) and 3 + len(coded) - 4 <= found[0][2] <= 3 + len(coded)
    quoted = "> " + "\n> ".join(lines[i : i + 24] for i in range(0, len(lines), 24))
    assert len(secrets.scan(f"mail:\n{quoted}\nend")[1]) == 3
    assert secrets.scan("\\u{110000} \\UFFFFFFFF &#0; &# %u12 \\u{}") == ([], [])



def test_secret_early_in_a_large_stream_spans_all_of_it():
    code = _B64(gzip.compress(SECRET.encode() + bytes(40 << 20)))
    assert [(s, e) for k, s, e, _ in secrets.scan("zz " + code + " yy")[1] if k == "assign"] == [(3, 3 + len(code.rstrip("=")))]


def test_secret_in_a_stream_nested_across_parts(monkeypatch):
    noise = bytes(random.Random(8).choices(b"ghijk lmnop!? ,.", k=60_000))
    monkeypatch.setattr(secrets, "INFLATE_CHUNK", 1 << 13)
    monkeypatch.setattr(secrets, "OVERLAP", 1 << 10)
    monkeypatch.setattr(secrets, "_STEP", 1 << 11)
    packed = gzip.compress(noise + SECRET.encode() + noise)
    for inner in (packed, noise[:9_000] + packed + noise[:9_000], gzip.compress(packed)):
        code = _B64(gzip.compress(inner))
        assert [(s, e) for k, s, e, _ in secrets.scan("zz " + code + " yy")[1] if k == "assign"] == [(3, 3 + len(code.rstrip("=")))]


def test_secret_spans_in_glued_and_wrapped_base64():
    code = _B64(b"x " * 30 + b"AKIA0123456789ABCD")
    for text in ("id_" + code, code[:64] + "\n" + code[64:], "a/b-" + code[:40] + "\r\n" + code[40:]):
        at = text.replace("\r", "").replace("\n", "").index(code) + code.index(code[80:]) + sum(text.count(c) for c in "\r\n")
        assert [(k, e) for k, _, e, _ in secrets.scan(text)[1] if k == "access"] == [("access", len(text))]
        assert all(at <= s for k, s, *_ in secrets.scan(text)[1] if k == "access")


def test_secret_base_spans():
    text = 'TOKEN : "abc" Secret=0123456789abcdef AKIA0123456789ABCD AKIA1 é api-key=xxxxxxxxxxxxxxxx apikey=yyyyyyyyyyyyyy deadbeefdeadbee'
    got = [(k, text[s:e]) for k, s, e in secrets.base_matches(text)]
    assert got == [("assign", "Secret=0123456789abcdef"), ("assign", "apikey=yyyyyyyyyyyyyy"), ("access", "AKIA0123456789ABCD"), ("hex", "0123456789abcdef")]
    assert secrets.scan(None) == ([], []) and secrets.scan("%41" * 3)[0] == []


def test_redaction(spark):
    d = docs(spark, "x " + SECRET + " y", "clean", None, "a " + base64.b64encode(SECRET.encode()).decode())
    got = [r["text"] for r in secrets.redact(d).orderBy("doc_id").collect()]
    assert got[0] == 'x [SECRET]" y' and got[1:3] == ["clean", None] and "[SECRET]" in got[3]
    assert secrets.scan_secrets(edge(spark)).count() == len(EDGE) + 2


def test_longest_match():
    vocab = [b" a", b"a", b"ab", b"abc", b"bcd", b"cd", b"d", b" "]
    m = wordpiece.LongestMatch(vocab)

    def greedy(w):
        n = 0
        while w:
            k = max((len(v) for v in vocab if w.startswith(v)), default=0)
            if not k:
                return None
            w, n = w[k:], n + 1
        return n

    for n in range(1, 7):
        for w in itertools.product(b" abcd", repeat=n):
            assert m.count(bytes(w)) == greedy(bytes(w)), bytes(w)


def test_token_counts_edges(spark):
    got = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in wordpiece.count_tokens(edge(spark)).collect()}
    assert got[0] == got[1] == got[2] == (0, 0) and got[8] == (30_000, 30_000) and got[None][0] == 2


TEXTS = ["", "  a  b \n\n c", "don't  'S\nx", "a b\nc d ", "\n x", "x́  y", "<|endoftext|> a"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_batch_encoder(name):
    e = tokens.BatchEncoder(name, memo=3)
    for texts in (TEXTS, TEXTS[::-1], [None]):
        ids, counts = e.encode(texts)
        want = [x.ids for x in e.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


def test_coder_round_trip():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 500):
        blocks = [rng.integers(0, 65536, n), np.zeros(2 * n, int), rng.integers(0, 4, 3 * n) * 16000, np.full(n, 65535)]
        codes = idcoder.encode_ids(blocks)
        assert all((a == b).all() for a, b in zip(blocks, idcoder.decode_ids(codes, [len(b) for b in blocks])))
    with pytest.raises(ValueError, match="65535"):
        idcoder.encode_ids([np.array([1, 70_000])])
    w = 1 / np.arange(1, 3001) ** 0.9
    w /= w.sum()
    for ids in (rng.choice(3000, idcoder.BLOCK_IDS, p=w), rng.permutation(49_000)[:3000][rng.choice(3000, idcoder.BLOCK_IDS, p=w)]):
        code = idcoder.encode_ids([ids])[0]  # close to the entropy of independent ids, though their frequencies are learned
        assert 8 * len(code) / len(ids) < 1.15 * -(w * np.log2(w)).sum()
    again = np.tile(rng.integers(0, 49_000, 64), 128)
    assert 8 * len(idcoder.encode_ids([again])[0]) / len(again) < 1
    block = idcoder.write_blocks(np.arange(10), [np.zeros(1, idcoder.PIECE)], [10])[0]
    with pytest.raises(ValueError, match="checksum"):
        idcoder.read_blocks([block[:20] + bytes([block[20] ^ 1]) + block[21:]])
    assert idcoder.crc32_join(zlib.crc32(b"ab"), zlib.crc32(b"cde"), 3) == zlib.crc32(b"abcde")


def test_chunks_are_encoded_without_offsets():
    """Only ids are asked for; to tell where they lie in the text as well takes longer."""

    class Plain:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, add_special_tokens):
            return self.tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    e, texts = tokens.BatchEncoder("byte_bpe_50k.json"), ["ein Wort und noch ein paar Wörter 漢字 \U0001f600 x", "noch ein", "", None]
    want = [e.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    e.tokenizer = Plain(e.tokenizer)
    ids, counts = e.encode(texts)
    assert ids.tolist() == sum(want, []) and counts.tolist() == [len(w) for w in want]


def test_blocks_are_coded_in_streams(monkeypatch):
    """A full block takes an eighth of its ids in steps; blocks of all sizes go together, and give what they give alone."""
    rng, steps, predict = np.random.default_rng(6), [], idcoder._Model.predict
    monkeypatch.setattr(idcoder._Model, "predict", lambda self, *a: steps.append(1) or predict(self, *a))
    sizes = [idcoder.BLOCK_IDS, 16_383, 0, 1, 2047, 2048, 4095, 4097, 8191, 12_289]
    blocks = [(rng.zipf(1.2, n) * 7 % 49_000).astype(np.uint32) for n in sizes]
    codes = idcoder.encode_ids(blocks)
    assert len(steps) <= 4095  # the one block that is too short for two streams
    assert len(idcoder.encode_ids(blocks[:1])[0]) == len(codes[0])
    steps.clear()
    got = idcoder.decode_ids(codes[:1], sizes[:1])
    assert len(steps) <= idcoder.BLOCK_IDS // 8 and (got[0] == blocks[0]).all()
    for some in (range(10), range(9, -1, -1), (4, 1)):
        got = idcoder.decode_ids([codes[i] for i in some], [sizes[i] for i in some])
        assert all((g == blocks[i]).all() for g, i in zip(got, some))
    assert idcoder.encode_ids(blocks[::-1]) == codes[::-1]
    whole = idcoder.write_blocks(blocks[0], [np.zeros(1, idcoder.PIECE)], sizes[:1])[0]
    for at in rng.integers(20, len(whole), 12):  # wherever it is damaged, also in the lengths of streams
        with pytest.raises(ValueError):
            idcoder.read_blocks([whole[:at] + bytes([whole[at] ^ 64]) + whole[at + 1 :]])
    head = idcoder._HEAD.size + idcoder.PIECE.itemsize
    with pytest.raises(ValueError):
        idcoder.read_blocks([whole[:head] + b"\xff\xff\xff\xff" + whole[head + 4 :]])


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_plain_words_go_to_the_model(name):
    """Words of Latin letters and the signs after them skip the splitting of texts, and get the same ids; no other chunk does."""
    seen = []

    class Watched:
        def __init__(self, tokenizer):
            self.encode_batch_fast = lambda texts, **k: seen.extend(texts) or tokenizer.encode_batch_fast(texts, **k)

    letters = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(192, 215), *range(216, 247), *range(248, 256)]))
    rng = random.Random(3)
    signs = [chr(i) for i in range(33, 127) if not chr(i).isalnum() and chr(i) != "'"]
    plain = [letters, "Hi", "hi", "hi,", "HI!?", "STRASSE", "Straße", "ça."] + ["".join(rng.choices(letters, k=rng.randint(1, 9)) + rng.choices(signs, k=rng.randint(0, 4))) for _ in range(500)]
    other = ["it's", "'tis", "a1", "x-y", "İx", "ʼn", "ªb", "µm", "Ω", "e\u0301", "ok…", "×", "o\u0301.", "<|endoftext|>", "x\u00a0y", "\u2028z", "q'", "'"]
    e = tokens.BatchEncoder(name, memo=100)
    texts = [" ".join(plain[i : i + 50]) for i in range(0, len(plain), 50)] + [" ".join(other), *other, " ".join(plain + other), "\n".join(plain)]
    want = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    e.tokenizer = Watched(e.tokenizer)
    for some, own in [(texts[:5], want[:5]), (texts[5:], want[5:])]:
        ids, counts = e.encode(some)
        assert counts.tolist() == list(map(len, own)) and ids.tolist() == sum(own, [])
    assert not {t.strip() for t in seen} & set(plain) and {t.strip() for t in seen} & set(other)


def test_equal_words_are_looked_up_once():
    """Word-level: whatever its case and the signs after it, a word is remembered once, over generations too."""
    e = tokens.BatchEncoder("word_bpe_49k.json", memo=4)
    rng, letters = random.Random(4), "abcxyzéßÀÿØ"
    long = "w" * 70
    many = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 6))) + rng.choice(["", ".", "?!", "'s", "\n", " "]) for _ in range(40)) for _ in range(30)]
    for texts in (["Word word, WORD! word", "", None, "it's word"], ["Ä " + long, long.upper() + ".", "word"], many, many[::-1], [], [None]):
        want = [x.ids for x in e.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        ids, counts = e.encode(texts)
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
        if texts[:1] == ["Word word, WORD! word"]:
            assert set(e.bare) == {"word", ",", "!", "", "it's"}
    assert long not in e.bare


def test_remembered_words_are_no_python_objects():
    """Word-level: words and their ids are kept side by side; in Python only their hashes and places."""
    e = tokens.BatchEncoder("word_bpe_49k.json")
    e.encode(["a"])
    text = " ".join("".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(20_000))
    tracemalloc.start()
    first = e.encode([text])[0].tolist()
    again = e.encode([text])[0].tolist() == first
    del first
    now = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert again and len(set(e.bare)) >= 20_000 and now < 1e6


@pytest.mark.parametrize("some", [1, 2, 50])
def test_words_of_equal_hashes_are_told_apart(monkeypatch, some):
    e = tokens.BatchEncoder("word_bpe_49k.json", memo=20)
    monkeypatch.setattr(tokens, "_hashes", lambda texts: np.arange(len(texts)).astype(np.uint64) % np.uint64(some))
    for texts in (TEXTS, TEXTS[::-1], ["one two, three! it's"], ["three two one's x1"], TEXTS):
        want = [x.ids for x in e.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        ids, counts = e.encode(texts)
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_codes_stay_as_they_are():
    """Files written before can be read: codes are the same bytes."""
    i = np.arange(40_000, dtype=np.int64)
    ids = (i * i % 977 * (i % 13 == 0) + i % 50 + i // 7 % 300).astype(np.uint32)
    codes = idcoder.encode_ids([ids[: idcoder.BLOCK_IDS], ids[idcoder.BLOCK_IDS : 2 * idcoder.BLOCK_IDS], ids[2 * idcoder.BLOCK_IDS :]])
    assert zlib.crc32(b"".join(codes)) == 1678610808


def test_small_blocks_take_little_memory():
    """Coding keeps frequencies of the ids that occur, not of all."""
    blocks = [np.arange(i, i + 20) for i in range(400)]
    idcoder.encode_ids(blocks[:1])
    tracemalloc.start()
    codes = idcoder.encode_ids(blocks)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6
    assert all((a == b).all() for a, b in zip(blocks, idcoder.decode_ids(codes, [20] * 400)))


def test_id_files(spark):
    texts = [None if t is None else t * 40 for t in EDGE[:8]] + ["long word " * 9_000]
    got = idfiles.decode_documents(idfiles.encode_documents(docs(spark, *texts).repartition(3), "word_bpe_49k.json")).orderBy("doc_id").collect()
    e, at = tokens.BatchEncoder("word_bpe_49k.json"), 0
    assert len(got) == len(texts)
    for r, t in zip(got, texts):
        own = np.append(e.encode([t])[0], 1).astype("<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)
    assert idfiles.decode_documents(idfiles.encode_documents(edge(spark), "word_bpe_49k.json")).count() == len(EDGE) + 2
    assert idfiles.decode_documents(idfiles.encode_documents(docs(spark, "x").where("false"), "word_bpe_49k.json")).count() == 0


def one_by_one(lengths, size):
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(free) if f >= n]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= n
        else:
            free.append(size - n)
    return sorted(free)


def test_packing_plan():
    for seed in range(150):
        rng = random.Random(seed)
        size = rng.choice([7, 16, 50])
        lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 60))]
        at = {}
        for n, lo, hi, first, each, offset in packing.plan({n: lengths.count(n) for n in lengths}, size):
            for r in range(hi - lo):
                at.setdefault(first + r // each, []).append((offset + r % each * n, n))
        for pieces in at.values():
            end = 0
            for o, n in sorted(pieces):
                assert o == end
                end += n
            assert end <= size
        assert sorted(size - sum(n for _, n in p) for p in at.values()) == one_by_one(lengths, size)


def test_packing(spark):
    got = packing.pack(edge(spark), size=256).collect()
    assert len({(r["doc_id"], r["start"]) for r in got}) == len(got) - 1  # one repeated row
    at = {}
    for r in got:
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in at.values():
        end = 0
        for o, n in sorted(pieces):
            assert o == end
            end += n
        assert end <= 256
    assert sum(r["length"] for r in got if r["doc_id"] == 8) == next(r["doc_tokens"] for r in got if r["doc_id"] == 8)
    assert packing.pack(docs(spark, "x").where("false")).count() == 0


def labelled(spark, good, bad, label):
    d = docs(spark, *good, *bad)
    rows = [(i, int((i >= len(good)) == (label == "toxic"))) for i in range(len(good) + len(bad))] + [(None, 1), (5, None)]
    return d, spark.createDataFrame(rows, f"doc_id long, {label} int")


def accuracy(df, labels, label, at):
    rows = df.join(labels.where("doc_id is not null and " + label + " is not null"), "doc_id").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    return np.mean([(r["score"] >= at) == r[label] for r in rows])


def test_quality(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("aeioustrnl") for _ in range(rng.randint(2, 8)))
    good = [" ".join(word() for _ in range(rng.randint(5, 200))) + "." for _ in range(150)]
    bad = [" ".join(word().upper() + "!!" for _ in range(rng.randint(5, 200))) for _ in range(50)]
    d, labels = labelled(spark, good, bad, "quality")
    model = quality.fit_quality(d, labels)
    score = quality.quality_score(model, F.col("text")).alias("score")
    assert accuracy(d.select("doc_id", score), labels, "quality", 0.3) > 0.95
    assert edge(spark).select(score).where("score between 0 and 1").count() == len(EDGE) + 2
    assert docs(spark, "x").select(quality.quality_score(quality.fit_quality(d, labels.where("false")), F.col("text")).alias("s")).first()["s"] == 0.5
    x, bags = quality.passage_features(["a b " * 100, "c"])
    net = quality.GatedAttention(x.shape[1])
    y = np.array([1.0, 0.0])
    grads = net.gradients(x.astype(float), bags, y)
    loss = lambda: -np.mean(y * np.log(net.scores(x, bags)) + (1 - y) * np.log(1 - net.scores(x, bags)))
    for name in ("W", "V", "U", "w", "c"):
        p = net.p[name].reshape(-1)
        before = loss()
        p[1] += 1e-5
        assert abs((loss() - before) / 1e-5 - grads[name].reshape(-1)[1]) < 1e-4
        p[1] -= 1e-5


def test_kernel():
    def slow(s, t, n, lam):
        spans = lambda x: [(tuple(x[i] for i in c), c[-1] - c[0] + 1) for c in itertools.combinations(range(len(x)), n)]
        return sum(lam ** (a + b) for u, a in spans(s) for v, b in spans(t) if u == v)

    words = ["idiot", "id1iot", "abc", "toidi", "iidioott"]
    got = toxicity.subsequence_kernel(toxicity._codes(words, 10), "idiot", 3, 0.6)
    assert np.allclose(got, [slow(w, "idiot", 3, 0.6) for w in words], rtol=1e-4)


def test_bound_of_words_loses_nothing():
    rng = random.Random(9)
    marks = ["idiot", "eszy", "moron", "aabb", "chón"]
    words = ["".join(rng.choice("abcdeiormntszyóh") for _ in range(rng.randint(1, 14))) for _ in range(9_000)]
    for m in marks:  # letters inserted and replaced
        for _ in range(300):
            w = list(m)
            for _ in range(rng.randint(0, 3)):
                w.insert(rng.randint(0, len(w)), rng.choice("abxyz1"))
            words.append("".join(w))
    fast, whole = toxicity.word_kernel(words, marks), toxicity.word_kernel(words, marks, spare=False)
    assert len(words) > 10_000 and (fast == whole).all() and (fast <= 1.0001).all() and (whole[-1500:] > 0).sum() > 700
    assert np.allclose(np.diag(toxicity.word_kernel(marks, marks)), 1, atol=1e-4)
    assert (whole[whole > 0] >= toxicity.FLOOR).all()


def test_sentences_take_their_likest_word():
    marks, texts = ["idiot", "moron"], ["an idiot. a moron! idxiot", "", None, "1i2d3i4o5t no", "i.d.i.o.t", "moron " * 3]
    x = toxicity.sentence_features(texts, marks)
    assert [len(b) for b in x] == [3, 0, 0, 1, 1, 1]
    assert np.allclose([x[0][0, 0], x[0][1, 1], x[3][0, 0], x[4][0, 0], x[5][0, 1]], 1, atol=1e-4) and 0.4 <= x[0][2, 0] < 1


def test_toxicity(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("aeioustrnl") for _ in range(rng.randint(2, 8)))
    line = lambda *more: ". ".join(" ".join([*(word() for _ in range(8)), *more]) for _ in range(3))
    d, labels = labelled(spark, [line() for _ in range(120)], [line(rng.choice(["grumbaz", "plivek"])) for _ in range(60)], "toxic")
    model = toxicity.fit_toxicity(d, labels)
    scored = toxicity.score_toxicity(d, model)
    assert accuracy(scored, labels, "toxic", 0.5) > 0.95
    odd = docs(spark, "so g r u m b a z you", "so g.r.u.m.b.a.z", "so gru-mbaz", "so grumxbaz", "so g1r2u3m4b5az", "so plivvek", "so nice")
    got = [(r["text"], r["score"] >= 0.5) for r in toxicity.score_toxicity(odd, model).orderBy("doc_id").collect()]
    assert got == [(t, t != "so nice") for t, _ in got]
    assert toxicity.score_toxicity(edge(spark), model).where("score between 0 and 1").count() == len(EDGE) + 2
    assert toxicity.score_toxicity(odd, toxicity.fit_toxicity(d, labels.where("false"))).where("score >= 0.5").count() == 0
