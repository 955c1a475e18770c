"""URL filter and prefix trie against brute force and on edge cases."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

from tidemark.llm import prefix_trie, urlfilter
from tidemark.llm.radix import RadixTree, _Full, _Indexed

PAGE = "page_id long, url string, id string, rid long, gram string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", 7, "y") for i, u in enumerate(urls)], PAGE)


def test_rules(spark):
    cases = {
        "https://a.example.org/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"), "http://Example.ORG/en/12?q": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"), "x://myexample.org/es/": ("myexample.org", "/es/", "org/", "allow"),
        "http://org/": ("org", "/", "org/", "allow"), "http://a.com/fr/x#y/de/": ("a.com", "/fr/x", "com/fr/", "allow"), "http://a.com/de/": ("a.com", "/de/", "com/de/", "block"),
        "http://a.org": ("a.org", "", None, None), "a.org/x": ("", "", None, None), "": ("", "", None, None), None: ("", "", None, None), "http://a.com?/fr/": ("a.com", "", None, None),
        "http://a.net/://b.org/": ("a.net", "/://b.org/", None, None), "http://xorg/": ("xorg", "/", None, None),
    }
    got = {r["page_id"]: r for r in urlfilter.judge_urls(pages(spark, list(cases))).collect()}
    assert len(got) == len(cases)
    for i, (host, path, rule, verdict) in enumerate(cases.values()):
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
        assert (r["score"] is None) == (rule is not None)


def test_edges(spark):
    assert urlfilter.judge_urls(pages(spark, [])).count() == 0
    none = urlfilter.judge_urls(pages(spark, [None, "http://a.net/", "http://a.net/"])).collect()
    assert [(r["verdict"], r["score"]) for r in none] == [("allow", 0.0)] * 3
    long = "http://a.net/" + "ü" * 50_000
    assert urlfilter.judge_urls(pages(spark, [long])).first()["path"] == "/" + "ü" * 50_000


def brute_ratio(ruled, gram):
    out = 0.0
    for verdict, sign in (("allow", 1), ("block", -1)):
        seen = Counter(g for u, v in ruled if v == verdict for g in brute_grams(u))
        p = 1 / urlfilter.SYMBOLS
        for k in range(urlfilter.ORDER + 1):
            key = gram[urlfilter.ORDER - k :]
            after = Counter()
            for g, n in seen.items():
                if g[urlfilter.ORDER - k : urlfilter.ORDER] == key[:k]:
                    after[g[-1]] += n
            n, t = sum(after.values()), len(after)
            p = (after[key[-1]] + t * p) / (n + t) if n else p
        out += sign * math.log(p)
    return out


def brute_grams(url):
    text = "\2" * urlfilter.ORDER + "".join(c.lower() if "!" <= c <= "~" else "\x7f" for c in url or "") + "\3"
    return [text[i : i + urlfilter.ORDER + 1] for i in range(len(text) - urlfilter.ORDER)]


def test_models_against_brute_force(spark):
    ruled = [("http://good.org/abc", "allow"), ("http://good.org/abd", "allow"), ("http://bad.com/zzé", "block"), ("http://bad.com/zz", "block")]
    new = ["http://good.net/abc", "http://bad.net/zzz", "q"]
    counts = urlfilter.count_grams(spark.createDataFrame(ruled, "url string, verdict string"))
    grams = sorted({g for u in new for g in brute_grams(u)})
    wanted = spark.createDataFrame([(g,) for g in grams], "gram string")
    for most in (200_000, 0):  # broadcast, and by shuffle
        got = {r["gram"]: r["micro"] for r in urlfilter.log_ratios(counts, wanted, most).collect()}
        assert set(got) == set(grams) and all(abs(got[g] - 1e6 * brute_ratio(ruled, g)) <= 1 for g in grams)
    ratios = spark.createDataFrame(list(got.items()), "gram string, micro long")
    urls = spark.createDataFrame(list(enumerate(new)), "rid long, url string")
    for most in (200_000, 0):
        mean = {r["rid"]: r["micro"] for r in urlfilter.scores(urls, ratios, most).collect()}
        assert mean == {i: sum(got[g] for g in brute_grams(u)) // len(brute_grams(u)) for i, u in enumerate(new)}
    assert mean[0] > 0 > mean[1]


def test_threshold(spark):
    known = lambda rows: spark.createDataFrame(rows, "verdict string, micro long")
    assert urlfilter.calibrated(known([("allow", 5_000), ("allow", 7_500), ("block", 3_900)])) == 5
    assert urlfilter.calibrated(known([("allow", 5_000), ("block", -3_900)])) == 0
    assert urlfilter.calibrated(known([("allow", 5_000)])) == 0 and urlfilter.calibrated(known([])) == 0


def test_radix_tree_layouts():
    rng = random.Random(3)
    keys = [bytes([rng.randrange(256), rng.randrange(40), rng.randrange(9)]) for _ in range(6_000)] + [b"", b"\0", b"\0\1"]
    tree, want = RadixTree(), defaultdict(list)
    for i, k in enumerate(keys):
        tree.insert(k, i)
        want[k].append(i)
    paths, got, kinds = {-1: b""}, {}, set()
    for at, (node, up) in enumerate(tree.walk()):
        paths[at] = paths[up] + node.path
        kinds.add((type(node.children), getattr(node.children, "room", 0)))
        if node.values:
            got[paths[at]] = node.values
    assert got == want and list(got) == sorted(want) and {t for t, _ in kinds} >= {_Full, _Indexed} and {r for _, r in kinds} >= {4, 16}


def brute_trie(rows, most=5):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tid = len(text).to_bytes(4, "big") + hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[c].append(((turn is not None, turn or 0), tid, role, text))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    new = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        new[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in new.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(who) - 1) * len(p[-1][1]) if p else 0
    digest = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return sorted((min(who), len(p), min(members[p[:-1]]) if p else -1, len(who), kids[p], leaves[p], saved[p], digest(p)) for p, who in members.items())


def test_trie_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for c in [*range(95, 130), 200, 201, 303, 1000, 1001]:
        for turn in rng.sample(range(40), rng.choice([1, 2, 3, 9, 30])):
            rows.append((c, turn if turn else None, rng.choice(["user", None, ""]), rng.choice(["a", "bé😀", "", None])))
    rows += [(c, t, "user", f"same {t}") for c in range(400, 460) for t in range(25)]  # copies, longer than a segment
    rows += [(107, 3, "user", "a"), (107, 3, "user", "a"), (None, 1, "user", "a"), (None, None, None, None)]
    df = spark.createDataFrame([(*r, 1, b"k", 2) for r in rows], "conv_id long, turn long, role string, text string, pos long, key binary, seg long").repartition(5)
    each, turns = prefix_trie.rebuilt(prefix_trie.numbered_turns(df))
    for size, held in ((4, 7), (256, 50_000)):
        got = sorted(tuple(-1 if v is None else v for v in r) for r in prefix_trie.prefix_nodes(each, turns, size, held).collect())
        assert got == brute_trie(rows)


def test_trie_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    run = lambda rows: prefix_trie.prefix_nodes(*prefix_trie.rebuilt(prefix_trie.numbered_turns(spark.createDataFrame(rows, schema)))).collect()
    assert run([]) == [] and run([(None, 1, "user", "a")]) == []
    alone = next(c for c in range(100, 200) if c % 100 and zlib.crc32(str(c).encode()) % 6)
    (root,) = run([(alone, None, None, None)])  # its turn lies within the first h, and the seed is absent
    assert root["depth"] == 0 and root["n_convs"] == 1 and root["n_leaves"] == 1 and root["ends_sha256"] == hashlib.sha256(str(alone).encode()).hexdigest()


def test_long_lists_of_ids(spark):
    ends = spark.range(0, 60_000).selectExpr("cast('n' as binary) AS node", "id AS conv_id").union(spark.sql("SELECT cast('m' as binary), 5L")).repartition(7)
    got = {bytes(r["node"]): r["ends_sha256"] for r in prefix_trie.list_digests(ends).collect()}
    assert got == {b"n": hashlib.sha256(",".join(map(str, range(60_000))).encode()).hexdigest(), b"m": hashlib.sha256(b"5").hexdigest()}
