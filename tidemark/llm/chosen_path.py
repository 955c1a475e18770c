"""MinHash near-duplicates by a chosen-path set similarity join.

Every distinct shingle set walks down independent trees. At a node each document moves to the child of the token
that is minwise under the node's level's hash function. A node of few documents is compared exhaustively; a
larger one branches again. Candidates whose bit sketches agree too little are dropped, the others are confirmed
on the full sets. Nodes that are still large at the last level hold real near copies: there every document is
compared with the node's leader, and then only across components that the links found so far leave apart.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import bounded_batches, cut, read
from .components import components
from .shingles import bit_sketch, coefficients, digest, minhashes, shingle_sets
from .tokens import in_steps

#: Bits of a sketch; random members of a large node that are tried before all of them; sizes of a block then compared.
SKETCH, HUBS, MINORS, MEMBERS = 128, 16, 64, 512
#: Members of a large node that one task should join with what belongs to the node.
SALT_ROWS = 2_048
#: Characters that a worker splits into words at once.
STEP_CHARS = 2_000_000


def trees_for(recall: float, cents: int, depth: int) -> int:
    """Trees that find a pair at the threshold with that probability where nodes are small only at the last level:
    each level keeps a pair with its similarity, so one tree finds it with (cents / 100) ** depth."""
    kept = (cents / 100) ** depth
    return 1 if kept >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log1p(-kept)))


def _plan(trees: int, depth: int) -> int:
    return max(SKETCH, trees * depth)


def set_features(docs: DataFrame, id: str, text: str, width: int, trees: int, depth: int) -> DataFrame:
    """(id, h, n, digest, path array<int> of trees x depth min-hashes, s0, s1 sketch words); a null id stays null. h, a
    hash of the text, tells rows of one id apart."""
    count = _plan(trees, depth)

    def run(batches):
        odd, plus = coefficients(count)
        for pdf in (part for batch in batches for part in in_steps(batch, STEP_CHARS)):
            rows = []
            for i, h, s in zip(pdf["id"], pdf["h"], shingle_sets(pdf["text"], width)):
                if len(s):
                    m = minhashes(s, odd, plus)
                    a, b = bit_sketch(m[:SKETCH])
                    rows.append((i, h, len(s), digest(s), m[: trees * depth].astype(np.int32), a, b))
                else:
                    rows.append((i, h, 0, None, None, 0, 0))
            yield pd.DataFrame(rows, columns=["id", "h", "n", "digest", "path", "s0", "s1"]).astype({"id": "Int64"})

    return _rows(docs, id, text).mapInPandas(run, "id long, h long, n long, digest binary, path array<int>, s0 long, s1 long")


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    return bounded_batches(docs).select(F.col(id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))


def _agree(a: str, b: str, least: int):
    return F.bit_count(F.col(f"{a}.s0").bitwiseXOR(F.col(f"{b}.s0"))) + F.bit_count(F.col(f"{a}.s1").bitwiseXOR(F.col(f"{b}.s1"))) <= SKETCH - least


def _slack(cents: int) -> int:
    """Fewest agreeing sketch bits that pass: five deviations below what sets at the threshold have."""
    p = (1 + cents / 100) / 2
    return math.floor(SKETCH * p - 5 * math.sqrt(SKETCH * p * (1 - p)))


def candidates(sets: DataFrame, cents: int, trees: int, depth: int, leaf: int) -> tuple[DataFrame, DataFrame | None]:
    """Pairs (a, b), a < b, of node mates with like sketches, and the members (node, id, s0, s1) of nodes left large."""
    least, pairs, rest = _slack(cents), None, None
    level = sets.select("id", "path", "s0", "s1", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    level = level.select("id", "s0", "s1", F.xxhash64("tree", F.lit(0)).alias("node"), F.slice("path", F.col("tree") * depth + 1, depth).alias("path"))
    for d in range(depth):
        # the rest of the path alone goes on
        here = level.withColumn("node", F.xxhash64("node", F.col("path")[0])).withColumn("path", F.slice("path", 2, depth))
        stats = here.groupBy("node").agg(F.count("*").alias("size"), F.min("id").alias("leader")).where("size > 1")
        here = cut(here.join(stats, "node"), "level")
        few = here.where(F.col("size") <= leaf).select("node", "id", "s0", "s1")
        found = few.alias("x").join(few.alias("y"), (F.col("x.node") == F.col("y.node")) & (F.col("x.id") < F.col("y.id")) & _agree("x", "y", least))
        found = found.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        level = here.where(F.col("size") > leaf)
        # the leader's row is one per node, so this star has at most one row per member
        heads = level.where("id = leader").select("node", "id", "s0", "s1")
        star = heads.alias("x").join(level.where("id != leader").alias("y"), (F.col("x.node") == F.col("y.node")) & _agree("x", "y", least))
        found = found.union(star.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))
        pairs = found if pairs is None else pairs.union(found)
        rest = level.select("node", "id", "s0", "s1", "size")
        level = level.drop("size", "leader")
        if level.isEmpty():
            return pairs, None
    return pairs, rest


def full_sets(docs: DataFrame, used: DataFrame, id: str, text: str, width: int) -> DataFrame:
    """(id, items): the full sets, sorted hashes, of the sets in used(id, doc, h, digest): of each a row that has it."""

    def run(batches):
        for pdf in (part for batch in batches for part in in_steps(batch, STEP_CHARS)):
            keep = [(i, s.view(np.int64)) for i, g, s in zip(pdf["id"], pdf["digest"], shingle_sets(pdf["text"], width)) if digest(s) == bytes(g)]
            yield pd.DataFrame(keep, columns=["id", "items"])

    texts = _rows(docs, id, text).select(F.col("id").alias("_doc"), F.col("h").alias("_h"), "text")
    src = texts.join(used, (F.col("_h") == F.col("h")) & F.col("_doc").eqNullSafe(F.col("doc"))).select("id", "digest", "text")
    # rows that repeat an id and its text give the same set; one of them is enough
    return cut(src.mapInPandas(run, "id long, items array<long>"), "sets").dropDuplicates(["id"])


def confirm(docs: DataFrame, pairs: DataFrame, id: str, text: str, width: int, cents: int, wanted: DataFrame) -> DataFrame:
    """The pairs whose full sets reach 100 * intersection >= cents * union. wanted: (id, doc, h, digest) of all sets."""
    used = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct().join(wanted, "id")
    sets = full_sets(docs, used, id, text, width)
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")
    meet = F.size(F.array_intersect("x", "y"))
    return both.where(100 * meet >= cents * (F.size("x") + F.size("y") - meet)).select("a", "b")


def _salts(size):
    return F.ceil(F.col(size) / SALT_ROWS).cast("int")


def _salted(rows: DataFrame, per_node: DataFrame) -> DataFrame:
    """rows(node, id, size) joined with what each node has, the members of a large node dealt over several tasks."""
    left = rows.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(3)), _salts("size")).cast("int"))
    right = per_node.withColumn("salt", F.explode(F.sequence(F.lit(0), _salts("size") - 1))).drop("size")
    return left.join(right, ["node", "salt"]).drop("salt")


def _apart(rest: DataFrame, known: DataFrame) -> DataFrame:
    """Members of nodes that known components leave in several parts: minor tells those outside the largest part."""
    apart = rest.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    sizes = apart.groupBy("node", "component").agg(F.count("*").alias("n"))
    top = F.max(F.struct("n", -F.col("component")))
    main = sizes.groupBy("node").agg((-top["col2"]).alias("main"), F.sum("n").alias("size"), F.count("*").alias("k"), (F.sum("n") - top["n"]).alias("minors"))
    apart = _salted(apart, main.where("k > 1").drop("k"))
    return cut(apart.withColumn("minor", F.col("component") != F.col("main")).drop("main"), "apart")


def _with_hubs(apart: DataFrame, cents: int, hubs: int) -> DataFrame:
    """Pairs (a, b) of each document outside its node's largest part with about `hubs` random members."""
    other = apart.where(F.pmod(F.xxhash64("id", "node"), F.col("size")) < hubs)
    other = other.select("node", "size", *[F.col(c).alias(f"_{c}") for c in ("id", "component", "s0", "s1")])
    near = F.bit_count(F.col("s0").bitwiseXOR(F.col("_s0"))) + F.bit_count(F.col("s1").bitwiseXOR(F.col("_s1"))) <= SKETCH - _slack(cents)
    pairs = _salted(apart.where("minor"), other).where((F.col("component") != F.col("_component")) & near)
    return pairs.select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b")).distinct()


def _joined(links: DataFrame, known: DataFrame) -> DataFrame:
    """known components (id, component) with what further links between their members join: only the components are
    linked anew, which are far fewer than the members."""
    for end in ("a", "b"):
        links = links.join(known.select(F.col("id").alias(end), "component"), end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    more = components(links)
    inside = known.join(more.select(F.col("id").alias("component"), F.col("component").alias("now")), "component", "left")
    inside = inside.select("id", F.coalesce("now", "component").alias("component"))
    # documents that no link reached before
    return cut(inside.union(more.join(known, "id", "left_anti").select("id", "component")), "components")


def _across(docs: DataFrame, apart: DataFrame, id: str, text: str, width: int, cents: int, wanted: DataFrame) -> DataFrame:
    """Links (a, b) between the parts of a node, one at least of any two parts that link: every document outside the
    largest part is compared with every member of another part, in blocks, and no pair but a link is written."""
    sets = full_sets(docs, apart.select("id").distinct().join(wanted, "id"), id, text, width)
    rows = apart.join(sets, "id").withColumns({"blocks": F.ceil(F.col("minors") / MINORS).cast("int"), "chunks": F.ceil(F.col("size") / MEMBERS).cast("int")})
    deal = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")
    keep = ["node", "block", "chunk", "first", "id", "component", "s0", "s1", "items"]
    left = rows.where("minor").withColumns({"block": deal("blocks", 1), "first": F.lit(True)}).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    right = rows.withColumns({"chunk": deal("chunks", 2), "first": F.lit(False)}).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    least = _slack(cents)

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf[pdf["first"]], pdf[~pdf["first"]]
        comp, ids, items = y["component"].to_numpy(), y["id"].to_numpy(), y["items"].to_list()
        size = np.array([len(i) for i in items])
        s0, s1 = (y[c].to_numpy().view(np.uint64) for c in ("s0", "s1"))
        out, known = [], set()
        for i, c, a0, a1, a in zip(x["id"], x["component"], x["s0"].to_numpy().view(np.uint64), x["s1"].to_numpy().view(np.uint64), x["items"]):
            near = np.flatnonzero((comp != c) & (np.bitwise_count(s0 ^ a0).astype(int) + np.bitwise_count(s1 ^ a1) <= SKETCH - least))
            if not len(near):
                continue
            # hashes are sorted as unsigned numbers; any one order will do for the search
            a = np.sort(a)
            flat = np.concatenate([items[k] for k in near])
            met = a[np.minimum(np.searchsorted(a, flat), len(a) - 1)] == flat
            meet = np.add.reduceat(met, np.cumsum(size[near]) - size[near], dtype=np.int64)
            for k in near[100 * meet >= cents * (len(a) + size[near] - meet)]:
                if (c, comp[k]) not in known:
                    known.add((c, comp[k]))
                    out.append((min(i, ids[k]), max(i, ids[k])))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return left.select(keep).union(right.select(keep)).groupBy("node", "block", "chunk").applyInPandas(links, "a long, b long").distinct()


def set_components(docs: DataFrame, id: str, text: str, width: int, cents: int, trees: int, depth: int, leaf: int) -> DataFrame:
    """One row per document: (id, h, n, component), a number of its component, null without words.

    Sets are numbered and searched by number, so rows that repeat an id, with equal or other texts, or lack one take
    part like all others. Equal sets are one."""
    feats = cut(set_features(docs, id, text, width, trees, depth), "features")
    full = feats.where("n > 0")
    # all columns but doc and h follow from the set, so any copy's values will do; of rows with an id the least is meant
    first = full.groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("doc"), "h")).alias("f"))
    alike = full.join(first.select("digest", "f.doc", F.col("f.h").alias("_h")), "digest").where(F.col("id").eqNullSafe(F.col("doc")) & (F.col("h") == F.col("_h")))
    alike = alike.dropDuplicates(["digest"]).select(F.monotonically_increasing_id().alias("id"), "doc", "h", "digest", "path", "s0", "s1")
    sets = cut(alike, "distinct")
    pairs, rest = candidates(sets.select("id", "path", "s0", "s1"), cents, trees, depth, leaf)
    wanted = sets.select("id", "doc", "h", "digest")
    known = cut(components(confirm(docs, cut(pairs.distinct(), "pairs"), id, text, width, cents, wanted)), "components")
    if rest is not None:
        rest = cut(rest.distinct(), "rest")
        # a few random members of each node first, so that the pass over all members has few documents left
        pairs = cut(_with_hubs(_apart(rest, known), cents, HUBS), "hubs")
        known = _joined(confirm(docs, pairs, id, text, width, cents, wanted), known)
        known = _joined(_across(docs, _apart(rest, known), id, text, width, cents, wanted), known)
    named = sets.select("digest", "id").join(known, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    return feats.select("id", "h", "n", "digest").join(named, "digest", "left").select("id", "h", "n", "component")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, cents: int = 80, trees: int | None = None, depth: int = 4, leaf: int = 32, recall: float = 0.999) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id that links reach), kept (id = component_id).

    Two documents link when 100 * |intersection| >= cents * |union| of their shingle sets. Equal sets are joined
    first and searched once. Documents without words link with nothing. Rows that repeat an id are documents of their
    own that share it. A document without an id takes the smallest id of its component (null if it has none), and is
    kept only if there is none. An empty table gives an empty result. Unless given, trees are as many as find a pair
    at the threshold with probability `recall` down to the last level.
    """
    found = cut(set_components(docs, id, text, width, cents, trees or trees_for(recall, cents, depth), depth, leaf), "found")
    least = found.where("component is not null").groupBy("component").agg(F.min("id").alias("least"))
    comp = F.coalesce("least", "id")
    kept = F.coalesce(F.col("id") == comp, comp.isNull())
    return found.join(least, "component", "left").select(F.col("id").alias(id), F.col("n").alias("n_shingles"), comp.alias("component_id"), kept.alias("kept"))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, cents: int = 80, depth: int = 4, leaf: int = 32, recall: float = 0.999) -> DataFrame:
    """docs with one row of each near-duplicate component: that of the smallest id, rows without one last; of rows that
    repeat an id and its text one. Documents without words stay, each of them."""
    found = cut(set_components(docs, id, text, width, cents, trees_for(recall, cents, depth), depth, leaf), "found").where("component is not null")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    first = found.groupBy("component").agg(F.min(order).alias("f")).select("component", F.col("f.id").alias("_id"), F.col("f.h").alias("_h"))
    rows = found.groupBy("component", "id", "h").agg(F.count("*").alias("n")).join(first, "component")
    rows = cut(rows.select(F.col("id").alias("_doc"), F.col("h").alias("_text"), "n", (F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))).alias("first")), "rows")
    same = lambda d: F.col(id).cast("long").eqNullSafe(d["_doc"]) & (F.xxhash64(F.col(text)) == d["_text"])
    gone = rows.where("not first")
    out = docs.join(gone, same(gone), "left_anti")
    again = rows.where("first and n > 1")
    if again.isEmpty():
        return out
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    repeated = out.join(again, same(again), "left_semi").select(F.col(id).alias("_doc"), F.xxhash64(F.col(text)).alias("_text"), whole).groupBy("_doc", "_text").agg(F.first("row").alias("row"))
    return out.join(again, same(again), "left_anti").unionByName(repeated.select("row.*"))


def op10_chosen_path(spark, sf_dir):
    """Near-duplicate components of all documents on two-word shingles at 0.8."""
    return near_duplicates(read(spark, sf_dir, "documents"), width=2, cents=80)


OP10_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN [w[1]]
             ELSE list_distinct([w[i] || ' ' || w[i + 1] for i in generate_series(1, len(w) - 1)]) END AS s FROM w),
t AS (SELECT min(doc_id) AS id, s, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
e AS (SELECT id, n, unnest(s) AS x FROM t),
rare AS (SELECT x, count(*) AS f FROM e GROUP BY x),
-- a pair at 0.8 shares one of the n // 5 + 1 rarest shingles of either set
p AS (SELECT id, n, x FROM (SELECT e.id, e.n, e.x, row_number() OVER (PARTITION BY e.id ORDER BY f, e.x) AS r FROM e JOIN rare USING (x)) WHERE r <= n // 5 + 1),
c AS (SELECT DISTINCT a.id AS a, b.id AS b FROM p a JOIN p b ON a.x = b.x AND a.id < b.id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80),
l AS (SELECT a, b FROM (SELECT c.a, c.b, len(list_intersect(ta.s, tb.s)) AS i, ta.n + tb.n AS n FROM c JOIN t ta ON ta.id = c.a JOIN t tb ON tb.id = c.b) WHERE 100 * i >= 80 * (n - i)),
g AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (WITH RECURSIVE reach(id, to_id) AS (SELECT id, id FROM t UNION SELECT reach.id, g.b FROM reach JOIN g ON g.a = reach.to_id)
      SELECT id, min(to_id) AS component FROM reach GROUP BY id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(r.component, s.doc_id) AS component_id, s.doc_id = coalesce(r.component, s.doc_id) AS kept
FROM s LEFT JOIN t ON t.s = s.s LEFT JOIN r ON r.id = t.id
"""
