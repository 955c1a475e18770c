"""The trie of conversation prefixes, from adaptive radix trees over fixed-width turn ids.

A turn's id has 20 bytes: the code points of its text, big-endian, and 16 bytes of a SHA-256 of role and text. A
conversation is the sequence of its turns' ids, cut into segments of SEGMENT turns. Each task puts its segments
into radix trees, one for each sequence of turns before the segment, and gives what it has counted of every node at
a whole number of turns; compressed paths give the nodes that lie inside them. Counts of the same node are then
added up over tasks, so a beginning that many conversations share is one row a tree, however many they are.
Sums over subtrees take as many rounds as the depth has binary digits: in each, nodes pass what they have gathered
to the node twice as far above them.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._base import bounded_batches, cut, read

#: Bytes of a turn's id; turns of a segment; segments that a task holds in trees at once.
WIDTH, SEGMENT, HELD = 20, 256, 50_000
ROOT = bytes(16)
#: Most characters of a piece of a list of ids.
PIECE = 1 << 16


def turn_id(role: Column, text: Column) -> Column:
    """The fixed-width id of a turn; null role or text counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.concat(F.lpad(F.hex(F.length(text).cast("long")), 8, "0"), F.substring(F.sha2(named, 256), 1, 32)))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, tid): turns counted from 1 in the order of `turn` (null first, ties by id of the turn).

    Rows are dealt out by ranges of that order, and only conversations that a range ends in take the counts of earlier
    ranges, so no conversation has to fit one task. Rows without a conv_id belong to none."""
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_id(F.col("role"), F.col("text")).alias("tid"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("tid")]
    rows = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "tid", F.monotonically_increasing_id().alias("row")), "turns")
    rows = rows.withColumn("part", F.shiftright("row", 33))
    lengths = rows.groupBy("conv_id", "part").count()
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    cuts = lengths.withColumn("before", F.sum("count").over(earlier)).where("before is not null").select("conv_id", "part", "before")
    first = F.min("row").over(Window.partitionBy("conv_id", "part"))
    # a range's lower end cuts one conversation at most, so there are fewer cuts than ranges
    placed = rows.withColumn("first", first).join(F.broadcast(cuts), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("row") - F.col("first") + 1 + F.coalesce("before", F.lit(0))).alias("pos"), "tid")


def rebuilt(turns: DataFrame, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """(conversations(conv_id), turns(conv_id, pos, tid)): conversation c takes the first h turns of conversation
    c - c % 100 (as many as it has), h = crc32(c) % (most + 1), and goes on with its own turns after its first h."""
    turns = cut(turns, "numbered")
    heads = turns.where((F.col("conv_id") % 100 == 0) & (F.col("pos") <= most)).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "tid")))["tid"].alias("head"))
    each = turns.select("conv_id").distinct().withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int"))
    each = each.join(heads.select(F.col("conv_id").alias("_seed"), "head"), F.col("conv_id") - F.col("conv_id") % 100 == F.col("_seed"), "left")
    each = cut(each.select("conv_id", "h", F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast("array<binary>")).alias("head")), "heads")
    first = each.select("conv_id", F.posexplode("head").alias("at", "tid")).select("conv_id", (F.col("at") + 1).cast("long").alias("pos"), "tid")
    own = turns.join(each.select("conv_id", "h", F.size("head").alias("k")), "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "tid")
    return each.select("conv_id"), first.unionByName(own)


def segments(turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(conv_id, before, key, seg): the ids of `size` turns in a row, and the node that the turns before them end at.

    That node is a digest chained over a conversation's segments; only conversations of more than one take part."""
    seg = F.floor((F.col("pos") - 1) / size).cast("long").alias("seg")
    ids = F.transform(F.sort_array(F.collect_list(F.struct("pos", "tid"))), lambda t: F.hex(t["tid"]))
    segs = cut(turns.groupBy("conv_id", seg).agg(F.unhex(F.array_join(ids, "")).alias("key")), "segments")
    long = segs.where("seg > 0").select("conv_id").distinct()
    chain = segs.join(long, "conv_id", "left_semi").select("conv_id", "seg", F.unhex(F.sha2("key", 256)).alias("digest"))

    def run(batches):
        now, node = None, ROOT
        for pdf in batches:
            out = []
            for conv, seg, digest in zip(pdf["conv_id"].tolist(), pdf["seg"].tolist(), pdf["digest"]):
                if conv != now:
                    now, node = conv, ROOT
                out.append((conv, seg, node))
                node = _node(node, digest)
            yield pd.DataFrame(out, columns=["conv_id", "seg", "before"])

    told = chain.repartition("conv_id").sortWithinPartitions("conv_id", "seg").mapInPandas(run, "conv_id long, seg long, before binary")
    return segs.join(told.where("seg > 0"), ["conv_id", "seg"], "left").select("conv_id", F.coalesce("before", F.lit(ROOT)).alias("before"), "key", "seg")


def _node(before: bytes, digest: bytes) -> bytes:
    """The id of the node that is reached from `before` by turns whose ids have that SHA-256."""
    return hashlib.sha256(before + digest).digest()[:16]


def _grown(tree, before: bytes, depth: int):
    """Rows of one radix tree: its trie nodes (node, parent, depth, points, n, conv_id, ends=False), and the
    conversations that end at them (ends=True). Only depths of whole turns are nodes."""
    walk = tree.walk()
    n, least = [len(node.values) for node, _ in walk], [min((v[0] for v in node.values), default=None) for node, _ in walk]
    for at in range(len(walk) - 1, 0, -1):  # children stand behind their parents
        up = walk[at][1]
        n[up] += n[at]
        least[up] = least[at] if least[up] is None else min(least[up], least[at])
    state = [None] * len(walk)  # of each node: hash of its whole turns, the last trie node, its depth, bytes beyond
    state[0] = (hashlib.sha256(), before, depth, b"")
    for at, (node, up) in enumerate(walk):
        if at:
            h, above, deep, left = state[up]
            raw = left + node.path
            h = h.copy()
            for i in range(0, len(raw) - WIDTH + 1, WIDTH):
                turn = raw[i : i + WIDTH]
                h.update(turn)
                here = _node(before, h.digest())
                deep += 1
                yield here, above, deep, int.from_bytes(turn[:4], "big"), n[at], least[at], False
                above = here
            state[at] = (h, above, deep, raw[len(raw) // WIDTH * WIDTH :])
        for conv, last in node.values:
            if last:
                yield state[at][1], None, None, None, None, conv, True


_COUNTED = "node binary, parent binary, depth long, points long, n long, conv_id long, ends boolean"


def counted(segs: DataFrame, size: int = SEGMENT, held: int = HELD) -> DataFrame:
    """What each task has counted of the nodes of its segments, and where conversations end."""
    from .radix import RadixTree

    def run(batches):
        trees, n = {}, 0

        def rows():
            names = [c.split(" ")[0] for c in _COUNTED.split(", ")]
            out = []
            for (before, depth), tree in trees.items():
                for row in _grown(tree, before, depth):
                    out.append(row)
                    if len(out) == 20_000:
                        yield frame(out, names)
                        out = []
            yield frame(out, names)

        def frame(out, names):
            return pd.DataFrame(out, columns=names).astype({c: "Int64" for c in ("depth", "points", "n")})

        for pdf in batches:
            for conv, before, key, seg, last in zip(pdf["conv_id"].tolist(), pdf["before"], pdf["key"], pdf["seg"].tolist(), pdf["last"].tolist()):
                tree = trees.setdefault((bytes(before), seg * size), RadixTree())
                tree.insert(bytes(key), (conv, last))
                n += 1
            if n >= held:
                yield from rows()
                trees, n = {}, 0
        yield from rows()

    return bounded_batches(segs).mapInPandas(run, _COUNTED)


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(node, values): the values of nodes(node, parent, depth, values) summed over each subtree, its top included."""
    now = cut(nodes.select("node", F.col("parent").alias("up"), *values), "sums")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        given = now.where("up is not null").groupBy("up").agg(*[F.sum(v).alias(f"_{v}") for v in values])
        above = now.where("up is not null").select(F.col("node").alias("up"), F.col("up").alias("_up"))
        moved = now.join(above, "up", "left").select("node", F.col("_up").alias("up"), *values)
        moved = moved.join(given.withColumnRenamed("up", "node"), "node", "left")
        now = cut(moved.select("node", "up", *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values]), "sums")
    return now.select("node", *values)


def list_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of ends(node, conv_id): SHA-256 of the ids in ascending order, comma-joined.

    Pieces of the list are made side by side from ranges of (node, conv_id); one pass then hashes the pieces of each
    node as they come, so no list is held, however long."""

    def pieces(batches):
        now, first, text, size = None, None, [], 0
        for pdf in batches:
            out = []
            for node, conv in zip(pdf["node"], pdf["conv_id"].tolist()):
                if node != now or size > PIECE:
                    if now is not None:
                        out.append((now, first, ",".join(text)))
                    now, first, text, size = node, conv, [], 0
                text.append(str(conv))
                size += len(text[-1]) + 1
            yield pd.DataFrame(out, columns=["node", "first", "ids"])
        if now is not None:
            yield pd.DataFrame([(now, first, ",".join(text))], columns=["node", "first", "ids"])

    def hashed(batches):
        now, h = None, None
        for pdf in batches:
            out = []
            for node, ids in zip(pdf["node"], pdf["ids"].tolist()):
                if node != now:
                    if now is not None:
                        out.append((now, h.hexdigest()))
                    now, h = node, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["node", "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(now, h.hexdigest())], columns=["node", "ends_sha256"])

    made = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInPandas(pieces, "node binary, first long, ids string")
    return made.repartition("node").sortWithinPartitions("node", "first").mapInPandas(hashed, "node binary, ends_sha256 string")


def prefix_nodes(conversations: DataFrame, turns: DataFrame, size: int = SEGMENT, held: int = HELD) -> DataFrame:
    """One row per node of the trie of turns(conv_id, pos, tid): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256. conversations(conv_id), each id once, may hold
    conversations without turns: they are members of the root alone. No conversations give no nodes."""
    segs = segments(turns, size)
    last = segs.groupBy("conv_id").agg(F.max("seg").alias("_last"))
    segs = segs.join(last, "conv_id").select("conv_id", "before", "key", "seg", (F.col("seg") == F.col("_last")).alias("last"))
    found = cut(counted(segs, size, held), "counted")
    nodes = found.where("not ends").groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("points").alias("points"), F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    root = conversations.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("points"), "n_convs", "conv_id")
    nodes = cut(nodes.select(*root.columns).unionByName(root), "nodes")
    kids = nodes.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "node")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = cut(nodes.join(parents, "parent", "left").withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("points")}), "nodes")
    sums = subtree_sums(nodes, ["n_leaves", "saved_tokens"])
    ending = found.where("ends").select("node", "conv_id")
    turnless = conversations.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").select(F.lit(ROOT).alias("node"), "conv_id")
    out = nodes.drop("n_leaves", "saved_tokens").join(sums, "node").join(list_digests(ending.unionByName(turnless)), "node", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def op12_prefix_trie(spark, sf_dir):
    """The prefix trie of all rebuilt conversations."""
    each, turns = rebuilt(numbered_turns(read(spark, sf_dir, "conversations")))
    return prefix_nodes(each, turns)


OP12_SQL = r"""
WITH t AS (SELECT conv_id, turn, printf('%08x', length(coalesce(text, ''))) || substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS tid
           FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(tid ORDER BY turn NULLS FIRST, tid) AS own FROM t GROUP BY conv_id),
c AS (SELECT *, conv_id - conv_id % 100 AS seed,
             -- crc32 bit by bit
             (xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, z: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295) % 6)::INTEGER AS h FROM o),
r AS (SELECT c.conv_id, array_to_string(list_concat(coalesce(s.own[1:c.h], []), c.own[c.h + 1:]), '') AS path FROM c LEFT JOIN o s ON s.conv_id = c.seed),
p AS (SELECT conv_id, length(path) // 40 AS len, d, substr(path, 1, 40 * d) AS key FROM (SELECT *, unnest(range(0, length(path) // 40 + 1)) AS d FROM r)),
n AS MATERIALIZED (SELECT key, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d > 0 THEN (count(*) - 1) * ('0x' || substr(key, 40 * d - 39, 8))::BIGINT ELSE 0 END AS saved,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len = d), '') AS ends FROM p GROUP BY key, d),
k AS (SELECT substr(key, 1, 40 * (depth - 1)) AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
a AS MATERIALIZED (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (key)),
s AS (SELECT substr(key, 1, 40 * up) AS key, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM a) GROUP BY 1)
SELECT a.conv_id, a.depth, b.conv_id AS parent_conv_id, a.n_convs, a.n_children, n_leaves, saved_tokens, sha256(a.ends) AS ends_sha256
FROM a JOIN s USING (key) LEFT JOIN a b ON a.depth > 0 AND b.key = substr(a.key, 1, 40 * (a.depth - 1))
"""
