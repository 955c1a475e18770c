"""Phrase collocations: frequent phrases counted in quotient filters, and how much more often they occur than chance.

Words are counted first; those that are frequent enough get dense ids. Texts become arrays of ids, with 0 where a
piece ends or a word is too rare for any phrase. Then phrases of 2, 3, .. words are counted level by level: each task
counts in filters of bounded size, which are dealt out by the highest bits of the permuted n-grams and merged.
A phrase can only be frequent if both phrases of one word less in it are; as long as the frequent phrases of a level
fit `PRUNE_BYTES`, workers look those up and don't count the others.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._base import BROADCAST_ROWS, bounded_batches, cut, kept, read, small
from .quotient import Lookup, Packing, merged, read_filter, write_filter

#: Most frequent words that workers get as a dictionary (more are joined), and bytes of a lookup of frequent phrases.
VOCABULARY_ROWS, PRUNE_BYTES = 300_000, 64 << 20
#: Entries that a task gathers before it merges them, and that its filter may have before it is sent on.
GATHER, HELD = 1 << 19, 1 << 20
#: Counted words of a shard of the filters; distinct words that a task holds; words of a block that are joined.
SHARD_WORDS, HELD_WORDS, BLOCK = 1 << 22, 200_000, 2_048
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz..........")


def words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8, A-Z lower-cased, with b'.' where a piece ends."""
    return (text or "").encode().translate(_LOWER).replace(b".", b" . ").split()


def _texts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return bounded_batches(docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text")))


def word_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, word, a): occurrences of each word; a null lang is `und`. Counted in tasks first."""

    def run(batches):
        seen: dict[str, Counter] = {}

        def rows():
            yield pd.DataFrame([(k, w.decode(), n) for k, c in seen.items() for w, n in c.items()], columns=["lang", "word", "a"])

        for pdf in batches:
            for k, t in zip(pdf["lang"], pdf["text"]):
                seen.setdefault(k, Counter()).update(words(t))
            for c in seen.values():
                c.pop(b".", None)
            if sum(map(len, seen.values())) > HELD_WORDS:
                yield from rows()
                seen = {}
        yield from rows()

    told = _texts(docs, lang, text).mapInPandas(run, "lang string, word string, a long")
    return told.groupBy("lang", "word").agg(F.sum("a").alias("a"))


def with_ids(vocabulary: DataFrame) -> DataFrame:
    """vocabulary with `id`, counted from 1: places within stored partitions plus the rows of those before."""
    rows = cut(vocabulary.withColumn("_row", F.monotonically_increasing_id()), "vocabulary")
    rows = rows.withColumn("_part", F.shiftright("_row", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = rows.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    place = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before") + 1
    return cut(rows.join(F.broadcast(offsets), "_part").withColumn("id", place).drop("_part", "_before", "_row"), "ids")


def encoded(docs: DataFrame, vocabulary: DataFrame, lang: str = "lang", text: str = "text", most: int = VOCABULARY_ROWS) -> DataFrame:
    """(ids array<long>, starts): texts as ids, 0 for ends of pieces and words without an id. An n-gram counts if it
    begins within the first `starts` ids; a block's further ids belong to the next one too.

    A vocabulary of at most `most` rows goes to the workers; a larger one is joined, word by word."""
    if vocabulary.limit(most + 1).count() <= most:
        ids: dict[str, dict[bytes, int]] = {}
        for r in vocabulary.select("lang", "word", "id").collect():  # counted above
            ids.setdefault(r["lang"], {})[r["word"].encode()] = r["id"]
        told = docs.sparkSession.sparkContext.broadcast(ids)

        def run(batches):
            for pdf in batches:
                out = []
                for k, t in zip(pdf["lang"], pdf["text"]):
                    get = told.value.get(k, {}).get
                    out += [get(w, 0) for w in words(t)]
                    out.append(0)
                yield pd.DataFrame({"ids": [np.array(out, np.int64)], "starts": [len(out)]})

        return _texts(docs, lang, text).mapInPandas(run, "ids array<long>, starts long")

    def blocks(batches):
        for pdf in batches:
            for rid, k, t in zip(pdf["rid"].tolist(), pdf["lang"], pdf["text"]):
                w = words(t)
                for b in range(0, len(w), BLOCK):
                    part = w[b : b + BLOCK + 4]
                    yield pd.DataFrame({"rid": rid, "block": b, "pos": range(len(part)), "lang": k, "word": [x.decode() for x in part], "starts": min(BLOCK, len(w) - b)})

    rows = _texts(docs, lang, text).withColumn("rid", F.monotonically_increasing_id()).select("rid", "lang", "text")
    each = rows.mapInPandas(blocks, "rid long, block long, pos long, lang string, word string, starts long")
    each = each.join(vocabulary.select("lang", "word", "id"), ["lang", "word"], "left").select("rid", "block", "starts", F.struct("pos", F.coalesce("id", F.lit(0)).alias("id")).alias("at"))
    return each.groupBy("rid", "block", "starts").agg(F.sort_array(F.collect_list("at"))["id"].alias("ids")).select("ids", "starts")  # BLOCK + 4 at most


def _starts(ids: np.ndarray, starts: int, n: int) -> np.ndarray:
    """Where n words in a row all have an id."""
    stop = min(starts, len(ids) - n + 1)
    if stop <= 0:
        return np.zeros(0, np.int64)
    ok = np.ones(stop, bool)
    for j in range(n):
        ok &= ids[j : j + stop] != 0
    return np.flatnonzero(ok)


def _found(lookup: Lookup, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    n = lookup.packing.words
    return lookup(lookup.packing.permute(lookup.packing.pack([ids[at + j] for j in range(n)])))


def count_phrases(texts: DataFrame, n: int, bits: int, shard_bits: int, least: int, known=None, gather: int = GATHER, held: int = HELD) -> DataFrame:
    """(shard, filter): the phrases of n words that occur at least `least` times in texts(ids, starts), with their
    counts, as one quotient filter a shard. known: a name and a broadcast of the filter of the frequent phrases of n - 1 words."""
    packing, smaller = Packing(n, bits), Packing(n - 1, bits)
    shard_bits = min(shard_bits, packing.widths[0])

    def sent(lanes, counts):
        shard = (lanes[0] >> np.uint64(packing.widths[0] - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(counts), np.int64)
        edges = np.flatnonzero(np.diff(shard, prepend=-1, append=1 << 62))
        rows = [(int(shard[a]), write_filter(packing, [x[a:b] for x in lanes], counts[a:b], shard_bits)) for a, b in zip(edges[:-1], edges[1:])]
        return pd.DataFrame(rows, columns=["shard", "filter"])

    def run(batches):
        lookup = None if known is None else kept(known[0], lambda: Lookup(smaller, read_filter(smaller, known[1].value, 0, 0)[0]))
        parts, size, whole = [], 0, 0
        for pdf in batches:
            for ids, starts in zip(pdf["ids"], pdf["starts"].tolist()):
                ids = np.asarray(ids, np.int64)
                for a in range(0, starts, gather):  # a long text in steps
                    some = ids[a : a + gather + n - 1]
                    at = _starts(some, min(gather, starts - a), n)
                    if lookup and len(at):
                        at = at[_found(lookup, some, at)]
                        at = at[_found(lookup, some, at + 1)]
                    if len(at):
                        parts.append((packing.permute(packing.pack([some[at + j] for j in range(n)])), np.ones(len(at), np.int64)))
                        size += len(at)
                    if size - whole > gather:
                        parts = [merged(parts)]
                        size = whole = len(parts[0][1])
                        if whole > held:
                            yield sent(*parts[0])
                            parts, size, whole = [], 0, 0
        if parts:
            yield sent(*merged(parts))

    def together(batches):
        shard, parts, size, whole = None, [], 0, 0

        def frequent():
            lanes, counts = merged(parts)
            keep = counts >= least
            if keep.any():
                yield pd.DataFrame([(shard, write_filter(packing, [x[keep] for x in lanes], counts[keep], shard_bits), int(keep.sum()))], columns=["shard", "filter", "phrases"])

        for pdf in batches:
            for s, raw in zip(pdf["shard"].tolist(), pdf["filter"]):
                if s != shard:
                    if parts:
                        yield from frequent()
                    shard, parts, size, whole = s, [], 0, 0
                parts.append(read_filter(packing, raw, s, shard_bits))
                size += len(parts[-1][1])
                if size - whole > gather:
                    parts = [merged(parts)]
                    size = whole = len(parts[0][1])
        if parts:
            yield from frequent()

    filters = texts.mapInPandas(run, "shard long, filter binary")
    return filters.repartition("shard").sortWithinPartitions("shard").mapInPandas(together, "shard long, filter binary, phrases long")


def frequent_phrases(texts: DataFrame, bits: int, shard_bits: int, least: int, longest: int = 5, prune_bytes: int = PRUNE_BYTES, **sizes) -> DataFrame:
    """(ids, a) of all phrases of 2 to `longest` words that occur at least `least` times."""
    spark, out, known = texts.sparkSession, None, None
    for n in range(2, longest + 1):
        found = cut(count_phrases(texts, n, bits, shard_bits, least, known, **sizes), "phrases")
        packing = Packing(n, bits)
        in_shard = min(shard_bits, packing.widths[0])

        def rows(batches, packing=packing, in_shard=in_shard):
            for pdf in batches:
                for shard, raw in zip(pdf["shard"].tolist(), pdf["filter"]):
                    lanes, counts = read_filter(packing, raw, shard, in_shard)
                    yield pd.DataFrame({"ids": list(packing.unpack(packing.permute(lanes, back=True))), "a": counts})

        level = found.select("shard", "filter").mapInPandas(rows, "ids array<long>, a long")
        out = level if out is None else out.unionByName(level)
        n_found, n_bytes = found.agg(F.sum("phrases"), F.sum(F.octet_length("filter"))).first()
        if not n_found:
            break
        known = None
        # in a worker's memory an entry takes 8 bytes a lane and the runs' first places
        if n < longest and max(n_bytes, n_found * 8 * (len(packing.widths) + 2)) <= prune_bytes:
            parts = [read_filter(packing, r["filter"], r["shard"], in_shard) for r in found.orderBy("shard").collect()]  # prune_bytes at most
            known = uuid.uuid4().hex, spark.sparkContext.broadcast(write_filter(packing, *merged(parts), 0))
    return out


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 100, longest: int = 5, absorb: int = 100, top: int = 2_000, vocabulary_rows: int = VOCABULARY_ROWS, prune_bytes: int = PRUNE_BYTES, **sizes) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each lang's first `top` phrases, as op13's contract defines them.

    Everything is exact. Null texts are empty, a null lang is `und`; repeated rows count each; an empty table gives
    an empty one. Other columns of docs are never read. Phrases cross no end of a piece or text."""
    seen = cut(word_counts(docs, lang, text), "words")
    total = seen.groupBy("lang").agg(F.sum("a").alias("n"))
    vocabulary = with_ids(seen.where(F.col("a") >= least))
    all_words, most_id = total.agg(F.sum("n")).first()[0] or 0, vocabulary.agg(F.max("id")).first()[0] or 0
    shard_bits = max(6, math.ceil(math.log2(all_words / SHARD_WORDS)) if all_words else 0)
    texts = cut(encoded(docs, vocabulary, lang, text, vocabulary_rows), "encoded")
    cand = cut(frequent_phrases(texts, max(1, int(most_id).bit_length()), shard_bits, least, longest, prune_bytes, **sizes), "candidates")
    known = cand.unionByName(vocabulary.select(F.array("id").alias("ids"), "a"))
    known = F.broadcast(known) if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else known
    # what a longer candidate takes with it
    length = F.explode(F.sequence(F.lit(2), F.size("ids") - 1)).alias("k")
    inner = cand.where(F.size("ids") > 2).select("ids", "a", length).select("k", "ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - F.col("k") + 1)).alias("at"))
    inside = inner.groupBy(F.slice("ids", F.col("at"), F.col("k")).alias("ids")).agg(F.max("a").alias("_in"))
    whole = cand.join(inside, "ids", "left").where(F.coalesce(100 * F.col("_in") < absorb * F.col("a"), F.lit(True))).select("ids", "a")
    named = vocabulary.select("id", "lang", "word").join(small(total), "lang")
    named = F.broadcast(named) if vocabulary.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else named
    texts_of = whole.select("ids", "a", F.posexplode("ids").alias("pos", "id")).join(named, "id").groupBy("ids", "a").agg(
        F.first("lang").alias("lang"), F.first("n").alias("n"), F.array_join(F.sort_array(F.collect_list(F.struct("pos", "word")))["word"], " ").alias("phrase"))
    cuts = texts_of.select("*", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.slice("ids", F.lit(1), F.col("k")), "rest": F.slice("ids", F.col("k") + 1, F.size("ids"))})
    cuts = cuts.join(known.select(F.col("ids").alias("first"), F.col("a").alias("l")), "first").join(known.select(F.col("ids").alias("rest"), F.col("a").alias("r")), "rest")
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    cuts = cuts.withColumn("score", F.expr(f"(1000 * ({wide('a')} * {wide('n')})) div ({wide('l')} * {wide('r')})"))
    best = cuts.groupBy("ids").agg(*[F.first(c).alias(c) for c in ("lang", "phrase", "a", "n")], F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))  # Spark keeps `top` rows a task
    return best.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir):
    """The first 2,000 collocations of each language of all documents."""
    return collocations(read(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
f AS MATERIALIZED (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g, count(*) AS a
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) t(k) WHERE len(w) >= k) GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS MATERIALIZED (SELECT *, string_split(g, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT *, array_to_string(w[1:j], ' ') AS first, array_to_string(w[j + 1:], ' ') AS rest FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
scored AS (SELECT cuts.lang, cuts.g, cuts.k, j, cuts.a, x.a AS l, y.a AS r, n, ((1000 * cuts.a::HUGEINT * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
           FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = first JOIN f y ON y.lang = cuts.lang AND y.g = rest JOIN n ON n.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
inner_ AS (SELECT lang, array_to_string(list_slice(w, i, i + s - 1), ' ') AS g, max(a) AS a FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM c)) GROUP BY ALL),
alone AS (SELECT b.* FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.g = b.g WHERE i.a IS NULL OR 100 * i.a < 100 * b.a)
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM alone) WHERE rank <= 2000
"""
