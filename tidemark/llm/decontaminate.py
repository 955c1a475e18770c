"""Benchmark decontamination by a positional index (DataFrame operations only).

The index is parted by document: every training text is stored once as its terms by position, so the postings of a
text lie together and lists meet without a shuffle. A phrase search takes the rarest term of each test phrase, as
counted over the whole corpus, fetches that term's postings, shifts each posting by the term's offset in the phrase
and intersects it with the other terms at their own offsets. A proximity search starts from the rarest term as well
and walks both ways with a slack between neighbouring terms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._base import BROADCAST_ROWS, ascii_lower, cut, read, small

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    """Words of a text, ASCII letters lower-cased; null has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def build_index(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Stored positional index: (rid, row, words); position p of a text is words[p], row has the columns to keep.

    rid numbers the rows, so repeated or null ids stay apart. Null and empty texts have no words.
    """
    return cut(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*keep).alias("row"), words(F.col(text)).alias("words")), "index")


def phrases(bench: DataFrame, size: int = 10, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, phrase): every window of `size` consecutive words; a shorter, non-empty item is one phrase."""
    w = bench.select(F.col(item).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1))))
    return w.select("item", "w", at.alias("at")).select("item", F.slice("w", F.col("at"), size).alias("phrase")).distinct()


def rarest_terms(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(phrase, term, off): of each distinct phrase its rarest term and where it stands, by counts over all texts."""
    terms = wanted.select(F.explode("phrase").alias("term")).distinct()
    found = index.select(F.explode("words").alias("term")).join(small(terms), "term", "left_semi").groupBy("term").count()
    found = cut(found, "terms")
    placed = wanted.select("phrase").distinct().select("phrase", F.posexplode("phrase").alias("off", "term"))
    ranked = placed.join(small(found), "term", "left").withColumn("n", F.coalesce("count", F.lit(0)))
    one = ranked.groupBy("phrase").agg(F.min(F.struct("n", "off", "term")).alias("m"), F.count("*").alias("k"))
    # a term that the corpus lacks rules its phrase out
    return one.where(F.col("m.n") > 0).select("phrase", F.col("k").cast("int").alias("k"), F.col("m.term").alias("term"), F.col("m.off").alias("off"))


def _anchored(index: DataFrame, anchors: DataFrame, most: int) -> DataFrame:
    """The postings of anchor terms with their texts' words: (rid, words, pos, *anchors).

    Many anchors are joined by shuffle; then only (rid, pos, term) travels, and each text's words are fetched once."""
    if anchors.limit(most + 1).count() <= most:
        return index.select("rid", "words", F.posexplode("words").alias("pos", "term")).join(F.broadcast(anchors), "term")
    found = index.select("rid", F.posexplode("words").alias("pos", "term")).join(anchors, "term")
    return found.join(index.select("rid", "words"), "rid")


def exact_matches(index: DataFrame, wanted: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(rid, start, k, phrase): every place where a phrase occurs; start counts from 0, k is its length."""
    start = F.col("pos") - F.col("off")
    lists_meet = (start >= 0) & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("k")) == F.col("phrase"))
    found = _anchored(index, cut(rarest_terms(index, wanted), "anchors"), broadcast_rows)
    return found.where(lists_meet).select("rid", start.alias("start"), "k", "phrase")


def _reached(pos, terms, slack: int, way: int):
    """All places that the last of the terms can have, if each stands 1 to 1 + slack places on from the one before."""

    def step(places, term):
        near = lambda p: F.filter(F.sequence(p + way, p + way * (1 + slack), F.lit(way)), lambda q: (q >= 0) & (F.get("words", q) == term))
        return F.array_distinct(F.flatten(F.transform(places, near)))

    return F.aggregate(terms, F.array(pos), step)


def proximity_matches(index: DataFrame, wanted: DataFrame, slack: int = 2, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(rid, phrase, start, end): the phrase's terms stand in order, each at most `slack` words after its place
    behind the one before. For every posting of the rarest term that lies in a match the nearest start and end,
    counted from 0; all places that a term can have are followed, so no match is lost."""
    found = _anchored(index, cut(rarest_terms(index, wanted), "anchors"), broadcast_rows)
    before = F.reverse(F.slice("phrase", F.lit(1), F.col("off")))
    after = F.slice("phrase", F.col("off") + 2, F.col("k"))
    found = found.withColumns({"starts": _reached(F.col("pos"), before, slack, -1), "ends": _reached(F.col("pos"), after, slack, 1)})
    return found.where((F.size("starts") > 0) & (F.size("ends") > 0)).select("rid", "phrase", F.array_max("starts").alias("start"), F.array_min("ends").alias("end")).distinct()


def contamination(docs: DataFrame, bench: DataFrame, size: int = 10, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: row (a struct of the columns to keep, so that none can clash), n_words, n_hit (words inside a matched window), n_items, items (sorted ids as
    text), items_sha256, contaminated. Null or empty texts have no words and no hits. An item without an id counts, but
    can't be named in items."""
    index = build_index(docs, keep=keep)
    wanted = cut(phrases(bench, size), "phrases")
    found = cut(exact_matches(index, wanted), "matches")
    spans = found.select("rid", "start", (F.col("start") + F.col("k")).alias("stop")).distinct()
    # words in the union of the spans: each span adds what lies beyond the furthest stop before it
    before = Window.partitionBy("rid").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0))), F.lit(0))
    hit = spans.select("rid", fresh.alias("fresh")).groupBy("rid").agg(F.sum("fresh").cast("long").alias("n_hit"))
    pairs = found.select("rid", "phrase").distinct().join(small(wanted), "phrase").select("rid", F.col("item").cast("string").alias("item")).distinct()
    items = pairs.groupBy("rid").agg(F.sort_array(F.collect_list("item")).alias("items"), F.count("*").alias("n_items"))
    none = F.array().cast("array<string>")
    out = index.select("rid", "row", F.size("words").cast("long").alias("n_words")).join(hit, "rid", "left").join(items, "rid", "left")
    items, n_hit = F.coalesce("items", none), F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        "row", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), items.alias("items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op5_decontaminate(spark, sf_dir):
    """Ten-word windows of benchmark items in all documents."""
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def proximity_search(spark, sf_dir):
    """Where the first three words of a benchmark item stand near one another, in order, in all documents: each at most
    two words after its place behind the one before."""
    index = build_index(read(spark, sf_dir, "documents"))
    w = read(spark, sf_dir, "benchmark").select(F.slice(words(F.col("text")), 1, 3).alias("phrase")).where(F.size("phrase") == 3).distinct()
    found = proximity_matches(index, cut(w, "wanted"), slack=2).join(index.select("rid", "row.doc_id"), "rid")
    return found.select("doc_id", F.array_join("phrase", " ").alias("phrase"), F.col("start").cast("long").alias("first"), F.col("end").cast("long").alias("last"))


PROXIMITY_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
w AS MATERIALIZED (SELECT doc_id, w[i] AS term, i - 1 AS pos FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
b AS (SELECT DISTINCT list_slice(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), 1, 3) AS p FROM benchmark),
p AS (SELECT p FROM b WHERE len(p) = 3),
n AS (SELECT term, count(*) AS n FROM w GROUP BY term),
rare AS (SELECT p, off FROM (SELECT p, off, row_number() OVER (PARTITION BY p ORDER BY coalesce(n, 0), off) AS r FROM (SELECT p, unnest(range(3)) AS off FROM p) LEFT JOIN n ON term = p[off + 1]) WHERE r = 1),
c AS (SELECT x.doc_id, p, x.pos AS a, z.pos AS z, CASE off WHEN 0 THEN x.pos WHEN 1 THEN y.pos ELSE z.pos END AS anchor
      FROM rare JOIN w x ON x.term = p[1] JOIN w y ON y.doc_id = x.doc_id AND y.term = p[2] AND y.pos BETWEEN x.pos + 1 AND x.pos + 3 JOIN w z ON z.doc_id = x.doc_id AND z.term = p[3] AND z.pos BETWEEN y.pos + 1 AND y.pos + 3)
SELECT DISTINCT doc_id, array_to_string(p, ' ') AS phrase, max(a)::BIGINT AS first, min(z)::BIGINT AS last FROM c GROUP BY doc_id, p, anchor
"""


OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS g, least(len(w), 10) AS k
        FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT k FROM win),
gram AS (SELECT doc_id, k, i, list_slice(w, i, i + k - 1) AS g
         FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, lens WHERE len(w) >= k)),
m AS (SELECT doc_id, i, gram.k, item_id FROM gram JOIN win ON gram.g = win.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
