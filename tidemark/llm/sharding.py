"""Weighted rendezvous hashing of stable record keys (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._base import cut, read, small


def rendezvous(key, weights: dict[int, float], seed: str = "s"):
    """The shard with the highest score -weight / ln(u), u in (0, 1) from a hash of key and shard.

    A new shard takes keys only into itself; a change of one weight moves keys only from or to that shard.
    A null key is a key of its own. Ties go to the higher shard number.
    """
    if not weights or any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive")

    def score(shard, weight):
        name = F.concat(F.lit(f"{seed}:{shard}:"), F.coalesce(key.cast("string"), F.lit("null")))
        u = (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(16**13)
        return F.struct((F.lit(-float(weight)) / F.log(u)).alias("score"), F.lit(int(shard)).alias("shard"))

    return F.array_max(F.array(*[score(s, w) for s, w in sorted(weights.items())]))["shard"]


def place(docs: DataFrame, weights: dict[int, float], key: str = "doc_id", text: str = "text", grown: dict[int, float] | None = None) -> DataFrame:
    """(key, size, text_crc32, shard, grown_shard, slot): slot counts from 0 without gaps in each shard, in key order.

    Rows are dealt out by ranges of the key in its own order, whatever its type, and written once with their place;
    rows are numbered inside (shard, range), and the counts of the earlier ranges are added, so no task numbers a
    whole shard. Rows of one key, however many, are cut by content and row. Null keys come first; equal keys share a
    shard; equal rows each have a slot. Null texts have no bytes. An empty table gives an empty one.
    """
    grown = grown or {**weights, max(weights) + 1: 1.0}
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("key"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.monotonically_increasing_id().alias("rid"))
    order = [F.col("key").asc_nulls_first(), F.col("text_crc32"), F.col("size"), F.col("rid")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = cut(dealt.select("key", "size", "text_crc32", rendezvous(F.col("key"), weights).alias("shard"), rendezvous(F.col("key"), grown).alias("grown_shard"), F.monotonically_increasing_id().alias("row")), "shards")
    rows = rows.withColumn("range", F.shiftright("row", 33))
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    counts = rows.groupBy("shard", "range").count().select("shard", "range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "range").orderBy("row"))
    out = rows.withColumn("at", inside - 1).join(small(counts), ["shard", "range"])
    return out.select(F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("before") + F.col("at")).cast("long").alias("slot"), "grown_shard")


def op4_shard(spark, sf_dir):
    """All documents in eight shards of equal weight, and where they would be in nine."""
    docs = read(spark, sf_dir, "documents")
    placed = place(docs, {s: 1.0 for s in range(8)})
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.col("grown_shard").cast("int").alias("grown_shard"))


OP4_SQL = """
WITH u AS (SELECT doc_id, coalesce(text, '') AS t, list_transform(range(9), lambda s: -1.0 / ln((('0x' || substr(md5('s:' || s || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)) AS score FROM documents),
s AS (SELECT doc_id, t, list_position(score[1:8], list_max(score[1:8])) - 1 AS shard, list_position(score, list_max(score)) - 1 AS grown_shard,
             list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM u)
SELECT doc_id, (strlen(t) + 1)::BIGINT AS size,
       -- crc32 bit by bit
       xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, z: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295) AS text_crc32,
       'key' AS law, shard::INTEGER AS shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard::INTEGER AS grown_shard
FROM s
"""
