"""Best-fit decreasing packing of tokenised documents.

Best-fit decreasing looks at piece lengths alone, so it is planned from the histogram of lengths (at most `size`
rows, whatever the corpus) and gives runs: the pieces of one length with ranks lo..hi-1 go to consecutive
sequences. Spark ranks the pieces of each length and looks their runs up.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._base import bounded_batches, cut, read, small
from .tokens import encoder, in_steps


class CapacityTree:
    """Segment tree over remaining capacities 0..size: which have an open window, and the tightest that fits."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = bytearray(2 * self.leaves)

    def set(self, capacity: int, is_open: bool):
        i = capacity + self.leaves
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] | self.open[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest open capacity that is at least `least`."""
        i = least + self.leaves
        if i >= 2 * self.leaves:
            return None
        while not self.open[i]:
            while i & 1:  # a right child: what lies to its right hangs higher up
                i //= 2
            if not i:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.leaves


def plan(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over {length: pieces}: runs (length, lo, hi, first sequence, pieces in each, offset).

    Windows that are alike stay together, so a step moves whole groups of windows: the tightest window that fits
    takes equal pieces until none fits, exactly as one piece at a time would.
    """
    tree, groups, runs, opened = CapacityTree(size), [deque() for _ in range(size + 1)], [], 0

    def put(capacity, first, n):
        if n and capacity:
            groups[capacity].append((first, n))
            tree.set(capacity, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        if not 0 < length <= size:
            raise ValueError(f"length {length} does not fit {size}")
        while left:
            room = tree.tightest(length)
            if room is None:
                room, each = size, size // length
                first, n = opened, -(-left // each)
                opened += n
            else:
                first, n = groups[room].popleft()
                if not groups[room]:
                    tree.set(room, False)
                each = room // length
            full = min(n, left // each)
            if full:
                runs.append((length, rank, rank + full * each, first, each, size - room))
                rank, left = rank + full * each, left - full * each
                put(room - each * length, first, full)
            if left and full < n:
                runs.append((length, rank, rank + left, first + full, left, size - room))
                put(room - left * length, first + full, 1)
                full, rank, left = full + 1, rank + left, 0
            put(room, first + full, n - full)
    return runs


def cut_documents(docs: DataFrame, tokenizer: str, size: int, id: str = "doc_id", text: str = "text", end: int = 1) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens): full windows of each document and what is left over.

    A null text is an empty one; every document ends with the id `end`, so none is without tokens.
    """

    def run(batches):
        for batch in batches:
            for pdf in in_steps(batch):
                ids, counts = encoder(tokenizer).encode(pdf["text"])
                rows, at = [], 0
                for i, n in zip(pdf["id"], counts):
                    own = np.append(ids[at : at + n], np.uint32(end)).astype("<u4")
                    at += n
                    rows += [(i, s, min(size, len(own) - s), zlib.crc32(own[s : s + size].tobytes()), len(own)) for s in range(0, len(own), size)]
                yield pd.DataFrame(rows, columns=["id", "start", "length", "ids_crc32", "doc_tokens"]).astype({"id": "Int64"})

    src = bounded_batches(docs).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return src.mapInPandas(run, "id long, start long, length long, ids_crc32 long, doc_tokens long").withColumnRenamed("id", id)


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", size: int = 2048, id: str = "doc_id", text: str = "text", end: int = 1) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (gapless in its sequence).

    Equal lengths are ranked in the order in which the pieces were written; an empty table gives none.
    """
    row = F.monotonically_increasing_id()
    pieces = cut_documents(docs, tokenizer, size, id, text, end)
    pieces = cut(pieces.select("*", F.shiftright(row, 33).alias("block"), row.alias("row")), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    runs = docs.sparkSession.createDataFrame(plan(counts, size), "length long, lo long, hi long, first long, each long, at long")
    # ranks: inside (length, block), plus the pieces of that length in earlier blocks
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.groupBy("length", "block").count().withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0))).drop("count")
    inside = Window.partitionBy("length", "block").orderBy("row")
    ranked = pieces.withColumn("rank", F.row_number().over(inside) - 1).join(offsets, ["length", "block"]).withColumn("rank", F.col("rank") + F.col("before"))
    # the runs depend on the lengths that occur, not on the number of pieces
    placed = ranked.join(small(runs), "length").where("rank >= lo and rank < hi")
    step = F.col("rank") - F.col("lo")
    return placed.select(
        id, "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first") + F.floor(step / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (step % F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def op9_pack(spark, sf_dir):
    """All pieces of all documents in sequences of 2048 tokens."""
    return pack(read(spark, sf_dir, "documents"), "byte_bpe_50k.json", 2048)
