"""Token-id files: documents in ascending id order as coded blocks, and what reading them back gives.

Blocks are kept in Parquet files, so that Spark's commit protocol guards the writes and any store that Spark
reaches will do. part is the file's range of document ids, seq the block within it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._base import bounded_batches, cut, read, small
from .idcoder import BLOCK_IDS, PIECE, crc32_join, read_blocks, write_blocks
from .tokens import encoder, in_steps

#: Blocks that a task codes at once: bounds its memory (about 0.6 MB each).
LANES = 400
BLOCKS = "part int, seq int, n_ids long, block binary"


def encode_documents(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", end: int = 1) -> DataFrame:
    """Blocks (part, seq, n_ids, block) of all documents in ascending id order (null ids first, ties by text)."""

    def run(batches):
        part = TaskContext.get().partitionId()
        doc_no = seq = 0
        left = np.zeros(0, np.uint32)  # ids of the block that isn't full yet
        pieces = np.zeros(0, PIECE)

        def blocks(ids, table, last):
            """Full blocks of what has gathered, and what is left over."""
            nonlocal seq
            ends = np.cumsum(table["n"].astype(np.int64))
            count = -(-len(ids) // BLOCK_IDS) if last else len(ids) // BLOCK_IDS
            sizes = [min(BLOCK_IDS, len(ids) - i * BLOCK_IDS) for i in range(count)]
            cuts, at, tables = np.cumsum(sizes), 0, []
            for stop, n in zip(cuts, sizes):
                start = stop - n
                first, to = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
                t = table[first:to].copy()
                begins = np.maximum(ends[first:to] - table["n"][first:to], start)
                t["n"] = np.minimum(ends[first:to], stop) - begins
                tables.append(t)
            done = int(cuts[-1]) if count else 0
            rows = [(part, seq + i, n, b) for i, (n, b) in enumerate(zip(sizes, write_blocks(ids[:done], tables, sizes)))]
            seq += count
            rest = table[np.searchsorted(ends, done, "right") :].copy()
            if len(rest):
                rest["n"][0] = min(int(rest["n"][0]), int(ends[len(table) - len(rest)] - done))
            return pd.DataFrame(rows, columns=["part", "seq", "n_ids", "block"]), ids[done:], rest

        gathered, waiting = [], 0
        for batch in batches:
            for pdf in in_steps(batch):
                ids, counts = encoder(tokenizer).encode(pdf["text"])
                ends = np.cumsum(counts + 1)
                full = np.full(int(ends[-1]), end, np.uint32)
                mask = np.ones(len(full), bool)
                mask[ends - 1] = False
                full[mask] = ids
                table = np.zeros(len(pdf), PIECE)
                null = pdf["id"].isna().to_numpy()
                table["doc_no"] = doc_no + np.arange(len(pdf))
                table["doc_id"] = pdf["id"].fillna(0).to_numpy().astype(np.int64)
                table["n"], table["flags"] = counts + 1, null
                doc_no += len(pdf)
                gathered.append((full, table))
                waiting += len(full)
                if waiting >= LANES * BLOCK_IDS:
                    rows, left, pieces = blocks(np.concatenate([left, *[g[0] for g in gathered]]), np.concatenate([pieces, *[g[1] for g in gathered]]), False)
                    gathered, waiting = [], 0
                    yield rows
        left, pieces = np.concatenate([left, *[g[0] for g in gathered]]), np.concatenate([pieces, *[g[1] for g in gathered]])
        rows, left, pieces = blocks(left, pieces, True)
        yield rows

    # ties are parted by text, so that an id of very many rows fills several files
    src = bounded_batches(docs).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"), F.md5(F.col(text).cast("binary")).alias("tie"))
    return src.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text").mapInPandas(run, BLOCKS)


def decode_documents(blocks: DataFrame, id: str = "doc_id") -> DataFrame:
    """One row per document: id, start (ids of all documents before it), n_tokens, ids_crc32, read from the blocks."""

    def run(batches):
        for pdf in batches:
            rows = []
            for first in range(0, len(pdf), LANES):
                some = pdf.iloc[first : first + LANES]
                for part, seq, (table, ids) in zip(some["part"], some["seq"], read_blocks([bytes(b) for b in some["block"]])):
                    at, raw = 0, ids.astype("<u4")
                    for piece in table:
                        n = int(piece["n"])
                        rows.append((part, int(piece["doc_no"]), None if piece["flags"] & 1 else int(piece["doc_id"]), seq, at, n, zlib.crc32(raw[at : at + n].tobytes())))
                        at += n
            yield pd.DataFrame(rows, columns=["part", "doc_no", "id", "seq", "at", "n", "crc"]).astype({"id": "Int64"})

    @F.pandas_udf("long")
    def joined(parts: pd.Series) -> pd.Series:
        def one(rows):
            rows = sorted(rows, key=lambda r: r["seq"])
            crc = rows[0]["crc"]
            for r in rows[1:]:
                crc = crc32_join(crc, r["crc"], 4 * r["n"])
            return crc

        return parts.map(one)

    # a part has as many blocks as its range of ids; counts of blocks add up to each block's first id
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    pieces = cut(blocks.mapInPandas(run, "part int, doc_no long, id long, seq int, at long, n long, crc long"), "pieces")
    docs = pieces.groupBy("part", "doc_no").agg(
        F.first("id").alias("id"), F.min(F.struct("seq", "at")).alias("first"), F.sum("n").alias("n_tokens"), F.collect_list(F.struct("seq", "n", "crc")).alias("parts"))
    where = F.col("first.seq").cast("long") * BLOCK_IDS + F.col("first.at")
    # few documents lie in more than one block
    whole = docs.where(F.size("parts") == 1).withColumn("crc", F.col("parts")[0]["crc"])
    docs = whole.union(docs.where(F.size("parts") > 1).withColumn("crc", joined("parts")))
    # one row per file, and a file holds at least a task's share of the documents
    return docs.join(small(offsets), "part").select(F.col("id").alias(id), (F.col("offset") + where).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32"))


def op7_id_files(spark, sf_dir):
    """All documents written as coded id blocks, and what reading them back gives."""
    files = cut(encode_documents(read(spark, sf_dir, "documents"), "word_bpe_49k.json"), "ids")
    return decode_documents(files)
