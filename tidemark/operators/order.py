"""Ordered operators: probes, ordinals without a global window, pages, running bytes, packing."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..cursor import Bound, CursorSpec, apply_bound, cursor_order
from ..errors import TidemarkError
from ..scratch import staged


def row_limit_probe(df: DataFrame, order: list[Column], max_rows: int) -> DataFrame:
    """The first max_rows rows in order, each with `truncated`: whether there is one more. The top max_rows + 1 rows
    are fetched; the last is the probe."""
    if not 1 <= max_rows <= 100_000:
        raise TidemarkError("row_limit", "max_rows must be 1..100000")
    top = df.orderBy(*order).limit(max_rows + 1)
    w = Window.orderBy(*order)  # at most max_rows + 1 rows
    marked = top.withColumn("_n", F.row_number().over(w)).withColumn("truncated", F.max("_n").over(Window.partitionBy()) > max_rows)
    return marked.where(F.col("_n") <= max_rows).drop("_n")


def next_page(df: DataFrame, spec: CursorSpec, bound: Bound | None, k: int) -> DataFrame:
    """The k smallest rows past the bound."""
    return apply_bound(df, spec, bound).orderBy(*cursor_order(spec)).limit(k)


def with_ordinal(df: DataFrame, ts: str = "ts_us", id: str = "id", buckets: int | None = None) -> DataFrame:
    """df with `ordinal` (1..n in (ts, id) order, nulls first) and `bucket` (ranges of that order).

    Rows are dealt out by ranges of (ts, id), sorted and written once with their place in the range; the counts of
    earlier ranges are added. A timestamp that many rows share is cut by id, and no task sees more than a range.
    """
    order = [F.col(ts).asc_nulls_first(), F.col(id).asc_nulls_first()]
    ranges = df.repartitionByRange(*([] if buckets is None else [buckets]), *order)
    placed = staged(ranges.sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("bucket", F.shiftright("_row", 33))
    counts = placed.groupBy("bucket").agg(F.count("*").alias("_c"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = counts.select("bucket", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    # as many rows as there are ranges, that is shuffle partitions
    return placed.join(F.broadcast(offsets), "bucket").withColumn("ordinal", (inside + 1 + F.col("_before")).cast("long")).drop("_row", "_before")


def page_assign(df: DataFrame, max_rows: int) -> DataFrame:
    """page = (ordinal - 1) div max_rows + 1."""
    return df.withColumn("page", (F.floor((F.col("ordinal") - 1) / F.lit(max_rows)) + 1).cast("long"))


def strictly_increasing(df: DataFrame, ts: str = "ts_us", id: str = "id", bucket: str = "bucket", ordinal: str = "ordinal") -> DataFrame:
    """Rows whose (ts, id) isn't past that of the row before them in ordinal order: (ordinal, ts, id).

    Neighbours within a bucket are compared by lag; the first row of each bucket with the last one of the bucket before."""
    at = F.struct(F.col(ts).alias("t"), F.col(id).alias("i"))
    inside = df.select(ordinal, ts, id, bucket, F.lag(at).over(Window.partitionBy(bucket).orderBy(ordinal)).alias("prior"))
    edges = df.groupBy(bucket).agg(F.min(ordinal).alias("first"), F.max_by(at, ordinal).alias("last"))
    edges = edges.select("first", F.lag("last").over(Window.orderBy("first")).alias("edge"))  # one row per bucket
    both = inside.join(F.broadcast(edges), inside[ordinal] == edges["first"], "left").withColumn("prior", F.coalesce("prior", "edge"))
    return both.where(F.col("prior").isNotNull() & ~(at > F.col("prior"))).select(ordinal, ts, id)


def running_bytes(df: DataFrame, by: list[str], bytes: str = "line_bytes") -> DataFrame:
    """df with `running`: bytes of the page so far, a newline after each line included."""
    w = Window.partitionBy(*by).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("running", F.sum(F.col(bytes) + 1).over(w).cast("long"))


def byte_limit(df: DataFrame, by: list[str], max_bytes: int) -> DataFrame:
    """Pages over the limit with the ordinal of the first line that doesn't fit; publishing any of them must fail."""
    over = running_bytes(df, by).where(F.col("running") > max_bytes)
    return over.groupBy(*by).agg(F.min("ordinal").alias("first_over"))


def page_by_page(events: DataFrame, by: list[str], *columns: str) -> DataFrame:
    """The columns of events with the rows of a page one behind the other in ordinal order, for a pass that carries
    its state from row to row; a worker streams many pages, and holds no page as a whole."""
    return events.select(*by, "ordinal", *columns).repartition(*by).sortWithinPartitions(*by, "ordinal")


class Packer:
    """Where batches begin, event after event: with a page, at max_events, or when the next event and its separator
    don't fit. An event over max_bytes fails."""

    def __init__(self, max_events: int, max_bytes: int):
        self.max_events, self.max_bytes = max_events, max_bytes
        self.page, self.n, self.used = None, 0, 0

    def starts(self, page, size: int) -> bool:
        """Whether an event of that page and size begins a batch."""
        if size > self.max_bytes:
            raise TidemarkError("event_exceeds_batch", f"an event of {size} bytes exceeds {self.max_bytes}")
        new = page != self.page or self.n == self.max_events or self.used + 1 + size > self.max_bytes
        if new:
            self.page, self.n, self.used = page, 0, 0
        self.used += (self.n > 0) + size
        self.n += 1
        return new


def pack_batches(events: DataFrame, by: list[str], max_events: int = 250, max_bytes: int = 1_000_000) -> DataFrame:
    """events (with ordinal and event_bytes) with `batch`, counted from 1 in each page, as Packer cuts them."""

    def greedy(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer, page, batch = Packer(max_events, max_bytes), None, 0
        for pdf in frames:
            out = []
            for *key, size in zip(*[pdf[c].tolist() for c in by], pdf["event_bytes"].tolist()):
                new = packer.starts(key, size)
                batch = 1 if key != page else batch + new
                page = key
                out.append(batch)
            yield pdf.assign(batch=out)

    keep = page_by_page(events, by, "event_bytes")
    return keep.mapInPandas(greedy, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep.schema) + ", batch long")
