"""Pages: summaries, digests, usage, accounting, delivered prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids
from .order import page_by_page

PAGE = ["input_id", "attempt_id", "page"]
SCAN = ["input_id", "attempt_id"]


def page_summary(events: DataFrame, committed: DataFrame | None = None, *more: Column) -> DataFrame:
    """rows, bytes, truncated, candidate and resume of each page. committed(input_id, ts_us, id) may be empty or None.

    resume is the last position of the page, candidate the larger of it and the committed one; more: further
    aggregates of a page."""
    at = F.struct("ts_us", "id")
    by_page = events.groupBy(*PAGE).agg(F.count("*").alias("rows"), F.sum(F.col("line_bytes") + 1).cast("long").alias("bytes"), F.max(at).alias("resume"), *more)
    last = Window.partitionBy(*SCAN)  # one row per page
    by_page = by_page.withColumn("truncated", F.col("page") < F.max("page").over(last))
    if committed is None:
        return by_page.withColumn("candidate", F.col("resume"))
    known = committed.select("input_id", F.struct("ts_us", "id").alias("committed"))
    return by_page.join(known, "input_id", "left").withColumn("candidate", F.greatest("resume", "committed")).drop("committed")


def scan_summary(manifest: DataFrame) -> DataFrame:
    """Rows, bytes, pages and the largest candidate of each scan."""
    return manifest.groupBy(*SCAN).agg(F.sum("rows").cast("long").alias("rows"), F.sum("bytes").cast("long").alias("bytes"), F.count("*").alias("pages"), F.max("candidate").alias("candidate"))


def current_cursor(cursors: DataFrame) -> DataFrame:
    """The cursor of the latest generation of each input."""
    return cursors.groupBy("input_id").agg(F.max("generation").alias("generation"), F.max_by(F.struct("ts_us", "id"), "generation").alias("at")).select("input_id", "generation", "at.ts_us", "at.id")


def duplicate_cursors(df: DataFrame, ts: str, id: str) -> DataFrame:
    return df.groupBy(ts, id).agg(F.count("*").alias("n")).where("n > 1")


def staged_usage(manifest: DataFrame, per_input: int, total: int) -> DataFrame:
    """Stored bytes of each input and of all (input_id null), with whether the quota is exceeded."""
    used = manifest.rollup("input_id").agg(F.sum("bytes").cast("long").alias("bytes"), F.grouping("input_id").alias("all_inputs"))
    return used.select("input_id", "bytes", F.when(F.col("all_inputs") == 1, F.col("bytes") > total).otherwise(F.col("bytes") > per_input).alias("over"))


def stream_digest(events: DataFrame, by: list[str] = PAGE, event: str = "line") -> DataFrame:
    """SHA-256 of a page over (8-byte length, event) in ordinal order, in one pass over all pages of a partition."""

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        page, h = None, None
        for pdf in frames:
            done = []
            for *key, text in zip(*[pdf[c].tolist() for c in by], pdf["event"].tolist()):
                if key != page:
                    if h is not None:
                        done.append((*page, h.hexdigest()))
                    page, h = key, hashlib.sha256()
                raw = text.encode("utf-8")
                h.update(len(raw).to_bytes(8, "big") + raw)
            yield pd.DataFrame(done, columns=[*by, "stream_digest"])
        if h is not None:
            yield pd.DataFrame([(*page, h.hexdigest())], columns=[*by, "stream_digest"])

    kept = page_by_page(events.select(*by, "ordinal", F.col(event).alias("event")), by, "event")
    return kept.mapInPandas(digest, ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in by) + ", stream_digest string")


def reference_digest(input_key: Column, attempt: Column, page: Column, rows: Column, bytes: Column, stream: Column, metadata: Column) -> Column:
    """SHA-256 over what identifies a sealed page and its recovery metadata."""
    raw = ids.utf8(metadata)
    return ids.sha(ids.utf8(ids.REFERENCE), ids.be(ids.VERSION, 2), F.unhex(input_key), ids.be(attempt, 8), ids.be(page, 8), ids.be(rows, 8), ids.be(bytes, 8), F.unhex(stream), ids.be(F.octet_length(raw), 8), raw)


def per_second(value: Column, duration_ns: Column) -> Column:
    """floor(value * 1e9 / ns) in exact integers; null at zero duration."""
    wide = value.cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.when(duration_ns > 0, F.floor(wide / F.when(duration_ns > 0, duration_ns).cast("decimal(19,0)")).cast("long"))


def run_rates(metrics: DataFrame) -> DataFrame:
    """metrics(input_id, rows, bytes, duration_ns) with rows_per_second and bytes_per_second."""
    return metrics.withColumn("rows_per_second", per_second(F.col("rows"), F.col("duration_ns"))).withColumn("bytes_per_second", per_second(F.col("bytes"), F.col("duration_ns")))


def backlog(manifest: DataFrame, receipts: DataFrame) -> DataFrame:
    """Pages, rows and bytes of each input that have no receipt."""
    open_pages = manifest.join(receipts, PAGE, "left_anti")
    return open_pages.groupBy("input_id").agg(F.count("*").alias("pages"), F.sum("rows").cast("long").alias("rows"), F.sum("bytes").cast("long").alias("bytes"))


def accounting_check(events: DataFrame, manifest: DataFrame, receipts: DataFrame) -> DataFrame:
    """Pages whose staged, recorded and delivered row counts differ (a page without receipt isn't delivered yet)."""
    staged = events.groupBy(*PAGE).agg(F.count("*").alias("staged"))
    told = manifest.select(*PAGE, F.col("rows").alias("recorded")).join(receipts.select(*PAGE, F.col("rows").alias("delivered")), PAGE, "left")
    both = staged.join(told, PAGE, "full_outer")
    bad = ~F.col("staged").eqNullSafe(F.col("recorded")) | (F.col("delivered").isNotNull() & ~F.col("delivered").eqNullSafe(F.col("staged")))
    return both.where(bad).select(*PAGE, "staged", "recorded", "delivered")


def contiguous_prefix(manifest: DataFrame) -> DataFrame:
    """Per scan: pages, and how many form the run 1..n without a gap."""
    n = F.row_number().over(Window.partitionBy(*SCAN).orderBy("page"))
    return manifest.select(*SCAN, "page", n.alias("n")).groupBy(*SCAN).agg(F.count("*").alias("pages"), F.count_if(F.col("n") == F.col("page")).alias("prefix"))


def delivered_prefix(manifest: DataFrame, receipts: DataFrame) -> DataFrame:
    """Per scan the last page of the longest prefix of pages that all have receipts."""
    marked = manifest.join(receipts.select(*PAGE, F.lit(True).alias("done")), PAGE, "left")
    open_page = F.min(F.when(F.col("done").isNull(), F.col("page")))
    return marked.groupBy(*SCAN).agg((F.coalesce(open_page, F.max("page") + 1) - 1).cast("long").alias("delivered_through"))


def previous_generation(cursors: DataFrame) -> DataFrame:
    """Cursor rows whose generation isn't their predecessor's plus one."""
    w = Window.partitionBy("input_id").orderBy("generation", "ts_us", "id")
    prior = F.lag("generation").over(w)
    return cursors.withColumn("prior", prior).where(F.col("prior").isNotNull() & (F.col("generation") != F.col("prior") + 1)).select("input_id", "prior", "generation")


def progress_check(manifest: DataFrame) -> DataFrame:
    """Pages that are truncated without a resume position, or whose resume doesn't advance."""
    prior = F.lag("resume").over(Window.partitionBy(*SCAN).orderBy("page"))
    issue = F.when(F.col("truncated") & F.col("resume").isNull(), "truncated_without_resume").when(F.col("prior").isNotNull() & ~(F.col("resume") > F.col("prior")), "resume_not_advancing")
    return manifest.withColumn("prior", prior).withColumn("issue", issue).where("issue is not null").select(*PAGE, "issue")


def manifest_check(manifest: DataFrame) -> DataFrame:
    """Pages that break: no rows means no positions and not truncated; rows mean both, candidate not before resume."""
    none = F.col("candidate").isNull() & F.col("resume").isNull()
    issue = F.when((F.col("rows") == 0) & ~(none & ~F.col("truncated")), "empty_page_with_cursor").when((F.col("rows") > 0) & (F.col("candidate").isNull() | F.col("resume").isNull()), "rows_without_cursor").when(F.col("candidate") < F.col("resume"), "candidate_before_resume")
    return manifest.withColumn("issue", issue).where("issue is not null").select(*PAGE, "issue")
