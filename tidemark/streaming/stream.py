"""Structured Streaming: incremental scans of an append-only base, delivery of sealed pages, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.pages import PAGE
from ..plans import state
from ..plans.run import Send, deliver, run_inputs
from ..plans.scan import Input


def stream_dedup(events: DataFrame, ts: str = "ts", delay: str = "10 minutes", delivered: DataFrame | None = None) -> DataFrame:
    """Replayed envelopes removed. Within the delay, which must be at least the overlap, or late rows of it are lost,
    state knows the ids; what was replayed after a longer outage is known from delivered(event_id), a table that each
    micro-batch reads as it then is. State is bounded by the delay, history is a join."""
    if delivered is not None:
        events = events.join(delivered.select("event_id").distinct(), "event_id", "left_anti")
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["event_id"])


def deliver_stream(spark: SparkSession, root: str, checkpoint: str, send: Send, files_per_trigger: int = 100, pages_per_send: int = 4096) -> StreamingQuery:
    """Delivers sealed pages: follows the manifest, since a page is visible only once its manifest row is, reads the
    events of those attempts alone, sends them, and appends the receipts that `send` gives. A replayed batch skips
    receipted pages. A trigger takes so many manifest files, and sends so many pages at once."""
    stream = spark.readStream.schema(state.SCHEMAS["manifest"]).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{root}/manifest")

    def step(pages: DataFrame, _: int) -> None:
        deliver(pages.sparkSession, root, pages.select(*PAGE), send, pages_per_send)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rising_stream(spark: SparkSession, path: str, schema, inp: Input, root: str, checkpoint: str, send: Send, files_per_trigger: int = 1000) -> StreamingQuery:
    """Scans an append-only directory as files arrive, one scan after another; the cursor moves only after delivery.
    Each trigger reads the base past the cursor, so rows that a failed trigger left behind are not lost; with
    max_scan_rows it takes that many at a time, each lot delivered and committed before the next, and with partition
    rules it reads only partitions that can hold new rows."""
    arrivals = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)

    def scan(_: DataFrame, __: int) -> None:
        while True:
            rows = run_inputs(spark, [(inp, spark.read.schema(schema).parquet(path))], root, send)[inp.input_id]
            if inp.max_scan_rows is None or rows < inp.max_scan_rows:
                return

    return arrivals.writeStream.foreachBatch(scan).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
