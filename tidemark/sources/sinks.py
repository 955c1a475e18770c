"""Sinks: NDJSON files, page tables, requests to an HTTP collector (see `collector`), run metrics."""

from __future__ import annotations

import json
import time
import urllib.request

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import TidemarkError
from ..functions.strict import envelope, event_size_guard
from ..scratch import local


def write_ndjson(events: DataFrame, path: str, mode: str = "errorifexists") -> None:
    events.select("line").write.mode(mode).text(path)


def write_pages(events: DataFrame, manifest: DataFrame, root: str) -> None:
    """Events first, then the manifest: a page is visible once its manifest row is."""
    events.write.mode("append").partitionBy("input_id", "attempt_id").parquet(f"{root}/events")
    manifest.write.mode("append").parquet(f"{root}/manifest")


def enveloped(events: DataFrame, time: str, index: str, sourcetype: str, source: str, most: int = 900_000) -> DataFrame:
    """events(event_id, line, ..) with the delivered `event`; one over `most` bytes fails the delivery."""
    event = envelope(F.col("line"), F.col("event_id"), F.lit(time), index, sourcetype, source)
    sized = events.withColumn("event", event)
    too_large = F.raise_error(F.concat(F.lit("event_size: "), F.col("event_id")))
    return sized.withColumn("event", F.when(event_size_guard(F.col("event"), most), F.col("event")).otherwise(too_large.cast("string")))


def _call(url: str, body: bytes, head: dict, timeout: float) -> dict:
    with urllib.request.urlopen(urllib.request.Request(url, body, head), timeout=timeout) as r:
        answer = json.loads(r.read() or b"{}")
    if not isinstance(answer, dict) or answer.get("code", 0) != 0:
        raise TidemarkError("http_delivery", f"the collector answered {str(answer)[:200]}")
    return answer


def post(url: str, body: bytes, token: str, timeout: float, ack_url: str | None, attempts: int = 3) -> None:
    """One request. Broken connections, busy servers and server errors are tried again, which may deliver twice and
    the event ids make harmless; a request that the collector refuses is not."""
    head = {"Authorization": f"Bearer {token}", "Content-Type": "application/json"}
    for n in range(attempts):
        try:
            answer = _call(url, body, head, timeout)
            break
        except OSError as e:
            status = getattr(e, "code", None)
            if n + 1 == attempts or (isinstance(status, int) and status < 500 and status not in (408, 429)):
                raise TidemarkError("http_delivery", str(e)) from e
            time.sleep(0.1 * 2**n)
    if ack_url is None:
        return
    ack, deadline = answer.get("ackId"), time.monotonic() + timeout
    if ack is None:
        raise TidemarkError("http_ack", "no acknowledgment id")
    while time.monotonic() < deadline:
        try:
            if _call(ack_url, json.dumps({"acks": [ack]}).encode(), head, timeout).get("acks", {}).get(str(ack)):
                return
        except OSError:
            pass  # asked again until the deadline
        time.sleep(0.1)
    raise TidemarkError("http_ack", "not acknowledged in time; the batch is uncertain")


def metrics_row(spark: SparkSession, input_id: str, status: str, rows: int | None = None, bytes: int | None = None, duration_ns: int | None = None, error_code: str | None = None) -> DataFrame:
    return metrics_frame(spark, [(input_id, status, rows, bytes, duration_ns, error_code)])


def metrics_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(input_id, status, rows, bytes, duration_ns, error_code) of the inputs of a run."""
    return local(spark, rows, "input_id string, status string, rows long, bytes long, duration_ns long, error_code string")


def write_metrics(metrics: DataFrame, path: str) -> None:
    from ..operators.pages import run_rates

    run_rates(metrics).coalesce(1).write.mode("append").parquet(path)
