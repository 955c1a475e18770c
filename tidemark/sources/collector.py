"""The HTTP collector as a data source to write to: packed batches are posted in one pass over ordered pages, and the
receipts of a job's pages appear when all of its tasks have delivered, or not at all."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from ..errors import TidemarkError
from ..operators.order import Packer, page_by_page
from ..operators.pages import PAGE
from ..scratch import scratch_dir

NAME = "tidemark_collector"
RECEIPT = "input_id string, attempt_id long, page long, rows long"


@dataclass
class Delivered(WriterCommitMessage):
    """Pages that a task has posted, and how many of their rows."""

    pages: list[tuple]


class _Poster:
    """What a task does with its rows (input_id, attempt_id, page, event): pages come one behind the other."""

    def __init__(self, options: dict):
        self.o = {k.lower(): v for k, v in options.items()}

    def write(self, rows: Iterator) -> Delivered:
        from .sinks import post

        o, done, held, now, n = self.o, [], [], None, 0
        packer = Packer(int(o["maxevents"]), int(o["maxbytes"]))

        def out():
            if held:
                post(o["url"], "\n".join(held).encode("utf-8"), o["token"], float(o["timeout"]), o.get("ackurl"))
                held.clear()

        for r in rows:
            key = (r["input_id"], r["attempt_id"], r["page"])
            if packer.starts(key, len(r["event"].encode("utf-8"))):
                out()
            if key != now:
                if now is not None:
                    done.append((*now, n))
                now, n = key, 0
            held.append(r["event"])
            n += 1
        out()
        return Delivered([*done, (*now, n)] if now is not None else done)

    def receipts(self, messages, name: str) -> None:
        """One file with the receipts of all tasks, under its name once it is whole. Pages are added up, since a
        stream's tasks may share one."""
        import pyarrow as pa
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        rows: dict[tuple, int] = {}
        for m in messages:
            for *key, n in m.pages if m is not None else ():
                rows[tuple(key)] = rows.get(tuple(key), 0) + n
        table = pa.table([[k[0] for k in rows], [k[1] for k in rows], [k[2] for k in rows], list(rows.values())], pa.schema([("input_id", pa.string()), ("attempt_id", pa.int64()), ("page", pa.int64()), ("rows", pa.int64())]))
        where, path = fs.FileSystem.from_uri(self.o["receipts"]) if ":/" in self.o["receipts"] else (fs.LocalFileSystem(), self.o["receipts"])
        where.create_dir(path, recursive=True)
        apart = f"{path}/_{uuid.uuid4().hex}"
        pq.write_table(table, apart, filesystem=where)
        where.move(apart, f"{path}/{name}.parquet")


class _Writer(_Poster, DataSourceWriter):
    def commit(self, messages) -> None:
        self.receipts(messages, uuid.uuid4().hex)

    def abort(self, messages) -> None:
        """No receipts: the pages go out again, and their event ids make that harmless."""


class _StreamWriter(_Poster, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:
        self.receipts(messages, f"batch-{batchId}")  # a batch that is repeated gives the same file again

    def abort(self, messages, batchId: int) -> None:
        pass


class CollectorSource(DataSource):
    """format("tidemark_collector"): url, token, receipts (a folder), maxEvents, maxBytes, timeout, ackUrl."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "input_id string, attempt_id long, page long, event string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return _StreamWriter(dict(self.options))


def collector_options(url: str, token: str, receipts: str, max_events: int = 250, max_bytes: int = 1_000_000, timeout: float = 30, ack_url: str | None = None) -> dict[str, str]:
    if max_events < 1 or max_bytes < 1:
        raise TidemarkError("batch_limit", "batches need at least one event and one byte")
    o = {"url": url, "token": token, "receipts": receipts, "maxEvents": str(max_events), "maxBytes": str(max_bytes), "timeout": str(timeout)}
    return o | ({"ackUrl": ack_url} if ack_url else {})


def http_sink(events: DataFrame, url: str, token: str, max_events: int = 250, max_bytes: int = 1_000_000, timeout: float = 30, ack_url: str | None = None) -> DataFrame:
    """Posts events(input_id, attempt_id, page, ordinal, event) in packed batches, one request each, and gives the
    receipts (page key, rows) once all have gone out. The events are shuffled once, into the order of their pages."""
    spark = events.sparkSession
    spark.dataSource.register(CollectorSource)
    path = scratch_dir(spark, "receipts")
    ordered = page_by_page(events, PAGE, "event").select(F.col("input_id").cast("string"), F.col("attempt_id").cast("long"), F.col("page").cast("long"), "event")
    ordered.write.format(NAME).options(**collector_options(url, token, path, max_events, max_bytes, timeout, ack_url)).mode("append").save()
    return spark.read.schema(RECEIPT).parquet(path)
