"""Durable tables of scans below one root: events of sealed attempts, manifest, receipts, cursors, identities, metrics.

Events lie in a folder of their own for each write (`events/scan=<write id>`), as they were written: by range and
place in it. The manifest names the write of a sealed attempt, and for each page the ranges that it lies in with the
rows before them, which give ordinals and pages. The manifest of an attempt is one file, named by input and attempt,
moved to its place if that is free: of two writers of one attempt the file system lets one seal it.

Control tables grow by files. `compact_table` folds them into a numbered snapshot that names the files it holds;
readers take the newest complete snapshot and the files that it doesn't name.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import TidemarkError
from ..operators.pages import PAGE, SCAN, current_cursor
from ..scratch import bytes_in, exists, local, names_in, remove, rename_new

#: Bytes up to which a control table is read as one partition, so that what it joins with and groups by isn't shuffled.
ONE_PARTITION = 32 << 20
#: Bytes of files for each part that a larger table is dealt out into: about 0.8 million rows, 0.1 GB where they're sorted.
PART_BYTES = 4 << 20

_AT = "struct<ts_us:bigint,id:bigint>"
_PARTS = "array<struct<range:int,before:bigint>>"
SCHEMAS = {
    "manifest": f"input_id string, attempt_id long, page long, mode string, rows long, bytes long, resume {_AT}, truncated boolean, candidate {_AT}, stream_digest string, write_id string, page_rows long, parts {_PARTS}, committed {_AT}, lineage_fp string, cursor_fp string, revision_fp string, request_fp string, schema_fp string",
    "receipts": "input_id string, attempt_id long, page long, rows long",
    "cursors": "input_id string, generation long, attempt_id long, ts_us long, id long",
    "identities": "input_id string, generation long, mode string, lineage_fp string, cursor_fp string, revision_fp string, schema_fp string",
    "metrics": "input_id string, status string, rows long, bytes long, duration_ns long, error_code string, rows_per_second long, bytes_per_second long",
}
#: Events as they are stored: the range of (timestamp, id) that a task wrote, and the place in it from 1.
STORED = "range int, place long, ts_us long, id long, event_id string, line string, line_bytes long"
#: Events as they are read.
EVENTS = "page long, ordinal long, ts_us long, id long, event_id string, line string, line_bytes long"


#: Tables of which a snapshot keeps the latest generation of each input.
_CURRENT = ("cursors", "identities")


def names(schema: str) -> list[str]:
    """Column names of a schema text."""
    return [c.strip().split(" ")[0] for c in schema.replace(_AT, "").replace(_PARTS, "").split(", ")]


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return local(spark, [], schema)


def _size(spark: SparkSession, paths: list[str]) -> int:
    return sum(bytes_in(spark, p) for p in paths)


def _found(spark: SparkSession, paths: list[str], schema: str, by: str | None = None) -> DataFrame:
    paths = [p for p in paths if exists(spark, p)]
    if not paths:
        return empty(spark, schema)
    rows = spark.read.schema(schema).parquet(*paths)
    size = _size(spark, paths)
    if size <= ONE_PARTITION:
        return rows.coalesce(1)
    return rows if by is None else rows.repartition(-(-size // PART_BYTES), by)


def _snapshot(spark: SparkSession, root: str, name: str) -> tuple[int, str | None, set[str]]:
    """(number, path, names of files that it holds) of the newest complete snapshot of a table."""
    folder = f"{root}/{name}.snapshots"
    done = [int(n) for n in names_in(spark, folder) if n.isdigit() and exists(spark, f"{folder}/{n}/rows/_SUCCESS") and exists(spark, f"{folder}/{n}/files/_SUCCESS")]
    if not done:
        return 0, None, set()
    top = f"{folder}/{max(done)}"
    return max(done), f"{top}/rows", {r["value"] for r in spark.read.text(f"{top}/files").collect()}  # a name for each run since the snapshot before


def table(spark: SparkSession, root: str, name: str, by: str | None = None) -> DataFrame:
    """A control table; empty if nothing was written yet.

    by: a column that a table read in parts is dealt out by before it is grouped by it. Files hold few bytes a row, so
    a grouping that sorts what it reads of them would take many times their size in one task."""
    _, snapshot, held = _snapshot(spark, root, name)
    if snapshot is None:
        return _found(spark, [f"{root}/{name}"], SCHEMAS[name], by)
    tail = [f"{root}/{name}/{f}" for f in names_in(spark, f"{root}/{name}") if f.endswith(".parquet") and f not in held]
    return _found(spark, [snapshot, *tail], SCHEMAS[name], by)


def append(df: DataFrame, root: str, name: str, large: bool = False) -> None:
    """Appends rows to a control table in one commit: as one file, or, if they are many, as files of about one size."""
    rows = df.select(*names(SCHEMAS[name]))
    (rows.hint("rebalance", "input_id") if large else rows.coalesce(1)).write.mode("append").parquet(f"{root}/{name}")


def compact_table(spark: SparkSession, root: str, name: str, keep: int = 16) -> bool:
    """Folds a control table's files into a new snapshot, if there are over `keep` besides the last one.

    The files of the new snapshot stay until the next one is made, so a reader that still uses the last one finds all
    of its files. One process should compact a root; two at once fail without harm, since a snapshot's folder is new."""
    number, snapshot, held = _snapshot(spark, root, name)
    files = [f for f in names_in(spark, f"{root}/{name}") if f.endswith(".parquet")]
    new = [f for f in files if f not in held]
    if len(new) <= keep:
        return False
    folder = f"{root}/{name}.snapshots"
    paths = [*([snapshot] if snapshot else []), *[f"{root}/{name}/{f}" for f in new]]
    rows = current_rows(_found(spark, paths, SCHEMAS[name], "input_id" if name in _CURRENT else None), name)
    (rows.coalesce(1) if _size(spark, paths) <= ONE_PARTITION else rows.hint("rebalance", "input_id")).write.parquet(f"{folder}/{number + 1}/rows")
    local(spark, [(f,) for f in new], "value string").write.text(f"{folder}/{number + 1}/files")
    for f in held:  # of the last snapshot: no reader that begins now needs them
        remove(spark, f"{root}/{name}/{f}")
    if number > 1:
        remove(spark, f"{folder}/{number - 1}")
    return True


def current_rows(rows: DataFrame, name: str) -> DataFrame:
    """What a snapshot keeps of a table: of cursors and identities the latest generation of each input, else all."""
    if name not in _CURRENT:
        return rows
    last = F.max_by(F.struct(*[c for c in rows.columns if c != "input_id"]), "generation").alias("last")
    return rows.groupBy("input_id").agg(last).select("input_id", "last.*").select(*rows.columns)


def events_path(root: str, write_id: str) -> str:
    return f"{root}/events/scan={write_id}"


def seal_manifest(pages: DataFrame, root: str, input_id: str, attempt_id: int, write_id: str, check=lambda rows: None) -> None:
    """Makes an attempt visible: its manifest is written apart, checked, and moved to the name of that attempt, which
    only one writer can do."""
    spark = pages.sparkSession
    apart = f"{root}/unsealed/{write_id}"
    try:
        pages.select(*names(SCHEMAS["manifest"])).coalesce(1).write.parquet(apart)
        check(spark.read.schema(SCHEMAS["manifest"]).parquet(apart))
        (part,) = [n for n in names_in(spark, apart) if n.endswith(".parquet")]
        name = f"{hashlib.sha256(input_id.encode()).hexdigest()[:32]}@{attempt_id}.parquet"
        if not rename_new(spark, f"{apart}/{part}", f"{root}/manifest/{name}"):
            raise TidemarkError("already_sealed", f"attempt {attempt_id} of {input_id}")
    finally:
        remove(spark, apart)


def one_write_each(found: list[tuple[str, int, str]]) -> list[tuple[str, int, str]]:
    """(input_id, attempt_id, write_id) in order, as they are; an attempt that two writes claim is an error."""
    for a, b in zip(found, found[1:]):
        if a[:2] == b[:2]:
            raise TidemarkError("two_writers", f"attempt {a[1]} of {a[0]} was sealed by two writers")
    return found


def writes(manifest: DataFrame) -> list[tuple[str, int, str]]:
    """(input_id, attempt_id, write_id) of the scans of some manifest rows."""
    return one_write_each([tuple(r) for r in manifest.select(*SCAN, "write_id").distinct().orderBy(*SCAN, "write_id").collect()])


def read_events(spark: SparkSession, root: str, pages: DataFrame, write_ids: list[str], ranges: tuple[int, int] | None = None) -> DataFrame:
    """Events of the writes that `pages` (manifest rows) name, with input, attempt, page and ordinal, in one scan.

    ranges: the first and last range to read, which files' statistics rule on."""
    schema = f"input_id string, attempt_id long, {EVENTS}"
    paths = [p for w in write_ids if exists(spark, p := events_path(root, w))]
    if not paths:
        return empty(spark, schema)
    rows = spark.read.schema(f"{STORED}, scan string").option("basePath", f"{root}/events").parquet(*paths)
    if ranges:
        rows = rows.where(F.col("range").between(*ranges))
    at = pages.select(*SCAN, F.col("write_id").alias("scan"), "page_rows", F.explode("parts").alias("part")).select(*SCAN, "scan", "page_rows", "part.range", "part.before").distinct()
    rows = rows.join(at, ["scan", "range"])  # a row for each range
    ordinal = F.col("place") + F.col("before")
    return rows.select(*SCAN, (F.floor((ordinal - 1) / F.col("page_rows")) + 1).cast("long").alias("page"), ordinal.alias("ordinal"), *names(EVENTS)[2:])


def events(spark: SparkSession, root: str, scans: list[tuple[str, int]]) -> DataFrame:
    """Events of these attempts."""
    if not scans:
        return empty(spark, f"input_id string, attempt_id long, {EVENTS}")
    sealed = table(spark, root, "manifest").join(local(spark, scans, "input_id string, attempt_id long"), SCAN, "left_semi")  # the scans named
    return read_events(spark, root, sealed, [w for _, _, w in writes(sealed)])


def read_cursors(spark: SparkSession, root: str) -> DataFrame:
    """(input_id, generation, ts_us, id): where each input stands."""
    return current_cursor(table(spark, root, "cursors", "input_id"))


def new_write_id() -> str:
    return uuid.uuid4().hex


def drop_events(spark: SparkSession, root: str, scans: list[tuple[str, int]]) -> None:
    """Removes the events of these attempts."""
    keys = local(spark, scans, "input_id string, attempt_id long")
    for _, _, w in writes(table(spark, root, "manifest").join(keys, SCAN, "left_semi")) if scans else ():
        remove(spark, events_path(root, w))


