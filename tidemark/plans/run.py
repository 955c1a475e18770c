"""Runs from end to end: what is sealed is delivered and committed first, then the inputs are fenced, scanned, sealed,
delivered and committed. Control steps are bulk operations over the shared tables of all inputs; scans run side by side."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..cursor import Cursor
from ..errors import TidemarkError
from ..functions import ids
from ..operators.control import commit_ready, reconcile_pages, record_receipts, replay_fence, require_none, revision_activation, validate_page
from ..operators.pages import PAGE, SCAN, accounting_check, delivered_prefix, stream_digest
from ..scratch import Scratch, local, remove
from ..sources.sinks import metrics_frame, write_metrics
from . import state
from .scan import BatchInput, Identity, Input, described, identities, seal, seal_batch

#: Delivers events(input_id, attempt_id, page, ordinal, event_id, line, ..) and gives receipts(page key, rows).
Send = Callable[[DataFrame], DataFrame]
_KEYS = "input_id string, attempt_id long"
_DONE = f"{_KEYS}, coll_rows long, deliv_rows long, candidate struct<ts_us:bigint,id:bigint>, all_sent boolean"
_DONE_NAMES = ["input_id", "attempt_id", "coll_rows", "deliv_rows", "candidate", "all_sent"]
_PREPARED = "input_id string, mode string, lineage_fp string, cursor_fp string, revision_fp string, schema_fp string"


def read_cursor(spark: SparkSession, root: str, input_id: str) -> tuple[int, Cursor | None]:
    """(generation, position) of an input."""
    row = state.read_cursors(spark, root).where(F.col("input_id") == input_id).first()
    if row is None:
        return 0, None
    return row["generation"], Cursor(row["ts_us"], row["id"]) if row["ts_us"] is not None else None


def _keys(spark: SparkSession, scans: list[tuple[str, int]]) -> DataFrame:
    """The keys of some scans: one open scan for each input at most."""
    return local(spark, scans, _KEYS)


def _reconcile(spark: SparkSession, root: str, events: DataFrame, scans: list[tuple[str, int]]) -> None:
    """Raises if sealed pages of open scans don't fit what is durable of them: pages without events, events without a
    page, other counts than the manifest's or the receipts', another digest, another request than the cursor's."""
    sealed = state.table(spark, root, "manifest").join(_keys(spark, scans), SCAN, "left_semi")
    receipts = state.table(spark, root, "receipts").join(_keys(spark, scans), SCAN, "left_semi")
    told = receipts.select(*PAGE, F.lit(True).alias("told"))
    references = sealed.select(*PAGE).join(told, PAGE, "left").select(*PAGE, F.coalesce("told", F.lit(False)).alias("receipted"))
    found = events.groupBy(*PAGE).agg(F.count("*").alias("rows")).join(told, PAGE, "left")
    found = found.select(*PAGE, "rows", F.when(F.col("told"), "delivered").otherwise("ready").alias("state"))
    last = sealed.groupBy(*SCAN).agg((F.max("page") + 1).alias("next_page"), (~F.max_by("truncated", "page")).alias("complete"))
    require_none(reconcile_pages(references, found, last).where("action not in ('deliver', 'compact')"), "reconcile")
    require_none(accounting_check(events, sealed, receipts), "accounting")
    # what the pages say of themselves, against their events and the cursor that they went on from
    after = F.lag("resume").over(Window.partitionBy(*SCAN).orderBy("page"))
    now = state.read_cursors(spark, root).select("input_id", F.when(F.col("ts_us").isNotNull(), F.struct("ts_us", "id")).alias("at"))
    asked = sealed.withColumn("_after", after).join(now, "input_id", "left").select(*PAGE, "revision_fp", ids.request_fingerprint(F.col("cursor_fp"), F.col("at"), F.col("_after")).alias("request_fp"))
    durable = asked.join(stream_digest(events), PAGE, "left")
    batch_or_bare = (F.col("mode") == "batch") | F.col("cursor_fp").isNull()  # asked for without a cursor, or sealed as a bare frame
    told_of = sealed.join(durable.select(*PAGE, F.col("request_fp").alias("_request")), PAGE).select(*PAGE, "revision_fp", F.when(batch_or_bare, F.col("_request")).otherwise(F.col("request_fp")).alias("request_fp"), "stream_digest")
    require_none(validate_page(told_of, durable), "page_changed")


def deliver(spark: SparkSession, root: str, pages: DataFrame, send: Send, pages_per_send: int = 4096, check: bool = True) -> list[tuple[str, int]]:
    """Sends the pages that have no receipt yet, in order, and records the receipts; gives their scans. Each send reads
    the ranges of its own pages. check: hold what was sealed earlier against what is durable of it first."""
    with Scratch(spark) as scratch:
        wanted = state.table(spark, root, "manifest").join(pages.select(*PAGE).join(state.table(spark, root, "receipts").select(*PAGE), PAGE, "left_anti"), PAGE, "left_semi")
        ends = F.transform("parts", lambda p: p["range"])
        low, high = F.min(F.array_min(ends)).alias("low"), F.max(F.array_max(ends)).alias("high")
        found = wanted.groupBy(*SCAN, "write_id").agg(F.count("*").alias("pages"), low, high).orderBy(*SCAN).collect()  # a row for each open scan
        writes = state.one_write_each([(r["input_id"], r["attempt_id"], r["write_id"]) for r in found])
        if not writes:
            return []
        scans, write_ids = [w[:2] for w in writes], [w[2] for w in writes]
        if check:
            whole = state.table(spark, root, "manifest").join(_keys(spark, scans), SCAN, "left_semi")
            _reconcile(spark, root, state.read_events(spark, root, whole, write_ids), scans)
        if max(r["pages"] for r in found) <= pages_per_send:
            turns = [(wanted, (min(r["low"] for r in found), max(r["high"] for r in found)))]
        else:  # one row per page; a few thousand pages go out at once
            turn = F.floor((F.row_number().over(Window.partitionBy(*SCAN).orderBy("page")) - 1) / pages_per_send).alias("turn")
            wanted = scratch.staged(wanted.select("*", turn), "open")
            turns = [(wanted.where(F.col("turn") == t["turn"]), (t["low"], t["high"])) for t in wanted.groupBy("turn").agg(low, high).orderBy("turn").collect()]
        for mine, ranges in turns:
            part = state.read_events(spark, root, mine, write_ids, ranges).join(mine.select(*PAGE), PAGE, "left_semi")
            told = scratch.staged(send(part), "told")  # sent once, whatever is read of the receipts
            state.append(record_receipts(state.table(spark, root, "receipts"), told.select(*PAGE, "rows")), root, "receipts")
        return scans


def commit(spark: SparkSession, root: str, scans: list[tuple[str, int]], empty: list[tuple[str, int]] = ()) -> None:
    """Moves the cursors of scans whose pages all have receipts; empty: scans that found nothing."""
    pages = state.table(spark, root, "manifest").where("mode = 'rising'").join(_keys(spark, [*scans, *empty]), SCAN)
    told = state.table(spark, root, "receipts").join(_keys(spark, [*scans, *empty]), SCAN, "left_semi").select(*PAGE, F.col("rows").alias("sent"))
    done = pages.join(told, PAGE, "left").groupBy(*SCAN).agg(
        F.sum("rows").alias("coll_rows"), F.sum("sent").alias("deliv_rows"), F.max("candidate").alias("candidate"), F.every(F.col("sent").isNotNull()).alias("all_sent"))
    ends = [*done.select(*_DONE_NAMES).collect(), *[(i, a, 0, 0, None, True) for i, a in empty]]  # a row for each open scan
    done = local(spark, ends, _DONE)
    attempts = done.select(
        *SCAN, (F.col("attempt_id") - 1).alias("generation"), F.lit("completed").alias("collection"), "coll_rows",
        F.when(F.col("all_sent"), "confirmed").otherwise("in_progress").alias("delivery"), F.coalesce("deliv_rows", F.lit(0)).alias("deliv_rows"), "candidate")
    state.append(commit_ready(attempts, state.read_cursors(spark, root)), root, "cursors")


def compact(spark: SparkSession, root: str, scans: list[tuple[str, int]]) -> None:
    """Drops the events of those scans whose pages are all delivered; their manifest and receipts stay."""
    pages = state.table(spark, root, "manifest").join(_keys(spark, scans), SCAN, "left_semi")
    through = delivered_prefix(pages, state.table(spark, root, "receipts").join(_keys(spark, scans), SCAN, "left_semi"))
    last = pages.groupBy(*SCAN).agg(F.max("page").alias("last"), F.first("write_id").alias("write_id"))
    for r in through.join(last, SCAN).where("delivered_through = last").select("write_id").collect():  # a row for each scan
        remove(spark, state.events_path(root, r["write_id"]))


def compact_tables(spark: SparkSession, root: str, keep: int = 16) -> list[str]:
    """Folds each control table that has over `keep` new files into a snapshot; gives their names."""
    return [name for name in state.SCHEMAS if state.compact_table(spark, root, name, keep)]


def _open(spark: SparkSession, root: str) -> list:
    """One row per scan that is sealed but not delivered (unsent) or not committed: at most one an input."""
    told = state.table(spark, root, "receipts").select(*PAGE, F.lit(True).alias("told"))
    now = state.read_cursors(spark, root).select("input_id", "generation")
    pages = state.table(spark, root, "manifest").join(told, PAGE, "left").join(now, "input_id", "left")
    scans = pages.groupBy(*SCAN).agg(
        F.count_if(F.col("told").isNull()).alias("unsent"), F.first("mode").alias("mode"), F.first("revision_fp").alias("revision_fp"),
        ((F.first("mode") == "rising") & (F.first("attempt_id") > F.coalesce(F.first("generation"), F.lit(0)))).alias("behind"))
    return scans.where("unsent > 0 or behind").orderBy(*SCAN).collect()


def recover(spark: SparkSession, root: str, send: Send, keep_events: bool = False, found: list | None = None) -> list[tuple[str, int]]:
    """Delivers and commits what was sealed before; nothing is read from any base. Safe to call at any time. found:
    the open scans to see to; else all."""
    found = _open(spark, root) if found is None else found
    unsent = [(r["input_id"], r["attempt_id"]) for r in found if r["unsent"]]
    if unsent:
        deliver(spark, root, state.table(spark, root, "manifest").join(_keys(spark, unsent), SCAN, "left_semi"), send)
    scans = [(r["input_id"], r["attempt_id"]) for r in found if r["behind"]]
    if scans:
        commit(spark, root, scans)
    both = sorted({*unsent, *scans})
    if both and not keep_events:
        compact(spark, root, both)
    return scans


def _prepared(spark: SparkSession, modes: dict[str, str], known: dict[str, Identity]) -> DataFrame:
    """(input_id, mode, lineage_fp, cursor_fp, revision_fp, schema_fp) of the inputs of a run, in one row each."""
    return local(spark, [(n, modes[n], k.lineage_fp, k.cursor_fp, k.revision_fp, k.schema_fp) for n, k in known.items()], _PREPARED)


def fence(spark: SparkSession, root: str, prepared: DataFrame, open_scans: DataFrame) -> DataFrame:
    """(input_id, action, schema_fp, held_fp) of prepared inputs against the identities they had last.

    action as `revision_activation` gives it, or `schema_drift`: an identity that stays has the schema it had.
    open_scans(input_id, unsent): scans that are sealed and not committed."""
    last = F.max_by(F.struct("lineage_fp", "cursor_fp", "revision_fp", "schema_fp"), "generation").alias("last")
    known = state.table(spark, root, "identities", "input_id").groupBy("input_id").agg(last).select("input_id", "last.*")
    going = open_scans.groupBy("input_id").agg(F.max(F.col("unsent") > 0).alias("_spooled"))
    known = known.join(going, "input_id", "left")
    before = known.select("input_id", "lineage_fp", "cursor_fp", "revision_fp", F.lit(False).alias("active"), F.col("_spooled").isNotNull().alias("spooled"))
    out = revision_activation(prepared, before).join(prepared, "input_id").join(known.select("input_id", F.col("schema_fp").alias("held_fp")), "input_id", "left")
    drift = F.col("action").isin("same", "activate") & (F.col("held_fp") != F.col("schema_fp"))
    return out.withColumn("action", F.when(drift, "schema_drift").otherwise(F.col("action")))


_REFUSED = {"identity_change": "its source, query or cursor columns are other than before", "schema_drift": "its columns' names or types are other than before",
            "blocked_active": "an attempt is going on under another revision", "blocked_spool": "pages of another revision wait for delivery"}


def run_inputs(spark: SparkSession, inputs: list[tuple[Input | BatchInput, DataFrame]], root: str, send: Send, keep_events: bool = False, parallel: int = 8, accept_schema: tuple[str, ...] = ()) -> dict[str, int]:
    """One run over many inputs, `parallel` of which are scanned at a time, each in a scheduler pool of its own (which
    counts where spark.scheduler.mode is FAIR). Whatever goes wrong with one input keeps no other: they are delivered
    and committed, and the first error is raised at the end. Metrics tell of each input; gives the rows that each has sealed.

    An input whose source, query, cursor columns or schema changed under its id is refused; accept_schema names inputs
    that may change their schema in this run. Sealed pages of a batch input are only sent again under the revision
    that they were sealed under; what inputs that aren't in this run have sealed is left alone."""
    names = [inp.input_id for inp, _ in inputs]
    if len(set(names)) < len(names):
        raise TidemarkError("duplicate_input", ", ".join(sorted({n for n in names if names.count(n) > 1})))
    errors: dict[str, Exception] = {}
    told_of = []
    for inp, base in inputs:
        try:
            told_of.append(described(inp, base))
        except Exception as e:  # a base that can't be analyzed, or lacks a column
            errors[inp.input_id] = e
    known = identities(spark, told_of) if told_of else {}
    fresh: list[str] = []
    if known:
        rows = _prepared(spark, {inp.input_id: inp.mode for inp, _ in inputs}, known)
        open_schema = "input_id string, attempt_id long, unsent long, mode string, revision_fp string, behind boolean"
        opened = _open(spark, root)
        if opened:
            ready = local(spark, opened, open_schema)
            acts = {(r["input_id"], r["attempt_id"]): r["action"] for r in replay_fence(ready, rows.select("input_id", "mode", "revision_fp")).collect()}
            for (input_id, attempt), action in acts.items():
                if action == "error:changed":
                    errors[input_id] = TidemarkError("revision_changed", f"{input_id} has pages of another revision, attempt {attempt}")
            recover(spark, root, send, keep_events, [r for r in opened if acts[r["input_id"], r["attempt_id"]] in ("deliver", "leave")])
            opened = _open(spark, root)
        told = fence(spark, root, rows, local(spark, opened, open_schema)).collect()
        for r in told:
            action = "activate" if r["action"] == "schema_drift" and r["input_id"] in accept_schema else r["action"]
            if action in _REFUSED:
                errors.setdefault(r["input_id"], TidemarkError(action, f"{r['input_id']}: {_REFUSED[action]}"))
            elif action in ("create", "activate"):
                fresh.append(r["input_id"])
    cursors = {r["input_id"]: r for r in state.read_cursors(spark, root).where(F.col("input_id").isin(names)).collect()}  # one per input of this run
    if fresh:
        generations = local(spark, [(n, cursors[n]["generation"] if n in cursors else 0) for n in fresh], "input_id string, generation long")
        last = state.table(spark, root, "identities").groupBy("input_id").agg((F.max("generation") + 1).alias("_next"))
        fresh_rows = rows.join(generations, "input_id").join(last, "input_id", "left")
        state.append(fresh_rows.withColumn("generation", F.greatest("generation", F.coalesce("_next", F.lit(0)))), root, "identities")
    began: dict[str, int] = {}
    batches = [inp.input_id for inp, _ in inputs if inp.mode == "batch"]
    tried = {r["input_id"]: r["n"] for r in state.table(spark, root, "manifest").where(F.col("input_id").isin(batches)).groupBy("input_id").agg(F.max("attempt_id").alias("n")).collect()} if batches else {}

    def scan(n: int, inp, base) -> tuple[int, int]:
        """(attempt, rows) of one sealed scan."""
        began[inp.input_id] = time.monotonic_ns()
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"tidemark-{n % parallel}")
        if inp.mode == "batch":
            attempt = (tried.get(inp.input_id) or 0) + 1
            seal_batch(base, inp, attempt, root, known[inp.input_id])
            return attempt, 1
        row = cursors.get(inp.input_id)
        attempt = (row["generation"] if row else 0) + 1
        return attempt, seal(base, inp, attempt, root, Cursor(row["ts_us"], row["id"]) if row and row["ts_us"] is not None else None, known[inp.input_id])

    sealed: list[tuple] = []
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(inputs) or 1))) as pool:
        todo = [(inp, pool.submit(inheritable_thread_target(spark)(scan), n, inp, base)) for n, (inp, base) in enumerate(inputs) if inp.input_id not in errors]
        for inp, job in todo:
            try:
                sealed.append((inp, *job.result()))
            except Exception as e:
                errors[inp.input_id] = e
    took = {n: time.monotonic_ns() - t for n, t in began.items()}
    if errors:
        write_metrics(metrics_frame(spark, [(n, "failed", None, None, took.get(n), getattr(e, "code", type(e).__name__)) for n, e in errors.items()]), f"{root}/metrics")
    if sealed:
        mine = [(i.input_id, a) for i, a, _ in sealed]
        pages = state.table(spark, root, "manifest").join(_keys(spark, mine), SCAN, "left_semi")  # the inputs of this run
        found = {(r["input_id"], r["attempt_id"]): r for r in pages.groupBy(*SCAN).agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).collect()}
        if found:
            deliver(spark, root, pages, send, check=False)  # summed up from what was read back just now
        rising = [(i.input_id, a) for i, a, _ in sealed if i.mode == "rising"]
        if rising:
            commit(spark, root, [s for s in rising if s in found], [s for s in rising if s not in found])
        if found and not keep_events:
            compact(spark, root, list(found))
        done = [(i, found.get((i.input_id, a))) for i, a, _ in sealed]
        write_metrics(metrics_frame(spark, [(i.input_id, "delivered", r["rows"] if r else 0, r["bytes"] if r else 0, took[i.input_id], None) for i, r in done]), f"{root}/metrics")
    compact_tables(spark, root)
    for inp, _ in inputs:
        if inp.input_id in errors:
            raise errors[inp.input_id]
    return {inp.input_id: n for inp, _, n in sealed}


def run_scan(spark: SparkSession, base: DataFrame, inp: Input, root: str, send: Send, keep_events: bool = False) -> Cursor | None:
    """One scan of one input to its end; gives its position. A failure leaves the cursor where it was, and the next
    run delivers what had been sealed before it reads anything new."""
    run_inputs(spark, [(inp, base)], root, send, keep_events)
    return read_cursor(spark, root, inp.input_id)[1]
