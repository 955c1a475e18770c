"""Control tables: reconciliation, fences, activation, attempts, commits, recovery. All are bulk transitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import TidemarkError
from .pages import PAGE, SCAN


def replay_dedup(events: DataFrame, delivered: DataFrame) -> DataFrame:
    """Events whose id wasn't delivered before, each id once. For consumers: before accounting it would hide rows."""
    return events.join(delivered.select("event_id"), "event_id", "left_anti").dropDuplicates(["event_id"])


def reconcile_pages(references: DataFrame, staged: DataFrame, scans: DataFrame) -> DataFrame:
    """(page key, action). references(page key, receipted): durable pages; staged(page key, state 'ready' or
    'delivered', rows); scans(scan key, next_page, complete)."""
    both = references.withColumn("known", F.lit(True)).join(staged, PAGE, "full_outer").join(scans, SCAN, "left")
    orphans = both.where("known is null").groupBy(*SCAN).agg(F.count("*").alias("orphans"))
    both = both.join(orphans, SCAN, "left")
    adoptable = (F.col("state") == "ready") & ~F.coalesce("complete", F.lit(True)) & (F.col("page") == F.col("next_page")) & (F.col("rows") > 0)
    action = (
        F.when(F.col("known") & F.col("receipted") & F.col("state").isNull(), "already_compacted")
        .when(F.col("known") & F.col("receipted") & (F.col("state") == "delivered"), "compact")
        .when(F.col("known") & F.col("receipted"), "error:receipted_but_ready")
        .when(F.col("known") & F.col("state").isNull(), "error:missing")
        .when(F.col("known"), "deliver")
        .when(F.col("orphans") > 1, "error:many_orphans")
        .when(adoptable, "adopt_orphan")
        .otherwise("error:not_adoptable"))
    return both.select(*PAGE, action.alias("action"))


def replay_fence(ready: DataFrame, active: DataFrame) -> DataFrame:
    """ready(input_id, page key.., revision_fp) against active(input_id, mode, revision_fp): what to do with each page."""
    known = active.select("input_id", F.col("mode").alias("_mode"), F.col("revision_fp").alias("_now"))
    action = F.when(F.col("_mode").isNull(), "error:absent").when(F.col("_mode") == "rising", "leave").when(F.col("_now") == F.col("revision_fp"), "deliver").otherwise("error:changed")
    return ready.join(known, "input_id", "left").withColumn("action", action).drop("_mode", "_now")


def schema_diff(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Positions at which (position, name, type, nullable) differ."""
    e = expected.select("position", *[F.col(c).alias(f"expected_{c}") for c in ("name", "type", "nullable")])
    o = observed.select("position", *[F.col(c).alias(f"observed_{c}") for c in ("name", "type", "nullable")])
    same = F.lit(True)
    for c in ("name", "type", "nullable"):
        same &= F.col(f"expected_{c}").eqNullSafe(F.col(f"observed_{c}"))
    return e.join(o, "position", "full_outer").where(~same)


def validate_page(pages: DataFrame, fences: DataFrame) -> DataFrame:
    """Disagreements of pages(page key, revision_fp, request_fp, stream_digest) with what is durable of them."""
    f = fences.select(*PAGE, *[F.col(c).alias(f"_{c}") for c in ("revision_fp", "request_fp", "stream_digest")])
    wrong = [F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in ("revision_fp", "request_fp", "stream_digest")]
    return pages.join(f, PAGE, "left").withColumn("wrong", F.array_compact(F.array(*wrong))).where(F.size("wrong") > 0).select(*PAGE, F.array_join("wrong", ",").alias("wrong"))


def revision_activation(prepared: DataFrame, state: DataFrame) -> DataFrame:
    """prepared(input_id, lineage_fp, cursor_fp, revision_fp) against state(.., active, spooled): the transition."""
    s = state.select("input_id", F.col("lineage_fp").alias("_l"), F.col("cursor_fp").alias("_c"), F.col("revision_fp").alias("_r"), "active", "spooled")
    action = (
        F.when(F.col("_r").isNull(), "create")
        .when((F.col("_l") != F.col("lineage_fp")) | (F.col("_c") != F.col("cursor_fp")), "identity_change")
        .when(F.col("_r") == F.col("revision_fp"), "same")
        .when(F.col("active"), "blocked_active")
        .when(F.col("spooled"), "blocked_spool")
        .otherwise("activate"))
    return prepared.join(s, "input_id", "left").select("input_id", action.alias("action"))


def detached_identities(persisted: DataFrame, configured: DataFrame) -> DataFrame:
    return persisted.select("input_id").distinct().join(configured, "input_id", "left_anti")


def duplicate_input_ids(inputs: DataFrame) -> DataFrame:
    """Ids used by more than one input, disabled ones included."""
    return inputs.where("input_id is not null").groupBy("input_id").agg(F.count("*").alias("n")).where("n > 1")


def start_attempts(inputs: DataFrame, attempts: DataFrame, cursors: DataFrame) -> DataFrame:
    """New attempt rows for enabled inputs without an active attempt, at their current generation."""
    idle = inputs.where("not disabled").join(attempts.where("active"), "input_id", "left_anti")
    last = attempts.groupBy("input_id").agg(F.max("attempt_id").alias("last"))
    return idle.join(cursors.select("input_id", "generation"), "input_id", "left").join(last, "input_id", "left").select(
        "input_id", (F.coalesce("last", F.lit(0)) + 1).alias("attempt_id"), F.coalesce("generation", F.lit(0)).alias("generation"), F.lit("in_progress").alias("collection"), F.lit("in_progress").alias("delivery"))


def adopt_orphans(actions: DataFrame, manifest: DataFrame) -> DataFrame:
    """Reference rows for adopted pages: position, next page, and whether the scan is now complete."""
    adopted = actions.where("action = 'adopt_orphan'").select(*PAGE)
    return manifest.join(adopted, PAGE, "left_semi").select(*PAGE, "rows", "resume", "candidate", (F.col("page") + 1).alias("next_page"), (~F.col("truncated")).alias("complete"))


def record_empty_completion(attempts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Scans in progress that gave no page: complete with no rows and no candidate."""
    return attempts.where("collection = 'in_progress'").join(manifest, SCAN, "left_anti").select(*SCAN, F.lit("completed").alias("collection"), F.lit(0).cast("long").alias("coll_rows"))


def record_receipts(receipts: DataFrame, delivered: DataFrame) -> DataFrame:
    """Receipts to append: each scan's delivered pages that go on from its last receipt without a gap."""
    have = receipts.groupBy(*SCAN).agg(F.max("page").alias("through"))
    new = delivered.join(receipts, PAGE, "left_anti").join(have, SCAN, "left").withColumn("through", F.coalesce("through", F.lit(0)))
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy(*SCAN).orderBy("page"))
    return new.where("page > through").withColumn("n", n).where(F.col("page") == F.col("through") + F.col("n")).select(*PAGE, "rows")


def recovery(attempts: DataFrame) -> DataFrame:
    """attempts(scan key, collection, coll_rows, delivery, deliv_rows): commit, or replay with its first reason."""
    action = (
        F.when(F.col("collection") == "failed", "replay:collection_failed")
        .when(F.col("delivery") == "failed", "replay:delivery_failed")
        .when(F.col("delivery") == "uncertain", "replay:delivery_uncertain")
        .when(F.col("collection") == "in_progress", "replay:collection_in_progress")
        .when(F.col("delivery") == "in_progress", "replay:delivery_in_progress")
        .when(F.col("coll_rows") != F.col("deliv_rows"), "replay:row_count_mismatch")
        .otherwise("commit"))
    return attempts.select(*SCAN, action.alias("action"))


def commit_ready(attempts: DataFrame, cursors: DataFrame) -> DataFrame:
    """Cursor rows to append for attempts that may commit under the current generation.

    attempts has generation and candidate (a struct ts_us, id, null if empty); an empty scan moves only the generation."""
    ready = attempts.join(recovery(attempts).where("action = 'commit'"), SCAN, "left_semi")
    now = cursors.select("input_id", F.col("generation").alias("_g"), F.when(F.col("ts_us").isNotNull(), F.struct("ts_us", "id")).alias("_at"))
    same = ready.join(now, "input_id", "left").where(F.coalesce("_g", F.lit(0)) == F.col("generation"))
    at = F.coalesce("candidate", "_at")
    return same.select("input_id", "attempt_id", (F.col("generation") + 1).alias("generation"), at["ts_us"].alias("ts_us"), at["id"].alias("id"), (F.col("candidate").isNotNull() & F.coalesce(F.col("candidate") > F.col("_at"), F.lit(True))).alias("advanced"))


def compact_pages(events: DataFrame, delivered_through: DataFrame) -> DataFrame:
    """Staged events that must stay: those of pages beyond their scan's delivered prefix."""
    return events.join(delivered_through, SCAN, "left").where(F.col("page") > F.coalesce("delivered_through", F.lit(0))).drop("delivered_through")


def require_none(df: DataFrame, code: str) -> None:
    row = df.first()
    if row is not None:
        raise TidemarkError(code, str(row.asDict()))
