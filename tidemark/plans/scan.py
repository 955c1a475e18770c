"""Scans: one pass reads the rows past a bound, deals them out by ranges of the cursor, checks, encodes and writes them.

What the checks count is observed while that write runs. Ordinals are the places in a range plus the rows of the
ranges before, so nothing is written again: a sealed scan's manifest says where its pages lie in what was written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..cursor import Cursor, CursorSpec, apply_bound, below_bound, null_cursor, ts_us
from ..errors import TidemarkError
from ..functions import ids
from ..functions.encode import ndjson_line
from ..operators import checks
from ..operators.inputs import pagination_guard
from ..operators.order import byte_limit
from ..operators.pages import PAGE, SCAN, page_summary, staged_usage, stream_digest
from ..operators.schema import check_cursor_schema, check_schema, schema_fingerprint
from ..scratch import Scratch, local, remove, scratch_dir, staged
from ..sources.base import batch_scan
from . import state

#: Most rows of a scan that is to be bounded, unless its input allows more: a guard against lots larger than meant.
MOST_SCAN_ROWS = 1_000_000
#: Bits of the buckets that cursors are counted in to find a position; rows that are few enough to be sorted at once.
_BUCKET_BITS, _FEW_ROWS = 12, 100_000


@dataclass(frozen=True)
class Input:
    """A rising input: its identity, what it reads, and its limits. max_staged: bytes that may wait for delivery;
    max_scan_rows: rows that one scan takes, the next ones then wait for the next scan; it is refused over
    most_scan_rows."""

    input_id: str
    spec: CursorSpec
    columns: tuple[str, ...]
    connector: str = "spark"
    query: str = ""
    max_rows: int = 100_000
    max_bytes: int = 1 << 30
    max_staged: int | None = None
    max_scan_rows: int | None = None
    most_scan_rows: int = MOST_SCAN_ROWS
    host: str = ""
    database: str = ""
    username: str = ""
    mode = "rising"

    def fingerprints(self):
        """(input key, lineage, cursor identity) as hex columns."""
        return (ids.input_key(F.lit(self.input_id)), *_lineage(self), ids.cursor_fingerprint(F.lit(self.spec.ts), F.lit(self.spec.id)))


@dataclass(frozen=True)
class BatchInput:
    """A batch input: the first max_rows rows of a query in a stated order, under an id of the run."""

    input_id: str
    batch_id: str
    columns: tuple[str, ...]
    order: tuple[Column, ...]
    max_rows: int = 100_000
    max_bytes: int = 1 << 30
    max_staged: int | None = None
    connector: str = "spark"
    query: str = ""
    host: str = ""
    database: str = ""
    username: str = ""
    mode = "batch"

    def fingerprints(self):
        return (ids.input_key(F.lit(self.input_id)), *_lineage(self), ids.cursor_fingerprint(F.lit(""), F.lit("")))


def _lineage(inp) -> tuple[Column]:
    lit = F.lit
    q = ids.query_fingerprint(lit(inp.connector), lit(inp.query))
    return (ids.lineage_fingerprint(lit(inp.mode), lit(inp.input_id), lit(inp.connector), lit(inp.host), lit(inp.database), lit(inp.username), q),)


@dataclass(frozen=True)
class Identity:
    """Fingerprints of an input and the columns that it reads, as hex."""

    input_key: str
    lineage_fp: str
    cursor_fp: str
    revision_fp: str
    schema_fp: str


def described(inp: Input | BatchInput, base: DataFrame) -> tuple:
    """What an input's fingerprints are made of; raises if its base can't be analyzed or lacks a column."""
    at = (inp.spec.ts, inp.spec.id, inp.spec.overlap_us) if isinstance(inp, Input) else ("", "", 0)
    fields = dict.fromkeys([*inp.columns, *(at[:2] if isinstance(inp, Input) else ())])
    schema = schema_fingerprint([base.schema[c] for c in fields])
    return (inp.input_id, inp.mode, inp.connector, inp.query, inp.host, inp.database, inp.username, *at, inp.max_rows, inp.max_bytes, schema)


def identities(spark: SparkSession, inputs: list[tuple]) -> dict[str, Identity]:
    """The identities of `described` inputs, by input: one expression over a row for each of them."""
    texts = ", ".join(f"{c} string" for c in ("input_id", "mode", "connector", "query", "host", "database", "username", "ts", "id"))
    rows = local(spark, inputs, f"{texts}, overlap long, max_rows long, max_bytes long, schema_fp string")
    c = F.col
    query_fp = ids.query_fingerprint(c("connector"), c("query"))
    lineage = ids.lineage_fingerprint(c("mode"), c("input_id"), c("connector"), c("host"), c("database"), c("username"), query_fp)
    rows = rows.withColumns({"input_key": ids.input_key(c("input_id")), "lineage_fp": lineage, "cursor_fp": ids.cursor_fingerprint(c("ts"), c("id"))})
    rows = rows.withColumn("revision_fp", ids.revision_fingerprint(c("lineage_fp"), c("cursor_fp"), c("overlap"), c("max_rows"), c("max_bytes"), F.lit(False)))
    found = rows.select("input_id", "input_key", "lineage_fp", "cursor_fp", "revision_fp", "schema_fp").collect()  # a row for each input of a run
    return {r["input_id"]: Identity(*r[1:]) for r in found}


def _identity(inp: Input | BatchInput, base: DataFrame) -> Identity:
    return identities(base.sparkSession, [described(inp, base)])[inp.input_id]


@dataclass(frozen=True)
class Written:
    """What one pass has written at `path`: rows, what its checks counted as (code, column, rows), and the ranges as
    (range, rows before it, rows in it)."""

    path: str
    rows: int
    counts: list[tuple[str, str, int]]
    ranges: list[tuple[int, int, int]]


def _bucket_of(rows: DataFrame, c: str, n: int, lo: int, hi: int, few: int) -> tuple[int, int, int, int]:
    """(first, last, rows before, rows) of a range of the whole-number column c that the n-th smallest row lies in: one
    value, or a range of at most `few` rows. Buckets are counted, finer ones within the one that holds the row."""
    before, inside = 0, None
    while lo < hi and (inside is None or inside > few):
        shift = max(0, (hi - lo).bit_length() - _BUCKET_BITS)
        buckets = rows.where(F.col(c).between(lo, hi)).groupBy(F.shiftright(c, shift).alias("b")).agg(F.count("*").alias("n"))
        for r in buckets.orderBy("b").collect():  # 2 ** _BUCKET_BITS + 1 rows at most
            at, inside = r["b"], r["n"]
            if before + inside >= n:
                break
            before += inside
        lo, hi = max(lo, at << shift), min(hi, ((at + 1) << shift) - 1)
    return lo, hi, before, inside


def last_position(base: DataFrame, inp: Input, committed: Cursor | None, few: int = _FEW_ROWS) -> Cursor | None:
    """Where a scan of at most max_scan_rows rows ends; None if all rows past the bound fit. Reads the cursor columns
    and counts them in ranges; no more than `few` rows are sorted, whatever max_scan_rows is."""
    if not 1 <= inp.max_scan_rows <= inp.most_scan_rows:
        raise TidemarkError("scan_rows", f"max_scan_rows must be 1..{inp.most_scan_rows}")
    spec, names = inp.spec, dict.fromkeys([inp.spec.ts, inp.spec.id, *(c for c, _ in inp.spec.partitions)])
    kept = apply_bound(base.select(*[F.col(f"`{c}`") for c in names]), spec, spec.bound(committed)).where(~null_cursor(spec))
    rows = kept.select(ts_us(kept, spec).alias("ts_us"), F.col(f"`{spec.id}`").alias("id"))
    ends = rows.agg(F.count("*").alias("n"), *[f(c).alias(f"{k}_{c}") for c in ("ts_us", "id") for k, f in (("lo", F.min), ("hi", F.max))]).first()
    if ends["n"] <= inp.max_scan_rows:
        return None
    n, near, inside = inp.max_scan_rows + 1, rows, ends["n"]  # the first row that doesn't fit
    for c in ("ts_us", "id"):  # ids count where very many rows share a timestamp
        if inside > few:
            lo, hi, before, found = _bucket_of(near, c, n, ends[f"lo_{c}"], ends[f"hi_{c}"], few)
            near, n, inside = near.where(F.col(c).between(lo, hi)), n - before, inside if found is None else found
    if inside > few:  # one position
        over = near.first()
    else:
        over = near.orderBy("ts_us", "id").limit(n).agg(F.max(F.struct("ts_us", "id")).alias("at")).first()["at"]
    first = (F.col("ts_us") < over["ts_us"]) | ((F.col("ts_us") == over["ts_us"]) & (F.col("id") < over["id"]))
    last = rows.where(first).agg(F.max(F.struct("ts_us", "id")).alias("at")).first()["at"]
    return Cursor(last["ts_us"], last["id"]) if last else None


def write_pass(base: DataFrame, inp: Input, path: str, committed: Cursor | None = None, resume_after: Cursor | None = None, buckets: int | None = None, last: Cursor | None = None, known: Identity | None = None) -> Written:
    """Reads base once and writes its rows past the bound once, as state.STORED has them, ordered by ranges.

    The first shuffle's output is what the ranges are sampled from and dealt out of, so the base isn't read for the
    sample. Equal positions share a range, so repeats show up without a shuffle of their own."""
    spark, spec = base.sparkSession, inp.spec
    bound = spec.bound(committed, resume_after)
    names = list(dict.fromkeys([*inp.columns, spec.ts, spec.id]))
    kept = apply_bound(base.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*names, *(c for c, _ in spec.partitions)])]), spec, bound, last)
    held = kept.withColumn("_low", below_bound(kept, spec, bound)).repartition(F.col(f"`{spec.id}`"))
    rows = held.select(ts_us(kept, spec).alias("ts_us"), F.col(f"`{spec.id}`").alias("id"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("_low").alias("low"))
    order = [F.col("ts_us").asc_nulls_first(), F.col("id").asc_nulls_first()]
    ranged = rows.repartitionByRange(*([] if buckets is None else [buckets]), *order).sortWithinPartitions(*order)
    key, lineage, cursor_fp = inp.fingerprints() if known is None else (F.lit(fp) for fp in (known.input_key, known.lineage_fp, known.cursor_fp))
    line = ndjson_line(rows.select("row.*"), list(inp.columns), inside="row")
    made = ranged.withColumn("twice", F.count("*").over(Window.partitionBy("ts_us", "id")) > 1).withColumns({
        "event_id": ids.rising_event_id(key, lineage, cursor_fp, F.col("ts_us"), F.col("id")), "line": line})
    null = F.col("ts_us").isNull() | F.col("id").isNull()
    told = {"null_cursor": null, "below_bound": F.col("low"), "duplicate": F.col("twice") & ~null}
    rejects = checks.rejected(rows.schema["row"].dataType, list(inp.columns), "row")
    told |= {f"reject{n}": bad for n, (_, _, bad) in enumerate(rejects)}
    seen = Observation()
    observed = made.observe(seen, F.count("*").alias("rows"), *[F.count_if(bad).alias(k) for k, bad in told.items()])
    at = F.monotonically_increasing_id()
    observed.select(
        F.shiftright(at, 33).cast("int").alias("range"), (at.bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("place"), "ts_us", "id", "event_id",
        F.coalesce("line", F.lit("")).alias("line"), F.coalesce(F.octet_length("line"), F.lit(0)).cast("long").alias("line_bytes")).write.parquet(path)
    counted = spark.read.schema(state.STORED).parquet(path).groupBy("range").agg(F.count("*").alias("n")).orderBy("range").collect()  # a row per range
    ranges, before = [], 0
    for r in counted:
        ranges.append((r["range"], before, r["n"]))
        before += r["n"]
    got = seen.get if before else {}
    what = [(k, "", k) for k in ("null_cursor", "below_bound", "duplicate")] + [(reason, f" in {name}", f"reject{n}") for n, (name, reason, _) in enumerate(rejects)]
    return Written(path, before, [(code, where, got.get(k) or 0) for code, where, k in what], ranges)


def require_clean(written: Written) -> None:
    """Raises on the first broken rule of a pass: null, low and repeated cursors, then values that don't encode."""
    for code, where, n in written.counts:
        if n:
            raise TidemarkError(code, f"{n} rows{where}")


def _numbered(spark: SparkSession, w: Written, max_rows: int) -> DataFrame:
    before = F.broadcast(local(spark, [(r, b) for r, b, _ in w.ranges], "range int, before long"))  # a row per range
    ordinal = F.col("place") + F.col("before")
    page = (F.floor((ordinal - 1) / F.lit(max_rows)) + 1).cast("long")
    rows = spark.read.schema(state.STORED).parquet(w.path).join(before, "range")
    return rows.select(page.alias("page"), ordinal.alias("ordinal"), "ts_us", "id", "event_id", "line", "line_bytes", (page < -(-w.rows // max_rows)).alias("truncated"))


def rising_scan(base: DataFrame, inp: Input, committed: Cursor | None = None, resume_after: Cursor | None = None, buckets: int | None = None) -> DataFrame:
    """(page, ordinal, ts_us, id, event_id, line, line_bytes, truncated) of all rows past the bound.

    The base is read once and the rows are written once. Nothing that the pass counts is judged: see `checked_scan`."""
    spark = base.sparkSession
    return _numbered(spark, write_pass(base, inp, scratch_dir(spark, "scan"), committed, resume_after, buckets), inp.max_rows)


def check_base(base: DataFrame, inp: Input) -> None:
    """What can be told of a base before it is read: its schema, its limits, its cursor's types."""
    pagination_guard(base)
    check_schema(base.schema)
    check_cursor_schema(base, inp.spec)


def checked_scan(base: DataFrame, inp: Input, committed: Cursor | None = None, resume_after: Cursor | None = None, buckets: int | None = None) -> DataFrame:
    """rising_scan after every check has passed: schema, limits of the base, null, low and repeated cursors, lossless
    encoding. What is checked are the rows that were written. Any failure raises."""
    check_base(base, inp)
    spark = base.sparkSession
    w = write_pass(base, inp, scratch_dir(spark, "scan"), committed, resume_after, buckets)
    require_clean(w)
    return _numbered(spark, w, inp.max_rows)


def checked_batch(base: DataFrame, inp: BatchInput, keep=staged) -> DataFrame:
    """The rows of a batch run as one page, checked like a rising scan; they have no cursor. keep(df, name) stages them."""
    check_schema(base.schema)
    copy = keep(batch_scan(base, list(inp.order), inp.max_rows), "read")  # at most max_rows rows
    checks.require_lossless(copy, list(inp.columns))
    n = F.row_number().over(Window.orderBy(*inp.order))
    line = ndjson_line(copy, list(inp.columns))
    rows = copy.select(n.cast("long").alias("ordinal"), line.alias("line"), "truncated")
    key, batch = ids.input_key(F.lit(inp.input_id)), F.sha2(F.lit(inp.batch_id), 256)
    none = F.lit(None).cast("long")
    return rows.select(F.lit(1).cast("long").alias("page"), "ordinal", none.alias("ts_us"), none.alias("id"), ids.batch_event_id(key, batch, F.col("ordinal")).alias("event_id"), "line", F.octet_length("line").cast("long").alias("line_bytes"), "truncated")


def _seal(spark: SparkSession, root: str, inp: Input | BatchInput, attempt_id: int, write_id: str, before: list[tuple[int, int]], committed: Cursor | None, known: Identity | None) -> None:
    """Sums up what a write holds in the manifest of the attempt, checks the limits, and makes the attempt visible."""
    parts = F.broadcast(local(spark, before, "range int, before long"))  # a row per range
    stored = spark.read.schema(state.STORED).parquet(state.events_path(root, write_id)).join(parts, "range")
    ordinal = F.col("place") + F.col("before")
    rows = stored.select(
        F.lit(inp.input_id).alias("input_id"), F.lit(attempt_id).cast("long").alias("attempt_id"), (F.floor((ordinal - 1) / F.lit(inp.max_rows)) + 1).cast("long").alias("page"),
        ordinal.alias("ordinal"), "range", "before", "ts_us", "id", "line", "line_bytes")
    lies = F.sort_array(F.collect_set(F.struct("range", "before"))).alias("parts")  # the ranges of a page
    pages = page_summary(rows, None, lies).join(stream_digest(rows), PAGE)
    at = F.struct(F.lit(committed.ts_us).cast("long").alias("ts_us"), F.lit(committed.id).cast("long").alias("id")) if committed else F.lit(None).cast("struct<ts_us:bigint,id:bigint>")
    pages = pages.withColumns({"mode": F.lit(inp.mode), "write_id": F.lit(write_id), "page_rows": F.lit(inp.max_rows).cast("long"), "committed": at, "candidate": F.greatest("resume", at)})
    if inp.mode == "batch":  # rows without a cursor
        pages = pages.withColumns({c: F.when(F.lit(False), F.col(c)) for c in ("resume", "candidate")})
    pages = pages.withColumns({c: F.lit(getattr(known, c, None)).cast("string") for c in ("lineage_fp", "cursor_fp", "revision_fp", "schema_fp")})
    # what was asked for: the page after the one before
    resumed = F.lag("resume").over(Window.partitionBy(*SCAN).orderBy("page"))
    pages = pages.withColumn("_after", resumed).withColumn("request_fp", ids.request_fingerprint(F.col("cursor_fp"), F.col("committed"), F.col("_after")))

    def check(sealed: DataFrame) -> None:
        if not sealed.where(F.col("bytes") > inp.max_bytes).isEmpty():
            over = byte_limit(rows, ["page"], inp.max_bytes).first()
            raise TidemarkError("byte_limit", f"page {over['page']} exceeds {inp.max_bytes} bytes at row {over['first_over']}")
        if inp.max_staged is not None:
            waiting = state.table(spark, root, "manifest").join(state.table(spark, root, "receipts"), PAGE, "left_anti").where(F.col("input_id") == inp.input_id)
            if not staged_usage(waiting.select("input_id", "bytes").union(sealed.select("input_id", "bytes")), inp.max_staged, 1 << 62).where("over").isEmpty():
                raise TidemarkError("staging_quota", f"{inp.input_id} would have over {inp.max_staged} bytes waiting")

    state.seal_manifest(pages, root, inp.input_id, attempt_id, write_id, check)


def _not_sealed(spark: SparkSession, root: str, inp, attempt_id: int) -> None:
    mine = (F.col("input_id") == inp.input_id) & (F.col("attempt_id") == attempt_id)
    if not state.table(spark, root, "manifest").where(mine).isEmpty():
        raise TidemarkError("already_sealed", f"attempt {attempt_id} of {inp.input_id}")


def seal(base: DataFrame, inp: Input, attempt_id: int, root: str, committed: Cursor | None = None, known: Identity | None = None) -> int:
    """A checked scan whose rows are written once, where they stay: gives the rows, sealed if there are any. known: the
    input's identity, if it is at hand.

    Each write has a folder of its own, and of two writers of one attempt one seals it; the other raises, and
    whatever a failed one has written is removed."""
    spark = base.sparkSession
    check_base(base, inp)
    known = known or _identity(inp, base)
    write_id = state.new_write_id()
    path = state.events_path(root, write_id)
    try:
        last = last_position(base, inp, committed) if inp.max_scan_rows is not None else None
        w = write_pass(base, inp, path, committed, last=last, known=known)
        require_clean(w)
        if w.rows:
            _seal(spark, root, inp, attempt_id, write_id, [(r, b) for r, b, _ in w.ranges], committed, known)
        else:
            remove(spark, path)
        return w.rows
    except Exception:
        remove(spark, path)
        raise


def publish(scan: DataFrame, inp: Input | BatchInput, attempt_id: int, root: str, committed: Cursor | None = None, known: Identity | None = None) -> None:
    """Seals a scan that is at hand as a frame (page, ordinal, ..), as `seal` does with what it has written itself."""
    spark = scan.sparkSession
    _not_sealed(spark, root, inp, attempt_id)
    write_id = state.new_write_id()
    path = state.events_path(root, write_id)
    try:
        scan.select(F.lit(0).alias("range"), F.col("ordinal").alias("place"), *state.names(state.STORED)[2:]).write.parquet(path)
        _seal(spark, root, inp, attempt_id, write_id, [(0, 0)], committed, known)
    except Exception:
        remove(spark, path)
        raise


def seal_batch(base: DataFrame, inp: BatchInput, attempt_id: int, root: str, known: Identity | None = None) -> None:
    """A batch run, checked and sealed."""
    with Scratch(base.sparkSession) as scratch:
        publish(checked_batch(base, inp, scratch.staged), inp, attempt_id, root, known=known or _identity(inp, base))
