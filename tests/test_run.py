"""Fences, writers, side-by-side inputs, and control tables of whole runs."""

import threading
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.cursor import Bound, Cursor, CursorSpec, apply_bound
from tidemark.errors import TidemarkError
from tidemark.plans import run, scan, state
from tidemark.plans.run import read_cursor, recover, run_inputs, run_scan
from tidemark.plans.scan import BatchInput, Input, checked_scan, publish, seal, write_pass
from tidemark.scratch import exists, local, names_in
from tidemark.streaming.stream import rising_stream

PAGE = ["input_id", "attempt_id", "page"]
INPUT = Input("in", CursorSpec("ts", "id"), ("id", "v"), max_rows=4)


def rows(spark, lo, hi):
    return spark.createDataFrame([(datetime(2024, 1, 1) + timedelta(seconds=i // 3), i, f"v{i}") for i in range(lo, hi)], "ts timestamp, id long, v string")


def receipts(events):
    return events.groupBy(*PAGE).agg(F.count("*").alias("rows"))


def down(_):
    raise ConnectionError("down")


def codes(spark, root):
    return sorted((r["input_id"], r["status"], r["error_code"]) for r in state.table(spark, root, "metrics").collect())


def test_one_pass_counts_what_the_checks_need(spark, tmp_path):
    base = rows(spark, 0, 30).union(rows(spark, 5, 7)).union(spark.createDataFrame([(None, 1, "x"), (datetime(2024, 1, 1), None, "y")], "ts timestamp, id long, v string"))
    base = base.withColumn("f", F.when(F.col("id") % 10 == 0, float("nan")).otherwise(1.0)).withColumn("f__x", F.col("f"))
    w = write_pass(base, Input("in", INPUT.spec, ("id", "v", "f", "f__x")), str(tmp_path / "w"), buckets=3)
    assert w.rows == 34 and w.counts == [("null_cursor", "", 2), ("below_bound", "", 0), ("duplicate", "", 4), ("not_finite", " in f", 3), ("not_finite", " in f__x", 3)]
    assert [b for _, b, _ in w.ranges] == [sum(n for _, _, n in w.ranges[:i]) for i in range(len(w.ranges))] and sum(n for _, _, n in w.ranges) == 34
    with pytest.raises(TidemarkError, match="null_cursor"):
        scan.require_clean(w)
    assert write_pass(rows(spark, 0, 0), INPUT, str(tmp_path / "e")).counts == [("null_cursor", "", 0), ("below_bound", "", 0), ("duplicate", "", 0)]


def test_rows_are_written_once(spark, tmp_path):
    """Of everything that is written, the lines are in one table: the one that the pages are read from."""
    root, wrote = str(tmp_path / "state"), []
    before = {str(p) for p in tmp_path.rglob("*.parquet")}
    assert seal(rows(spark, 0, 50), INPUT, 1, root) == 50
    for p in {str(p) for p in tmp_path.rglob("*.parquet")} - before:
        if "line" in spark.read.parquet(p).columns:
            wrote.append(spark.read.parquet(p).count())
    assert sum(wrote) == 50
    plan = state.events(spark, root, [("in", 1)])
    assert [r["ordinal"] for r in plan.orderBy("ordinal").collect()] == list(range(1, 51)) and plan.agg(F.max("page")).first()[0] == 13


def test_two_writers_of_one_attempt(spark, tmp_path):
    root = str(tmp_path / "state")
    one, two = rows(spark, 0, 10), rows(spark, 0, 4)
    seal(one, INPUT, 1, root)
    with pytest.raises(TidemarkError, match="already_sealed"):
        seal(two, INPUT, 1, root)
    assert state.events(spark, root, [("in", 1)]).count() == 10 and len(names_in(spark, f"{root}/events")) == 1
    # both begin before either seals
    barrier, told = threading.Barrier(2), []
    real = state.seal_manifest

    def together(*a, **k):
        barrier.wait(60)
        return real(*a, **k)

    state.seal_manifest = together
    try:
        def attempt(base):
            try:
                told.append(seal(base, INPUT, 2, root))
            except TidemarkError as e:
                told.append(e.code)

        threads = [threading.Thread(target=attempt, args=(b,)) for b in (one, two)]
        [t.start() for t in threads]
        [t.join() for t in threads]
    finally:
        state.seal_manifest = real
    assert "already_sealed" in told and len(told) == 2
    (n,) = [t for t in told if t != "already_sealed"]
    assert state.events(spark, root, [("in", 2)]).count() == n == state.table(spark, root, "manifest").where("attempt_id = 2").agg(F.sum("rows")).first()[0]
    # a manifest of two writes, whatever made it, is not read as one page
    other = state.table(spark, root, "manifest").where("attempt_id = 2").withColumn("write_id", F.lit("other"))
    state.append(other, root, "manifest")
    with pytest.raises(TidemarkError, match="two_writers"):
        state.events(spark, root, [("in", 2)])


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "state")
    with pytest.raises(TidemarkError, match="duplicate"):
        seal(rows(spark, 0, 5).union(rows(spark, 0, 1)), INPUT, 1, root)
    with pytest.raises(TidemarkError, match="byte_limit"):
        seal(rows(spark, 0, 5), Input("in", INPUT.spec, ("id", "v"), max_rows=4, max_bytes=20), 1, root)
    assert not names_in(spark, f"{root}/events") and not names_in(spark, f"{root}/manifest") and not names_in(spark, f"{root}/unsealed")


def test_identity_and_schema_are_fenced(spark, tmp_path):
    root = str(tmp_path / "state")
    base = rows(spark, 0, 9).withColumn("ts2", F.col("ts") + F.expr("interval 1 day"))
    run_scan(spark, base, INPUT, root, receipts)
    at = read_cursor(spark, root, "in")
    for other, code in (
        (Input("in", CursorSpec("ts2", "id"), ("id", "v"), max_rows=4), "identity_change"),  # another cursor column
        (Input("in", INPUT.spec, ("id", "v"), query="q", max_rows=4), "identity_change"),  # another query
        (Input("in", INPUT.spec, ("id", "v"), host="h", max_rows=4), "identity_change"),  # another source
        (Input("in", INPUT.spec, ("id",), max_rows=4), "schema_drift"),  # a column less
    ):
        with pytest.raises(TidemarkError, match=code):
            run_scan(spark, base, other, root, receipts)
    wider = base.withColumn("v", F.col("id").cast("double"))
    with pytest.raises(TidemarkError, match="schema_drift"):
        run_scan(spark, wider, INPUT, root, receipts)
    assert read_cursor(spark, root, "in") == at and state.table(spark, root, "manifest").count() == 3
    run_scan(spark, base, Input("in", INPUT.spec, ("id", "v"), max_rows=5), root, receipts)  # a limit is a revision, not an identity
    run_inputs(spark, [(INPUT, wider)], root, receipts, accept_schema=("in",))
    run_scan(spark, wider, INPUT, root, receipts)
    with pytest.raises(TidemarkError, match="schema_drift"):
        run_scan(spark, base, INPUT, root, receipts)
    assert [r["generation"] for r in state.table(spark, root, "identities").orderBy("generation").collect()] == [0, 1, 2]


def test_sealed_batch_pages_need_their_revision(spark, tmp_path):
    root, sent = str(tmp_path / "state"), []
    batch = lambda **k: BatchInput("b", "run 1", ("id", "v"), (F.col("id").asc(),), 5, **k)
    send = lambda e: sent.extend(r["id"] for r in e.collect()) or receipts(e)
    with pytest.raises(ConnectionError):
        run_inputs(spark, [(batch(), rows(spark, 0, 3))], root, down)
    with pytest.raises(TidemarkError, match="revision_changed"):
        run_inputs(spark, [(batch(max_bytes=999_999), rows(spark, 0, 3)), (INPUT, rows(spark, 0, 2))], root, send)
    assert len(sent) == 2 and read_cursor(spark, root, "in")[1].id == 1  # the other input went on
    run_inputs(spark, [(INPUT, rows(spark, 0, 2))], root, send)  # the batch isn't in this run: left alone
    assert len(sent) == 2
    run_inputs(spark, [(batch(), rows(spark, 0, 3))], root, send)
    assert len(sent) == 2 + 3 + 3


def test_changed_pages_are_not_sent_again(spark, tmp_path):
    for change in ("line", "request"):
        root = str(tmp_path / change)
        with pytest.raises(ConnectionError):
            run_scan(spark, rows(spark, 0, 10), INPUT, root, down)
        if change == "line":
            ((_, _, write_id),) = state.writes(state.table(spark, root, "manifest"))
            path = state.events_path(root, write_id)
            spark.createDataFrame(spark.read.parquet(path).withColumn("line", F.replace("line", F.lit("v3"), F.lit("w3"))).collect(), state.STORED).write.mode("overwrite").parquet(path)
        else:  # the cursor moved behind the scan's back
            state.append(spark.createDataFrame([("in", 0, 0, 5, 5)], state.SCHEMAS["cursors"]), root, "cursors")
        with pytest.raises(TidemarkError, match="page_changed"):
            recover(spark, root, receipts)


def test_any_error_stays_with_its_input(spark, tmp_path):
    root = str(tmp_path / "state")

    def broken(frames):
        raise OSError("the source is gone")
        yield from frames

    bad = rows(spark, 0, 5).mapInPandas(broken, "ts timestamp, id long, v string")
    lacks = rows(spark, 0, 3).drop("v")
    with pytest.raises(Exception, match="source is gone"):
        run_inputs(spark, [(Input("bad", INPUT.spec, ("id", "v")), bad), (Input("lacks", INPUT.spec, ("id", "v")), lacks), (INPUT, rows(spark, 0, 5))], root, receipts)
    assert read_cursor(spark, root, "in")[1].id == 4 and read_cursor(spark, root, "bad") == (0, None)
    assert [c[:2] for c in codes(spark, root)] == [("bad", "failed"), ("in", "delivered"), ("lacks", "failed")]


def test_inputs_run_side_by_side(spark, tmp_path):
    going, most, lock = [0], [0], threading.Lock()
    real = run.seal

    def slow(*a, **k):
        with lock:
            going[0] += 1
            most[0] = max(most[0], going[0])
        time.sleep(0.3)
        try:
            return real(*a, **k)
        finally:
            with lock:
                going[0] -= 1

    run.seal = slow
    try:
        run_inputs(spark, [(Input(f"i{n}", INPUT.spec, ("id", "v"), max_rows=4), rows(spark, 0, 3)) for n in range(6)], str(tmp_path / "s"), receipts, parallel=3)
    finally:
        run.seal = real
    assert most[0] == 3 and state.table(spark, str(tmp_path / "s"), "cursors").count() == 6


def test_scratch_of_a_run_is_removed(spark, tmp_path):
    kept = spark.conf.get("spark.checkpoint.dir")
    before = set(names_in(spark, kept))
    batch = BatchInput("b", "run 1", ("id", "v"), (F.col("id").asc(),), 5)
    run_inputs(spark, [(batch, rows(spark, 0, 9)), (INPUT, rows(spark, 0, 9))], str(tmp_path / "s"), receipts)
    assert set(names_in(spark, kept)) == before


def test_deliveries_in_turns(spark, tmp_path):
    root, sent = str(tmp_path / "state"), []
    publish(checked_scan(rows(spark, 0, 30), INPUT, buckets=3), INPUT, 1, root)
    seal(rows(spark, 0, 30), Input("two", INPUT.spec, ("id", "v"), max_rows=4), 1, root)

    def send(events):
        sent.append(sorted((r["input_id"], r["id"]) for r in events.collect()))
        return receipts(events)

    run.deliver(spark, root, state.table(spark, root, "manifest"), send, pages_per_send=3)
    assert len(sent) == 3 and sorted(x for s in sent for x in s) == sorted((n, i) for n in ("in", "two") for i in range(30))
    assert all(len(s) <= 24 for s in sent) and state.table(spark, root, "receipts").agg(F.sum("rows")).first()[0] == 60


def test_control_tables_are_folded(spark, tmp_path):
    root = str(tmp_path / "state")
    for n in range(1, 8):
        state.append(spark.createDataFrame([("a", n, n, n, n), ("b", n, n, 10 * n, n)], state.SCHEMAS["cursors"]), root, "cursors")
    want = {"a": (7, 7), "b": (7, 70)}
    now = lambda: {r["input_id"]: (r["generation"], r["ts_us"]) for r in state.read_cursors(spark, root).collect()}
    held = state.table(spark, root, "cursors")  # a reader that began before the swap
    assert state.compact_table(spark, root, "cursors", keep=3) and now() == want and held.count() == 14
    assert state.table(spark, root, "cursors").count() == 2 and not state.compact_table(spark, root, "cursors", keep=3)
    for n in range(8, 13):
        state.append(spark.createDataFrame([("a", n, n, n, n)], state.SCHEMAS["cursors"]), root, "cursors")
    held = state.table(spark, root, "cursors")
    assert state.compact_table(spark, root, "cursors", keep=3) and held.count() == 7
    assert now() == {"a": (12, 12), "b": (7, 70)}
    assert len([n for n in names_in(spark, f"{root}/cursors") if n.endswith(".parquet")]) == 5 and names_in(spark, f"{root}/cursors.snapshots") == ["1", "2"]
    # a snapshot that wasn't finished counts for nothing
    state.table(spark, root, "cursors").limit(1).write.parquet(f"{root}/cursors.snapshots/3/rows")
    assert now() == {"a": (12, 12), "b": (7, 70)}


def test_runs_fold_their_tables(spark, tmp_path):
    root = str(tmp_path / "state")
    for n in range(1, 4):
        run_scan(spark, rows(spark, 0, 3 * n), INPUT, root, receipts)
        run.compact_tables(spark, root, keep=0)
    assert read_cursor(spark, root, "in") == (3, Cursor(1_704_067_202_000_000, 8))
    assert state.table(spark, root, "receipts").agg(F.sum("rows")).first()[0] == 9 and len(codes(spark, root)) == 3
    for name in state.SCHEMAS:
        assert len([n for n in names_in(spark, f"{root}/{name}") if n.endswith(".parquet")]) <= 1 and len(names_in(spark, f"{root}/{name}.snapshots")) <= 2
    with pytest.raises(TidemarkError, match="already_sealed"):
        publish(checked_scan(rows(spark, 0, 3), INPUT), INPUT, 2, root)
    assert not exists(spark, f"{root}/events/scan=x")


def test_small_tables_are_read_as_one_partition(spark, tmp_path, monkeypatch):
    """Beyond the size, tables are read and joined in parts; what a run does is the same."""
    told = {}
    for most in (state.ONE_PARTITION, -1):
        monkeypatch.setattr(state, "ONE_PARTITION", most)
        root = str(tmp_path / f"state{most}")
        with pytest.raises(ConnectionError):
            run_scan(spark, rows(spark, 0, 10), INPUT, root, down)
        group = f"run{most}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            run_inputs(spark, [(INPUT, rows(spark, 0, 17)), (Input("two", INPUT.spec, ("id", "v"), max_rows=4), rows(spark, 0, 0))], root, receipts)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        parts = state.table(spark, root, "receipts").rdd.getNumPartitions()
        told[most] = [sorted((r[0] for r in state.table(spark, root, t).select(c).collect()), key=str) for t, c in (("receipts", "rows"), ("cursors", "ts_us"), ("manifest", "stream_digest"), ("identities", "revision_fp"))]
        if most > 0:
            few = jobs
            assert parts == 1
    one, parted = told.values()
    assert one == parted
    assert few < jobs


def test_large_control_tables_are_written_and_grouped_in_parts(spark, tmp_path, monkeypatch):
    """No task writes, folds or sorts the whole of a table beyond the size that is read as one partition."""
    monkeypatch.setattr(state, "ONE_PARTITION", 1 << 10)
    monkeypatch.setattr(state, "PART_BYTES", 1 << 12)
    root, ids = str(tmp_path / "state"), spark.range(2_000).selectExpr("cast(id AS string) AS input_id")
    held = ids.crossJoin(spark.sql("SELECT * FROM VALUES (0L, 'old'), (1L, 'now') AS t(generation, revision_fp)"))
    rows = held.selectExpr("input_id", "generation", "'rising' AS mode", "'l' AS lineage_fp", "'c' AS cursor_fp", "revision_fp", "'s' AS schema_fp")
    now = rows.where("generation = 1").drop("generation")
    files = lambda path: len([n for n in names_in(spark, path) if n.endswith(".parquet")])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # little data would be put together again
    try:
        for folds in range(2):
            state.append(rows, root, "identities", large=True)
            dealt = state.table(spark, root, "identities", "input_id").withColumn("p", F.spark_partition_id())
            assert dealt.groupBy("p").count().count() > 1 and dealt.groupBy("input_id").agg(F.count_distinct("p").alias("n")).where("n > 1").isEmpty()
            told = run.fence(spark, root, now, local(spark, [("7", 1)], "input_id string, unsent long"))
            assert {r["action"]: r["count"] for r in told.groupBy("action").count().collect()} == {"same": 2_000}
            assert files(f"{root}/identities") > 1 and state.compact_table(spark, root, "identities", 0)
            assert files(f"{root}/identities.snapshots/{folds + 1}/rows") > 1
            left = state.table(spark, root, "identities")
            assert left.count() == 2_000 and left.where("generation <> 1").isEmpty()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rows_at_hand(spark):
    at = spark.sql("SELECT struct(1L AS ts_us, 2L AS id) AS at").first()["at"]
    df = local(spark, [("a", at), (None, None)], "k string, at struct<ts_us:bigint,id:bigint>")
    assert sorted(map(tuple, df.select("k", "at.id").collect()), key=str) == [("a", 2), (None, None)]
    assert df.rdd.getNumPartitions() == 1 and local(spark, [], "k string, n long").collect() == []


def test_bounded_scans_take_up_where_they_stopped(spark, tmp_path):
    """At most so many rows a scan; a delivery that fails between scans loses and repeats none."""
    root, path, sent = str(tmp_path / "state"), str(tmp_path / "base"), []
    rows(spark, 0, 23).write.parquet(path)
    inp = Input("in", INPUT.spec, ("id", "v"), max_rows=4, max_scan_rows=6)

    def send(events):
        if len(sent) == 12 and not broke:
            broke.append(1)
            raise ConnectionError("down")
        sent.extend(r["id"] for r in events.collect())
        return receipts(events)

    broke = []
    start = lambda: rising_stream(spark, path, rows(spark, 0, 0).schema, inp, root, str(tmp_path / "c"), send).awaitTermination()
    with pytest.raises(Exception, match="down"):
        start()
    start()
    assert sorted(sent) == list(range(23)) and len(sent) == 23
    per = state.table(spark, root, "manifest").groupBy("attempt_id").agg(F.sum("rows").alias("n")).orderBy("attempt_id").collect()
    assert [r["n"] for r in per] == [6, 6, 6, 5]
    for bad in (0, 10**7):
        with pytest.raises(TidemarkError, match="scan_rows"):
            run_scan(spark, rows(spark, 0, 30), Input("in", INPUT.spec, ("id", "v"), max_rows=4, max_scan_rows=bad), root, receipts)


def test_positions_of_large_scans(spark):
    """An input may allow lots of any size; where one ends is counted, with the same result as by sorting all rows."""
    big = Input("in", INPUT.spec, ("id",), max_scan_rows=2_000_000, most_scan_rows=2_000_000)
    base = spark.range(2_500_000).select(F.timestamp_micros(F.col("id").bitwiseAND(7) * 10**12 - 4 * 10**12).alias("ts"), (F.col("id") - 10**6).alias("id"))
    order = sorted((i % 8 * 10**12 - 4 * 10**12, i - 10**6) for i in range(2_500_000))
    assert scan.last_position(base, big, None) == Cursor(*order[1_999_999])
    least = -(2**63)
    at = [(0, 5), (0, least), (0, 2**63 - 1), (-1, 3), (-1, 3), (7, 1), (7, 1), (7, 1), (7, 2), (10**15, 0), (-(10**15), 4)]
    few = spark.createDataFrame(at, "us long, id long").select(F.timestamp_micros("us").alias("ts"), "id")
    for n in (1, 4, 5, 7, 8, 11):
        lot = Input("in", INPUT.spec, ("id",), max_scan_rows=n)
        over = sorted(at)[n] if n < len(at) else None
        fits = [p for p in sorted(at) if over and p < over]
        want = Cursor(*fits[-1]) if fits else None
        assert [scan.last_position(few, lot, None, k) for k in (0, 100)] == [want] * 2


def test_bounds_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "base")
    hours = spark.range(0, 24 * 10).selectExpr("timestamp'2024-01-01 00:30:00' + make_interval(0, 0, 0, 0, cast(id AS int)) AS ts", "id", "'x' AS v")
    whole = hours.withColumns({"y": F.year("ts"), "m": F.date_format("ts", "MM"), "d": F.day("ts")})
    whole.union(spark.sql("SELECT CAST(NULL AS timestamp), 7L, 'n', CAST(NULL AS int), CAST(NULL AS string), CAST(NULL AS int)")).repartition(1).write.partitionBy("y", "m", "d").parquet(path)
    df = spark.read.parquet(path)
    plain, ruled = CursorSpec("ts", "id"), CursorSpec("ts", "id", partitions=(("y", "year"), ("m", "month"), ("d", "day")))
    at, last = Cursor(1_704_067_200_000_000 + 4 * 86_400_000_000, 3), Cursor(1_704_067_200_000_000 + 6 * 86_400_000_000, 3)
    for bound, end in ((Bound(at), None), (Bound(at, True), last), (None, last)):
        slow, fast = apply_bound(df, plain, bound, end), apply_bound(df, ruled, bound, end)
        assert sorted(r["id"] for r in slow.collect()) == sorted(r["id"] for r in fast.collect())
        plan = fast._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [(" in plan or "PartitionFilters: [((" in plan
        read = fast.select("id", F.input_file_name().alias("f")).where("f <> ''").select("f").distinct().count()
        assert read <= {(True, False): 7, (True, True): 4, (False, True): 8}[bound is not None, end is not None]
    got = write_pass(df, Input("in", ruled, ("id", "v")), str(tmp_path / "w"), at)
    assert got.rows == sum(1 for _ in range(24 * 6)) + 1 and got.counts[0][2] == 1  # the null cursor is still found
    for bad in ((("d", "day"),), (("d", "date"), ("m", "month")), (("h", "hour"),)):
        with pytest.raises(TidemarkError, match="partition_rule"):
            CursorSpec("ts", "id", partitions=bad)
