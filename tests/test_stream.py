import json
import threading
from datetime import datetime, timedelta
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from tidemark.cursor import Cursor, CursorSpec
from tidemark.plans.scan import Input, checked_scan, publish
from tidemark.sources.base import jdbc_base, sql_base
from tidemark.sources.catalog import balanced_ranges, catalog_schema, catalog_types, guarded_projection, jdbc_balanced
from tidemark.sources.collector import CollectorSource, collector_options, http_sink
from tidemark.errors import TidemarkError
from tidemark.plans import state
from tidemark.plans.run import read_cursor, recover, run_inputs, run_scan
from tidemark.plans.scan import BatchInput
from tidemark.sources.sinks import enveloped
from tidemark.streaming.stream import deliver_stream, rising_stream

PAGE = ["input_id", "attempt_id", "page"]
SPEC = CursorSpec("ts", "id")
INPUT = Input("in", SPEC, ("id", "v"), max_rows=4)


def rows(spark, lo, hi):
    return spark.createDataFrame([(datetime(2024, 1, 1) + timedelta(seconds=i // 3), i, f"v{i}") for i in range(lo, hi)], "ts timestamp, id long, v string")


def receipts(events):
    return events.groupBy(*PAGE).agg(F.count("*").alias("rows"))


@pytest.fixture
def collector():
    got = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"])).decode()
            if self.path == "/ack":
                answer = {"acks": {"7": True}}
            else:
                got.append(body.split("\n"))
                answer = {"ackId": 7}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(answer).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", got
    server.shutdown()


def test_http_sink(spark, collector):
    url, got = collector
    events = spark.range(10).selectExpr("'a' AS input_id", "1L AS attempt_id", "id DIV 5 + 1 AS page", "id AS ordinal", "concat('{\"n\":', id, '}') AS event")
    told = http_sink(events, url, "t", max_events=2, ack_url=f"{url}/ack").collect()
    assert sorted((r["page"], r["rows"]) for r in told) == [(1, 5), (2, 5)]
    assert sorted(map(len, got)) == [1, 1, 2, 2, 2, 2] and sorted(x for b in got for x in b) == sorted(f'{{"n":{i}}}' for i in range(10))


def test_failed_tasks_leave_no_receipts(spark, collector, tmp_path):
    """A task that fails aborts the write without a receipt; the next write delivers all. One shuffle of the payload."""
    url, got = collector
    events = spark.range(40).selectExpr("'a' AS input_id", "1L AS attempt_id", "id DIV 10 + 1 AS page", "id AS ordinal", "concat('{\"n\":', id, '}') AS event")
    spark.dataSource.register(CollectorSource)
    o = collector_options(url, "t", str(tmp_path / "receipts"), max_events=4)
    ordered = events.repartition("page").sortWithinPartitions("page", "ordinal").drop("ordinal")
    with pytest.raises(Exception, match="event_exceeds_batch"):
        ordered.write.format("tidemark_collector").options(**{**o, "maxBytes": "7"}).mode("append").save()  # two digits are too many
    assert not (tmp_path / "receipts").exists()
    got.clear()
    ordered.write.format("tidemark_collector").options(**o).mode("append").save()
    told = spark.read.parquet(str(tmp_path / "receipts"))
    assert sorted(tuple(r) for r in told.collect()) == [("a", 1, p, 10) for p in (1, 2, 3, 4)]
    assert sorted(map(len, got)) == [2] * 4 + [4] * 8 and len({x for b in got for x in b}) == 40
    assert http_sink(events.where("false"), url, "t").count() == 0


def test_streams_reach_the_collector(spark, collector, tmp_path):
    url, got = collector
    for n in range(2):
        spark.range(n * 10, n * 10 + 10).selectExpr("'a' AS input_id", "1L AS attempt_id", "id DIV 5 + 1 AS page", "concat('{\"n\":', id, '}') AS event").write.mode("append").parquet(str(tmp_path / "in"))
    spark.dataSource.register(CollectorSource)
    o = collector_options(url, "t", str(tmp_path / "receipts"), max_events=3)
    for _ in range(2):  # the second time there is nothing new
        rows = spark.readStream.schema("input_id string, attempt_id long, page long, event string").parquet(str(tmp_path / "in"))
        rows.writeStream.format("tidemark_collector").options(**o).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(x for b in got for x in b) == sorted(f'{{"n":{i}}}' for i in range(20))
    told = spark.read.parquet(str(tmp_path / "receipts")).groupBy("page").agg(F.sum("rows")).collect()
    assert sorted(tuple(r) for r in told) == [(1, 5), (2, 5), (3, 5), (4, 5)]


def test_deliver_stream_is_replay_safe(spark, tmp_path):
    root = str(tmp_path / "pages")
    publish(checked_scan(rows(spark, 0, 10), INPUT), INPUT, 1, root)
    for _ in range(2):
        deliver_stream(spark, root, str(tmp_path / "c"), receipts).awaitTermination()
    assert spark.read.parquet(f"{root}/receipts").agg(F.sum("rows")).first()[0] == 10


def test_rising_stream_moves_the_cursor_after_delivery(spark, tmp_path):
    root, path = str(tmp_path / "state"), str(tmp_path / "base")
    rows(spark, 0, 10).write.parquet(path)
    schema = spark.read.parquet(path).schema

    def broken(_):
        raise RuntimeError("collector is down")

    with pytest.raises(Exception, match="collector is down"):
        run_scan(spark, spark.read.parquet(path), INPUT, root, broken)
    assert read_cursor(spark, root, "in") == (0, None)
    sent = []

    def kept(events):
        sent.extend(events.select("id", "event_id").collect())
        return receipts(events)

    rising_stream(spark, path, schema, INPUT, root, str(tmp_path / "c"), kept).awaitTermination()
    assert read_cursor(spark, root, "in")[1].id == 9
    rows(spark, 10, 17).write.mode("append").parquet(path)
    rising_stream(spark, path, schema, INPUT, root, str(tmp_path / "c"), kept).awaitTermination()
    generation, at = read_cursor(spark, root, "in")
    assert (generation, at.id) == (3, 16)  # the sealed attempt, an empty one, and the new rows
    assert sorted(r["id"] for r in sent) == list(range(17)) and len({r["event_id"] for r in sent}) == 17
    assert state.events(spark, root, [("in", 1), ("in", 3)]).isEmpty()  # delivered, so dropped
    assert {r["status"] for r in state.table(spark, root, "metrics").collect()} == {"delivered"}
    assert run_scan(spark, spark.read.parquet(path), INPUT, root, receipts) == at


def test_byte_limit_publishes_nothing(spark, tmp_path):
    inp = Input("in", SPEC, ("id", "v"), max_rows=4, max_bytes=20)
    with pytest.raises(ValueError, match="byte_limit"):
        publish(checked_scan(rows(spark, 0, 10), inp), inp, 1, str(tmp_path / "p"))
    assert not (tmp_path / "p" / "manifest").exists()


def test_derby(spark, tmp_path):
    url = f"jdbc:derby:memory:t{abs(hash(str(tmp_path)))}"
    rows(spark, 0, 9).withColumn("v", F.col("v").cast("varchar(20)")).write.format("jdbc").options(url=f"{url};create=true", dbtable="T", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver", createTableColumnTypes="v VARCHAR(20)").save()
    df = jdbc_base(spark, url, 'SELECT "ts", "id", "v" FROM T', "derby", "id", 0, 9, 3)
    assert df.rdd.getNumPartitions() == 3
    got = checked_scan(df, Input("db", SPEC, ("id", "v")), Cursor(1_704_067_200_000_000, 1)).orderBy("ordinal").collect()
    assert [r["id"] for r in got] == list(range(2, 9))


def test_native_types_and_balanced_ranges(spark, tmp_path):
    url = f"jdbc:derby:memory:c{abs(hash(str(tmp_path)))}"
    o = {"url": f"{url};create=true", "dbtable": "T", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    k = F.when(F.col("id") < 900, F.col("id")).when(F.col("id") < 990, F.col("id") * 1_000_003 - 5_000_000).otherwise(None)
    spark.range(1000).select(k.cast("long").alias("k"), F.col("id").cast("decimal(9,2)").alias("d"), F.repeat(F.lit("x"), F.col("id").cast("int")).alias("v"), F.current_timestamp().alias("ts"), F.lit(b"b").alias("b")).write.format("jdbc").options(**o, createTableColumnTypes="v VARCHAR(2000)").save()
    types = catalog_types(spark, url, "derby", "APP", "T")
    assert [(r["name"], r["type"], r["nullable"]) for r in types.orderBy("position").collect()] == [("k", "BIGINT", True), ("d", "DECIMAL(9,2)", True), ("v", "VARCHAR(2000)", False), ("ts", "TIMESTAMP", False), ("b", "BLOB(2147483647)", False)]
    fields = catalog_schema(types, "derby", ["k", "d", "v", "ts"], "ts")
    assert [f.dataType.simpleString() for f in fields] == ["bigint", "decimal(9,2)", "string", "timestamp"]
    with pytest.raises(TidemarkError, match="unknown_columns: nope, q"):
        catalog_schema(types, "derby", ["k", "nope", "q"])
    with pytest.raises(TidemarkError, match="rejected_columns: k .*, d "):  # a dialect that has no such types
        catalog_schema(types.withColumn("type", F.lit("XML")), "derby", ["k", "d"])
    ranges = balanced_ranges(spark, url, "SELECT * FROM T", "derby", "k", 5)
    assert sum(ranges.rows) == 990 and 4 <= len(ranges.rows) <= 6 and max(ranges.rows) <= 1.5 * min(ranges.rows)
    df = jdbc_balanced(spark, url, "SELECT * FROM T", "derby", "k", 5, fields)
    assert df.rdd.getNumPartitions() == len(ranges.rows) and df.count() == 1000 and df.where("k is null").count() == 10
    with pytest.raises(Exception, match="value_size"):
        guarded_projection(df, fields, 500).collect()
    assert balanced_ranges(spark, url, "SELECT * FROM T WHERE 1 = 0", "derby", "k", 5).rows == [0]
    # what comes in after the bound was taken isn't read by any range
    df = spark.read.jdbc(url, "T", predicates=ranges.predicates, properties={"driver": o["driver"]})
    spark.createDataFrame([(10**15, None, "new", datetime(2024, 1, 1), b"b")], "k long, d decimal(9,2), v string, ts timestamp, b binary").write.format("jdbc").options(**o).mode("append").save()
    assert df.count() == 1000


def test_sql_base(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT id FROM range(3) UNION ALL SELECT 7")
    assert sql_base(spark, file=str(tmp_path / "q.sql")).count() == 4
    for bad in ({}, {"text": "SELECT 1", "file": "x"}, {"text": " "}, {"text": "SELECT 1 LIMIT 1"}):
        with pytest.raises(ValueError):
            sql_base(spark, **bad)


def down(_):
    raise ConnectionError("collector is down")


def test_sealed_pages_go_out_before_anything_new(spark, tmp_path):
    root, sent = str(tmp_path / "state"), []

    def send(events):
        sent.extend((r["attempt_id"], r["id"]) for r in events.collect())
        return receipts(events)

    with pytest.raises(ConnectionError):
        run_scan(spark, rows(spark, 0, 10), INPUT, root, down)
    assert run_scan(spark, rows(spark, 0, 12), INPUT, root, send).id == 11
    assert sorted(sent) == [(1, i) for i in range(10)] + [(2, 10), (2, 11)]
    assert run_scan(spark, rows(spark, 0, 13), INPUT, root, send).id == 12
    assert state.table(spark, root, "receipts").agg(F.sum("rows")).first()[0] == 13
    with pytest.raises(TidemarkError, match="already_sealed"):
        publish(checked_scan(rows(spark, 0, 3), INPUT), INPUT, 1, root)


def test_delivered_without_a_receipt_of_the_cursor_is_not_sent_again(spark, tmp_path):
    root = str(tmp_path / "state")
    publish(checked_scan(rows(spark, 0, 10), INPUT), INPUT, 1, root)
    from tidemark.plans.run import deliver

    deliver(spark, root, state.table(spark, root, "manifest").select(*PAGE), receipts)  # and then the run dies
    assert recover(spark, root, down) == [("in", 1)] and read_cursor(spark, root, "in")[1].id == 9


def test_lost_events_are_noticed(spark, tmp_path):
    root = str(tmp_path / "state")
    publish(checked_scan(rows(spark, 0, 10), INPUT), INPUT, 1, root)
    (_, _, write_id), = state.writes(state.table(spark, root, "manifest"))
    whole = state.events_path(root, write_id)
    spark.read.parquet(whole).where("id <> 2").write.parquet(str(tmp_path / "less"))
    state.drop_events(spark, root, [("in", 1)])
    with pytest.raises(TidemarkError, match="reconcile"):
        recover(spark, root, receipts)
    spark.read.parquet(str(tmp_path / "less")).write.parquet(whole)
    with pytest.raises(TidemarkError, match="accounting"):
        recover(spark, root, receipts)


def test_input_ids_stay_text(spark, tmp_path):
    root, names = str(tmp_path / "state"), ("007", "7", "a/b c")
    run_inputs(spark, [(Input(n, SPEC, ("id", "v"), max_rows=4), rows(spark, 0, 3 + k)) for k, n in enumerate(names)], root, receipts)
    assert {r["input_id"]: r["id"] for r in state.read_cursors(spark, root).collect()} == {"007": 2, "7": 3, "a/b c": 4}
    with pytest.raises(TidemarkError, match="duplicate_input"):
        run_inputs(spark, [(INPUT, rows(spark, 0, 1))] * 2, root, receipts)


def test_one_input_that_fails_keeps_no_other(spark, tmp_path):
    root = str(tmp_path / "state")
    twice = rows(spark, 0, 2).union(rows(spark, 0, 1))
    with pytest.raises(TidemarkError, match="duplicate"):
        run_inputs(spark, [(Input("bad", SPEC, ("id",)), twice), (INPUT, rows(spark, 0, 3))], root, receipts)
    assert read_cursor(spark, root, "in")[1].id == 2 and read_cursor(spark, root, "bad") == (0, None)
    assert {(r["input_id"], r["status"], r["error_code"]) for r in state.table(spark, root, "metrics").collect()} == {("bad", "failed", "duplicate"), ("in", "delivered", None)}


def test_the_base_is_read_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            reads.add(len(f))
            yield f

    base = rows(spark, 0, 40)
    scan = checked_scan(base.mapInPandas(count, base.schema), Input("in", SPEC, ("id", "v"), max_rows=4))
    assert scan.count() == 40 and scan.agg(F.max("page")).first()[0] == 10 and reads.value == 40


def test_staging_quota(spark, tmp_path):
    inp = Input("in", SPEC, ("id", "v"), max_rows=4, max_staged=100)
    with pytest.raises(TidemarkError, match="staging_quota"):
        publish(checked_scan(rows(spark, 0, 10), inp), inp, 1, str(tmp_path / "p"))


def test_batch_and_rising_runs_reach_the_collector(spark, tmp_path, collector):
    url, got = collector
    root = str(tmp_path / "state")
    batch = BatchInput("b", "run 1", ("id", "v"), (F.col("id").asc(),), 5)

    def send(events):
        return http_sink(enveloped(events, "1.5", "main", "rows", "s"), url, "t", max_events=3, ack_url=f"{url}/ack")

    for n in (1, 2):
        run_inputs(spark, [(batch, rows(spark, 0, 9)), (INPUT, rows(spark, 0, 6))], root, send)
    events = [json.loads(x) for b in got for x in b]
    assert len(events) == 16 and len({e["fields"]["event_id"] for e in events}) == 11  # a repeated batch run has the same ids
    assert sorted(e["event"]["id"] for e in events) == sorted([*range(5)] * 2 + [*range(6)])
    assert read_cursor(spark, root, "in") == (2, Cursor(1_704_067_201_000_000, 5)) and read_cursor(spark, root, "b") == (0, None)
    with pytest.raises(Exception, match="event_size"):
        enveloped(spark.createDataFrame([("x", "{}")], "event_id string, line string"), "1", "i", "t", "s", most=10).collect()


def test_refused_requests_are_not_tried_again():
    tried = []

    class Refuse(BaseHTTPRequestHandler):
        def do_POST(self):
            tried.append(self.rfile.read(int(self.headers["Content-Length"])))
            self.send_response({b"bad": 400, b"busy": 503}.get(tried[-1], 200))
            self.end_headers()
            self.wfile.write(b'{"code": 4}')

        def log_message(self, *_):
            pass

    from tidemark.sources.sinks import post

    server = HTTPServer(("127.0.0.1", 0), Refuse)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    for body, times in ((b"bad", 1), (b"busy", 3), (b"no", 1)):
        tried.clear()
        with pytest.raises(TidemarkError, match="http_delivery"):
            post(f"http://127.0.0.1:{server.server_port}", body, "t", 5, None)
        assert len(tried) == times
    server.shutdown()
