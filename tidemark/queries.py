"""Registered queries of the library and their DuckDB twins. Names begin with the operator's number in the inventory."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cursor import Bound, Cursor, CursorSpec, after, apply_bound, below_bound, cursor_order, ts_us
from .functions import encode, ids, strict
from .operators import checks, control, inputs, order, pages, schema
from .plans import state
from .plans.run import fence, run_inputs
from .plans.scan import BatchInput, Input, checked_scan, publish, rising_scan
from .scratch import scratch_dir
from .sources import base, catalog, sinks
from .streaming.stream import deliver_stream, rising_stream, stream_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- events: a unique cursor -------------------------------------------------------------------------------------

SPEC = CursorSpec("ts", "event_id", assume_utc=True)
OVERLAP = CursorSpec("ts", "event_id", timedelta(hours=6), True)
AT = Cursor(1_704_153_600_000_000, 40)  # 2024-01-02
RESUME = Cursor(1_704_240_000_000_000, 0)  # 2024-01-03
COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
EVENTS = Input("00000000-0000-4000-8000-000000000001", SPEC, COLUMNS, "spark", "events", 500)


def event_base(spark, d) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id", "ts", "user_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"), F.col("props").alias("props", metadata={"field_type": "json"}))


US = "epoch_us(ts)"
LINE = """'{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","user_id":' || coalesce(user_id::VARCHAR, 'null') || ',"event_type":' || coalesce(to_json(event_type)::VARCHAR, 'null') || ',"value":' || coalesce('"' || value::DECIMAL(18,2) || '"', 'null') || ',"props":' || coalesce(props, 'null') || '}'"""


def _h(domain: str, *parts: bytes) -> str:
    return hashlib.sha256(domain.encode() + b"".join(parts)).hexdigest()


def _n(tag: int, v: int, width: int) -> bytes:
    return bytes([tag]) + v.to_bytes(width, "big")


def _s(tag: int, v: str) -> bytes:
    return _n(tag, len(v.encode()), 4) + v.encode()


def _identity(inp: Input) -> str:
    q = _h(ids.QUERY, _n(1, 1, 2), _s(2, inp.connector), _s(3, inp.query))
    lineage = _h(ids.LINEAGE, _n(1, 1, 2), _s(2, "rising"), _s(3, inp.input_id), _s(4, inp.connector), _s(5, ""), _s(6, ""), _s(7, ""), b"\x08" + bytes.fromhex(q))
    return _h(ids.INPUT, _n(1, 1, 2), _s(2, inp.input_id)) + lineage + _h(ids.CURSOR, _n(1, 1, 2), _s(2, inp.spec.ts), _s(3, inp.spec.id))


EVENT_ID = f"sha256('{ids.RISING_EVENT}'::BLOB || unhex('{_identity(EVENTS)}') || unhex(printf('0001%016x%016x', {US}, event_id)))"
PAST = f"({US} > {AT.ts_us} OR ({US} = {AT.ts_us} AND event_id > {AT.id}))"


@query("s2_rising_scan", f"""SELECT (n - 1) // 500 + 1 AS page, n AS ordinal, us AS ts_us, event_id AS id, eid AS event_id, line, strlen(line) AS line_bytes, (n - 1) // 500 < (c - 1) // 500 AS truncated FROM (
    SELECT row_number() OVER (ORDER BY ts, event_id) AS n, count(*) OVER () AS c, {US} AS us, event_id, {EVENT_ID} AS eid, {LINE} AS line FROM events WHERE {PAST})""")
def s2_rising_scan(spark, d):
    return rising_scan(event_base(spark, d), EVENTS, AT).select("page", "ordinal", "ts_us", "id", "event_id", "line", "line_bytes", "truncated")


@query("s2_checked_scan", f"SELECT page, count(*) AS rows, sum(strlen(line) + 1)::BIGINT AS bytes FROM (SELECT (row_number() OVER (ORDER BY ts, event_id) - 1) // 500 + 1 AS page, {LINE} AS line FROM events WHERE {PAST}) GROUP BY page")
def s2_checked_scan(spark, d):
    return checked_scan(event_base(spark, d), EVENTS, AT).groupBy("page").agg(F.count("*").alias("rows"), F.sum(F.col("line_bytes") + 1).alias("bytes"))


@query("s1_batch_scan", "SELECT o_orderkey, o_orderdate, (SELECT count(*) FROM orders) > 1000 AS truncated FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1000")
def s1_batch_scan(spark, d):
    rows = base.table_base(spark, f"{d}/orders.parquet").select("o_orderkey", "o_orderdate")
    return base.batch_scan(rows, [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()], 1000)


@query("s4_table_base", "SELECT o_orderkey, o_orderstatus FROM orders")
def s4_table_base(spark, d):
    return base.table_base(spark, f"{d}/orders.parquet").select("o_orderkey", "o_orderstatus")


@query("s5_sql_base", "SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS top FROM orders GROUP BY o_orderstatus UNION ALL SELECT 'none', 0, NULL")
def s5_sql_base(spark, d):
    text = "WITH t AS (SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS top FROM {orders} GROUP BY o_orderstatus) SELECT * FROM t UNION ALL VALUES ('none', 0, CAST(NULL AS BIGINT))"
    return base.sql_base(spark, text, orders=table(spark, d, "orders"))


@query("s7_collect_inputs", "SELECT 'customer' AS input_id, c_custkey AS id, c_name AS name, NULL::INTEGER AS size FROM customer UNION ALL SELECT 'part', p_partkey, p_name, p_size FROM part")
def s7_collect_inputs(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return base.collect_inputs({"customer": c, "part": p})


def _bounded(spark, d, spec, bound):
    df = table(spark, d, "events")
    return apply_bound(df, spec, bound).select("event_id", ts_us(df, spec).alias("ts_us"))


@query("f1_no_bound", f"SELECT event_id, {US} AS ts_us FROM events")
def f1_no_bound(spark, d):
    return _bounded(spark, d, SPEC, SPEC.bound(None))


@query("f2_after", f"SELECT event_id, {US} AS ts_us FROM events WHERE {PAST}")
def f2_after(spark, d):
    return _bounded(spark, d, SPEC, SPEC.bound(AT))


@query("f3_overlap", f"SELECT event_id, {US} AS ts_us FROM events WHERE {US} >= {AT.ts_us - OVERLAP.overlap_us}")
def f3_overlap(spark, d):
    return _bounded(spark, d, OVERLAP, OVERLAP.bound(AT))


@query("f4_resume", f"SELECT event_id, {US} AS ts_us FROM events WHERE {US} > {RESUME.ts_us} OR ({US} = {RESUME.ts_us} AND event_id > {RESUME.id})")
def f4_resume(spark, d):
    return _bounded(spark, d, OVERLAP, OVERLAP.bound(AT, RESUME))


def _holes(spark, d):
    return table(spark, d, "events").select(F.when(F.col("event_id") % 97 != 0, F.col("ts")).alias("ts"), F.when(F.col("event_id") % 89 != 0, F.col("event_id")).alias("event_id"), F.col("user_id"))


HOLES = "(SELECT CASE WHEN event_id % 97 <> 0 THEN ts END AS ts, CASE WHEN event_id % 89 <> 0 THEN event_id END AS event_id, user_id FROM events)"


@query("f5_null_guard", f"SELECT user_id, {US} AS ts_us, event_id FROM {HOLES} WHERE {PAST} OR ts IS NULL OR event_id IS NULL")
def f5_null_guard(spark, d):
    df = _holes(spark, d)
    return apply_bound(df, SPEC, Bound(AT)).select("user_id", ts_us(df, SPEC).alias("ts_us"), "event_id")


@query("f6_lower_bound_check", f"SELECT count(*) FILTER (NOT {PAST}) AS below FROM events")
def f6_lower_bound_check(spark, d):
    df = table(spark, d, "events")
    return df.agg(F.count_if(below_bound(df, SPEC, Bound(AT))).alias("below"))


@query("f7_typed_projection", "SELECT c_custkey, c_acctbal::DECIMAL(15,2) AS c_acctbal, c_nationkey::BIGINT AS c_nationkey, c_name FROM customer")
def f7_typed_projection(spark, d):
    target = schema.map_schema("postgres", {"c_custkey": "bigint", "c_acctbal": "numeric(15,2)", "c_nationkey": "bigint", "c_name": "text"})
    return schema.typed_projection(table(spark, d, "customer"), target)


@query("f9_preview", "SELECT count(*) AS rows FROM (SELECT * FROM lineitem LIMIT 100)")
def f9_preview(spark, d):
    return inputs.preview(table(spark, d, "lineitem"), 100).agg(F.count("*").alias("rows"))


@query("o1_cursor_order", f"SELECT user_id, rank() OVER (ORDER BY ts ASC NULLS FIRST, event_id ASC NULLS FIRST) AS n FROM {HOLES}")
def o1_cursor_order(spark, d):
    from pyspark.sql import Window

    rows = order.with_ordinal(_holes(spark, d), "ts", "event_id", buckets=8)
    return rows.select("user_id", F.min("ordinal").over(Window.partitionBy("bucket", "ts", "event_id")).alias("n"))


@query("o2_row_limit_probe", "SELECT event_id, (SELECT count(*) FROM events) > 700 AS truncated FROM events ORDER BY ts, event_id LIMIT 700")
def o2_row_limit_probe(spark, d):
    return order.row_limit_probe(table(spark, d, "events"), cursor_order(SPEC), 700).select("event_id", "truncated")


@query("o4_next_page", f"SELECT event_id FROM events WHERE {PAST} ORDER BY ts, event_id LIMIT 300")
def o4_next_page(spark, d):
    return order.next_page(table(spark, d, "events"), SPEC, Bound(AT), 300).select("event_id")


# ---- orders: many ties -------------------------------------------------------------------------------------------


def _order_cursors(spark, d):
    df = table(spark, d, "orders")
    spec = CursorSpec("o_orderdate", "o_orderkey", assume_utc=True)
    return df.select(ts_us(df, spec).alias("ts_us"), F.col("o_orderkey").alias("id"))


@query("w2_ordinal", "SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS ordinal FROM orders")
def w2_ordinal(spark, d):
    return order.with_ordinal(_order_cursors(spark, d), buckets=16).select("id", "ordinal")


@query("w3_page_assign", "SELECT page, count(*) AS rows, min(o_orderkey) AS low FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 400 + 1 AS page FROM orders) GROUP BY page")
def w3_page_assign(spark, d):
    return order.page_assign(order.with_ordinal(_order_cursors(spark, d), buckets=16), 400).groupBy("page").agg(F.count("*").alias("rows"), F.min("id").alias("low"))


LINES = "(SELECT l_shipdate AS ts, l_orderkey * 10 + l_linenumber AS id FROM lineitem)"


def _line_cursors(spark, d):
    df = table(spark, d, "lineitem").select(F.col("l_shipdate").alias("ts"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return df.select(ts_us(df, CursorSpec("ts", "id", assume_utc=True)).alias("ts_us"), "id")


@query("w1_strictly_increasing", f"SELECT {US} AS ts_us, id, count(*) - 1 AS again FROM {LINES} GROUP BY ALL HAVING count(*) > 1")
def w1_strictly_increasing(spark, d):
    return order.strictly_increasing(order.with_ordinal(_line_cursors(spark, d), buckets=16)).groupBy("ts_us", "id").agg(F.count("*").alias("again"))


@query("s2_lineitem_scan", f"SELECT (n - 1) // 5000 + 1 AS page, count(*) AS rows, min(us) AS low, max(us) AS high FROM (SELECT row_number() OVER (ORDER BY ts, id) AS n, {US} AS us FROM {LINES}) GROUP BY page")
def s2_lineitem_scan(spark, d):
    """The whole of lineitem as a rising scan: read once, ordered, paged, encoded and identified."""
    rows = table(spark, d, "lineitem").select(F.col("l_shipdate").alias("ts"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_quantity").cast("decimal(18,2)").alias("quantity"), F.col("l_returnflag").alias("flag"))
    scan = rising_scan(rows, Input("lines", CursorSpec("ts", "id", assume_utc=True), ("id", "quantity", "flag"), query="lines", max_rows=5_000))
    summed = scan.groupBy("page").agg(F.count("*").alias("rows"), F.min("ts_us").alias("low"), F.max("ts_us").alias("high"), F.count_if(F.length("event_id") + F.col("line_bytes") < 65).alias("odd"))
    return summed.where("odd = 0").drop("odd")


@query("a4_duplicate_cursors", f"SELECT {US} AS ts_us, id, count(*) AS n FROM {LINES} GROUP BY ALL HAVING n > 1")
def a4_duplicate_cursors(spark, d):
    return pages.duplicate_cursors(_line_cursors(spark, d), "ts_us", "id")


@query("x2_cursor_check", f"SELECT 0::BIGINT AS null_cursor, count(*) FILTER (NOT (ts >= TIMESTAMP '1996-01-01')) AS below_bound, count(*) - count(DISTINCT (ts, id)) AS duplicate FROM {LINES}")
def x2_cursor_check(spark, d):
    df = table(spark, d, "lineitem").select(F.col("l_shipdate").alias("ts"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    spec = CursorSpec("ts", "id", assume_utc=True)
    return checks.cursor_counts(df, spec, Bound(Cursor(820_454_400_000_000, -(2**63)), True), "ts", "id")


@query("x1_lossless_check", "SELECT * FROM (SELECT 'v' AS \"column\", 'not_finite' AS reason, count(*) FILTER (event_id % 50 = 0) AS rows FROM events UNION ALL SELECT 'j', 'invalid_json', count(*) FILTER (event_id % 70 = 0) FROM events) WHERE rows > 0")
def x1_lossless_check(spark, d):
    e = table(spark, d, "events")
    bad = e.select("event_id", F.when(F.col("event_id") % 50 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("v"), F.when(F.col("event_id") % 70 == 0, F.concat("props", F.lit(" x"))).otherwise(F.col("props")).alias("j", metadata={"field_type": "json"}))
    return checks.lossless_check(bad)


# ---- staged pages and control tables, derived from orders by SQL that both engines run ---------------------------

STAGED = """SELECT input_id, attempt_id, CAST(floor((rn - 1) / 50) AS BIGINT) + 1 AS page, rn AS ordinal, ts_us, id, line, CAST(length(line) AS BIGINT) AS line_bytes FROM (
 SELECT o_orderpriority AS input_id, CAST(o_orderkey % 3 AS BIGINT) AS attempt_id, CAST(o_custkey AS BIGINT) AS ts_us, CAST(o_orderkey AS BIGINT) AS id,
 concat('{"k":', CAST(o_orderkey AS STRING), ',"s":"', o_orderstatus, '"}') AS line,
 CAST(row_number() OVER (PARTITION BY o_orderpriority, o_orderkey % 3 ORDER BY o_custkey, o_orderkey) AS BIGINT) AS rn FROM orders) t"""
CTE = f"WITH staged AS ({STAGED})"
MANIFEST = "SELECT input_id, attempt_id, page, count(*) AS rows, CAST(sum(line_bytes + 1) AS BIGINT) AS bytes FROM staged GROUP BY input_id, attempt_id, page"
RECEIPTS = "SELECT input_id, attempt_id, page, count(*) AS rows FROM staged WHERE page <> 4 + attempt_id GROUP BY input_id, attempt_id, page"
CTES = f"{CTE}, manifest AS ({MANIFEST}), receipts AS ({RECEIPTS})"
COMMITTED = "SELECT DISTINCT o_orderpriority AS input_id, CAST(100 AS BIGINT) AS ts_us, CAST(7 AS BIGINT) AS id FROM orders WHERE o_orderpriority < '3'"
CURSORS = "SELECT o_orderpriority AS input_id, CAST(o_orderkey % 40 AS BIGINT) AS generation, CAST(max(o_custkey) AS BIGINT) AS ts_us, CAST(max(o_orderkey) AS BIGINT) AS id FROM orders WHERE o_orderkey % 40 NOT IN (11, 12, 29) GROUP BY o_orderpriority, o_orderkey % 40"
ATTEMPTS = """SELECT CAST(o_custkey AS BIGINT) AS input_id, CAST(o_orderkey AS BIGINT) AS attempt_id, CAST(o_custkey % 4 AS BIGINT) AS generation, o_orderkey % 2 = 0 AS active,
 CASE WHEN o_orderkey % 11 = 0 THEN 'failed' WHEN o_orderkey % 5 = 0 THEN 'in_progress' ELSE 'completed' END AS collection, CAST(o_orderkey % 9 AS BIGINT) AS coll_rows,
 CASE WHEN o_orderkey % 13 = 0 THEN 'failed' WHEN o_orderkey % 7 = 0 THEN 'uncertain' WHEN o_orderkey % 4 = 0 THEN 'in_progress' ELSE 'confirmed' END AS delivery,
 CAST(CASE WHEN o_orderkey % 17 = 0 THEN -1 ELSE o_orderkey % 9 END AS BIGINT) AS deliv_rows FROM orders"""


def frames(spark, d, **sql: str) -> dict[str, DataFrame]:
    """DataFrames of the SQL above; {orders} and earlier names may be read."""
    known = {n: table(spark, d, n) for n in ("orders", "customer", "lineitem")}
    for name, text in sql.items():
        text, used = text.replace("{", "{{").replace("}", "}}"), {}
        for n, df in known.items():
            text, k = re.subn(rf"\bFROM {n}\b", f"FROM {{{n}}}", text)
            if k:
                used[n] = df
        known[name] = spark.sql(text, **used)
    return known


def _control(spark, d):
    f = frames(spark, d, staged=STAGED, manifest=MANIFEST, receipts=RECEIPTS)
    return f["staged"], f["manifest"], f["receipts"]


@query("a1_page_summary", f"""{CTE}, p AS (SELECT input_id, attempt_id, page, count(*) AS rows, sum(line_bytes + 1)::BIGINT AS bytes, arg_max(ts_us, ordinal) AS t, arg_max(id, ordinal) AS i FROM staged GROUP BY ALL), c AS ({COMMITTED})
    SELECT input_id, attempt_id, page, rows, bytes, page < max(page) OVER (PARTITION BY input_id, attempt_id) AS truncated, p.t AS resume_ts, p.i AS resume_id,
    CASE WHEN c.ts_us > p.t OR (c.ts_us = p.t AND c.id > p.i) THEN c.ts_us ELSE p.t END AS candidate_ts, CASE WHEN c.ts_us > p.t OR (c.ts_us = p.t AND c.id > p.i) THEN c.id ELSE p.i END AS candidate_id FROM p LEFT JOIN c USING (input_id)""")
def a1_page_summary(spark, d):
    f = frames(spark, d, staged=STAGED, committed=COMMITTED)
    s = pages.page_summary(f["staged"], f["committed"])
    return s.select(*pages.PAGE, "rows", "bytes", "truncated", F.col("resume.ts_us").alias("resume_ts"), F.col("resume.id").alias("resume_id"), F.col("candidate.ts_us").alias("candidate_ts"), F.col("candidate.id").alias("candidate_id"))


@query("a2_scan_summary", f"{CTE} SELECT input_id, attempt_id, count(*) AS rows, sum(line_bytes + 1)::BIGINT AS bytes, max(page) AS pages, arg_max(id, ordinal) AS id FROM staged GROUP BY ALL")
def a2_scan_summary(spark, d):
    staged, _, _ = _control(spark, d)
    return pages.scan_summary(pages.page_summary(staged)).select(*pages.SCAN, "rows", "bytes", "pages", F.col("candidate.id").alias("id"))


@query("a3_current_cursor", f"SELECT * FROM ({CURSORS}) QUALIFY generation = max(generation) OVER (PARTITION BY input_id)")
def a3_current_cursor(spark, d):
    return pages.current_cursor(frames(spark, d, cursors=CURSORS)["cursors"])


@query("a5_staged_usage", f"{CTES} SELECT input_id, sum(bytes)::BIGINT AS bytes, CASE WHEN grouping(input_id) = 1 THEN sum(bytes) > 200000 ELSE sum(bytes) > 60000 END AS over FROM manifest GROUP BY ROLLUP (input_id)")
def a5_staged_usage(spark, d):
    return pages.staged_usage(_control(spark, d)[1], 60_000, 200_000)


@query("a6_stream_digest", f"{CTE} SELECT input_id, attempt_id, page, sha256(unhex(string_agg(printf('%016x', strlen(line)) || hex(encode(line)), '' ORDER BY ordinal))) AS stream_digest FROM staged GROUP BY ALL")
def a6_stream_digest(spark, d):
    return pages.stream_digest(_control(spark, d)[0])


@query("a7_reference_digest", f"""{CTES} SELECT input_id, attempt_id, page, sha256('{ids.REFERENCE}'::BLOB || unhex('0001') || unhex(sha256('{ids.INPUT}'::BLOB || unhex('01000102') || unhex(printf('%08x', strlen(input_id))) || encode(input_id)))
    || unhex(printf('%016x%016x%016x%016x', attempt_id, page, rows, bytes)) || unhex(sha256('x')) || unhex(printf('%016x', 2)) || encode('{{}}')) AS digest FROM manifest""")
def a7_reference_digest(spark, d):
    m = _control(spark, d)[1]
    c = F.col
    return m.select(*pages.PAGE, pages.reference_digest(ids.input_key(c("input_id")), c("attempt_id"), c("page"), c("rows"), c("bytes"), F.sha2(F.lit("x"), 256), F.lit("{}")).alias("digest"))


RUNS = "SELECT o_orderkey AS input_id, CAST(o_custkey AS BIGINT) AS rows, CAST(o_custkey AS BIGINT) * 1000003 AS bytes, CAST((o_orderkey % 5) AS BIGINT) * 333333333 AS duration_ns FROM orders"


@query("a8_run_rates", f"SELECT *, CASE WHEN duration_ns > 0 THEN (rows::HUGEINT * 1000000000 // duration_ns)::BIGINT END AS rows_per_second, CASE WHEN duration_ns > 0 THEN (bytes::HUGEINT * 1000000000 // duration_ns)::BIGINT END AS bytes_per_second FROM ({RUNS})")
def a8_run_rates(spark, d):
    return pages.run_rates(frames(spark, d, runs=RUNS)["runs"])


@query("a9_backlog", f"{CTES} SELECT input_id, count(*) AS pages, sum(m.rows)::BIGINT AS rows, sum(bytes)::BIGINT AS bytes FROM manifest m ANTI JOIN receipts USING (input_id, attempt_id, page) GROUP BY input_id")
def a9_backlog(spark, d):
    _, m, r = _control(spark, d)
    return pages.backlog(m, r)


@query("a10_accounting_check", f"{CTES} SELECT input_id, attempt_id, page, m.rows AS staged, CASE WHEN page = 3 THEN m.rows + 1 ELSE m.rows END AS recorded, r.rows AS delivered FROM manifest m LEFT JOIN receipts r USING (input_id, attempt_id, page) WHERE page = 3")
def a10_accounting_check(spark, d):
    s, m, r = _control(spark, d)
    return pages.accounting_check(s, m.withColumn("rows", F.col("rows") + F.when(F.col("page") == 3, 1).otherwise(0)), r)


@query("w4_running_bytes", f"{CTE} SELECT id, sum(line_bytes + 1) OVER (PARTITION BY input_id, attempt_id, page ORDER BY ordinal)::BIGINT AS running FROM staged")
def w4_running_bytes(spark, d):
    return order.running_bytes(_control(spark, d)[0], pages.PAGE).select("id", "running")


@query("o3_byte_limit", f"{CTE}, r AS (SELECT *, sum(line_bytes + 1) OVER (PARTITION BY input_id, attempt_id, page ORDER BY ordinal) AS u FROM staged) SELECT input_id, attempt_id, page, min(ordinal) AS first_over FROM r WHERE u > 700 GROUP BY ALL")
def o3_byte_limit(spark, d):
    return order.byte_limit(_control(spark, d)[0], pages.PAGE, 700)


@query("w5_pack_batches", f"""WITH RECURSIVE staged AS ({STAGED}), e AS (SELECT input_id, attempt_id, page, ordinal, line_bytes AS b, row_number() OVER (PARTITION BY input_id, attempt_id, page ORDER BY ordinal) AS n FROM staged),
    w AS (SELECT input_id, attempt_id, page, ordinal, n, 1::BIGINT AS batch, 1 AS k, b AS used FROM e WHERE n = 1 UNION ALL
    SELECT e.input_id, e.attempt_id, e.page, e.ordinal, e.n, CASE WHEN k = 20 OR used + 1 + b > 300 THEN batch + 1 ELSE batch END, CASE WHEN k = 20 OR used + 1 + b > 300 THEN 1 ELSE k + 1 END, CASE WHEN k = 20 OR used + 1 + b > 300 THEN b ELSE used + 1 + b END
    FROM w JOIN e ON e.input_id = w.input_id AND e.attempt_id = w.attempt_id AND e.page = w.page AND e.n = w.n + 1)
    SELECT input_id, attempt_id, page, ordinal, batch FROM w""")
def w5_pack_batches(spark, d):
    s = _control(spark, d)[0].withColumn("event_bytes", F.col("line_bytes"))
    return order.pack_batches(s, pages.PAGE, 20, 300).drop("event_bytes")


@query("w6_contiguous_prefix", f"{CTES} SELECT input_id, attempt_id, count(*) AS pages, count(*) FILTER (page < 6) AS prefix FROM manifest WHERE page <> 6 GROUP BY ALL")
def w6_contiguous_prefix(spark, d):
    return pages.contiguous_prefix(_control(spark, d)[1].where("page <> 6"))


@query("w7_delivered_prefix", f"{CTES} SELECT input_id, attempt_id, least(max(page), 3 + any_value(attempt_id)) AS delivered_through FROM manifest GROUP BY input_id, attempt_id")
def w7_delivered_prefix(spark, d):
    _, m, r = _control(spark, d)
    return pages.delivered_prefix(m, r)


@query("w8_previous_generation", f"SELECT input_id, prior, generation FROM (SELECT input_id, generation, lag(generation) OVER (PARTITION BY input_id ORDER BY generation) AS prior FROM ({CURSORS})) WHERE generation <> prior + 1")
def w8_previous_generation(spark, d):
    return pages.previous_generation(frames(spark, d, cursors=CURSORS)["cursors"])


@query("s6_read_ready_pages", f"{CTES} SELECT input_id, attempt_id, page, ordinal, line FROM staged ANTI JOIN receipts USING (input_id, attempt_id, page)")
def s6_read_ready_pages(spark, d):
    s, _, r = _control(spark, d)
    return base.read_ready_pages(s, r).select(*pages.PAGE, "ordinal", "line")


DELIVERED = "SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS event_id FROM lineitem WHERE l_orderkey % 3 = 0"
SENT = "SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS event_id FROM lineitem"


@query("j1_replay_dedup", f"SELECT DISTINCT event_id FROM ({SENT}) EXCEPT SELECT event_id FROM ({DELIVERED})")
def j1_replay_dedup(spark, d):
    f = frames(spark, d, sent=SENT, delivered=DELIVERED)
    return control.replay_dedup(f["sent"], f["delivered"])


REFERENCES = "SELECT DISTINCT input_id, attempt_id, page, page <= 2 AS receipted FROM staged WHERE page % 5 <> 0"
READY = "SELECT input_id, attempt_id, page, CASE WHEN page <= 1 THEN 'delivered' ELSE 'ready' END AS state, count(*) AS rows FROM staged WHERE page % 4 <> 0 AND page < 6 + 5 * attempt_id GROUP BY input_id, attempt_id, page"
SCANS = "SELECT input_id, attempt_id, CAST(5 AS BIGINT) AS next_page, input_id > '4' AS complete FROM staged GROUP BY input_id, attempt_id"


@query("j2_reconcile_pages", f"""{CTE}, r AS ({REFERENCES}), s AS ({READY}), c AS ({SCANS}), j AS (SELECT input_id, attempt_id, page, r.receipted, s.state, s.rows FROM r FULL JOIN s USING (input_id, attempt_id, page)),
    k AS (SELECT *, count(*) FILTER (receipted IS NULL) OVER (PARTITION BY input_id, attempt_id) AS orphans FROM j JOIN c USING (input_id, attempt_id))
    SELECT input_id, attempt_id, page, CASE WHEN receipted AND state IS NULL THEN 'already_compacted' WHEN receipted AND state = 'delivered' THEN 'compact' WHEN receipted THEN 'error:receipted_but_ready'
    WHEN receipted IS NOT NULL AND state IS NULL THEN 'error:missing' WHEN receipted IS NOT NULL THEN 'deliver' WHEN orphans > 1 THEN 'error:many_orphans'
    WHEN state = 'ready' AND NOT complete AND page = next_page AND rows > 0 THEN 'adopt_orphan' ELSE 'error:not_adoptable' END AS action FROM k""")
def j2_reconcile_pages(spark, d):
    f = frames(spark, d, staged=STAGED, references=REFERENCES, ready=READY, scans=SCANS)
    return control.reconcile_pages(f["references"], f["ready"], f["scans"])


FENCED = "SELECT CAST(o_orderkey AS BIGINT) AS input_id, CAST(o_custkey AS STRING) AS revision_fp FROM orders"
ACTIVE = "SELECT CAST(o_orderkey AS BIGINT) AS input_id, CASE WHEN o_orderkey % 3 = 0 THEN 'rising' ELSE 'batch' END AS mode, CAST(o_custkey - o_orderkey % 2 AS STRING) AS revision_fp FROM orders WHERE o_orderkey % 7 <> 0"


@query("j3_replay_fence", f"SELECT f.input_id, f.revision_fp, CASE WHEN mode IS NULL THEN 'error:absent' WHEN mode = 'rising' THEN 'leave' WHEN a.revision_fp = f.revision_fp THEN 'deliver' ELSE 'error:changed' END AS action FROM ({FENCED}) f LEFT JOIN ({ACTIVE}) a USING (input_id)")
def j3_replay_fence(spark, d):
    f = frames(spark, d, ready=FENCED, active=ACTIVE)
    return control.replay_fence(f["ready"], f["active"])


FENCES = "SELECT input_id, attempt_id, page, CAST(page AS STRING) AS revision_fp, CAST(rows + page % 3 AS STRING) AS request_fp, CAST(bytes - page % 2 AS STRING) AS stream_digest FROM manifest"
FOUND = "SELECT input_id, attempt_id, page, CAST(page AS STRING) AS revision_fp, CAST(rows AS STRING) AS request_fp, CAST(bytes AS STRING) AS stream_digest FROM manifest"


@query("j5_validate_page", f"{CTES} SELECT input_id, attempt_id, page, concat_ws(',', CASE WHEN page % 3 <> 0 THEN 'request_fp' END, CASE WHEN page % 2 <> 0 THEN 'stream_digest' END) AS wrong FROM manifest WHERE page % 6 <> 0")
def j5_validate_page(spark, d):
    f = frames(spark, d, staged=STAGED, manifest=MANIFEST, fences=FENCES, found=FOUND)
    return control.validate_page(f["found"], f["fences"])


PREPARED = "SELECT CAST(o_orderkey AS BIGINT) AS input_id, 'l' AS lineage_fp, 'c' AS cursor_fp, CAST(o_custkey AS STRING) AS revision_fp FROM orders"
STATE = "SELECT CAST(o_orderkey AS BIGINT) AS input_id, CASE WHEN o_orderkey % 11 = 0 THEN 'm' ELSE 'l' END AS lineage_fp, 'c' AS cursor_fp, CAST(o_custkey - o_orderkey % 2 AS STRING) AS revision_fp, o_orderkey % 3 = 0 AS active, o_orderkey % 5 = 0 AS spooled FROM orders WHERE o_orderkey % 13 <> 0"


@query("j6_revision_activation", "SELECT o_orderkey AS input_id, CASE WHEN o_orderkey % 13 = 0 THEN 'create' WHEN o_orderkey % 11 = 0 THEN 'identity_change' WHEN o_orderkey % 2 = 0 THEN 'same' WHEN o_orderkey % 3 = 0 THEN 'blocked_active' WHEN o_orderkey % 5 = 0 THEN 'blocked_spool' ELSE 'activate' END AS action FROM orders")
def j6_revision_activation(spark, d):
    f = frames(spark, d, prepared=PREPARED, state=STATE)
    return control.revision_activation(f["prepared"], f["state"])


HELD = """SELECT CAST(o_orderkey AS STRING) AS input_id, CAST(o_custkey % 3 AS BIGINT) AS generation, 'rising' AS mode, CASE WHEN o_orderkey % 11 = 0 THEN 'm' ELSE 'l' END AS lineage_fp, 'c' AS cursor_fp,
 CAST(o_custkey - o_orderkey % 2 AS STRING) AS revision_fp, CAST(o_orderkey % 17 AS STRING) AS schema_fp FROM orders WHERE o_orderkey % 13 <> 0
 UNION ALL SELECT CAST(o_orderkey AS STRING), -1, 'rising', 'old', 'c', 'old', 'old' FROM orders WHERE o_orderkey % 13 <> 0"""
NOW = "SELECT CAST(o_orderkey AS STRING) AS input_id, 'rising' AS mode, 'l' AS lineage_fp, 'c' AS cursor_fp, CAST(o_custkey AS STRING) AS revision_fp, CAST(o_orderkey % 17 + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS STRING) AS schema_fp FROM orders"


@query("t8_identity_fence", """SELECT o_orderkey::VARCHAR AS input_id, CASE WHEN o_orderkey % 13 = 0 THEN 'create' WHEN o_orderkey % 11 = 0 THEN 'identity_change' WHEN o_orderkey % 2 = 1 AND o_orderkey % 5 = 0 THEN 'blocked_spool'
    WHEN o_orderkey % 7 = 0 THEN 'schema_drift' WHEN o_orderkey % 2 = 0 THEN 'same' ELSE 'activate' END AS action FROM orders""")
def t8_identity_fence(spark, d):
    """What a run over as many inputs as there are orders would be let do, by the identities that they had."""
    root = scratch_dir(spark, "fence")
    f = frames(spark, d, held=HELD, now=NOW)
    state.append(f["held"], root, "identities", large=True)
    waiting = table(spark, d, "orders").where("o_orderkey % 5 = 0").select(F.col("o_orderkey").cast("string").alias("input_id"), F.lit(1).alias("unsent"))
    return fence(spark, root, f["now"], waiting).select("input_id", "action")


@query("u2_detached_identities", "SELECT o_custkey AS input_id FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0")
def u2_detached_identities(spark, d):
    return control.detached_identities(table(spark, d, "orders").select(F.col("o_custkey").alias("input_id")), table(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("input_id")))


@query("u3_duplicate_input_ids", "SELECT o_custkey AS input_id, count(*) AS n FROM orders GROUP BY ALL HAVING n > 1")
def u3_duplicate_input_ids(spark, d):
    return control.duplicate_input_ids(table(spark, d, "orders").select(F.col("o_custkey").alias("input_id")))


@query("u1_union_inputs", "SELECT input_id, id, count(*) AS n FROM (SELECT 'a' AS input_id, o_orderkey AS id FROM orders UNION ALL SELECT 'b', l_orderkey FROM lineitem) GROUP BY ALL")
def u1_union_inputs(spark, d):
    o, li = table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"))
    return base.collect_inputs({"a": o, "b": li}).groupBy("input_id", "id").agg(F.count("*").alias("n"))


INPUTS = """SELECT CASE WHEN c_custkey % 10 = 0 THEN concat(c_name, ' x') ELSE replace(c_name, '#', '_') END AS name, CASE WHEN c_custkey % 9 = 0 THEN 'oracle' WHEN c_custkey % 14 = 0 THEN 'db2' ELSE 'postgres' END AS connector,
 CASE WHEN c_custkey % 4 = 0 THEN 'batch' ELSE 'rising' END AS mode, CASE WHEN c_custkey % 8 <> 0 THEN concat('00000000-0000-4000-8000-', lpad(CAST(c_custkey AS STRING), CASE WHEN c_custkey % 15 = 0 THEN 11 ELSE 12 END, '0')) END AS input_id,
 CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 12 = 0 THEN '' ELSE 'ts' END AS ts_field, CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 21 = 0 THEN 'ts' ELSE 'id' END AS id_field,
 CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE CAST(c_custkey % 3 - 1 AS BIGINT) END AS overlap_secs, CAST((c_custkey % 30) * 5000 AS BIGINT) AS max_rows, CAST(1000 AS BIGINT) AS max_bytes FROM customer"""
_ISSUES = [
    ("name NOT SIMILAR TO '[A-Za-z0-9_.:/+-]{1,128}'", "name"), ("connector = 'db2'", "connector"), ("mode = 'rising' AND connector = 'oracle'", "oracle_is_batch_only"), ("max_rows NOT BETWEEN 1 AND 100000", "max_rows"),
    ("mode = 'batch' AND (input_id IS NOT NULL OR ts_field IS NOT NULL OR id_field IS NOT NULL OR overlap_secs IS NOT NULL)", "rising_keys_in_batch"),
    ("mode = 'rising' AND (input_id IS NULL OR length(input_id) <> 36)", "input_id"), ("mode = 'rising' AND coalesce(ts_field, '') = ''", "ts_field"), ("mode = 'rising' AND (coalesce(id_field, '') = '' OR id_field = ts_field)", "id_field"), ("mode = 'rising' AND coalesce(overlap_secs, 0) < 0", "overlap")]


@query("c19_input_issues", f"WITH i AS ({INPUTS}) " + " UNION ALL ".join(f"SELECT name, '{n}' AS issue FROM i WHERE {w}" for w, n in _ISSUES))
def c19_input_issues(spark, d):
    return inputs.input_issues(frames(spark, d, inputs=INPUTS)["inputs"])


# ---- durable progress --------------------------------------------------------------------------------------------

STARTABLE = "SELECT CAST(c_custkey AS BIGINT) AS input_id, c_custkey % 6 = 0 AS disabled FROM customer"
GENERATIONS = "SELECT CAST(c_custkey AS BIGINT) AS input_id, CAST(c_custkey % 4 AS BIGINT) AS generation, CAST(CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 50 END AS BIGINT) AS ts_us, CAST(1 AS BIGINT) AS id FROM customer"


@query("p1_start_attempts", f"""WITH i AS ({STARTABLE}), a AS ({ATTEMPTS}), g AS ({GENERATIONS}) SELECT i.input_id, coalesce((SELECT max(attempt_id) FROM a WHERE a.input_id = i.input_id), 0) + 1 AS attempt_id, coalesce(g.generation, 0) AS generation,
    'in_progress' AS collection, 'in_progress' AS delivery FROM i LEFT JOIN g USING (input_id) WHERE NOT disabled AND i.input_id NOT IN (SELECT input_id FROM a WHERE active)""")
def p1_start_attempts(spark, d):
    f = frames(spark, d, startable=STARTABLE, attempts=ATTEMPTS, generations=GENERATIONS)
    return control.start_attempts(f["startable"], f["attempts"], f["generations"])


@query("p3_adopt_orphans", f"{CTES} SELECT input_id, attempt_id, page, rows, page + 1 AS next_page, NOT page < (SELECT max(page) FROM manifest n WHERE n.input_id = m.input_id AND n.attempt_id = m.attempt_id) AS complete FROM manifest m WHERE page % 6 = 0")
def p3_adopt_orphans(spark, d):
    s = pages.page_summary(_control(spark, d)[0])
    actions = s.select(*pages.PAGE, F.when(F.col("page") % 6 == 0, "adopt_orphan").otherwise("deliver").alias("action"))
    return control.adopt_orphans(actions, s).select(*pages.PAGE, "rows", "next_page", "complete")


@query("p4_record_empty_completion", f"WITH a AS ({ATTEMPTS}) SELECT input_id, attempt_id, 'completed' AS collection, 0::BIGINT AS coll_rows FROM a WHERE collection = 'in_progress' AND attempt_id % 3 <> 0")
def p4_record_empty_completion(spark, d):
    a = frames(spark, d, attempts=ATTEMPTS)["attempts"]
    return control.record_empty_completion(a, a.where("attempt_id % 3 = 0").select("input_id", "attempt_id", F.lit(1).alias("page")))


@query("p5_record_receipts", f"{CTES} SELECT input_id, attempt_id, page, rows FROM manifest WHERE page > 2 AND page < 7")
def p5_record_receipts(spark, d):
    m = _control(spark, d)[1]
    return control.record_receipts(m.where("page <= 2").select(*pages.PAGE, "rows"), m.where("page > 2 and page <> 7").select(*pages.PAGE, "rows"))


RECOVERY = "CASE WHEN collection = 'failed' THEN 'replay:collection_failed' WHEN delivery = 'failed' THEN 'replay:delivery_failed' WHEN delivery = 'uncertain' THEN 'replay:delivery_uncertain' WHEN collection = 'in_progress' THEN 'replay:collection_in_progress' WHEN delivery = 'in_progress' THEN 'replay:delivery_in_progress' WHEN coll_rows <> deliv_rows THEN 'replay:row_count_mismatch' ELSE 'commit' END"


@query("p7_recover", f"SELECT input_id, attempt_id, {RECOVERY} AS action FROM ({ATTEMPTS})")
def p7_recover(spark, d):
    return control.recovery(frames(spark, d, attempts=ATTEMPTS)["attempts"])


@query("p6_commit_ready", f"""WITH a AS (SELECT *, CASE WHEN coll_rows > 0 THEN attempt_id % 60 END AS ct FROM ({ATTEMPTS})), g AS ({GENERATIONS})
    SELECT a.input_id, attempt_id, a.generation + 1 AS generation, coalesce(ct, g.ts_us) AS ts_us, CASE WHEN ct IS NOT NULL THEN 1 WHEN g.ts_us IS NOT NULL THEN g.id END AS id, ct IS NOT NULL AND (g.ts_us IS NULL OR ct > g.ts_us) AS advanced
    FROM a LEFT JOIN g USING (input_id) WHERE {RECOVERY} = 'commit' AND coalesce(g.generation, 0) = a.generation""")
def p6_commit_ready(spark, d):
    f = frames(spark, d, attempts=ATTEMPTS, generations=GENERATIONS)
    at = F.when(F.col("coll_rows") > 0, F.struct((F.col("attempt_id") % 60).alias("ts_us"), F.lit(1).cast("long").alias("id")))
    return control.commit_ready(f["attempts"].withColumn("candidate", at), f["generations"])


@query("p8_compact_pages", f"{CTE} SELECT id FROM staged WHERE page > 3 + attempt_id")
def p8_compact_pages(spark, d):
    s, m, r = _control(spark, d)
    return control.compact_pages(s, pages.delivered_prefix(m, r)).select("id")


@query("x3_progress_check", f"{CTES} SELECT input_id, attempt_id, page, CASE WHEN page % 4 = 0 THEN 'truncated_without_resume' ELSE 'resume_not_advancing' END AS issue FROM (SELECT *, max(page) OVER (PARTITION BY input_id, attempt_id) AS top FROM manifest) WHERE (page % 4 = 0 AND page < top) OR page = 7")
def x3_progress_check(spark, d):
    s = pages.page_summary(_control(spark, d)[0])
    first = F.struct(F.lit(-1).cast("long").alias("ts_us"), F.lit(0).cast("long").alias("id"))
    return pages.progress_check(s.withColumn("resume", F.when(F.col("page") % 4 == 0, None).when(F.col("page") == 7, first).otherwise(F.col("resume"))))


@query("x4_manifest_check", f"{CTES} SELECT input_id, attempt_id, page, CASE page % 4 WHEN 0 THEN 'empty_page_with_cursor' WHEN 1 THEN 'rows_without_cursor' ELSE 'candidate_before_resume' END AS issue FROM manifest WHERE page % 4 < 3")
def x4_manifest_check(spark, d):
    s = pages.page_summary(_control(spark, d)[0])
    low = F.struct(F.lit(-1).cast("long").alias("ts_us"), F.lit(0).cast("long").alias("id"))
    k = F.col("page") % 4
    return pages.manifest_check(s.withColumn("rows", F.when(k == 0, 0).otherwise(F.col("rows"))).withColumn("candidate", F.when(k == 1, None).when(k == 2, low).otherwise(F.col("candidate"))))


# ---- column functions --------------------------------------------------------------------------------------------


@query("c1_ndjson_line", f"SELECT event_id, {LINE} AS line FROM events")
def c1_ndjson_line(spark, d):
    e = event_base(spark, d)
    return e.select("event_id", encode.ndjson_line(e, list(COLUMNS)).alias("line"))


@query("c2_json_string", "SELECT page_id, to_json(html)::VARCHAR AS j FROM pages")
def c2_json_string(spark, d):
    return table(spark, d, "pages").select("page_id", encode.json_string(F.col("html")).alias("j"))


@query("c3_json_number", "SELECT l_orderkey, l_linenumber, l_partkey::VARCHAR AS j FROM lineitem")
def c3_json_number(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", encode.json_number(F.col("l_partkey")).alias("j"))


@query("c4_json_float", "SELECT o_orderkey, o_totalprice::VARCHAR AS j, (o_totalprice * 1e6)::VARCHAR AS large, CASE WHEN o_orderkey % 9 > 0 THEN ((o_orderkey % 9) / 10000)::VARCHAR END AS small FROM orders")
def c4_json_float(spark, d):
    price, tiny = F.col("o_totalprice"), F.when(F.col("o_orderkey") % 9 > 0, (F.col("o_orderkey") % 9) / 10000)
    return table(spark, d, "orders").select("o_orderkey", encode.json_float(price).alias("j"), encode.json_float(price * 1e6).alias("large"), encode.json_float(tiny).alias("small"))


@query("c5_json_decimal", """SELECT c_custkey, '"' || c_acctbal::DECIMAL(38,6)::VARCHAR || '"' AS j FROM customer""")
def c5_json_decimal(spark, d):
    return table(spark, d, "customer").select("c_custkey", encode.json_decimal(F.col("c_acctbal").cast("decimal(38,6)")).alias("j"))


@query("c6_json_binary", """SELECT doc_id, '"hex:' || lower(hex(encode(text))) || '"' AS j FROM documents""")
def c6_json_binary(spark, d):
    return table(spark, d, "documents").select("doc_id", encode.json_binary(F.col("text").cast("binary")).alias("j"))


@query("c7_json_raw", "SELECT event_id, CASE WHEN event_id % 10 < 7 THEN props END AS j FROM events")
def c7_json_raw(spark, d):
    bad = F.when(F.col("event_id") % 10 == 7, F.concat("props", F.lit(" x"))).when(F.col("event_id") % 10 == 8, F.lit('{"a": NaN}')).when(F.col("event_id") % 10 == 9, F.lit("{'a': 1}"))
    e = table(spark, d, "events").select("event_id", F.coalesce(bad, F.col("props")).alias("j"))
    return e.select("event_id", F.when(~encode.rejects_raw(F.col("j")), encode.json_raw(F.col("j"))).alias("j"))


@query("c8_json_date", """SELECT o_orderkey, '"' || strftime(o_orderdate, '%Y-%m-%d') || '"' AS j FROM orders""")
def c8_json_date(spark, d):
    return table(spark, d, "orders").select("o_orderkey", encode.json_date(F.col("o_orderdate").cast("date")).alias("j"))


@query("c9_json_time", """SELECT event_id, '"' || strftime(ts, '%H:%M:%S.%f') || '"' AS j FROM events""")
def c9_json_time(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", encode.json_time(F.pmod(ts_us(e, SPEC), F.lit(86_400_000_000))).alias("j"))


@query("c10_json_timestamp", """SELECT event_id, '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"' AS j FROM events""")
def c10_json_timestamp(spark, d):
    return table(spark, d, "events").select("event_id", encode.json_timestamp(F.col("ts")).alias("j"))


@query("c11_json_timestamp_utc", """SELECT event_id, '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"' AS j FROM events""")
def c11_json_timestamp_utc(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", encode.json_timestamp_utc(F.timestamp_micros(ts_us(e, SPEC))).alias("j"))


_HASH = "md5(CAST(c_custkey AS VARCHAR))"
_GUID = f"concat(substr({_HASH}, 1, 8), '-', substr({_HASH}, 9, 4), '-', substr({_HASH}, 13, 4), '-', substr({_HASH}, 17, 4), '-', substr({_HASH}, 21, 12))"


@query("c12_json_uuid", f"""SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN '"' || {_GUID} || '"' END AS j FROM customer""")
def c12_json_uuid(spark, d):
    text = F.expr(_GUID.replace("VARCHAR", "STRING"))
    u = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 > 0, F.upper(text)).otherwise(F.substring(text, 1, 35)).alias("u"))
    return u.select("c_custkey", F.when(~encode.rejects_uuid(F.col("u")), encode.json_uuid(F.col("u"))).alias("j"))


@query("c13_json_bool", "SELECT o_orderkey, (o_totalprice > 100000)::VARCHAR AS j FROM orders")
def c13_json_bool(spark, d):
    return table(spark, d, "orders").select("o_orderkey", encode.json_bool(F.col("o_totalprice") > 100000).alias("j"))


@query("c14_cursor_bytes", f"SELECT lower(printf('0001%016x%016x', {US}, event_id)) AS raw, {US} AS ts_us, event_id AS id FROM events")
def c14_cursor_bytes(spark, d):
    e = table(spark, d, "events")
    raw = e.select(ids.cursor_bytes(ts_us(e, SPEC), F.col("event_id")).alias("b"))
    return raw.select(F.lower(F.hex("b")).alias("raw"), ids.cursor_from_bytes(F.col("b")).alias("c")).select("raw", "c.ts_us", "c.id")


@query("c15_rising_event_id", f"SELECT event_id, {EVENT_ID} AS eid FROM events")
def c15_rising_event_id(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", ids.rising_event_id(*EVENTS.fingerprints(), ts_us(e, SPEC), F.col("event_id")).alias("eid"))


@query("c16_batch_event_id", f"SELECT event_id, sha256('{ids.BATCH_EVENT}'::BLOB || unhex('aa') || unhex('bb') || unhex(printf('%016x', row_number() OVER (ORDER BY ts, event_id)))) AS eid FROM events")
def c16_batch_event_id(spark, d):
    e = table(spark, d, "events")
    n = order.with_ordinal(e.select(ts_us(e, SPEC).alias("ts_us"), F.col("event_id").alias("id")), buckets=8)
    return n.select(F.col("id").alias("event_id"), ids.batch_event_id(F.lit("aa"), F.lit("bb"), F.col("ordinal")).alias("eid"))


def _t(tag: int, col: str) -> str:
    return f"unhex('{tag:02x}') || unhex(printf('%08x', strlen({col}))) || encode({col})"


_VERSION = "unhex('010001')"


@query("c17_fingerprints", f"""WITH i AS ({INPUTS}), a AS (SELECT name, mode, connector, max_rows, coalesce(ts_field, '') AS ts, coalesce(overlap_secs, 0) + 1 AS o FROM i),
    b AS (SELECT *, sha256('{ids.QUERY}'::BLOB || {_VERSION} || {_t(2, 'connector')} || {_t(3, 'ts')}) AS query_fp, sha256('{ids.CURSOR}'::BLOB || {_VERSION} || {_t(2, 'ts')} || {_t(3, 'name')}) AS cursor_fp FROM a),
    c AS (SELECT *, sha256('{ids.LINEAGE}'::BLOB || {_VERSION} || {_t(2, 'mode')} || {_t(3, 'name')} || {_t(4, 'connector')} || {_t(5, 'ts')} || {_t(6, 'ts')} || {_t(7, 'ts')} || unhex('08') || unhex(query_fp)) AS lineage_fp FROM b)
    SELECT name, max_rows, query_fp, cursor_fp, lineage_fp, sha256('{ids.REVISION}'::BLOB || {_VERSION} || unhex('02') || unhex(lineage_fp) || unhex('03') || unhex(cursor_fp) || unhex('04') || unhex(printf('%016x%08x', o, 500000 * 1000)) || unhex('05') || unhex(printf('%016x', max_rows)) || unhex('06') || unhex(printf('%016x', 1000)) || unhex('0701')) AS revision_fp FROM c""")
def c17_fingerprints(spark, d):
    i = frames(spark, d, inputs=INPUTS)["inputs"].select("name", "mode", "connector", "max_rows", F.coalesce("ts_field", F.lit("")).alias("ts"), (F.coalesce("overlap_secs", F.lit(0)) + 1).alias("o"))
    c = F.col
    f = i.withColumn("query_fp", ids.query_fingerprint(c("connector"), c("ts"))).withColumn("cursor_fp", ids.cursor_fingerprint(c("ts"), c("name")))
    f = f.withColumn("lineage_fp", ids.lineage_fingerprint(c("mode"), c("name"), c("connector"), c("ts"), c("ts"), c("ts"), c("query_fp")))
    return f.select("name", "max_rows", "query_fp", "cursor_fp", "lineage_fp", ids.revision_fingerprint(c("lineage_fp"), c("cursor_fp"), c("o") * 1_000_000 + 500_000, c("max_rows"), F.lit(1000), F.lit(True)).alias("revision_fp"))


@query("c18_request_fingerprint", f"""SELECT o_orderkey, sha256('{ids.REQUEST}'::BLOB || unhex('ab') || CASE WHEN o_orderkey % 3 = 0 THEN unhex('00') ELSE unhex(printf('010001%016x%016x', o_custkey, o_orderkey)) END || CASE WHEN o_orderkey % 2 = 0 THEN unhex('00') ELSE unhex(printf('010001%016x%016x', o_orderkey, o_custkey)) END) AS fp FROM orders""")
def c18_request_fingerprint(spark, d):
    at = lambda a, b: F.struct(F.col(a).alias("ts_us"), F.col(b).alias("id"))
    committed = F.when(F.col("o_orderkey") % 3 != 0, at("o_custkey", "o_orderkey"))
    resume = F.when(F.col("o_orderkey") % 2 != 0, at("o_orderkey", "o_custkey"))
    return table(spark, d, "orders").select("o_orderkey", ids.request_fingerprint(F.lit("ab"), committed, resume).alias("fp"))


TEXTS = """SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN n WHEN 1 THEN concat(n, '0') WHEN 2 THEN concat('+', n) WHEN 3 THEN concat('0', n) WHEN 4 THEN '1e3' WHEN 5 THEN concat('-', replace(n, '-', '')) WHEN 6 THEN '12345678901.00' ELSE '-0.50' END AS v
 FROM (SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR(40)) AS n FROM customer) t"""


@query("c20_strict_decimal", f"SELECT c_custkey, CASE WHEN regexp_full_match(v, '-?(0|[1-9][0-9]*)\\.[0-9]{{2}}') AND length(regexp_replace(regexp_extract(v, '^-?([0-9]+)', 1), '^0$', '')) <= 8 THEN v::DECIMAL(10,2)::VARCHAR END AS n FROM ({TEXTS})")
def c20_strict_decimal(spark, d):
    return frames(spark, d, texts=TEXTS)["texts"].select("c_custkey", strict.strict_decimal(F.col("v"), 10, 2).cast("string").alias("n"))


@query("c21_unsigned_range", "SELECT l_orderkey, l_linenumber, CASE WHEN v BETWEEN 0 AND 255 THEN v END AS u8, CASE WHEN v >= 0 THEN v END AS u32, CASE WHEN v >= 0 THEN v::VARCHAR END AS u64 FROM (SELECT *, l_partkey - 100 AS v FROM lineitem)")
def c21_unsigned_range(spark, d):
    v = F.col("l_partkey") - 100
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", strict.unsigned_range(v, 8).alias("u8"), strict.unsigned_range(v, 32).alias("u32"), strict.unsigned_range(v, 64).cast("string").alias("u64"))


@query("c22_bit_bool", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN false WHEN 1 THEN true END AS b FROM orders")
def c22_bit_bool(spark, d):
    return table(spark, d, "orders").select("o_orderkey", strict.bit_bool(ids.be(F.col("o_orderkey") % 3, 1)).alias("b"))


@query("c23_money", "SELECT c_custkey, (c_acctbal::DECIMAL(18,4))::VARCHAR AS m, CASE WHEN c_custkey % 2 = 0 THEN (c_acctbal::DECIMAL(18,4))::VARCHAR END AS s FROM customer")
def c23_money(spark, d):
    text = F.col("c_acctbal").cast("decimal(18,4)").cast("string")
    big = F.when(F.col("c_custkey") % 2 == 0, text).otherwise("214748.3648")
    return table(spark, d, "customer").select("c_custkey", strict.money(text).cast("string").alias("m"), strict.smallmoney(big).cast("string").alias("s"))


DATES = "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '0000-00-00' WHEN 1 THEN '2023-02-30' WHEN 2 THEN concat(t, ' 00:00:00') WHEN 3 THEN '2024-00-10' ELSE t END AS v FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS t FROM orders) t"


@query("c24_strict_date", f"SELECT o_orderkey, CASE WHEN o_orderkey % 6 > 3 THEN v END AS v FROM ({DATES})")
def c24_strict_date(spark, d):
    return frames(spark, d, dates=DATES)["dates"].select("o_orderkey", strict.strict_date(F.col("v")).cast("string").alias("v"))


@query("c25_exact_micros", f"SELECT event_id, CASE WHEN event_id % 3 < 2 THEN {US} END AS us FROM events")
def c25_exact_micros(spark, d):
    e = table(spark, d, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, "000").otherwise("001"))
    t = e.select("event_id", strict.exact_micros(text).alias("ts"))
    return t.select("event_id", ts_us(t, SPEC).alias("us"))


@query("c26_offset_timestamp_text", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' +02:00' END AS v FROM events")
def c26_offset_timestamp_text(spark, d):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.when(F.col("event_id") % 2 == 0, " +02:00").otherwise(" CET"))
    return table(spark, d, "events").select("event_id", strict.offset_timestamp_text(text).alias("v"))


@query("c27_value_size_guard", "SELECT doc_id, coalesce(strlen(text) <= 4000, true) AS fits FROM documents")
def c27_value_size_guard(spark, d):
    return table(spark, d, "documents").select("doc_id", strict.value_size_guard(F.col("text"), 4000).alias("fits"))


ENVELOPE = f"""'{{"time":1700000000.5,"index":"main","sourcetype":"rows","source":"a \\"b\\"","fields":{{"event_id":"' || {EVENT_ID} || '"}},"event":' || {LINE} || '}}'"""


def _envelopes(spark, d):
    e = event_base(spark, d)
    eid = ids.rising_event_id(*EVENTS.fingerprints(), ts_us(e, SPEC), F.col("event_id"))
    return e.select("event_id", strict.envelope(encode.ndjson_line(e, list(COLUMNS)), eid, F.lit("1700000000.5"), "main", "rows", 'a "b"').alias("event"))


@query("c28_envelope", f"SELECT event_id, {ENVELOPE} AS event FROM events")
def c28_envelope(spark, d):
    return _envelopes(spark, d)


@query("c29_event_size_guard", f"SELECT event_id, strlen({ENVELOPE}) <= 320 AS fits FROM events")
def c29_event_size_guard(spark, d):
    return _envelopes(spark, d).select("event_id", strict.event_size_guard(F.col("event"), 320).alias("fits"))


# ---- schemas, sinks, streams -------------------------------------------------------------------------------------


@query("j4_schema_diff", """SELECT o_orderkey AS position, o_orderstatus AS expected_name, CASE WHEN o_orderkey % 5 > 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE o_orderstatus END END AS observed_name
    FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 3 = 0""")
def j4_schema_diff(spark, d):
    o = table(spark, d, "orders")
    rows = o.select(F.col("o_orderkey").alias("position"), F.col("o_orderstatus").alias("name"), F.col("o_orderpriority").alias("type"), F.lit(True).alias("nullable"))
    seen = rows.where("position % 5 > 0").withColumn("name", F.when(F.col("position") % 3 == 0, "x").otherwise(F.col("name")))
    return control.schema_diff(rows, seen).select("position", "expected_name", "observed_name")


@query("k1_write_ndjson", f"SELECT {LINE} AS line FROM events")
def k1_write_ndjson(spark, d):
    e = event_base(spark, d)
    path = scratch_dir(spark, "ndjson")
    sinks.write_ndjson(e.select(encode.ndjson_line(e, list(COLUMNS)).alias("line")), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("k2_write_pages", f"{CTE} SELECT input_id, attempt_id, page, count(*) AS rows, sum(line_bytes + 1)::BIGINT AS bytes FROM staged GROUP BY ALL")
def k2_write_pages(spark, d):
    root = scratch_dir(spark, "pages")
    staged, _, _ = _control(spark, d)
    sinks.write_pages(staged, pages.page_summary(staged), root)
    told = spark.read.parquet(f"{root}/manifest").select(*pages.PAGE, "rows", "bytes")
    found = spark.read.parquet(f"{root}/events").groupBy(*pages.PAGE).agg(F.count("*").alias("n"))
    return told.join(found, pages.PAGE).where("n = rows").drop("n")


@query("k4_write_metrics", f"SELECT *, CASE WHEN duration_ns > 0 THEN (rows::HUGEINT * 1000000000 // duration_ns)::BIGINT END AS rows_per_second, CASE WHEN duration_ns > 0 THEN (bytes::HUGEINT * 1000000000 // duration_ns)::BIGINT END AS bytes_per_second FROM ({RUNS})")
def k4_write_metrics(spark, d):
    path = scratch_dir(spark, "metrics")
    sinks.write_metrics(frames(spark, d, runs=RUNS)["runs"], path)
    return spark.read.parquet(path)


@query("r3_stream_dedup", "SELECT DISTINCT l_orderkey * 10 + l_linenumber AS event_id FROM lineitem")
def r3_stream_dedup(spark, d):
    root = scratch_dir(spark, "stream")
    rows = spark.readStream.schema(table(spark, d, "lineitem").schema).parquet(f"{d}/lineitem.parquet*")
    events = rows.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_id"), F.col("l_shipdate").cast("timestamp").alias("ts"))
    q = stream_dedup(events, "ts", "10000 days").writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out").select("event_id")


def _receipts(events: DataFrame) -> DataFrame:
    return events.groupBy(*pages.PAGE).agg(F.count("*").alias("rows"))


_PAGES = f"SELECT page, count(*) AS rows, sum(strlen(line) + 1)::BIGINT AS bytes FROM (SELECT (row_number() OVER (ORDER BY ts, event_id) - 1) // 500 + 1 AS page, {LINE} AS line FROM events WHERE {PAST}) GROUP BY page"


@query("p2_seal_page", _PAGES)
def p2_seal_page(spark, d):
    root = scratch_dir(spark, "sealed")
    publish(checked_scan(event_base(spark, d), EVENTS, AT), EVENTS, 1, root, AT)
    return state.table(spark, root, "manifest").select("page", "rows", "bytes")


@query("r1_deliver_stream", _PAGES.replace(", sum(strlen(line) + 1)::BIGINT AS bytes", ""))
def r1_deliver_stream(spark, d):
    root = scratch_dir(spark, "delivered")
    publish(checked_scan(event_base(spark, d), EVENTS, AT), EVENTS, 1, root, AT)
    deliver_stream(spark, root, f"{root}/checkpoint", _receipts).awaitTermination()
    return state.table(spark, root, "receipts").select("page", "rows")


def _to_files(path: str):
    """A sink that appends the events to Parquet files and gives their receipts."""

    def send(events: DataFrame) -> DataFrame:
        events.write.mode("append").parquet(path)
        return _receipts(events)

    return send


@query("r2_rising_stream", f"SELECT event_id AS id, {US} AS ts_us FROM events")
def r2_rising_stream(spark, d):
    root, path = scratch_dir(spark, "rising"), f"{d}/events.parquet*"
    inp = Input("events", SPEC, ("event_id", "ts", "event_type"), query="events", max_rows=2_000)
    rising_stream(spark, path, table(spark, d, "events").schema, inp, root, f"{root}/checkpoint", _to_files(f"{root}/out")).awaitTermination()
    return spark.read.schema("id long, ts_us long").parquet(f"{root}/out")


@query("r2_resumed_scan", f"SELECT attempt_id, count(*) AS rows, max(event_id) AS last FROM (SELECT event_id, CASE WHEN {US} < {RESUME.ts_us} THEN 1 ELSE 2 END::BIGINT AS attempt_id FROM events) GROUP BY attempt_id")
def r2_resumed_scan(spark, d):
    """A run that fails in delivery; then the base has grown: what was sealed goes out first, the rest after it."""
    root = scratch_dir(spark, "resumed")
    inp = Input("007", SPEC, ("event_id", "ts", "event_type"), query="events", max_rows=2_000)
    e = table(spark, d, "events")

    def down(_: DataFrame) -> DataFrame:
        raise ConnectionError("down")

    try:
        run_inputs(spark, [(inp, e.where(F.col("ts") < F.lit("2024-01-03").cast("timestamp_ntz")))], root, down)
    except ConnectionError:
        run_inputs(spark, [(inp, e)], root, _to_files(f"{root}/out"))
    sent = spark.read.parquet(f"{root}/out").where("input_id = '007'")
    return sent.groupBy("attempt_id").agg(F.count("*").alias("rows"), F.max("id").alias("last"))


@query("s1_batch_run", f"""WITH o AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
    SELECT input_id, count(*) AS rows, min(event_id) AS first FROM (
    SELECT 'orders' AS input_id, sha256('{ids.BATCH_EVENT}'::BLOB || unhex('{_h(ids.INPUT, _n(1, 1, 2), _s(2, "orders"))}') || unhex('{hashlib.sha256(b"run 1").hexdigest()}') || unhex(printf('%016x', n))) AS event_id FROM o WHERE n <= 5000
    UNION ALL SELECT 'events', {EVENT_ID.replace(_identity(EVENTS), _identity(Input("events", SPEC, (), query="events")))} FROM events) GROUP BY input_id""")
def s1_batch_run(spark, d):
    """A batch input and a rising input in one run, sealed, delivered and committed together."""
    root = scratch_dir(spark, "runs")
    batch = BatchInput("orders", "run 1", ("o_orderkey", "o_orderstatus"), (F.col("o_orderdate").asc(), F.col("o_orderkey").asc()), 5_000)
    rising = Input("events", SPEC, ("event_id", "ts"), query="events", max_rows=2_000)
    run_inputs(spark, [(batch, table(spark, d, "orders")), (rising, table(spark, d, "events"))], root, _to_files(f"{root}/out"))
    return spark.read.parquet(f"{root}/out").groupBy("input_id").agg(F.count("*").alias("rows"), F.min("event_id").alias("first"))


def _derby(spark, df: DataFrame, types: str = "") -> str:
    """The address of a new database in memory whose table T has the rows of df."""
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex}"
    o = {"url": f"{url};create=true", "dbtable": "T", "driver": base.DRIVERS["derby"], "batchsize": "10000", "numPartitions": "1"}
    df.write.format("jdbc").options(**o, **({"createTableColumnTypes": types} if types else {})).save()
    return url


@query("s3_balanced_reads", "SELECT o_orderkey, o_custkey, o_orderstatus, TRUE AS balanced FROM orders")
def s3_balanced_reads(spark, d):
    """Orders from a database, read side by side by ranges of a skewed key that its own counts make about equal."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    skewed = (F.col("o_orderkey") * F.when(F.col("o_orderkey") % 3 == 0, 1000).otherwise(1) + 0).cast("long").alias("k")
    url = _derby(spark, o.select(skewed, "*"))
    text = 'SELECT "k", "o_orderkey", "o_custkey", "o_orderstatus" FROM T'
    ranges = catalog.balanced_ranges(spark, url, text, "derby", "k", 6)
    even = len(ranges.rows) >= 5 and max(ranges.rows) <= 1.5 * min(ranges.rows)
    return base.jdbc_base(spark, url, text, "derby", predicates=ranges.predicates).select("o_orderkey", "o_custkey", "o_orderstatus", F.lit(even).alias("balanced"))


@query("t1_catalog_types", "SELECT o_orderkey, o_totalprice::DECIMAL(15,2) AS o_totalprice, o_orderstatus, o_orderdate::DATE AS day, 'o_orderkey BIGINT, o_totalprice DECIMAL(15,2), o_orderstatus VARCHAR(1), day DATE' AS native FROM orders")
def t1_catalog_types(spark, d):
    """Orders from a database, cast to the types that its catalog tells, with the guard on the size of values."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"), "o_orderstatus", F.col("o_orderdate").cast("date").alias("day"))
    url = _derby(spark, o, "o_orderstatus VARCHAR(1)")
    types = catalog.catalog_types(spark, url, "derby", "APP", "T")
    native = ", ".join(f"{r['name']} {r['type']}" for r in types.orderBy("position").collect())
    fields = catalog.catalog_schema(types, "derby")
    df = base.jdbc_base(spark, url, "SELECT * FROM T", "derby")
    return catalog.guarded_projection(df, fields).withColumn("native", F.lit(native))


@query("r5_bounded_scans", f"SELECT attempt_id, count(*) AS rows, max(id) AS last FROM (SELECT event_id AS id, (row_number() OVER (ORDER BY ts, event_id) - 1) // (SELECT count(*) // 3 + 1 FROM events) + 1 AS attempt_id FROM events) GROUP BY attempt_id")
def r5_bounded_scans(spark, d):
    """A third of the events a scan, each delivered and committed before the next one reads."""
    root, path, e = scratch_dir(spark, "bounded"), f"{d}/events.parquet*", table(spark, d, "events")
    third = e.count() // 3 + 1
    inp = Input("events", SPEC, ("event_id", "ts"), query="events", max_rows=2_000, max_scan_rows=third, most_scan_rows=third)
    rising_stream(spark, path, e.schema, inp, root, f"{root}/checkpoint", _to_files(f"{root}/out")).awaitTermination()
    return spark.read.parquet(f"{root}/out").groupBy("attempt_id").agg(F.count("*").alias("rows"), F.max("id").alias("last"))


@query("s4_pruned_partitions", f"SELECT event_id, {US} AS ts_us FROM events WHERE {US} > {RESUME.ts_us} OR ({US} = {RESUME.ts_us} AND event_id > {RESUME.id})")
def s4_pruned_partitions(spark, d):
    """Events parted by day and hour; the bound rules out partitions, by the rule that they follow from the timestamp."""
    path, e = scratch_dir(spark, "parted"), table(spark, d, "events").select("event_id", "ts")
    e.withColumns({"day": F.to_date("ts"), "hour": F.hour("ts")}).repartition("day").write.partitionBy("day", "hour").parquet(path)
    spec = CursorSpec("ts", "event_id", assume_utc=True, partitions=(("day", "date"), ("hour", "hour")))
    df = base.table_base(spark, path)
    return apply_bound(df, spec, Bound(RESUME)).select("event_id", ts_us(df, spec).alias("ts_us"))


@query("r3_dedup_with_history", "SELECT DISTINCT l_orderkey * 10 + l_linenumber AS event_id FROM lineitem WHERE l_orderkey % 3 <> 0")
def r3_dedup_with_history(spark, d):
    """Events that a table says were delivered long ago, and repeats within the stream, are dropped."""
    root = scratch_dir(spark, "history")
    rows = spark.readStream.schema(table(spark, d, "lineitem").schema).parquet(f"{d}/lineitem.parquet*")
    event = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_id")
    delivered = table(spark, d, "lineitem").where("l_orderkey % 3 = 0").select(event)
    kept = stream_dedup(rows.select(event, F.col("l_shipdate").cast("timestamp").alias("ts")), "ts", "10000 days", delivered)
    kept.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").select("event_id")


@query("r4_late_rows", f"SELECT {EVENT_ID} AS event_id FROM events WHERE {PAST} OR ({US} >= {AT.ts_us - OVERLAP.overlap_us} AND event_id % 10 = 3)")
def r4_late_rows(spark, d):
    """Rows that were committed late into the overlap window come with the next scan; the others are known by id."""
    e = event_base(spark, d)
    scanned = rising_scan(e, Input(EVENTS.input_id, OVERLAP, COLUMNS, "spark", "events", 500), AT)
    known = rising_scan(e.where(~after(e, SPEC, Bound(AT)) & (F.col("event_id") % 10 != 3)), EVENTS)
    return control.replay_dedup(scanned.select("event_id"), known)
