from datetime import datetime, timedelta

import pytest

from tidemark.cursor import I64_MIN, Bound, Cursor, CursorSpec, apply_bound, below_bound, overlap_from_nanos
from tidemark.errors import TidemarkError
from tidemark.operators import checks, inputs, order
from tidemark.plans.scan import Input, checked_scan, rising_scan

T0 = 1_704_067_200_000_000  # 2024-01-01
SPEC = CursorSpec("ts", "id")


def rows(spark, *pairs):
    return spark.createDataFrame([(None if s is None else datetime(2024, 1, 1) + timedelta(seconds=s), i, f"r{i}") for s, i in pairs], "ts timestamp, id long, v string")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_equal_timestamps(spark):
    df = rows(spark, (0, 1), (0, 2), (0, 3))
    assert ids(apply_bound(df, SPEC, SPEC.bound(Cursor(T0, 1)))) == [2, 3]


def test_overlap_and_resume(spark):
    spec = CursorSpec("ts", "id", timedelta(seconds=1))
    df = rows(spark, (0, I64_MIN), (0, 0), (0, 1), (1, 5))
    committed = Cursor(T0 + 1_000_000, 5)
    assert ids(apply_bound(df, spec, spec.bound(committed))) == [I64_MIN, 0, 1, 5]
    assert ids(apply_bound(df, spec, spec.bound(committed, Cursor(T0, 0)))) == [1, 5]
    with pytest.raises(TidemarkError, match="resume_before_bound"):
        spec.bound(committed, Cursor(T0 - 1, 0))


def test_bound_algebra():
    assert SPEC.bound(Cursor(1_000_000, 42)) == Bound(Cursor(1_000_000, 42))
    ten = CursorSpec("ts", "id", timedelta(microseconds=10))
    assert ten.bound(Cursor(1_000_000, 42)) == Bound(Cursor(999_990, I64_MIN), True)
    with pytest.raises(TidemarkError, match="overlap_precision"):
        overlap_from_nanos(1)
    with pytest.raises(TidemarkError, match="overlap_range"):
        overlap_from_nanos((2**64 - 1) * 10**9)
    with pytest.raises(TidemarkError, match="overlap_underflow"):
        ten.bound(Cursor(I64_MIN, 0))


def test_canonical_bytes():
    c = Cursor(-1, I64_MIN)
    assert c.to_bytes().hex() == "0001ffffffffffffffff8000000000000000"
    assert Cursor.from_bytes(c.to_bytes()) == c
    with pytest.raises(TidemarkError):
        Cursor.from_bytes(b"\0\2" + bytes(16))


def test_null_cursor_passes_filter_and_fails_scan(spark):
    df = rows(spark, (None, 0), (0, 2))
    inp = Input("a", SPEC, ("id", "v"))
    assert apply_bound(df, SPEC, Bound(Cursor(T0, 1))).count() == 2
    with pytest.raises(TidemarkError, match="null_cursor"):
        checked_scan(df, inp, Cursor(T0, 1))


def test_duplicate_fails(spark):
    with pytest.raises(TidemarkError, match="duplicate"):
        checked_scan(rows(spark, (0, 1), (0, 1)), Input("a", SPEC, ("id",), max_rows=1))


def test_below_bound(spark):
    df = rows(spark, (0, 1), (0, 9))
    assert df.where(below_bound(df, SPEC, Bound(Cursor(T0, 5)))).count() == 1
    assert checks.cursor_counts(df, SPEC, Bound(Cursor(T0, 5)), "ts", "id").first()["below_bound"] == 1


def test_probe(spark):
    df = rows(spark, *[(i, i) for i in range(5)])
    got = order.row_limit_probe(df, [df.ts.asc()], 4).collect()
    assert [r["id"] for r in got] == [0, 1, 2, 3] and all(r["truncated"] for r in got)
    assert not any(r["truncated"] for r in order.row_limit_probe(df, [df.ts.asc()], 5).collect())


def test_pages_do_not_change_identity(spark):
    df = rows(spark, *[(i // 7, i) for i in range(200)])
    want = None
    for max_rows, buckets, parts in ((10, 1, 1), (37, 10, 3), (200, None, 7)):
        inp = Input("a", SPEC, ("id", "v"), max_rows=max_rows)
        got = rising_scan(df.repartition(parts), inp, Cursor(T0, 3), buckets=buckets).orderBy("ordinal").collect()
        assert [r["ordinal"] for r in got] == list(range(1, 197))
        assert [r["id"] for r in got] == list(range(4, 200))
        assert [r["page"] for r in got] == [(n - 1) // max_rows + 1 for n in range(1, 197)]
        ids_now = [(r["id"], r["event_id"], r["line"]) for r in got]
        assert want in (None, ids_now)
        want = ids_now


def test_one_huge_tie(spark):
    df = spark.range(5000).selectExpr("CASE WHEN id % 10 < 8 THEN 50 ELSE id % 100 END AS ts_us", "id")
    got = order.with_ordinal(df, buckets=50)
    assert got.groupBy("bucket").count().agg({"count": "max"}).first()[0] < 1000
    want = sorted((r["ts_us"], r["id"]) for r in df.collect())
    assert [(r["ts_us"], r["id"]) for r in got.orderBy("ordinal").collect()] == want


def test_pushdown(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = apply_bound(df, CursorSpec("ts", "event_id", assume_utc=True), Bound(Cursor(T0, 1))).select("event_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in text and "GreaterThan(ts" in text


def test_pagination_guard(spark):
    df = spark.range(5)
    assert inputs.pagination_guard(df) is df
    assert inputs.pagination_guard(df.limit(3).groupBy("id").count())
    for bad in (df.limit(3), df.offset(1), df.orderBy("id").limit(2).select("id")):
        with pytest.raises(TidemarkError, match="base_has_limit"):
            inputs.pagination_guard(bad)
    with pytest.raises(TidemarkError, match="preview_limit"):
        inputs.preview(df, 101)
    with pytest.raises(TidemarkError, match="preview_bytes"):
        inputs.preview(df, 5, 10)


def test_empty_scan(spark):
    assert checked_scan(rows(spark, (0, 1)).where("id > 5"), Input("a", SPEC, ("id",))).count() == 0
