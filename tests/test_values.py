import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.cursor import CursorSpec
from tidemark.errors import TidemarkError
from tidemark.functions import encode, ids, strict
from tidemark.operators import checks, control, order, schema


def test_line(spark):
    fields = [
        ("b", T.BooleanType(), True), ("i", T.LongType(), -5), ("f", T.DoubleType(), 1.5), ("s", T.StringType(), 'a"\\\n\x1fé/'), ("d", T.DecimalType(38, 6), Decimal("1.500000")),
        ("x", T.BinaryType(), bytearray(b"\0\xff")), ("day", T.DateType(), date(2024, 2, 29)), ("n", T.TimestampNTZType(), datetime(2024, 2, 29, 23, 59, 58, 654321)), ("u", T.TimestampType(), datetime(1970, 1, 1)), ("z", T.StringType(), None)]
    s = T.StructType([T.StructField(n, t) for n, t, _ in fields] + [T.StructField("t", T.LongType(), True, {"field_type": "time_us"}), T.StructField("j", T.StringType(), True, {"field_type": "json"})])
    df = spark.createDataFrame([tuple(v for _, _, v in fields) + (3_723_000_004, '{"k": 1, "k":2}')], s)
    line = df.select(encode.ndjson_line(df)).first()[0]
    assert line == '{"b":true,"i":-5,"f":1.5,"s":"a\\"\\\\\\n\\u001fé/","d":"1.500000","x":"hex:00ff","day":"2024-02-29","n":"2024-02-29T23:59:58.654321","u":"1970-01-01T00:00:00.000000Z","z":null,"t":"01:02:03.000004","j":{"k": 1, "k":2}}'
    assert json.loads(line)["s"] == 'a"\\\n\x1fé/'
    assert df.select(encode.json_binary(F.col("x"), "\\x")).first()[0] == '"\\\\x00ff"'


def test_lossless_check(spark):
    s = T.StructType([T.StructField("f", T.DoubleType()), T.StructField("j", T.StringType(), True, {"field_type": "json"}), T.StructField("u", T.LongType(), True, {"field_type": "uint32"})])
    df = spark.createDataFrame([(float("nan"), "{} x", -1), (float("inf"), '{"a":NaN}', 2**32), (1.0, "[1]", 0), (None, None, None)], s)
    got = {r["column"]: (r["reason"], r["rows"]) for r in checks.lossless_check(df).collect()}
    assert got == {"f": ("not_finite", 2), "j": ("invalid_json", 2), "u": ("uint32_range", 2)}


def one(spark, f, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_strict_values(spark):
    d = lambda *v, **k: one(spark, lambda c: strict.strict_decimal(c, 4, 2, **k).cast("string"), *v)
    assert d("12.34", "-0.50", "12.345", "12.3", "+1.00", "01.00", "123.00", "1e1", "", None) == ["12.34", "-0.50"] + [None] * 8
    assert d("-1.00", unsigned=True) == [None] and d("1.5", "1", pad=True) == ["1.50", "1.00"]
    assert one(spark, lambda c: strict.money(c).cast("string"), "922337203685477.5807", "1.23") == ["922337203685477.5807", None]
    assert one(spark, lambda c: strict.smallmoney(c).cast("string"), "-214748.3648", "214748.3648") == ["-214748.3648", None]
    assert one(spark, lambda c: strict.unsigned_range(c, 64).cast("string"), "18446744073709551615", "18446744073709551616", "-1") == ["18446744073709551615", None, None]
    assert one(spark, lambda c: strict.strict_date(c).cast("string"), "2024-02-29", "2023-02-29", "0000-00-00", "2024-01-01 00:00:00") == ["2024-02-29", None, None, None]
    assert one(spark, lambda c: strict.exact_micros(c).cast("string"), "2024-01-01 00:00:00.1234560", "2024-01-01 00:00:00.1234561") == ["2024-01-01 00:00:00.123456", None]


def test_ids(spark):
    df = spark.createDataFrame([(-1, -(2**63))], "t long, i long")
    raw = df.select(ids.cursor_bytes(F.col("t"), F.col("i")).alias("b"))
    assert raw.first()[0].hex() == "0001ffffffffffffffff8000000000000000"
    assert tuple(raw.select(ids.cursor_from_bytes(F.col("b")).alias("c")).first()["c"]) == (-1, -(2**63))

    def eid(key="aa", lineage="bb", cursor="cc", t=1):
        return df.select(ids.rising_event_id(F.lit(key), F.lit(lineage), F.lit(cursor), F.lit(t), F.col("i"))).first()[0]

    assert len({eid(), eid(key="ab"), eid(lineage="bc"), eid(cursor="cd"), eid(t=2)}) == 5 and eid() == eid()


@pytest.mark.parametrize("dialect,source,want", [
    ("postgres", '"char"', T.ByteType()), ("postgres", "oid", T.LongType()), ("postgres", "numeric(38,6)", T.DecimalType(38, 6)), ("postgres", "timestamp with time zone", T.TimestampType()),
    ("mysql", "BIGINT UNSIGNED", T.DecimalType(20, 0)), ("mysql", "bit(1)", T.BooleanType()), ("mysql", "bit(8)", T.BinaryType()), ("mysql", "datetime", T.TimestampNTZType()), ("mysql", "timestamp", T.TimestampType()),
    ("mssql", "tinyint", T.ShortType()), ("mssql", "money", T.DecimalType(19, 4)), ("mssql", "smallmoney", T.DecimalType(10, 4)), ("mssql", "datetimeoffset(7)", T.StringType()), ("mssql", "datetime2(6)", T.TimestampNTZType()),
    ("oracle", "NUMBER(20,4)", T.DecimalType(20, 4)), ("oracle", "DATE", T.TimestampNTZType()), ("oracle", "RAW", T.BinaryType())])
def test_types(dialect, source, want):
    assert schema.map_type(dialect, source).type == want


@pytest.mark.parametrize("dialect,source", [
    ("postgres", "numeric"), ("postgres", "interval"), ("mysql", "time"), ("mysql", "geometry"), ("mssql", "sql_variant"), ("mssql", "datetime2(7)"), ("oracle", "NUMBER"), ("oracle", "NUMBER(10,-2)"),
    ("oracle", "CLOB"), ("oracle", "TIMESTAMP(9)"), ("oracle", "TIMESTAMP(6) WITH TIME ZONE")])
def test_rejected_types(dialect, source):
    with pytest.raises(TidemarkError):
        schema.map_type(dialect, source)


def test_schemas(spark):
    s = schema.map_schema("mariadb", {"a": "json", "b": "int unsigned"})
    assert s["a"].metadata == {"source_type": "json"} and s["b"].metadata["field_type"] == "uint32"
    assert isinstance(schema.map_schema("mssql", {"t": "datetime2(3)"}, cursor_ts="t")["t"].dataType, T.TimestampType)
    with pytest.raises(TidemarkError, match="a .*c "):
        schema.map_schema("mysql", {"a": "time", "b": "int", "c": "geometry"})
    with pytest.raises(TidemarkError, match="duplicate_column"):
        schema.map_schema("oracle", {"A": "DATE", "a": "DATE"})
    with pytest.raises(TidemarkError, match="empty_schema"):
        schema.check_schema(T.StructType([]))
    df = spark.createDataFrame([], "ts timestamp_ntz, id long, n int")
    schema.check_cursor_schema(df, CursorSpec("ts", "id", assume_utc=True))
    for spec in (CursorSpec("ts", "id"), CursorSpec("ts", "n", assume_utc=True), CursorSpec("ts", "no", assume_utc=True)):
        with pytest.raises(TidemarkError):
            schema.check_cursor_schema(df, spec)
    with pytest.raises(TidemarkError, match="schema_drift"):
        schema.schema_fence(df.schema, df.drop("n").schema)


@pytest.mark.parametrize("c,cr,d,dr,want", [
    ("failed", None, "failed", None, "replay:collection_failed"), ("completed", 2, "failed", None, "replay:delivery_failed"), ("in_progress", None, "uncertain", None, "replay:delivery_uncertain"),
    ("in_progress", None, "confirmed", 2, "replay:collection_in_progress"), ("completed", 2, "in_progress", None, "replay:delivery_in_progress"), ("completed", 2, "confirmed", 3, "replay:row_count_mismatch"), ("completed", 2, "confirmed", 2, "commit")])
def test_recovery_matrix(spark, c, cr, d, dr, want):
    a = spark.createDataFrame([("i", 1, c, cr, d, dr)], "input_id string, attempt_id long, collection string, coll_rows long, delivery string, deliv_rows long")
    assert control.recovery(a).first()["action"] == want


def test_pack_fails_on_a_large_event(spark):
    df = spark.createDataFrame([("a", 1, 1, 1, 11)], "input_id string, attempt_id long, page long, ordinal long, event_bytes long")
    with pytest.raises(Exception, match="event_exceeds_batch"):
        order.pack_batches(df, ["input_id", "attempt_id", "page"], 5, 10).collect()
