"""JSON encoders of the typed fields. Each gives null for null; what an encoder can't represent is a `rejects`."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Field types beyond what the Spark type says, kept in the column's metadata under "field_type".
JSON, UUID, TIME, UINT32 = "json", "uuid", "time_us", "uint32"
_UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def json_string(c: Column) -> Column:
    quoted = F.to_json(F.struct(c.alias("v")))
    body = F.substring(quoted, F.lit(6), F.length(quoted) - 6)
    low = body
    for h in "ABCDEF":  # control characters in lower-case hex
        low = F.regexp_replace(low, r"(?<!\\)((?:\\\\)*\\u00[01])" + h, "$1" + h.lower())
    return F.when(c.isNotNull(), F.when(c.rlike(r"[\x00-\x1f]"), low).otherwise(body))


def json_number(c: Column) -> Column:
    return c.cast("string")


def json_bool(c: Column) -> Column:
    return c.cast("string")


def json_float(c: Column) -> Column:
    """The shortest text of the double: plain from 1e-5 to below 1e16, with an exponent beyond."""
    s = c.cast("double").cast("string")
    sign, first, rest, power = (F.regexp_extract(s, r"^(-?)(\d)\.(\d+)E(-?\d+)$", k) for k in range(1, 5))
    e, rest = power.try_cast("int"), F.when(rest == "0", "").otherwise(rest)
    digits, more = F.concat(first, rest), F.length(rest)
    whole = F.concat(digits, F.repeat(F.lit("0"), e - more), F.lit(".0"))
    parted = F.concat(F.substring(digits, F.lit(1), e + 1), F.lit("."), F.substring(digits, e + 2, F.lit(20)))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    far = F.concat(first, F.when(more > 0, F.concat(F.lit("."), rest)).otherwise(""), F.lit("e"), power)
    plain = F.when(e.between(0, 15), F.when(more <= e, whole).otherwise(parted)).when(e.between(-5, -1), small).otherwise(far)
    return F.when(s.contains("E"), F.concat(sign, plain)).otherwise(s)


def rejects_float(c: Column) -> Column:
    d = c.cast("double")
    return F.isnan(d) | (F.abs(d) == float("inf"))


def json_decimal(c: Column) -> Column:
    return F.concat(F.lit('"'), c.cast("string"), F.lit('"'))


def json_binary(c: Column, prefix: str = "hex:") -> Column:
    """Lower-case hex behind `hex:`, or behind a backslash and x for PostgreSQL."""
    return F.concat(F.lit('"' + prefix.replace("\\", "\\\\")), F.lower(F.hex(c)), F.lit('"'))


def _no_constant(name: str):
    raise ValueError(name)


@F.pandas_udf(T.BooleanType())
def is_strict_json(texts: pd.Series) -> pd.Series:
    """Whether a text is one JSON value: no NaN or Infinity, nothing behind it."""

    def ok(t):
        if t is None:
            return None
        try:
            json.loads(t, parse_constant=_no_constant)
        except (ValueError, RecursionError):
            return False
        return True

    return texts.map(ok)


def json_raw(c: Column) -> Column:
    """The text as it is; `rejects_raw` tells what isn't JSON."""
    return c


def rejects_raw(c: Column) -> Column:
    return ~is_strict_json(c)


def json_date(c: Column) -> Column:
    return F.concat(F.lit('"'), F.date_format(c, "yyyy-MM-dd"), F.lit('"'))


def json_time(c: Column) -> Column:
    """Microseconds of the day."""
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    s = F.floor(c / 1_000_000).cast("long")
    return F.concat(F.lit('"'), two(F.floor(s / 3600)), F.lit(":"), two(F.floor(s / 60) % 60), F.lit(":"), two(s % 60), F.lit("."), F.lpad((c % 1_000_000).cast("string"), 6, "0"), F.lit('"'))


def rejects_time(c: Column) -> Column:
    return (c < 0) | (c >= 86_400_000_000)


def json_timestamp(c: Column) -> Column:
    return F.concat(F.lit('"'), F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('"'))


def json_timestamp_utc(c: Column) -> Column:
    """The session zone must be UTC."""
    return F.concat(F.lit('"'), F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('Z"'))


def json_uuid(c: Column) -> Column:
    return F.concat(F.lit('"'), F.lower(c), F.lit('"'))


def rejects_uuid(c: Column) -> Column:
    return ~F.lower(c).rlike(_UUID)


def rejects_uint32(c: Column) -> Column:
    return (c < 0) | (c > 2**32 - 1)


_NEVER = None


def encoder(field: T.StructField, c: Column | None = None, binary_prefix: str = "hex:") -> tuple[Column, Column | None, str]:
    """(JSON text, rows that it rejects or None, reason) of a field."""
    c = F.col(f"`{field.name}`") if c is None else c
    kind, t = field.metadata.get("field_type"), field.dataType
    if kind == JSON:
        return json_raw(c), rejects_raw(c), "invalid_json"
    if kind == UUID:
        return json_uuid(c), rejects_uuid(c), "invalid_uuid"
    if kind == TIME:
        return json_time(c), rejects_time(c), "time_range"
    if kind == UINT32:
        return json_number(c), rejects_uint32(c), "uint32_range"
    if isinstance(t, T.BooleanType):
        return json_bool(c), _NEVER, ""
    if isinstance(t, T.IntegralType):
        return json_number(c), _NEVER, ""
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return json_float(c), rejects_float(c), "not_finite"
    if isinstance(t, T.DecimalType):
        return json_decimal(c), _NEVER, ""
    if isinstance(t, T.StringType):
        return json_string(c), _NEVER, ""
    if isinstance(t, T.BinaryType):
        return json_binary(c, binary_prefix), _NEVER, ""
    if isinstance(t, T.DateType):
        return json_date(c), _NEVER, ""
    if isinstance(t, T.TimestampNTZType):
        return json_timestamp(c), _NEVER, ""
    if isinstance(t, T.TimestampType):
        return json_timestamp_utc(c), _NEVER, ""
    from ..errors import TidemarkError

    raise TidemarkError("unsupported_type", f"{field.name} has type {t.simpleString()}")


def ndjson_line(df: DataFrame, columns: list[str] | None = None, binary_prefix: str = "hex:", inside: str | None = None) -> Column:
    """One JSON object per row: fields in order, nulls written out. inside: the struct column that holds them."""
    parts: list[Column] = []
    for n, name in enumerate(columns or df.columns):
        text, _, _ = encoder(df.schema[name], F.col(f"{inside}.`{name}`") if inside else None, binary_prefix)
        parts += [F.lit(("," if n else "{") + json.dumps(name, ensure_ascii=False) + ":"), F.coalesce(text, F.lit("null"))]
    return F.concat(*parts, F.lit("}")) if parts else F.lit("{}")
