"""Checks of a whole scan in one aggregate, before anything is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import TidemarkError
from ..functions.encode import encoder
from ..cursor import Bound, CursorSpec, below_bound


def rejected(schema: T.StructType, columns: list[str] | None = None, inside: str | None = None) -> list[tuple[str, str, Column]]:
    """(column, reason, condition) of what the encoders of a schema reject. inside: the struct that holds the columns."""
    out = []
    for name in columns or schema.names:
        _, bad, reason = encoder(schema[name], F.col(f"{inside}.`{name}`") if inside else None)
        if bad is not None:
            out.append((name, reason, bad))
    return out


def lossless_check(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, reason, rows) of every rejected kind, none if all rows encode without loss."""
    found = rejected(df.schema, columns)
    if not found:
        return df.sparkSession.createDataFrame([], "column string, reason string, rows long")
    one = df.agg(*[F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(found)])
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("column"), F.lit(reason).alias("reason"), F.col(f"n{i}").alias("rows")) for i, (name, reason, _) in enumerate(found)])).alias("r")
    return one.select(rows).select("r.*").where("rows > 0")


def cursor_counts(df: DataFrame, spec: CursorSpec, bound: Bound | None, ts: str = "ts_us", id: str = "id") -> DataFrame:
    """One row: rows with a null cursor, below the bound, and repeated positions."""
    flagged = df.select(F.col(ts).alias("t"), F.col(id).alias("i"), below_bound(df, spec, bound).alias("low"))
    tuples = flagged.groupBy("t", "i").agg(F.count("*").alias("n"), F.count_if("low").alias("low"))
    null = F.col("t").isNull() | F.col("i").isNull()
    return tuples.agg(
        F.coalesce(F.sum(F.when(null, F.col("n"))), F.lit(0)).cast("long").alias("null_cursor"),
        F.coalesce(F.sum("low"), F.lit(0)).cast("long").alias("below_bound"),
        F.coalesce(F.sum(F.when(~null, F.col("n") - 1)), F.lit(0)).cast("long").alias("duplicate"))


def require_clean(df: DataFrame, spec: CursorSpec, bound: Bound | None, columns: list[str]) -> None:
    """Raises on the first broken rule; only counts reach the driver."""
    row = cursor_counts(df, spec, bound, spec.ts, spec.id).first()
    for what in ("null_cursor", "below_bound", "duplicate"):
        if row[what]:
            raise TidemarkError(what, f"{row[what]} rows")
    require_lossless(df, columns)


def require_lossless(df: DataFrame, columns: list[str]) -> None:
    """Raises if an encoder rejects a row."""
    bad = lossless_check(df, columns).first()
    if bad:
        raise TidemarkError(bad["reason"], f"{bad['rows']} rows in {bad['column']}")
