"""The (timestamp, id) cursor: positions, lower bounds and the predicates they give."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import TidemarkError

I64_MIN, I64_MAX = -(2**63), 2**63 - 1
_EPOCH = datetime(1970, 1, 1)


@dataclass(frozen=True, order=True)
class Cursor:
    """A position: microseconds since the epoch (UTC), then a signed 64-bit id."""

    ts_us: int
    id: int

    def __post_init__(self):
        if not (I64_MIN <= self.ts_us <= I64_MAX and I64_MIN <= self.id <= I64_MAX):
            raise TidemarkError("cursor_range", "cursor parts must be signed 64-bit integers")

    def to_bytes(self) -> bytes:
        return b"\0\1" + self.ts_us.to_bytes(8, "big", signed=True) + self.id.to_bytes(8, "big", signed=True)

    @staticmethod
    def from_bytes(raw: bytes) -> Cursor:
        if len(raw) != 18 or raw[:2] != b"\0\1":
            raise TidemarkError("cursor_format", "a cursor has 18 bytes and version 1")
        return Cursor(int.from_bytes(raw[2:10], "big", signed=True), int.from_bytes(raw[10:], "big", signed=True))


@dataclass(frozen=True)
class Bound:
    at: Cursor
    inclusive: bool = False


@dataclass(frozen=True)
class CursorSpec:
    """Cursor columns and overlap. Null cursors are never accepted: they pass the filter and fail the checks.

    assume_utc: read a timestamp without zone as UTC. Without it such a column isn't a cursor.
    partitions: partition columns that follow from the timestamp in UTC, the widest first, as (column, unit) with unit
    `date` (a date, or its text yyyy-MM-dd), `year`, `month`, `day` or `hour` (numbers, or their text of even width).
    A bound then rules out whole partitions. Rows in a partition that lies before the bound aren't seen again, even
    with a null id; rows in a null partition always are.
    """

    ts: str
    id: str
    overlap: timedelta = timedelta(0)
    assume_utc: bool = False
    partitions: tuple[tuple[str, str], ...] = ()

    def __post_init__(self):
        if not self.ts or not self.id or self.ts == self.id:
            raise TidemarkError("cursor_fields", "cursor fields must be two different names")
        if self.overlap < timedelta(0):
            raise TidemarkError("overlap_range", "overlap can't be negative")
        units = [u for _, u in self.partitions]
        if units and units != ["date"] and units != ["date", "hour"] and units != ["year", "month", "day", "hour"][: len(units)]:
            raise TidemarkError("partition_rule", f"{units} isn't a sequence of units from the widest on")

    @property
    def overlap_us(self) -> int:
        return self.overlap // timedelta(microseconds=1)

    def initial_bound(self, committed: Cursor | None) -> Bound | None:
        """No commit: none. No overlap: after the commit. Overlap: from (ts - overlap, least id) on, itself included."""
        if committed is None:
            return None
        if not self.overlap_us:
            return Bound(committed)
        if committed.ts_us - self.overlap_us < I64_MIN:
            raise TidemarkError("overlap_underflow", "the overlap reaches before the first timestamp")
        return Bound(Cursor(committed.ts_us - self.overlap_us, I64_MIN), True)

    def bound(self, committed: Cursor | None, resume_after: Cursor | None = None) -> Bound | None:
        """The bound of the next page; a resume position excludes itself and takes no second overlap."""
        first = self.initial_bound(committed)
        if resume_after is None:
            return first
        if first and (resume_after < first.at):
            raise TidemarkError("resume_before_bound", "the resume position precedes the scan's lower bound")
        return Bound(resume_after)


def overlap_from_nanos(nanos: int) -> timedelta:
    """Whole microseconds only."""
    if nanos % 1000:
        raise TidemarkError("overlap_precision", "overlap must be whole microseconds")
    if nanos // 1000 > I64_MAX:
        raise TidemarkError("overlap_range", "overlap exceeds 64 bits")
    return timedelta(microseconds=nanos // 1000)


def ts_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.typeName()


def ts_us(df: DataFrame, spec: CursorSpec) -> Column:
    """Microseconds since the epoch of the cursor timestamp; a zoneless one is read as UTC whatever the session zone."""
    if ts_type(df, spec.ts) == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{spec.ts}`)")
    return F.unix_micros(F.col(spec.ts))


def ts_literal(df: DataFrame, spec: CursorSpec, us: int) -> Column:
    """The timestamp as a literal of the column's own type, so that the comparison reaches the source."""
    if ts_type(df, spec.ts) == "timestamp_ntz":
        return F.expr(f"TIMESTAMP_NTZ'{(_EPOCH + timedelta(microseconds=us)).isoformat(sep=' ', timespec='microseconds')}'")
    return F.timestamp_micros(F.lit(us))


def after(df: DataFrame, spec: CursorSpec, bound: Bound) -> Column:
    """Rows past the bound, written out as alternatives: a struct comparison would not be pushed down."""
    t, i, at = F.col(spec.ts), F.col(spec.id), ts_literal(df, spec, bound.at.ts_us)
    if bound.inclusive and bound.at.id == I64_MIN:
        return t >= at
    return (t > at) | ((t == at) & (i >= bound.at.id if bound.inclusive else i > bound.at.id))


def null_cursor(spec: CursorSpec) -> Column:
    return F.col(spec.ts).isNull() | F.col(spec.id).isNull()


def upto(df: DataFrame, spec: CursorSpec, last: Cursor) -> Column:
    """Rows up to a position, itself included."""
    t, i, at = F.col(spec.ts), F.col(spec.id), ts_literal(df, spec, last.ts_us)
    return (t < at) | ((t == at) & (i <= last.id))


def in_partitions(df: DataFrame, spec: CursorSpec, ts_us: int, first: bool) -> Column | None:
    """What partitions may hold timestamps from (first) or up to one, as a predicate on partition columns alone."""
    when = _EPOCH + timedelta(microseconds=ts_us)
    out = None
    for name, unit in reversed(spec.partitions):
        kind, c = df.schema[name].dataType, F.col(f"`{name}`")
        value = when.date() if unit == "date" else getattr(when, unit)
        if isinstance(kind, T.StringType):
            value = str(value) if unit in ("date", "year") else f"{value:02}"
        v = F.lit(value).cast(kind)
        past = c > v if first else c < v
        out = (c >= v if first else c <= v) if out is None else past | ((c == v) & out)
    return out if out is None else out | F.col(f"`{spec.partitions[0][0]}`").isNull()


def apply_bound(df: DataFrame, spec: CursorSpec, bound: Bound | None, last: Cursor | None = None) -> DataFrame:
    """Rows past the bound and up to a last position, and rows with a null cursor, which the checks then reject."""
    for at, first, rows in ((bound and bound.at, True, bound and after), (last, False, last and upto)):
        if at is None:
            continue
        if spec.partitions:
            df = df.where(in_partitions(df, spec, at.ts_us, first))
        df = df.where(rows(df, spec, bound if first else last) | null_cursor(spec))
    return df


def below_bound(df: DataFrame, spec: CursorSpec, bound: Bound | None) -> Column:
    """Whether a row that came back lies before its bound (false for null cursors)."""
    return F.lit(False) if bound is None else F.coalesce(~after(df, spec, bound), F.lit(False))


def cursor_order(spec: CursorSpec) -> list[Column]:
    return [F.col(spec.ts).asc_nulls_first(), F.col(spec.id).asc_nulls_first()]
