"""Identities: canonical cursor bytes, event ids and tagged, length-prefixed fingerprints, as SHA-256 columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Domains keep the hashes of different things apart; they are parameters of a deployment.
RISING_EVENT, BATCH_EVENT, REQUEST, REFERENCE = "tidemark:rising-event:1", "tidemark:batch-event:1", "tidemark:request:1", "tidemark:reference:1"
QUERY, INPUT, LINEAGE, CURSOR, REVISION = "tidemark:query:1", "tidemark:input:1", "tidemark:lineage:1", "tidemark:cursor:1", "tidemark:revision:1"
VERSION = 1


def be(c: Column | int, width: int) -> Column:
    """An integer as big-endian two's complement of `width` bytes."""
    c = F.lit(c) if isinstance(c, int) else c
    return F.unhex(F.lpad(F.hex(c.cast("long")), 2 * width, "0"))


def utf8(c: Column | str) -> Column:
    return (F.lit(c) if isinstance(c, str) else c).cast("binary")


def sha(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def cursor_bytes(ts_us: Column, id: Column) -> Column:
    """Version 1, timestamp and id: 18 bytes."""
    return F.concat(be(1, 2), be(ts_us, 8), be(id, 8))


def cursor_from_bytes(raw: Column) -> Column:
    """(ts_us, id) of canonical bytes; null if the length or version is wrong."""
    part = lambda at: F.conv(F.hex(F.substring(raw, at, 8)), 16, -10).cast("long")
    ok = (F.octet_length(raw) == 18) & (F.hex(F.substring(raw, 1, 2)) == "0001")
    return F.when(ok, F.struct(part(3).alias("ts_us"), part(11).alias("id")))


def rising_event_id(input_key: Column, lineage: Column, cursor_fp: Column, ts_us: Column, id: Column, domain: str = RISING_EVENT) -> Column:
    """Stable over page borders, attempts and overlap: input, lineage and cursor identity (hex), and the position."""
    return sha(utf8(domain), F.unhex(input_key), F.unhex(lineage), F.unhex(cursor_fp), cursor_bytes(ts_us, id))


def batch_event_id(input_key: Column, batch_id: Column, ordinal: Column, domain: str = BATCH_EVENT) -> Column:
    return sha(utf8(domain), F.unhex(input_key), F.unhex(batch_id), be(ordinal, 8))


class Preimage:
    """Tagged fields of a fingerprint in order."""

    def __init__(self, domain: str):
        self.parts = [utf8(domain)]

    def _add(self, tag: int, *more: Column) -> Preimage:
        self.parts += [be(tag, 1), *more]
        return self

    def number(self, tag: int, value, width: int) -> Preimage:
        return self._add(tag, be(value, width))

    def text(self, tag: int, value) -> Preimage:
        raw = utf8(value)
        return self._add(tag, be(F.octet_length(raw), 4), raw)

    def digest(self, tag: int, hex_value: Column) -> Preimage:
        return self._add(tag, F.unhex(hex_value))

    def optional_text(self, tag: int, value: Column) -> Preimage:
        raw = value.cast("binary")
        return self._add(tag, F.coalesce(F.concat(be(1, 1), be(F.octet_length(raw), 4), raw), be(0, 1)))

    def duration(self, tag: int, micros: Column) -> Preimage:
        return self._add(tag, be(F.floor(micros / 1_000_000), 8), be((micros % 1_000_000) * 1000, 4))

    def sha(self) -> Column:
        return sha(*self.parts)


def query_fingerprint(connector, query) -> Column:
    return Preimage(QUERY).number(1, VERSION, 2).text(2, connector).text(3, query).sha()


def input_key(input_id) -> Column:
    return Preimage(INPUT).number(1, VERSION, 2).text(2, input_id).sha()


def lineage_fingerprint(mode, input_id, connector, host, database, username, query_fp: Column) -> Column:
    """What the rows come from; batch and rising inputs are kept apart."""
    p = Preimage(LINEAGE).number(1, VERSION, 2).text(2, mode).text(3, input_id).text(4, connector)
    return p.text(5, host).text(6, database).text(7, username).digest(8, query_fp).sha()


def cursor_fingerprint(ts_field, id_field) -> Column:
    return Preimage(CURSOR).number(1, VERSION, 2).text(2, ts_field).text(3, id_field).sha()


def revision_fingerprint(lineage: Column, cursor_fp: Column, overlap_us: Column, max_rows: Column, max_bytes: Column, disabled: Column) -> Column:
    """Everything that may change without changing the identity of the events."""
    p = Preimage(REVISION).number(1, VERSION, 2).digest(2, lineage).digest(3, cursor_fp).duration(4, overlap_us)
    return p.number(5, max_rows, 8).number(6, max_bytes, 8).number(7, disabled.cast("int"), 1).sha()


def request_fingerprint(cursor_fp: Column, committed: Column, resume: Column) -> Column:
    """committed, resume: structs (ts_us, id) or null; a presence byte stands before each."""
    slot = lambda c: F.coalesce(F.concat(be(1, 1), cursor_bytes(c["ts_us"], c["id"])), be(0, 1))
    return sha(utf8(REQUEST), F.unhex(cursor_fp), slot(committed), slot(resume))
