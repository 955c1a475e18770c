"""Secret scan with a recursive decoding worklist.

The text itself is the first layer. Each layer is scanned, then everything in it that is URL-, Unicode-, base64-
or zlib/gzip-encoded is unwrapped into further layers, until nothing new appears; layers seen before are skipped,
so cycles end. Every layer maps each of its characters to a span of the original text, and a finding in it is
reported there.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import bounded_batches, read
from .tokens import in_steps

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
#: Runs of \uXXXX and %uXXXX (code units), of \xXX (bytes), and single \u{X}, \UXXXXXXXX and &#N; with or without its end.
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|(?:%u[0-9A-Fa-f]{4})+|(?:\\x[0-9A-Fa-f]{2})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});?")
#: ASCII text in two bytes a character, either byte first.
_WIDE = re.compile(r"(?:[\t\n\r\x20-\x7e]\x00){8,}|(?:\x00[\t\n\r\x20-\x7e]){8,}")
#: A run of base64 characters, over line ends too (wrapped or quoted base64).
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+(?:\r?\n[ \t>]*[A-Za-z0-9+/_-]++)*+|[A-Za-z0-9+/_-]++(?:\r?\n[ \t>]*[A-Za-z0-9+/_-]++)++)")
_BREAK = re.compile(r"[\r\n \t>]+")
_FROM_URL = str.maketrans("-_", "+/")
#: Where a gzip or zlib stream may begin in decoded bytes.
_PACKED = re.compile(r"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]")
#: Bytes without any of these hold neither a finding nor a further layer.
_ANY = re.compile(rb"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{16}|%u?[0-9A-Fa-f]{2}|\\[uUx]\{?[0-9A-Fa-f]|&#|(?:[\x20-\x7e]\x00){8}|[A-Za-z0-9+/_-]{16}|[A-Za-z0-9+/_-]\r?\n[ \t>]*[A-Za-z0-9+/_-]|\x1f\x8b\x08|x[\x01\x5e\x9c\xda]")
_ANY_TEXT = re.compile(_ANY.pattern.decode("latin-1"))
#: Bytes of an unfolded stream that are scanned at once, and how many of them the next part has again.
INFLATE_CHUNK, OVERLAP = 16 << 20, 1 << 20
_STEP = 1 << 16


def base_matches(text: str):
    """(kind, start, end) of the base patterns, leftmost and non-overlapping per kind."""
    low = text.lower()
    if any(h in low for h in _HINTS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 12:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            yield "access", m.start(), m.end()
    for m in _HEX.finditer(text):
        yield "hex", m.start(), m.end()


def _replaced(text, lo, hi, pattern, decode):
    """The layer in which each match that decodes is replaced, or None. lo, hi map its characters to the source."""
    parts, los, his, at = [], [], [], 0
    for m in pattern.finditer(text):
        got = decode(m.group())
        if got is None:
            continue
        new, units = got  # units: for each new character its first and last position within the match
        parts += [text[at : m.start()], new]
        los += [lo[at : m.start()], lo[m.start() + units[:, 0]]]
        his += [hi[at : m.start()], hi[m.start() + units[:, 1]]]
        at = m.end()
    if not parts:
        return None
    parts.append(text[at:])
    los.append(lo[at:])
    his.append(hi[at:])
    return "".join(parts), np.concatenate(los), np.concatenate(his)


def _byte_units(data: bytes, width):
    """Each byte as one character (what is searched for is ASCII, so any bytes will do), `width` characters wide."""
    first = np.arange(len(data), dtype=np.int64) * width
    return data.decode("latin-1"), np.stack([first, first + width - 1], axis=1)


def _percent(run: str):
    return _byte_units(bytes.fromhex(run.replace("%", "")), 3)


def _character(n: int, length: int):
    if not 0 < n < 0x110000 or 0xD800 <= n < 0xE000:
        return None
    return chr(n), np.array([[0, length - 1]])


def _escape(run: str):
    if run[0] == "&":
        body = run[2:].rstrip(";")
        return _character(int(body[1:], 16) if body[0] in "xX" else int(body), len(run))
    if run[1] == "x":
        return _byte_units(bytes.fromhex(run.replace("\\x", "")), 4)
    if run[1] == "U" or run[2] == "{":
        return _character(int(run[2:].strip("{}"), 16), len(run))
    text, units, at = "", [], 0
    codes = [int(x, 16) for x in run.split(run[:2])[1:]]
    while at < len(codes):
        n, k = codes[at], 1
        if 0xD800 <= n < 0xDC00 and at + 1 < len(codes) and 0xDC00 <= codes[at + 1] < 0xE000:
            n, k = 0x10000 + ((n - 0xD800) << 10) + codes[at + 1] - 0xDC00, 2
        text += "\ufffd" if 0xD800 <= n < 0xE000 else chr(n)
        units.append((6 * at, 6 * (at + k) - 1))
        at += k
    return text, np.array(units)


def _wide(run: str):
    first = np.arange(len(run) // 2, dtype=np.int64) * 2
    return run.replace("\0", ""), np.stack([first, first + 1], axis=1)


class _Part(str):
    """A part of unfolded bytes; more() gives the pieces behind it."""

    more = None


class _Stream:
    """The stream that begins at a place of a layer: its unfolded bytes, over all its members, as far as they go.
    end is the place behind what was read so far, last that behind all of it once chunks has given a part, and
    whole tells whether the last member was complete."""

    def __init__(self, text: str, start: int):
        self.origin, self.start, self.end, self.last, self.whole = text, start, start, None, False
        self.text, self.base, self.rest = text, 0, getattr(text, "more", None) and text.more()

    def _slice(self, at: int, size: int) -> str:
        """Characters of the layer from `at` on, those behind its part included; `at` never goes back."""
        while self.rest is not None and at - self.base + size > len(self.text):
            if (piece := next(self.rest, None)) is None:
                self.rest = None
                break
            self.text, self.base = self.text[at - self.base :] + piece.decode("latin-1"), at
        return self.text[at - self.base : at - self.base + size]

    def _read(self, at: int, size: int = _STEP) -> bytes:
        part = self._slice(at, size)
        try:
            return part.encode("latin-1")
        except UnicodeEncodeError as e:
            return part[: e.start].encode("latin-1")

    def pieces(self):
        at, mode = self.start, 31 if self.text[self.start] == "\x1f" else 15
        while True:
            d = zlib.decompressobj(mode)
            self.whole = False
            while not d.eof and (data := self._read(at)):
                while True:
                    before = d.copy()
                    try:
                        out = d.decompress(data, _STEP)
                    except zlib.error:
                        # what comes before the damage counts
                        for k in range(len(data)):
                            try:
                                out = before.decompress(data[k : k + 1])
                            except zlib.error:
                                break
                            if out:
                                yield out
                            self.end = at + k + 1
                        return
                    if out:
                        yield out
                    left = d.unused_data if d.eof else d.unconsumed_tail
                    at += len(data) - len(left)
                    self.end, data = at, left
                    if d.eof or (not data and len(out) < _STEP):
                        break
            if not d.eof:
                if out := d.flush():
                    yield out
                return
            self.whole, after = True, at
            while mode == 31 and self._slice(after, 1) == "\0":  # gzip allows zeros between members
                after += 1
            if not (m := _PACKED.match(self._slice(after, 3))):
                return
            at, mode = after, 31 if m.group()[0] == "\x1f" else 15

    def _behind(self, done: int):
        """The pieces behind the first `done` unfolded bytes, unfolded anew."""
        for piece in _Stream(self.origin, self.start).pieces():
            if done < len(piece):
                yield piece[done:]
            done = max(0, done - len(piece))

    def chunks(self):
        """The unfolded bytes in parts that overlap."""
        held, size, done = [], 0, 0
        for piece in self.pieces():
            held.append(piece)
            size += len(piece)
            done += len(piece)
            if size >= INFLATE_CHUNK:
                part = _Part(b"".join(held), "latin-1")
                part.more = lambda done=done: self._behind(done)
                if self.last is None:  # findings in the first part already span the whole stream
                    ahead = _Stream(self.origin, self.start)
                    for _ in ahead.pieces():
                        pass
                    self.last = ahead.end
                yield part
                held, size = [part[-OVERLAP:].encode("latin-1")], OVERLAP
        self.last = self.end
        if size:
            yield _Part(b"".join(held), "latin-1")


def _unpacked(text, lo, hi):
    """Layers of the compressed streams in a decoded layer, each of their characters at the stream's whole span."""
    at = 0
    while m := _PACKED.search(text, at):
        stream = _Stream(text, m.start())
        for part in stream.chunks():
            if _ANY_TEXT.search(part):
                span = slice(m.start(), stream.last)
                yield part, np.broadcast_to(lo[span].min(), len(part)), np.broadcast_to(hi[span].max(), len(part))
        at = stream.end if stream.whole else m.start() + 1


def _blobs(text, lo, hi):
    """Layers of the base64 runs. Each run is read at all four alignments, so that base64 behind '/', '_' or any
    other character of its alphabet is decoded too; what surrounds it gives bytes without meaning."""
    for m in _BASE64.finditer(text):
        run = m.group()
        at = None
        if "\n" in run:
            kept = np.ones(len(run), bool)
            for gap in _BREAK.finditer(run):
                kept[gap.start() : gap.end()] = False
            at, run = np.flatnonzero(kept), _BREAK.sub("", run)
        if len(run) < 16:
            continue
        run = run.translate(_FROM_URL)
        for shift in range(4):
            part = run[shift:]
            part = part[: len(part) - (len(part) % 4 == 1)]
            data = base64.b64decode(part + "=" * (-len(part) % 4))
            if not _ANY.search(data):
                continue
            i = np.arange(len(data), dtype=np.int64)  # byte i comes from characters 4i/3 to (4i+4)/3
            first, last = shift + i * 4 // 3, shift + np.minimum((i * 4 + 4) // 3, len(part) - 1)
            if at is not None:
                first, last = at[first], at[last]
            yield data.decode("latin-1"), lo[m.start() + first], hi[m.start() + last]


def _inside(layer, lo, hi, path):
    """The layers that a layer holds, each with its path."""
    for name, pattern, decode in (("url", _PERCENT, _percent), ("unicode", _ESCAPE, _escape), ("utf-16", _WIDE, _wide)):
        if new := _replaced(layer, lo, hi, pattern, decode):
            yield *new, f"{path}/{name}"
    for new in _blobs(layer, lo, hi):
        yield *new, f"{path}/base64"
    if path:
        for new in _unpacked(layer, lo, hi):
            yield *new, f"{path}/inflate"


def scan(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, str]]]:
    """Base spans, and all spans with the way they were reached ('' for the text itself), in code points."""
    text = text or ""
    base = list(base_matches(text))
    spans = {s: "" for s in base}
    if not (_PERCENT.search(text) or _ESCAPE.search(text) or _BASE64.search(text) or _WIDE.search(text)):
        return base, [(*s, "") for s in base]
    at = np.arange(len(text), dtype=np.int64)
    work, seen = [iter([(text, at, at, "")])], set()
    while work:  # depth first, each layer made when its turn comes
        if (new := next(work[-1], None)) is None:
            work.pop()
            continue
        layer, lo, hi, path = new
        key = hashlib.blake2b(layer.encode("utf-8", "surrogatepass") + lo[:1].tobytes(), digest_size=16).digest()
        if key in seen:
            continue
        seen.add(key)
        if path:
            for kind, s, e in base_matches(layer):
                spans.setdefault((kind, int(lo[s:e].min()), int(hi[s:e].max()) + 1), path)
        work.append(_inside(layer, lo, hi, path))
    return base, [(*s, p) for s, p in spans.items()]


def _ordered(spans):
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, base and found, arrays of (kind, start, end, path) ordered by start and kind.

    base holds what the patterns match in the text itself; found adds what decoding uncovers. Null is empty.
    """

    def run(batches):
        for batch in batches:
            for pdf in in_steps(batch):
                both = [scan(t) for t in pdf["text"]]
                row = lambda s: {"kind": s[0], "start": s[1], "end": s[2], "path": s[3] if len(s) > 3 else ""}
                yield pd.DataFrame({"id": pdf["id"].astype("Int64"), "base": [[row(s) for s in _ordered(b)] for b, _ in both], "found": [[row(s) for s in _ordered(a)] for _, a in both]})

    src = bounded_batches(docs).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    kind = "array<struct<kind string, start long, end long, path string>>"
    return src.mapInPandas(run, f"id long, base {kind}, found {kind}").withColumnRenamed("id", id)


def redact(docs: DataFrame, id: str = "doc_id", text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs with every found span (overlapping ones merged) replaced by `mark`; other columns stay."""

    def clean(t: str | None) -> str | None:
        if t is None:
            return None
        parts, at = [], 0
        for s, e in sorted((s, e) for _, s, e, _ in scan(t)[1]):
            if e <= at:
                continue
            if s >= at:
                parts += [t[at:s], mark]
            at = e
        return "".join(parts) + t[at:] if parts else t

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(clean)

    return bounded_batches(docs).withColumn(text, cleaned(F.col(text)))


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_secrets(spark, sf_dir):
    """Base counts and digest of all documents, and all spans that decoding adds to."""
    found = scan_secrets(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))
