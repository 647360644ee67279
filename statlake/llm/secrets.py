"""Secret scan: base patterns, and spans confirmed by their structure.

Base spans are the matches of three patterns (assignments, access keys, hex strings). Candidates in
base64 or hex are then decoded and reported only if what comes out has the structure of a secret: a
signed token whose header is a JSON object with an algorithm, a key in DER whose nested lengths fit, or
an OpenSSH private key whose length-prefixed fields fit. Each text is scanned whole, where it lies.

Cases: a NULL or empty text has no spans. Offsets are code points, the end is exclusive. Repeated rows
give repeated rows; an empty table gives an empty result; other columns are kept (a column named
``spans`` is replaced).
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns and the fewest characters that count, in the order of their kinds.
KINDS = ("assign", "access", "hex", "jwt", "key")
ASSIGN = re.compile(
    rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
ASSIGN_MIN, ACCESS_MIN = 8, 16

# A part is tried at its first letter only and never given back, so a run takes linear time.
TOKEN = re.compile(rb"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]*+")
PACKED = re.compile(rb"[A-Za-z0-9+/_-]{40,}={0,2}")
PEM = re.compile(
    rb"-----BEGIN ([A-Z0-9 ]{0,40})PRIVATE KEY-----([A-Za-z0-9+/=\s]+)-----END \1PRIVATE KEY-----"
)


def marks_of(letters: bytes) -> bytes:
    """A translation that puts 1 for the given bytes and 0 for others."""
    return bytes(int(b in letters) for b in range(256))


DIGITS = b"0123456789"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
PACKED_MARKS = marks_of(DIGITS + UPPER + UPPER.lower() + b"+/_-.=")
HEX_MARKS = marks_of(DIGITS + b"abcdef")


def runs(data: bytes, marks: bytes, least: int) -> Iterator[tuple[int, int]]:
    """Maximal runs of marked bytes, ``least`` or longer."""
    marked, probe, at = data.translate(marks), b"\1" * least, 0
    while (start := marked.find(probe, at)) >= 0:
        at = marked.find(b"\0", start)
        at = len(marked) if at < 0 else at
        yield start, at


def unpacked(text: bytes) -> bytes | None:
    """What base64 (either alphabet, padded or not) decodes to."""
    text = text.rstrip(b"=").replace(b"-", b"+").replace(b"_", b"/")
    try:
        return base64.b64decode(text + b"=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def json_object(text: bytes) -> dict | None:
    try:
        value = json.loads(unpacked(text) or b"")
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(text: bytes) -> bool:
    header, payload, _ = text.split(b".")
    found = json_object(header)
    return bool(found) and isinstance(found.get("alg"), str) and json_object(payload) is not None


def der_parts(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The (tag, start, end) of the values from ``start`` on; None if they don't end at ``end``."""
    parts = []
    while start < end:
        if end - start < 2:
            return None
        tag, size, at = data[start], data[start + 1], start + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if at + size > end:
            return None
        parts.append((tag, at, at + size))
        start = at + size
    return parts


SEQUENCE, INTEGER, OCTETS, NAME = 0x30, 0x02, 0x04, 0x06


def is_der_key(data: bytes) -> bool:
    """A private key in DER: an RSA key, an elliptic-curve key, or either in its usual envelope."""
    if len(data) < 32 or data[0] != SEQUENCE:
        return False
    outer = der_parts(data, 0, len(data))
    if outer is None or len(outer) != 1:
        return False
    parts = der_parts(data, *outer[0][1:])
    if not parts or parts[0][0] != INTEGER:
        return False
    tags = [tag for tag, _, _ in parts]
    if tags[:9] == [INTEGER] * 9 or tags[:2] == [INTEGER, OCTETS]:
        return True
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:
        kind = der_parts(data, *parts[1][1:])
        return bool(kind) and kind[0][0] == NAME
    return False


def is_openssh_key(data: bytes) -> bool:
    """The marker, then cipher, method and options by length, a count, and as many public keys."""
    mark = b"openssh-key-v1\0"
    if not data.startswith(mark):
        return False
    at = len(mark)
    for _ in range(3):
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if at > len(data) or not 1 <= keys <= 64:
        return False
    for _ in range(keys + 1):
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        if at > len(data):
            return False
    return True


def is_key(data: bytes | None) -> bool:
    return data is not None and (is_der_key(data) or is_openssh_key(data))


def base_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in bytes."""
    found = []
    lower = data.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        for m in ASSIGN.finditer(data):
            if m.end(1) - m.start(1) >= ASSIGN_MIN:
                found.append((m.start(), 0, m.end()))
    if b"AKIA" in data:
        for m in ACCESS.finditer(data):
            if m.end() - m.start() >= ACCESS_MIN:
                found.append((m.start(), 1, m.end()))
    found += [(start, 2, end) for start, end in runs(data, HEX_MARKS, 32)]
    return found


def confirmed_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of signed tokens and encoded keys, in bytes."""
    found = []
    for start, end in runs(data, PACKED_MARKS, 20):
        at = start
        while m := TOKEN.search(data, at, end):
            if is_signed_token(m[0]):
                found.append((m.start(), 3, m.end()))
                at = m.end()
            else:
                # What was taken for the payload may be the header.
                at = data.index(b".", m.start()) + 1
        for m in PACKED.finditer(data, start, end):
            text = m[0]
            if is_key(unpacked(text)):
                found.append((m.start(), 4, m.end()))
            elif len(text) % 2 == 0 and HEX.fullmatch(text.lower()) and is_key(bytes.fromhex(text.decode())):
                found.append((m.start(), 4, m.end()))
    if b"PRIVATE KEY-----" in data:
        for m in PEM.finditer(data):
            if is_key(unpacked(b"".join(m[2].split()))):
                found.append((m.start(), 4, m.end()))
    return found


def spans_of(text: str | None) -> list[dict]:
    """All spans of a text in order of start, then kind."""
    if not text:
        return []
    data = text.encode()
    found = sorted({*base_spans(data), *confirmed_spans(data)})
    if len(data) != len(text):
        # Byte offsets to code points, in one pass over the text.
        places, at, points = {}, 0, 0
        for place in sorted({p for start, _, end in found for p in (start, end)}):
            points += len(data[at:place].decode())
            at = places[place] = place
            places[place] = points
        found = [(places[start], kind, places[end]) for start, kind, end in found]
    return [{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in found]


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: array of (kind, start, end)."""

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([spans_of(t) for t in batch.tolist()], dtype=object)

    return docs.withColumn("spans", spans(F.col(text)))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s.kind.isin(*KINDS[:3]))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")
