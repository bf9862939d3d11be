"""Secret scans with structural confirmation.

Three plain patterns are reported as they stand: assignments of a word such as ``password``, access
key ids, and long runs of hexadecimal digits. Beyond those, candidates that only look encoded
(armoured blocks, base64 and hexadecimal runs, dotted tokens) are decoded and must have the inner
structure of a key or a signed token before they are reported:

- ``der``: a DER sequence whose nested lengths add up exactly and which has the fields of a private
  key (PKCS#1, PKCS#8, SEC 1, or encrypted PKCS#8), as armour, bare base64 or hexadecimal digits;
- ``openssh``: the magic of an OpenSSH key followed by length-prefixed fields that fit;
- ``jwt``: three dotted base64url parts whose first decodes to a JSON object that names an algorithm.

Positions are code points, the end is exclusive.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "der", "openssh", "jwt")
SPANS = "array<struct<start: int, end: int, kind: string>>"

_ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss](?:[Ww][Oo][Rr][Dd]|[Ww][Dd])|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_ARMOUR = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----")
_ARMOUR_END = re.compile(r"-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----")
_BASE64 = re.compile(r"[A-Za-z0-9+/]{40,}={0,2}")
_HEX_EITHER = re.compile(r"30[0-9A-Fa-f]{62,}")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
_MAGIC = b"openssh-key-v1\0"
_INTEGER, _OCTETS, _SEQUENCE = 0x02, 0x04, 0x30


def _items(data: bytes) -> list[tuple[int, bytes]] | None:
    """The DER items that ``data`` consists of, or None if lengths do not add up to its end."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length >= 0x80:
            digits = length & 0x7F
            if not 1 <= digits <= 4 or at + digits > len(data):
                return None
            length = int.from_bytes(data[at : at + digits], "big")
            at += digits
            if length < 0x80:  # not the shortest form
                return None
        if at + length > len(data):
            return None
        found.append((tag, data[at : at + length]))
        at += length
    return found


def is_der_key(data: bytes) -> bool:
    """Whether ``data`` is exactly one DER sequence with the fields of a private key."""
    outer = _items(data)
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE:
        return False
    fields = _items(outer[0][1])
    if not fields or len(fields) < 2:
        return False
    tags = [tag for tag, _ in fields]
    if tags[0] == _INTEGER and len(fields[0][1]) == 1:
        if len(fields) >= 9 and all(tag == _INTEGER for tag in tags[:9]):  # PKCS#1: nine integers
            return True
        if tags[1] == _OCTETS and len(fields[1][1]) >= 16:  # SEC 1: version, key
            return fields[0][1] == b"\x01"
        if len(fields) >= 3 and tags[1] == _SEQUENCE and tags[2] == _OCTETS:  # PKCS#8: version, algorithm, key
            algorithm = _items(fields[1][1])
            return bool(algorithm) and algorithm[0][0] == 0x06
        # DSA: version, p, q, g, public, private
        return len(fields) == 6 and all(tag == _INTEGER for tag in tags)
    if len(fields) == 2 and tags == [_SEQUENCE, _OCTETS]:  # encrypted PKCS#8: algorithm with parameters, data
        algorithm = _items(fields[0][1])
        return bool(algorithm) and len(algorithm) == 2 and algorithm[0][0] == 0x06 and algorithm[1][0] == _SEQUENCE
    return False


def is_openssh_key(data: bytes) -> bool:
    """Whether ``data`` has the magic, three named fields, a count and as many public keys that fit."""
    if not data.startswith(_MAGIC):
        return False
    at = len(_MAGIC)

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        length = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if at + length > len(data):
            return None
        at += length
        return data[at - length : at]

    for _ in range(3):  # cipher, derivation, its options
        if field() is None:
            return False
    if at + 4 > len(data):
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    return 1 <= keys <= 64 and all(field() for _ in range(keys)) and bool(field())


def is_signed_token(text: str) -> bool:
    """Whether the first of three dotted parts is a JSON object that names its algorithm."""
    parts = text.split(".")
    if len(parts) != 3 or not all(parts):
        return False
    try:
        header = json.loads(base64.urlsafe_b64decode(parts[0] + "=" * (-len(parts[0]) % 4)))
        base64.urlsafe_b64decode(parts[1] + "=" * (-len(parts[1]) % 4))
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def _decoded(text: str) -> bytes | None:
    try:
        return base64.b64decode(text + "=" * (-len(text.rstrip("=")) % 4 if not text.endswith("=") else 0), validate=True)
    except (ValueError, binascii.Error):
        return None


def _key_kind(data: bytes | None) -> str | None:
    if data is None:
        return None
    return "openssh" if is_openssh_key(data) else "der" if is_der_key(data) else None


def _armoured(text: str) -> Iterator[tuple[int, int, str]]:
    at = 0
    while begin := _ARMOUR.search(text, at):
        end = _ARMOUR_END.search(text, begin.end())
        if not end:
            return
        # The nearest opening line before the end is the one that belongs to it.
        inner = text.rfind("-----BEGIN ", begin.end(), end.start())
        opening = _ARMOUR.match(text, inner) if inner >= 0 else begin
        opening = opening or begin
        body = re.sub(r"^[A-Za-z-]+:.*$", "", text[opening.end() : end.start()], flags=re.M)
        kind = _key_kind(_decoded(re.sub(r"\s+|\\n", "", body)))
        if kind:
            yield opening.start(), end.end(), kind
        at = end.end()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The spans of the three plain patterns, leftmost and non-overlapping per kind."""
    spans = [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    spans += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    spans += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return spans


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Candidates that decode to a key or a signed token."""
    spans, taken = list(_armoured(text)), []
    taken = [(a, b) for a, b, _ in spans]

    def free(at: int) -> bool:
        return not any(a <= at < b for a, b in taken)

    for m in _BASE64.finditer(text):
        # A DER sequence starts with M, the magic of OpenSSH with b3BlbnNz.
        if m[0][0] == "M" or m[0].startswith("b3BlbnNz"):
            kind = _key_kind(_decoded(m[0]))
            if kind and free(m.start()):
                spans.append((*m.span(), kind))
    for m in _HEX_EITHER.finditer(text):
        digits = m[0] if len(m[0]) % 2 == 0 else m[0][:-1]
        if is_der_key(bytes.fromhex(digits)) and free(m.start()):
            spans.append((m.start(), m.start() + len(digits), "der"))
    spans += [(*m.span(), "jwt") for m in _JWT.finditer(text) if is_signed_token(m[0])]
    return spans


def find_spans(text: str | None) -> list[tuple[int, int, str]]:
    """All spans by start, then kind as listed in ``KINDS``; none without a text."""
    if not text:
        return []
    return sorted(base_spans(text) + confirmed_spans(text), key=lambda s: (s[0], KINDS.index(s[2])))


def secret_spans(text: Column) -> Column:
    """The secrets of a text as an array of (start, end, kind), sorted; empty for null or empty texts.

    A column function: rows, repeated or not, and other columns stay as they are. Texts are
    scanned whole, one at a time.
    """

    @F.arrow_udf(SPANS)
    def scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        for column in texts:
            found = [
                [{"start": a, "end": b, "kind": k} for a, b, k in find_spans(value.as_py())] for value in column
            ]
            yield pa.array(found, kind)

    return scan(text)


def _redacted(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    parts, at = [], 0
    for start, end, _ in spans:
        if end <= at:
            continue
        if start >= at:
            parts += [text[at:start], mark]
        at = end
    return "".join([*parts, text[at:]])


def redact_secrets(text: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by ``mark``; texts without secrets and null unchanged."""

    @F.arrow_udf("string")
    def redact(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            out = []
            for value in column:
                plain = value.as_py()
                spans = find_spans(plain)
                out.append(_redacted(plain, spans, mark) if spans else plain)
            yield pa.array(out, pa.string())

    return redact(text)


def joined_spans(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """Spans of the given kinds as ``kind:start:end``, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
