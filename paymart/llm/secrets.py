"""Secret scans (operator 4).

Base kinds are found by pattern: ``assign`` (a key name and its value),
``access`` (an access key id) and ``hex`` (a long lower-case hex run).  Two
more kinds are reported only after structural confirmation:

* ``jwt``: three base64url parts; the first decodes to a JSON object with a
  string ``alg``, the second to a JSON object;
* ``key``: base64 or hex text of at least 36 bytes that decodes to a DER key
  (RSA, DSA, EC, PKCS#8, encrypted PKCS#8 or a public key) whose nested lengths
  add up exactly, or to an OpenSSH private key whose length-prefixed fields
  fit.  A PEM body's line breaks are skipped, real ones and those written as a
  backslash and a letter.  Without a BEGIN line a key may be wrapped over lines,
  of which the first of a block has 16 characters at least; its own length
  fields say on which line it ends.

Cheap byte tests pick the texts worth a pattern; every text is read whole.
Offsets are code points, ends are exclusive.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import itertools
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import texts_of, tidy

KINDS = ("assign", "access", "hex", "jwt", "key")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32
MIN_LINE, MIN_KEY = 16, 36  # characters of a wrapped key's first line; decoded bytes of a key
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
# a JSON object begins with a brace or with white space, so its base64 with one of these letters
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(?=([eCDI][A-Za-z0-9_-]+)\.([eCDI][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*))")
_PEM = re.compile(r"-----BEGIN ([A-Z ]+)-----((?:[A-Za-z0-9+/=\s]|\\+[nrt/])++)-----END \1-----")
_BREAK = r"(?:[\r\n]|\\+[rn])++(?:[\x20\t]|\\+t)*+"
_BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_HEX_LINE = re.compile(r"[0-9A-Fa-f]+")
_BASE64 = re.compile(
    r"(?:(?<=\\[nrt])|(?<![A-Za-z0-9+/_-])(?!(?<=\\)[nrt]))[A-Za-z0-9+/_-]{%d,}+(?:%s[A-Za-z0-9+/_-]++)*+={0,2}" % (MIN_LINE, _BREAK)
)
_ANY_HEX = re.compile(r"[0-9A-Fa-f]{%d,}+(?:%s[0-9A-Fa-f]++)*+" % (MIN_LINE, _BREAK))
_BREAKS = re.compile(_BREAK)
_ESCAPED = re.compile(r"\\+([nrt/])")
_OPENSSH = b"openssh-key-v1\x00"
_ENCODED = np.zeros(256, bool)
_ENCODED[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=.")] = True

Span = tuple[str, int, int]


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the DER element at ``at``, if its length is well formed and fits."""
    if at + 2 > end:
        return None
    tag, size = data[at], data[at + 1]
    at += 2
    if size & 0x80:
        wide = size & 0x7F
        if not 1 <= wide <= 4 or at + wide > end or data[at] == 0:
            return None
        size = int.from_bytes(data[at : at + wide], "big")
        at += wide
        if size < 0x80:
            return None
    return (tag, at, at + size) if at + size <= end else None


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``at`` to ``end`` exactly."""
    found = []
    while at < end:
        one = _element(data, at, end)
        if one is None:
            return None
        found.append(one)
        at = one[2]
    return found


def is_der_key(data: bytes) -> bool:
    """RSA (public or private), DSA or EC private, PKCS#8 (plain or encrypted) or SubjectPublicKeyInfo, by its nested elements."""
    outer = _element(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    parts = _children(data, outer[1], outer[2])
    if not parts:
        return False
    tags = [p[0] for p in parts]
    if tags == [0x02] * 6:  # DSA private key: version 0, three parameters, both keys
        return data[parts[0][1] : parts[0][2]] == b"\x00" and parts[1][2] - parts[1][1] >= 32
    if len(tags) >= 2 and set(tags) == {0x02}:  # RSA: modulus and exponents, or a leading version 0 and eight numbers
        return len(tags) == 2 and parts[0][2] - parts[0][1] >= 32 or len(tags) >= 9 and parts[0][2] - parts[0][1] == 1
    if tags[:2] == [0x02, 0x04]:  # EC private key: version 1 and an octet string
        return data[parts[0][1] : parts[0][2]] == b"\x01" and parts[1][2] - parts[1][1] >= 16
    named = lambda p: bool(inside := _children(data, p[1], p[2])) and inside[0][0] == 0x06
    if tags[:3] == [0x02, 0x30, 0x04]:  # PKCS#8: version, algorithm, key
        return parts[0][2] - parts[0][1] == 1 and named(parts[1])
    if tags == [0x30, 0x04]:  # encrypted PKCS#8: algorithm with its parameters (a plain digest has none), encrypted key
        inside = _children(data, parts[0][1], parts[0][2])
        return bool(inside) and [p[0] for p in inside] == [0x06, 0x30] and parts[1][2] - parts[1][1] >= 16
    if tags == [0x30, 0x03]:  # public key: algorithm, bit string
        return named(parts[0]) and parts[1][2] - parts[1][1] >= 16
    return False


def is_openssh_key(data: bytes) -> bool:
    if not data.startswith(_OPENSSH):
        return False
    at, fields = len(_OPENSSH), 0
    while fields < 3:  # cipher, key derivation and its options
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        fields += 1
    return at + 4 <= len(data) and 1 <= int.from_bytes(data[at : at + 4], "big") <= 64


def is_key(data: bytes) -> bool:
    return is_der_key(data) or is_openssh_key(data)


def _whole_size(data: bytes) -> int | None:
    """Bytes of the DER key that ``data`` begins with, by its length field; None if it does not tell."""
    if data[:1] == b"\x30" and len(data) >= 2:
        wide = data[1] & 0x7F if data[1] & 0x80 else 0
        return (2 + wide + int.from_bytes(data[2 : 2 + wide], "big") if wide else 2 + data[1]) if wide <= 4 else None
    return None


def _openssh_size(read: Callable[[int, int], bytes | None], most: int) -> tuple[bool, int | None]:
    """Whether the fields up to the number of keys are there, and the bytes of the key if all its fields are.

    ``read(at, n)`` gives bytes of the key; only the length fields are read.  ``most``: no field ends behind it.
    """
    def number(at: int) -> int | None:
        data = read(at, 4) if at + 4 <= most else None
        return int.from_bytes(data, "big") if data is not None and len(data) == 4 else None

    at = len(_OPENSSH)
    if read(0, at) != _OPENSSH:
        return False, None
    keys = None
    for _ in range(3):  # cipher, key derivation and its options
        size = number(at)
        if size is None:
            return False, None
        at += 4 + size
    keys = number(at)
    if keys is None or not 1 <= keys <= 64:
        return False, None
    at += 4
    for _ in range(keys + 1):  # public keys, the private part
        size = number(at)
        if size is None:
            return True, None
        at += 4 + size
    return True, at if at <= most else None


def _part(text: str, start: int, at: int, n: int, decoded: Callable[[str], bytes | None], bits: int) -> bytes | None:
    """Bytes ``at`` to ``at + n`` of what is encoded from character ``start`` on."""
    chars, size = (4, 3) if bits == 6 else (2, 1)
    first, skip = at // size * chars, at % size
    data = decoded(text[start + first : start + first + -(-(skip + n) // size) * chars])
    return data[skip : skip + n] if data is not None and len(data) >= skip + n else None


def _from_base64(text: str) -> bytes | None:
    body = re.sub(r"\s+", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _is_object(text: str, need: str | None = None) -> bool:
    data = _from_base64(text)
    try:
        value = json.loads(data) if data is not None else None
    except (ValueError, RecursionError):
        return False
    return isinstance(value, dict) and (need is None or isinstance(value.get(need), str))


def _from_hex(text: str) -> bytes | None:
    return bytes.fromhex(text) if len(text) % 2 == 0 else None


def _plain(m: re.Match) -> str:
    """What an escape in a PEM body stands for: a slash, or white space."""
    return "/" if m[1] == "/" else ""


def _lines(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """(start, end) of the lines of a block, without their breaks."""
    breaks = [m.span() for m in _BREAKS.finditer(text, start, end)]
    return list(zip([start, *(b for _, b in breaks)], [*(a for a, _ in breaks), end], strict=True))


def _keys_in(text: str, start: int, end: int, line: re.Pattern, starts: tuple[str, ...], decoded: Callable[[str], bytes | None], bits: int) -> list[Span]:
    """Spans of the keys in a block of encoded lines: each begins a line and ends one, as its own lengths say."""
    lines = _lines(text, start, end)
    bodies = [line.match(text, a, b)[0] for a, b in lines]
    upto = [0, *itertools.accumulate(map(len, bodies))]
    whole = "".join(bodies)
    found, free = [], 0
    for i, body in enumerate(bodies):
        if i < free or not body.startswith(starts):
            continue
        head = "".join(bodies[i : i + 4])[:16]  # a tag and its length take 6 bytes at most
        if head.startswith(starts[0]):
            size = _whole_size(decoded(head[: len(head) // 4 * 4]) or b"")
            if size is None or size < MIN_KEY:
                continue
            last = bisect.bisect_left(upto, upto[i] + -(-8 * size // bits), i + 1)
            if last == len(upto) or upto[last] != upto[i] + -(-8 * size // bits):
                continue
        else:  # lines of one length and a shorter one at most, and no more than the fields ask for
            header, size = _openssh_size(lambda at, n: _part(whole, upto[i], at, n, decoded, bits), len(whole) - upto[i])  # noqa: B023
            if not header:
                continue
            last = i + 1
            while last < len(bodies) and len(bodies[last - 1]) == len(body) >= len(bodies[last]):
                last += 1
            if size is not None:
                last = min(last, bisect.bisect_left(upto, upto[i] + -(-8 * size // bits), i + 1))
        data = decoded("".join(bodies[i:last]))
        if data is None and last - i > 1:
            last -= 1
            data = decoded("".join(bodies[i:last]))
        if data is not None and len(data) >= MIN_KEY and is_key(data):
            found.append((lines[i][0], lines[last - 1][1]))
            free = last
    return found


def confirmed(text: str) -> list[Span]:
    found, end = [], 0
    for m in _JWT.finditer(text):
        if m.start() >= end and _is_object(m[1], "alg") and _is_object(m[2]):
            end = m.end(3)
            found.append(("jwt", m.start(), end))
    taken = []
    for m in _PEM.finditer(text):
        if (data := _from_base64(_ESCAPED.sub(_plain, m[2]))) and is_key(data):
            found.append(("key", *m.span()))
            taken.append(m.span())
    free = lambda start, end: not any(a < end and start < b for a, b in taken)
    for pattern, line, starts, decoded, bits in (
        (_BASE64, _BASE64_LINE, ("M", "b3BlbnNzaC1rZXkt"), _from_base64, 6),
        (_ANY_HEX, _HEX_LINE, ("30", _OPENSSH[:8].hex(), _OPENSSH[:8].hex().upper()), _from_hex, 4),
    ):
        for m in pattern.finditer(text):
            keys = [k for k in _keys_in(text, m.start(), m.end(), line, starts, decoded, bits) if free(*k)]
            found += [("key", *k) for k in keys]
            taken += keys
    return found


def _longest_encoded(data: np.ndarray) -> int:
    breaks = np.flatnonzero(~_ENCODED[data])
    return int(np.diff(breaks, prepend=-1, append=len(data)).max()) - 1 if len(data) else 0


def scan(data: np.ndarray | None) -> tuple[list[Span], list[tuple[int, int]]]:
    """Spans of a text by start, then kind, and what to hide of it (of ``assign`` the value alone)."""
    if data is None or not len(data):
        return [], []
    raw = data.tobytes()
    small = raw.lower()
    named = any(name in small for name in _NAMES)
    access = b"AKIA" in raw
    run = _longest_encoded(data)
    pem = b"-----BEGIN " in raw
    if not (named or access or run >= MIN_LINE or pem):
        return [], []
    text = raw.decode("utf-8", "replace")
    found: list[Span] = []
    hide: list[tuple[int, int]] = []
    if named:
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= MIN_VALUE:
                found.append(("assign", *m.span()))
                hide.append(m.span(2))
    if access:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    if run >= MIN_HEX:
        found += [("hex", *m.span()) for m in _HEX.finditer(text) if len(m[0]) >= MIN_HEX]
    if run >= MIN_LINE or pem:  # the shortest signed token is longer
        found += confirmed(text)
    found.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return found, hide + [s[1:] for s in found if s[0] != "assign"]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


@tidy
def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in scan(t)[0]] for t in texts_of(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], names=["doc_id", "spans"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>), one row per document, spans by start, then kind.

    Null, empty and clean texts have no spans.  Null ids and repeated rows are scanned like any other;
    other columns of ``docs`` are ignored.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scanned, "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    )


def digests(scanned: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select(
        "doc_id", *(count(k) for k in KINDS[:3]), F.sha2(said(base).cast("binary"), 256).alias("base_sha256"),
        said(F.col("spans")).alias("spans"), *(count(k) for k in KINDS[3:]),
    )


def hidden(text: str, hide: list[tuple[int, int]], mask: str = "[SECRET]") -> str:
    """The text with every span replaced; spans that overlap or touch share one mask."""
    out, at = [], 0
    merged: list[list[int]] = []
    for a, b in sorted(hide):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


@tidy
def _redacted(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column, new = batch.column(at), {}
        for i, data in enumerate(texts_of(column)):
            hide = scan(data)[1]
            if hide:
                new[i] = hidden(data.tobytes().decode("utf-8", "replace"), hide)
        if new:
            values = column.to_pylist()
            for i, text in new.items():
                values[i] = text
            batch = batch.set_column(at, batch.schema.field(at), pa.array(values, column.type))
        yield batch


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mask; rows and other columns stay, n_chars (if there) follows the text."""
    at = docs.columns.index("text")
    done = docs.mapInArrow(lambda batches: _redacted(batches, at), docs.schema)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done
