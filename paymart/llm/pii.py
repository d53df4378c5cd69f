"""Format-preserving pseudonyms by a keyed Feistel network (operator 7).

Found and validated: ``email``, ``card`` (13 to 19 digits with a right check
digit), ``phone``, ``ssn``, ``ip`` (four octets) and ``date`` (a day of the
calendar).  A value is read as a number of its format's domain, permuted by a
Feistel network under the key (walking the cycle until the image lies in the
domain again), and written back in the same format: lengths, separators,
letter classes, check digits and the calendar hold.  The permutation depends on
key and kind only, so equal values get equal pseudonyms in every document and
different ones stay different; ``Feistel.back`` undoes it for who holds the key.

A slash date is read as day/month, and as month/day if that is no date; days up
to the 12th and days after it are permuted apart, so that a pseudonym is read in
the same order.  A phone without separators needs a ``+`` (8 to 15 digits).
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import texts_of, tidy

KINDS = ("email", "date", "card", "phone", "ssn", "ip")
KEY = b"paymart-demonstration-key"
ROUNDS = 10

_FIRST_DAY, _LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", re.ASCII)
_RUN = re.compile(r"[0-9+(][0-9()+ ./-]*[0-9]", re.ASCII)
_NUMBER = re.compile(
    r"(?P<date>(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]))"
    r"|(?P<ip>(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9]))"
    r"|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"
    r"|(?P<card>(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9]))"
    r"|(?P<phone>(?<![0-9A-Za-z+])\+[1-9][0-9]{7,14}(?![0-9]|-[0-9])|(?:\+[0-9]{1,3}[ .-]?|(?<![0-9+])(?<![0-9][ .-]))(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3,4}[ .-][0-9]{4}(?![0-9]|-[0-9]))",
    re.ASCII,
)
#: Country codes of one and two digits; all others have three.
_CODE = re.compile(r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})", re.ASCII)
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(b"0123456789@")] = True


class Feistel:
    """A keyed permutation of 0 .. size - 1."""

    def __init__(self, key: bytes, kind: str, size: int) -> None:
        self.size = size
        self.half = max(1, -(-(size - 1).bit_length() // 2))
        self.mask = (1 << self.half) - 1
        self.bytes = -(-self.half // 8)
        self.seed = hashlib.blake2b(f"{kind}:{size}".encode(), key=key[:64], digest_size=32).digest()

    def _round(self, k: int, half: int) -> int:
        got = hashlib.blake2b(bytes([k]) + half.to_bytes(self.bytes, "little"), key=self.seed, digest_size=min(64, self.bytes + 8)).digest()
        return int.from_bytes(got, "little") & self.mask

    def _once(self, value: int, order: range, back: bool) -> int:
        left, right = value >> self.half, value & self.mask
        for k in order:
            if back:
                left, right = right ^ self._round(k, left), left
            else:
                left, right = right, left ^ self._round(k, right)
        return left << self.half | right

    def __call__(self, value: int) -> int:
        while True:
            value = self._once(value, range(ROUNDS), False)
            if value < self.size:
                return value

    def back(self, value: int) -> int:
        while True:
            value = self._once(value, range(ROUNDS - 1, -1, -1), True)
            if value < self.size:
                return value


@functools.lru_cache(4096)
def _permutation(key: bytes, kind: str, size: int) -> Feistel:
    return Feistel(key, kind, size)


def check_digit(digits: str) -> str:
    """The digit that makes ``digits`` + it pass the mod 10 test."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _refill(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in text)


def _permuted(key: bytes, kind: str, digits: str) -> str:
    return str(_permutation(key, kind, 10 ** len(digits))(int(digits))).zfill(len(digits))


def _card(key: bytes, text: str) -> str | None:
    digits = _digits(text)
    if check_digit(digits[:-1]) != digits[-1]:
        return None
    body = _permuted(key, "card", digits[:-1])
    return _refill(text, body + check_digit(body))


def _phone(key: bytes, text: str) -> str | None:
    at = _CODE.match(text) if text[1:].isdigit() else re.match(r"\+[0-9]{1,3}", text)
    code, own = (at[0], text[at.end() :]) if at else ("", text)  # the country code stays
    return code + _refill(own, _permuted(key, "phone", _digits(own)))


def _ssn(key: bytes, text: str) -> str | None:
    if text[:3] in ("000", "666") or text[0] == "9" or text[4:6] == "00" or text[7:] == "0000":
        return None
    digits = _digits(text)
    while True:  # the walk goes on until the image is a valid number again
        digits = _permuted(key, "ssn", digits)
        if not (digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000"):
            return _refill(text, digits)


def _ip(key: bytes, text: str) -> str | None:
    octets = [int(x) for x in text.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    value = _permutation(key, "ip", 1 << 32)(int.from_bytes(bytes(octets), "big"))
    return ".".join(map(str, value.to_bytes(4, "big")))


def _date(key: bytes, text: str) -> str | None:
    form = "%Y-%m-%d" if text[4] == "-" else "%d/%m/%Y" if text[2] == "/" else "%d.%m.%Y"
    if text[2] == "/" and int(text[:2]) <= 12 < int(text[3:5]):
        form = "%m/%d/%Y"
    try:
        date = datetime.datetime.strptime(text, form).date()
    except ValueError:
        return None
    if not _FIRST_DAY <= date.toordinal() <= _LAST_DAY:
        return None
    late = date.day > 12
    while True:  # the walk goes on until the image is as late in its month, so that its order can be told as well
        day = _permutation(key, "date", _LAST_DAY - _FIRST_DAY + 1)(date.toordinal() - _FIRST_DAY)
        date = datetime.date.fromordinal(day + _FIRST_DAY)
        if (date.day > 12) == late:
            return date.strftime(form)


def _email(key: bytes, text: str) -> str | None:
    """The local part's letters and digits, each within its class; the domain stays."""
    local, _, domain = text.rpartition("@")
    classes = [(10, "0") if c.isdigit() else (26, "a") if c.islower() else (26, "A") if c.isupper() else (1, c) for c in local]
    size, value = 1, 0
    for c, (radix, zero) in zip(local, classes, strict=True):
        value = value * radix + (ord(c) - ord(zero))
        size *= radix
    shape = "".join(zero for _, zero in classes)
    value = _permutation(key, f"email:{shape}", size)(value)
    out = []
    for radix, zero in reversed(classes):
        value, digit = divmod(value, radix)
        out.append(chr(ord(zero) + digit))
    return "".join(reversed(out)) + "@" + domain


_WRITE = {"email": _email, "date": _date, "card": _card, "phone": _phone, "ssn": _ssn, "ip": _ip}


def _numbers(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, value) of what looks like a number of some kind, tried again one character on if it is not valid."""
    for run in _RUN.finditer(text):
        at = run.start()
        while (m := _NUMBER.search(text, at, run.end())) is not None:
            valid = yield m.start(), m.end(), next(k for k in KINDS[1:] if m[k] is not None), m[0]
            at = m.end() if valid else m.start() + 1


def pseudonyms(text: str, key: bytes = KEY) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with every validated value replaced, and (kind, start, end) of each in the text given."""
    found: list[tuple[int, int, str, str]] = []
    end, at = 0, text.find("@")
    while at >= 0:
        m = _EMAIL.search(text, max(end, at - 64))  # a local part has 64 characters at most
        if m is None:
            break
        found.append((m.start(), m.end(), "email", _email(key, m[0])))
        end = m.end()
        at = text.find("@", end)
    taken = {k for a, b, *_ in found for k in range(a, b)}
    numbers = _numbers(text)
    one = next(numbers, None)
    while one is not None:
        a, b, kind, value = one
        new = None if a in taken or b - 1 in taken else _WRITE[kind](key, value)
        if new is not None:
            found.append((a, b, kind, new))
        try:
            one = numbers.send(new is not None)
        except StopIteration:
            break
    out, at = [], 0
    for a, b, _, new in sorted(found):
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]]), [(kind, a, b) for a, b, kind, _ in sorted(found)]


@tidy
def _replaced(batches: Iterator[pa.RecordBatch], key: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(1)
        texts = column.to_pylist()
        said: list[list[tuple[str, int, int]]] = []
        for i, data in enumerate(texts_of(column)):
            if data is None or not _IS_MARK[data].any():
                said.append([])
            else:
                texts[i], found = pseudonyms(texts[i], key)
                said.append(found)
        counts = [pa.array([sum(s[0] == kind for s in found) for found in said], pa.int64()) for kind in KINDS]
        spans = pa.array([",".join(f"{k}:{a}:{b}" for k, a, b in found) for found in said], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), *counts, spans], names=["doc_id", "text", *(f"n_{k}" for k in KINDS), "spans"])


def pseudonymize(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """One row per document: doc_id, text (with pseudonyms), n_email .. n_ip, spans (kind:start:end in the text given).

    Null stays null and empty stays empty, without spans.  Null ids and repeated rows are treated like
    any other; other columns of ``docs`` are ignored.  The default key is for demonstration.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        functools.partial(_replaced, key=key), "doc_id long, text string, " + ", ".join(f"n_{k} long" for k in KINDS) + ", spans string"
    )
