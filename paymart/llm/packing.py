"""Hierarchical multi-length packing (operator 10).

A document's ids (with its end id) are routed to tiers of context size 2048,
1024, 512 and 256:

* whole 2048-id runs are sequences of their own;
* what is left is cut at powers of two into exact windows, until it is less than
  ``GAP`` short of a window (an *open* window of that tier) or shorter than 256
  ids (a *crumb*); both carry their ids;
* if the crumbs of a group cannot fill its open windows, the shortest windows
  become crumbs until they can;
* open windows are filled from the crumbs, long tiers first: the longest crumb
  that fits, and if none fits, a crumb is cut.  Crumbs left over are chained
  into 2048-id sequences, cut where one ends.

Every sequence but the last of a group is therefore exactly full at a power of
two.  Groups are a hash of the piece and its number among equal ones, of about
``GROUP`` pieces and ``GROUP_BYTES`` of ids that may be cut, whatever the size of the
table and its splits, and are packed independently.  Within a group and a context
size, sequences are ordered by attention cost (sum of squared piece lengths)
and dealt to and fro over step groups of ``STEP`` tokens, so steps cost alike.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import numbered_copies, tidy
from paymart.llm.tokens import encoder, tokenizer_path

TIERS = (2048, 1024, 512, 256)
GAP = 128
GROUP = 40_000
GROUP_BYTES = 48 << 20
STEP = 16 * 2048
TOKENIZER = "byte_bpe_50k.json"
END_ID = 1

_PIECE = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("tier", pa.int32()), ("ids", pa.binary())]
)


def route(n: int) -> list[tuple[int, int, int]]:
    """(start, length, tier) of the pieces of ``n`` ids; length < tier is an open window, or a crumb in the last tier."""
    top = TIERS[0]
    out = [(at, top, top) for at in range(0, n - n % top, top)]
    at, left = n - n % top, n % top
    for tier, half in zip(TIERS[:-1], TIERS[1:], strict=True):
        if left and tier - left < GAP:
            return [*out, (at, left, tier)]
        if left >= half:
            out.append((at, half, half))
            at, left = at + half, left - half
    return [*out, (at, left, TIERS[-1])] if left else out


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


@tidy
def _cut(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokens = encoder(path)
    end = np.array([END_ID], tokens.dtype)
    for batch in batches:
        rows: list[list] = [[] for _ in _PIECE]
        for doc, found in zip(batch.column(0).to_pylist(), tokens.encode(batch.column(1)), strict=True):
            ids = np.concatenate((found, end))
            for start, length, tier in route(len(ids)):
                part = ids[start : start + length]
                for column, value in zip(rows, (doc, start, length, crc(part), len(ids), tier, part.astype("<u4").tobytes() if length < tier else None), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _PIECE, strict=True)], schema=_PIECE)


class Crumbs:
    """Pieces to fill gaps with, by length: (piece, start within it)."""

    def __init__(self) -> None:
        self.by_length: list[list[tuple[int, int]]] = [[] for _ in range(TIERS[0])]
        self.there = 0  # bit k: there are crumbs of length k

    def put(self, piece: int, start: int, length: int) -> None:
        self.by_length[length].append((piece, start))
        self.there |= 1 << length

    def _take(self, length: int) -> tuple[int, int]:
        found = self.by_length[length].pop()
        if not self.by_length[length]:
            self.there &= ~(1 << length)
        return found

    def fill(self, gap: int) -> list[tuple[int, int, int]]:
        """(piece, start, length) that add up to ``gap``, or to all crumbs there are."""
        out = []
        while gap and self.there:
            fits = self.there & ((1 << (gap + 1)) - 1)
            if fits:
                length = fits.bit_length() - 1
                piece, start = self._take(length)
            else:
                whole = (self.there & -self.there).bit_length() - 1  # the shortest of the too long
                piece, start = self._take(whole)
                self.put(piece, start + gap, whole - gap)
                length = gap
            out.append((piece, start, length))
            gap -= length
        return out


def sequences(length: np.ndarray, tier: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, start within it, length): every piece's ids once, none longer than the top tier."""
    top, last = TIERS[0], TIERS[-1]
    out = [[(i, 0, n)] for i, n in zip(np.flatnonzero(length == tier).tolist(), length[length == tier].tolist(), strict=True)]
    is_open = (length < tier) & (tier > last)
    is_crumb = (length < tier) & (tier == last)
    windows = np.flatnonzero(is_open)
    windows = windows[np.argsort(length[windows], kind="stable")]
    lack = int((tier - length)[is_open].sum() - length[is_crumb].sum())
    freed = np.concatenate(([0], np.cumsum(tier[windows])))  # a window that becomes a crumb gives its ids and asks for none
    cut = int(np.searchsorted(freed, lack)) if lack > 0 else 0
    is_open[windows[:cut]], is_crumb[windows[:cut]] = False, True
    crumbs = Crumbs()
    for i in np.flatnonzero(is_crumb).tolist():
        crumbs.put(i, 0, int(length[i]))
    for size in TIERS[:-1]:
        for i in np.flatnonzero(is_open & (tier == size)).tolist():
            n = int(length[i])
            out.append([(i, 0, n), *crumbs.fill(size - n)])
    while crumbs.there:
        out.append(crumbs.fill(top))
    return out


def _context(total: int) -> int:
    return total if total in TIERS else TIERS[0]


def _pack(key: tuple, group: pa.Table) -> pa.Table:
    group = group.combine_chunks().sort_by("place")
    length, tier = group.column("length").to_numpy(), group.column("tier").to_numpy()
    made = sequences(length, tier)
    start, crcs, total = (group.column(c).to_numpy() for c in ("start", "ids_crc32", "doc_tokens"))
    doc, ids = group.column("doc_id"), group.column("ids")
    steps = np.zeros(len(made), np.int64)
    context = np.array([_context(sum(p[2] for p in s)) for s in made], np.int64)
    cost = np.array([sum(p[2] * p[2] for p in s) for s in made], np.int64)
    for k, size in enumerate(TIERS):
        own = np.flatnonzero(context == size)
        own = own[np.argsort(-cost[own], kind="stable")]
        n = max(1, -(-len(own) * size // STEP))
        lap, at = np.divmod(np.arange(len(own)), n)
        steps[own] = (k << 28) + np.where(lap % 2, n - 1 - at, at)
    base = key[0].as_py() << 32
    rows: list[list] = [[] for _ in range(9)]
    which = []
    for s, parts in enumerate(made):
        offset = 0
        for i, skip, n in parts:
            value = int(crcs[i])
            if n != length[i]:
                value = zlib.crc32(ids[i].as_buffer()[4 * skip : 4 * (skip + n)])
            which.append(i)
            for column, v in zip(rows[1:], (int(start[i]) + skip, n, value, int(total[i]), base + s, offset, int(context[s]), base + int(steps[s])), strict=True):
                column.append(v)
            offset += n
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "context", "step_group"]
    arrays = [doc.take(pa.array(which, pa.int64())), *(pa.array(c, pa.int64()) for c in rows[1:])]
    return pa.table(dict(zip(names, arrays, strict=True)))


def pack(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context, step_group.

    A document's pieces cover its ids once; pieces of a sequence are gapless from offset 0 and at most
    2048 ids.  A sequence is padded to ``context``: its own length at a tier's size, else 2048.  Null
    and empty texts are one end id.  Null and repeated doc ids are packed row by row (their pieces keep
    the id); other columns of ``docs`` are ignored; no documents give no pieces.  The result is the same
    however the input is split.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, tier int, ids binary"
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(functools.partial(_cut, path=path), schema)
    own = F.xxhash64("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    numbered, written = numbered_copies(pieces, own, "copy", "pieces")
    size = written.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("ids")), F.lit(0))).first()
    groups = max(1, -(-size[0] // GROUP), -(-size[1] // GROUP_BYTES))
    keyed = numbered.withColumn("place", F.xxhash64(own, "copy")).withColumn("pack_group", F.pmod("place", F.lit(groups))).drop("copy")
    return keyed.groupBy("pack_group").applyInArrow(
        _pack,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context long, step_group long",
    )
