"""Exact substring dedup by level-wise doubling (operator 11).

A window of 35 words that starts in several places is found through shorter
windows, each level twice as long as the one before: 9, 18, 35.  Only what
repeats at one length is extended to the next; the search ends at 35, or at the
first length at which nothing repeats.

Not every short window is counted.  Each window of 35 words has an anchor: of
the 9-word grams that start at its first 18 words the one of smallest hash (the
first of equals).  Equal windows have equal anchors at equal offsets, so a
window repeats only if its anchor gram does; an anchor serves 9 windows on
average.  An anchor occurrence is one row

    h0, h1   hashes of the 9 and 18 words from the anchor on (inside each of its windows)
    span     hash of all words of its windows and of their offsets
    d, th    the document: id, and hash of id and text
    place    the anchor's word, and smallest and largest offset of its windows, in one long

and passes the levels as that one row.  At full length equal (h0, span) are one
class, whose windows are the same.  Windows of a class with several occurrences
repeat.  Where a gram has classes of one occurrence beside others (the borders
of copied passages), one occurrence a class lists its windows, and those that
several classes list repeat too.

A gram, span or window that a third of all documents share is counted with a
map-side sum and never gathered: what a count decides goes back to its rows by
(key, one of 64 buckets of rows).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import IS_WORD, WordHashes, mix64, staged, tidy

WINDOW = 35
LEVELS = 2
BUCKETS = 64
TOGETHER = 1 << 18  # bytes of texts that are worked on at once (a longer text is taken alone)
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def lengths(window: int = WINDOW, levels: int = LEVELS) -> list[int]:
    """The lengths of the levels, each at most twice the one before: [9, 18, 35]."""
    out = [-(-window // (1 << k)) for k in range(levels, -1, -1)]
    if out[0] < 1 or window - out[-2] + 1 > 62:
        raise ValueError(f"no levels {out} for windows of {window} words: offsets must fit 62 bits")
    return out


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(mix64(a * _LEFT) ^ (b * _RIGHT))


def window_hashes(words: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Hashes of all windows of each of the ascending sizes, by doubling: two overlapping halves make a window."""
    out, half, size = [], words, 1
    for wanted in sizes:
        while size < wanted:
            grown = min(2 * size, wanted)
            n = max(len(words) - grown + 1, 0)
            half = _joined(half[:n], half[grown - size : grown - size + n])
            size = grown
        out.append(half)
    return out


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of its smallest, the first of equals."""
    place, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        a, b = place[:-step], place[step:]
        place = np.where(values[a] <= values[b], a, b)
        size += step
    return place


class _Texts:
    """Texts that lie one after the other in a column's buffer, taken together: words, bounds and window hashes.

    ``at``: byte offsets of the texts, ``low``: number of the first word of each (and of the end).
    """

    def __init__(self, data: np.ndarray, at: np.ndarray) -> None:
        self.data, self.at = data, at
        self.is_word = IS_WORD[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[at] = True
        rest = ~self.is_word
        self.starts = np.flatnonzero(self.is_word & (cut[:-1] | np.concatenate(([True], rest[:-1])))) if len(data) else np.empty(0, np.int64)
        self.ends = np.flatnonzero(self.is_word & (cut[1:] | np.concatenate((rest[1:], [True])))) + 1 if len(data) else np.empty(0, np.int64)
        self.low = np.searchsorted(self.starts, at)
        self.of = np.repeat(np.arange(len(at) - 1), np.diff(self.low))  # word -> its text

    def windows(self, hashes: WordHashes, sizes: list[int]) -> list[np.ndarray]:
        return window_hashes(hashes(self.data, self.starts, self.ends), sizes)

    def anchors(self, hashes: WordHashes, sizes: list[int]) -> tuple[np.ndarray, ...]:
        """(text, place, smallest offset, largest offset, span, level hashes...) of the anchors."""
        window = sizes[-1]
        at = np.flatnonzero(np.arange(window, len(self.of) + window) <= self.low[1:][self.of])  # windows that lie in one text
        if not len(at):
            return tuple(np.empty(0, np.int64) for _ in range(4 + len(sizes)))
        *short, full = self.windows(hashes, sizes)
        place = leftmost_minima(short[0], window - sizes[-2] + 1)[at]
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], len(place)) - 1
        place, first, last = place[first], at[first], at[last]
        low, high = place - last, place - first
        span = _joined(_joined(full[first], full[last]), (low * 64 + high).astype(np.uint64))
        of = self.of[place]
        return (of, place - self.low[of], low, high, span, *(h[place] for h in short))


def _taken(column: pa.Array) -> Iterator[tuple[int, int, _Texts]]:
    """(first row, row after the last, texts) of a column, some texts at a time; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(at, at[low] + TOGETHER, side="right")) - 1)
        yield low, high, _Texts(data[at[low] : at[high]], at[low : high + 1] - at[low])
        low = high


def _anchors(window: int, levels: int):
    names = ["d", "th", "place", "span", *(f"h{k}" for k in range(levels))]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sizes = WordHashes(), lengths(window, levels)
        for batch in batches:
            for low, _, texts in _taken(batch.column(2)):
                of, place, least, most, *found = texts.anchors(hashes, sizes)
                if len(of):
                    row = pa.array(of + low)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(row), batch.column(1).take(row), pa.array(place << 12 | least << 6 | most),
                         *(pa.array(h.view(np.int64)) for h in found)], names=names,
                    )

    return run, "d long, th long, place long, span long" + "".join(f", h{k} long" for k in range(levels))


def _lists(column: pa.Array, low: int, high: int) -> tuple[np.ndarray, pa.StructArray]:
    """Which of the rows low..high - 1 each element of their lists belongs to (from 0), and the elements."""
    rows = column.slice(low, high - low)
    return np.repeat(np.arange(high - low), pc.fill_null(pc.list_value_length(rows), 0).to_numpy()), rows.flatten()


def _listed(window: int, levels: int):
    """The windows of the anchors asked for: (h0, span, n, o: offset, w: hash)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sizes = WordHashes(), lengths(window, levels)
        for batch in batches:
            for low, high, texts in _taken(batch.column(0)):
                of, asked = _lists(batch.column(1), low, high)
                place, h0, span, n = (asked.field(c).to_numpy() for c in ("place", "h0", "span", "n"))
                least, most = place >> 6 & 63, place & 63
                many = most - least + 1
                row = np.repeat(np.arange(len(place)), many)
                offset = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + least[row]
                full = texts.windows(hashes, sizes)[-1][texts.low[of[row]] + (place[row] >> 12) - offset]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h0[row]), pa.array(span[row]), pa.array(n[row]), pa.array(offset.astype(np.int32)), pa.array(full.view(np.int64))],
                    names=["h0", "span", "n", "o", "w"],
                )

    return run, "h0 long, span long, n long, o int, w long"


def _cut(texts: _Texts, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and next word of each run of words that the windows cover (within one text), and the bytes and offsets of the rest."""
    n = len(texts.starts)
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    gone = np.cumsum(edge)[:-1] > 0
    new = np.concatenate(([True], texts.of[1:] != texts.of[:-1])) if n else np.empty(0, bool)
    begin = np.flatnonzero(gone & (new | np.concatenate(([True], ~gone[:-1])))) if n else np.empty(0, np.int64)
    after = np.flatnonzero(gone & np.concatenate((new[1:] | ~gone[1:], [True]))) + 1 if n else np.empty(0, np.int64)
    keep = texts.is_word.astype(np.int8)
    sign = np.zeros(len(keep) + 1, np.int8)  # +1 from the first byte of a run that goes to the end of its last word
    sign[texts.starts[begin]] += 1
    np.subtract.at(sign, texts.ends[after - 1], 1)
    keep = (keep > 0) & (np.cumsum(sign, dtype=np.int8)[:-1] == 0)
    out = texts.data.copy()
    stays = np.flatnonzero(~gone)
    followed = stays[:-1][texts.of[stays[:-1]] == texts.of[stays[1:]]]  # the byte after such a word is of its text
    out[texts.ends[followed]], keep[texts.ends[followed]] = 0x20, True
    total = np.concatenate(([0], np.cumsum(keep)))
    return begin, after, out[keep], total[texts.at]


def _rest(window: int, reach: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.arange(reach)
        for batch in batches:
            for low, high, texts in _taken(batch.column(1)):
                of, found = _lists(batch.column(2), low, high)
                row, offset = np.nonzero(found.field("mask").to_numpy()[:, None] >> bits & 1)
                place = found.field("place").to_numpy() >> 12
                begin, after, kept, ends = _cut(texts, texts.low[of[row]] + place[row] - offset, window)
                text = texts.of[begin]
                spans = pa.StructArray.from_arrays([pa.array(begin - texts.low[text]), pa.array(after - texts.low[text])], names=["start", "end"])
                many = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=high - low))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(np.diff(texts.low)), pa.ListArray.from_arrays(pa.array(many.astype(np.int32)), spans),
                     pa.StringArray.from_buffers(high - low, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(kept))],
                    names=["doc_id", "n_words", "spans", "kept"],
                )

    return run, "doc_id long, n_words long, spans array<struct<start: long, end: long>>, kept string"


def _bucket(*by: str) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(BUCKETS)).cast("int")


def _bits(bucket: Column) -> Column:
    """All buckets of a group as the bits of one long."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bucket)).alias("bits")


def _each(bits: str) -> Column:
    return F.explode(F.filter(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.getbit(F.col(bits), b) == 1))


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    """The rows (with their ``bucket``) whose key is that of several rows."""
    several = rows.groupBy(key).agg(F.count("*").alias("n"), _bits(F.col("bucket"))).where("n > 1")
    return rows.join(several.select(key, _each("bits").alias("bucket")), [key, "bucket"], "left_semi")


def repeated_windows(docs: DataFrame, window: int = WINDOW, levels: int = LEVELS) -> DataFrame | None:
    """(d, th, place, mask) of ``docs`` (d, th, text): the window o words before the anchor repeats where mask has bit o; None if no window can."""
    run, schema = _anchors(window, levels)
    rows = docs.mapInArrow(run, schema).withColumn("bucket", _bucket("d", "th", "place"))
    for level in range(levels):
        rows = staged(_repeated(rows, f"h{level}"), f"repeats-level{level}")
        if rows.isEmpty():
            return None
    sub = _bucket("span")
    occurrence = F.struct("d", "th", "place")
    classes = staged(
        rows.groupBy("h0", "span").agg(F.count("*").alias("n"), F.min(occurrence).alias("one"), _bits(F.col("bucket"))),
        "repeats-classes",
    )
    beside = (
        classes.groupBy("h0").agg(F.min("n").alias("least"), F.count("*").alias("many"), _bits(sub))
        .where("least = 1 and many > 1").select("h0", _each("bits").alias("sub"))
    )
    asked = (
        classes.withColumn("sub", sub).join(beside, ["h0", "sub"], "left_semi")
        .groupBy("one.d", "one.th").agg(F.collect_list(F.struct("one.place", "h0", "span", "n")).alias("asked"))
    )
    run, schema = _listed(window, levels)
    listed = staged(docs.join(asked, ["d", "th"]).select("text", "asked").mapInArrow(run, schema), "repeats-windows").withColumn("sub", sub)
    several = listed.groupBy("h0", "o", "w").agg(F.sum("n").alias("n"), _bits(F.col("sub"))).where("n > 1")
    some = (
        listed.where("n = 1").join(several.select("h0", "o", "w", _each("bits").alias("sub")), ["h0", "o", "w", "sub"], "left_semi")
        .groupBy("h0", "span").agg(F.bit_or(F.expr("shiftleft(1L, o)")).alias("mask"))
    )
    every = F.expr("shiftleft(1L, cast(one.place & 63 as int) + 1) - shiftleft(1L, cast(shiftright(one.place, 6) & 63 as int))")
    decided = classes.where("n > 1").select("h0", "span", every.alias("mask"), "bits").unionByName(
        classes.where("n = 1").select("h0", "span", "bits").join(some, ["h0", "span"]).select("h0", "span", "mask", "bits")
    )
    return rows.join(decided.select("h0", "span", "mask", _each("bits").alias("bucket")), ["h0", "span", "bucket"]).select("d", "th", "place", "mask")


def remove_repeats(docs: DataFrame, window: int = WINDOW, levels: int = LEVELS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, spans (first and next word of what is removed), kept (the other words, one space between).

    A word is removed if a window of ``window`` words covers it that also starts elsewhere, in the same
    document (overlapping itself included) or another; all windows are judged on the input.  Null, empty
    and blank texts have no words; texts of fewer words than a window lose none.  Rows that repeat are
    copies of one another: of ``window`` words or more, nothing of them is kept.  Null ids are allowed.
    Other columns of ``docs`` are ignored; an empty table gives no rows.
    """
    id_ = F.col(id_col).cast("long")
    own = docs.select(
        id_.alias("doc_id"), F.col(text_col).alias("text"),
        F.coalesce(id_, F.lit(0)).alias("d"), F.xxhash64(id_, F.col(text_col)).alias("th"),
    )
    found = repeated_windows(own.select("d", "th", "text"), window, levels)
    run, schema = _rest(window, window - lengths(window, levels)[-2] + 1)
    none = F.lit(None).cast("array<struct<place: long, mask: long>>")
    if found is None:
        return own.select("doc_id", "text", none.alias("found")).mapInArrow(run, schema)
    # a set, so that rows that repeat send each of their anchors once
    places = found.groupBy("d", "th").agg(F.collect_set(F.struct("place", "mask")).alias("found"))
    return own.join(places, ["d", "th"], "left").select("doc_id", "text", "found").mapInArrow(run, schema)


def digests(removed: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of the rows of ``remove_repeats``."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return removed.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
