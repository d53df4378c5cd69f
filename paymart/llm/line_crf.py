"""Quality rules by line labelling (operator 2).

Every line with a word is an observation of 16 yes/no features (symbols,
shouting, repeats, length, punctuation ...).  A linear-chain conditional random
field with two states, boilerplate (0) and content (1), is decoded by Viterbi;
a document is kept if at least half of its words lie in content lines and the
base rules did not reject it.

The field is trained here, on a bounded sample of labelled documents (the
``TRAIN_DOCS`` of each class with the smallest hash of their id, and of these
a run of ``TRAIN_LINES`` lines from anywhere in the text); a line inherits its document's label.  As that
alone would never show a change of label, as many sequences are added in which
a good document has the lines of a bad one inside.  Scoring covers every line of
every document.  Without labels of both classes the
weights are zero and every line is content.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import WordHashes, mix64, texts_of, tidy, word_bounds

TRAIN_DOCS = 1000
TRAIN_LINES = 64
CONTENT_SHARE = 0.5
N_FEATURES = 16
WINDOW = 5

_CLASS = np.zeros((5, 256), np.int64)  # symbol, upper, lower, digit, starts a code point
_CLASS[0, list(b"#*$%&|<>")] = 1
_CLASS[1, ord("A") : ord("Z") + 1] = 1
_CLASS[2, ord("a") : ord("z") + 1] = 1
_CLASS[3, ord("0") : ord("9") + 1] = 1
_CLASS[4] = 1
_CLASS[4, 0x80:0xC0] = 0
_END = np.zeros(256, bool)
_END[list(b".!?\"')")] = True
_PLACE = np.random.default_rng(7).integers(1 << 63, size=WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Lines:
    """Base counts of a text, and the features and word counts of its lines with a word."""

    def __init__(self) -> None:
        self.hashes = WordHashes()

    def __call__(self, text: np.ndarray | None) -> tuple[list[int], np.ndarray, np.ndarray]:
        nothing = np.zeros((0, N_FEATURES), bool), np.zeros(0, np.int64)
        if text is None or not len(text):
            return [0] * len(BASE), *nothing
        starts, ends = word_bounds(text)
        n = len(starts)
        n_symbols = int(_CLASS[0][text].sum())
        if n == 0:
            return [0, 0, n_symbols, 0, 0], *nothing
        sums = np.zeros((5, len(text) + 1), np.int64)
        np.cumsum(_CLASS[:, text], axis=1, out=sums[:, 1:])
        symbol, upper, lower, digit, chars = sums[:, ends] - sums[:, starts]
        hashes = self.hashes(text, starts, ends)

        covered = np.zeros(n + 1, np.int64)
        if n >= WINDOW:
            window = hashes[: n - WINDOW + 1] * _PLACE[0]
            for k in range(1, WINDOW):
                window = window + hashes[k : n - WINDOW + 1 + k] * _PLACE[k]
            _, where, counts = np.unique(mix64(window), return_inverse=True, return_counts=True)
            at = np.flatnonzero(counts[where] > 1)
            np.add.at(covered, at, 1)
            np.add.at(covered, at + WINDOW, -1)

        breaks = np.flatnonzero(text == 0x0A)
        line, first, of = np.unique(np.searchsorted(breaks, starts), return_index=True, return_inverse=True)
        whole = text.tobytes().split(b"\n")
        seen: set[bytes] = set()
        again = np.zeros(len(line), bool)
        for i, k in enumerate(line.tolist()):
            again[i] = whole[k] in seen
            seen.add(whole[k])

        words = np.bincount(of)
        share = lambda x: np.bincount(of, weights=x) / words
        same = np.zeros(n, bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
        sym, shout = share(symbol > 0), share((upper > 1) & (lower == 0))
        last = np.append(first[1:], n) - 1
        features = np.stack(
            [
                np.ones(len(line), bool), sym > 0.5, (sym > 0.05) & (sym <= 0.5), shout > 0.5, (shout > 0.05) & (shout <= 0.5),
                share(text[ends - 1] == ord("!")) > 0.3, share(same) > 0.3, again, words < 3, (words >= 3) & (words < 6),
                words > 60, _END[text[ends[last] - 1]], share(lower) == 0, share(digit > 0) > 0.3, share(chars) > 12,
                share(text[starts] == ord("|")) > 0.2,
            ],
            axis=1,
        )
        counts = [n, int(chars.sum()), n_symbols, int(again.sum()), int((np.cumsum(covered)[:n] > 0).sum())]
        return counts, features, words


class Crf:
    """Two states; weights: emission (features x 2), transition (2 x 2), start (2)."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray, start: np.ndarray) -> None:
        self.emission, self.transition, self.start = emission, transition, start

    @classmethod
    def blank(cls) -> Crf:
        return cls(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))

    @classmethod
    def fit(cls, sequences: list[np.ndarray], labels: list[np.ndarray], weight: np.ndarray, rounds: int = 80, rate: float = 0.15, ridge: float = 1e-3) -> Crf:
        """Maximum likelihood by gradient steps; expected counts by forward and backward sums over all sequences at once."""
        length = np.array([len(s) for s in sequences])
        top = int(length.max())
        x = np.zeros((len(sequences), top, N_FEATURES))
        for i, s in enumerate(sequences):
            x[i, : len(s)] = s
        there = np.arange(top)[None, :] < length[:, None]
        y = np.zeros((len(sequences), top), np.int64)
        for i, own in enumerate(labels):
            y[i, : len(own)] = own
        gold = np.stack([(y == k) & there for k in (0, 1)], axis=2).astype(float)
        flat = np.zeros(N_FEATURES * 2 + 4 + 2)
        slope, square = np.zeros_like(flat), np.zeros_like(flat)
        shape = lambda v: cls(v[: N_FEATURES * 2].reshape(-1, 2), v[N_FEATURES * 2 : -2].reshape(2, 2), v[-2:])
        pair_gold = np.einsum("n,nti,ntj->ij", weight, gold[:, :-1], gold[:, 1:])
        emit_gold = np.einsum("n,ntf,ntk->fk", weight, x, gold)
        start_gold = weight @ gold[:, 0]
        for step in range(1, rounds + 1):
            m = shape(flat)
            e = x @ m.emission
            a, b = np.zeros_like(e), np.zeros_like(e)
            a[:, 0] = m.start + e[:, 0]
            for t in range(1, top):
                to = np.logaddexp(a[:, t - 1, 0, None] + m.transition[0], a[:, t - 1, 1, None] + m.transition[1]) + e[:, t]
                a[:, t] = np.where(there[:, t, None], to, a[:, t - 1])
            for t in range(top - 2, -1, -1):
                after = e[:, t + 1] + b[:, t + 1]
                to = np.logaddexp(m.transition[:, 0] + after[:, 0, None], m.transition[:, 1] + after[:, 1, None])
                b[:, t] = np.where(there[:, t + 1, None], to, 0)
            z = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
            p = np.exp(a + b - z[:, None, None]) * there[:, :, None]
            joint = a[:, :-1, :, None] + m.transition + (e + b)[:, 1:, None, :] - z[:, None, None, None]
            pairs = np.where(there[:, 1:, None, None], np.exp(np.minimum(joint, 0)), 0)
            grad = np.concatenate(
                [
                    (emit_gold - np.einsum("n,ntf,ntk->fk", weight, x, p)).ravel(),
                    (pair_gold - np.einsum("n,ntij->ij", weight, pairs)).ravel(),
                    start_gold - weight @ p[:, 0],
                ]
            ) - ridge * flat
            slope, square = 0.9 * slope + 0.1 * grad, 0.999 * square + 0.001 * grad**2
            flat = flat + rate * (slope / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        return shape(flat)

    def decode(self, features: np.ndarray) -> list[int]:
        """The likeliest label sequence; content wins ties."""
        (t00, t01), (t10, t11) = self.transition.tolist()
        back: list[tuple[int, int]] = []
        s0, s1 = self.start.tolist()
        for k, (e0, e1) in enumerate((features @ self.emission).tolist()):
            if k:
                from0, from1 = int(s1 + t10 >= s0 + t00), int(s1 + t11 >= s0 + t01)
                back.append((from0, from1))
                s0, s1 = (s1 + t10 if from0 else s0 + t00), (s1 + t11 if from1 else s0 + t01)
            s0, s1 = s0 + e0, s1 + e1
        if not len(features):
            return []
        path = [int(s1 >= s0)]
        for step in reversed(back):
            path.append(step[path[-1]])
        return path[::-1]


def _run(features: np.ndarray, hashed: int) -> np.ndarray:
    """TRAIN_LINES lines in a row, or all of a shorter text."""
    n = len(features)
    at = hashed % (n + TRAIN_LINES - 1) - (TRAIN_LINES - 1)
    at = max(0, min(at, n - TRAIN_LINES))
    return features[at : at + TRAIN_LINES]


@tidy
def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label_id, quality, text) to (label_id, quality, features of a run of TRAIN_LINES lines as bits).

    Where the run lies is up to a hash of the id; the head and the foot of a text are reached like its middle.
    """
    lines = Lines()
    bit = 1 << np.arange(N_FEATURES)
    for batch in batches:
        hashed = mix64(batch.column(0).to_numpy().view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)).tolist()
        rows = [(_run(lines(text)[1], h) @ bit).tolist() for h, text in zip(hashed, texts_of(batch.column(2)), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int64()))], names=["label_id", "quality", "bits"])


def train(docs: DataFrame, labels: DataFrame) -> Crf:
    """Fit on at most 2 x TRAIN_DOCS documents; labels: (doc_id, quality 0/1), others ignored.

    A document gives a run of at most TRAIN_LINES lines from anywhere in it.  Of rows that repeat an id,
    one is taken (the smallest by its features), so the sample stays bounded.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality")).where("label_id is not null")
    of = [known.where(F.col("quality") == k).orderBy(F.xxhash64("label_id"), "label_id").limit(TRAIN_DOCS) for k in (0, 1)]
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(of[0].union(of[1])), F.col("doc_id") == F.col("label_id"))
        .select("label_id", "quality", "text").mapInArrow(_observed, "label_id long, quality int, bits array<long>")
        .groupBy("label_id").agg(F.min(F.struct("quality", "bits")).alias("row")).select("row.*").collect()
    )
    unpack = lambda bits: (np.array(bits)[:, None] >> np.arange(N_FEATURES)) & 1
    bad, good = ([unpack(r["bits"]) for r in sorted(rows) if r["bits"] and r["quality"] == k] for k in (0, 1))
    return Crf.fit(*training_set(good, bad)) if good and bad else Crf.blank()


def training_set(good: list[np.ndarray], bad: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Sequences, labels and weights: both classes, and good documents with a bad one inside; each of the three weighs the same."""
    ones, zeros = [np.ones(len(s), int) for s in good], [np.zeros(len(s), int) for s in bad]
    mixed, marks = [], []
    for k in range(max(len(good), len(bad))):
        g, b = good[k % len(good)], bad[k % len(bad)]
        cut = len(g) // 2
        mixed.append(np.concatenate((g[:cut], b, g[cut:])))
        marks.append(np.concatenate((np.ones(cut, int), np.zeros(len(b), int), np.ones(len(g) - cut, int))))
    weight = np.concatenate([np.full(n, 1 / (3 * n)) for n in (len(good), len(bad), len(mixed))])
    return [*good, *bad, *mixed], [*ones, *zeros, *marks], weight


@tidy
def _judged(batches: Iterator[pa.RecordBatch], crf: Crf) -> Iterator[pa.RecordBatch]:
    """Puts the verdict columns in place of the last column, the text."""
    lines = Lines()
    for batch in batches:
        out: list[list] = []
        for text in texts_of(batch.column(batch.num_columns - 1)):
            counts, features, words = lines(text)
            share = float(np.dot(crf.decode(features), words) / counts[0]) if counts[0] else 0.0
            failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
            out.append([*counts, failed, not failed and share >= CONTENT_SHARE, share])
        types = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64()]
        added = [pa.array([r[k] for r in out], t) for k, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names=[*batch.schema.names[:-1], *BASE, "base_failed", "kept", "content_share"])


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share.

    Null, empty and blank texts have no words and fail the base rules.  Null ids and repeated rows are
    judged like any other; other columns of ``docs`` are ignored.
    """
    crf = train(docs, labels)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        functools.partial(_judged, crf=crf),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean, content_share double",
    )


@tidy
def _survivors(batches: Iterator[pa.RecordBatch], crf: Crf, text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        judged = next(_judged(iter([pa.RecordBatch.from_arrays([batch.column(text_at)], names=["text"])]), crf))
        yield batch.filter(judged.column("kept"))


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    crf = train(docs, labels)
    return docs.mapInArrow(functools.partial(_survivors, crf=crf, text_at=docs.columns.index("text")), docs.schema)
