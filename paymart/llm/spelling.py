"""Spelling variants by dense prefix-suffix tiling (operator 12).

Two words differ by exactly one inserted, deleted or replaced code point when
they are distinct, their lengths differ by at most one, and common prefix plus
common suffix reach the longer length minus one.  One of the two then covers
half of the shorter word.  So words of length l and l + 1 meet in groups of
equal first or equal last l // 2 code points; each word is in four groups.

A group is cut into blocks, and two blocks are a tile: two padded matrices of
code points, compared column by column for all pairs of their words at once,
from the front for prefixes and from the back for suffixes.  A tile holds at
most ``TILE`` words a side and ``CELLS`` code points, whatever the words'
lengths; it emits only pairs that are near.  A pair found by its prefix is not
reported again by its suffix.

A word has at most a few hundred near words (alphabet times places), so counts
by word are small sums; the largest near word is a maximum, combined before the
shuffle.  Forms lead to ever larger counts, by a factor of 5, so the chain to
the root is short and is followed by doubling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import groups, shuffle_partitions, staged, tidy

LETTERS = r"[a-zÀ-ÿ]+"
DROP_EVERY = 199
MIN_POINTS = 6
MIN_COUNT = 5
TIMES = 5
TILE = 512
CELLS = 1 << 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def corpus_words(docs: DataFrame, drop_every: int = DROP_EVERY, min_points: int = MIN_POINTS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the runs of letters of ``docs`` (doc_id, text): at least ``min_points`` long, ``min_count`` times.

    A-Z are lowered, nothing else.  Where ``drop_every`` divides the crc32 of ``<doc_id>:<run>`` the run loses
    its code point at crc32 % length (a made spelling fault); rows without an id lose none.  Null texts
    have no words; repeated rows count as often as they come.
    """
    text = F.translate(F.col("text"), _UPPER, _UPPER.lower())
    runs = docs.select(F.col("doc_id").cast("string").alias("id"), F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"))
    size = F.char_length("run")
    at = F.pmod(F.col("h"), size).cast("int")
    lossy = F.coalesce(F.pmod(F.col("h"), F.lit(drop_every)) == 0, F.lit(False))
    left = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, size))
    words = (
        runs.where(size >= min_points)  # a run never grows
        .withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        .select(F.when(lossy, left).otherwise(F.col("run")).alias("word"))
    )
    return words.where(F.char_length("word") >= min_points).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _tiles(words: DataFrame, tile: int, cells: int) -> DataFrame:
    """(grp, i, j, side, block, len, word, n), sorted by tile: the words of two blocks of a group.

    ``side`` 0: groups by first, 1: by last code points; ``short``: the smaller of the group's two lengths.
    """
    size = F.char_length("word")
    half = F.floor(F.col("short") / 2).cast("int")
    key = F.when(F.col("side") == 0, F.substring(F.col("word"), F.lit(1), half)).otherwise(F.substring(F.col("word"), F.col("len") - half + 1, half))
    members = (
        words.withColumn("len", size)
        .withColumn("short", F.explode(F.array(F.col("len") - 1, F.col("len"))))
        .withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("grp", F.xxhash64("side", "short", key))  # words that meet by a collision are compared for nothing
    )
    # of two words of the longer length only, nothing is near here: they meet where they are the shorter ones
    several = (
        members.groupBy("grp").agg(
            F.count("*").alias("m"), F.count(F.when(F.col("len") == F.col("short"), 1)).alias("shorts"), F.max("len").alias("longest"))
        .where("m > 1 and shorts > 0")
        .select("grp", F.ceil(F.col("m") / F.greatest(F.lit(1), F.least(F.lit(tile), F.floor(F.lit(cells) / F.col("longest"))))).cast("int").alias("blocks"))
    )
    return (
        members.join(several, "grp")
        .withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("grp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "side", "short", "len", "word", "n")
        .repartition(shuffle_partitions(words.sparkSession), "grp", "i", "j").sortWithinPartitions("grp", "i", "j")
    )


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, padded to the right, and their lengths."""
    size = np.array([len(w) for w in words])
    out = np.zeros((len(words), size.max()), np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return out, size


def _turned(points: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The padded words read from the back."""
    at = size[:, None] - 1 - np.arange(points.shape[1])
    return np.where(at >= 0, np.take_along_axis(points, np.maximum(at, 0), axis=1), 0)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of every row of ``a`` and every row of ``b``; padding (0) matches nothing."""
    out = np.zeros((len(a), len(b)), np.int32)
    alive = np.ones(out.shape, bool)
    for k in range(min(a.shape[1], b.shape[1])):
        alive &= (a[:, k, None] == b[None, :, k]) & (a[:, k, None] != 0)
        if not alive.any():
            break
        out += alive
    return out


def near_pairs(words_a: list[str], words_b: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows (a, b) of near words of two lists, their common prefix and suffix lengths."""
    (a, la), (b, lb) = _points(words_a), _points(words_b)
    prefix, suffix = _common(a, b), _common(_turned(a, la), _turned(b, lb))
    longer, gap = np.maximum(la[:, None], lb[None, :]), np.abs(la[:, None] - lb[None, :])
    same = (gap == 0) & (prefix == longer)
    x, y = np.nonzero((gap <= 1) & ~same & (prefix + suffix >= longer - 1))
    return x, y, prefix[x, y], suffix[x, y]


@tidy
def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of each tile, both ways round: (word, near, near_n)."""
    for group in groups(batches, ("grp", "i", "j")):
        block, side, short, size, n = (group.column(c).to_numpy() for c in ("block", "side", "short", "len", "n"))
        word = np.array(group.column("word").to_pylist(), object)
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        # several groups may share a hash: each is compared for itself
        for s, l in {*zip(side.tolist(), short.tolist(), strict=True)}:
            of = (side == s) & (short == l)
            left, right = np.flatnonzero(of & (block == i)), np.flatnonzero(of & (block == j))
            if not len(left) or not len(right):
                continue
            x, y, prefix, suffix = near_pairs(word[left].tolist(), word[right].tolist())
            x, y, half = left[x], right[y], l // 2
            # two words of the longer length meet elsewhere; a pair of equal beginnings is the prefix group's;
            # within one block a pair is met from either side
            keep = ((size[x] == l) | (size[y] == l)) & ((prefix >= half) if s == 0 else (prefix < half) & (suffix >= half))
            if i == j:
                keep &= x < y
            x, y = x[keep], y[keep]
            one, two = np.concatenate((x, y)), np.concatenate((y, x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(word[one], pa.string()), pa.array(word[two], pa.string()), pa.array(n[two], pa.int64())], names=["word", "near", "near_n"]
            )


def near_words(words: DataFrame, tile: int = TILE, cells: int = CELLS) -> DataFrame:
    """(word, near, near_n) of all pairs of near words of ``words`` (word, n; distinct words), both ways round."""
    rows = _tiles(words.select("word", "n").where("word is not null"), tile, cells)
    return rows.mapInArrow(_compared, "word string, near string, near_n long")


def variants(words: DataFrame, times: int = TIMES, tile: int = TILE, cells: int = CELLS) -> DataFrame:
    """One row per row of ``words`` (word, n; distinct words): word, form, root, n, n_near, form_n.

    ``form``: the near word of largest n (ties: the smallest in code-point order) if its n is at least
    ``times`` that of the word, else null.  ``root``: the last word that forms lead to from the word,
    the word itself without a form.  A null word is left out; an empty table gives no rows; a word of any
    length is taken; other columns are ignored.
    """
    words = staged(words.select("word", "n"), "spelling-words")
    # of words with equal n the smallest: MIN_BY over (-n, word)
    first = F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))
    best = near_words(words, tile, cells).groupBy("word").agg(F.count("*").alias("n_near"), F.min(first).alias("top"))
    found = staged(
        words.where("word is not null").join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(-F.col("top.m") >= times * F.col("n"), F.col("top.near")).alias("form"),
            F.when(-F.col("top.m") >= times * F.col("n"), -F.col("top.m")).alias("form_n"),
        ),
        "spelling-forms",
    )
    forms = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # a chain of k forms is done after log2 k rounds; counts grow five times a step, so k < 28
        step = forms.select(F.col("word").alias("via"), F.col("root").alias("next"))
        forms = staged(
            forms.join(step, forms["root"] == step["via"], "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        if not forms.where("moved").limit(1).count():
            break
        forms = forms.select("word", "root")
    roots = forms.select("word", "root")
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
