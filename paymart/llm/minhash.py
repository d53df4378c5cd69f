"""Near-duplicate documents by b-bit MinHash (operator 1).

A document's set holds the 64-bit hashes of its distinct 5-word shingles
(words: runs without space or tab..CR, A-Z lowered; a shorter text is one
shingle of all its words).  384 minima per set give

* 64 band keys of 6 minima each: two sets of similarity 0.75 share no band
  with probability (1 - 0.75**6) ** 64 < 4e-6;
* a signature of the 4 low bits of each minimum, packed two to a byte.  The
  share of equal nibbles, counted as bits and corrected for chance equality
  (1/16), estimates the similarity with a standard deviation below 0.024.
  Candidates under 0.75 - 0.10 by estimate (over 4 deviations) are not
  verified.

Links are found in three rounds, so that no bucket emits all its pairs:

1. every member of a bucket is compared with the bucket's smallest member; of
   the candidates of one set the most similar one is verified on full sets.
   The components of these links cover nearly all copies;
2. in buckets that still hold several components, only pairs from different
   components can add anything.  They are estimated in blocks of at most
   2 x BLOCK members (a larger bucket is cut into blocks, and every pair of
   blocks is one group).  The most similar partner of each set is verified;
3. what then still lies in a bucket with another component meets every partner,
   each pair once, on a signature of 1,408 minima (1,024 more, made for members
   of shared buckets only; deviation below 0.0121), and is verified if the
   estimate is over 0.75 - 0.055.

Equal sets are one node from the start; nodes are 64-bit hashes of whole sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import WordHashes, free_name, groups, mix64, shuffle_partitions, staged, texts_of, tidy, word_bounds
from paymart.llm.components import connected_components

WORDS = 5
BANDS, ROWS = 64, 6
MINIMA = BANDS * ROWS
BITS = 4
SHARE_PERCENT = 75
MARGIN = 0.10
WIDE, WIDE_MARGIN = 1024, 0.055
BLOCK = 1024

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_rng = np.random.default_rng(20240607)
_MULTIPLY = _rng.integers(1 << 31, size=MINIMA + WIDE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(1 << 32, size=MINIMA + WIDE, dtype=np.uint32)
_PLACE = _rng.integers(1 << 63, size=max(WORDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = mix64(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Shingles:
    """The set of a text: its sorted distinct shingle hashes (uint64)."""

    def __init__(self) -> None:
        self.words = WordHashes()

    def __call__(self, text: np.ndarray | None) -> np.ndarray:
        if text is None or not len(text):
            return np.empty(0, np.uint64)
        starts, ends = word_bounds(text)
        n = len(starts)
        if n == 0:
            return np.empty(0, np.uint64)
        words = self.words(_LOWER[text], starts, ends)
        if n < WORDS:
            return mix64(np.atleast_1d((words * _PLACE[:n]).sum(dtype=np.uint64)) + np.uint64(n))
        total = words[: n - WORDS + 1] * _PLACE[0]
        for k in range(1, WORDS):
            total = total + words[k : n - WORDS + 1 + k] * _PLACE[k]
        return np.unique(mix64(total))


def minima(hashes: np.ndarray, family: slice = slice(0, MINIMA)) -> np.ndarray:
    """The smallest value of the set under each function of the family."""
    x = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    multiply, add = _MULTIPLY[family], _ADD[family]
    low = np.full(len(add), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 256):
        y = np.multiply.outer(x[at : at + 256], multiply)
        y += add
        np.minimum(low, y.min(axis=0), out=low)
    return low


def pack(low: np.ndarray) -> bytes:
    """The 4 low bits of each minimum, two to a byte."""
    bits = (low & 15).astype(np.uint8)
    return (bits[0::2] | bits[1::2] << 4).tobytes()


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(BANDS, ROWS).astype(np.uint64) * _PLACE[:ROWS]
    return mix64(rows.sum(axis=1, dtype=np.uint64) ^ _BAND).view(np.int64)


def node_of(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures (last axis: uint64 words), corrected for chance equality of the low bits."""
    equal = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]), np.int32)
    ones = np.uint64(0x1111111111111111)
    for w in range(a.shape[-1]):
        x = a[..., w] ^ b[..., w]
        x = x | x >> np.uint64(1)
        x = (x | x >> np.uint64(2)) & ones
        equal += 16 - np.bitwise_count(x).astype(np.int32)
    chance = 1 / (1 << BITS)
    return (equal / (16 * a.shape[-1]) - chance) / (1 - chance)


@tidy
def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingles = Shingles()
    for batch in batches:
        sizes, nodes, sigs, keys, at = [], [], [], [], [0]
        for text in texts_of(batch.column(2)):
            found = shingles(text)
            sizes.append(len(found))
            if len(found):
                low = minima(found)
                nodes.append(node_of(found))
                sigs.append(pack(low))
                keys.append(band_keys(low))
            else:
                nodes.append(None)
                sigs.append(None)
            at.append(at[-1] + (BANDS if len(found) else 0))
        flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sigs, pa.binary()),
             pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))],
            names=["doc_id", "text_hash", "n_shingles", "node", "sig", "keys"],
        )


@tidy
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node wanted, text) to (node, sorted hashes, wide signature), where the text has that node."""
    shingles = Shingles()
    for batch in batches:
        nodes, sets, wide = [], [], []
        for wanted, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
            found = shingles(text)
            if len(found) and node_of(found) == wanted:
                nodes.append(wanted)
                sets.append(found.tobytes())
                wide.append(pack(minima(found, slice(MINIMA, None))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array(sets, pa.binary()), pa.array(wide, pa.binary())], names=["node", "hashes", "wide"]
        )


@tidy
def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for k in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(estimate(a, b))], names=["node", "center", "share"])


@tidy
def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps pairs with 100 * intersection >= 75 * union on full sets."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            a, b = (a, b) if len(a) <= len(b) else (b, a)
            both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            keep.append(100 * both >= SHARE_PERCENT * (len(a) + len(b) - both))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


class _Block:
    """A bucket, or two blocks of one: rows (key, i, j, block, node, label, sig)."""

    def __init__(self, group: pa.Table) -> None:
        self.node, self.label, block = (group.column(k).to_numpy() for k in ("node", "label", "block"))
        self.sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint64).reshape(len(self.node), -1)
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        _, self.where = np.unique(self.label, return_inverse=True)
        common = np.bincount(self.where).argmax()  # members of the commonest label are met by all others
        sides = ((left, right),) if i == j else ((left, right), (right, left))
        self.sides = [(one[self.where[one] != common], two) for one, two in sides]

    def shares(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, columns, estimated similarity, -1 within a label), some rows at a time."""
        for one, two in self.sides:
            for at in range(0, len(one), 256):
                part = one[at : at + 256]
                share = estimate(self.sig[part][:, None, :], self.sig[two][None, :, :])
                share[self.where[part][:, None] == self.where[two][None, :]] = -1
                yield part, two, share


@tidy
def _best_across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each member off the commonest label, its most similar member of another label, if over the margin."""
    for group in groups(batches, ("key", "i", "j")):
        block = _Block(group)
        for part, two, share in block.shares():
            if len(two):
                best = share.argmax(axis=1)
                top = share[np.arange(len(part)), best]
                ok = top >= SHARE_PERCENT / 100 - MARGIN
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.node[part[ok]]), pa.array(block.node[two[best[ok]]]), pa.array(top[ok])], names=["node", "center", "share"]
                )


@tidy
def _all_across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every pair of members of different labels over the margin, in the first band that the two share."""
    for group in groups(batches, ("key", "i", "j")):
        block = _Block(group)
        keys = np.array(group.column("keys").combine_chunks().flatten()).reshape(-1, BANDS)
        band = int((keys[0] == group.column("key")[0].as_py()).argmax())
        for part, two, share in block.shares():
            x, y = np.nonzero(share >= SHARE_PERCENT / 100 - WIDE_MARGIN)
            x, y = part[x], two[y]
            first = np.zeros(len(x), bool)
            for at in range(0, len(x), 8192):
                first[at : at + 8192] = (keys[x[at : at + 8192]] == keys[y[at : at + 8192]]).argmax(axis=1) == band
            a, b = block.node[x[first]], block.node[y[first]]
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["node", "center"])


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a, b = (sets.select(F.col("node").alias(n), F.col("hashes").alias(h)) for n, h in (("na", "ha"), ("nb", "hb")))
    return (
        pairs.join(a, pairs["node"] == a["na"]).join(b, pairs["center"] == b["nb"])
        .select("node", "center", "ha", "hb")
        .mapInArrow(_verified, "node long, center long")
    )


def _mixed(members: DataFrame, label: DataFrame, sigs: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, in sorted groups (key, i, j) of two blocks at most."""
    named = members.select("key", "node").join(label, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    several = (
        named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
        .where("low <> high").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    return (
        named.join(several, "key").join(sigs, "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "label", "sig", "keys")
        .repartition(shuffle_partitions(members.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Null, empty and blank texts have an empty set and link with nothing: they are their own component.
    component_id is the smallest id that links reach; null ids are reached but never smallest, so a
    component of null ids only has a null component_id.  kept is ``doc_id <=> component_id``.  Repeated
    rows are returned as often as they come.  Other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    signed = staged(
        text.mapInArrow(_signed, "doc_id long, text_hash long, n_shingles long, node long, sig binary, keys array<long>"), "minhash"
    )
    bands = signed.select(F.explode("keys").alias("key"), "node")
    several = (
        bands.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("last"))
        .where("center <> last").select("key", "center")
    )
    members = staged(bands.join(several, "key").groupBy("key", "node").agg(F.first("center").alias("center")), "members")
    nodes = members.select("node").distinct()
    sigs = staged(signed.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("sig").alias("sig"), F.min("keys").alias("keys")), "sigs")

    one = signed.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    # one text of each set, found by id and text hash: an id that many rows share fetches no other texts
    wanted = (
        signed.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("one"))
        .select("node", F.col("one.doc_id").alias("of"), F.col("one.text_hash").alias("hash"))
    )
    sets = staged(
        text.join(wanted, text["doc_id"].eqNullSafe(wanted["of"]) & (text["text_hash"] == wanted["hash"])).select("node", "text")
        .mapInArrow(_sets, "node long, hashes binary, wide binary")
        .groupBy("node").agg(F.min("hashes").alias("hashes"), F.min("wide").alias("wide")),
        "sets",
    )

    near = members.where("node <> center").select("node", "center").distinct()
    a, b = (sigs.select(F.col("node").alias(n), F.col("sig").alias(s)) for n, s in (("na", "sa"), ("nb", "sb")))
    best = (
        near.join(a, near["node"] == a["na"]).join(b, near["center"] == b["nb"]).select("node", "center", "sa", "sb")
        .mapInArrow(_estimated, "node long, center long, share double").where(F.col("share") >= SHARE_PERCENT / 100 - MARGIN)
        .groupBy("node").agg(F.max_by("center", F.struct("share", "center")).alias("center"))
    )
    links = staged(_verify(best, sets), "links1")
    label = connected_components(links, "node", "center")

    mixed = _mixed(members, label, sigs).drop("keys")
    most = (
        mixed.mapInArrow(_best_across, "node long, center long, share double")
        .groupBy("node").agg(F.max_by("center", F.struct("share", "center")).alias("center"))
    )
    links = staged(links.union(_verify(most, sets)), "links2")
    label = connected_components(links, "node", "center")

    whole = sigs.join(sets, "node").select("node", F.concat("sig", "wide").alias("sig"), "keys")
    more = staged(_mixed(members, label, whole).mapInArrow(_all_across, "node long, center long").distinct(), "pairs3")
    links = links.union(staged(_verify(more, sets), "links3"))
    label = connected_components(links, "node", "center")

    classes = one.where("node is not null").join(label, "node", "left").select("node", "first_id", F.coalesce("label", "node").alias("label"))
    smallest = classes.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of = classes.join(smallest, "label").select("node", "component_id")
    return signed.select("doc_id", "n_shingles", "node").join(of, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("doc_id").eqNullSafe(F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, any others) that stay: of each group of near copies the one of smallest doc_id.

    Rows are judged one by one, whatever their ids: unrelated texts that share a doc_id all stay.  Blank
    texts are in no group and all stay.  Of rows that repeat the smallest doc_id within a group, the one
    of smallest text hash stays.  Rows without an id come after all others of their group.
    """
    # numbers are written before use, so that a row has the same one in every later stage
    line, digest = (free_name(docs.columns, c) for c in ("line", "text_hash"))
    own = staged(docs.withColumn(line, F.monotonically_increasing_id()).withColumn(digest, F.xxhash64("text")), "numbered")
    found = near_duplicates(own.select(F.col(line).alias("line"), "text"), id_col="line").select(F.col("doc_id").alias("of"), F.col("component_id").alias("group"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").cast("long").alias("id"), F.col(digest).alias("digest"), F.col(line).alias("line"))
    first = (
        own.select(F.col(line).alias("line"), order.alias("order")).join(found, F.col("line") == F.col("of"))
        .groupBy("group").agg(F.min("order").alias("first")).select(F.col("first.line").alias("stays"))
    )
    return own.join(first, own[line] == first["stays"], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
