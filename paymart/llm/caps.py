"""Near-duplicate vectors by spherical-cap filters (operator 6).

Filters are caps around the directions of ``CODES`` structured random product
codes: vectors are rotated by a fixed random orthogonal matrix and cut in two
halves; each half has ``WORDS`` random codewords, and every pair of codewords is
a direction (WORDS**2 a code).  A vector belongs to the filters whose direction
it exceeds its cap height with, and that height is set for each vector and code
where ``LIST`` directions reach it.  (One height for all vectors gave lists of 0
to 200 filters, and missed what has short lists.)  The list is decoded without
visiting other directions: a pair of the i-th best codeword of one half and the
j-th best of the other has i * j pairs that score as well, so the LIST best of
each half suffice.

WORDS**2 should grow with the table, so that filters hold few unrelated
vectors: 1024 serves some million vectors, and doubles with each factor of 4.

Two vectors can only be compared inside a filter they share.  A filter's
members are verified by exact cosine in double precision, in blocks (a larger
filter is cut into blocks, and every pair of blocks is one group).  A pair that
shares several filters counts in the first only.  A group reports the number of
links of each member and a spanning forest of its links, never all its pairs.

Equal vectors are one node with a weight from the start.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import groups, shuffle_partitions, staged, tidy
from paymart.llm.components import connected_components

CODES = 4
WORDS = 1024
LIST = 8
COSINE = 0.95
BLOCK = 1024
SEED = 20240607


@functools.lru_cache(32)
def _code(dim: int, words: int, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation, and the codewords of both halves (a direction is a pair of them, of unit length)."""
    random = np.random.default_rng([SEED, dim, words, k])
    rotation = np.linalg.qr(random.standard_normal((dim, dim)))[0]
    halves = []
    for size in (dim - dim // 2, dim // 2):
        code = random.standard_normal((words, size))
        length = np.linalg.norm(code, axis=1, keepdims=True)
        halves.append(code / np.where(length > 0, length, 1) * np.sqrt(size / dim))
    return rotation, halves


def _best(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the n highest scores of each row, falling."""
    at = np.argpartition(-scores, n - 1, axis=1)[:, :n]
    value = np.take_along_axis(scores, at, axis=1)
    order = np.lexsort((at, -value), axis=1)
    return np.take_along_axis(at, order, axis=1), np.take_along_axis(value, order, axis=1)


def filters_of(units: np.ndarray, codes: int = CODES, words: int = WORDS, list_size: int = LIST) -> np.ndarray:
    """For each unit vector the sorted numbers of its filters, ``codes * list_size`` of them."""
    dim = units.shape[1]
    split = dim - dim // 2
    out = []
    for k in range(codes):
        rotation, halves = _code(dim, words, k)
        turned = units @ rotation
        (a, x), (b, y) = (_best(part @ half.T, list_size) for part, half in zip((turned[:, :split], turned[:, split:]), halves, strict=True))
        top, _ = _best((x[:, :, None] + y[:, None, :]).reshape(len(units), -1), list_size)
        i, j = np.divmod(top, list_size)
        out.append((k * words + np.take_along_axis(a, i, axis=1)) * words + np.take_along_axis(b, j, axis=1))
    return np.sort(np.concatenate(out, axis=1), axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@tidy
def _listed(batches: Iterator[pa.RecordBatch], codes: int, words: int, list_size: int) -> Iterator[pa.RecordBatch]:
    """(node, dim, vector) to (node, dim, vector, filters)."""
    for batch in batches:
        dims = batch.column(1).to_numpy()
        for dim in np.unique(dims):
            own = batch.filter(pa.array(dims == dim))
            for at in range(0, own.num_rows, 1024):
                part = own.slice(at, 1024)
                found = filters_of(_unit(_matrix(part.column(2))), codes, words, list_size)
                ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=["node", "dim", "vector", "filters"])


def _shared_before(x: np.ndarray, y: np.ndarray, lists: list[np.ndarray], this: int) -> np.ndarray:
    """For pairs of members, whether they share a filter below ``this`` (lists: each member's filters below it)."""
    names, inverse = np.unique(np.concatenate(lists), return_inverse=True)
    if not len(names):
        return np.zeros(len(x), bool)
    has = np.zeros((len(lists), len(names)), bool)
    has[np.repeat(np.arange(len(lists)), [len(v) for v in lists]), inverse] = True
    out = np.zeros(len(x), bool)
    for at in range(0, len(x), 16_384):
        out[at : at + 16_384] = (has[x[at : at + 16_384]] & has[y[at : at + 16_384]]).any(axis=1)
    return out


@tidy
def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups (filter, dim, i, j) of (block, node, weight, vector, filters) to rows (node, links, other): other is a link of a forest, or null."""
    for group in groups(batches, ("filter", "dim", "i", "j")):
        if group.num_rows < 2:
            continue
        node, weight, block = (group.column(k).to_numpy() for k in ("node", "weight", "block"))
        unit = _unit(_matrix(group.column("vector")))
        this, i, j = (group.column(k)[0].as_py() for k in ("filter", "i", "j"))
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        xs, ys = [], []
        for at in range(0, len(left), 512):
            part = left[at : at + 512]
            x, y = np.nonzero(unit[part] @ unit[right].T >= COSINE)
            x, y = part[x], right[y]
            keep = x < y if i == j else np.ones(len(x), bool)
            xs.append(x[keep])
            ys.append(y[keep])
        if not sum(map(len, xs)):
            continue
        x, y = np.concatenate(xs), np.concatenate(ys)
        every = _matrix(group.column("filters"))
        lists = [v[: np.searchsorted(v, this)] for v in every]
        new = ~_shared_before(x, y, lists, this)
        x, y = x[new], y[new]
        if not len(x):
            continue
        links = np.bincount(x, weights=weight[y], minlength=len(node)) + np.bincount(y, weights=weight[x], minlength=len(node))
        top = np.arange(len(node))
        other: dict[int, int] = {}

        def root(k: int, top: np.ndarray = top) -> int:
            while top[k] != k:
                top[k] = top[top[k]]
                k = top[k]
            return k

        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        firsts = np.flatnonzero(np.diff(x, prepend=-1))
        for k, partners in zip(x[firsts].tolist(), np.split(y, firsts[1:]), strict=True):  # all partners of a member join its tree
            for q in np.unique(top[partners]).tolist():
                a, b = root(k), root(q)
                if a != b:
                    other[b] = k
                    top[b] = a
        some = np.flatnonzero(links > 0)
        partner = [int(node[other[k]]) if k in other else None for k in some.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[some]), pa.array(links[some].astype(np.int64)), pa.array(partner, pa.int64())], names=["node", "links", "other"]
        )


def near_vectors(rows: DataFrame, codes: int = CODES, words: int = WORDS, list_size: int = LIST) -> DataFrame:
    """One row per row of ``rows`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Links are pairs with cosine >= 0.95 (a vector of another length is no partner).  Null, empty and zero
    vectors and those with null or non-finite components link with nothing.  component_id is the smallest
    vec_id that links reach, null ids left aside; kept is ``vec_id <=> component_id``.  Repeated rows
    are linked vectors like any other.  Other columns are ignored.
    """
    spark = rows.sparkSession
    kind = "array<float>" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    wide = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v"))
    good = F.coalesce(
        (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False)
    )
    known = wide.select("vec_id", F.when(good, F.xxhash64("v")).alias("node"), F.when(good, F.col("v")).alias("v"))
    classes = staged(
        known.where("node is not null").groupBy("node").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first_id"), F.min("v").alias("vector")),
        "vectors",
    )
    listed = staged(
        classes.select("node", F.size("vector").alias("dim"), "vector")
        .mapInArrow(functools.partial(_listed, codes=codes, words=words, list_size=list_size), f"node long, dim int, vector {kind}, filters array<int>"),
        "filters",
    )
    members = listed.join(classes.select("node", "weight"), "node").withColumn("filter", F.explode("filters"))
    sizes = (
        listed.select("dim", F.explode("filters").alias("filter")).groupBy("filter", "dim").count()
        .where("count > 1").select("filter", "dim", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    )
    blocks = (
        members.join(sizes, ["filter", "dim"])
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("filter", "dim", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "weight", "vector", "filters")
        .repartition(shuffle_partitions(spark), "filter", "dim", "i", "j").sortWithinPartitions("filter", "dim", "i", "j", "node")
    )
    found = staged(blocks.mapInArrow(_linked, "node long, links long, other long"), "links")
    label = connected_components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.join(label, "node", "left").select("node", "weight", "first_id", F.coalesce("label", "node").alias("label"))
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of = named.join(smallest, "label").join(linked, "node", "left").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"))
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return known.select("vec_id", "node").join(of, "node", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )
