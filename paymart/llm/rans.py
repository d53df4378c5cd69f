"""Static range asymmetric numeral coding of token ids (operator 5).

One frequency table (all ids of the corpus, scaled to 2**20) is shared by all
blocks.  A block holds whole documents, ``BLOCK_TOKENS`` ids or more, as
``LANES`` interleaved states of 64 bits that renormalize by 32-bit words: id i
belongs to lane i mod LANES, and a step codes one id in every lane.  Every
``EVERY`` steps the encoder records a checkpoint (all states and the place in
the word stream).  A decoder starts at any checkpoint; the reader decodes all
segments of a block side by side.

The files are two Parquet folders under one path.  ``table``: (id, freq).
``blocks``, one row a block: shard and block (ascending order), first (ids
before it in the shard), n_tokens, doc_ids and lengths in order, states
(checkpoints x lanes, unsigned 64-bit), places (words before each checkpoint),
words (unsigned 32-bit), crc32 of states and words, ids_crc32 of the ids.
Documents are range-partitioned by id, so ascending (shard, block, place) is
ascending doc_id order.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paymart.llm.common import shuffle_partitions, staged, tidy
from paymart.llm.tokens import encoder, tokenizer_path
from paymart.sources.storage import new_table_path

SCALE = 20
LANES = 1024
EVERY = 256
BLOCK_TOKENS = 1 << 20
TOKENIZER = "word_bpe_49k.json"
END_ID = 2

_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_BITS = np.uint64(SCALE)
_SLOT = np.uint64((1 << SCALE) - 1)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to 2**SCALE, at least 1 for every id that occurs."""
    total = 1 << SCALE
    seen = counts > 0
    if not seen.any():
        return np.zeros(len(counts), np.uint64)
    if seen.sum() > total:
        raise ValueError(f"more than {total} different ids")
    freq = np.where(seen, np.maximum(1, np.floor(counts / counts.sum() * total)), 0).astype(np.int64)
    order = np.argsort(-counts, kind="stable")[: int(seen.sum())]
    left = total - int(freq.sum())
    while left:  # what rounding left over goes to, or comes from, the commonest ids
        share = freq[order] if left < 0 else np.ones(len(order), np.int64)
        able = order[share > 1] if left < 0 else order
        step = able[: abs(left)]
        freq[step] += 1 if left > 0 else -1
        left = total - int(freq.sum())
    return freq.astype(np.uint64)


class Table:
    def __init__(self, freq: np.ndarray) -> None:
        self.freq = freq
        self.cum = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64) if len(freq) else freq
        self.limit = freq << np.uint64(63 - SCALE)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(states: checkpoints x lanes, places, words) of a block."""
        n = len(ids)
        steps = -(-n // LANES)
        state = np.full(LANES, _LOW, np.uint64)
        out: list[np.ndarray] = []
        states, emitted, so_far = [], [], 0
        for t in range(steps - 1, -1, -1):
            s = ids[t * LANES : (t + 1) * LANES]
            x, f = state[: len(s)], self.freq[s]
            over = x >= self.limit[s]
            if over.any():
                out.append(x[over].astype(np.uint32))
                so_far += len(out[-1])
                x = np.where(over, x >> _WORD, x)
            whole, rest = np.divmod(x, f)
            state[: len(s)] = (whole << _BITS) + rest + self.cum[s]
            if t % EVERY == 0:
                states.append(state.copy())
                emitted.append(so_far)
        words = np.concatenate(out[::-1]) if out else np.empty(0, np.uint32)
        places = len(words) - np.array(emitted[::-1], np.int64)
        return np.array(states[::-1], np.uint64).reshape(-1, LANES), places, words

    def decode(self, n: int, states: np.ndarray, places: np.ndarray, words: np.ndarray, first: int = 0) -> np.ndarray:
        """Ids from checkpoint ``first`` to the end of a block of ``n`` ids, all segments side by side."""
        steps = -(-n // LANES)
        x, at = states[first:].copy(), places[first:].copy()
        parts = len(x)
        ids = np.zeros((parts, EVERY, LANES), np.uint32)
        for j in range(min(EVERY, steps)):
            # the last segment may be short: of steps, and its last step of lanes
            live = parts if (first + parts - 1) * EVERY + j < steps else parts - 1
            if live == 0:
                break
            y = x[:live]
            slot = y & _SLOT
            s = self.symbol[slot.astype(np.int64)]
            ids[:live, j] = s
            y = self.freq[s] * (y >> _BITS) + slot - self.cum[s]
            need = y < _LOW
            if (first + live - 1) * EVERY + j == steps - 1 and n % LANES:
                need[-1, n % LANES :] = False
                y[-1, n % LANES :] = x[live - 1, n % LANES :]
            where = at[:live, None] + np.cumsum(need, axis=1)
            if need.any():
                y[need] = (y[need] << _WORD) | words[where[need] - 1].astype(np.uint64)
            at[:live] = where[:, -1]
            x[:live] = y
        return ids.reshape(-1)[: n - first * EVERY * LANES]


@tidy
def _tokens(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokens = encoder(path)
    end = np.array([END_ID], tokens.dtype).tobytes()
    for batch in batches:
        ids = [found.tobytes() + end for found in tokens.encode(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])


def _counted(batches: Iterator[pa.RecordBatch], dtype: str) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        if batch.num_rows:
            got = np.bincount(np.concatenate([np.frombuffer(value.as_buffer(), dtype) for value in batch.column(0)]))
            if len(got) > len(counts):
                counts = np.pad(counts, (0, len(got) - len(counts)))
            counts[: len(got)] += got
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["id", "n"])


_BLOCK = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())), ("states", pa.binary()), ("places", pa.list_(pa.int64())), ("words", pa.binary()), ("crc32", pa.int64()), ("ids_crc32", pa.int64()),
    ]
)
_BLOCK_DDL = (
    "shard int, block int, first long, n_tokens long, doc_ids array<long>, lengths array<long>, states binary,"
    " places array<long>, words binary, crc32 long, ids_crc32 long"
)


@tidy
def _encoded(batches: Iterator[pa.RecordBatch], freq: np.ndarray, dtype: str) -> Iterator[pa.RecordBatch]:
    """Rows (shard, doc_id, ids) of one shard in order to its blocks."""
    table = Table(freq)
    docs: list = []
    parts: list[np.ndarray] = []
    held = first = block = 0

    def close(shard: int) -> pa.RecordBatch:
        ids = np.concatenate(parts)
        states, places, words = table.encode(ids)
        raw, tail = states.astype("<u8").tobytes(), words.astype("<u4").tobytes()
        row = (
            shard, block, first, len(ids), list(docs), [len(p) for p in parts], raw, places.tolist(), tail,
            zlib.crc32(tail, zlib.crc32(raw)), zlib.crc32(ids.astype("<u4").tobytes()),
        )
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK, strict=True)], schema=_BLOCK)

    shard = 0
    for batch in batches:
        for shard_of, doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            shard = shard_of
            docs.append(doc)
            parts.append(np.frombuffer(value.as_buffer(), dtype).copy())
            held += len(parts[-1])
            if held >= BLOCK_TOKENS:
                yield close(shard)
                first, block = first + held, block + 1
                docs, parts, held = [], [], 0
    if parts:
        yield close(shard)


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Encode the documents (doc_id, text) into files under ``path``, in ascending doc_id order (nulls first).

    Null and empty texts are one end id.  Repeated ids follow one another, ordered by a hash of their token ids.
    Other columns are ignored; an empty table gives empty files.
    """
    spark = docs.sparkSession
    vocabulary = tokenizer or tokenizer_path(TOKENIZER)
    tokens = staged(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(functools.partial(_tokens, path=vocabulary), "doc_id long, ids binary"),
        "tokens",
    )
    dtype = encoder(vocabulary).dtype.str
    found = tokens.select("ids").mapInArrow(functools.partial(_counted, dtype=dtype), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in found), default=-1) + 1, np.int64)  # one row an id of the vocabulary
    for r in found:
        counts[r["id"]] = r["n"]
    freq = scaled(counts)
    rows = [(i, int(f)) for i, f in enumerate(freq) if f]
    spark.createDataFrame(rows, "id long, freq long").coalesce(1).write.parquet(f"{path}/table")
    # a repeated id (a null one, say) is cut by a hash of its ids, equal rows by their place
    by = ["doc_id", F.xxhash64("ids"), F.monotonically_increasing_id()]
    ordered = tokens.repartitionByRange(shuffle_partitions(spark), *by).sortWithinPartitions("doc_id", F.xxhash64("ids"))
    blocks = ordered.select(F.spark_partition_id().alias("shard"), "doc_id", "ids").mapInArrow(functools.partial(_encoded, freq=freq, dtype=dtype), _BLOCK_DDL)
    blocks.write.parquet(f"{path}/blocks")


@tidy
def _decoded(batches: Iterator[pa.RecordBatch], freq: np.ndarray, digest: bool) -> Iterator[pa.RecordBatch]:
    table = Table(freq)
    for batch in batches:
        for row in batch.to_pylist():
            if zlib.crc32(row["words"], zlib.crc32(row["states"])) != row["crc32"]:
                raise ValueError(f"shard {row['shard']}, block {row['block']}: checksum of the block")
            states = np.frombuffer(row["states"], "<u8").reshape(-1, LANES)
            ids = table.decode(row["n_tokens"], states, np.array(row["places"], np.int64), np.frombuffer(row["words"], "<u4")).astype("<u4")
            raw = ids.tobytes()
            if zlib.crc32(raw) != row["ids_crc32"]:
                raise ValueError(f"shard {row['shard']}, block {row['block']}: checksum of the ids")
            ends = np.cumsum(row["lengths"])
            starts = ends - row["lengths"]
            parts = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            last = pa.array([zlib.crc32(p) for p in parts], pa.int64()) if digest else pa.array(parts, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first"] + row["shard_start"]), pa.array(row["lengths"], pa.int64()), last],
                names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
            )


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids as little-endian unsigned 32-bit integers), one row per document of the files.

    ``digest``: ids_crc32, the checksum of a document's ids, in place of the ids.
    """
    table = spark.read.schema("id long, freq long").parquet(f"{path}/table").collect()  # one row an id of the vocabulary
    freq = np.zeros(max((r["id"] for r in table), default=-1) + 1, np.uint64)
    for r in table:
        freq[r["id"]] = r["freq"]
    blocks = spark.read.schema(_BLOCK_DDL).parquet(f"{path}/blocks")
    sizes = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # one row a shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    return blocks.join(F.broadcast(starts), "shard").mapInArrow(
        functools.partial(_decoded, freq=freq, digest=digest), "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary")
    )


def encoded_path(spark: SparkSession) -> str:
    return new_table_path(spark, "llm-ids")
