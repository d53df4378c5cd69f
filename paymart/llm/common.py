"""Helpers the operators share: tables, staged results, text columns in Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import hashlib
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paymart.sources.storage import new_table_path

#: Bytes that end a word: space, and tab to carriage return.
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors through Spark's file server, once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="paymart-ship-"), "paymart_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_table_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with as many underscores before it as no column of that name needs."""
    taken = {c.lower() for c in columns}
    while wanted in taken:
        wanted = "_" + wanted
    return wanted


def numbered_copies(rows: DataFrame, same: Column, number: str, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the column ``number``: rows that agree in the hash ``same`` are numbered 0, 1, 2, ...; and the written input.

    The numbers of a hash are gapless whatever the input's splits, so what is derived from (hash, number)
    repeats on other splits if rows of one hash are interchangeable.  Copies are counted by the task that
    wrote them, so no task gathers a hot hash.  The input is written first: places in it must stay.
    """
    key, task, line, before = (free_name(rows.columns, c) for c in ("same", "task", "line", "before"))
    placed = staged(rows.withColumn(key, same).withColumn(task, F.spark_partition_id()).withColumn(line, F.monotonically_increasing_id()), name)
    lower = Window.partitionBy(key).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    counts = placed.groupBy(key, task).agg(F.count("*").alias(before))
    starts = counts.select(key, task, F.sum(before).over(lower).alias(before)).where(F.col(before) > 0)
    rank = F.row_number().over(Window.partitionBy(key, task).orderBy(line)) - 1
    numbered = placed.withColumn(number, rank).join(starts, [key, task], "left").select(
        *[F.col(f"`{c}`") for c in rows.columns], (F.col(number) + F.coalesce(before, F.lit(0))).cast("long").alias(number)
    )
    return numbered, placed


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _libc() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another C library: it keeps what it has
        return None


def tidy(stage: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A batch function that hands freed memory back to the system when its partition is done.

    Python workers live on for later stages; without this each keeps the most it ever held.
    """

    @functools.wraps(stage)
    def run(batches: Iterator[pa.RecordBatch], *args, **kwargs) -> Iterator[pa.RecordBatch]:
        try:
            yield from stage(batches, *args, **kwargs)
        finally:
            pa.default_memory_pool().release_unused()
            libc = _libc()
            if libc is not None and hasattr(libc, "malloc_trim"):
                libc.malloc_trim(0)

    return run


def texts_of(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The UTF-8 bytes of each value (no copy), None for null."""
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(n):
        yield data[at[i] : at[i + 1]] if valid[i] else None


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Rows that come sorted by integer ``keys``, one table a key; holds one group and one batch at a time."""
    rest: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([rest, now]) if rest is not None else now
        if not now.num_rows:
            continue
        new = np.zeros(now.num_rows - 1, bool)
        for key in keys:
            value = now.column(key).to_numpy()
            new |= value[1:] != value[:-1]
        ends = [0, *(np.flatnonzero(new) + 1).tolist()]
        for at, to in zip(ends[:-1], ends[1:], strict=True):
            yield now.slice(at, to - at)
        rest = now.slice(ends[-1])
    if rest is not None and rest.num_rows:
        yield rest


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finalizer (a bijection that spreads every input bit over the word)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the starts and ends of the words of a text."""
    edge = np.diff(np.concatenate(([0], IS_WORD[text].view(np.int8), [0])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class WordHashes:
    """64-bit hashes of all words of a text at once.

    A word is read eight bytes at a time and every step is a bijection of the running value, so words of
    eight bytes at most never collide with one another, and no pattern of bytes cancels out.  Words of
    more than ``LONG`` bytes are hashed by blake2b.
    """

    LONG = 64
    _STEP = np.uint64(0xD6E8FEB86659FD93)
    _LOW = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)

    def __call__(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        padded = np.zeros(len(text) + 8, np.uint8)
        padded[: len(text)] = text
        eight = np.ndarray((len(text) + 1,), np.dtype("<u8"), padded.data, strides=(1,))
        size = ends - starts
        value = mix64(eight[starts] & self._LOW[np.minimum(size, 8)]) + size.astype(np.uint64) * self._STEP
        rest, at = np.flatnonzero((size > 8) & (size <= self.LONG)), 8
        while len(rest):
            here = eight[starts[rest] + at] & self._LOW[np.minimum(size[rest] - at, 8)]
            value[rest] = mix64((value[rest] ^ here) * self._STEP)
            at += 8
            rest = rest[size[rest] > at]
        for k in np.flatnonzero(size > self.LONG).tolist():
            word = hashlib.blake2b(text[starts[k] : ends[k]].tobytes(), digest_size=8)
            value[k] = int.from_bytes(word.digest(), "little")
        return mix64(value)
