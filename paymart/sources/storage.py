"""Where jobs write tables, and how tables are written and read.

Tables go under the shared folder the cluster names in ``spark.checkpoint.dir``
(read from the session).  Only a local-mode session without that setting gets
a private temporary folder, so tests can run; a cluster session without it is
an error rather than a silent write to one machine's disk.

Writers never overwrite a path that is being read: every image gets a fresh
directory, and partitioned tables use dynamic partition overwrite so that a
re-run replaces exactly the partitions it produces.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_CONF = "spark.checkpoint.dir"
COMPRESSION = "zstd"  # of parquet files: about a fifth smaller than by the default
#: Rows of a file of transactions or facts, some 2 MB.  Spark packs files into one task by their
#: size and 4 MB an opened file: 21 of these, whose rows a task sorts in less than 1 GB.
ROWS_PER_FILE = 100_000


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[str, list] = {}  # session -> [writes under way, the setting as it was before them]
_freeing_lock = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write are deleted as soon as it has ended.

    Without that they stay until the driver collects its garbage, which takes longer than
    a load: the disk would hold the shuffles of all tables of a day instead of those of the tables
    being written.  Only for writes, whose plans are run once.  Tables are written side by
    side, so the session's own setting comes back after the last of them.
    """
    session = spark._jsparkSession.sessionUUID()
    with _freeing_lock:
        if session not in _freeing:
            _freeing[session] = [0, spark.conf.get(FREE_SHUFFLES, None)]
            spark.conf.set(FREE_SHUFFLES, True)
        _freeing[session][0] += 1
    try:
        yield
    finally:
        with _freeing_lock:
            _freeing[session][0] -= 1
            if not _freeing[session][0]:
                before = _freeing.pop(session)[1]
                spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def storage_root(spark: SparkSession) -> str:
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            f"set {CHECKPOINT_CONF} to a folder shared by all executors before running paymart jobs"
        )
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="paymart-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh directory for one table image."""
    return f"{storage_root(spark)}/paymart/{name}-{uuid.uuid4().hex[:12]}"


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    dynamic: bool = False,
    rebalance: bool = True,
    file_rows: int | None = None,
) -> str:
    """Overwrite ``path`` with ``df`` as parquet.

    ``dynamic=True`` replaces only the partitions present in ``df`` (a re-run
    of one load date leaves the other dates alone).

    Partitioned writes go through a REBALANCE on the partition columns: AQE
    groups each partition value's rows into advisory-size tasks, coalescing
    small ones and splitting a large (skewed) value over several tasks.  Each
    directory thus gets a few right-sized files instead of one small file per
    upstream task, and no single task has to write a whole month.
    ``rebalance=False`` skips that shuffle when the input splits already have
    the right size (a one-day ingest of landed files).  ``file_rows``: the most rows of a file.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite").option("compression", COMPRESSION)
    if file_rows:
        w = w.option("maxRecordsPerFile", file_rows)
    if partition_by:
        w = w.partitionBy(*partition_by)
        if dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
    with shuffles_freed(df.sparkSession):
        w.parquet(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked of its own file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a parquet table; a declared schema types partition columns and lets a table without rows be read."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)
