"""Shuffle files are deleted with the write they were made for."""

import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from paymart.sources import storage
from paymart.sources.csv import write_csv
from paymart.sources.storage import new_table_path, write_table


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size())} if files.size() else set()


def _left_by(spark, write):
    """The shuffle files of a write that are still there 5 seconds later."""
    before = _shuffle_files(spark)
    write()
    for _ in range(50):
        left = {f for f in _shuffle_files(spark) - before if f.startswith("shuffle_")}
        if not left:
            break
        time.sleep(0.1)
    return left


def test_shuffle_files_go_with_their_write(spark):
    grouped = spark.range(1000).groupBy((F.col("id") % 7).cast("string").alias("k")).agg(F.count(F.lit(1)).cast("string").alias("n"))
    assert _left_by(spark, lambda: grouped.write.parquet(new_table_path(spark, "plain")))
    assert not _left_by(spark, lambda: write_table(grouped, new_table_path(spark, "freed")))
    assert not _left_by(spark, lambda: write_csv(grouped, new_table_path(spark, "freed")))


def test_the_sessions_own_setting_comes_back(spark):
    before = spark.conf.get(storage.FREE_SHUFFLES, None)
    inside = []

    def write(n):
        with storage.shuffles_freed(spark):
            inside.append(spark.conf.get(storage.FREE_SHUFFLES))
            time.sleep(0.05 * n)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(8)))
    assert inside == ["true"] * 8 and spark.conf.get(storage.FREE_SHUFFLES, None) == before
    with pytest.raises(ValueError), storage.shuffles_freed(spark):
        raise ValueError
    assert spark.conf.get(storage.FREE_SHUFFLES, None) == before
