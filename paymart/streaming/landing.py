"""Incremental bronze ingest with Structured Streaming.

The batch ingest (``sources.bronze.ingest_csv``) lands one file set per call.
This is the same landing as a file-source stream: CSV files dropped under
``<landing>/load_date=<day>/`` are picked up once each, get the audit
columns, and are appended to the bronze table partitioned by ``load_date``.

``Trigger.AvailableNow`` processes everything that has landed and stops, so
a daily scheduler can run it like a batch job, while the checkpoint and the
file sink's commit log make every file land exactly once: a re-run after a
failure (or a lost executor) neither drops nor duplicates rows.  The
checkpoint lives under the shared storage root.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paymart.schemas import RAW_COLUMNS, string_schema
from paymart.sources.bronze import stream_path
from paymart.sources.csv import header_columns


def stream_landing_to_bronze(
    spark: SparkSession,
    source: str,
    landing_dir: str,
    bronze_root: str,
    checkpoint_dir: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start an available-now stream from ``landing_dir`` into the bronze table of ``source``.

    ``landing_dir`` holds ``load_date=YYYY-MM-DD`` subdirectories of header
    CSV files; columns go by header name (see ``read_csv_strings``).  The rows
    land in a folder of their own next to the batch part, and ``read_bronze``
    reads both.  Returns the started query (call ``awaitTermination()``).
    """
    columns = [c for c in header_columns(spark, landing_dir, source) if c != "load_date"]
    schema = string_schema([*columns, "load_date"])
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.csv(landing_dir)
    bronze = rows.select(
        *RAW_COLUMNS[source],
        F.concat(F.col("load_date"), F.lit(" 00:00:00")).alias("load_timestamp"),
        F.lit(f"{source}.csv").alias("source_file"),
        "load_date",
    )
    return (
        bronze.writeStream.format("parquet")
        .partitionBy("load_date")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start(stream_path(bronze_root, source))
    )
