"""Bronze layer: raw strings plus audit columns, partitioned by load date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from paymart.schemas import AUDIT_COLUMNS, BRONZE_TABLES, RAW_COLUMNS, bronze_schema
from paymart.sources.csv import RESCUED, field_count, read_csv_rescued
from paymart.sources.storage import ROWS_PER_FILE, path_exists, read_table, write_table


def load_stamp(as_of: str) -> str:
    """The string stamp recorded for a load day (no wall clock)."""
    return f"{as_of} 00:00:00"


def add_audit_columns(df: DataFrame, source: str, load_date: str, load_timestamp: str | None = None) -> DataFrame:
    """Append ``load_timestamp``, ``source_file`` and ``load_date`` (all strings)."""
    return df.select(
        *RAW_COLUMNS[source],
        F.lit(load_timestamp or load_stamp(load_date)).alias("load_timestamp"),
        F.lit(f"{source}.csv").alias("source_file"),
        F.lit(load_date).alias("load_date"),
    )


QUARANTINE_SCHEMA = StructType(
    [
        StructField("source", StringType()),
        StructField("landed_file", StringType()),
        StructField("reason", StringType()),
        StructField("found_fields", IntegerType()),
        StructField("expected_fields", IntegerType()),
        StructField("first_field", StringType()),
        StructField("line", StringType()),
        StructField("load_date", StringType()),
    ]
)


def ingest_csv(spark: SparkSession, source: str, csv_path: str, bronze_root: str, load_date: str, columns: list[str] | None = None) -> str:
    """Land one CSV source into its bronze table for ``load_date``.

    The day's own folder is overwritten: re-running a day replaces that day only,
    also by a feed that has no rows any more, and earlier days stay (full audit
    trail).  No shuffle is added; files are bounded by their rows, so that a task that
    reads them packs few enough to sort them in memory.
    Lines that are malformed go to the quarantine table of the source instead,
    one day's folder likewise.  They are counted while the good rows are written;
    only a feed that has some is scanned a second time (a task run twice can only
    raise the count, so none is missed).  ``columns`` are the files' columns where the
    caller knows them.  Returns the table path.
    """
    path = f"{bronze_root}/{BRONZE_TABLES[source]}"
    rows = read_csv_rescued(spark, csv_path, source, columns)
    seen = Observation()
    counted = rows.observe(seen, F.count(RESCUED).alias("malformed"))
    df = add_audit_columns(counted.where(F.col(RESCUED).isNull()), source, load_date)
    write_table(df.drop("load_date"), f"{path}/load_date={load_date}", file_rows=ROWS_PER_FILE)
    rejects = f"{quarantine_path(bronze_root, source)}/load_date={load_date}"
    if seen.get["malformed"] or path_exists(spark, rejects):
        write_table(_rejected(rows, source), rejects)
    return path


def _rejected(rows: DataFrame, source: str) -> DataFrame:
    """Malformed lines with the file they came from and what is wrong with them."""
    found = field_count(F.col(RESCUED))
    reason = F.when(found < F.col("expected_fields"), "short").when(found > F.col("expected_fields"), "long").otherwise("unreadable")
    return rows.where(F.col(RESCUED).isNotNull()).select(
        F.lit(source).alias("source"), "landed_file", reason.alias("reason"), found.alias("found_fields"), "expected_fields",
        F.col(RAW_COLUMNS[source][0]).alias("first_field"), F.col(RESCUED).alias("line"),  # Spark wants a parsed column beside the line
    )


def quarantine_path(bronze_root: str, source: str) -> str:
    return f"{bronze_root}/{BRONZE_TABLES[source]}_quarantine"


def read_quarantine(spark: SparkSession, bronze_root: str, source: str, load_date: str | None = None) -> DataFrame:
    """Malformed lines of a source (optionally of one load date); no rows if no day had any."""
    path = quarantine_path(bronze_root, source)
    if not path_exists(spark, path):
        return spark.createDataFrame([], QUARANTINE_SCHEMA)
    df = read_table(spark, path, QUARANTINE_SCHEMA)
    return df if load_date is None else df.filter(F.col("load_date") == load_date)


def stream_path(bronze_root: str, source: str) -> str:
    """Where the streaming landing keeps its part of a bronze table (its commit log rules that folder alone)."""
    return f"{bronze_root}/{BRONZE_TABLES[source]}_stream"


def read_bronze(spark: SparkSession, bronze_root: str, source: str, load_date: str | None = None) -> DataFrame:
    """Read a bronze table, batch and streamed part (optionally one load date, pruned at the partition level)."""
    schema = bronze_schema(source)
    parts = []
    for path in (f"{bronze_root}/{BRONZE_TABLES[source]}", stream_path(bronze_root, source)):
        if path_exists(spark, path):
            parts.append(read_table(spark, path, schema).select(*RAW_COLUMNS[source], *AUDIT_COLUMNS))
    if not parts:
        raise FileNotFoundError(f"no bronze table of {source} under {bronze_root}")
    df = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return df if load_date is None else df.filter(F.col("load_date") == load_date)
