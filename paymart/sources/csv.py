"""Header CSV landing files, read as all-string tables (no inference)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paymart.schemas import RAW_COLUMNS, string_schema
from paymart.sources.storage import shuffles_freed

#: Column that holds the text of a line whose number of fields differs from the header's, else NULL.
RESCUED = "_rescued_line"

#: Lines of a landed file: some 25 MB of text, 6 MB gzipped.
ROWS_PER_FILE = 250_000


def header_columns(spark: SparkSession, path: str, source: str) -> list[str]:
    """The columns of landed files in file order, from a header line; all raw columns of ``source`` must be there."""
    found = spark.read.option("header", True).csv(path).columns
    missing = [c for c in RAW_COLUMNS[source] if c not in found]
    if missing:
        raise ValueError(f"{source} files under {path}: no column {', '.join(missing)} in header {found}")
    return found


def read_csv_strings(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Scan landed CSV as strings, columns by header name.

    The header gives the file order and the declared column list selects from
    it, so reordered and additional columns are fine and a missing one is an
    error.  Every value stays text: casting rules live in the silver layer.
    Files of one landing must agree: ``enforceSchema`` off makes Spark compare
    each file's header and fail on another one.
    """
    columns = header_columns(spark, path, source)
    return (
        spark.read.schema(string_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
        .select(*RAW_COLUMNS[source])
    )


def read_csv_rescued(spark: SparkSession, path: str, source: str, columns: list[str] | None = None) -> DataFrame:
    """``read_csv_strings`` with two more columns: the line itself where it is malformed, and its file.

    A line is malformed if it has fewer or more fields than the header (an
    unclosed quote swallows fields, so it counts as short).  Whole lines are
    parsed for that, so Spark's pruning of CSV columns is off.  Text after a line
    break inside quotes is a line of its own, as in ``read_csv_strings``.
    ``columns`` in file order spare the job that reads a header line; files that
    have another header are an error all the same.
    """
    columns = columns or header_columns(spark, path, source)
    schema = StructType([*string_schema(columns), StructField(RESCUED, StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RESCUED)
        .option("columnPruning", False)
        .csv(path)
        .select(*RAW_COLUMNS[source], RESCUED, F.lit(len(columns)).alias("expected_fields"), F.col("_metadata.file_name").alias("landed_file"))
    )


def field_count(line: Column) -> Column:
    """Fields of a CSV line: separators outside quotes and one; an unclosed quote runs to the end of the line."""
    bare = F.regexp_replace(line, r'(^|,)\s*"(?:[^"\\]|\\.)*(?:"|$)', "$1")
    return (F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1).cast("int")


def write_csv(df: DataFrame, path: str) -> str:
    """Land a string table as header CSV, keeping leading/trailing spaces.

    Files are gzipped, about a quarter of the plain text.  A reader cannot split such
    a file, so none holds more than ``ROWS_PER_FILE`` lines.
    """
    with shuffles_freed(df.sparkSession):
        (
            df.write.mode("overwrite")
            .option("header", True)
            .option("compression", "gzip")
            .option("maxRecordsPerFile", ROWS_PER_FILE)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    return path
