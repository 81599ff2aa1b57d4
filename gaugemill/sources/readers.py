"""Batch and streaming sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from gaugemill.schemas import CSV_READING

Options = Mapping[str, str] | None

# The engine forgets files older than a week, by modification time, and never reads them. A
# backfill copied with its times kept must count, too, so no file is too old here. In return,
# the names of all files ever read are kept with the checkpoint.
MAX_FILE_AGE = "36500d"


def read_csv(spark: SparkSession, path: str, schema: T.StructType = CSV_READING) -> DataFrame:
    """CSV with a header row; the schema is given, so the files are read once."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_documents(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "json",
    schema: T.StructType | None = None,
    options: Options = None,
) -> DataFrame:
    """A document collection from any data source on the classpath.

    Without a schema the source infers one, which for JSON files takes a second pass over
    the data; pass a schema where it is known.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def stream_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    max_files: int | None = None,
    max_bytes: int | None = None,
    max_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """New files of a collection as a stream, so much per batch at most.

    ``path`` is a directory or a glob pattern. Files whose modification time lies ``max_age``
    before the newest one are left out for good.
    """
    reader = limited(spark.readStream.schema(schema), max_files, max_bytes, max_age)
    return reader.format(fmt).load(path)


def stream_table(
    spark: SparkSession,
    table: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    max_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Rows appended to a table as a stream; ``max_age`` as in ``stream_documents``."""
    return limited(spark.readStream, max_files, max_bytes, max_age).table(table)


def limited(
    reader: DataStreamReader,
    max_files: int | None = None,
    max_bytes: int | None = None,
    max_age: str = MAX_FILE_AGE,
) -> DataStreamReader:
    """A reader of files with its limits per batch."""
    reader = reader.option("maxFileAge", max_age)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader
