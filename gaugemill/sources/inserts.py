"""Inserts that can be repeated: each has a name, and a folder of its own.

The files of an insert are written to its folder as one job, and its partitions are then made
known to the catalog. A folder that holds a finished job is left as it is; an unfinished one is
written anew. Whatever a failure left undone, the same call again completes it, and rows are
stored once. Folders have the usual names of partitions, so that ``MSCK REPAIR`` finds them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugemill.sources.folders import delete_folder, exists, folder_names

INSERT_ID = "insert_id"
_DONE = "_SUCCESS"  # what a finished job leaves in its folder
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _escaping(spark: SparkSession):
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils


def folder_of(spark: SparkSession, root: str, insert: Mapping[str, object]) -> str:
    """The folder of a partition below that of its table."""
    names = _escaping(spark)
    parts = (names.getPartitionPathString(name, str(value)) for name, value in insert.items())
    return "/".join((root.rstrip("/"), *parts))


def root_of(spark: SparkSession, table: str) -> str:
    """Where a table keeps its files."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def is_done(spark: SparkSession, folder: str) -> bool:
    return exists(spark, f"{folder}/{_DONE}")


def write_once(
    frame: DataFrame,
    folder: str,
    fmt: str = "parquet",
    by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    """Write a folder, unless a finished job has written it before."""
    if not is_done(frame.sparkSession, folder):
        writer = frame.write.format(fmt).options(**(options or {})).mode("overwrite")
        (writer.partitionBy(*by) if by else writer).save(folder)


def publish(
    frame: DataFrame, table: str, insert: Mapping[str, object], by: str | None = None
) -> None:
    """Write an insert's files once and add its partitions to a Parquet table.

    ``table`` is a name for SQL, partitioned by the names in ``insert`` and then by ``by``. All
    partitions are added by one statement.
    """
    spark = frame.sparkSession
    folder = folder_of(spark, root_of(spark, table), insert)
    write_once(frame, folder, by=[by] if by else [])
    add_partitions(spark, table, insert, folder, by)


def add_partitions(
    spark: SparkSession, table: str, insert: Mapping[str, object], folder: str, by: str | None
) -> None:
    clauses = []
    for name in folder_names(spark, folder) if by else [""]:
        own = dict(insert)
        if by:
            key, _, value = name.partition("=")
            if key != by:
                continue
            own[by] = _escaping(spark).unescapePathName(value)
        place = f"{folder}/{name}".rstrip("/")
        clauses.append(f"PARTITION ({_spec(own)}) LOCATION {quoted(place)}")
    if clauses:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(clauses)}")
    spark.catalog.refreshTable(table)


def remove(spark: SparkSession, table: str, insert: Mapping[str, object]) -> None:
    """Take an insert out of a table, with its files."""
    found = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({_spec(insert)})").collect()
    names = _escaping(spark)
    clauses = []
    for row in found:
        parts = (part.split("=", 1) for part in row[0].split("/"))
        values = {key: names.unescapePathName(value) for key, value in parts}
        clauses.append(f"PARTITION ({_spec(values)})")
    if clauses:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(clauses)}")
    delete_folder(spark, folder_of(spark, root_of(spark, table), insert))


def _spec(values: Mapping[str, object]) -> str:
    return ", ".join(
        f"{name} = " + ("NULL" if value == _NO_VALUE else quoted(str(value)))
        for name, value in values.items()
    )


def arranged(frame: DataFrame, by: str | None, order: Sequence[str]) -> DataFrame:
    """Rows gathered by partition and sorted within it; a large one is dealt to many tasks."""
    if by:
        frame = frame.hint("rebalance", F.col(by))
    return frame.sortWithinPartitions(*([by] if by else []), *order)
