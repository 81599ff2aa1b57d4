"""Folders: scratch space for data that a query writes and reads back, and their sizes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def new_staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the session names; removed when the driver ends."""
    path = f"{_shared_folder(spark)}/gaugemill/{name}-{uuid.uuid4().hex}"
    _remove_at_exit(spark, path)
    return path


@contextmanager
def staged(frame: DataFrame, name: str) -> Iterator[DataFrame]:
    """The frame as Parquet files for as long as the block runs, to be read several times."""
    spark = frame.sparkSession
    path = new_staging_path(spark, name)
    frame.write.mode("append").parquet(path)
    try:
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        target, file_system = _file_system(spark, path)
        file_system.delete(target, True)


def _shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, or else one in the warehouse, which all executors write, too."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    folder = folder or f"{spark.conf.get(WAREHOUSE_DIR)}/_staged"
    return folder.rstrip("/")


def make_folder(spark: SparkSession, path: str) -> None:
    target, file_system = _file_system(spark, path)
    file_system.mkdirs(target)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    make_folder(spark, path)  # only an existing path can be marked
    target, file_system = _file_system(spark, path)
    file_system.deleteOnExit(target)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    target, file_system = _file_system(spark, path)
    return file_system.exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The folders right below one."""
    target, file_system = _file_system(spark, path)
    return sorted(
        status.getPath().getName()
        for status in file_system.listStatus(target)
        if status.isDirectory()
    )


def delete_folder(spark: SparkSession, path: str) -> None:
    target, file_system = _file_system(spark, path)
    file_system.delete(target, True)
