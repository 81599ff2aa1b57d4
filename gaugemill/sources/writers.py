"""Sinks. All of them append by default and none removes duplicates; an insert with a name is
stored once, however often it is repeated."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugemill.schemas import MONTH_PARTITION, REQUIRED_COLUMNS
from gaugemill.sources.inserts import INSERT_ID, arranged, folder_of, publish, write_once

BATCH_ROWS = 10_000


def append_documents(
    documents: DataFrame,
    path: str | None = None,
    fmt: str = "json",
    mode: str = "append",
    options: Mapping[str, str] | None = None,
    id_column: str | None = "_id",
    insert_id: str | None = None,
) -> None:
    """Append documents to a collection.

    File formats give no identifiers, so documents without one get a random ``id_column``;
    pass ``None`` for a store that assigns its own. With ``insert_id``, which is for files, the
    documents go to a folder of that name and a repeated call adds nothing. All inserts of a
    collection have one, or none has: its readers see it as a column.
    """
    if id_column and id_column not in documents.columns:
        documents = documents.withColumn(id_column, F.uuid())
    if insert_id is not None:
        folder = folder_of(documents.sparkSession, path, {INSERT_ID: insert_id})
        write_once(documents, folder, fmt, options=options)
        return
    documents.write.format(fmt).options(**(options or {})).mode(mode).save(path)


def append_table(
    frame: DataFrame,
    table: str,
    mode: str = "append",
    *,
    partition_by: Sequence[str] = (),
    gather_by: Sequence[Column] = (),
    sort_by: Sequence[str | Column] = (),
    not_null: Sequence[str] = (),
    on_null: str = "raise",
    gather: bool = True,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write to a catalog table, matching columns by name.

    Rows are gathered by partition, so that each partition gets few files. ``rebalance``
    lets adaptive execution split a partition value that holds much of the data over many
    tasks, where a plain repartition would put it into one. Input that comes ordered by
    partition, such as a time-ordered feed, can do without that shuffle (``gather=False``).
    ``gather_by`` gathers rows within a partition, too.
    ``fmt`` names the table's provider where it is not the session's default.
    """
    frame = require_values(frame, not_null, on_null)
    if partition_by and gather:
        # The hint takes columns only.
        within = {f"__gather_{i}": column for i, column in enumerate(gather_by)}
        names = (F.col(name) for name in (*partition_by, *within))
        frame = frame.withColumns(within).hint("rebalance", *names).drop(*within)
    if sort_by:
        frame = frame.sortWithinPartitions(*partition_by, *sort_by)
    writer = frame.write.options(**(options or {})).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt:
        writer = writer.format(fmt)
    writer.saveAsTable(table)


def append_readings(
    readings: DataFrame,
    table: str,
    mode: str = "append",
    on_null: str = "raise",
    machine_buckets: int | None = None,
    **kwargs,
) -> None:
    """Write cleaned readings: partitioned by month, sorted by time within a partition.

    With ``machine_buckets`` the machines of a month are dealt to so many buckets, which lie one
    after the other, each sorted by time. A row group then holds the machines of few buckets,
    which its dictionary, or else a Bloom filter (``tables.BY_MACHINE``), tells to readers: those
    of one machine skip the others, and those of a time range still skip most of each bucket. A
    machine with much of the data is dealt to many tasks, as a month is.
    """
    order: list[str | Column] = ["timestamp"]
    gather_by: list[Column] = []
    if machine_buckets is not None:
        bucket = F.pmod(F.xxhash64("machine_id"), F.lit(machine_buckets))
        order, gather_by = [bucket, *order], [bucket]
    append_table(
        readings,
        table,
        mode,
        partition_by=[MONTH_PARTITION],
        gather_by=gather_by,
        sort_by=order,
        not_null=REQUIRED_COLUMNS,
        on_null=on_null,
        **kwargs,
    )


def append_insert(
    readings: DataFrame, table: str, insert_id: str, on_null: str = "raise"
) -> None:
    """Store cleaned readings once under a name, in a table made with ``by_insert``.

    The same call again completes what a failure left undone and adds nothing else, whatever it
    is given. Sorted as by ``append_readings``.
    """
    readings = require_values(readings, REQUIRED_COLUMNS, on_null)
    rows = arranged(readings, MONTH_PARTITION, ["timestamp"])
    publish(rows, table, {INSERT_ID: insert_id}, MONTH_PARTITION)


def append_jdbc(
    frame: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    *,
    batch_rows: int = BATCH_ROWS,
    connections: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write over JDBC, ``batch_rows`` per round trip.

    Each task opens a connection and commits its rows at once, so a retried task adds
    nothing twice unless it was lost after its commit. ``connections`` bounds how many
    tasks write, and with them the load on the database; a frame that is not staged is also
    computed by no more tasks, back to its last shuffle, so stage it first (``staged``).
    """
    writer = (
        frame.write.format("jdbc")
        .options(**(properties or {}))
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_rows)
    )
    if connections is not None:
        writer = writer.option("numPartitions", connections)
    writer.mode(mode).save()


def require_values(frame: DataFrame, columns: Sequence[str], on_null: str = "raise") -> DataFrame:
    """Refuse (``raise``) or leave out (``drop``) rows with NULL in one of the columns.

    The check is part of the write's own plan and costs no extra pass.
    """
    if on_null == "drop":
        return frame.dropna(subset=list(columns)) if columns else frame
    if on_null != "raise":
        raise ValueError(f"on_null must be 'raise' or 'drop', not {on_null!r}")
    return frame.withColumns({name: _or_fail(name) for name in columns})


def _or_fail(name: str) -> Column:
    failure = F.raise_error(F.lit(f"NULL in required column {name}"))
    return F.when(F.col(name).isNotNull(), F.col(name)).otherwise(failure)
