"""Incremental summaries over Structured Streaming.

Each micro-batch is one insert: it is reduced to states and stored in the partition
``(run_id, stream_id, batch_id, until)``. A batch that is run again after a failure has the same ids
and replaces its own states, so every reading counts once. A new checkpoint starts at batch 0
again, as another stream, and needs a ``run_id`` of its own: a run that another stream has
begun is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugemill.functions.timing import AsOf, resolved
from gaugemill.plans.tables import INSERT_COLUMNS, NO_STREAM, SummaryTable, quoted

FOLDED_RUN = "folded"

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_STREAM_ID = "sql.streaming.queryId"  # what the engine calls the running stream


def write_states(
    inputs: DataFrame, table: SummaryTable, database: str, run_id: str, batch_id: int
) -> None:
    """Store the states of one insert, replacing those of an earlier attempt."""
    store_insert(table.summary.to_states(inputs), table, database, run_id, batch_id)


def store_insert(
    states: DataFrame, table: SummaryTable, database: str, run_id: str, batch_id: int
) -> None:
    """As ``write_states``, for states that are known already."""
    spark = states.sparkSession
    stream_id = stream_of(spark)
    _refuse_foreign_run(spark, table, database, run_id, stream_id)
    _store(states, table, database, (run_id, stream_id, batch_id, batch_id + 1))


def stream_of(spark: SparkSession) -> str:
    """The identity of the stream that runs in this thread."""
    return spark.sparkContext.getLocalProperty(_STREAM_ID) or NO_STREAM


def inserts_of(
    spark: SparkSession, table: SummaryTable, database: str, run_id: str | None = None
) -> set[tuple[str, str, int, int]]:
    """The ``INSERT_COLUMNS`` of the inserts in a table, from its list of partitions."""
    only = "" if run_id is None else f" PARTITION (run_id = {quoted(run_id)})"
    found = spark.sql(f"SHOW PARTITIONS {table.qualified(database)}{only}").collect()
    result = set()
    for row in found:
        parts = dict(part.split("=", 1) for part in row[0].split("/"))
        run, stream, batch, until = (unquote(parts[name]) for name in INSERT_COLUMNS)
        result.add((run, stream, int(batch), int(until)))
    return result


_OWN: set[tuple] = set()  # runs that a stream of this driver has been found to own


def _refuse_foreign_run(spark, table, database, run_id: str, stream_id: str) -> None:
    """Looked up once per stream, as the list of partitions grows with its batches."""
    owned = stream_id, run_id, table.qualified(database)
    if owned in _OWN:
        return
    streams = {stream for _, stream, *_ in inserts_of(spark, table, database, run_id)}
    if streams - {stream_id}:
        raise ValueError(
            f"run {run_id!r} of {table.name} belongs to another stream: "
            "give a new checkpoint a run_id of its own"
        )
    if stream_id != NO_STREAM:
        _OWN.add(owned)


def fold_states(spark: SparkSession, table: SummaryTable, database: str, target: str) -> None:
    """Combine the states of many inserts into one, in the table of another database.

    State tables grow by a row per key and insert. Stop the streams, fold, and go on with the
    same checkpoints in ``target``. The last batch of each run may yet be repeated and stays
    apart. The old table is left as it is, so folding can be repeated, too.
    """
    last: dict[tuple[str, str], int] = {}
    for run_id, stream_id, batch_id, _ in inserts_of(spark, table, database):
        if run_id != FOLDED_RUN:
            key = run_id, stream_id
            last[key] = max(batch_id, last.get(key, batch_id))
    states = table.live_states(spark, database)
    older = states
    for (run_id, stream_id), batch_id in last.items():
        is_last = (
            (F.col("run_id") == run_id)
            & (F.col("stream_id") == stream_id)
            & (F.col("batch_id") == batch_id)
        )
        older = older.where(~is_last)
        kept = states.where(is_last).drop(*INSERT_COLUMNS)
        _store(kept, table, target, (run_id, stream_id, batch_id, batch_id + 1))
    _store(table.summary.combine_states(older), table, target, (FOLDED_RUN, NO_STREAM, 0, 1))


def _store(
    states: DataFrame, table: SummaryTable, database: str, insert: tuple[str, str, int, int]
) -> None:
    """Replace one insert, with all its months, whatever the session's overwrite mode."""
    if table.by_month:
        states = states.hint("rebalance", F.col("month"))
    states = states.sortWithinPartitions(*table.order)
    by_month = ", month" if table.by_month else ""
    spark = states.sparkSession
    with _setting(spark, _OVERWRITE_MODE, "static"):
        spark.sql(
            f"INSERT OVERWRITE TABLE {table.qualified(database)} PARTITION "
            f"(run_id = :run_id, stream_id = :stream_id, batch_id = :batch_id, until = :until"
            f"{by_month}) "
            "BY NAME SELECT * FROM {states}",
            args=dict(zip(INSERT_COLUMNS, insert)),
            states=states,
        )


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def maintain(
    readings: DataFrame,
    table: SummaryTable,
    database: str,
    checkpoint: str,
    run_id: str,
    as_of: AsOf = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep a summary table up to date from a stream of cleaned readings.

    Rows and columns are selected before ``foreachBatch``, where the scan can still use it.
    Without ``as_of`` the time range ends at the batch's recorded start, which stays the same
    when the batch is run again. A frame is looked up once, here: all batches of this stream
    have the same range, and one that is started later on the same checkpoint moves on.
    """
    if run_id == FOLDED_RUN:
        raise ValueError(f"{FOLDED_RUN!r} names the folded states; give another run_id")
    inputs = table.summary.select_inputs(readings, resolved(as_of))

    def insert(batch: DataFrame, batch_id: int) -> None:
        write_states(batch, table, database, run_id, batch_id)

    return (
        inputs.writeStream.queryName(f"{database}.{table.name} {run_id}")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(insert)
        .start()
    )


def catch_up(
    readings: DataFrame,
    tables: tuple[SummaryTable, ...],
    database: str,
    checkpoint: str,
    run_id: str,
    as_of: AsOf = None,
) -> None:
    """Bring several summaries up to date with all readings that have arrived.

    If one fails, the others are stopped; all of them go on from their checkpoints. Each table
    has a stream, which reads the source by itself: of a readings table only its own columns,
    of JSON documents all of them, so that several summaries are better fed from the table.
    """
    as_of = resolved(as_of)
    running = []
    try:
        for table in tables:
            folder = f"{checkpoint}/{table.name}"
            running.append(maintain(readings, table, database, folder, run_id, as_of))
        for query in running:
            query.awaitTermination()
    finally:
        for query in running:
            query.stop()
        for table in tables:  # written in the streams' own sessions
            readings.sparkSession.catalog.refreshTable(table.qualified(database))
