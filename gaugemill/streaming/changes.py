"""Which summary values each batch has changed, as a log that further streams can follow.

A late reading changes a value that was shown before. The log has a row for every key that a
batch has touched, with its values before (NULL for a new key) and after. It is a table of its
own, a partition per batch, that ``sources.readers.stream_table`` reads as a stream.

A batch's changes are written once, before its states: what was there before is known as long as
the states are not, and a repeated batch finds its changes written and stores its states again.
One stream feeds such a table: the values before are those of all batches but its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugemill.functions.timing import AsOf, resolved
from gaugemill.plans.tables import SummaryTable, quoted_name
from gaugemill.schemas import ddl
from gaugemill.sources.inserts import publish
from gaugemill.streaming.views import FOLDED_RUN, stream_of, write_states

_INSERT = {"run_id": "STRING", "stream_id": "STRING", "batch_id": "BIGINT"}


def changes_name(table: SummaryTable, database: str) -> str:
    return quoted_name(f"{database}.{table.states}_changes")


def create_changes(spark: SparkSession, table: SummaryTable, database: str) -> None:
    """The log of a summary table."""
    values = table.summary.merge_states(spark.createDataFrame([], table.summary.schema))
    keys = T.StructType([field for field in values.schema if field.name in table.summary.keys])
    shown = [field for field in values.schema if field.name not in table.summary.keys]
    both = T.StructType(
        [T.StructField(name, T.StructType(shown)) for name in ("before", "after")]
    )
    inserts = ", ".join(f"{name} {kind}" for name, kind in _INSERT.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {changes_name(table, database)} "
        f"({ddl(keys)}, {ddl(both)}, {inserts}) "
        f"USING parquet PARTITIONED BY ({', '.join(_INSERT)})"
    )


def changes_of(
    inputs: DataFrame, table: SummaryTable, database: str, insert: tuple[str, str, int]
) -> DataFrame:
    """Values before and after one insert, of the keys in it."""
    summary, keys = table.summary, list(table.summary.keys)
    own = summary.to_states(inputs)
    states = table.live_states(inputs.sparkSession, database)
    is_own = F.lit(True)
    for name, value in zip(_INSERT, insert):
        is_own &= F.col(name) == value
    touched = own.select(*(F.col(key).alias(f"of_{key}") for key in keys))
    same = [F.col(key).eqNullSafe(F.col(f"of_{key}")) for key in keys]
    old = states.where(~is_own).join(touched, same, "left_semi").select(*own.columns)
    after = summary.merge_states(old.unionByName(own))
    values = [name for name in after.columns if name not in keys]
    before = summary.merge_states(old).select(
        *(F.col(key).alias(f"of_{key}") for key in keys),
        F.struct(*values).alias("before"),
    )
    return after.join(before, same, "left").select(
        *keys, "before", F.struct(*values).alias("after")
    )


def write_changes(
    inputs: DataFrame, table: SummaryTable, database: str, run_id: str, batch_id: int
) -> None:
    """Log the changes of one insert, unless an earlier attempt has, and store its states."""
    insert = run_id, stream_of(inputs.sparkSession), batch_id
    found = changes_of(inputs, table, database, insert)
    publish(found, changes_name(table, database), dict(zip(_INSERT, insert)))
    write_states(inputs, table, database, run_id, batch_id)


def maintain_with_changes(
    readings: DataFrame,
    table: SummaryTable,
    database: str,
    checkpoint: str,
    run_id: str,
    as_of: AsOf = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """As ``views.maintain``, with a log of changes."""
    if run_id == FOLDED_RUN:
        raise ValueError(f"{FOLDED_RUN!r} names the folded states; give another run_id")

    def insert(batch: DataFrame, batch_id: int) -> None:
        write_changes(batch, table, database, run_id, batch_id)

    return (
        table.summary.select_inputs(readings, resolved(as_of))
        .writeStream.queryName(f"{database}.{table.name} {run_id}")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(insert)
        .start()
    )


def replayed(changes: DataFrame, table: SummaryTable) -> DataFrame:
    """The summary of one run, from its log: of each key what the last batch left."""
    last = F.max_by("after", "batch_id").alias("last")
    return changes.groupBy(*table.summary.keys).agg(last).select(*table.summary.keys, "last.*")
