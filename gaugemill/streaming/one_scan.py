"""Several summaries from one scan of a stream.

Each micro-batch is read once: it is reduced to the states of all summaries per machine and
month, the finest of their keys, and these are staged. The tables are fed from them, one after
the other; coarser keys merge the finer ones' states. A batch that failed between two tables is
run again as a whole, and replaces in each table what it had stored there, so that every reading
counts once in each.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugemill.functions.timing import AsOf, months_before, resolved
from gaugemill.operators.states import KEY_INPUTS, Summary
from gaugemill.plans.tables import SummaryTable
from gaugemill.streaming import views
from gaugemill.streaming.compaction import compact

_FINEST = ("machine_id", "month")


def _name(number: int, name: str) -> str:
    return f"s{number}_{name}"


class Together:
    """The states of several summaries in one aggregation."""

    def __init__(self, summaries: Sequence[Summary]) -> None:
        self.summaries: list[Summary] = []
        for summary in summaries:
            if summary not in self.summaries:
                self.summaries.append(summary)
        for summary in self.summaries:
            if not set(summary.keys) <= set(_FINEST):
                raise ValueError(f"{summary.name} has other keys than {_FINEST}")

    def select_inputs(self, readings: DataFrame, as_of: AsOf = None) -> DataFrame:
        """What all of them need. Out of a summary's time range its inputs are NULL."""
        columns = [F.col(KEY_INPUTS[key]) for key in _FINEST]
        for number, summary in enumerate(self.summaries):
            within = _within(summary, as_of)
            columns.append(within.alias(_name(number, "within")))
            columns += [
                F.when(within, F.col(name)).alias(_name(number, name))
                for name in summary.inputs
                if name not in KEY_INPUTS.values()
            ]
        return readings.select(*columns)

    def to_states(self, inputs: DataFrame) -> DataFrame:
        """A row per machine and month, with the states of each summary and its row count."""
        states = []
        for number, summary in enumerate(self.summaries):
            states.append(F.count_if(_name(number, "within")).alias(_name(number, "rows")))
            pattern = re.compile(rf"\b({'|'.join(summary.inputs)})\b")
            for name, sql in summary.states.items():
                own = pattern.sub(lambda found: _name(number, found[0]), sql)
                states.append(F.expr(own).alias(_name(number, name)))
        keys = (F.col(KEY_INPUTS[key]).alias(key) for key in _FINEST)
        return inputs.groupBy(*keys).agg(*states)

    def of(self, summary: Summary, states: DataFrame) -> DataFrame:
        """One summary's states."""
        number = self.summaries.index(summary)
        own = states.where(F.col(_name(number, "rows")) > 0).select(
            F.col("machine_id").cast("string").alias("machine_id"),
            "month",
            *(F.col(_name(number, name)).alias(name) for name in summary.states),
        )
        if set(summary.keys) != set(_FINEST):
            own = summary.combine_states(own)
        return own.select(*summary.keys, *summary.states)


def _within(summary: Summary, as_of: AsOf) -> Column:
    if summary.months is None:
        return F.lit(True)
    return F.coalesce(F.col("timestamp") >= months_before(as_of, summary.months), F.lit(False))


def maintain_together(
    readings: DataFrame,
    tables: Sequence[SummaryTable],
    database: str,
    checkpoint: str,
    run_id: str,
    as_of: AsOf = None,
    trigger: dict | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Keep several summary tables up to date from one stream, which reads its source once.

    ``as_of`` is that of ``views.maintain``. Every ``compact_every`` batches the inserts of the
    tables are merged by size.
    """
    if run_id == views.FOLDED_RUN:
        raise ValueError(f"{views.FOLDED_RUN!r} names the folded states; give another run_id")
    together = Together([table.summary for table in tables])
    staged = f"{checkpoint}/states"

    def insert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        states = together.to_states(batch)
        states.write.mode("overwrite").parquet(staged)
        stored = spark.read.schema(states.schema).parquet(staged)
        for table in tables:
            own = together.of(table.summary, stored)
            views.store_insert(own, table, database, run_id, batch_id)
            if compact_every and batch_id % compact_every == compact_every - 1:
                compact(spark, table, database)

    return (
        together.select_inputs(readings, resolved(as_of))
        .writeStream.queryName(f"{database} {run_id}")
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(insert)
        .start()
    )


def catch_up_together(
    readings: DataFrame,
    tables: Sequence[SummaryTable],
    database: str,
    checkpoint: str,
    run_id: str,
    as_of: AsOf = None,
    compact_every: int | None = None,
) -> int:
    """Bring summaries up to date with all readings that have arrived; returns the rows read."""
    query = maintain_together(
        readings, tables, database, checkpoint, run_id, as_of, compact_every=compact_every
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()
        for table in tables:  # written in the stream's own session
            readings.sparkSession.catalog.refreshTable(table.qualified(database))
    return sum(progress["numInputRows"] for progress in query.recentProgress)
