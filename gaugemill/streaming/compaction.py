"""Merging the inserts of a summary table while its streams go on.

The batches of a stream are merged by size: ``FAN_IN`` inserts make one of the next tier, so that
n batches leave some ``FAN_IN`` log n inserts. A merged insert is a partition as any other, from
its first batch ``until`` the one after its last. It is written to its own folder and added to
the table; then the table's ``live`` view is replaced, which is the one step that readers see.
What the view left out already is removed only at the next call, so that queries that were
planned before a replacement can end.

The last batch of a stream may be repeated, and is never merged. One that is older and repeated
all the same goes to a partition that the view leaves out. After a crash anywhere, the next call
goes on: a merged folder that a finished job left is used, any other is written anew.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugemill.plans.tables import INSERT_COLUMNS, SummaryTable
from gaugemill.sources.inserts import (
    arranged,
    folder_of,
    is_done,
    publish,
    quoted,
    remove,
    root_of,
)
from gaugemill.streaming.views import FOLDED_RUN, inserts_of

FAN_IN = 4

Insert = tuple[str, str, int, int]


def tiers(count: int, fan_in: int = FAN_IN) -> list[tuple[int, int]]:
    """The merged ranges of the first ``count`` batches: the digits of the number, as it were."""
    ranges, begin, size = [], 0, 1
    while size * fan_in <= count:
        size *= fan_in
    while size > 1:
        while begin + size <= count:
            ranges.append((begin, begin + size))
            begin += size
        size //= fan_in
    return ranges


def live_inserts(inserts: set[Insert]) -> set[Insert]:
    """Inserts that none with more batches covers."""
    by_stream = defaultdict(list)
    for insert in inserts:
        by_stream[insert[:2]].append(insert)
    live = set()
    for own in by_stream.values():
        reached = -1
        for insert in sorted(own, key=lambda x: (x[2], -x[3])):
            if insert[3] > reached:
                live.add(insert)
                reached = insert[3]
    return live


def compact(
    spark: SparkSession, table: SummaryTable, database: str, fan_in: int = FAN_IN
) -> set[Insert]:
    """Merge what can be merged, show the result, and return the inserts that are live."""
    name = table.qualified(database)
    inserts = finished_inserts(spark, table, database)
    live = live_inserts(inserts)
    # After a crash the view may not show this yet; then nothing goes before the next call.
    is_shown = _shown(spark, table, database) == _shows(table, database, live)
    removable = inserts - live if is_shown else set()
    last: dict[tuple[str, str], int] = {}
    for insert in inserts:
        if insert[0] != FOLDED_RUN:
            last[insert[:2]] = max(insert[2], last.get(insert[:2], 0))
    states = table.live_states(spark, database)
    for (run_id, stream_id), count in last.items():
        own = {insert for insert in live if insert[:2] == (run_id, stream_id)}
        for begin, until in tiers(count, fan_in):
            merged = (run_id, stream_id, begin, until)
            inside = {x for x in own if begin <= x[2] and x[3] <= until}
            if inside and merged not in inserts:
                _merge(states, table, name, merged)
                inserts.add(merged)
    live = live_inserts(inserts)
    spark.sql(
        f"CREATE OR REPLACE VIEW {table.live(database)} AS {_shows(table, database, live)}"
    )
    for insert in removable:
        remove(spark, name, dict(zip(INSERT_COLUMNS, insert)))
    spark.catalog.refreshTable(name)
    return live


def _merge(states: DataFrame, table: SummaryTable, name: str, merged: Insert) -> None:
    run_id, stream_id, begin, until = merged
    parts = states.where(
        (F.col("run_id") == run_id)
        & (F.col("stream_id") == stream_id)
        & (F.col("batch_id") >= begin)
        & (F.col("until") <= until)
    )
    by = "month" if table.by_month else None
    order = [key for key in table.order if key != by]
    combined = arranged(table.summary.combine_states(parts), by, order)
    publish(combined, name, dict(zip(INSERT_COLUMNS, merged)), by)


def finished_inserts(spark: SparkSession, table: SummaryTable, database: str) -> set[Insert]:
    """The inserts of a table, but for merged ones whose files are not complete.

    The catalog has no such insert, unless it has lost its tables and found their folders again.
    """
    name = table.qualified(database)
    found, root = inserts_of(spark, table, database), root_of(spark, name)
    unfinished = set()
    for insert in found:
        named = dict(zip(INSERT_COLUMNS, insert))
        if insert[3] > insert[2] + 1 and not is_done(spark, folder_of(spark, root, named)):
            unfinished.add(insert)
            remove(spark, name, named)
    return found - unfinished


def _shows(table: SummaryTable, database: str, live: set[Insert]) -> str:
    """The view's text: all but what merged inserts cover."""
    merged = defaultdict(list)
    for run_id, stream_id, begin, until in sorted(live):
        if until > begin + 1:
            merged[run_id, stream_id].append((begin, until))
    covered = []
    for (run_id, stream_id), ranges in merged.items():
        kept = " OR ".join(f"(batch_id = {a} AND until = {b})" for a, b in ranges)
        covered.append(
            f"(run_id = {quoted(run_id)} AND stream_id = {quoted(stream_id)} "
            f"AND batch_id < {max(b for _, b in ranges)} AND NOT ({kept}))"
        )
    where = f" WHERE NOT ({' OR '.join(covered)})" if covered else ""
    return f"SELECT * FROM {table.qualified(database)}{where}"


def _shown(spark: SparkSession, table: SummaryTable, database: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table.live(database)}")
    return rows.where("col_name = 'View Text'").first()["data_type"]
