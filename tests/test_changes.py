from __future__ import annotations

from datetime import datetime

import pytest
from conftest import SMALL, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_reports import readings
from test_streaming import direct, prepared, rounded  # noqa: F401

from gaugemill.plans.tables import STATE_TABLES
from gaugemill.sources.readers import stream_documents
from gaugemill.sources.sample_tables import lineitem, shipment_readings
from gaugemill.streaming import changes
from gaugemill.streaming.changes import (
    changes_name,
    create_changes,
    maintain_with_changes,
    replayed,
    write_changes,
)
from gaugemill.streaming.views import write_states


def log(spark, table, database):
    return spark.table(changes_name(table, database))


def test_a_late_reading_shows_as_a_change(spark, prepared):  # noqa: F811
    table = STATE_TABLES[2]
    create_changes(spark, table, prepared)
    end = datetime(2025, 6, 30)
    for batch, values in enumerate(
        [
            [{"timestamp": datetime(2025, 5, 3), "temperature": 10.0}],
            [{"timestamp": datetime(2025, 6, 3), "temperature": 1.0}],
            [
                {"timestamp": datetime(2025, 5, 1), "temperature": 20.0},  # late
                {"timestamp": datetime(2025, 6, 1), "machine_id": None, "temperature": 5.0},
            ],
        ]
    ):
        for _ in range(2):  # a repeated batch logs nothing new
            inputs = table.summary.select_inputs(readings(spark, *values), end)
            write_changes(inputs, table, prepared, "run", batch)
    found = log(spark, table, prepared).select(
        "batch_id",
        F.col("month").cast("string"),
        "machine_id",
        "before.avg_temperature",
        F.col("after.avg_temperature").alias("after"),
    )
    assert rows(found) == [
        (0, "2025-05-01", "39", None, 10.0),
        (1, "2025-06-01", "39", None, 1.0),
        (2, "2025-05-01", "39", 10.0, 15.0),
        (2, "2025-06-01", None, None, 5.0),
    ]
    assert rows(replayed(log(spark, table, prepared), table)) == rows(table.read(spark, prepared))


@pytest.mark.parametrize("table", STATE_TABLES, ids=lambda table: table.name)
def test_the_log_after_a_crash_equals_the_table(spark, prepared, tmp_path, monkeypatch, table):  # noqa: F811
    create_changes(spark, table, prepared)
    frame = shipment_readings(lineitem(spark, SMALL))
    as_of = frame.agg(F.max("timestamp")).first()[0]
    frame.repartition(3).write.parquet(f"{tmp_path}/parts")
    stream = stream_documents(spark, f"{tmp_path}/parts", frame.schema, "parquet", max_files=1)
    calls = []

    def failing(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost after the changes")
        write_states(*args)

    arguments = stream, table, prepared, f"{tmp_path}/checkpoint", "run", as_of
    with monkeypatch.context() as patch:
        patch.setattr(changes, "write_states", failing)
        with pytest.raises(StreamingQueryException, match="lost after"):
            maintain_with_changes(*arguments).awaitTermination()
    maintain_with_changes(*arguments).awaitTermination()
    final = rounded(table.read(spark, prepared))
    assert final == rounded(direct(table, frame, as_of))
    found = log(spark, table, prepared)
    assert rounded(replayed(found, table)) == final
    # Each change begins where the one before it ended.
    keys = list(table.summary.keys)
    later = found.alias("later").join(
        found.alias("earlier"),
        [F.col(f"later.{key}").eqNullSafe(F.col(f"earlier.{key}")) for key in keys]
        + [F.col("later.batch_id") == F.col("earlier.batch_id") + 1],
    )
    assert later.count() > 0
    first = found.where("before IS NULL").groupBy(*keys).count()
    assert first.where("count > 1").count() == 0
    assert first.count() == len(final)
