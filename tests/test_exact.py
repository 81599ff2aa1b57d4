"""Sums that don't depend on order, and trailing ranges from states by day."""

from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta
from fractions import Fraction

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_reports import readings

from gaugemill.operators.exact import _EXPONENTS, total
from gaugemill.operators.states import EXACT_ENERGY, EXACT_TEMPERATURE
from gaugemill.plans.tables import (
    DAILY_TABLES,
    EXACT_TABLES,
    READINGS,
    create_daily,
    create_exact,
    create_readings,
)
from gaugemill.sources.writers import append_readings
from gaugemill.streaming.panes import trailing_temperature
from gaugemill.streaming.views import write_states


def energies(spark, values):
    return spark.createDataFrame(
        [(i % 3, value, "1") for i, value in enumerate(values)],
        "machine_id int, energy_consumption double, machine_status string",
    )


def wide(seed, count=600):
    rng = random.Random(seed)
    return [rng.choice((-1, 1)) * rng.random() * 10.0 ** rng.randrange(-9, 14) for _ in range(count)]


@pytest.mark.parametrize("seed", [1, 2])
def test_states_of_any_partitioning_are_equal(spark, seed):
    frame = energies(spark, wide(seed))
    expected = rows(EXACT_ENERGY.to_states(frame))
    values = rows(EXACT_ENERGY.merge_states(EXACT_ENERGY.to_states(frame)))
    for parts in (2, 7, 40):
        part = F.pmod(F.xxhash64("energy_consumption", F.lit(parts)), F.lit(parts))
        states = None
        for i in range(min(parts, 7)):
            own = frame.where(part % 7 == i) if parts > 7 else frame.where(part == i)
            own = EXACT_ENERGY.to_states(own.repartition(parts))
            states = own if states is None else own.union(states)
        assert rows(EXACT_ENERGY.combine_states(states)) == expected
        assert rows(EXACT_ENERGY.merge_states(states)) == values


@pytest.mark.parametrize("seed", [3, 4])
def test_sums_are_the_nearest_doubles(spark, seed):
    values = wide(seed) + [0.1, -0.1, 2.0**-60, -0.0, 1e18, -1e18, None]
    states = EXACT_ENERGY.to_states(energies(spark, values))
    smallest = Fraction(2) ** _EXPONENTS[-1]
    found = states.select("machine_id", F.expr(total("avg_energy")), "avg_energy.count")
    for machine, result, count in found.collect():
        own = [x for i, x in enumerate(values) if str(i % 3) == machine and x is not None]
        cut = sum(int(Fraction(x) / smallest) for x in own) * smallest
        assert count == len(own)
        assert abs(result - float(cut)) <= math.ulp(float(cut))
        assert abs(float(cut) - math.fsum(own)) <= len(own) * float(smallest) + math.ulp(result)


def test_small_sums_after_cancelling(spark):
    values = [1e12, 2.0**-50, -1e12] * 1 + [0.0] * 6
    values = [v for value in values[:3] for v in (value, None, None)]
    states = EXACT_ENERGY.to_states(energies(spark, values))
    (row,) = [x for x in states.select("machine_id", F.expr(total("avg_energy"))).collect() if x[0] == "0"]
    assert row[1] == 2.0**-50


def test_values_beyond(spark):
    values = [math.inf, 1.0, math.nan, 4.0, 1e300, -math.inf, None, 3.0, 4.0]
    merged = EXACT_ENERGY.merge_states(EXACT_ENERGY.to_states(energies(spark, values)))
    found = {row["machine_id"]: row["avg_energy"] for row in merged.collect()}
    assert found["0"] == math.inf and math.isnan(found["2"])
    assert found["1"] == pytest.approx(1e300 / 3)


def test_no_values(spark):
    merged = EXACT_ENERGY.merge_states(EXACT_ENERGY.to_states(energies(spark, [None])))
    assert rows(merged) == [("0", None, None, 1.0)]


def test_exact_tables_keep_their_columns(spark, database):
    create_exact(spark, database)
    frame = readings(spark, {"temperature": 1.5, "energy_consumption": 2.5})
    for table in EXACT_TABLES:
        inputs = table.summary.select_inputs(frame, datetime(2025, 5, 20))
        for _ in range(2):
            write_states(inputs, table, database, "run", 0)
    assert rows(EXACT_TABLES[1].read(spark, database)) == [(date(2025, 5, 1), "39", 1.5)]


def test_trailing_ranges_equal_all_readings_at_any_moment(spark, database):
    rng = random.Random(7)
    begin = datetime(2025, 1, 1)
    frame = readings(
        spark,
        *(
            {
                "timestamp": begin + timedelta(seconds=rng.randrange(200 * 86_400)),
                "machine_id": rng.randrange(3),
                "temperature": rng.random() * 100,
            }
            for _ in range(500)
        ),
        {"timestamp": datetime(2025, 2, 28, 12, 0), "temperature": 1.0},
        {"timestamp": datetime(2025, 2, 28, 12, 1), "temperature": None},
    )
    name, (table,) = f"{database}.{READINGS}", DAILY_TABLES
    create_readings(spark, name)
    create_daily(spark, database)
    append_readings(frame, name)
    for batch in range(3):
        part = frame.where(F.pmod(F.xxhash64("timestamp"), F.lit(3)) == batch)
        write_states(table.summary.select_inputs(part), table, database, "run", batch)
    stored = spark.table(name)
    for moment in (
        datetime(2025, 5, 31, 12, 0),
        datetime(2025, 5, 31, 12, 0, 1),
        datetime(2025, 6, 1),
        datetime(2025, 7, 20, 23, 59, 59),
        datetime(2024, 1, 1),
        datetime(2030, 1, 1),
    ):
        expected = EXACT_TEMPERATURE.summarise(stored, moment)
        assert rows(trailing_temperature(stored, table, database, moment)) == rows(expected)


def test_a_trailing_range_reads_a_day_of_readings(spark, database):
    from conftest import plan_of

    name, (table,) = f"{database}.{READINGS}", DAILY_TABLES
    create_readings(spark, name)
    create_daily(spark, database)
    append_readings(readings(spark, {}), name)
    found = trailing_temperature(spark.table(name), table, database, datetime(2025, 7, 1, 3))
    plan = plan_of(found)
    assert plan.count("PartitionFilters: [isnotnull(month") == 2
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp,2025-04-01 03" in plan
