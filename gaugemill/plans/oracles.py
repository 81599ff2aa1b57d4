"""The catalogue's queries as SQL over the given tables."""

from __future__ import annotations

_E = """
WITH e AS (
    SELECT
        cast(event_id AS VARCHAR) AS _id,
        date_trunc('second', ts) AS "timestamp",
        value AS temperature,
        value + 1000 AS pressure,
        value / 10 AS vibration,
        value * 2 AS energy_consumption,
        cast(regexp_extract(props, '[0-9]+') AS DOUBLE) AS humidity,
        event_type = 'error' AS anomaly_flag,
        cast(0 AS DOUBLE) AS downtime_risk,
        CASE event_type WHEN 'view' THEN '0' WHEN 'error' THEN '1' ELSE '99' END AS failure_code,
        cast(regexp_extract(props, '[0-9]+') AS INTEGER) AS remaining_life,
        cast(user_id AS INTEGER) AS machine_id,
        cast(event_id % 3 AS VARCHAR) AS machine_status,
        event_type = 'signup' AS maintenance_required,
        cast(date_trunc('month', ts) AS DATE) AS month_partition,
        CASE event_type WHEN 'view' THEN 'Normal' WHEN 'error' THEN 'Critical'
            ELSE event_type END AS failure_type
    FROM events
)
"""

_L = """
WITH l AS (
    SELECT
        l_shipdate AS "timestamp",
        l_quantity AS temperature,
        l_discount AS vibration,
        l_extendedprice AS energy_consumption,
        l_returnflag = 'R' AS anomaly_flag,
        cast(l_suppkey AS INTEGER) AS machine_id,
        cast(l_linenumber % 3 AS VARCHAR) AS machine_status,
        cast(date_trunc('month', l_shipdate) AS DATE) AS month_partition
    FROM lineitem
)
"""

_DOUBLES = (
    "temperature",
    "pressure",
    "vibration",
    "energy_consumption",
    "humidity",
    "downtime_risk",
)
_OTHERS = (
    '"timestamp"',
    "anomaly_flag",
    "failure_code",
    "remaining_life",
    "machine_id",
    "machine_status",
    "maintenance_required",
    "month_partition",
)


def _cleaned(float_type: str = "DOUBLE", extra: tuple[str, ...] = ("_id",)) -> str:
    floats = (f"cast({name} AS {float_type}) AS {name}" for name in _DOUBLES)
    return f"{_E} SELECT {', '.join((*extra, *_OTHERS, *floats))} FROM e"


def _average(value: str, name: str) -> str:
    return f"round(avg({value}) + 1e-9, 6) AS {name}"


def _daily(cte: str, source: str) -> str:
    return f"""{cte}
    SELECT cast("timestamp" AS DATE) AS day,
        {_average("temperature", "avg_temp")}, {_average("vibration", "avg_vib")}
    FROM {source}
    WHERE machine_id = 39
        AND "timestamp" >= (SELECT max("timestamp") FROM {source}) - INTERVAL 45 DAY
    GROUP BY day ORDER BY day"""


def _anomalies(cte: str, source: str, count_type: str = "INTEGER") -> str:
    return f"""{cte}
    SELECT cast(machine_id AS VARCHAR) AS machine_id, month_partition AS month,
        cast(count(*) FILTER (WHERE anomaly_flag) AS {count_type}) AS anomaly_count
    FROM {source} GROUP BY ALL"""


def _energy(cte: str, source: str) -> str:
    return f"""{cte}
    SELECT cast(machine_id AS VARCHAR) AS machine_id,
        max(energy_consumption) AS max_energy,
        {_average("energy_consumption", "avg_energy")},
        {_average("cast(machine_status AS DOUBLE)", "avg_machine_status")}
    FROM {source} GROUP BY ALL"""


def _temperature(cte: str, source: str, value: str = "temperature") -> str:
    return f"""{cte}
    SELECT month_partition AS month, cast(machine_id AS VARCHAR) AS machine_id,
        {_average(value, "avg_temperature")}
    FROM {source}
    WHERE "timestamp" >= (SELECT max("timestamp") FROM {source}) - INTERVAL 3 MONTH
    GROUP BY ALL"""


def _exact(value: str) -> str:
    """The average of whole multiples of 2^-80, rounded as the states' places are."""
    units = f"sum(cast(trunc({value} * power(2::DOUBLE, 80)) AS HUGEINT))"
    high, low = f"({units} >> 48)", f"({units} & 281474976710655::HUGEINT)"
    return (
        f"(cast(cast({high} AS VARCHAR) AS DOUBLE) * power(2::DOUBLE, -32) "
        f"+ cast({low} AS DOUBLE) * power(2::DOUBLE, -80)) / count({value})"
    )


_TRAILING = " UNION ALL ".join(
    f"""SELECT end_at - {back} AS as_of, month_partition AS month,
        cast(machine_id AS VARCHAR) AS machine_id, {_exact("temperature")} AS avg_temperature
    FROM l, (SELECT max("timestamp") AS end_at FROM l)
    WHERE "timestamp" >= end_at - {back} - INTERVAL 3 MONTH
    GROUP BY ALL"""
    for back in (
        "INTERVAL 0 DAY",
        "(INTERVAL 37 DAY + INTERVAL 7 HOUR)",
        "(INTERVAL 800 DAY + INTERVAL 1 MINUTE)",
    )
)

# The spoiled rows, with what is to become of each text written out.
_SPOILED_CSV = f"""{_E}
    SELECT
        CASE event_id % 8 WHEN 0 THEN TIMESTAMP '2024-01-05 06:07:08' WHEN 1 THEN NULL
            WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE "timestamp" END AS "timestamp",
        CASE event_id % 8 WHEN 0 THEN 7 WHEN 1 THEN 12 WHEN 2 THEN NULL WHEN 3 THEN NULL
            WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN -1 ELSE machine_id END AS machine_id,
        CASE event_id % 8 WHEN 0 THEN 1000.0 WHEN 1 THEN 3.5 WHEN 2 THEN NULL WHEN 3 THEN NULL
            WHEN 4 THEN NULL WHEN 5 THEN cast('-0' AS DOUBLE) ELSE temperature END AS temperature,
        vibration, humidity, pressure, energy_consumption,
        CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 2 WHEN 3 THEN 4
            WHEN 4 THEN NULL ELSE cast(machine_status AS INTEGER) END AS machine_status,
        cast(anomaly_flag AS INTEGER) AS anomaly_flag,
        remaining_life AS predicted_remaining_life,
        CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'normal' WHEN 2 THEN 'Criticality'
            ELSE failure_type END AS failure_type,
        cast(downtime_risk AS INTEGER) AS downtime_risk,
        cast(maintenance_required AS INTEGER) AS maintenance_required
    FROM e JOIN events ON _id = cast(event_id AS VARCHAR)"""


def _spoiled(float_type: str = "DOUBLE", where: str = "true") -> str:
    """Cleaned readings of the spoiled documents."""
    return f"""{_E},
    typed AS (
        SELECT _id, event_id % 8 AS r,
            CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 3 THEN NULL
                WHEN 2 THEN TIMESTAMP '2024-01-05 06:07:08' ELSE "timestamp" END AS "timestamp",
            CASE event_id % 8 WHEN 0 THEN 12 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL
                WHEN 4 THEN NULL ELSE machine_id END AS machine_id,
            CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 5.5 WHEN 2 THEN NULL WHEN 3 THEN NULL
                WHEN 4 THEN NULL ELSE humidity END AS humidity,
            CASE event_id % 8 WHEN 5 THEN true WHEN 6 THEN NULL ELSE anomaly_flag END
                AS anomaly_flag,
            CASE event_id % 8 WHEN 6 THEN NULL ELSE remaining_life END AS remaining_life,
            CASE event_id % 8 WHEN 6 THEN NULL ELSE failure_code END AS failure_code,
            CASE event_id % 8 WHEN 6 THEN NULL ELSE temperature END AS temperature,
            vibration, pressure, energy_consumption, downtime_risk, machine_status,
            maintenance_required
        FROM e JOIN events ON _id = cast(event_id AS VARCHAR)
    )
    SELECT _id, "timestamp", anomaly_flag, failure_code, remaining_life, machine_id,
        machine_status, maintenance_required,
        {", ".join(f"cast({name} AS {float_type}) AS {name}" for name in _DOUBLES)},
        cast(date_trunc('month', "timestamp") AS DATE) AS month_partition
    FROM typed WHERE {where}"""


ORACLES: dict[str, str] = {
    "csv_ingest_dirty": _SPOILED_CSV,
    "clean_double_dirty": _spoiled(),
    "clean_float_dirty": _spoiled("FLOAT"),
    "table_dropped_nulls": _spoiled(where='"timestamp" IS NOT NULL'),
    "csv_ingest": f"""{_E}
        SELECT "timestamp", machine_id, temperature, vibration, humidity, pressure,
            energy_consumption, cast(machine_status AS INTEGER) AS machine_status,
            cast(anomaly_flag AS INTEGER) AS anomaly_flag,
            remaining_life AS predicted_remaining_life, failure_type,
            cast(downtime_risk AS INTEGER) AS downtime_risk,
            cast(maintenance_required AS INTEGER) AS maintenance_required
        FROM e""",
    "label_values": f"""{_E}
        SELECT 'Date: ' || strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp",
            'Machine_' || machine_id AS machine_id,
            'humid_value:' || cast(humidity AS VARCHAR) AS humidity
        FROM e""",
    "failure_code": f"""{_E}
        SELECT "timestamp", cast(machine_id AS VARCHAR) AS machine_id, failure_type,
            CASE failure_type WHEN 'Normal' THEN 0 WHEN 'Critical' THEN 1 ELSE 99 END
                AS failure_code
        FROM e""",
    "nest_readings": f"""{_E}
        SELECT 'Date: ' || strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp",
            'Machine_' || machine_id AS machine_id,
            cast(machine_status AS INTEGER) AS machine_status,
            cast(anomaly_flag AS INTEGER) AS anomaly_flag,
            remaining_life AS life_remaining,
            cast(failure_code AS INTEGER) AS failure_code,
            cast(downtime_risk AS INTEGER) AS downtime_risk,
            cast(maintenance_required AS INTEGER) AS maintenance_required,
            temperature, vibration, 'humid_value:' || cast(humidity AS VARCHAR) AS humidity,
            pressure, energy_consumption AS energy_use
        FROM e""",
    "document_scan": _cleaned(),
    "document_scan_inferred": _cleaned(),
    "document_scan_drift": _cleaned(),
    "table_machine": _daily(_L, "l"),
    "csv_quarantine": f"""{_E},
        judged AS (
            SELECT pressure, event_id % 8 AS r,
                CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'normal' WHEN 2 THEN 'Criticality'
                    ELSE failure_type END AS failure_type,
                CASE event_id % 8
                    WHEN 0 THEN 'machine_status=1e3'
                    WHEN 1 THEN 'timestamp=bad'
                    WHEN 3 THEN 'timestamp=2024-1-2 03:04'
                    WHEN 4 THEN 'timestamp=2024-13-01 00:00:00; machine_id=abc; '
                        || 'temperature=abc; machine_status=0x1'
                    WHEN 5 THEN 'machine_id=99999999999'
                END AS reasons
            FROM e JOIN events ON _id = cast(event_id AS VARCHAR)
        )
        SELECT reasons, pressure, failure_type,
            (SELECT count(*) FROM judged WHERE reasons IS NULL) AS typed_stored,
            (SELECT count(*) FROM judged) AS rows_seen,
            (SELECT count(*) FROM judged WHERE reasons IS NULL) AS typed_seen,
            (SELECT count(*) FROM judged WHERE reasons IS NOT NULL) AS rejected_seen,
            (SELECT count(*) FROM judged WHERE r IN (1, 3, 4)) AS timestamp_seen,
            (SELECT count(*) FROM judged WHERE r IN (4, 5)) AS machine_id_seen
        FROM judged WHERE reasons IS NOT NULL""",
    "clean_double": _cleaned(),
    "clean_float": _cleaned("FLOAT"),
    "table_scan": _cleaned(extra=("_id", "strftime(month_partition, '%Y%m') AS yyyymm")),
    "table_months": f"""{_L}
        SELECT strftime(month_partition, '%Y%m') AS yyyymm, count(*) AS readings,
            cast(max(temperature) AS FLOAT) AS max_temperature
        FROM l GROUP BY ALL""",
    "daily_averages": _daily(_E, "e"),
    "daily_averages_shipments": _daily(_L, "l"),
    "high_risk": f"""{_E}
        SELECT machine_id, remaining_life, machine_status, anomaly_flag
        FROM e WHERE remaining_life < 50 AND anomaly_flag""",
    "needs_maintenance": f"""{_E}
        SELECT machine_id, machine_status, maintenance_required
        FROM e WHERE maintenance_required""",
    "anomaly_summary": _anomalies(_L, "l"),
    "anomaly_summary_events": _anomalies(_E, "e"),
    "energy_efficiency": _energy(_E, "e"),
    "monthly_temp": _temperature(_L, "l"),
    "mv_anomaly": _anomalies(_L, "l"),
    "mv_energy": _energy(_L, "l"),
    "mv_monthly_temp": _temperature(_L, "l"),
    "state_anomaly": _anomalies(_L, "l", "DOUBLE"),
    "state_energy": _energy(_E, "e"),
    "state_temp": _temperature(_L, "l"),
    "state_energy_folded": _energy(_E, "e"),
    "ingest_run": _cleaned(extra=()),
    "state_anomaly_two_runs": _anomalies(_L, "l", "DOUBLE"),
    "native_run": _daily(_L, "l"),
    "native_energy": _energy(_E, "e"),
    "native_repeated": f"""{_L}
        SELECT cast(machine_id AS VARCHAR) AS machine_id, month_partition AS month,
            cast(count(*) FILTER (WHERE anomaly_flag) AS INTEGER) AS anomaly_count,
            count(*) AS readings
        FROM l GROUP BY ALL""",
    "views_one_scan": f"""{_L},
        recent AS ({_temperature("", "l").replace("round(", "(").replace(" + 1e-9, 6)", ")")})
        SELECT machine_id, max_energy, avg_energy, avg_machine_status,
            anomalies, months, round(avg_of_months + 1e-9, 6) AS avg_of_months,
            (SELECT count(*) FROM l) AS rows_read
        FROM ({_energy("", "l")}) e
        JOIN (
            SELECT cast(machine_id AS VARCHAR) AS machine_id,
                cast(count(*) FILTER (WHERE anomaly_flag) AS BIGINT) AS anomalies
            FROM l GROUP BY ALL
        ) USING (machine_id)
        LEFT JOIN (
            SELECT machine_id, count(*) AS months, avg(avg_temperature) AS avg_of_months
            FROM recent GROUP BY ALL
        ) USING (machine_id)""",
    "state_anomaly_compacted": _anomalies(_L, "l", "DOUBLE"),
    "state_anomaly_replayed": _anomalies(_L, "l", "DOUBLE"),
    "exact_energy": f"""{_L}
        SELECT cast(machine_id AS VARCHAR) AS machine_id, max(energy_consumption) AS max_energy,
            {_exact("energy_consumption")} AS avg_energy,
            {_exact("cast(machine_status AS DOUBLE)")} AS avg_machine_status
        FROM l GROUP BY ALL""",
    "exact_temp": f"""{_L}
        SELECT month_partition AS month, cast(machine_id AS VARCHAR) AS machine_id,
            {_exact("temperature")} AS avg_temperature
        FROM l
        WHERE "timestamp" >= (SELECT max("timestamp") FROM l) - INTERVAL 3 MONTH
        GROUP BY ALL""",
    "temp_trailing": f"{_L} {_TRAILING}",
    "float_states": _temperature(_L, "l", "cast(cast(temperature AS FLOAT) AS DOUBLE)"),
}
