from __future__ import annotations

import itertools
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gaugemill.functions.labels import failure_code, label, label_timestamp
from gaugemill.functions.parsing import (
    DATE_LABEL,
    HUMIDITY_LABEL,
    machine_number,
    parse_timestamp,
    strip_label,
    text_to_int,
)
from gaugemill.functions.timing import days_before, latest, month_start, months_before, year_month


def evaluate(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(value,) for value in values], f"x {kind}")
    return [row[0] for row in frame.select(expression(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "text, number",
    [
        ("0.37", 0),
        ("1.0", 1),
        ("-1.9", -1),
        (" 7 ", 7),
        ("1.", 1),
        (".5", 0),
        ("+3", 3),
        ("\t7.5\n", 7),
        ("-2147483648.9", -2147483648),
        ("1e3", None),
        ("NaN", None),
        ("99999999999", None),
        ("99999999999.5", None),
        ("abc", None),
        ("1.2.3", None),
        ("1 .5", None),
        ("+", None),
        ("", None),
        (None, None),
    ],
)
def test_text_to_int(spark, text, number):
    assert evaluate(spark, [text], text_to_int) == [number]


def test_text_to_int_equals_lenient_cast(spark, setting):
    signs = ["", "+", "-", "+-"]
    digits = ["", "0", "12", "007", "2147483647", "2147483648", "x"]
    decimals = ["", ".", ".0", ".99", ".9.9", ".x", "e2", ". 5"]
    padding = ["", " ", "\t", "\x00", "\x7f", " "]
    texts = [
        before + sign + whole + decimal + after
        for before, sign, whole, decimal, after in itertools.product(
            padding, signs, digits, decimals, padding
        )
    ]
    setting("spark.sql.ansi.enabled", "false")
    frame = spark.createDataFrame([(text,) for text in texts], "x string")
    wrong = frame.where(~F.col("x").cast("int").eqNullSafe(text_to_int(F.col("x"))))
    assert wrong.collect() == []


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Date: 2025-01-01 00:00:00", datetime(2025, 1, 1)),
        ("2025-01-01 10:20:30", datetime(2025, 1, 1, 10, 20, 30)),
        ("Date: bad", None),
        ("2025-1-2 03:04", None),
        ("2025-02-30 00:00:00", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, text, expected):
    parsed = evaluate(spark, [text], lambda x: parse_timestamp(strip_label(x, DATE_LABEL)))
    assert parsed == [expected]


def test_machine_number_is_a_search(spark):
    texts = ["Machine_12", "xMachine_12b", "M_1", "", None, "Machine_99999999999", "machine_1"]
    assert evaluate(spark, texts, machine_number) == [12, 12, None, None, None, None, None]


def test_humidity(spark):
    texts = ["humid_value:41.5", "41.5", "humid_value:", "humid_value:abc", None]
    values = evaluate(spark, texts, lambda x: strip_label(x, HUMIDITY_LABEL).try_cast("double"))
    assert values == [41.5, 41.5, None, None, None]


def test_labels_keep_null(spark):
    assert evaluate(spark, [7, None], lambda x: label("Machine_", x), "int") == ["Machine_7", None]
    times = [datetime(2025, 1, 1, 2, 3, 4, 567000), None]
    assert evaluate(spark, times, label_timestamp, "timestamp") == [
        "Date: 2025-01-01 02:03:04",
        None,
    ]


def test_failure_code(spark):
    texts = ["Normal", "Critical", "normal", "other", None]
    assert evaluate(spark, texts, failure_code) == [0, 1, 99, 99, 99]
    custom = evaluate(spark, ["a", "Normal"], lambda x: failure_code(x, {"a": 5}, -1))
    assert custom == [5, -1]


def test_month_buckets(spark):
    moments = [datetime(2025, 3, 31, 23, 59, 59), None]
    months = evaluate(spark, moments, month_start, "timestamp")
    assert months == [date(2025, 3, 1), None]
    assert evaluate(spark, months, year_month, "date") == ["202503", None]


@pytest.mark.parametrize(
    "as_of",
    [
        datetime(2025, 5, 31, 10),
        "2025-05-31 10:00:00",
        "expression",
        "frame",
    ],
)
def test_month_cutoff_is_clamped(spark, as_of):
    if as_of == "expression":
        as_of = F.lit("2025-05-31 10:00:00").cast("timestamp")
    elif as_of == "frame":
        moments = [(datetime(2025, 5, 31, 10),), (datetime(2024, 1, 1),), (None,)]
        as_of = latest(spark.createDataFrame(moments, "timestamp timestamp"))
    row = spark.range(1).select(months_before(as_of, 3), days_before(as_of, 45)).first()
    assert tuple(row) == (datetime(2025, 2, 28, 10), datetime(2025, 4, 16, 10))


def test_cutoff_defaults_to_now(spark):
    frame = spark.range(1).select(
        days_before(None, 1) == F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    )
    assert frame.first()[0]
