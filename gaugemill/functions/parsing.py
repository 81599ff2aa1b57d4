"""Text to values. Bad text gives NULL and never fails a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms found in the readings.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_LABEL = "Date: "
HUMIDITY_LABEL = "humid_value:"
MACHINE_LABEL = "Machine_"
MACHINE_PATTERN = r"Machine_(\d+)"

# Casts ignore blanks and control characters around a number.
_PADDING = r"[\x00-\x20\x7f]*"
_WHOLE = rf"^{_PADDING}[+-]?0*\d{{1,10}}(\.\d*)?{_PADDING}$"
_FRACTION = rf"^{_PADDING}[+-]?\.\d*{_PADDING}$"


def text_to_int(text: Column) -> Column:
    """Text to int, cutting off decimals: ``'-1.9'`` is -1, ``'.5'`` is 0.

    ``try_cast`` alone rejects decimals, and a detour through double would accept ``1e3``.
    The patterns come first because each text that ``try_cast`` rejects costs an exception,
    many times the price of a match.
    """
    whole = F.substring_index(text, ".", 1).try_cast("int")
    return F.when(text.rlike(_WHOLE), whole).when(text.rlike(_FRACTION), 0)


def parse_timestamp(text: Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    return F.try_to_timestamp(text, F.lit(fmt))


def strip_label(text: Column, label: str) -> Column:
    """Remove a literal label wherever it stands."""
    return F.replace(text, F.lit(label), F.lit(""))


def machine_number(text: Column) -> Column:
    """The number after the first machine label anywhere in the text; NULL without one."""
    numbers = F.regexp_extract_all(text, F.lit(MACHINE_PATTERN), F.lit(1))
    return F.get(numbers, 0).try_cast("int")
