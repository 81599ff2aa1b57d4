"""Sums of doubles that don't depend on order, as states to be merged.

A double is cut into whole numbers of fixed units, 2^40 down to 2^-80 in steps of 24 bits. Each
step is exact, and so are sums of whole numbers: the states of the same values are the same bit
by bit, whatever the partitions and inserts they came in, and so is the average read from them.
A sum takes 2^39 values and more. What is below 2^-80 is cut off value by value. Values of
2^64 or more, infinite ones and NaN are added up apart, as plain doubles.
"""

from __future__ import annotations

from pyspark.sql import types as T

from gaugemill.schemas import struct

_STEP = 24
_EXPONENTS = (40, 16, -8, -32, -56, -80)
_LIMIT = 2.0**64
_LAST = len(_EXPONENTS) - 1

EXACT = struct(
    **{f"s{i}": T.LongType() for i in range(len(_EXPONENTS))},
    beyond=T.DoubleType(),
    count=T.LongType(),
)


def _double(value: float) -> str:
    return f"{value!r}D"


def _part(value: str, place: int) -> str:
    """How many units of this place a double holds after those before it."""
    unit = _double(2.0 ** _EXPONENTS[place])
    before = f"({value}) % {_double(2.0 ** _EXPONENTS[place - 1])}" if place else f"({value})"
    return f"cast(({before} - ({value}) % {unit}) / {unit} AS bigint)"


def average_state(value: str) -> str:
    """SQL that aggregates doubles to a state."""
    within = f"abs({value}) < {_double(_LIMIT)}"
    sums = (
        f"'s{i}', sum(CASE WHEN {within} THEN {_part(value, i)} END)"
        for i in range(len(_EXPONENTS))
    )
    beyond = f"sum(CASE WHEN NOT ({within}) THEN {value} END)"
    return f"named_struct({', '.join(sums)}, 'beyond', {beyond}, 'count', count({value}))"


def combined_average(state: str) -> str:
    """SQL that aggregates states to one."""
    names = [field.name for field in EXACT]
    return f"named_struct({', '.join(f"'{name}', sum({state}.{name})" for name in names)})"


def total(state: str) -> str:
    """SQL for the sum in a state, as a double.

    Carries leave 24 bits in each place but the first. The places down to 2^-32 make one whole
    number, those below it another; both are rounded once, and so is their sum.
    """
    places = [f"coalesce({state}.s{i}, 0)" for i in range(len(_EXPONENTS))]
    for i in range(_LAST, 0, -1):
        places[i - 1] = f"({places[i - 1]} + shiftright({places[i]}, {_STEP}))"
        places[i] = f"({places[i]} & {(1 << _STEP) - 1})"
    high = " + ".join(
        f"cast({places[i]} AS decimal(20, 0)) * {1 << (_STEP * (3 - i))}BD" for i in range(4)
    )
    low = f"({places[4]} * {1 << _STEP}L + {places[5]})"
    return (
        f"(cast({high} AS double) * {_double(2.0**-32)} "
        f"+ cast({low} AS double) * {_double(2.0**-80)} + coalesce({state}.beyond, 0D))"
    )


def average(state: str) -> str:
    return f"try_divide({total(state)}, {state}.count)"
