"""Lenient conversions: a value that does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A cast to double also accepts Java suffixes such as "12d"; this does not.
_DECIMAL = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_INTEGER = r"^[+-]?\d+$"


def none_if_empty(value: Column) -> Column:
    """Empty text counts as absent."""
    return F.nullif(value, F.lit(""))


def first_present(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[none_if_empty(v) for v in values])


def lenient_long(value: Column) -> Column:
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def lenient_int(value: Column) -> Column:
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(_INTEGER), text.try_cast("int"))


def lenient_double(value: Column) -> Column:
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def lenient_timestamp(value: Column) -> Column:
    """ISO-8601 text with an offset or ``Z``; without one it is session time."""
    return F.try_to_timestamp(none_if_empty(value.cast("string")))


def latency_ms(value: Column) -> Column:
    """Seconds with an optional trailing ``s`` to milliseconds, 3 decimals."""
    seconds = lenient_double(F.regexp_replace(value.cast("string"), r"s\z", ""))
    return F.bround(seconds * F.lit(1000.0), 3)


def status_family(code: Column) -> Column:
    """``204`` becomes ``2xx``."""
    return F.concat(F.floor(code / F.lit(100)).cast("string"), F.lit("xx"))


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 where the whole is 0 or null."""
    return F.coalesce(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))
