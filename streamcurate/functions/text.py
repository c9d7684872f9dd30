"""Column expressions for the text rules of raw records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimal numbers as Python's float() takes them, without underscores.
FLOAT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"
INTEGER = r"^\s*[+-]?\d+\s*$"
BOOLEAN = r"(?i)^\s*(true|false)\s*$"
#: Extended ISO-8601 with an offset.
TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?(Z|[+-]\d{2}:\d{2})$"


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def to_double(c: Column) -> Column:
    # without these letters a cast takes just what the pattern does, and the pattern is dear
    return F.when(~c.rlike("[dDfFxX]") | c.rlike(FLOAT), F.trim(c).try_cast("double"))


def to_long(c: Column) -> Column:
    return F.when(c.rlike(INTEGER), F.trim(c).try_cast("long"))


def to_boolean(c: Column) -> Column:
    return F.when(c.rlike(BOOLEAN), F.lower(F.trim(c)) == "true")


def to_time(c: Column) -> Column:
    return F.when(c.rlike(TIMESTAMP), c.try_cast("timestamp"))


CASTS = {"float": to_double, "integer": to_long, "boolean": to_boolean, "datetime": to_time, "string": lambda c: c}


def is_finite(c: Column) -> Column:
    return ~(F.isnan(c) | (F.abs(c) == float("inf")))


def iso_utc(ts: Column) -> Column:
    """Canonical UTC text: six fractional digits only where there are microseconds."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
