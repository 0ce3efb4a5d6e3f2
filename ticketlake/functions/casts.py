"""Casts that give NULL for text they cannot read, and read the same text everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# a full date, optionally followed by a time with at least hours and minutes
_TIMESTAMP_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:.*)?$"
# Spark reads Java's float suffixes as part of the number
_FLOAT_SUFFIX = r"(?i)[0-9.][df]\s*$"


def to_bigint(text: Column) -> Column:
    """Whole numbers as they are; decimal and exponent forms rounded half away from zero."""
    rounded = F.round(text.try_cast("decimal(38,10)"), 0).try_cast("bigint")
    return F.coalesce(text.try_cast("bigint"), rounded)


def to_timestamp(text: Column) -> Column:
    """Zone-less timestamp; a zone suffix is ignored, partial dates are NULL."""
    return F.when(text.rlike(_TIMESTAMP_SHAPE), text.try_cast("timestamp_ntz"))


def to_double(text: Column) -> Column:
    return F.when(~text.rlike(_FLOAT_SUFFIX), text.try_cast("double"))


def ntz(value) -> Column:
    """Zone-less timestamp literal from a naive datetime, ISO text or None."""
    text = None if value is None else str(value).replace("T", " ")
    return F.lit(text).cast("timestamp_ntz")
