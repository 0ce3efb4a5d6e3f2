"""Text standardisation used by staging."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def upper_trim(text: Column) -> Column:
    return F.upper(F.trim(text))


def postcode(text: Column) -> Column:
    """The five digits the trimmed text starts with, else NULL."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike("^[0-9]{5}"), F.substring(trimmed, 1, 5))


def category(text: Column, aliases: Mapping[str, str]) -> Column:
    """Upper-case and trim; blank becomes NULL, known aliases are spelled out, the rest stays."""
    clean = upper_trim(text)
    out = F.when(clean == "", F.lit(None).cast("string"))
    for alias, name in aliases.items():
        out = out.when(clean == alias, F.lit(name))
    return out.otherwise(clean)
