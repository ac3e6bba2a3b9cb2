"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabsmith import fixed


def parse_datetime(c: Column, formats=fixed.DATE_FORMATS) -> Column:
    """First format that parses wins; text that parses with none becomes null.

    Each format is tried only on text of its shape, so free text and the other formats'
    dates never take the parser's exception path.
    """
    t = F.trim(c.cast("string"))
    tries = []
    for f in formats:
        attempt = F.try_to_timestamp(t, F.lit(f))
        shape = fixed.DATE_FORMAT_SHAPES.get(f)
        tries.append(F.when(t.rlike(shape), attempt) if shape else attempt)
    return F.coalesce(*tries)


def weekday_monday0(c: Column) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(c)
