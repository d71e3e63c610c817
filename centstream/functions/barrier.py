"""Keeping costly expressions from being evaluated more than once."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(*columns: Column) -> Column:
    """Columns computed once per row, however often they are read afterwards.

    Spark pushes a filter below a projection by copying the projected
    expressions into it, so a filter on ten fields of parsed JSON parses ten
    times. A generator stops that. Use as ``df.select("*", once(a, b))``.
    """
    return F.inline(F.array(F.struct(*columns)))
