"""Clock columns. All of them need the session time zone to be UTC."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Last second of the year 9999: the largest instant Python and SQL clients can hold.
LAST_EPOCH_SECOND = 253402300799

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def event_time(epoch_seconds: Column) -> Column:
    """Instant of an epoch second; null outside the years 1970 to 9999."""
    in_range = epoch_seconds.between(0, LAST_EPOCH_SECOND)
    return F.when(in_range, F.timestamp_seconds(epoch_seconds))


def parse_iso(text: Column) -> Column:
    """Instant of an ISO-8601 text; null when it does not parse.

    A text must open with a four-digit year: a bare time such as ``12:30``
    would otherwise be read as today's.
    """
    return F.when(text.rlike(r"^\d{4}(-|$)"), F.try_to_timestamp(text))


def iso_utc(instant: Column) -> Column:
    """ISO-8601 text with six fractional digits and ``Z``."""
    return F.date_format(instant, ISO_MICROS)
