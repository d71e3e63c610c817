"""Bus record to typed columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centstream.contract import EVENT_DDL, TRACE_COLUMNS


def decode_envelope(bus: DataFrame) -> DataFrame:
    """Key and value as text, with the record's position and clock."""
    return bus.selectExpr(
        "CAST(key AS STRING) AS kafka_key",
        "CAST(value AS STRING) AS raw_value",
        "timestamp AS kafka_timestamp",
        "partition AS kafka_partition",
        "offset AS kafka_offset",
    )


def parse_contract(decoded: DataFrame) -> DataFrame:
    """Trace columns plus the twelve event columns; unreadable JSON gives nulls.

    The one-element ``inline`` is deliberate. A struct expanded by ``payload.*``
    lets the optimizer push the later validity filter below the projection and
    parse the JSON again for every rule that reads a field. A generator is a
    boundary for that push-down, so each value is parsed once.
    """
    payload = F.from_json("raw_value", EVENT_DDL)
    return decoded.select(*TRACE_COLUMNS, F.inline(F.array(payload)))
