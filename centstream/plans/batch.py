"""The batch form of the job: bus records to a payments table."""

from pyspark.sql import Column, DataFrame, SparkSession

from centstream.operators.parse import decode_envelope, parse_contract
from centstream.operators.route import valid_records
from centstream.operators.validate import enrich_and_validate
from centstream.sources.payments import PaymentsTable


def check_records(bus: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Decoded, parsed and validated records, from a table or a stream."""
    return enrich_and_validate(parse_contract(decode_envelope(bus)), processed_at)


def payments_of(bus: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Valid payments of a batch of bus records, each key once."""
    return valid_records(check_records(bus, processed_at))


def load_table(
    spark: SparkSession, root: str, bus: DataFrame, processed_at: Column | None = None
) -> PaymentsTable:
    """Upsert a batch of bus records into the table at ``root``."""
    table = PaymentsTable(spark, root)
    table.upsert(payments_of(bus, processed_at), unique=True)
    return table
