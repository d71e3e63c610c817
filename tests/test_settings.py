import pytest

from centstream.contract import EVENT_COLUMNS, TABLE_COLUMNS, VALID_COLUMNS
from centstream.session import new_folder, shared_root
from centstream.settings import JobSettings
from centstream.sources import bus
from centstream.sources.jdbc import JdbcPayments
from centstream.sources.payments import PaymentsTable
from centstream.streaming.job import payments_sink

ENV = {
    "KAFKA_BOOTSTRAP_SERVERS": "broker:9092",
    "PAYMENTS_TABLE_PATH": "/t",
    "REJECTED_PATH": "/r",
    "CHECKPOINT_ROOT": "/c",
    "JDBC_PASSWORD": "hidden",
}


def test_settings_from_environment():
    made = JobSettings.from_environment(ENV | {"MAX_OFFSETS_PER_TRIGGER": "500"})
    assert (made.topic, made.watermark, made.max_offsets_per_trigger) == (
        "payment_events",
        "1 day",
        500,
    )
    assert made.key_scope == "table"
    assert "hidden" not in repr(made)


@pytest.mark.parametrize("name", [n for n in ENV if n != "JDBC_PASSWORD"])
def test_required_settings(name):
    with pytest.raises(KeyError):
        JobSettings.from_environment({k: v for k, v in ENV.items() if k != name})


def test_no_password_by_default():
    env = {k: v for k, v in ENV.items() if k != "JDBC_PASSWORD"}
    assert JobSettings.from_environment(env).jdbc_password is None


def test_sink_follows_the_settings(spark):
    files = JobSettings.from_environment(ENV)
    assert isinstance(payments_sink(spark, files), PaymentsTable)
    database = JobSettings.from_environment(ENV | {"JDBC_URL": "jdbc:x", "JDBC_USER": "u"})
    assert isinstance(payments_sink(spark, database), JdbcPayments)
    with pytest.raises(ValueError):
        payments_sink(spark, JobSettings.from_environment(ENV | {"JDBC_URL": "jdbc:x"}))


def test_kafka_options():
    assert bus.kafka_options("b:1", "t") == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    wider = bus.kafka_options("b:1", "t", 10, 400)
    assert (wider["maxOffsetsPerTrigger"], wider["minPartitions"]) == ("10", "400")


def test_column_lists():
    assert (len(EVENT_COLUMNS), len(VALID_COLUMNS), len(TABLE_COLUMNS)) == (12, 15, 15)
    assert TABLE_COLUMNS[4] == "amount_major"


def test_table_refuses_another_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            PaymentsTable(spark, "/nowhere")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_session_is_utc_and_shared_folder_is_the_configured_one(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")
