"""The message bus: Kafka, or files holding the same columns."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from centstream.contract import BUS_DDL
from centstream.operators.publish import publish_records

# Delivery guarantees of the publishing side.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.compression.type": "snappy",
    "kafka.linger.ms": "20",
    "kafka.request.timeout.ms": "5000",
    "kafka.delivery.timeout.ms": "10000",
}


def kafka_options(
    servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    """Reader options: from the earliest record.

    Unless ``fail_on_data_loss`` is set, records that expired before they were read are
    passed over; ``offsets.offset_gaps`` over an archive of the topic shows which.
    ``min_partitions`` lets Spark cut a topic partition into ranges of offsets, so
    that the number of topic partitions does not limit the tasks, nor a full one
    hold up the rest.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    fail_on_data_loss: bool = False,
) -> DataFrame:
    """Live bus records. Set the limit, or the first batch is the whole backlog."""
    options = kafka_options(
        servers, topic, max_offsets_per_trigger, min_partitions, fail_on_data_loss
    )
    return spark.readStream.format("kafka").options(**options).load()


def kafka_batch(
    spark: SparkSession, servers: str, topic: str, min_partitions: int | None = None
) -> DataFrame:
    """All bus records there are now."""
    options = kafka_options(servers, topic, min_partitions=min_partitions)
    return spark.read.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Bus records archived as Parquet files, read as a stream."""
    reader = spark.readStream.schema(BUS_DDL)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def file_batch(spark: SparkSession, path: str) -> DataFrame:
    """Bus records archived as Parquet files."""
    return spark.read.schema(BUS_DDL).parquet(path)


def publish_batch(events: DataFrame, servers: str, topic: str) -> None:
    """Send events to the bus from the executors."""
    (
        publish_records(events)
        .write.format("kafka")
        .options(**PRODUCER_OPTIONS)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_stream(
    events: DataFrame, servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    """Keep sending events to the bus; a failed batch is sent again on restart."""
    return (
        publish_records(events)
        .writeStream.format("kafka")
        .options(**PRODUCER_OPTIONS)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
