"""Record shapes and fixed values shared by every stage."""

# Event types that count as payments.
SUCCEEDED = "payment_intent.succeeded"
PAYMENT_EVENT_TYPES = (
    "payment_intent.succeeded",
    "payment_intent.payment_failed",
    "payment_intent.processing",
    "payment_intent.canceled",
)

# Fixed value: provider tag carried by every event.
PROVIDER = "stripe"

# Raw webhook deliveries as they land, before anything is checked.
BRONZE_DDL = "body STRING, sig_header STRING, arrived_at TIMESTAMP"

# Columns of a bus record, as the Kafka source delivers them.
BUS_DDL = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP, timestampType INT"
)

# The flat event carried in a bus record's value.
EVENT_DDL = (
    "event_id STRING, event_type STRING, payment_id STRING, amount_minor BIGINT, "
    "currency STRING, payment_status STRING, description STRING, customer_id STRING, "
    "livemode BOOLEAN, provider_created_at BIGINT, received_at STRING, source STRING"
)

# A payment, less the tag of its provider.
PAYMENT_DDL = (
    "event_id STRING, payment_id STRING, event_type STRING, amount_minor BIGINT, "
    "amount_major DECIMAL(18,3), currency STRING, payment_status STRING, "
    "description STRING, customer_id STRING, livemode BOOLEAN, is_successful BOOLEAN, "
    "event_time TIMESTAMP, received_at TIMESTAMP, processed_at TIMESTAMP"
)

# A validated payment, as it leaves the stream.
VALID_DDL = PAYMENT_DDL + ", source STRING"

# The payments table: a payment plus its own JSON rendering.
TABLE_DDL = PAYMENT_DDL + ", raw_event STRING"

REJECT_DDL = (
    "rejection_reason STRING, raw_value STRING, kafka_key STRING, "
    "kafka_timestamp TIMESTAMP, kafka_partition INT, kafka_offset BIGINT, "
    "processed_at TIMESTAMP, rejection_date DATE"
)


def column_names(ddl: str) -> list[str]:
    """Column names of one of the DDL strings above."""
    outside_parens = ddl.replace("(18,3)", "")
    return [field.split()[0] for field in outside_parens.split(",")]


EVENT_COLUMNS = column_names(EVENT_DDL)
VALID_COLUMNS = column_names(VALID_DDL)
TABLE_COLUMNS = column_names(TABLE_DDL)
REJECT_COLUMNS = column_names(REJECT_DDL)
TRACE_COLUMNS = ["kafka_key", "raw_value", "kafka_timestamp", "kafka_partition", "kafka_offset"]
ARRIVAL_ORDER = ["kafka_timestamp", "kafka_partition", "kafka_offset"]
