"""DuckDB SQL that computes every registered query from the given tables alone.

The common table expressions below build on one another: ``typed`` derives the
payment fields of each event, ``bus`` the delivered records, ``checked`` the
parsed and validated ones, ``payments`` the table. ``_with`` puts them before a
query.
"""

CLOCK = "TIMESTAMP '2024-02-01 00:00:00'"
AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"


# Currencies without, and with three, decimal places; and the secret that
# the deliveries are signed with. Given anew here, so that an error in the package shows.
ZERO_DECIMAL = (
    "bif", "clp", "djf", "gnf", "jpy", "kmf", "krw", "mga",
    "pyg", "rwf", "ugx", "vnd", "vuv", "xaf", "xof", "xpf",
)
THREE_DECIMAL = ("bhd", "jod", "kwd", "omr", "tnd")
SECRET = b"whsec_fixture_only"
HASH_BLOCK = 64


def _pad(value: int) -> bytes:
    """The secret, filled up to a hash block, xored with a byte (RFC 2104)."""
    repeated = int.from_bytes(bytes([value]) * HASH_BLOCK, "big")
    secret = int.from_bytes(SECRET, "big") << 8 * (HASH_BLOCK - len(SECRET))
    return (secret ^ repeated).to_bytes(HASH_BLOCK, "big")


def _list(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


EVENT_TYPES = (
    "'payment_intent.succeeded', 'payment_intent.payment_failed', "
    "'payment_intent.processing', 'payment_intent.canceled'"
)

FIELDS = (
    "event_id, event_type, payment_id, amount_minor, currency, payment_status, description, "
    "customer_id, livemode, provider_created_at, received_at, source"
)


def _json(names: str) -> str:
    pairs = ", ".join(f"'{name.strip()}', {name.strip()}" for name in names.split(","))
    return f"json_object({pairs})"


TYPED = """
typed AS (
  SELECT n, f, n % 25 AS g, ts, epoch_us(ts) // 1000000 AS secs,
    CASE WHEN f = 0 THEN '  ' ELSE 'evt_' || n END AS event_id,
    CASE WHEN f = 6 THEN NULL ELSE CASE kind
      WHEN 'purchase' THEN 'payment_intent.succeeded'
      WHEN 'error' THEN 'payment_intent.payment_failed'
      WHEN 'view' THEN 'payment_intent.processing'
      WHEN 'click' THEN 'payment_intent.canceled'
      WHEN 'signup' THEN 'customer.created' END END AS event_type,
    CASE WHEN f = 1 THEN NULL ELSE 'pi_' || user_id || '_' || n END AS payment_id,
    CASE f WHEN 2 THEN NULL WHEN 3 THEN -1 WHEN 13 THEN 9000000000000000000
      ELSE CAST(round(value * 100) AS BIGINT) END AS amount_minor,
    CASE f WHEN 4 THEN 'us' WHEN 5 THEN NULL WHEN 13 THEN 'jpy' WHEN 15 THEN 'GBP '
      ELSE CASE n % 6 WHEN 0 THEN 'gbp' WHEN 1 THEN 'EUR' WHEN 2 THEN 'usd'
        WHEN 3 THEN 'jpy' WHEN 4 THEN 'kwd' ELSE 'GBP' END END AS currency,
    CASE WHEN f = 7 THEN '' ELSE CASE kind WHEN 'purchase' THEN 'succeeded'
      WHEN 'error' THEN 'requires_payment_method' WHEN 'view' THEN 'processing'
      ELSE 'canceled' END END AS payment_status,
    CASE WHEN n % 9 = 0 THEN NULL ELSE 'item ' || n END AS description,
    CASE WHEN user_id % 5 = 0 THEN NULL ELSE 'cus_' || user_id END AS customer_id,
    CASE WHEN f = 14 THEN NULL ELSE n % 2 = 0 END AS livemode,
    CASE f WHEN 8 THEN NULL WHEN 9 THEN -1 WHEN 17 THEN 300000000000
      ELSE epoch_us(ts) // 1000000 END AS provider_created_at,
    CASE f WHEN 10 THEN NULL WHEN 11 THEN 'not-a-time'
      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS received_at,
    'stripe' AS source
  FROM (SELECT event_id AS n, event_id % 50 AS f, event_type AS kind, ts, user_id, value
    FROM events)
)"""

BUS = f"""
delivered AS (
  SELECT *, 0 AS nth FROM typed
  UNION ALL
  SELECT * REPLACE ('redelivery' AS description), 1 AS nth FROM typed WHERE n % 20 = 16
),
bus AS (
  SELECT *, CAST(n AS VARCHAR) AS kafka_key,
    CASE WHEN f = 12 THEN '{{"event_id": "trunc' ELSE CAST({_json(FIELDS)} AS VARCHAR) END
      AS raw_value,
    ts + nth * INTERVAL 1 MINUTE AS kafka_timestamp,
    CAST(n % 3 AS INTEGER) AS kafka_partition,
    2 * (n // 3) + nth AS kafka_offset
  FROM delivered
)"""

_NULL_IF_CUT = ", ".join(
    f"CASE WHEN f = 12 THEN NULL ELSE {name.strip()} END AS {name.strip()}"
    for name in FIELDS.split(",")
)

CHECKED = f"""
parsed AS (
  SELECT n, f, nth, kafka_key, raw_value, kafka_timestamp, kafka_partition, kafka_offset,
    {_NULL_IF_CUT}
  FROM bus
),
normal AS (
  SELECT * REPLACE (lower(trim(currency)) AS currency),
    CASE WHEN provider_created_at BETWEEN 0 AND 253402300799
      THEN make_timestamp(provider_created_at * 1000000) END AS event_time,
    TRY_CAST(replace(received_at, 'Z', '') AS TIMESTAMP) AS received_at_ts,
    event_type = 'payment_intent.succeeded' AS is_successful,
    CASE WHEN lower(trim(currency)) IN ({_list(ZERO_DECIMAL)}) THEN 1
      WHEN lower(trim(currency)) IN ({_list(THREE_DECIMAL)}) THEN 1000 ELSE 100 END AS divisor
  FROM parsed
),
priced AS (
  SELECT *, TRY_CAST(CAST(amount_minor AS DECIMAL(19,0)) * CAST(CASE divisor
    WHEN 1 THEN 1.000 WHEN 1000 THEN 0.001 ELSE 0.010 END AS DECIMAL(4,3))
    AS DECIMAL(18,3)) AS amount_major
  FROM normal
),
checked AS (
  SELECT *, {CLOCK} AS processed_at, concat_ws('; ',
    CASE WHEN event_id IS NULL OR trim(event_id) = '' THEN 'missing event_id' END,
    CASE WHEN payment_id IS NULL OR trim(payment_id) = '' THEN 'missing payment_id' END,
    CASE WHEN amount_minor IS NULL THEN 'missing amount_minor' END,
    CASE WHEN amount_minor < 0 THEN 'amount_minor must be non-negative' END,
    CASE WHEN currency IS NULL OR length(currency) <> 3
      THEN 'currency must contain three characters' END,
    CASE WHEN event_type IS NULL OR trim(event_type) = '' THEN 'missing event_type' END,
    CASE WHEN event_type NOT IN ({EVENT_TYPES}) THEN 'unsupported event_type' END,
    CASE WHEN payment_status IS NULL OR trim(payment_status) = ''
      THEN 'missing payment_status' END,
    CASE WHEN provider_created_at IS NULL THEN 'missing provider_created_at' END,
    CASE WHEN provider_created_at < 0 THEN 'provider_created_at must be non-negative' END,
    CASE WHEN received_at IS NULL THEN 'missing received_at' END,
    CASE WHEN provider_created_at > 253402300799 THEN 'invalid provider_created_at' END,
    CASE WHEN received_at IS NOT NULL AND received_at_ts IS NULL THEN 'invalid received_at' END,
    CASE WHEN amount_minor IS NOT NULL AND amount_major IS NULL THEN 'amount out of range' END,
    CASE WHEN livemode IS NULL THEN 'missing livemode' END) AS rejection_reason
  FROM priced
)"""

VALID_COLUMNS = (
    "event_id, payment_id, event_type, amount_minor, amount_major, currency, payment_status, "
    "description, customer_id, livemode, is_successful, event_time, received_at, processed_at, "
    "source"
)
TABLE_COLUMNS = VALID_COLUMNS.replace("source", "raw_event")

RAW_EVENT = _json(VALID_COLUMNS)
for _name in ("event_time", "received_at", "processed_at"):
    RAW_EVENT = RAW_EVENT.replace(
        f"'{_name}', {_name}", f"'{_name}', strftime({_name}, '%Y-%m-%dT%H:%M:%S.%fZ')"
    )
RAW_EVENT = RAW_EVENT.replace(
    "'amount_major', amount_major", "'amount_major', CAST(amount_major AS VARCHAR)"
)


def _payments(name: str, order: str, where: str = "true") -> str:
    """A table of accepted payments that keeps one delivery per key."""
    return f"""
{name} AS (
  SELECT *, CAST({RAW_EVENT} AS VARCHAR) AS raw_event,
    CAST(event_time AS DATE) AS event_day
  FROM (
    SELECT * EXCLUDE (received_at, received_at_ts), received_at_ts AS received_at
    FROM checked WHERE rejection_reason = '' AND {where}
    QUALIFY row_number() OVER (PARTITION BY event_id
      ORDER BY kafka_timestamp {order}, kafka_partition, kafka_offset) = 1)
)"""


PAYMENTS = _payments("payments", "ASC")
MERGED = _payments("merged", "DESC")

REJECTED = (
    "SELECT CAST(processed_at AS DATE) AS rejection_date, rejection_reason, raw_value, kafka_key, "
    "kafka_timestamp, kafka_partition, kafka_offset, processed_at "
    "FROM checked WHERE rejection_reason <> ''"
)


def _with(body: str, *parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body


def _checked(body: str) -> str:
    return _with(body, TYPED, BUS, CHECKED)


def _stored(body: str) -> str:
    return _with(body, TYPED, BUS, CHECKED, PAYMENTS)


AMOUNT = "CAST(coalesce(sum(amount_major) FILTER (WHERE is_successful), 0) AS DECIMAL(38,3))"

# Exact mean, rounded half up to six places in whole numbers.
_SUM_MILLI = "CAST(coalesce(sum(amount_major) FILTER (WHERE is_successful), 0) * 1000 AS HUGEINT)"
_SUCCESSES = "count(*) FILTER (WHERE is_successful)"
MEAN = (
    f"CAST(CASE WHEN {_SUCCESSES} = 0 THEN 0 ELSE "
    f"CAST((2000 * {_SUM_MILLI} + {_SUCCESSES}) // (2 * {_SUCCESSES}) AS DECIMAL(32,0)) "
    "* CAST(0.000001 AS DECIMAL(6,6)) END AS DECIMAL(38,6))"
)
HEADLINE = (
    f"count(*) AS total_events, {_SUCCESSES} AS successful_events, "
    "count(*) FILTER (WHERE NOT is_successful) AS unsuccessful_events, "
    f"{AMOUNT} AS successful_amount, {MEAN} AS average_successful_amount"
)
RATE = (
    f"CASE WHEN count(*) > 0 THEN CAST({_SUCCESSES} AS DOUBLE) / count(*) * 100 ELSE 0.0 END"
)


def _money(amount: str) -> str:
    symbol = (
        "CASE currency WHEN 'gbp' THEN '£' WHEN 'eur' THEN '€' WHEN 'usd' THEN '$' "
        "WHEN 'jpy' THEN '¥' ELSE upper(currency) || ' ' END"
    )
    value = f"CAST({amount} AS DOUBLE)"
    return (
        f"{symbol} || CASE WHEN currency IN ({_list(ZERO_DECIMAL)}) "
        f"THEN format('{{:,.0f}}', {value}) "
        f"WHEN currency IN ({_list(THREE_DECIMAL)}) THEN format('{{:,.3f}}', {value}) "
        f"ELSE format('{{:,.2f}}', {value}) END"
    )


RECENT = (
    "SELECT event_time, event_type, payment_id, payment_status, amount_major, description, "
    "is_successful, event_id, currency FROM payments WHERE currency = 'gbp' "
    "ORDER BY event_time DESC, event_id LIMIT 25"
)
LIVE = (
    "SELECT date_trunc('{width}', event_time) AS window_start, currency, "
    "count(*) AS event_count, count(*) FILTER (WHERE is_successful) AS successful_count, "
    f"{AMOUNT} AS successful_amount FROM payments GROUP BY ALL"
)

NOT_NULL = (
    "payment_id event_type amount_minor amount_major currency payment_status livemode "
    "is_successful event_time received_at processed_at raw_event"
).split()
CONTRACT_REPORT = " UNION ALL ".join(
    [
        "SELECT 'event_id PRIMARY KEY' AS constraint_name, count(*) AS violations FROM "
        "(SELECT event_id FROM loose GROUP BY event_id HAVING count(*) > 1 OR event_id IS NULL)"
    ]
    + [
        f"SELECT '{name} NOT NULL', count(*) FILTER (WHERE {name} IS NULL) FROM loose"
        for name in NOT_NULL
    ]
    + [
        f"SELECT '{name} >= 0', count(*) FILTER (WHERE {name} < 0) FROM loose"
        for name in ("amount_minor", "amount_major")
    ]
    + ["SELECT 'currency VARCHAR(3)', count(*) FILTER (WHERE length(currency) > 3) FROM loose"]
)
LOOSE = f"""
loose AS (
  SELECT *, CAST({RAW_EVENT} AS VARCHAR) AS raw_event
  FROM (SELECT * EXCLUDE (received_at, received_at_ts), received_at_ts AS received_at FROM checked)
)"""


def _webhook() -> str:
    """Signed deliveries, and what becomes of each."""
    ipad, opad = (f"unhex('{_pad(value).hex()}')" for value in (0x36, 0x5C))

    def document(payment: str) -> str:
        return (
            "CAST(json_object('id', event_id, 'object', 'event', 'type', event_type, 'created', "
            "provider_created_at, 'livemode', livemode, 'data', json_object('object', "
            f"{payment}), 'pending_webhooks', 1) AS VARCHAR)"
        )

    def payment(customer: str, currency: str = "'currency', currency, ") -> str:
        return (
            "json_object('id', payment_id, 'object', 'payment_intent', 'amount', amount_minor, "
            f"{currency}'status', payment_status, 'description', description, "
            f"'customer', {customer})"
        )

    expanded = "json_object('id', customer_id, 'object', 'customer')"
    return f"""
bodies AS (
  SELECT *, CASE g WHEN 2 THEN '{{broken ' || n WHEN 4 THEN {document(payment(expanded))}
    WHEN 5 THEN {document("NULL")} WHEN 6 THEN {document(payment("customer_id", ""))}
    ELSE {document(payment("customer_id"))} END AS body
  FROM typed
),
digests AS (
  SELECT *, sha256({opad} || unhex(sha256({ipad} || encode(secs || '.' || body)))) AS digest
  FROM bodies
),
deliveries AS (
  SELECT *, CASE g WHEN 0 THEN NULL WHEN 1 THEN 't=' || secs || ',v1=' || repeat('0', 64)
      WHEN 3 THEN 't=' || secs || ',v1=' || repeat('0', 64) || ',v1=' || digest
      ELSE 't=' || secs || ',v1=' || digest END AS sig_header,
    CASE g WHEN 0 THEN 'missing_signature' WHEN 1 THEN 'invalid_signature' ELSE 'ok' END
      AS signature_status
  FROM digests
),
routed AS (
  SELECT *, CASE WHEN signature_status <> 'ok' THEN signature_status
    WHEN g = 2 THEN 'invalid_json'
    WHEN event_type IN ({EVENT_TYPES}) THEN 'publish' ELSE 'ignored' END AS route
  FROM deliveries
),
mapped AS (
  SELECT n, route, event_id, event_type,
    CASE WHEN g = 5 THEN NULL ELSE payment_id END AS payment_id,
    CASE WHEN g = 5 THEN 0 ELSE coalesce(amount_minor, 0) END AS amount_minor,
    CASE WHEN g IN (5, 6) THEN '' ELSE lower(coalesce(currency, '')) END AS currency,
    CASE WHEN g = 5 THEN 'unknown' ELSE payment_status END AS payment_status,
    CASE WHEN g = 5 THEN NULL ELSE description END AS description,
    CASE WHEN g = 5 THEN NULL
      WHEN g = 4 AND customer_id IS NULL THEN '{{"id":null,"object":"customer"}}'
      ELSE customer_id END AS customer_id,
    coalesce(livemode, false) AS livemode,
    coalesce(provider_created_at, 0) AS provider_created_at,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS received_at, source
  FROM routed
),
ingested AS (
  SELECT *, CASE WHEN route <> 'publish' THEN route
    WHEN event_id IS NULL OR payment_id IS NULL OR amount_minor < 0 OR length(currency) <> 3
      OR provider_created_at < 0 THEN 'contract_violation' ELSE 'published' END AS ingest_status
  FROM mapped
)"""


CONTRACT_CHECK = f"""
SELECT n, concat_ws('; ',
  CASE WHEN event_type IS NULL THEN 'event_type is required' END,
  CASE WHEN payment_id IS NULL THEN 'payment_id is required' END,
  CASE WHEN amount_minor IS NULL THEN 'amount_minor must be an integer' END,
  CASE WHEN amount_minor < 0 THEN 'amount_minor must be at least 0' END,
  CASE WHEN currency IS NULL OR length(currency) <> 3 THEN 'currency must have length 3' END,
  CASE WHEN livemode IS NULL THEN 'livemode must be a boolean' END,
  CASE WHEN provider_created_at IS NULL THEN 'provider_created_at must be an integer' END,
  CASE WHEN provider_created_at < 0 THEN 'provider_created_at must be at least 0' END,
  CASE WHEN TRY_CAST(replace(received_at, 'Z', '') AS TIMESTAMP) IS NULL
    THEN 'received_at must be a timestamp' END,
  CASE WHEN n % 7 = 3 THEN 'unexpected fields' END) AS contract_violation
FROM typed"""

STREAM_LATE = """
, accepted AS (
  SELECT *, n % 40 = 17 AS delayed FROM payments
),
mark AS (
  SELECT max(event_time) FILTER (WHERE NOT delayed) - INTERVAL 1 DAY AS watermark FROM accepted
)
SELECT CAST(event_time AS DATE) AS event_day,
  count(*) FILTER (WHERE NOT delayed) AS on_time,
  count(*) FILTER (WHERE delayed AND event_time > (SELECT watermark FROM mark)) AS late_admitted,
  count(*) FILTER (WHERE delayed AND event_time <= (SELECT watermark FROM mark)) AS late_dropped
FROM accepted GROUP BY ALL"""


def sql() -> dict[str, str]:
    """Oracle per query name."""
    webhook = _webhook()
    trace = "kafka_key, raw_value, kafka_timestamp, kafka_partition, kafka_offset"
    valid = f"SELECT {VALID_COLUMNS} FROM payments"
    table = f"SELECT {TABLE_COLUMNS}, event_day"
    merged = _with(f"SELECT {TABLE_COLUMNS} FROM merged", TYPED, BUS, CHECKED, MERGED)
    merged_table = _with(f"{table} FROM merged", TYPED, BUS, CHECKED, MERGED)
    live_merged = LIVE.replace("FROM payments", "FROM merged")
    windows = {
        width: _with(live_merged.format(width=width), TYPED, BUS, CHECKED, MERGED)
        for width in ("hour", "day")
    }
    envelope = _with(f"SELECT {trace} FROM bus", TYPED, BUS)
    record = "SELECT kafka_key, kafka_offset,"
    published = _with(
        f"SELECT event_id AS key, CAST({_json(FIELDS)} AS VARCHAR) AS value "
        "FROM ingested WHERE ingest_status = 'published'",
        TYPED,
        webhook,
    )
    return {
        "fixture_payments": _with(f"SELECT n, {FIELDS} FROM typed", TYPED),
        "publish_records": _with(
            f"SELECT event_id AS key, CAST({_json(FIELDS)} AS VARCHAR) AS value FROM typed", TYPED
        ),
        "envelope_decode": envelope,
        "offset_gaps": _with(
            "SELECT 'payment_events' AS topic, partition, before + 1 AS first_missing, "
            "kafka_offset - 1 AS last_missing, kafka_offset - before - 1 AS missing FROM ("
            "SELECT kafka_partition AS partition, kafka_offset, lag(kafka_offset) OVER "
            "(PARTITION BY kafka_partition ORDER BY kafka_offset) AS before FROM bus) "
            "WHERE kafka_offset - before > 1",
            TYPED,
            BUS,
        ),
        "stream_source": envelope,
        "parse_contract": _checked(f"SELECT {trace}, {FIELDS} FROM parsed"),
        "minor_unit_divisor": _checked(f"{record} currency, divisor FROM normal"),
        "amount_major": _checked(f"{record} amount_minor, currency, amount_major FROM priced"),
        "event_time": _checked(f"{record} provider_created_at, event_time FROM normal"),
        "received_at": _checked(f"{record} received_at, received_at_ts FROM normal"),
        "validate_reasons": _checked(
            f"{record} rejection_reason, rejection_reason = '' AS is_valid FROM checked"
        ),
        "reject_reason_counts": _checked(
            "SELECT rejection_reason, count(*) AS record_count FROM checked GROUP BY ALL"
        ),
        "dedup_first": _stored(f"SELECT event_id, description, {trace} FROM payments"),
        "valid_records": _stored(valid),
        "rejected_records": _checked(REJECTED),
        "raw_event_json": _stored("SELECT event_id, raw_event FROM payments"),
        "upsert_merge": merged,
        "table_upsert": merged_table,
        "table_contract": _with(CONTRACT_REPORT, TYPED, BUS, CHECKED, LOOSE),
        "quality_metrics": _checked(
            "SELECT count(*) AS input_rows, "
            "count(*) FILTER (WHERE rejection_reason = '') AS valid_rows, "
            "count(*) FILTER (WHERE rejection_reason <> '') AS rejected_rows, "
            "count(DISTINCT event_id) FILTER (WHERE rejection_reason = '') AS stored_rows "
            "FROM checked"
        ),
        "currencies": _stored("SELECT DISTINCT currency FROM payments ORDER BY currency"),
        "default_currency": _stored(
            "SELECT currency FROM (SELECT DISTINCT currency FROM payments) "
            "ORDER BY currency <> 'gbp', currency LIMIT 1"
        ),
        "summary": _stored(f"SELECT {HEADLINE} FROM payments WHERE currency = 'gbp'"),
        "summary_by_currency": _stored(
            f"SELECT currency, {HEADLINE} FROM payments GROUP BY currency"
        ),
        "success_rate": _stored(
            f"SELECT currency, {RATE} AS success_rate FROM payments GROUP BY currency"
        ),
        "summary_display": _stored(
            "SELECT currency, format('{:,}', count(*)) AS total_events, "
            f"format('{{:,}}', {_SUCCESSES}) AS successful, "
            "format('{:,}', count(*) FILTER (WHERE NOT is_successful)) AS other_states, "
            f"format('{{:.1f}}', {RATE}) || '%' AS success_rate, "
            f"{_money(AMOUNT)} AS successful_amount FROM payments GROUP BY currency"
        ),
        "status_breakdown": _stored(
            "SELECT payment_status, count(*) AS event_count FROM payments "
            "WHERE currency = 'gbp' GROUP BY payment_status "
            "ORDER BY event_count DESC, payment_status"
        ),
        "hourly_activity": _stored(
            "SELECT date_trunc('hour', event_time) AS hour, count(*) AS event_count, "
            f"{AMOUNT} AS successful_amount FROM payments WHERE currency = 'gbp' "
            f"AND event_time >= {AS_OF} - INTERVAL 24 HOURS GROUP BY ALL ORDER BY hour"
        ),
        "daily_summary": _stored(
            "SELECT date_trunc('day', event_time)::TIMESTAMP AS payment_day, currency, "
            "count(*) AS event_count, "
            f"{_SUCCESSES} AS successful_count, {AMOUNT} AS successful_amount "
            "FROM payments GROUP BY ALL"
        ),
        "recent_payments": _stored(f"SELECT * EXCLUDE (event_id, currency) FROM ({RECENT})"),
        "recent_display": _stored(
            "SELECT * EXCLUDE (amount_major, event_id, currency), "
            f"{_money('amount_major')} AS amount FROM ({RECENT})"
        ),
        "format_money": _stored(
            f"SELECT event_id, currency, {_money('amount_major')} AS amount FROM payments"
        ),
        "dashboard_bundle": _stored(
            "SELECT 'summary' AS section, 'gbp' AS label, count(*) AS event_count, "
            f"{AMOUNT} AS amount FROM payments WHERE currency = 'gbp' UNION ALL "
            "SELECT 'status', payment_status, count(*), CAST(NULL AS DECIMAL(38,3)) "
            "FROM payments WHERE currency = 'gbp' GROUP BY payment_status UNION ALL "
            "SELECT 'hour', strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M:%S'), "
            f"count(*), {AMOUNT} FROM payments WHERE currency = 'gbp' "
            f"AND event_time >= {AS_OF} - INTERVAL 24 HOURS "
            "GROUP BY date_trunc('hour', event_time) UNION ALL "
            "SELECT 'recent', payment_id, CAST(NULL AS BIGINT), "
            f"CAST(amount_major AS DECIMAL(38,3)) FROM ({RECENT})"
        ),
        "webhook_signature": _with(
            "SELECT body, sig_header, ts AS arrived_at, signature_status FROM deliveries",
            TYPED,
            webhook,
        ),
        "webhook_route": _with("SELECT body, ts AS arrived_at, route FROM routed", TYPED, webhook),
        "webhook_map": _with(
            f"SELECT {FIELDS} FROM mapped WHERE route = 'publish'", TYPED, webhook
        ),
        "webhook_outcomes": _with(
            "SELECT ingest_status, count(*) AS delivery_count FROM ingested GROUP BY ALL",
            TYPED,
            webhook,
        ),
        "webhook_publish": published,
        "stream_ingest": published,
        "stream_deliveries": _with(
            "SELECT ingest_status, count(*) AS delivery_count FROM ingested GROUP BY ALL",
            TYPED,
            webhook,
        ),
        "contract_check": _with(CONTRACT_CHECK, TYPED),
        "stream_valid": _stored(valid),
        "stream_dedup": _stored(f"{table} FROM payments"),
        "stream_late": _stored("").rstrip() + STREAM_LATE,
        "stream_late_safe": merged_table,
        "stream_upsert": _stored(f"{table} FROM payments"),
        "stream_rejected": _checked(REJECTED),
        "stream_fanout": _stored(
            "SELECT 'payments' AS sink, count(*) AS row_count FROM payments UNION ALL "
            "SELECT 'rejected', count(*) FROM checked WHERE rejection_reason <> ''"
        ),
        "stream_hourly": _stored(LIVE.format(width="hour")),
        "stream_daily": _stored(LIVE.format(width="day")),
        "stream_windows_hourly": windows["hour"],
        "stream_windows_daily": windows["day"],
    }
