"""Session set-up and the shared working folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")

BASE_CONF = {
    # Every clock expression here assumes UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Deduplication state on disk next to the executor instead of on its heap.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A document that repeats a field is read as its last value, as JSON readers do.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

_fallback: dict[str, str] = {}


def build_session(
    app: str, shuffle_partitions: int | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Session with the settings the job relies on.

    ``shuffle_partitions`` also fixes the number of state partitions of a stream
    for as long as its checkpoint lives, so size it for the cluster at first start.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in (BASE_CONF | (conf or {})).items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Refuse a session whose days and hours would not be those of UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone is {zone}; set it to UTC")


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's ``spark.checkpoint.dir``.

    Only where that is unset on a single machine, as in tests, is a temporary
    folder made; a cluster must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="centstream-")
    return _fallback[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder not used before, under the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
