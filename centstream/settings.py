"""Settings of the streaming job, read from the environment."""

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from centstream.operators.route import WATERMARK
from centstream.sources.payments import KEY_SCOPES, WHOLE_TABLE


@dataclass(frozen=True)
class JobSettings:
    """Where the job reads and writes. Nothing secret has a default."""

    kafka_servers: str
    topic: str
    table_path: str
    rejected_path: str
    checkpoint_root: str
    log_level: str = "INFO"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    watermark: str = WATERMARK
    shuffle_partitions: int | None = None
    key_scope: str = WHOLE_TABLE
    tidy_every: int = 100
    late_safe: bool = False
    fail_on_data_loss: bool = False
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = field(default=None, repr=False)

    def __post_init__(self):
        if self.key_scope not in KEY_SCOPES:
            raise ValueError(f"KEY_SCOPE is {self.key_scope!r}; use one of {KEY_SCOPES}")

    @classmethod
    def from_environment(cls, env: Mapping[str, str] | None = None) -> "JobSettings":
        env = os.environ if env is None else env

        def number(name: str) -> int | None:
            return int(env[name]) if env.get(name) else None

        def switch(name: str) -> bool:
            return env.get(name, "false").lower() == "true"

        return cls(
            kafka_servers=env["KAFKA_BOOTSTRAP_SERVERS"],
            topic=env.get("KAFKA_TOPIC", "payment_events"),
            table_path=env["PAYMENTS_TABLE_PATH"],
            rejected_path=env["REJECTED_PATH"],
            checkpoint_root=env["CHECKPOINT_ROOT"],
            log_level=env.get("LOG_LEVEL", "INFO").upper(),
            max_offsets_per_trigger=number("MAX_OFFSETS_PER_TRIGGER"),
            min_partitions=number("MIN_PARTITIONS"),
            watermark=env.get("WATERMARK", WATERMARK),
            shuffle_partitions=number("SHUFFLE_PARTITIONS"),
            key_scope=env.get("KEY_SCOPE", WHOLE_TABLE),
            tidy_every=int(env.get("TIDY_EVERY", "100")),
            late_safe=switch("LATE_SAFE"),
            fail_on_data_loss=switch("FAIL_ON_DATA_LOSS"),
            jdbc_url=env.get("JDBC_URL"),
            jdbc_user=env.get("JDBC_USER"),
            jdbc_password=env.get("JDBC_PASSWORD"),
        )
