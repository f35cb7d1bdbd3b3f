"""Table descriptions and environment settings.

A :class:`TableSpec` says which columns of a captured table form its key, which
are payload, and how each is cleansed.  Every operator takes a spec, so adding a
table means adding a spec, not code.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

# Columns that order two events of one key, most significant first.  Nulls rank
# lowest, which is what Spark's struct comparison and DESC NULLS LAST both do.
# The log partition comes last: offsets are unique only inside one partition.
ORDER_COLUMNS = ("source_ts_ms", "source_lsn", "kafka_offset", "kafka_partition")

# The position of one record in the change log.
LOG_POSITION = ("kafka_topic", "kafka_partition", "kafka_offset")

CLEANSERS = ("none", "trim", "lower_trim")


@dataclass(frozen=True)
class Field:
    """One captured column: name, Spark type and cleansing rule."""

    name: str
    type: str = "string"
    clean: str = "none"

    def __post_init__(self):
        if self.clean not in CLEANSERS:
            raise ValueError(f"unknown cleansing rule {self.clean!r} for {self.name}")


@dataclass(frozen=True)
class TableSpec:
    """A captured table and the layer tables derived from it."""

    name: str
    topic: str
    key: tuple[Field, ...]
    values: tuple[Field, ...]
    domain_of: str | None = None

    def __post_init__(self):
        if not self.key:
            raise ValueError(f"table {self.name} needs at least one key column")
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ValueError(f"table {self.name} repeats a column: {names}")
        if self.domain_of is not None and self.domain_of not in self.value_names:
            raise ValueError(f"{self.domain_of} is not a payload column of {self.name}")

    @property
    def fields(self) -> tuple[Field, ...]:
        return self.key + self.values

    @property
    def key_names(self) -> list[str]:
        return [f.name for f in self.key]

    @property
    def value_names(self) -> list[str]:
        return [f.name for f in self.values]

    @property
    def domain_column(self) -> str | None:
        return f"{self.domain_of}_domain" if self.domain_of else None

    # Layer tables, as users address them in SQL.
    @property
    def bronze_table(self) -> str:
        return f"bronze.{self.name}_raw"

    @property
    def silver_table(self) -> str:
        return f"silver.{self.name}_clean"

    @property
    def domain_table(self) -> str:
        return f"gold.{self.name}_email_domain"

    @property
    def daily_table(self) -> str:
        return f"gold.{self.name}_daily_changes"

    @property
    def layer_tables(self) -> list[str]:
        return [self.bronze_table, self.silver_table, self.domain_table, self.daily_table]


USERS = TableSpec(
    name="users",
    topic="pgb.public.users",
    key=(Field("id", "int"),),
    values=(Field("name", "string", "trim"), Field("email", "string", "lower_trim")),
    domain_of="email",
)

REGISTRY: dict[str, TableSpec] = {USERS.topic: USERS}


def spec_for(topic: str, registry: Mapping[str, TableSpec] | None = None) -> TableSpec:
    """Spec registered for ``topic``; an unknown topic is an error."""
    known = REGISTRY if registry is None else registry
    if topic not in known:
        raise ValueError(f"unknown topic {topic!r} (available: {sorted(known)})")
    return known[topic]


@dataclass(frozen=True)
class Settings:
    """Deployment settings.  Credentials have no default and are never printed."""

    topic: str = USERS.topic
    bootstrap_servers: str | None = None
    security_protocol: str = "PLAINTEXT"
    sasl_mechanism: str = "SCRAM-SHA-512"
    kafka_username: str | None = None
    kafka_password: str | None = field(default=None, repr=False)
    lake_root: str | None = None
    checkpoint: str | None = None
    trigger_seconds: int = 30
    query_name: str = "users-cdc-streaming"
    max_offsets_per_trigger: int = 10_000
    min_partitions: int | None = None
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = field(default=None, repr=False)

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        return cls(
            topic=env.get("KAFKA_TOPIC", cls.topic),
            bootstrap_servers=env.get("KAFKA_BOOTSTRAP_SERVERS"),
            security_protocol=env.get("KAFKA_SECURITY_PROTOCOL", cls.security_protocol),
            sasl_mechanism=env.get("KAFKA_SASL_MECHANISM", cls.sasl_mechanism),
            kafka_username=env.get("KAFKA_USERNAME"),
            kafka_password=env.get("KAFKA_PASSWORD"),
            lake_root=env.get("TIDELOG_ROOT"),
            checkpoint=env.get("STREAMING_CHECKPOINT"),
            trigger_seconds=int(env.get("STREAMING_TRIGGER_SECONDS", cls.trigger_seconds)),
            query_name=env.get("STREAMING_QUERY_NAME", cls.query_name),
            max_offsets_per_trigger=int(
                env.get("TIDELOG_MAX_OFFSETS_PER_TRIGGER", cls.max_offsets_per_trigger)
            ),
            min_partitions=int(n) if (n := env.get("TIDELOG_MIN_PARTITIONS")) else None,
            jdbc_url=env.get("TIDELOG_JDBC_URL"),
            jdbc_user=env.get("PG_USER"),
            jdbc_password=env.get("PG_PASSWORD"),
        )

    def describe(self) -> dict[str, str]:
        """Printable settings, without secrets."""
        return {
            "topic": self.topic,
            "bootstrap_servers": self.bootstrap_servers or "(unset)",
            "security_protocol": self.security_protocol,
            "lake_root": self.lake_root or "(unset)",
            "checkpoint": self.checkpoint or "(unset)",
            "trigger_seconds": str(self.trigger_seconds),
            "query_name": self.query_name,
            "max_offsets_per_trigger": str(self.max_offsets_per_trigger),
            "jdbc_url": "(set)" if self.jdbc_url else "(unset)",
        }
