"""Change-log records to flat Bronze rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas
from tidelog.config import TableSpec
from tidelog.functions import effective_key, op_name

LINEAGE = "debezium-kafka"


def parse_events(
    log: DataFrame, spec: TableSpec, columns: Sequence[str] | None = None
) -> DataFrame:
    """Flatten the nested envelope; the same function serves batch and stream.

    Tombstones (null values) are dropped.  Unreadable JSON is kept with null
    fields and operation ``UNKNOWN``.

    ``columns`` limits the result to some Bronze columns.  Catalyst does not
    prune a parsed struct with several readers, so the JSON schema is narrowed
    here: fields nobody reads are skipped by the parser.
    """
    wanted = schemas.bronze(spec).names if columns is None else list(columns)
    raw = log.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("json_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    ).where(F.col("json_value").isNotNull())

    paths = _event_paths(spec)
    needed = _closure(wanted, spec)
    parsed = {name: path for name, path in paths.items() if name in needed}
    schema = _narrowed(schemas.envelope(spec), parsed.values())
    # A generator is the one operator that filters are not moved below: without it a filter
    # on a parsed field would parse the text again, and below any exchange.
    events = raw.select(
        *[c for c in raw.columns if c != "json_value"],
        F.explode(F.array(F.from_json("json_value", schema))).alias("event"),
    )
    flat = events.select(
        *[c for c in raw.columns if c != "json_value"],
        *[F.col("event." + ".".join(path)).alias(name) for name, path in parsed.items()],
    )

    computed = {k: effective_key(k) for k in spec.key_names}
    computed["op_type"] = op_name(F.col("op"))
    computed["_ingestion_ts"] = F.current_timestamp()
    computed["_source"] = F.lit(LINEAGE)
    return flat.select(*[computed[c].alias(c) if c in computed else F.col(c) for c in wanted])


def _event_paths(spec: TableSpec) -> dict[str, tuple[str, ...]]:
    """Where each parsed Bronze column comes from in the envelope.

    The event time is the envelope's own clock, not the one in its source block.
    """
    paths: dict[str, tuple[str, ...]] = {"op": ("op",), "source_ts_ms": ("ts_ms",)}
    for name in ("db", "schema", "table", "lsn"):
        paths[f"source_{name}"] = ("source", name)
    for side in ("before", "after"):
        for f in spec.fields:
            paths[f"{side}_{f.name}"] = (side, f.name)
    return paths


def _closure(wanted: Iterable[str], spec: TableSpec) -> set[str]:
    """Wanted columns and those they are computed from."""
    needed = set(wanted)
    for key in needed & set(spec.key_names):
        needed |= {f"after_{key}", f"before_{key}"}
    if "op_type" in needed:
        needed.add("op")
    return needed


def _narrowed(envelope: T.StructType, paths: Iterable[tuple[str, ...]]) -> T.StructType:
    """The envelope schema with only the fields on ``paths``."""
    heads: dict[str, set[str]] = {}
    for head, *tail in paths:
        heads.setdefault(head, set()).update(tail)
    fields = []
    for f in envelope:
        if f.name in heads:
            inner = heads[f.name]
            kept = T.StructType([g for g in f.dataType if g.name in inner]) if inner else f.dataType
            fields.append(T.StructField(f.name, kept))
    # A parser schema must not be empty, even if only log columns are read.
    return T.StructType(fields or [envelope["op"]])
