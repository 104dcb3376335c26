"""Feature messages on the wire (SRC-3..5, SRC-9..12).

A message value is a 5-byte header (a zero byte and the schema version as unsigned big-endian 32 bits) followed by
UTF-8 JSON. Input and output have the columns of Spark's Kafka source and sink; a file or table with the same columns
works alike.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import from_epoch, to_epoch

# Fixed values of the message format.
MAGIC = b"\x00"
HEADER_BYTES = 5
DEFAULT_EVENT_TYPE = "feature_update"

# A field without a default must be there.
REQUIRED = object()


@dataclass(frozen=True)
class Field:
    """A field of a schema version: its Spark type, and its value where a message does not have it."""

    name: str
    kind: str
    default: Any = REQUIRED


Schema = tuple[Field, ...]

V1: Schema = (
    Field("entity_id", "string"),
    Field("feature_name", "string"),
    Field("feature_value", "variant", None),
    Field("timestamp", "double"),
    Field("event_type", "string", DEFAULT_EVENT_TYPE),
    Field("schema_version", "bigint", 1),
    Field("correlation_id", "string"),
    Field("metadata", "map<string,string>", {}),
)
# Schemas by version; a message of a version that is not listed has the newest one below it (SRC-9).
SCHEMAS: Mapping[int, Schema] = {1: V1}


def unreadable(schemas: Mapping[int, Schema], reader: int | None = None) -> list[str]:
    """Why the reader's version cannot read all messages of the others: a field they lack, without a default (SRC-9)."""
    own = schemas[max(schemas) if reader is None else reader]
    return [
        f"version {v} has no field '{f.name}', which has no default" for v, fields in sorted(schemas.items())
        for f in own if f.default is REQUIRED and f.name not in {x.name for x in fields}
    ]


def _payload(schemas: Mapping[int, Schema]) -> T.StructType:
    """All fields of all versions, for one parse per message."""
    kinds: dict[str, str] = {}
    for fields in schemas.values():
        for f in fields:
            if kinds.setdefault(f.name, f.kind) != f.kind:
                raise ValueError(f"field '{f.name}' has two types")
    return T.StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in kinds.items()) + ", `_corrupt_record` string")

PARTITION_STRATEGIES = ("key_hash", "entity_based", "feature_group", "round_robin")


def header(version: Column) -> Column:
    """The 5 header bytes of a schema version."""
    v = version.cast("bigint")
    fits = F.when(v.between(0, 2**32 - 1), v).otherwise(F.raise_error(F.concat(F.lit("schema version out of range: "), v.cast("string"))))
    return F.concat(F.lit(MAGIC), F.unhex(F.lpad(F.hex(fits), 8, "0")))


def partition_key(strategy: str = "key_hash", explicit: Column | None = None) -> Column:
    """Message key: the entity, a digest of entity and feature, or empty (SRC-12). An explicit key wins."""
    if strategy not in PARTITION_STRATEGIES:
        raise ValueError(f"unknown partition strategy: {strategy}")
    if strategy == "feature_group":
        key = F.md5(F.concat_ws(":", "entity_id", "feature_name").cast("binary"))
    elif strategy == "round_robin":
        key = F.lit("")
    else:
        key = F.col("entity_id").cast("string")
    return key if explicit is None else F.coalesce(F.nullif(explicit, F.lit("")), key)


def encode(
    features: DataFrame, topic: str, strategy: str = "key_hash", key: Column | None = None,
    headers: Mapping[str, str] | None = None,
) -> DataFrame:
    """Messages ``key, value, headers, topic`` for a Kafka sink (SRC-10, SRC-11).

    ``features`` has the payload's columns; ``feature_value`` may be a number, text or VARIANT.
    """
    have = set(features.columns)

    def col(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in have else default

    version = col("schema_version", F.lit(1)).cast("bigint")
    payload = F.struct(
        F.col("entity_id").cast("string").alias("entity_id"),
        "feature_name",
        "feature_value",
        F.col("timestamp").cast("double").alias("timestamp"),
        col("event_type", F.lit(DEFAULT_EVENT_TYPE)).alias("event_type"),
        version.alias("schema_version"),
        col("correlation_id", F.lit("")).alias("correlation_id"),
        col("metadata", F.create_map().cast("map<string,string>")).alias("metadata"),
    )
    own = [
        ("correlation_id", col("correlation_id", F.lit(""))),
        ("schema_version", version.cast("string")),
        ("event_type", col("event_type", F.lit(DEFAULT_EVENT_TYPE))),
        *[(k, F.lit(v)) for k, v in (headers or {}).items()],
    ]
    entries = [F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value")) for k, v in own]
    text = F.to_json(payload, {"ignoreNullFields": "false"})
    return features.select(
        partition_key(strategy, key).cast("binary").alias("key"),
        F.concat(header(version), F.encode(text, "UTF-8")).alias("value"),
        F.array(*entries).alias("headers"),
        F.lit(topic).alias("topic"),
    )


def _default(f: Field) -> Column:
    if isinstance(f.default, Mapping):
        pairs = [x for k, v in f.default.items() for x in (F.lit(k), F.lit(v))]
        return F.create_map(*pairs).cast(f.kind)
    return F.lit(None if f.default is REQUIRED else f.default).cast(f.kind)


def decode(messages: DataFrame, schemas: Mapping[int, Schema] = SCHEMAS, reader: int | None = None) -> DataFrame:
    """Decode in one pass; ``_error`` says what is wrong with a message, null when it is good (SRC-3, SRC-4, SRC-9).

    The result has the fields of the ``reader``'s version, the newest unless given. The header's version says how a
    message was written: a field of that version is taken from the message, or from that version's default; a field it
    does not have from the reader's default, whatever the message holds under the name; fields that the reader does not
    have are left out. What is then missing is an error. Every message is parsed once, for all versions. The header's
    version replaces the payload's. Malformed messages never fail the job.
    """
    own = schemas[max(schemas) if reader is None else reader]
    payload = _payload(schemas)
    value = F.col("value")
    magic_ok = F.substring(value, 1, 1) == F.lit(MAGIC)
    version = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")
    text = F.try_validate_utf8(F.substring(value, F.lit(HEADER_BYTES + 1), F.length(value)).cast("string"))
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    transport = [c for c in ("topic", "partition", "offset") if c in messages.columns]
    parsed = messages.select(
        "*",
        magic_ok.alias("__magic"),
        F.when(magic_ok, version).alias("__version"),
        F.when(magic_ok & (F.length(value) > HEADER_BYTES), text).alias("__text"),
    )
    # A filter on the outcome must not be moved below the parse, where it would parse again for every condition:
    # nothing moves through a generator.
    parsed = parsed.select("*", F.explode(F.array(F.from_json("__text", payload, opts))).alias("__p"))

    def resolved(f: Field) -> Column:
        raw, versions = F.col(f"__p.`{f.name}`"), sorted(schemas)
        out = F.lit(None).cast(f.kind)
        for v in versions:
            written = next((x for x in schemas[v] if x.name == f.name), None)
            # A message below all versions is read as the oldest.
            here = F.coalesce(raw, _default(written if written.default is not REQUIRED else Field(f.name, f.kind, None))) if written else _default(f)
            out = here if v == versions[0] else F.when(F.col("__version") >= v, here).otherwise(out)
        return out

    fields = {f.name: F.col("__version") if f.name == "schema_version" else resolved(f) for f in own}
    # Required: in the reader's version or in that of the message.
    absent = F.lit(None).cast("string")
    for f in reversed(own):
        strict = [v for v in sorted(schemas) if f.default is REQUIRED or any(x.name == f.name and x.default is REQUIRED for x in schemas[v])]
        if strict and f.name != "schema_version":
            needed = F.lit(False)
            for v in sorted(schemas):
                written = next((x for x in schemas[v] if x.name == f.name), f)
                needed = F.lit(written.default is REQUIRED) if v == min(schemas) else F.when(F.col("__version") >= v, F.lit(written.default is REQUIRED)).otherwise(needed)
            absent = F.when(fields[f.name].isNull() & needed, F.lit(f"missing field: {f.name}")).otherwise(absent)
    error = (
        F.when(value.isNull(), "empty message")
        .when(F.length(value) < HEADER_BYTES, "truncated header")
        .when(~F.col("__magic"), "invalid magic byte")
        .when(F.col("__text").isNull(), "invalid text")
        .when(F.col("__p").isNull() | F.col("__p._corrupt_record").isNotNull(), "invalid JSON")
        .otherwise(absent)
    )
    out = [*[c.alias(n) for n, c in fields.items()], *transport]
    if "timestamp" in messages.columns:
        out.append(to_epoch(F.col("timestamp").cast("timestamp")).alias("broker_time"))
    if "headers" in messages.columns:
        given = F.filter("headers", lambda h: h["value"].isNotNull())
        pairs = F.transform(given, lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")))
        # A repeated header keeps its last value.
        last = F.aggregate(
            pairs, F.lit([]).cast("array<struct<key:string,value:string>>"),
            lambda acc, h: F.concat(F.filter(acc, lambda e: e["key"] != h["key"]), F.array(h)),
        )
        names = F.transform(given, lambda h: h["key"])
        merged = F.when(F.size(F.array_distinct(names)) == F.size(names), F.map_from_entries(pairs)).otherwise(
            F.map_from_entries(last)
        )
        out.append(F.coalesce(merged, F.create_map().cast("map<string,string>")).alias("headers"))
    if "key" in messages.columns:
        out.append(F.coalesce(F.col("key").cast("string"), F.lit("")).alias("key"))
    return parsed.select(*out, error.alias("_error"), F.col("value").alias("_raw"))


def good(decoded: DataFrame) -> DataFrame:
    """Decoded messages without an error."""
    return decoded.filter(F.col("_error").isNull()).drop("_error", "_raw")


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Messages that could not be decoded, with the reason and the original bytes (SRC-5)."""
    keep = [c for c in ("topic", "partition", "offset", "broker_time", "key") if c in decoded.columns]
    return decoded.filter(F.col("_error").isNotNull()).select(*keep, "_error", "_raw")


def resend_as_dead_letters(features: DataFrame, error: Column, topic: str, now: Column | None = None) -> DataFrame:
    """Messages for the dead-letter topic of features that could not be sent (SRC-5)."""
    extra = F.create_map(
        F.lit("error"), error.cast("string"), F.lit("original_timestamp"), F.col("timestamp").cast("string")
    )
    old = F.col("metadata") if "metadata" in features.columns else F.create_map().cast("map<string,string>")
    marked = features.withColumn("metadata", F.map_concat(F.map_filter(old, lambda k, _: ~k.isin("error", "original_timestamp")), extra))
    stamped = marked.withColumn("timestamp", to_epoch(F.current_timestamp() if now is None else now))
    return encode(stamped, topic, "entity_based")


# Bits of a message's order that its place in the partition has.
OFFSET_BITS = 47


def broker_order(partition: Column, offset: Column) -> Column:
    """One number that orders messages by (partition, offset), the order in which the broker has them (SRC-4).

    Messages of one key are in one partition, so this is the order of their arrival. A partition above 65,535 or an offset
    of 2^47 or more is an error.
    """
    fits = partition.between(0, 2**16 - 1) & offset.between(0, 2**OFFSET_BITS - 1)
    number = F.shiftleft(partition.cast("bigint"), OFFSET_BITS).bitwiseOR(offset.cast("bigint"))
    return F.when(fits, number).otherwise(F.raise_error(F.concat_ws(" ", F.lit("no order for partition and offset"), partition, offset)))


def as_events(decoded: DataFrame) -> DataFrame:
    """Good messages as events in the broker's order: ``event_id, user_id, event_type, ts, seq, properties`` (SRC-4, SRC-6).

    The event's type is the feature's name and its property ``value`` the feature's value, beside the metadata. Equal
    event times are ordered by arrival wherever events are: first and last values, patterns, lateness.
    """
    number = F.try_variant_get("feature_value", "$", "string")
    return decoded.select(
        F.col("correlation_id").alias("event_id"), F.col("entity_id").alias("user_id"), F.col("feature_name").alias("event_type"),
        from_epoch(F.col("timestamp")).alias("ts"), broker_order(F.col("partition"), F.col("offset")).alias("seq"),
        F.map_concat(F.map_filter("metadata", lambda k, _: k != "value"), F.create_map(F.lit("value"), number)).alias("properties"),
    )
