"""Feature store views over an append-only history (FS-1..14, OFF-1..5, ON-1..6).

The history is the only truth: writes and deletions are rows. Every view is a DataFrame over all keys; a lookup is a
join with a frame of requested keys, never a loop. ``now`` is always a parameter, so results can be reproduced.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import runtime
from tidemark.functions.columns import shift, to_epoch
from tidemark.operators.joins import join_on
from tidemark.operators.slices import Running, running, with_slices

KEYS = ["entity_id", "feature_name"]
WRITE_ORDER = ["ingestion_time", "seq"]
DEFAULT_TTL_SECONDS = 3600
OFFLINE_TTL_SECONDS = 90 * 86_400
MAX_VERSIONS = 10
DEFAULT_RANGE_LIMIT = 1000

HISTORY = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("feature_name", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("value_json", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("ingestion_time", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("ttl_seconds", T.IntegerType()),
    T.StructField("expires_at", T.TimestampType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("op", T.StringType()),
])

Moment = datetime | Column


def _at(t: Moment) -> Column:
    return t if isinstance(t, Column) else F.lit(t)


def _optional(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def ttl(call: int | None, own: Column, default: int | None) -> Column:
    """Time to live in seconds: call over record over default; 0 counts as not given (FS-1, ON-1, D-13)."""
    given = [F.lit(call).cast("int")] if call else []
    return F.coalesce(*given, F.nullif(own, F.lit(0)), F.lit(default).cast("int"))


def records(
    writes: DataFrame, now: Moment | None = None, ttl_seconds: int | None = None,
    default_ttl: int | None = DEFAULT_TTL_SECONDS,
) -> DataFrame:
    """Writes as history rows (FS-1).

    ``writes`` has entity_id, feature_name and value (a number), or ``value_json`` for anything else; event_time,
    ingestion_time, seq, version, ttl_seconds and metadata are optional. A missing event time means now.
    """
    moment = F.current_timestamp() if now is None else _at(now)
    event_time = F.coalesce(_optional(writes, "event_time", "timestamp"), moment)
    filled = writes.select(
        F.col("entity_id").cast("string").alias("entity_id"),
        "feature_name",
        _optional(writes, "value", "double").alias("value"),
        _optional(writes, "value_json", "string").alias("value_json"),
        event_time.alias("event_time"),
        F.coalesce(_optional(writes, "ingestion_time", "timestamp"), moment).alias("ingestion_time"),
        F.coalesce(_optional(writes, "seq", "bigint"), F.lit(0)).alias("seq"),
        F.coalesce(_optional(writes, "version", "int"), F.lit(1)).alias("version"),
        ttl(ttl_seconds, _optional(writes, "ttl_seconds", "int"), default_ttl).alias("ttl_seconds"),
        F.coalesce(_optional(writes, "metadata", "map<string,string>"), F.create_map().cast("map<string,string>")).alias("metadata"),
    )
    expires = F.timestamp_micros(F.unix_micros("event_time") + F.col("ttl_seconds").cast("bigint") * 1_000_000)
    return filled.select(
        *filled.columns[:-1], expires.alias("expires_at"), "metadata", F.lit("set").alias("op")
    ).select(*HISTORY.names)


def tombstones(targets: DataFrame, now: Moment | None = None) -> DataFrame:
    """Deletions as history rows (FS-9, ON-4).

    A target with a feature_name hides that feature online and keeps its history; without one it removes the entity.
    """
    moment = F.current_timestamp() if now is None else _at(now)
    name = _optional(targets, "feature_name", "string")
    stamp = F.coalesce(_optional(targets, "ingestion_time", "timestamp"), moment)
    values = {
        "entity_id": F.col("entity_id").cast("string"),
        "feature_name": name,
        "ingestion_time": stamp,
        "event_time": stamp,
        "seq": F.coalesce(_optional(targets, "seq", "bigint"), F.lit((1 << 63) - 1)),
        "op": F.when(name.isNull(), "delete_entity").otherwise("delete_feature"),
    }
    return targets.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in HISTORY.fields]
    )


def write_order(time: str = "ingestion_time") -> Column:
    """(time, seq) as one decimal, so that picking the latest write compares plain numbers."""
    t = F.unix_micros(time).cast("decimal(17,0)") * F.lit("20000000000000000000").cast("decimal(20,0)")
    return (t + F.col("seq").cast("decimal(19,0)")).cast("decimal(38,0)")


def _deletions(history: DataFrame, op: str, keys: Sequence[str], name: str) -> DataFrame | None:
    """The last deletion per key, or None when there is none: then the history need not be joined with anything.

    Deletions are few beside writes. Broadcast behind a count, they are checked without a shuffle of the history.
    """
    last = history.filter(F.col("op") == op).groupBy(*keys).agg(F.max(write_order()).alias(name))
    found = runtime.pin_if_any(last)
    return None if found is None else runtime.broadcast_if_small(found)


def _after(writes: DataFrame, deleted: DataFrame | None, keys: Sequence[str], name: str) -> DataFrame:
    """Writes later than the deletion of their key."""
    if deleted is None:
        return writes
    return join_on(writes, deleted, keys).filter(F.col(name).isNull() | (write_order() > F.col(name))).drop(name)


def surviving(history: DataFrame) -> DataFrame:
    """Writes not removed by a later deletion of their entity."""
    gone = _deletions(history, "delete_entity", ["entity_id"], "__gone")
    return _after(history.filter(F.col("op") != "delete_entity"), gone, ["entity_id"], "__gone")


def _latest(history: DataFrame, order: Column) -> DataFrame:
    row = F.struct(*[F.col(c) for c in history.columns if c not in KEYS])
    return history.groupBy(*KEYS).agg(F.max_by(row, order).alias("r")).select(*KEYS, "r.*")


def online(history: DataFrame, by_event_time: bool = False) -> DataFrame:
    """The latest value of each (entity, feature) (FS-2, D-10).

    The last write by arrival wins, or with ``by_event_time`` the newest event. One row per key and task is shuffled.
    Each key is reduced to its last row before entity deletions are looked up.
    """
    if by_event_time:
        order = F.struct(F.unix_micros("event_time").alias("t"), write_order().alias("w"))
        deleted = _deletions(history, "delete_feature", KEYS, "__deleted")
        return _latest(_after(surviving(history).filter(F.col("op") == "set"), deleted, KEYS, "__deleted"), order)
    last = _latest(history.filter(F.col("op") != "delete_entity"), write_order())
    gone = history.filter(F.col("op") == "delete_entity").groupBy("entity_id").agg(F.max(write_order()).alias("__gone"))
    return _after(last, gone, ["entity_id"], "__gone").filter(F.col("op") == "set")


def unexpired(view: DataFrame, now: Moment) -> DataFrame:
    """Rows that have not expired; a value is still valid at the very instant it expires (FS-3)."""
    return view.filter(F.col("expires_at").isNull() | (F.col("expires_at") >= _at(now)))


def get_features(view: DataFrame, now: Moment, entities: DataFrame | None = None, names: Sequence[str] = ()) -> DataFrame:
    """Unexpired rows, all columns, of the entities and features asked for; no names means all (FS-3, FS-4, FS-5)."""
    out = unexpired(view, now)
    if names:
        out = out.filter(F.col("feature_name").isin(*names))
    return out if entities is None else join_on(out, entities.select("entity_id").distinct(), ["entity_id"], "left_semi")


def batch_get(view: DataFrame, entities: DataFrame, names: Sequence[str], now: Moment) -> DataFrame:
    """One row per requested entity and one column per feature; unknown entities keep a row of nulls (FS-8, ON-2)."""
    wanted = get_features(view, now, entities, names)
    wide = wanted.groupBy("entity_id").pivot("feature_name", list(names)).agg(F.max("value"))
    return join_on(entities.select("entity_id").distinct(), wide, ["entity_id"])


def versions(history: DataFrame, max_versions: int | None = MAX_VERSIONS) -> DataFrame:
    """The last writes of each key, newest first in ``version_rank`` (FS-6).

    The rank limit is applied within each task before the shuffle, so a key with very many writes sends few rows.
    """
    w = Window.partitionBy(*KEYS).orderBy(write_order().desc())
    ranked = surviving(history).filter(F.col("op") == "set").withColumn("version_rank", F.row_number().over(w))
    return ranked if max_versions is None else ranked.filter(F.col("version_rank") <= max_versions)


def at_time(
    history: DataFrame, spine: DataFrame, names: Sequence[str], time: str = "ts", row_limit: int | None = None
) -> DataFrame:
    """Point-in-time values for training rows: spine x names with ``value`` and ``value_time`` (FS-7, D-12).

    The value is the last write with event time at or before the row's time. Expiry plays no part; deletions of a
    feature leave the past as it was.
    """
    past = surviving(history).filter((F.col("op") == "set") & F.col("feature_name").isin(*names))
    # With few entities asked for, the history of all others is discarded before anything is shuffled.
    asked = spine.select("entity_id").distinct()
    if asked.limit(runtime.BROADCAST_ROWS + 1).count() <= runtime.BROADCAST_ROWS:
        past = join_on(past, asked, ["entity_id"], "left_semi", hint=True)
    record, request = F.struct("value", "value_json", "event_time"), F.struct(*[F.col(c) for c in spine.columns])
    none = lambda c, df: F.lit(None).cast(df.select(c.alias("c")).schema["c"].dataType)
    writes = past.select(
        "entity_id", F.unix_micros("event_time").alias("__us"), F.lit(0).alias("__side"), "ingestion_time", "seq",
        F.col("feature_name").alias("__name"), record.alias("__record"), none(request, spine).alias("__request"),
    )
    asks = spine.select(
        "entity_id", F.unix_micros(time).alias("__us"), F.lit(1).alias("__side"), F.lit(None).cast("timestamp").alias("ingestion_time"),
        F.lit(None).cast("bigint").alias("seq"), F.lit(None).cast("string").alias("__name"), none(record, past).alias("__record"),
        request.alias("__request"),
    )
    # One ordered scan per entity carries the last record of every name, so a spine row is moved once.
    both, piece = with_slices(writes.unionByName(asks), ["entity_id"], "__us", row_limit)
    last = {f"__r{i}": Running("last", F.when(F.col("__name") == n, F.col("__record"))) for i, n in enumerate(names)}
    found = running(both, ["entity_id"], ["__us", "__side", "ingestion_time", "seq"], piece, last).filter(F.col("__side") == 1)
    each = F.array(*[F.struct(F.lit(n).alias("feature_name"), F.col(f"__r{i}").alias("record")) for i, n in enumerate(names)])
    found = found.select("__request.*", F.explode(each).alias("__f"))
    return found.select(
        *spine.columns, F.col("__f.feature_name").alias("feature_name"), F.col("__f.record.value").alias("value"),
        F.col("__f.record.value_json").alias("value_json"), F.col("__f.record.event_time").alias("value_time"),
    )


def list_entities(view: DataFrame) -> DataFrame:
    """Entities with any stored feature, expired or not (FS-10)."""
    return view.select("entity_id").distinct()


def list_features(view: DataFrame, now: Moment) -> DataFrame:
    """Unexpired feature names per entity (FS-10)."""
    return unexpired(view, now).select(*KEYS)


def counts(view: DataFrame) -> DataFrame:
    """Number of entities and of stored features (FS-10)."""
    per_entity = view.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    return per_entity.agg(F.count(F.lit(1)).alias("entities"), F.coalesce(F.sum("n"), F.lit(0)).alias("features"))


def expired(view: DataFrame, now: Moment) -> DataFrame:
    """What a clean-up removes (FS-11)."""
    return view.filter(F.col("expires_at") < _at(now))


def nested_snapshot(view: DataFrame, now: Moment) -> DataFrame:
    """Unexpired values as one map per entity (FS-12). The map has one entry per feature name."""
    rec = F.struct("value", "value_json", "version", "event_time", "ttl_seconds", "metadata")
    entries = F.collect_list(F.struct(F.col("feature_name").alias("key"), rec.alias("value")))
    return unexpired(view, now).groupBy("entity_id").agg(F.map_from_entries(entries).alias("features"))


def log_lines(history: DataFrame) -> DataFrame:
    """History writes as JSON lines (FS-13)."""
    value = F.coalesce(F.to_json(F.struct("value")), F.lit("{}"))
    line = F.to_json(
        F.struct(
            "entity_id", "feature_name",
            F.coalesce(F.try_parse_json(F.get_json_object(value, "$.value")), F.try_parse_json("value_json")).alias("value"),
            to_epoch(F.col("event_time")).alias("timestamp"), "version", "metadata",
            to_epoch(F.col("ingestion_time")).alias("ingestion_time"),
        )
    )
    return history.filter(F.col("op") == "set").select(line.alias("value"))


def hits(view: DataFrame, requests: DataFrame, now: Moment) -> DataFrame:
    """(entity_id, feature_name, hit) of requested (entity, feature) pairs (FS-14).

    A name that is absent or expired is a miss. An entity without anything stored is one miss in total.
    """
    stored = view.select(*KEYS, F.coalesce(F.col("expires_at") >= _at(now), F.lit(True)).alias("__valid"))
    known = view.groupBy("entity_id").agg(F.lit(True).alias("__known"))
    seen = join_on(join_on(requests.select(*KEYS), stored, KEYS), known, ["entity_id"])
    known_rows = seen.filter(F.col("__known")).select(*KEYS, F.coalesce("__valid", F.lit(False)).alias("hit"))
    unknown = seen.filter(F.col("__known").isNull()).select("entity_id").distinct()
    return known_rows.unionByName(
        unknown.select("entity_id", F.lit(None).cast("string").alias("feature_name"), F.lit(False).alias("hit"))
    )


def hit_rate(view: DataFrame, requests: DataFrame, now: Moment) -> DataFrame:
    """Hits, misses and their rate to 4 digits; 0 without requests (FS-14)."""
    h = hits(view, requests, now).agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"))
    total = F.col("hits") + F.col("misses")
    return h.withColumn("hit_rate", F.coalesce(F.round(F.col("hits") / F.nullif(total, F.lit(0)), 4), F.lit(0.0)))


# --- offline history --------------------------------------------------------------------------------------------


def offline(history: DataFrame) -> DataFrame:
    """One row per (entity, feature, event time): the last write wins (OFF-1)."""
    sets = surviving(history).filter(F.col("op") == "set")
    key = [*KEYS, "event_time"]
    row = F.struct(*[F.col(c) for c in sets.columns if c not in key])
    return sets.groupBy(*key).agg(F.max_by(row, write_order()).alias("r")).select(*key, "r.*").select(*sets.columns)


def time_range(
    history: DataFrame, start: Moment, end: Moment, entities: DataFrame | None = None, names: Sequence[str] = (),
    limit: int | None = DEFAULT_RANGE_LIMIT, deletions: DataFrame | None = None,
) -> DataFrame:
    """Records in [start, end], newest first, at most ``limit`` per key (OFF-2).

    ``deletions`` are deletion marks where they are kept apart; else they are looked for in the whole history.
    """
    rows = history.filter((F.col("op") == "set") & F.col("event_time").between(_at(start), _at(end)))
    if names:
        rows = rows.filter(F.col("feature_name").isin(*names))
    if entities is not None:
        rows = join_on(rows, entities.select("entity_id").distinct(), ["entity_id"], "left_semi")
    # Deletions count whenever they happened; kept apart, the range still prunes the scan.
    rows = rows.unionByName((history if deletions is None else deletions).filter(F.col("op") == "delete_entity"))
    w = Window.partitionBy(*KEYS).orderBy(F.col("event_time").desc())
    ranked = offline(rows).withColumn("newest_rank", F.row_number().over(w))
    return ranked if limit is None else ranked.filter(F.col("newest_rank") <= limit)


def latest(history: DataFrame) -> DataFrame:
    """The newest record of every key by event time (OFF-3)."""
    sets = surviving(history).filter(F.col("op") == "set")
    return _latest(sets, F.struct(F.unix_micros("event_time").alias("t"), write_order().alias("w")))


def entity_index(history: DataFrame) -> DataFrame:
    """Features of each entity and when they were last updated (OFF-4)."""
    return (
        surviving(history).filter(F.col("op") == "set").groupBy(*KEYS).agg(F.max("event_time").alias("last_updated"))
    )


def retained(history: DataFrame, now: Moment, ttl_seconds: int = OFFLINE_TTL_SECONDS) -> DataFrame:
    """History whose write is not older than the retention period (OFF-5)."""
    return history.filter(F.col("ingestion_time") >= shift(_at(now), -ttl_seconds))


# --- online serving ---------------------------------------------------------------------------------------------


def stored_version(history: DataFrame) -> DataFrame:
    """Version of the last write, also when the value has expired (ON-3)."""
    return online(history).select(*KEYS, "version")


def ttl_remaining(view: DataFrame, requests: DataFrame, now: Moment) -> DataFrame:
    """Seconds left per requested key: -1 without expiry, -2 when missing or expired (ON-5)."""
    left = F.unix_micros("expires_at") - F.unix_micros(_at(now))
    seen = join_on(requests.select(*KEYS), view.select(*KEYS, F.lit(True).alias("__there"), "expires_at"), KEYS)
    code = (
        F.when(F.col("__there").isNull(), F.lit(-2))
        .when(F.col("expires_at").isNull(), F.lit(-1))
        .when(left < 0, F.lit(-2))
        .otherwise(F.floor(left / F.lit(1_000_000)))
    )
    return seen.select(*KEYS, code.cast("bigint").alias("ttl_remaining"))


def kv_pairs(view: DataFrame, prefix: str = "feature:") -> DataFrame:
    """Key and JSON text for a key-value store (ON-6)."""
    value = F.coalesce(F.to_json(F.struct(F.col("value").alias("v"))), F.lit("{}"))
    v = F.coalesce(F.try_parse_json(F.get_json_object(value, "$.v")), F.try_parse_json("value_json"))
    body = F.struct(v.alias("v"), F.col("version").alias("ver"), to_epoch(F.col("event_time")).alias("ts"), F.col("metadata").alias("meta"))
    return view.select(
        F.concat(F.lit(prefix), "entity_id", F.lit(":"), "feature_name").alias("key"),
        F.to_json(body).alias("value"),
        "ttl_seconds",
    )
