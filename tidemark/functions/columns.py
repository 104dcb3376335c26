"""Columns over the event record: properties, numbers, keys, order and time (SRC-7, SRC-8, PIPE-4..6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS = 1_000_000

# A string counts as a number only in plain decimal or exponent notation; blanks around it are allowed.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def micros(seconds: float) -> int:
    """Seconds as whole microseconds."""
    return round(seconds * MICROS)


def interval(seconds: float) -> str:
    """Seconds as an interval string with microsecond precision."""
    return f"{micros(seconds)} microseconds"


def from_epoch(seconds: Column) -> Column:
    """Float epoch seconds to a timestamp (SRC-7)."""
    return F.timestamp_micros(F.round(seconds * F.lit(float(MICROS))).cast("bigint"))


def to_epoch(ts: Column) -> Column:
    """Timestamp to float epoch seconds."""
    return F.unix_micros(ts) / F.lit(float(MICROS))


def shift(ts: Column, seconds: float) -> Column:
    """A timestamp moved by a number of seconds, exact to the microsecond."""
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(micros(seconds)))


def _field_type(df: DataFrame, name: str) -> T.DataType | None:
    return df.schema[name].dataType if name in df.columns else None


def prop(df: DataFrame, name: str) -> Column:
    """A property of the event by name, null when absent (SRC-8).

    ``properties`` may be a struct of typed columns (unused fields are pruned from the scan), a map, a VARIANT or
    a JSON string. The lookup is one level deep.
    """
    kind = _field_type(df, "properties")
    if isinstance(kind, T.StructType):
        return F.col("properties")[name] if name in kind.names else F.lit(None).cast("string")
    if isinstance(kind, T.MapType):
        return F.try_element_at(F.col("properties"), F.lit(name))
    if isinstance(kind, T.VariantType):
        return F.try_variant_get(F.col("properties"), f"$['{name}']", "string")
    if isinstance(kind, T.StringType):
        return F.get_json_object(F.col("properties"), f"$['{name}']")
    return F.lit(None).cast("string")


def prop_or(df: DataFrame, name: str, default: Column | str | float) -> Column:
    """A property with a default value (SRC-8)."""
    other = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(prop(df, name).cast("string"), other.cast("string"))


def number(value: Column, kind: T.DataType) -> Column:
    """A finite DOUBLE or null; text must look like a plain number, NaN and infinities are missing (D-5)."""
    if isinstance(kind, T.StringType):
        d = F.when(value.rlike(NUMBER_PATTERN), F.trim(value).try_cast("double"))
    else:
        d = value.try_cast("double")
    finite = ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))
    return F.when(finite, d)


def _typed(df: DataFrame, c: Column) -> T.DataType:
    return df.select(c.alias("c")).schema["c"].dataType


def number_prop(df: DataFrame, name: str) -> Column:
    """A property as a finite number or null; top-level fields are not consulted (CEP-4)."""
    c = prop(df, name)
    return number(c, _typed(df, c))


def entity(df: DataFrame, key_field: str = "user_id") -> Column:
    """Partition key: the user, or a property with the user as fallback (PIPE-4, CEP-5).

    Never null: events without a user share the empty key.
    """
    user = F.coalesce(F.col("user_id").cast("string"), F.lit(""))
    if key_field == "user_id":
        return user
    return F.coalesce(prop(df, key_field).cast("string"), user)


def value(df: DataFrame, source_field: str, aggregation: str) -> Column:
    """The number an event contributes to a feature; null means the event is not routed (PIPE-5, D-15)."""
    if source_field in ("_count", "__count__") or aggregation == "distinct_count":
        return F.lit(1.0)
    if source_field == "_timestamp":
        return to_epoch(F.col("ts"))
    c = prop(df, source_field)
    top_level = {"event_id", "user_id", "event_type"} & set(df.columns)
    if source_field == "timestamp":
        raw, num = F.coalesce(c.cast("string"), F.col("ts").cast("string")), None
        num = F.coalesce(number(c, _typed(df, c)), F.when(c.isNull(), to_epoch(F.col("ts"))))
    elif source_field in top_level:
        raw = F.coalesce(c.cast("string"), F.col(source_field).cast("string"))
        num = number(raw, T.StringType())
    else:
        raw, num = c, number(c, _typed(df, c))
    return F.when(raw.isNull(), F.lit(1.0)).otherwise(num) if aggregation == "count" else num


def distinct_key(df: DataFrame, source_field: str, fallback: str = "product_id") -> Column:
    """What distinct_count counts: the product (else the event), or a named source field (AGG-6, D-15)."""
    field = fallback if source_field in ("_count", "__count__", "_timestamp") else source_field
    return F.coalesce(prop(df, field).cast("string"), F.col("event_id").cast("string"))


def arrival(df: DataFrame) -> Column:
    """Tie-breaker between equal event times: ``seq`` when present, otherwise the event id."""
    return F.col("seq") if "seq" in df.columns else F.col("event_id")


def order_key(df: DataFrame) -> Column:
    """One comparable value for (ts, arrival).

    With an integral arrival number this is a DECIMAL, which keeps first/last aggregates in hash aggregation;
    with a text arrival it is a struct.
    """
    a = arrival(df)
    if isinstance(_typed(df, a), T.IntegralType):
        ts = F.unix_micros(F.col("ts")).cast("decimal(17,0)")
        return (ts * F.lit("20000000000000000000").cast("decimal(20,0)") + a.cast("decimal(19,0)")).cast("decimal(38,0)")
    return F.struct(F.unix_micros(F.col("ts")).alias("t"), a.alias("s"))


def order_key_is_struct(df: DataFrame) -> bool:
    """Whether ``order_key`` needs a struct, i.e. arrival is not an integer."""
    return not isinstance(_typed(df, arrival(df)), T.IntegralType)
