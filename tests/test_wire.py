from __future__ import annotations

import hashlib
import json
import struct

import pytest
from pyspark.sql import functions as F

from tidemark.sources import wire

COLUMNS = "key binary, value binary, headers array<struct<key:string,value:binary>>, topic string, partition int, offset long, timestamp timestamp"
GOOD = {"entity_id": "u", "feature_name": "f", "feature_value": 1.5, "timestamp": 10.0, "event_type": "e", "schema_version": 9,
        "correlation_id": "c", "metadata": {"a": "b"}}


def message(payload, version=1, magic=0):
    body = payload if isinstance(payload, bytes) else json.dumps(payload).encode()
    return struct.pack(">bI", magic, version) + body


@pytest.fixture(scope="module")
def decode(spark):
    def run(*values, headers=None, key=b"k"):
        rows = [(key, bytearray(v) if v is not None else None, headers, "t", 0, i, None) for i, v in enumerate(values)]
        return wire.decode(spark.createDataFrame(rows, COLUMNS)).orderBy("offset").collect()

    return run


def test_header_bytes(spark):
    for v in (0, 1, 300, 2**32 - 1):
        assert bytes(spark.range(1).select(wire.header(F.lit(v)).alias("h")).first().h) == struct.pack(">bI", 0, v)


def test_good_message(decode):
    r = decode(message(GOOD, 7))[0]
    assert r._error is None and r.schema_version == 7 and r.entity_id == "u" and r.metadata == {"a": "b"} and r.key == "k"
    assert r.topic == "t" and r.feature_value.toPython() == 1.5


def test_bad_messages(decode):
    missing = {k: v for k, v in GOOD.items() if k != "entity_id"}
    bad = [None, b"", b"\x00\x00", message(GOOD, magic=1), message(b"{not json"), message(b"\xff\xfe{}"), message(missing), message(b"[1]")]
    errors = [r._error for r in decode(*bad)]
    assert errors == ["empty message", "truncated header", "truncated header", "invalid magic byte", "invalid JSON", "invalid text",
                      "missing field: entity_id", errors[-1]]
    assert errors[-1] is not None


def test_defaults(decode):
    old = {k: GOOD[k] for k in ("entity_id", "feature_name", "feature_value", "timestamp", "correlation_id")}
    r = decode(message(old))[0]
    assert (r._error, r.event_type, r.metadata) == (None, "feature_update", {})
    null = decode(message({**GOOD, "feature_value": None}))[0]
    assert null._error is None


def test_headers_and_key(decode):
    r = decode(message(GOOD), headers=[("a", b"1"), ("b", None), ("a", b"2")], key=None)[0]
    assert r.headers == {"a": "2"} and r.key == ""
    assert decode(message(GOOD))[0].headers == {}


def test_encode(spark):
    df = spark.createDataFrame([("u", "f", 2.5, 10.0)], "entity_id string, feature_name string, feature_value double, timestamp double")
    r = wire.encode(df, "topic", headers={"x": "y"}).first()
    payload = json.loads(bytes(r.value)[5:])
    assert bytes(r.value)[:5] == struct.pack(">bI", 0, 1) and payload["feature_value"] == 2.5 and payload["event_type"] == "feature_update"
    assert [h.key for h in r.headers] == ["correlation_id", "schema_version", "event_type", "x"]
    assert bytes(r.key) == b"u" and r.topic == "topic"
    keys = df.select(*[wire.partition_key(s).alias(s) for s in wire.PARTITION_STRATEGIES], wire.partition_key("key_hash", F.lit("own")).alias("own")).first()
    assert tuple(keys) == ("u", "u", hashlib.md5(b"u:f").hexdigest(), "", "own")
    with pytest.raises(ValueError):
        wire.partition_key("random")


def test_dead_letters(spark):
    df = spark.createDataFrame([("u", "f", 2.5, 10.0)], "entity_id string, feature_name string, feature_value double, timestamp double")
    m = wire.resend_as_dead_letters(df, F.lit("too big"), "dlq", F.timestamp_seconds(F.lit(99)))
    back = wire.decode(m).first()
    assert back.metadata == {"error": "too big", "original_timestamp": "10.0"} and back.timestamp == 99.0 and back.key == "u"
    both = wire.decode(m.select("value").union(spark.createDataFrame([(bytearray(b"zz"),)], "value binary")))
    assert wire.good(both).count() == 1 and wire.dead_letters(both).first()._raw == bytearray(b"zz")
