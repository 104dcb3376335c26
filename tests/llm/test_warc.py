from __future__ import annotations

import base64
import hashlib

import pytest

from tests.llm.conftest import run_sql
from tidemark import runtime
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.warc import page_report, parse_records, read_archive, write_archive

SCHEMA = "page_id long, url string, html string, address string, http string"


def archived(spark, rows, **kw):
    path = runtime.scratch_path(spark, "test-warc")
    write_archive(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA), path, **kw)
    return path


def brute(rows, least=0):
    out = []
    for i, u, h in rows:
        b = (h or "").encode()
        same = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        last = max(same) if same else None
        alone = len(b) < least or i == last
        clean = (u or "").replace("\r", "%0D").replace("\n", "%0A")
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if alone else "revisit", None if alone else last, clean))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/é", "<p>x</p>\r\n\r\nWARC/1.1\r\n"), (2, "http://b", "<p>x</p>\r\n\r\nWARC/1.1\r\n"), (3, None, None), (4, "u\r\nWARC-Type: evil", ""),
    (5, "http://long", "ü" * 200_000), (6, "http://c", "other"), (None, "http://d", "other"), (None, "http://e", "no id"),
]


@pytest.mark.parametrize("least", [0, 6])
def test_cases(spark, least):
    path = archived(spark, ROWS, least_bytes=least)
    got = sorted((tuple(r) for r in page_report(read_archive(spark, path)).collect()), key=str)
    assert got == brute(ROWS, least)


def test_records_are_whole_and_payloads_stored_once(spark):
    path = archived(spark, ROWS)
    records = {r.id: bytes(r.record) for r in read_archive(spark, path).collect()}
    one = records[2]
    head, rest = one.split(b"\r\n\r\n", 1)
    length = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length"))[16:])
    assert rest[length:] == b"\r\n\r\n" and rest[:length].endswith(ROWS[1][2].encode()) and head.startswith(b"WARC/1.1\r\nWARC-Type: response")
    assert b"WARC-Refers-To: <urn:record:2>" in records[1] and not records[1].endswith(b"</p>\r\n\r\nWARC/1.1\r\n\r\n\r\n")
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in ROWS})
    uris = {r.id: r.target_uri for r in parse_records(read_archive(spark, path)).collect()}
    assert uris[1] == "http://a/é"


def test_damage_is_found(spark):
    path = archived(spark, ROWS)
    bad = runtime.scratch_path(spark, "test-warc")
    spark.read.parquet(f"{path}/records").write.parquet(f"{bad}/records")
    spark.read.parquet(f"{path}/payloads").selectExpr("address", "concat(payload, cast('!' as binary)) payload").write.parquet(f"{bad}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        read_archive(spark, bad).collect()


def test_many_copies(spark):
    rows = [(i, "u", "copy" if i % 2 else f"page {i}") for i in range(5000)]
    got = sorted((tuple(r) for r in page_report(read_archive(spark, archived(spark, rows))).collect()), key=str)
    assert [r[3] for r in got].count("response") == 2501 and all(r[4] == 4999 for r in got if r[3] == "revisit")


def test_empty(spark):
    assert page_report(read_archive(spark, archived(spark, []))).collect() == []


def test_query(spark, duck):
    df = QUERIES["op1_warc_archive"](spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in df.collect()), key=str) == run_sql(duck, ORACLES["op1_warc_archive"], df.columns)
