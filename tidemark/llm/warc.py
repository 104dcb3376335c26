"""A content-addressed archive of WARC records.

Payload bytes are stored once per content, addressed by SHA-256; the exact headers of every record are stored apart. A
record is put together again by joining its address with the payloads, whose digest is verified when they are read.

Both tables are Parquet in one folder: ``records`` (record header, HTTP header, address) and ``payloads`` (address,
payload). Of the records with equal payloads that with the largest identifier is a ``response``; the others are
``revisit`` records that refer to it and have no payload in their block. Payloads smaller than ``least_bytes`` are all
responses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import attach, stored

CRLF = "\r\n"
# Fixed values of the WARC format and of base32 (RFC 4648).
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGITS_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE_32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in base32: the 40 hexadecimal digits in four groups of eight base32 digits."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), DIGITS_32, BASE_32)


def _record_id(value: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(value.cast("string"), F.lit("none")), F.lit(">"))


def _lines(*parts: tuple[str, Column]) -> Column:
    return F.concat(*[F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in parts])


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    date: str = "1970-01-01T00:00:00Z", least_bytes: int = 0,
) -> None:
    """Archive one record per row of ``pages``.

    A null payload is empty, a null URL is the empty text, line ends in a URL are escaped. A row without an identifier
    revisits like others but is never referred to; where no row of a group has an identifier, all its rows are
    responses. Rows with one identifier and one payload share their record identifier. Other columns are not read.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"").cast("binary"))
    url = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), "\r", "%0D"), "\n", "%0A")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), url.alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"address": F.sha2("payload", 256), "sha1": base32_sha1(F.col("payload")), "bytes": F.octet_length("payload").cast("long")})
    groups = rows.groupBy("address").agg(F.max("id").alias("holder"), F.count(F.lit(1)).alias("members"))
    placed = attach(rows, stored(groups, "warc-groups"), "address", "members")
    alone = F.col("bytes") < least_bytes
    is_response = alone | F.col("id").eqNullSafe(F.col("holder"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    digest = F.concat(F.lit("sha1:"), F.col("sha1"))
    common = (("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("url")), ("WARC-Payload-Digest", digest), ("Content-Type", F.lit("application/http;msgtype=response")))
    response = F.concat(
        F.lit(VERSION + CRLF), _lines(("WARC-Type", F.lit("response")), ("WARC-Record-ID", _record_id(F.col("id"))), *common,
        ("Content-Length", (F.octet_length("http") + F.col("bytes")).cast("string"))), F.lit(CRLF),
    )
    revisit = F.concat(
        F.lit(VERSION + CRLF), _lines(("WARC-Type", F.lit("revisit")), ("WARC-Record-ID", _record_id(F.col("id"))),
        ("WARC-Refers-To", _record_id(F.col("holder"))), ("WARC-Profile", F.lit(PROFILE)), *common,
        ("Content-Length", F.octet_length("http").cast("string"))), F.lit(CRLF),
    )
    records = placed.withColumn("http", http).select(
        "id", F.when(is_response, response).otherwise(revisit).cast("binary").alias("header"), F.col("http").cast("binary").alias("http"),
        F.when(is_response, F.col("address")).alias("address"),
    )
    records.write.mode("errorifexists").parquet(f"{path}/records")
    once = placed.filter(F.col("id").eqNullSafe(F.col("holder")))
    once.select("address", "payload").dropDuplicates(["address"]).write.mode("errorifexists").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record as its original bytes: ``id, record``. A payload that does not have its address is an error."""
    records, payloads = spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/payloads")
    damaged = F.raise_error(F.concat(F.lit("damaged payload "), F.col("address")))
    sound = payloads.select("address", F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(damaged).alias("payload"))
    end = F.lit(CRLF * 2).cast("binary")
    empty = F.lit(b"").cast("binary")
    # Only responses have an address, one for each content (more only where payloads are below the least size).
    responses = records.filter(F.col("address").isNotNull()).join(sound, "address", "left")
    lost = F.raise_error(F.concat(F.lit("lost payload "), F.col("address")))
    whole = responses.select("id", "header", "http", F.when(F.col("payload").isNull(), lost).otherwise(F.col("payload")).alias("payload"))
    rest = records.filter(F.col("address").isNull()).select("id", "header", "http", empty.alias("payload"))
    return whole.unionByName(rest).select("id", F.concat("header", "http", "payload", end).alias("record"))


def parse_records(records: DataFrame) -> DataFrame:
    """Fields of record bytes: ``id, record_type, record_id, refers_to_record, target_uri, payload_digest, payload``."""
    latin = lambda c: F.decode(c, "ISO-8859-1")  # noqa: E731  one character a byte, so that lengths are bytes
    utf8 = lambda c: F.decode(F.encode(c, "ISO-8859-1"), "UTF-8")
    field = lambda name: F.regexp_extract("head", rf"(?m)^{name}: (.*?)\r?$", 1)
    got = records.withColumn("head", F.substring_index(latin(F.col("record")), CRLF * 2, 1))
    block = F.substring(F.col("record"), F.length("head") + 5, field("Content-Length").cast("int"))
    got = got.withColumn("block", block)
    http = F.substring_index(latin(F.col("block")), CRLF * 2, 1)
    body = F.substring(F.col("block"), F.length(http) + 5, F.octet_length("block"))
    return got.select(
        "id", field("WARC-Type").alias("record_type"), field("WARC-Record-ID").alias("record_id"), field("WARC-Refers-To").alias("refers_to_record"),
        utf8(field("WARC-Target-URI")).alias("target_uri"), F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"), body.alias("payload"),
    )


def page_report(records: DataFrame) -> DataFrame:
    """Per record of an archive: ``page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri``.

    Length and digest are those of the full payload; a revisit gets them from the response that it refers to.
    """
    parsed = parse_records(records)
    target = F.nullif(F.regexp_extract("refers_to_record", r"<urn:record:(-?\d+)>", 1), F.lit("")).cast("long")
    rows = parsed.select(
        F.col("id").alias("page_id"), "record_type", target.alias("refers_to"), "target_uri",
        F.octet_length("payload").cast("long").alias("own_bytes"), base32_sha1(F.col("payload")).alias("own_digest"),
    )
    rows = stored(rows, "warc-rows")
    bodies = rows.filter(F.col("record_type") == "response").select(F.col("page_id").alias("refers_to"), F.col("own_bytes").alias("payload_bytes"), F.col("own_digest").alias("payload_digest"))
    wanted = rows.filter(F.col("record_type") == "revisit")
    counts = wanted.groupBy("refers_to").agg(F.count(F.lit(1)).alias("members"))
    referred = stored(counts.join(bodies.dropDuplicates(["refers_to"]), "refers_to", "left"), "warc-referred")
    revisits = attach(wanted, referred, "refers_to", "members")
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")
    responses = rows.filter(F.col("record_type") == "response")
    responses = responses.withColumns({"payload_bytes": F.col("own_bytes"), "payload_digest": F.col("own_digest")})
    return responses.select(*columns).unionByName(revisits.select(*columns))
