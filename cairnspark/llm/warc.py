"""WARC as a content-addressed archive.

Payload bytes are stored once under their SHA-256, exact record headers in a table of
their own; original records come back by a join on the digest, and each payload is
verified against its digest when it is read. Of the records with one payload of at least
min_bytes the one with the largest key is the response, the others are revisits of it.
Both tables lie in one folder of the shared storage, which is the caller's to remove; export_text writes plain
WARC files. Records that share one payload with many others (empty or equal error pages) are joined in
parts, see common.attach.

Edge cases: null payload text: empty payload; equal empty payloads revisit as others do;
rows repeated with key and payload are all responses of one stored payload; null keys
count as smallest and are written as "null"; an empty table gives an empty archive; line
breaks in a URL are percent-encoded; columns other than key, url and html are not read.
"""

from __future__ import annotations

import base64
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnspark.llm.common import attach, cut, shared_folder, small_batches, table

CRLF = "\r\n"
DATE = "1970-01-01T00:00:00Z"  # the tables have no time of capture
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@F.pandas_udf(T.StringType())
def base32(hexadecimal: pd.Series) -> pd.Series:
    """Bare upper-case base32 of bytes given as hex."""
    return hexadecimal.map(lambda x: base64.b32encode(bytes.fromhex(x)).decode())


def _urn(key: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(">"))


def _header(response: Column) -> Column:
    """Exact header bytes of a record; for a response also the head of the HTTP message."""
    uri = F.coalesce(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), F.lit(""))
    length = F.when(response, F.lit(len(HTTP_HEAD)) + F.col("bytes")).otherwise(0)
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(response, "response").otherwise("revisit")),
        F.concat(F.lit("WARC-Record-ID: "), _urn(F.col("key"))),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(~response, F.concat(F.lit("WARC-Refers-To: "), _urn(F.col("first")))),
        F.when(~response, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    head = F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))  # concat_ws leaves nulls out
    return F.encode(F.concat(head, F.when(response, F.lit(HTTP_HEAD)).otherwise("")), "utf-8")


def write_archive(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0
) -> str:
    """Write payloads and headers of all pages below folder, a path that driver and executors share."""
    small_batches(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8")
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"))
    stored = rows.groupBy("digest").agg(F.first("payload").alias("payload"))
    stored.write.parquet(f"{folder}/payloads")

    keys = rows.select("key", "url", "digest", "bytes", F.sha1("payload").alias("sha1"))
    # a digest's first key matters only where rows repeat it, so the joined side is small
    first = cut(keys.filter(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.max("key").alias("first"), F.count("*").alias("n")).filter("n > 1"))
    joined = attach(keys.withColumn("sha1", base32("sha1")), first.drop("n"), ["digest"], first.select("digest", "n"), F.xxhash64("key", "url"))
    response = F.col("first").isNull() | F.col("first").eqNullSafe(F.col("key"))
    joined.select("digest", "key", _header(response).alias("header")).write.parquet(f"{folder}/headers")
    return folder


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """All records: digest, header, payload and record (exact bytes); fails on a payload that is not what its digest says."""
    payloads = spark.read.parquet(f"{folder}/payloads")
    sound = F.sha2("payload", 256) == F.col("digest")
    payloads = payloads.select(
        "digest",
        F.when(sound, F.col("payload")).otherwise(F.raise_error(F.lit("payload and digest differ"))).alias("payload"),
        F.when(sound, F.octet_length("payload").cast("long")).otherwise(F.raise_error(F.lit("payload and digest differ"))).alias("payload_bytes"),
        F.sha1("payload").alias("payload_sha1"),
    )
    end = F.encode(F.lit(CRLF + CRLF), "utf-8")
    headers = spark.read.parquet(f"{folder}/headers")
    counts = headers.groupBy("digest").agg(F.count("*").alias("n"))
    rows = attach(headers, payloads, ["digest"], counts, F.xxhash64("header"), "inner")
    body = F.when(field("WARC-Type") == "response", F.col("payload")).otherwise(F.encode(F.lit(""), "utf-8"))
    return rows.withColumn("record", F.concat(F.col("header"), body, end))


def field(name: str) -> Column:
    """Value of a header field, null where the header lacks it."""
    found = F.regexp_extract(F.decode(F.col("header"), "utf-8"), rf"(?m)^{name}: (.*?)\r?$", 1)
    return F.when(found != "", found)


def export_text(spark: SparkSession, folder: str, path: str, compression: str = "gzip") -> None:
    """Write the records as WARC files; the text writer's line end is the end of a record, so payloads must be UTF-8."""
    records = read_archive(spark, folder).select(F.decode("record", "utf-8").alias("value"))
    whole = F.expr(f"substring(value, 1, char_length(value) - {len(CRLF + CRLF)})")
    records.select(whole.alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", compression).text(path)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_archive(table(spark, sf_dir, "pages"), f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}")
    page = lambda x: F.regexp_extract(x, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")
    return read_archive(spark, folder).select(
        page(field("WARC-Record-ID")).alias("page_id"),
        "payload_bytes",
        base32("payload_sha1").alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        page(field("WARC-Refers-To")).alias("refers_to"),
        (F.concat(F.lit("sha1:"), base32("payload_sha1")) == field("WARC-Payload-Digest")).alias("digest_matches"),
    )


#: Base32 of the SHA-1 from its hex digits: five of them give four characters of five bits.
ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, html, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS first FROM p),
b AS (SELECT *, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
  CAST(list_sum([(instr('0123456789abcdef', substr(hex, CAST(5 * (i // 4) + k + 1 AS BIGINT), 1)) - 1) * CAST(pow(16, 4 - k) AS BIGINT) FOR k IN range(0, 5)]) AS BIGINT)
  // CAST(pow(2, 15 - 5 * (i % 4)) AS BIGINT)) % 32 AS BIGINT), 1) FOR i IN range(0, 32)], '') AS digest FROM h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, true AS digest_matches
FROM b
"""
