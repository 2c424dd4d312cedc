"""WARC: a content-addressed archive.

Payload bytes are stored once per SHA-256 digest; every record's exact header
text is kept apart with the digest of its payload.  Reading joins the two,
checks each payload against its digest and puts the original records together
again.

Of the records with equal payloads of at least ``min_revisit`` bytes, the one
with the smallest id is the response and the others are revisits of it;
smaller payloads make responses only (they too are stored once).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _one_line(text: Column) -> Column:
    """A header value; line breaks inside it are percent-encoded."""
    out = F.coalesce(text, F.lit(""))
    return F.replace(F.replace(out, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_revisit: int = 100,
                  date: str = "1970-01-01T00:00:00Z") -> str:
    """Write one record per row of ``pages`` below ``path``.

    ``path/payloads`` holds (digest, payload, payload_bytes), ``path/headers``
    holds (page_id, url, digest, header).  A null payload is empty.  A record
    without an id is never the one others refer to; a group that has only
    such records, and rows that repeat the smallest id, are responses.  Other
    columns of ``pages`` are not archived.  Rows that share a digest but
    differ in length or in a second hash stop the write.
    """
    payload = F.encode(F.coalesce(F.col(f"`{payload_col}`"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})

    check = F.xxhash64("payload")
    same = (F.min("payload_bytes") == F.max("payload_bytes")) & (F.min(check) == F.max(check))
    stored = rows.groupBy("digest").agg(F.any_value("payload").alias("payload"),
                                        F.min("payload_bytes").alias("payload_bytes"), same.alias("same"))
    (stored.where(F.when(F.col("same"), True).otherwise(F.raise_error(F.lit("payloads differ under one digest"))))
     .select("digest", "payload", "payload_bytes").write.parquet(f"{path}/payloads"))

    slim = rows.select("page_id", "url", "digest", "payload_bytes")
    first = (slim.where(F.col("payload_bytes") >= min_revisit).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
             .select(F.col("digest").alias("of"), "first"))
    typed = slim.join(first, F.col("digest") == F.col("of"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}{CRLF}")
    body = F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")) + F.length(http)
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{CRLF}WARC-Record-ID: "), _record_id(F.col("page_id")),
        F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: "), _one_line(F.col("url")),
        F.lit(f"{CRLF}WARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response"),
        F.when(revisit, F.concat(
            F.lit(f"{CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            F.lit(f"{CRLF}WARC-Refers-To: "), _record_id(F.col("first")))).otherwise(F.lit("")),
        F.lit(f"{CRLF}Content-Length: "), body.cast("string"), F.lit(CRLF + CRLF), http)
    typed.select("page_id", "url", "digest", header.alias("header")).write.parquet(f"{path}/headers")
    return path


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records: page_id, url, header, payload, and ``record``, the bytes of
    the WARC record as such (a revisit's has no payload).

    A payload whose bytes do not have its digest, or a header whose payload
    is not there, stops the read.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").withColumnsRenamed({"digest": "stored"})
    sound = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload missing or damaged: "), F.col("digest"))))
    whole = headers.join(payloads, F.col("digest") == F.col("stored"), "left").withColumn("payload", sound)
    body = F.when(F.col("header").contains(f"{CRLF}WARC-Type: revisit{CRLF}"), F.lit("").cast("binary")).otherwise(
        F.col("payload"))
    record = F.concat(F.encode("header", "UTF-8"), body, F.lit(CRLF + CRLF).cast("binary"))
    return whole.select("page_id", "url", "header", "payload", record.alias("record"))


def header_field(header: Column, name: str) -> Column:
    """The value of a named field in a record's header, null when absent."""
    found = F.regexp_extract(header, f"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)
