"""WARC archives without repeated payloads.

Headers, without payloads, are shuffled by payload digest; the record with the least page_id of a digest stays a response, the others
become revisit records that refer to it. Digests that occur once are not joined back; the table of the others is broadcast if its
measured size allows, so payloads stay where they are read. Archives are written by Spark's text writer: a record is text (the payload is HTML in UTF-8), and the
two line ends behind each record are the writer's line separator. Every file is a gzipped WARC file of its own. No file holds more
than a set number of bytes, or one record. Reading streams one file at a time, takes each record by its Content-Length, and digests the payload again.

Defined cases: a null payload is empty; payloads under ``least`` bytes are always responses; equal payloads of pages with equal ids
are both responses if that id is the least; a null page_id is written as an empty field, read as null, and is an original
only if its payload has no page with an id; a null url is an empty field; empty tables give archives without records.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlake.operators.lookups import lookup, table_bytes
from cardlake.session import scratch_path, stage

LEAST = 100
ARCHIVE_BYTES = 1 << 30  # payloads of one archive
END = "\r\n\r\n"


def resolve_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to, refers_to_url.

    A digest with a third of all rows is one row per task before its headers are shuffled. Where the table of repeated digests is
    too large to broadcast, its frequent ones are spread over many tasks in the join.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    heads = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload")).withColumn(
        "payload_digest", F.sha2(F.col("payload").cast("binary"), 256)).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long"))
    first = (heads.filter(F.col("payload_bytes") >= least).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("first_url"), F.count("*").alias("copies"))
             .filter("copies > 1 and first is not null").select("payload_digest", "first", "first_url"))
    first = stage(first, "repeated-digests")
    revisit = F.coalesce(F.col("first") != F.col("page_id"), F.col("first").isNotNull())
    return lookup(heads, first, "payload_digest", "left", table_bytes(first), spread=["page_id", "url"]).select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, F.lit("revisit")).otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"), F.when(revisit, F.col("first_url")).alias("refers_to_url"))


def _record_id(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat(F.coalesce(page.cast("string"), F.lit("")), F.lit(" "), digest).cast("binary"))
    return F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def _field(value: Column) -> Column:
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"[\r\n]", " ")


def largest_payload(pages: DataFrame, payload: str = "html") -> int:
    return pages.agg(F.max(F.octet_length(F.col(payload).cast("string")))).first()[0] or 1


def write_archives(records: DataFrame, path: str, largest: int | None = None, most: int = ARCHIVE_BYTES) -> None:
    """The records of ``resolve_revisits`` as gzipped WARC/1.1 files under ``path``.

    No file holds payloads of more than ``most`` bytes, or one record: as many records go to one as fit with the ``largest`` payload.
    """
    largest = largest or records.agg(F.max("payload_bytes")).first()[0] or 1
    is_revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    digest = F.concat(F.lit("sha256:"), F.col("payload_digest"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "), _record_id(F.col("page_id"), F.col("payload_digest")),
        F.lit("\r\nWARC-Date: "), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("\r\nWARC-Target-URI: "), _field(F.col("url")), F.lit("\r\nWARC-Payload-Digest: "), digest,
        F.lit("\r\nX-Page-Id: "), _field(F.col("page_id")),
        F.when(is_revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            _record_id(F.col("refers_to"), F.col("payload_digest")), F.lit("\r\nWARC-Refers-To-Target-URI: "), _field(F.col("refers_to_url")),
            F.lit("\r\nX-Refers-To-Page-Id: "), _field(F.col("refers_to")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"))
    records.select(F.concat(head, F.lit(END), block).alias("value")).write.option("lineSep", END).option("compression", "gzip") \
        .option("maxRecordsPerFile", max(1, most // max(1, largest))).text(path)


def parse_archive(content: bytes):
    """(fields, block) of each record, in order."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            fields[name.lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield fields, block


def _read(payload: bool):
    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for fields, block in parse_archive(content.as_py()):
                    http, _, body = block.partition(b"\r\n\r\n")
                    said = int(http.lower().partition(b"content-length:")[2].split(b"\r\n")[0])
                    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response" and (len(body) != said or hashlib.sha256(body).hexdigest() != digest):
                        raise ValueError(f"payload of {fields['warc-record-id']} does not match its header")
                    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                    rows.append((int(page) if page else None, fields.get("warc-target-uri"), said, digest, kind, int(refers) if refers else None,
                                 *([body.decode()] if payload and kind == "response" else [None] * payload)))
                    if len(rows) >= 1000:
                        yield _batch(rows, payload)
                        rows = []
                if rows:
                    yield _batch(rows, payload)
    return run


def _batch(rows, payload):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"][:6 + payload]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records under ``path``; with ``payload`` also the bodies of responses (null for revisits)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(_read(payload), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
                            "refers_to long" + (", payload string" if payload else ""))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    write_archives(resolve_revisits(pages), path, largest_payload(pages))
    return read_archives(spark, path).drop("url")
