"""WARC archives: write captures, read records, assemble transactions.

Every page becomes three records: its response (or a revisit of an equal payload),
the request, and metadata, the latter two tied to the first by WARC-Concurrent-To.
Spark's text writer puts them into gzip files: a record ends in two line ends, which
is the writer's line separator. Reading is the reverse: Spark's text reader deals
out the pieces between double line ends, file by file and in order, and a parser
that holds one record at a time cuts them by Content-Length, so that a payload may
hold double line ends itself. Assembly groups the records by the capture they name.

Defined results: a missing payload is an empty one; a missing page id or URL leaves
out its line; control characters and blanks in a URL are percent-encoded. Rows that
repeat page id, URL and payload are the same record, written as often as given and
read back as one capture with that many `copies`. A capture whose response is not in
the archives has a null response; of several requests or metadata records of one
capture the one with the smallest record id counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.llm.common import saved

END = "\r\n\r\n"
# Payloads below this size are written in full even when they repeat.
REVISIT_FROM_BYTES = 1000
# Bounds the size of an archive file: three records for each page.
RECORDS_PER_FILE = 15_000

RECORD_SCHEMA = (
    "record_type string, record_id string, concurrent_to string, refers_to string, "
    "target_uri string, declared_digest string, payload_bytes long, payload_digest string, "
    "fields string, payload binary"
)


def _record_id(kind: str, *parts: Column) -> Column:
    """A UUID that follows from what the record describes."""
    texts = [F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]
    h = F.md5(F.concat_ws("\x01", F.lit(kind), *texts).cast("binary"))
    cut = [F.substring(h, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _encoded(url: Column) -> Column:
    """The URL with blanks and control characters percent-encoded."""
    parts = F.transform(
        F.regexp_extract_all(url, F.lit(r"(?s)[\x00-\x20\x7F]|[^\x00-\x20\x7F]+"), F.lit(0)),
        lambda x: F.when(
            x.rlike(r"^[\x00-\x20\x7F]"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(x)), 2, "0"))
        ).otherwise(x),
    )
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), F.concat_ws("", parts)).otherwise(url)


def _record(kind: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    """A whole record but for its end; lines without a value are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), *lines, length
    )
    return F.concat(head, F.lit(END), block)


def with_revisits(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) with payload size, digest and, for a revisit, its original.

    Only digests are grouped, combined before their shuffle. The groups are written,
    so that the join back starts from two shuffles and a hot payload can be split.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(
        "page_id",
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("n_bytes"),
    )
    groups = (
        rows.where(F.col("n_bytes") >= REVISIT_FROM_BYTES)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max(F.struct("page_id", "url")).alias("original"))
        .where("n > 1")
        .select(F.col("digest"), "original")
    )
    return rows.join(saved(groups, "warc-groups"), "digest", "left")


def write_archives(pages: DataFrame, path: str) -> None:
    """One archive folder with a response or revisit, a request and metadata per page."""
    rows = with_revisits(pages)
    own = F.struct("page_id", "url")
    revisit = F.col("original").isNotNull() & ~F.col("original").eqNullSafe(own)
    url = _encoded(F.col("url"))
    capture = _record_id("capture", F.col("page_id"), F.col("url"), F.col("digest"))
    original = _record_id(
        "capture", F.col("original.page_id"), F.col("original.url"), F.col("digest")
    )
    date = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http_head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n_bytes").cast("string"),
        F.lit(END),
    )
    response = _record(
        F.when(revisit, "revisit").otherwise("response"),
        [
            ("WARC-Record-ID", capture),
            ("WARC-Date", date),
            ("WARC-Target-URI", url),
            ("WARC-Refers-To", F.when(revisit, original)),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("Content-Type", F.lit("application/http;msgtype=response")),
        ],
        F.concat(http_head, F.when(revisit, "").otherwise(F.col("html"))),
    )
    host = F.regexp_extract(url, r"^[^:]*://([^/?#]*)", 1)
    target = F.coalesce(F.regexp_extract(url, r"^[^:]*://[^/?#]*([^#]*)", 1), F.lit(""))
    request = _record(
        F.lit("request"),
        [
            ("WARC-Record-ID", _record_id("request", capture)),
            ("WARC-Date", date),
            ("WARC-Target-URI", url),
            ("WARC-Concurrent-To", capture),
            ("Content-Type", F.lit("application/http;msgtype=request")),
        ],
        F.concat(
            F.lit("GET "),
            F.when(target == "", "/").otherwise(target),
            F.lit(" HTTP/1.1\r\nHost: "),
            F.coalesce(host, F.lit("")),
            F.lit(END),
        ),
    )
    metadata = _record(
        F.lit("metadata"),
        [
            ("WARC-Record-ID", _record_id("metadata", capture)),
            ("WARC-Date", date),
            ("WARC-Target-URI", url),
            ("WARC-Concurrent-To", capture),
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string")), F.lit("")),
    )
    rows.select(F.explode(F.array(response, request, metadata)).alias("value")).write.option(
        "lineSep", END
    ).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _parsed(stream: bytes, at: int, keep_payload: bool) -> tuple[tuple, int] | None:
    """The record that begins at `at` and the place behind it; None if it is not all there."""
    head_end = stream.find(b"\r\n\r\n", at)
    if head_end < 0:
        return None
    lines = stream[at:head_end].decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    start = head_end + 4
    stop = start + int(fields["content-length"])
    if len(stream) < stop + 4:
        return None
    kind = fields.get("warc-type")
    payload = text = None
    if kind in ("response", "revisit"):
        cut = stream.find(b"\r\n\r\n", start, stop)
        if kind == "response":
            http = fields.get("content-type", "").startswith("application/http") and cut >= 0
            payload = stream[cut + 4 if http else start : stop]
    else:
        text = stream[start:stop].decode("utf-8", "replace")
    digest = fields.get("warc-payload-digest", "")
    row = (
        kind,
        fields.get("warc-record-id"),
        fields.get("warc-concurrent-to"),
        fields.get("warc-refers-to"),
        fields.get("warc-target-uri"),
        digest.removeprefix("sha1:") or None,
        None if payload is None else len(payload),
        None if payload is None else hashlib.sha1(payload).hexdigest(),
        text,
        payload if keep_payload else None,
    )
    return row, stop + 4


def read_records(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """One row per record of the gzip archives below `path`.

    A gzip file is read by one task from its start, which keeps its pieces in order.
    A record without WARC line or Content-Length, or one cut short, fails the read.
    """
    pieces = spark.read.option("lineSep", END).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece")
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [
            pa.field(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string())
            for n in (c.split()[0] for c in RECORD_SCHEMA.split(", "))
        ]
        file, rest = None, b""
        for batch in batches:
            rows, parts = [], [rest]

            def take(parts: list[bytes]) -> bytes:
                stream, at = b"".join(parts), 0
                while at < len(stream) and (found := _parsed(stream, at, keep_payload)):
                    row, at = found
                    rows.append(row)
                return stream[at:]

            files = batch.column("file").to_pylist()
            for name, piece in zip(files, batch.column("piece").to_pylist(), strict=True):
                if name != file:
                    if take(parts).strip(b"\r\n"):
                        raise ValueError(f"{file}: the last record is cut short")
                    file, parts = name, []
                parts += [piece, b"\r\n\r\n"]
            rest = take(parts)
            columns = list(zip(*rows, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, types, strict=True)], schema=pa.schema(types)
            )
        if rest.strip(b"\r\n"):
            raise ValueError(f"{file}: the last record is cut short")

    return pieces.mapInArrow(parse, RECORD_SCHEMA)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, request and metadata.

    All records of a capture meet at its record id: that of the response, and for the
    others the one they are concurrent to. Each side is reduced to one record before
    the shuffle, so a capture that very many records name stays small.
    """
    answer = F.col("record_type").isin("response", "revisit")
    key = F.when(answer, F.col("record_id")).otherwise(F.col("concurrent_to"))
    response = F.struct(
        "record_id", "record_type", "refers_to", "target_uri", "payload_bytes",
        "payload_digest", "declared_digest", "payload",
    )
    other = F.struct("record_id", "target_uri", "fields")
    kind = F.col("record_type")
    return (
        records.where(key.isNotNull())
        .groupBy(key.alias("capture_id"))
        .agg(
            F.count_if(answer).alias("copies"),
            F.min(F.when(answer, response)).alias("response"),
            F.min(F.when(kind == "request", other)).alias("request"),
            F.min(F.when(kind == "metadata", other)).alias("metadata"),
        )
    )
