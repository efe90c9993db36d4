"""WARC archives of pages: written with revisits, segments and chunked framing, and read back.

A response whose block is longer than a segment is cut: the first part is the
response itself, the others are continuation records that name it. Reading
groups continuation records by their origin, orders them by segment number,
checks numbers and total length, and takes the chunked framing off.

Files are written and read by Spark's own writers and readers, so they may lie in
any store. Payloads stay within the row of their page; only digests and the parts
of segmented records are shuffled, and a group never exceeds one payload.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicmill.llm.common import shielded
from topicmill.session import stage_path

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 2000
EOL = b"\r\n"

# The digits of base 32 as digests are written, and those of `conv`.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base 32 of the SHA-1: five hex digits are four base-32 ones."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV32, BASE32)


@shielded("page_id", "url", "html", made=("payload", "payload_bytes", "payload_digest", "record_type", "refers_to"))
def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds payload, payload_bytes, payload_digest, record_type and refers_to.

    Among equal payloads of at least `min_bytes` bytes the one with the largest
    page_id is the response and the others revisit it. A null html is an empty
    payload. A page without id revisits a response that has one; if no equal
    page has an id, all are responses, as are rows that repeat the largest id.
    """
    made = ["payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(*[c for c in pages.columns if c not in made]).withColumns(
        {"payload": payload, "payload_bytes": F.octet_length(payload).cast("long"), "payload_digest": base32_sha1(payload)}
    )
    # One row per repeated payload; counted on the map side, so copies of one
    # page by the million leave each task as one row.
    groups = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy(F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes"))
        .agg(F.max("page_id").alias("_response"), F.count("*").alias("_rows"))
        .where(F.col("_rows") > 1)
    )
    joined = rows.join(groups, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") == F.col("_bytes")), "left")
    revisit = F.col("_response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_response"))
    return joined.withColumns(
        {
            "record_type": F.when(revisit, "revisit").otherwise("response"),
            "refers_to": F.when(revisit, F.col("_response")),
        }
    ).drop("_digest", "_bytes", "_response", "_rows")


# --- writing ---------------------------------------------------------------------


def chunked(payload: bytes, size: int) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts += [b"%x" % len(part), EOL, part, EOL]
    return b"".join([*parts, b"0", EOL, EOL])


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [b"WARC/1.1"] + [f"{name}: {value}".encode() for name, value in headers if value is not None]
    return EOL.join([*lines, b"Content-Length: %d" % len(block), b"", block])


def page_records(page: dict, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The records of one planned page, without the blank lines between records."""
    own = f"<urn:uuid:{uuid.uuid4()}>"
    # A header is one line; a URL with line ends is kept as one.
    url = None if page["url"] is None else page["url"].replace("\r", "%0D").replace("\n", "%0A")
    head = [
        ("WARC-Type", page["record_type"]),
        ("WARC-Record-ID", own),
        ("WARC-Target-URI", url),
        ("X-Page-ID", page["page_id"]),
        ("WARC-Payload-Digest", f"sha1:{page['payload_digest']}"),
    ]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    kind = ("Content-Type", "application/http; msgtype=response")
    if page["record_type"] == "revisit":
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head += [("WARC-Profile", profile), ("WARC-Refers-To", f"<urn:page:{page['refers_to']}>"), kind]
        yield _record(head, http + b"Content-Length: %d\r\n\r\n" % page["payload_bytes"])
        return
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(page["payload"], chunk_bytes)
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    if len(parts) > 1:
        head.append(("WARC-Segment-Number", 1))
    yield _record([*head, kind], parts[0])
    for number, part in enumerate(parts[1:], 2):
        last = len(block) if number == len(parts) else None
        yield _record(
            [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                ("WARC-Segment-Origin-ID", own),
                ("WARC-Segment-Number", number),
                ("WARC-Segment-Total-Length", last),
            ],
            part,
        )


def write_warc(
    planned: DataFrame,
    path: str,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
    compression: str = "gzip",
) -> None:
    """Write planned pages as WARC files.

    The text writer puts the blank lines that end a record after each row.
    """
    columns = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def records(batches):
        for batch in batches:
            found, size = [], 0
            for i in range(batch.num_rows):
                page = {c: batch.column(j)[i].as_py() for j, c in enumerate(columns)}
                for record in page_records(page, segment_bytes, chunk_bytes):
                    found.append(record)
                    size += len(record)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["value"])
                    found, size = [], 0
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["value"])

    # A revisit says nothing about its payload but the digest: it isn't sent.
    lean = planned.withColumn("payload", F.when(F.col("record_type") == "response", F.col("payload")))
    lines = lean.select(*columns).mapInArrow(records, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file).option(
        "compression", compression
    ).text(path)


# --- reading ---------------------------------------------------------------------


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a file."""
    at = 0
    while (end := data.find(b"\r\n\r\n", at)) >= 0:
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        start = end + 4
        stop = start + int(headers["content-length"])
        yield headers, data[start:stop]
        at = stop + 4


def dechunk(body: bytes) -> bytes | None:
    """The payload below chunked framing; None where the framing is broken."""
    parts, at = [], 0
    while (end := body.find(EOL, at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        if size == 0:
            return b"".join(parts)
        if body[end + 2 + size : end + 4 + size] != EOL:
            return None
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size
    return None


def http_payload(block: bytes) -> tuple[bytes | None, int | None]:
    """Payload of an HTTP response block and the length its headers state."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(EOL)[1:])}
    stated = int(fields[b"content-length"]) if b"content-length" in fields else None
    return (dechunk(body) if fields.get(b"transfer-encoding", b"").lower() == b"chunked" else body), stated


RECORD = "record_id string, origin_id string, segment int, total_length long, page_id long, url string, record_type string, refers_to long, digest string, block binary"
_NAMES = [x.split()[0] for x in RECORD.split(", ")]
_ARROW = pa.schema(
    list(zip(_NAMES, [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]))
)


def _row(headers: dict[str, str], block: bytes) -> dict:
    refers = headers.get("warc-refers-to", "").strip("<>").removeprefix("urn:page:")
    return {
        "record_id": headers.get("warc-record-id"),
        "origin_id": headers.get("warc-segment-origin-id"),
        "segment": int(headers["warc-segment-number"]) if "warc-segment-number" in headers else None,
        "total_length": int(headers["warc-segment-total-length"]) if "warc-segment-total-length" in headers else None,
        "page_id": int(headers["x-page-id"]) if "x-page-id" in headers else None,
        "url": headers.get("warc-target-uri"),
        "record_type": headers.get("warc-type"),
        "refers_to": int(refers) if refers.isdigit() else None,
        "digest": headers.get("warc-payload-digest", "").removeprefix("sha1:"),
        "block": block,
    }


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records below a folder, one row each, segments still apart."""

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                found, size = [], 0
                for headers, block in parse_records(data):
                    found.append(_row(headers, block))
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(found, _ARROW)
                        found, size = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist(found, _ARROW)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(parse, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Responses and revisits with their whole block.

    Adds `complete`: segment numbers run from 1 without gap or repeat and the
    parts add up to the stated total length. An incomplete record keeps a null
    block; continuation records without their origin give nothing.
    """
    whole = records.where("segment is null and record_type in ('response', 'revisit')")
    parts = records.where("segment is not null").withColumn("_origin", F.coalesce("origin_id", "record_id"))
    first = F.col("segment") == 1
    head = [c for c in _NAMES if c not in ("block", "total_length", "segment", "origin_id")]
    grouped = parts.groupBy("_origin").agg(
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("_parts"),
        F.max("total_length").alias("total_length"),
        *[F.first(F.when(first, F.col(c)), ignorenulls=True).alias(c) for c in head],
    )
    numbers = F.transform("_parts", lambda p: p["segment"])
    # Concatenated as text: the bytes of parts go through unchanged.
    joined = F.concat_ws("", F.transform("_parts", lambda p: p["block"].cast("string"))).cast("binary")
    grouped = (
        grouped.where("record_id is not null")
        .withColumn("_joined", joined)
        .withColumn(
            "complete",
            F.coalesce(
                (numbers == F.sequence(F.lit(1), F.size("_parts"))) & (F.octet_length("_joined") == F.col("total_length")),
                F.lit(False),
            ),
        )
        .withColumn("block", F.when(F.col("complete"), F.col("_joined")))
    )
    columns = [*head, "block", "complete"]
    return whole.withColumn("complete", F.lit(True)).select(*columns).unionByName(grouped.select(*columns))


PAGE = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary, valid boolean"


def decode(whole: DataFrame) -> DataFrame:
    """Payloads of whole records.

    `valid`: the record is complete, its framing is sound and, for a response,
    the payload has the stated digest. A revisit has no payload; its length is
    the one that its HTTP headers state.
    """

    def pages(batches):
        for batch in batches:
            found, lengths = [], []
            for block in batch.column(batch.num_columns - 1):
                data = block.as_py()
                payload, stated = (None, None) if data is None else http_payload(data)
                found.append(payload)
                lengths.append(stated if stated is not None else None if payload is None else len(payload))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            names = [f.name for f in batch.schema][:-1]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lengths, pa.int64()), pa.array(found, pa.binary())], [*names, "payload_bytes", "payload"]
            )

    head = ["page_id", "url", "record_type", "refers_to", "digest", "complete"]
    schema = "page_id long, url string, record_type string, refers_to long, digest string, complete boolean, payload_bytes long, payload binary"
    rows = whole.select(*head, "block").mapInArrow(pages, schema)
    own = base32_sha1(F.col("payload"))
    response = F.col("record_type") == "response"
    return rows.select(
        "page_id",
        "url",
        "record_type",
        "refers_to",
        F.when(response & F.col("payload").isNotNull(), own).otherwise(F.col("digest")).alias("payload_digest"),
        "payload_bytes",
        F.when(response, F.col("payload")).alias("payload"),
        F.when(response, F.coalesce(F.col("complete") & (own == F.col("digest")), F.lit(False))).otherwise(F.col("complete")).alias("valid"),
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the archives below a folder: see `PAGE` for the columns."""
    return decode(reassemble(read_records(spark, path)))


def archive_round_trip(pages: DataFrame, min_bytes: int = 0, **options) -> DataFrame:
    """Write pages into archives in the shared folder and read them back."""
    path = stage_path(pages.sparkSession, "warc")
    write_warc(plan_records(pages, min_bytes), path, **options)
    return read_pages(pages.sparkSession, path)
