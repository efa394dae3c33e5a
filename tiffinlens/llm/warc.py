"""WARC archives: records written by Spark, read back, and put together from their segments.

A payload over the segment size becomes a first record and continuation records;
each names the first by WARC-Segment-Origin-ID and its place by
WARC-Segment-Number, the last also has the total length. Reading groups
continuations by their origin, orders them, checks numbers and length, and
undoes the chunked framing of HTTP bodies. Whole records never meet a shuffle;
segments do, under their origin's id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffinlens.plans.lineage import scratch_path

from .staging import staged

# Equal payloads of this many bytes are stored once; others revisit.
REVISIT_BYTES = 100
# Bytes of a record's block at most, before it goes on in a continuation.
SEGMENT_BYTES = 1 << 16
# Bytes of one chunk of a chunked body.
CHUNK_BYTES = 1 << 14
# Records of one archive file at most. No block is over SEGMENT_BYTES, so a file is read whole in under 130 MB.
RECORDS_PER_FILE = 2000
# Bytes of the records handed to Spark at once.
_BATCH = 1 << 23
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def payload_of(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, refers_to for every row of ``pages``.

    Of equal payloads of ``least`` bytes or more the smallest page_id is the one
    the others refer to. Only digests and ids are shuffled for that, after a
    map-side minimum. Rows that repeat a page_id with an equal payload are all
    responses; NULL ids refer, but are not referred to.
    """
    digested = pages.select(
        "page_id",
        "url",
        "html",
        F.octet_length(payload_of(F.col("html"))).cast("long").alias("payload_bytes"),
        F.sha2(payload_of(F.col("html")), 256).alias("payload_digest"),
    )
    # Digests of one page alone need no reference: what is joined are repeated payloads only. Written down, they
    # have a known size: few are broadcast, and pages stay where they are.
    firsts = staged(
        digested.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n"),
        "repeated",
    )
    return digested.join(firsts, "payload_digest", "left").select(
        "page_id",
        "url",
        "html",
        "payload_bytes",
        "payload_digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The body in chunked transfer framing."""
    parts = []
    for at in range(0, len(body), size):
        piece = body[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(framed: bytes) -> bytes:
    """The body inside chunked framing; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk without a size line")
        size = int(framed[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk shorter than its size")
        out.append(framed[at : at + size])
        at += size + 2


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record without the line end after it."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r"


def records_of(
    name: str,
    uri: str | None,
    payload: bytes,
    refers_to: str | None,
    segment_bytes: int = SEGMENT_BYTES,
) -> Iterator[bytes]:
    """The records of one payload: a revisit, or a response with as many continuations as it takes."""
    head = [("WARC-Record-ID", f"<{name}>"), ("WARC-Date", DATE)]
    if uri:
        head.append(("WARC-Target-URI", uri.replace("\r", "%0D").replace("\n", "%0A")))
    digest = ("WARC-Payload-Digest", f"sha256:{hashlib.sha256(payload).hexdigest()}")
    http = ("Content-Type", "application/http;msgtype=response")
    if refers_to is not None:
        yield record(
            [("WARC-Type", "revisit"), *head, digest, ("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", PROFILE),
             ("WARC-Payload-Length", str(len(payload))), http],
            REVISIT_HEAD,
        )
        return
    block = HTTP_HEAD + chunked(payload)
    if len(block) <= segment_bytes:
        yield record([("WARC-Type", "response"), *head, digest, http], block)
        return
    yield record(
        [("WARC-Type", "response"), *head, digest, ("WARC-Segment-Number", "1"), http], block[:segment_bytes]
    )
    for number, at in enumerate(range(segment_bytes, len(block), segment_bytes), 2):
        extra = [
            ("WARC-Record-ID", f"<{name}:{number}>"),
            ("WARC-Date", DATE),
            ("WARC-Segment-Origin-ID", f"<{name}>"),
            ("WARC-Segment-Number", str(number)),
        ]
        if at + segment_bytes >= len(block):
            extra.append(("WARC-Segment-Total-Length", str(len(block))))
        yield record([("WARC-Type", "continuation"), *extra], block[at : at + segment_bytes])


def _writer(segment_bytes: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, row = TaskContext.get().partitionId(), 0
        for frame in frames:
            rows: list[bytes] = []
            size = 0
            for name, uri, html, refers_to in zip(frame["name"], frame["url"], frame["html"], frame["refers_to"]):
                row += 1
                for one in records_of(
                    f"{name}#{task}-{row}",
                    uri if isinstance(uri, str) else None,
                    html.encode() if isinstance(html, str) else b"",
                    refers_to if isinstance(refers_to, str) else None,
                    segment_bytes,
                ):
                    rows.append(one)
                    size += len(one)
                if size >= _BATCH:
                    yield pd.DataFrame({"record": rows})
                    rows, size = [], 0
            if rows:
                yield pd.DataFrame({"record": rows})

    return run


def write_archives(
    pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE
) -> None:
    """Writes a record per row of ``pages`` (page_id, url, html, refers_to) into files under ``path``.

    A record is named by its page and, as a fragment, its place in the writing
    task: rows that repeat a page_id stay apart. References leave the fragment out.
    Spark's text writer puts the bytes down as they are; the last line end of a
    record is the writer's own separator, so any file system that Spark writes
    to will do and the files are plain WARC.
    """
    named = pages.select(
        name_of(F.col("page_id")).alias("name"),
        "url",
        "html",
        F.when(F.col("refers_to").isNotNull(), name_of(F.col("refers_to"))).alias("refers_to"),
    )
    named.mapInPandas(_writer(segment_bytes), "record binary").select(
        F.col("record").cast("string").alias("value")
    ).write.option("lineSep", "\n").option("maxRecordsPerFile", records_per_file).text(path)


def name_of(page_id: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")))


def parse_headers(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with a blank goes on with the last field."""
    fields: dict[str, str] = {}
    last = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            fields[last] = value.strip()
    return fields


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; ValueError where lengths do not fit."""
    at = 0
    while at < len(content):
        if content[at : at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        end = content.find(b"\r\n\r\n", at)
        fields = parse_headers(content[at:end])
        start = end + 4
        stop = start + int(fields["content-length"])
        if end < 0 or content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield fields, content[start:stop]
        at = stop + 4


RECORD = (
    "record_id string, origin_id string, record_type string, segment int, total long, uri string, "
    "digest string, refers_to string, payload_length long, block binary"
)

def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in RECORD.split(", ")]
    kinds = {"segment": pa.int32(), "total": pa.int64(), "payload_length": pa.int64(), "block": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def number(text: str | None) -> int | None:
        return int(text) if text else None

    def bare(text: str | None) -> str | None:
        return text.strip("<>") if text else None

    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            for h, block in parse_archive(content.as_buffer().to_pybytes()):
                rows.append(
                    (
                        bare(h.get("warc-record-id")),
                        bare(h.get("warc-segment-origin-id")),
                        h.get("warc-type"),
                        number(h.get("warc-segment-number")),
                        number(h.get("warc-segment-total-length")),
                        h.get("warc-target-uri"),
                        h.get("warc-payload-digest"),
                        bare(h.get("warc-refers-to")),
                        number(h.get("warc-payload-length")),
                        block,
                    )
                )
                size += len(block)
                if size >= _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``, as RECORD lists the columns."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("content")
        .mapInArrow(_reader, RECORD)
    )


def body_of(record_type: str, block: bytes) -> bytes:
    """The payload of a whole HTTP block: after its header, its chunked framing undone."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        return block
    fields = parse_headers(block[:end])
    body = block[end + 4 :]
    return unchunked(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [n for n in ("record_id", "record_type", "refers_to", "digest", "payload_length")]
    for batch in batches:
        bodies, errors = [], []
        for kind, block, error in zip(batch.column("record_type"), batch.column("block"), batch.column("error")):
            problem, body = error.as_py(), b""
            if problem is None:
                try:
                    body = body_of(kind.as_py(), block.as_buffer().to_pybytes() if block.is_valid else b"")
                except ValueError as wrong:
                    problem = str(wrong)
            bodies.append(body if problem is None else None)
            errors.append(problem)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], pa.array(bodies, pa.binary()), pa.array(errors, pa.string())],
            names=[*names, "payload", "error"],
        )


def reassembled(records: DataFrame) -> DataFrame:
    """record_id, record_type, refers_to, digest, payload_length, payload, error of each record and segmented record.

    Segments are grouped by their origin and ordered by number. ``error`` says
    what is wrong (a number missing or twice, no last segment, a total length
    that does not fit, broken framing); the payload is then NULL. A group holds
    the segments of one record, as long as that record and no longer.
    """
    plain = records.where("segment IS NULL").select(
        "record_id", "record_type", "refers_to", "digest", "payload_length", "block", F.lit(None).cast("string").alias("error")
    )
    first = F.col("segment") == 1
    grouped = (
        records.where("segment IS NOT NULL")
        .groupBy(F.coalesce("origin_id", "record_id").alias("record_id"))
        .agg(
            F.max(F.when(first, F.col("record_type"))).alias("record_type"),
            F.max(F.when(first, F.col("refers_to"))).alias("refers_to"),
            F.max(F.when(first, F.col("digest"))).alias("digest"),
            F.max("payload_length").alias("payload_length"),
            F.max("total").alias("total"),
            F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        )
        .withColumn("numbers", F.col("parts.segment"))
        .withColumn("size", F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"])))
        .withColumn(
            "error",
            F.when(F.col("numbers") != F.sequence(F.lit(1), F.size("numbers")), F.lit("segments missing or repeated"))
            .when(F.col("total").isNull(), F.lit("no last segment"))
            .when(F.col("total") != F.col("size"), F.lit("total length does not fit")),
        )
        .select(
            "record_id",
            "record_type",
            "refers_to",
            "digest",
            "payload_length",
            # Binary parts joined in order; bytes pass as they are.
            F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary").alias("block"),
            "error",
        )
    )
    schema = (
        "record_id string, record_type string, refers_to string, digest string, payload_length long, "
        "payload binary, error string"
    )
    return plain.unionByName(grouped).mapInArrow(_payloads, schema)


def round_trip(pages: DataFrame, path: str | None = None, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, error, as read back from archives of ``pages``.

    For responses, bytes and digest are those of the payload that was put
    together again; a revisit has no body, and tells its payload's own. A page
    that cannot be read back has an error. Rows of NULL page_id have NULL.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(with_revisits(pages), path, segment_bytes)
    found = reassembled(read_records(spark, path))
    response = F.col("record_type") == "response"
    told = F.regexp_replace("digest", "^sha256:", "")
    actual = F.sha2("payload", 256)
    return found.select(
        F.regexp_extract("record_id", r"^urn:page:(-?\d+)", 1).try_cast("long").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(response, actual).otherwise(told).alias("payload_digest"),
        "record_type",
        F.regexp_extract("refers_to", r"^urn:page:(-?\d+)", 1).try_cast("long").alias("refers_to"),
        F.coalesce("error", F.when(response & (actual != told), F.lit("digest does not fit"))).alias("error"),
    )
