"""WARC archives as tables of chunks: (record, chunk number) rows written as record segments, and read back.

A payload is streamed in chunks of bounded size. Each chunk is a row, and a record of its own in the archive: the first
is the `response`, the others are `continuation` segments with their number, and every one carries the digest of the
payload so far. No step holds more than a chunk of a payload beside the cell it came in. Archives are written with
Spark's text writer, whose line end is the end of a record, and read with its text reader, whose separator is a
record's end and the next one's first line; so they can be read in splits, in any store that Spark reaches. A chunk
ends within every `WARC/1.1` of a payload, hence that separator can't occur inside a record.

Of equal payloads of at least `least` bytes the row with the largest id is the response (a null id is smaller than any;
of repeated rows the one with the largest locator); the others are `revisit` records without payload. Null payloads
count as empty. Every row has its record, repeated rows too; an empty table gives empty archives and results. Further
columns are not read. Line ends within ids and URLs are percent-encoded.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.llm.common import LOCATOR, located, slices, small_batches, stored, without_keys
from quirelake.session import scratch

VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
#: What stands between the content of two records, seen from a reader.
BETWEEN = (END + VERSION + b"\r\n").decode()
_VERSION = re.compile(re.escape(VERSION))
CHUNK = 1 << 20
LEAST = 1000
DATE = "2000-01-01T00:00:00Z"


def cuts(view: memoryview, chunk: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Starts and ends of the chunks of a payload; an empty payload has one. The payload is searched in place, once."""
    start, size = 0, len(view)
    while True:
        stop = min(start + chunk, size)
        found = _VERSION.search(view, start, stop)
        if found:
            stop = found.start() + 4
        yield start, stop
        if stop >= size:
            return
        start = stop


def _clean(value) -> bytes:
    text = "" if value is None else str(value)
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A").encode()


def _unclean(value: bytes) -> str:
    return value.decode().replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _record_id(file: int, row: int) -> bytes:
    return f"<urn:uuid:{uuid.UUID(int=(file & (1 << 64) - 1) << 64 | row)}>".encode()


def _head(fields: list[tuple[bytes, bytes]]) -> bytes:
    return VERSION + b"\r\n" + b"".join(k + b": " + v + b"\r\n" for k, v in fields) + b"\r\n"


def _segments(record: bytes, page: bytes, url: bytes, payload: memoryview, digest: str, chunk: int) -> Iterator[bytes]:
    running, number = hashlib.sha1(), 0
    for start, stop in cuts(payload, chunk):
        number += 1
        last = stop == len(payload)
        block = bytes(payload[start:stop])
        running.update(block)
        own = record if number == 1 else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, record.decode() + str(number))}>".encode()
        fields = [
            (b"WARC-Type", b"response" if number == 1 else b"continuation"), (b"WARC-Record-ID", own),
            (b"WARC-Date", DATE.encode()), (b"WARC-Target-URI", url), (b"X-Page-ID", page),
            (b"WARC-Payload-Digest", b"sha1:" + digest.encode()),
            (b"X-Running-Digest", b"sha1:" + running.hexdigest().encode()),
            (b"Content-Type", b"text/html"), (b"Content-Length", str(len(block)).encode()),
        ]
        if number > 1 or not last:
            fields.append((b"WARC-Segment-Number", str(number).encode()))
        if number > 1:
            fields.append((b"WARC-Segment-Origin-ID", record))
            if last:
                fields.append((b"WARC-Segment-Total-Length", str(len(payload)).encode()))
        yield _head(fields) + block


def _revisit(record: bytes, page: bytes, url: bytes, digest: str, size: int, refers: bytes, refers_page: bytes) -> bytes:
    return _head([
        (b"WARC-Type", b"revisit"), (b"WARC-Record-ID", record), (b"WARC-Date", DATE.encode()),
        (b"WARC-Target-URI", url), (b"X-Page-ID", page), (b"WARC-Payload-Digest", b"sha1:" + digest.encode()),
        (b"WARC-Profile", b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        (b"WARC-Refers-To", refers), (b"X-Refers-To-Page-ID", refers_page), (b"X-Payload-Length", str(size).encode()),
        (b"Content-Length", b"0"),
    ])


def write_archives(
    pages: DataFrame, path: str, payload: str = "html", page_id: str = "page_id", url: str = "url",
    least: int = LEAST, chunk: int = CHUNK,
) -> None:
    """Write the pages as WARC files below `path`, one per task."""
    small_batches(pages.sparkSession, 128)
    rows = located(pages).select(
        LOCATOR, F.col(page_id).cast("bigint").alias("page"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    )
    size = F.octet_length("payload").cast("bigint")
    # Only payloads that can have a revisit are compared, by length and SHA-256; no payload is shuffled for it.
    narrow = stored(
        rows.filter(size >= least).select(LOCATOR, "page", "url", size.alias("size"), F.sha2("payload", 256).alias("key")), "payload-keys"
    )
    groups = narrow.groupBy("key", "size").agg(F.max(F.struct("page", LOCATOR)).alias("top"), F.count(F.lit(1)).alias("n"))
    again = stored(
        narrow.join(groups.filter("n > 1"), ["key", "size"]).filter(F.col(LOCATOR) != F.col("top")[LOCATOR]), "revisits"
    )
    responses = without_keys(rows, again, LOCATOR).select(
        f"{LOCATOR}.file", f"{LOCATOR}.row", "page", "url", "payload", F.sha1("payload").alias("digest")
    )

    def respond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            file, row, page, target, _, digest = (batch.column(i) for i in range(6))
            out, held = [], 0
            for i in range(batch.num_rows):
                view = memoryview(batch.column(4)[i].as_buffer())
                record = _record_id(file[i].as_py(), row[i].as_py())
                for segment in _segments(record, _clean(page[i].as_py()), _clean(target[i].as_py()), view, digest[i].as_py(), chunk):
                    out.append(segment)
                    held += len(segment)
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                        out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    # A revisit's digest is that of its response, whose payload it shares.
    digests = responses.select(F.struct("file", "row").alias("__top"), "digest")
    pointing = again.select(
        LOCATOR, "page", "url", "size", F.col("top")[LOCATOR].alias("__top"), F.col("top")["page"].alias("refers")
    ).join(digests, "__top")

    def revisit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [
                _revisit(
                    _record_id(r["file"], r["row"]), _clean(r["page"]), _clean(r["url"]), r["digest"], r["size"],
                    _record_id(r["top_file"], r["top_row"]), _clean(r["refers"]),
                )
                for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    revisits = pointing.select(
        f"{LOCATOR}.file", f"{LOCATOR}.row", "page", "url", "size", "refers", "digest",
        F.col("__top.file").alias("top_file"), F.col("__top.row").alias("top_row"),
    ).mapInArrow(revisit, "value binary")
    records = responses.mapInArrow(respond, "value binary").unionByName(revisits)
    records.select(F.col("value").cast("string")).write.option("lineSep", END.decode()).text(path)


SEGMENT = (
    "record string, page bigint, type string, url string, digest string, size bigint, refers bigint, number int, "
    "total bigint, running string, data binary"
)


def _number(value: bytes | None) -> int | None:
    return int(value) if value else None


def _parse(value: bytes) -> dict:
    value = value.removeprefix(VERSION + b"\r\n")
    head, _, rest = value.partition(END)
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n"))
    block = rest[: int(fields[b"Content-Length"])]
    kind = fields[b"WARC-Type"].decode()
    return {
        "record": fields.get(b"WARC-Segment-Origin-ID", fields[b"WARC-Record-ID"]).decode(),
        "page": _number(fields[b"X-Page-ID"]), "type": kind, "url": _unclean(fields[b"WARC-Target-URI"]),
        "digest": fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:"),
        "size": _number(fields.get(b"X-Payload-Length")) if kind == "revisit" else len(block),
        "refers": _number(fields.get(b"X-Refers-To-Page-ID")), "number": _number(fields.get(b"WARC-Segment-Number")),
        "total": _number(fields.get(b"WARC-Segment-Total-Length")),
        "running": fields.get(b"X-Running-Digest", b"").decode().removeprefix("sha1:"), "data": block,
    }


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table: a row per record or segment. `data` stays only where a record has several segments;
    `digest` of a response in one piece is computed from its content."""
    small_batches(spark, 128)
    values = spark.read.option("lineSep", BETWEEN).text(path).select(F.col("value").cast("binary"))
    names = [c.split(" ")[0] for c in SEGMENT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(list(zip(names, [
            pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(),
            pa.string(), pa.binary(),
        ], strict=True)))
        for batch in slices(batches):
            out = []
            for value in batch.column(0):
                found = _parse(value.as_py())
                if found["number"] is None:
                    if found["type"] == "response":
                        found["digest"] = hashlib.sha1(found["data"]).hexdigest()
                    found["data"] = None
                out.append(found)
            yield pa.RecordBatch.from_pylist(out, schema)

    return values.mapInArrow(run, SEGMENT)


RECORD = "page bigint, url string, type string, refers bigint, size bigint, digest string"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per record; segmented ones are digested chunk by chunk in order, and checked on the way."""
    segments = stored(read_segments(spark, path), "segments")
    whole = segments.filter("number IS NULL").select("page", "url", "type", "refers", "size", "digest")
    parts = segments.filter("number IS NOT NULL").select("record", "number", "page", "url", "total", "running", "data")
    ordered = parts.repartition(F.col("record")).sortWithinPartitions("record", "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, number, size, hasher = None, 0, 0, None
        for batch in slices(batches):
            out = []
            for i in range(batch.num_rows):
                own, n, page, url, total, running = (batch.column(k)[i].as_py() for k in range(6))
                if own != record:
                    record, number, size, hasher = own, 0, 0, hashlib.sha1()
                data = memoryview(batch.column(6)[i].as_buffer())
                hasher.update(data)
                number, size = number + 1, size + len(data)
                if n != number or running != hasher.hexdigest():
                    raise ValueError(f"{record}: segment {n} is out of order or damaged")
                if total is not None:
                    if total != size:
                        raise ValueError(f"{record}: {size} of {total} bytes")
                    out.append({"page": page, "url": url, "type": "response", "refers": None, "size": size, "digest": hasher.hexdigest()})
            schema = pa.schema([("page", pa.int64()), ("url", pa.string()), ("type", pa.string()), ("refers", pa.int64()), ("size", pa.int64()), ("digest", pa.string())])
            yield pa.RecordBatch.from_pylist(out, schema)

    return whole.unionByName(ordered.mapInArrow(run, RECORD))


def round_trip(pages: DataFrame, payload: str = "html", page_id: str = "page_id", url: str = "url", **sizes) -> DataFrame:
    """Write the pages as archives into the shared folder and read their records."""
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path, payload, page_id, url, **sizes)
    return read_records(pages.sparkSession, path)
