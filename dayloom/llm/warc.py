"""WARC archives in Zstandard: a dictionary in the leading skippable frame, one frame a record."""
from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.llm.common import keep
from dayloom.session import scratch_path

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 32 << 20  # of records before compression; an archive ends after the record that passes it
DICTIONARY_BYTES, SAMPLE_BYTES, LEAST_SAMPLES = 16 << 10, 1 << 20, 16
ROWS_AT_ONCE, BYTES_AT_ONCE = 256, 4 << 20
FIRST = "WARC/1.1\r\n"
RECORD_SCHEMA = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"


class BadArchive(ValueError):
    """An archive that breaks the format."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url, payload: bytes, refers_to, digest: str, size: int) -> bytes:
    """A response with its payload as an HTTP body, or a revisit with its HTTP header alone."""
    name = lambda i: "urn:page:" + ("null" if i is None else str(i))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{name(page_id)}>")]
    if url is not None:
        odd = re.search(r"[\r\n]|^\s|\s$|^b64:", url)  # would not survive as a header line
        head.append(("WARC-Target-URI", "b64:" + base64.b64encode(url.encode()).decode() if odd else url))
    if revisit:
        head += [("WARC-Refers-To", f"<{name(refers_to)}>"), ("WARC-Profile", PROFILE)]
    head += [
        ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", "sha1:" + digest), ("WARC-Block-Digest", "sha1:" + digest_of(block)),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of one record; raises where a header is missing or malformed, or a length or digest is wrong."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] not in (b"WARC/1.0", VERSION):
        raise BadArchive("a record does not start with its version and headers")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        key, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!#$%&'*+.^_`|~0-9A-Za-z-]+", key):
            raise BadArchive(f"a header line is malformed: {line[:80]!r}")
        if (k := key.decode().lower()) in fields:
            raise BadArchive(f"a header is given twice: {k}")
        fields[k] = value.decode().strip(" \t")
    for key in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if key not in fields:
            raise BadArchive(f"a record has no {key}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BadArchive("a record's length differs from its header")
    block = rest[:-4]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != "sha1:" + digest_of(block):
        raise BadArchive("a block differs from its digest")
    kind = fields["warc-type"]
    http, mark, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?mi)^content-length: (\d+)\r?$", http)
    if kind not in ("response", "revisit") or not mark or not size:
        raise BadArchive(f"not a response or revisit with an HTTP header: {kind}")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload) != int(size[1]) or digest_of(payload) != digest):
        raise BadArchive("a payload differs from its length or digest")
    number = lambda key: None if (v := fields.get(key, "null>").removeprefix("<urn:page:")[:-1]) == "null" else int(v)
    url = fields.get("warc-target-uri")
    return {
        "page_id": number("warc-record-id"), "url": base64.b64decode(url[4:]).decode() if url and url.startswith("b64:") else url,
        "record_type": kind, "payload_bytes": int(size[1]), "payload_digest": digest,
        "refers_to": number("warc-refers-to") if kind == "revisit" else None, "payload": payload if kind == "response" else b"",
    }


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from the first records of an archive; empty where they are too few."""
    if len(samples) < LEAST_SAMPLES:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # samples too alike or too short to learn from
        return b""


def write_archive(sink, records: Iterator[bytes]) -> int:
    """Writes the records until the archive is full; returns how many."""
    first: list[bytes] = []
    size = 0
    for record in records:
        first.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES:
            break
    if not first:
        return 0
    data = train_dictionary(first)
    sink.write(struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data)
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(data) if data else None, write_content_size=True, write_checksum=True)
    for record in first:
        sink.write(packer.compress(record))
    count = len(first)
    while size < ARCHIVE_BYTES and (record := next(records, None)) is not None:
        sink.write(packer.compress(record))
        size, count = size + len(record), count + 1
    return count


def read_archive(source) -> Iterator[dict]:
    """The records of an archive, one frame at a time: no more than one record and a block of input are held."""
    head = source.read(8)
    if len(head) < 8:
        raise BadArchive("an archive has no leading frame")
    magic, size = struct.unpack("<II", head)
    if magic != DICTIONARY_MAGIC:
        raise BadArchive("an archive does not lead with a dictionary frame")
    data = source.read(size)
    if len(data) != size:
        raise BadArchive("the dictionary is cut off")
    if data[:4] == struct.pack("<I", FRAME_MAGIC):  # a dictionary may itself be a frame
        data = zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 27)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data) if data else None)
    rest = b""
    while True:
        if not rest:
            rest = source.read(1 << 20)
            if not rest:
                return
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if not rest:
                rest = source.read(1 << 20)
                if not rest:
                    raise BadArchive("the last frame is cut off")
            try:
                parts.append(frame.decompress(rest))
            except zstandard.ZstdError as error:
                raise BadArchive(f"a frame cannot be decoded: {error}") from error
            rest = frame.unused_data if frame.eof else b""
        yield parse_record(b"".join(parts))


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _payload() -> Column:
    return F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))


def record_kinds(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, digest, refers_to``: of equal payloads of at least ``least_bytes`` the one of the smallest page_id (null ids
    last, then the smallest url) is the response and the others refer to it. Of rows equal in all three one is the response.

    Only digests that occur twice or more meet the pages again, so the payloads are moved only where Spark cannot send
    these to every task.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha1(_payload())))
    order = F.struct(F.col("page_id").isNull().alias("a"), F.col("page_id").alias("id"), F.col("url").isNull().alias("b"), F.col("url").alias("url"), F.col("m"))
    equal = rows.where(F.octet_length(_payload()) >= least_bytes).groupBy("digest", "page_id", "url").agg(F.count("*").alias("m"))
    copied = equal.groupBy("digest").agg(F.min(order).alias("first"), F.sum("m").alias("n")).where("n > 1")
    copied = keep(copied.select(F.col("digest").alias("c_digest"), "first"), "copied-payloads")
    same = F.col("first").isNotNull() & F.col("page_id").eqNullSafe(F.col("first.id")) & F.col("url").eqNullSafe(F.col("first.url"))
    met = rows.join(copied, F.col("digest") == F.col("c_digest"), "left")
    columns = ["page_id", "url", "html", "digest", "revisit", F.col("first.id").alias("refers_to")]
    once = met.where(~same | (F.col("first.m") == 1)).withColumn("revisit", F.col("first").isNotNull() & ~same).select(*columns)
    if copied.where("first.m > 1").isEmpty():
        return once
    tied = rows.join(copied.where("first.m > 1"), F.col("digest") == F.col("c_digest")).where(same)
    tied = tied.groupBy("digest", "page_id", "url").agg(F.any_value("html").alias("html"), F.any_value("first").alias("first"))
    tied = tied.withColumn("place", F.explode(F.sequence(F.lit(1), F.col("first.m")))).withColumn("revisit", F.col("place") > 1)
    return once.unionByName(tied.select(*columns))


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes one record a page into archives below ``folder``; returns ``path`` and ``records`` of each archive.

    A task writes an archive under a name of its own and only finished archives are listed, so a task that is run again leaves no
    archive that is read twice. ``folder`` is one that all executors reach.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(folder)

        def records() -> Iterator[bytes]:
            for whole in batches:
                for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                    for r in whole.slice(start, ROWS_AT_ONCE).to_pylist():
                        payload = (r["html"] or "").encode()
                        first = r["refers_to"] if r["revisit"] else None
                        if r["revisit"] and first is None:
                            first = "null"
                        yield record_bytes(r["page_id"], r["url"], payload, first, base64.b32encode(r["digest"]).decode(), len(payload))

        waiting = records()
        while True:
            path = f"{root}/{uuid.uuid4().hex}.warc.zst"
            buffer = io.BytesIO()
            count = write_archive(buffer, waiting)
            if not count:
                return
            with files.open_output_stream(path) as sink:
                sink.write(buffer.getbuffer())
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [count]}, schema=pa.schema([("path", pa.string()), ("records", pa.int64())]))

    files, root = file_system(folder)
    files.create_dir(root, recursive=True)
    return keep(record_kinds(pages, least_bytes).mapInArrow(run, "path string, records bigint"), "archives")


def read_warc(spark: SparkSession, archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the archives listed in ``path`` (within ``folder``'s file system), each validated; a broken archive stops the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = file_system(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for path, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                rows, size, count = [], 0, 0
                with files.open_input_stream(path) as source:
                    for record in read_archive(source):
                        if not payloads:
                            record["payload"] = None
                        rows.append(record)
                        size, count = size + len(record["payload"] or b""), count + 1
                        if len(rows) == ROWS_AT_ONCE or size > BYTES_AT_ONCE:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                if records is not None and count != records:
                    raise BadArchive(f"{path} has {count} records, not {records}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    n = spark.sparkContext.defaultParallelism
    return archives.select("path", "records").repartition(max(1, 4 * n)).mapInArrow(run, RECORD_SCHEMA)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Pages written to archives and read back, without the payloads: a null html is an empty payload, empty payloads are equal to each
    other, an empty table writes no archive and gives no rows."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    return read_warc(spark, write_warc(pages, folder), folder, payloads=False).drop("payload")
