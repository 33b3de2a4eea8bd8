"""Web archives: one gzip member per record, written and read back by many tasks.

Pages are spread over archives in a shared folder. Each task writes archives under
names of its own and reports them; only the reports of tasks that ended well are read,
so an archive that a lost executor left half-written is never looked at. A reader goes
through an archive once, front to back: it decompresses member after member as the
bytes come in, frames records by their content length and verifies their digests, and
holds one record at a time.

A payload of ``SHARED_PAYLOAD`` bytes or more is stored once, in the response of the
smallest page id; the other pages revisit that response.

Definitions. A null html is an empty payload. A page without an id is never referred to:
it revisits if another page with an id has its payload, else it is a response. All rows
of the smallest id are responses. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import stage
from docloom.shared import shared_dir

#: Payloads from this size on are stored once.
SHARED_PAYLOAD = 100
#: Bytes after which a task begins another archive.
ARCHIVE_BYTES = 256 << 20
#: Bytes read from an archive at a time.
CHUNK = 1 << 16
#: Bytes of payloads that a reader hands over at a time.
BATCH_BYTES = 8 << 20

# Fixed values of the WARC format.
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
_DATE = "1970-01-01T00:00:00Z"


class BrokenArchive(Exception):
    """An archive that ends early, is framed wrongly or fails a digest."""


def record_types(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_digest, refers_to): null refers_to is a response."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"))
    # ids and digests only; pre-aggregated, so many copies of one payload are no hot key
    leaders = (
        pages.where(F.octet_length(payload) >= SHARED_PAYLOAD)
        .groupBy(F.sha2(payload, 256).alias("payload_digest"))
        .agg(F.min("page_id").alias("leader"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    joined = rows.join(leaders, "payload_digest", "left")
    other = F.col("leader").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("leader"))
    return joined.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        "payload",
        "payload_digest",
        F.when(other, F.col("leader")).cast("long").alias("refers_to"),
    )


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def member(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", _DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(3, ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _name(refers_to))]
    head = _VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + _END) + packer.flush()


def _open(folder: str):
    """File system of the shared folder and the folder's path in it."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write(records: DataFrame, name: str = "warc", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of ``record_types`` as archives; returns (archive, records, bytes)."""
    folder = f"{shared_dir(records.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(folder)
        system.create_dir(path, recursive=True)
        out, archive, count, size = None, "", 0, 0

        def report() -> pa.RecordBatch:
            out.close()
            columns = [pa.array([archive]), pa.array([count], pa.int64()), pa.array([size], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["archive", "records", "bytes"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    archive, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{path}/{archive}")
                data = member(*row)
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    yield report()
                    out = None
        if out is not None:
            yield report()

    columns = records.select("page_id", "url", "payload", "payload_digest", "refers_to")
    # stored at once: every archive is written by one task, whatever is read later
    written = stage(columns.mapInArrow(archives, "archive string, records long, bytes long"), name)
    return written.withColumn("archive", F.concat(F.lit(f"{folder}/"), "archive"))


def members(stream: BinaryIO) -> Iterator[bytes]:
    """Decompressed members of an archive, one after another."""
    rest = b""
    while rest or (rest := stream.read(CHUNK)):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not rest and not (rest := stream.read(CHUNK)):
                raise BrokenArchive("the last member is cut off")
            try:
                parts.append(unpacker.decompress(rest))
            except zlib.error as error:
                raise BrokenArchive(f"not a gzip member: {error}") from error
            rest = unpacker.unused_data
        yield b"".join(parts)


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode("utf-8").split("\r\n") if line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse(record: bytes) -> dict:
    """Fields of a record whose framing and digests hold."""
    head, found, rest = record.partition(_END)
    version, _, lines = head.partition(b"\r\n")
    if not found or version != _VERSION:
        raise BrokenArchive("no record header")
    fields = _fields(lines)
    length = int(fields["content-length"])
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != _END:
        raise BrokenArchive("the block isn't as long as its content length")
    if fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise BrokenArchive("the block fails its digest")
    http, _, payload = block.partition(_END)
    size = int(_fields(http.partition(b"\r\n")[2])["content-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    response = fields["warc-type"] == "response"
    if response and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise BrokenArchive("the payload fails its length or digest")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload": payload if response else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": None if response else _page(fields["warc-refers-to"]),
    }


_READ = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)
_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive, expected in zip(batch.column("archive").to_pylist(), batch.column("records").to_pylist()):
            folder, _, name = archive.rpartition("/")
            system, path = _open(folder)
            rows, held, count = [], 0, 0
            with system.open_input_stream(f"{path}/{name}") as stream:
                for record in members(stream):
                    rows.append(parse(record))
                    held += len(record)
                    count += 1
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, held = [], 0
            if count != expected:
                raise BrokenArchive(f"{archive} has {count} of {expected} records")
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)


def read(written: DataFrame) -> DataFrame:
    """Records of the archives that ``write`` reports, each archive read by one task."""
    # one archive a task; without a number, Spark would merge the short list into one
    tasks = max(1, written.count())
    return written.select("archive", "records").repartition(tasks).mapInArrow(_records, _READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """What is read back of all pages, without the payloads."""
    return read(write(record_types(pages))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
