"""Web archives in WARC 1.1, compressed with Zstandard: one frame per record, with a dictionary.

An archive begins with a skippable frame (magic number 0x184D2A5D) that holds the dictionary, raw or
itself a Zstandard frame, followed by one frame per record, so that any record can be read on its own.
Archives without a dictionary begin with the first record.

The reader streams: it holds one record at a time, and checks of each that its frame holds one record
and nothing else, that the version line and the mandatory fields are there, that the length stated is
the length found, and that payload digests and lengths agree. What fails is reported in the ``error``
column of its row, not skipped.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stage

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
MANDATORY = ("warc-record-id", "content-length", "warc-date", "warc-type")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 64 << 20  # of payload; then the task begins another archive
SAMPLE_BYTES = 1 << 20  # first records that train an archive's dictionary
DICTIONARY_BYTES = 32 << 10
LEAST_REVISIT = 1000  # payloads shorter than this are always stored
DATE = "2024-01-01T00:00:00Z"
READ_BYTES = 1 << 18


def _field(text: str) -> str:
    """A header value in one line: control characters and blanks percent-coded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def page_uri(page_id: int | None) -> str:
    return "urn:page:none" if page_id is None else f"urn:page:{page_id}"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record: an HTTP response with its body, or a revisit with the HTTP header alone."""
    digest = hashlib.sha1(payload).digest()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    # equal ids may occur: the record's own id also tells its content and target
    own = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_uri(page_id)} {url} {digest.hex()}")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{own}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", _field(url) if url else page_uri(page_id)),
        ("WARC-Concurrent-To", f"<{page_uri(page_id)}>"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest).decode()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{page_uri(refers_to)}>"), ("WARC-Truncated", "length")]
    fields.append(("Content-Length", str(len(block))))
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"
    return head + block + b"\r\n\r\n"


class Writer:
    """Writes records to an open file. The first ones wait until there are enough to train the
    dictionary; an archive too small to train one has none."""

    def __init__(self, out: BinaryIO):
        self.out, self.waiting, self.waiting_bytes, self.engine = out, [], 0, None
        self.records = self.payload = 0

    def add(self, data: bytes) -> None:
        self.records += 1
        self.payload += len(data)
        if self.engine is None:
            self.waiting.append(data)
            self.waiting_bytes += len(data)
            if self.waiting_bytes >= SAMPLE_BYTES:
                self._begin()
        else:
            self.out.write(self.engine.compress(data))

    def _begin(self) -> None:
        trained = None
        if len(self.waiting) >= 16:
            try:
                trained = zstandard.train_dictionary(DICTIONARY_BYTES, [x[:1 << 16] for x in self.waiting])
            except zstandard.ZstdError:  # too little to learn from
                trained = None
        if trained is not None:
            packed = zstandard.ZstdCompressor(level=3).compress(trained.as_bytes())
            self.out.write(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        self.engine = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)
        for data in self.waiting:
            self.out.write(self.engine.compress(data))
        self.waiting = []

    def close(self) -> None:
        if self.engine is None:
            self._begin()
        self.out.close()


class Record(NamedTuple):
    fields: dict[str, str]
    block: bytes
    error: str | None


def read_dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    """The content of the leading skippable frame: a dictionary, or a Zstandard frame with one."""
    if data[:4] == FRAME:
        data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
    return zstandard.ZstdCompressionDict(data)


def frames(stream: BinaryIO, size: int = READ_BYTES) -> Iterator[tuple[bytes, str | None]]:
    """(decoded frame, error) for every frame of an archive. Later skippable frames are passed over.
    A damaged frame ends the archive: where the next begins cannot be told."""
    engine = zstandard.ZstdDecompressor()
    held, first = b"", True
    while True:
        while len(held) < 8:
            more = stream.read(size)
            if not more:
                break
            held += more
        if not held:
            return
        if len(held) < 8:
            yield b"", "archive ends within a frame"
            return
        magic, length = struct.unpack("<II", held[:8])
        if 0x184D2A50 <= magic <= 0x184D2A5F:
            while len(held) < 8 + length:
                more = stream.read(max(size, 8 + length - len(held)))
                if not more:
                    yield b"", "archive ends within a frame"
                    return
                held += more
            if first and magic == SKIPPABLE:
                try:
                    engine = zstandard.ZstdDecompressor(dict_data=read_dictionary(held[8:8 + length]))
                except zstandard.ZstdError as error:
                    yield b"", f"dictionary: {error}"
                    return
            held, first = held[8 + length:], False
            continue
        first = False
        one, parts = engine.decompressobj(), []
        try:
            while True:
                parts.append(one.decompress(held))
                if one.eof:
                    held = one.unused_data
                    break
                held = stream.read(size)
                if not held:
                    yield b"".join(parts), "archive ends within a frame"
                    return
        except zstandard.ZstdError as error:
            yield b"".join(parts), f"frame: {error}"
            return
        yield b"".join(parts), None


def parse(data: bytes, error: str | None = None) -> Record:
    """The record of a frame, checked."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            error = error or "header line without a name"
            continue
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if error:
        return Record(fields, rest, error)
    if not gap or not lines[0].startswith(b"WARC/1."):
        return Record(fields, rest, "no WARC version line")
    missing = [x for x in MANDATORY if x not in fields]
    if missing:
        return Record(fields, rest, "missing " + ", ".join(missing))
    if not fields["content-length"].isascii() or not fields["content-length"].isdigit():
        return Record(fields, rest, "content-length is not a number")
    length = int(fields["content-length"])
    block, tail = rest[:length], rest[length:]
    if len(block) < length or tail != b"\r\n\r\n":
        return Record(fields, block, f"content-length {length}, but the frame holds {max(0, len(rest) - 4)}")
    return Record(fields, block, None)


def payload_of(found: Record) -> tuple[int, str, bytes | None, str | None]:
    """(bytes, SHA-1 in hex, payload or None for a revisit, error) of a response or revisit."""
    http, gap, body = found.block.partition(b"\r\n\r\n")
    stated = [x.split(b":", 1)[1].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    kind, _, coded = found.fields.get("warc-payload-digest", "").partition(":")
    try:
        digest = base64.b32decode(coded).hex() if kind == "sha1" else ""
    except ValueError:
        digest = ""
    if not gap or len(stated) != 1 or not stated[0].isdigit():
        return 0, digest, None, "no HTTP header with a length"
    length = int(stated[0])
    if not digest:
        return length, digest, None, "no SHA-1 payload digest"
    if found.fields["warc-type"] == "revisit":
        return length, digest, None, None if not body else "revisit with a payload"
    if length != len(body):
        return length, digest, body, f"payload of {len(body)} bytes where {length} are stated"
    if hashlib.sha1(body).hexdigest() != digest:
        return length, digest, body, "payload does not match its digest"
    return length, digest, body, None


def _page(uri: str) -> int | None:
    text = uri.strip("<>").removeprefix("urn:page:")
    return int(text) if text.lstrip("-").isdigit() else None


def marked(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html and refers_to. Of equal payloads of at least ``least`` bytes, the largest
    page_id is stored and the others refer to it. Only digests and ids are grouped; a digest that a
    third of all pages share is one row of the grouped side, which the pages are joined with."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    sizes = F.octet_length("html")
    key = F.when(sizes >= least, F.sha1(F.encode("html", "UTF-8")))
    rows = rows.withColumn("_digest", key)
    stored = (rows.where("_digest is not null").groupBy("_digest").agg(F.max("page_id").alias("_stored"), F.count("*").alias("_n"))
              .where("_n > 1").select(F.col("_digest").alias("_d"), "_stored"))
    met = rows.join(stored, F.col("_digest") == F.col("_d"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_stored")), F.col("_stored"))
    return met.select("page_id", "url", "html", refers.alias("refers_to"))


def write(pages: DataFrame, least: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives under the shared folder; returns their list: path, records, payload bytes.

    The list, written by Spark's commit protocol, names the archives of the attempts that counted;
    archives that a lost task left behind are in no list. A null html is an empty payload, a null url
    gives the page's own URN as target. A row without a page_id is stored, or refers to the page that
    holds its payload; rows that repeat the largest page_id are each stored."""
    folder = scratch_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(root, recursive=True)
        writer, path = None, ""
        for batch in batches:
            for page_id, url, html, refers in zip(*[batch.column(i) for i in range(4)]):
                if writer is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.zst"
                    writer = Writer(store.open_output_stream(path))
                writer.add(record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers.as_py()))
                if writer.payload >= archive_bytes:
                    yield _listed(path, writer)
                    writer = None
        if writer is not None:
            yield _listed(path, writer)

    return stage(marked(pages, least).mapInArrow(run, "path string, records long, bytes long"), "warc-list").withColumn(
        "folder", F.lit(folder))


def _listed(path: str, writer: Writer) -> pa.RecordBatch:
    writer.close()
    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([writer.records]), pa.array([writer.payload])],
                                      names=["path", "records", "bytes"])


READ_SCHEMA = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
               "refers_to long, record_id string, payload binary, error string")


def read(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the archives listed in ``archives`` (path, folder), one row each. An archive is
    read by one task, as a stream. A page's id is the number in its ``urn:page:``."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, folder in zip(batch.column("path").to_pylist(), batch.column("folder").to_pylist()):
                store, _ = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
                rows, held = [], 0
                with store.open_input_stream(path) as stream:
                    for data, error in frames(stream):
                        found = parse(data, error)
                        size, digest, payload, wrong = payload_of(found) if found.error is None else (None, None, None, found.error)
                        own = found.fields
                        rows.append((_page(own.get("warc-concurrent-to", "")), own.get("warc-target-uri"), own.get("warc-type"),
                                     size, digest, _page(own.get("warc-refers-to", "")), own.get("warc-record-id"),
                                     payload if with_payload else None, wrong))
                        held += len(data)
                        if held > 1 << 24:
                            yield _rows(rows, kinds, names)
                            rows, held = [], 0
                if rows:
                    yield _rows(rows, kinds, names)

    # an archive is a row of the list: one to a task, or as many as there are cores to go round
    n = max(1, archives.count())
    return archives.repartition(n).select("path", "folder").mapInArrow(run, READ_SCHEMA)


def _rows(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
