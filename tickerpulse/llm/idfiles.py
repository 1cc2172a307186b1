"""Token ids in binary files with Elias-Fano encoded document boundaries.

A file holds a run of documents in ascending order of their ids: all token ids in one array, and where
documents end in it as an Elias-Fano sequence: of each number the low bits in full, the high bits in
unary, n ones among about 2n bits, with the place of every 256th one. ``select`` of one document's end
reads a word or two; there is no table of 64-bit offsets. Document ids are a second such sequence.

Layout, little-endian: ids (2 or 4 bytes each) | document ends | document ids | footer. An Elias-Fano
section is its header (count, low bits, first number, sizes), low bits, high bits, samples. Writing streams the ids; only
two numbers per document of the file are held.
"""

from __future__ import annotations

import array
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stage, tidy
from .tokens import encoder

MAGIC = b"IDEF0001"
FOOTER = struct.Struct("<8sQQQQQQQQ")  # magic, documents, without id, ids, bytes per id, ends at, doc ids at, footer at, 0
SECTION = struct.Struct("<QQqQQQ")  # numbers, low bits, smallest, bytes of low bits, of high bits, of samples
SAMPLE = 256
WINDOW = 1 << 12  # numbers encoded or decoded at once, a multiple of SAMPLE
END = 1  # id that ends a document
FILE_TOKENS = 1 << 24  # then the task begins another file,
FILE_DOCUMENTS = 1 << 20  # or after so many documents


class EliasFano(NamedTuple):
    """Ascending numbers, repeats allowed. ``low``: packed low bits; ``high``: bitmap in bytes;
    ``samples``: bit position of every SAMPLE-th one."""

    n: int
    width: int
    least: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        n = len(values)
        if not n:
            return cls(0, 0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        least = int(values[0])
        span = int(values[-1]) - least  # numbers are taken modulo 2**64, so any span of int64 fits
        width = max(0, (span // n).bit_length() - 1)
        low = np.zeros((n * width + 7) // 8, np.uint8)
        high = np.zeros(((span >> width) + n + 7) // 8, np.uint8)
        samples = np.zeros(-(-n // SAMPLE), np.uint64)
        for a in range(0, n, WINDOW):  # a multiple of 8 numbers, so of whole bytes
            x = values[a:a + WINDOW].astype(np.uint64) - np.uint64(least % 2**64)
            bits = ((x[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
            packed = np.packbits(bits.reshape(-1), bitorder="little")
            low[a * width // 8:a * width // 8 + len(packed)] = packed
            ones = (x >> np.uint64(width)).astype(np.int64) + np.arange(a, a + len(x))
            first = int(ones[0]) // 8
            marks = np.bincount(ones // 8 - first, 1 << (ones % 8))  # all different bits
            high[first:first + len(marks)] += marks.astype(np.uint8)
            samples[a // SAMPLE:a // SAMPLE + len(ones[::SAMPLE])] = ones[::SAMPLE]
        return cls(n, width, least, low, high, samples)

    def to_bytes(self) -> bytes:
        parts = [self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u8").tobytes()]
        return SECTION.pack(self.n, self.width, self.least, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> "EliasFano":
        n, width, least, a, b, c = SECTION.unpack_from(data)
        at = SECTION.size
        if len(data) < at + a + b + c:
            raise ValueError("an Elias-Fano section is cut off")
        return cls(n, width, least, np.frombuffer(data, np.uint8, a, at), np.frombuffer(data, np.uint8, b, at + a),
                   np.frombuffer(data, "<u8", c // 8, at + a + b))

    def _low(self, i: int) -> int:
        first, value = i * self.width, 0
        chunk = int.from_bytes(self.low[first // 8:(first + self.width + 7) // 8].tobytes(), "little")
        value = (chunk >> (first % 8)) & ((1 << self.width) - 1)
        return value

    def select(self, i: int) -> int:
        """Number ``i``: from the sample before it, ones are counted byte by byte."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        bit, todo = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, within = divmod(bit, 8)
        word = int(self.high[byte]) >> within << within
        while (ones := word.bit_count()) <= todo:
            todo -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(todo):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        return self.least + ((place - i) << self.width | self._low(i))

    def run(self, a: int, b: int) -> np.ndarray:
        """Numbers ``a`` to ``b`` - 1: from the sample before the first, the bitmap is read up to the
        sample after the last. Only what lies between is decoded."""
        if not 0 <= a <= b <= self.n:
            raise IndexError((a, b))
        if a == b:
            return np.zeros(0, np.int64)
        bit, after = int(self.samples[a // SAMPLE]), (b - 1) // SAMPLE + 1
        stop = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[bit // 8:stop], bitorder="little")) + bit // 8 * 8
        ones = ones[np.searchsorted(ones, bit):][a % SAMPLE:a % SAMPLE + b - a]
        at, size = a * self.width, (b - a) * self.width
        bits = np.unpackbits(self.low[at // 8:(at + size + 7) // 8], bitorder="little")[at % 8:at % 8 + size].reshape(b - a, self.width)
        low = np.zeros(b - a, np.uint64)
        for i in range(self.width):
            low |= bits[:, i].astype(np.uint64) << np.uint64(i)
        x = ((ones - np.arange(a, b)).astype(np.uint64) << np.uint64(self.width)) + low
        return (x + np.uint64(self.least % 2**64)).view(np.int64)

    def all(self) -> np.ndarray:
        """Every number, in one array."""
        return np.concatenate([np.zeros(0, np.int64), *[self.run(a, min(a + WINDOW, self.n)) for a in range(0, self.n, WINDOW)]])


class Writer:
    """Appends documents, in order of their ids (those without an id first), to an open file."""

    def __init__(self, out: BinaryIO, id_bytes: int):
        self.out, self.kind = out, {2: "<u2", 4: "<u4"}[id_bytes]
        self.ends, self.docs = array.array("q"), array.array("q")
        self.unnamed = self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        numbers = np.frombuffer(ids, "<u4")
        self.out.write(numbers.astype(self.kind).tobytes())
        self.tokens += len(numbers)
        self.ends.append(self.tokens)
        if doc_id is None:
            self.unnamed += 1
        else:
            self.docs.append(doc_id)

    def close(self) -> None:
        width = int(self.kind[-1])
        at = self.tokens * width
        ends = EliasFano.encode(np.frombuffer(self.ends, np.int64)).to_bytes()
        docs = EliasFano.encode(np.frombuffer(self.docs, np.int64)).to_bytes()
        footer = FOOTER.pack(MAGIC, len(self.ends), self.unnamed, self.tokens, width, at, at + len(ends),
                             at + len(ends) + len(docs), 0)
        self.out.write(ends + docs + footer)
        self.out.close()


class Reader:
    """Random and whole access to a file, given how to read a range of it."""

    def __init__(self, read_at, size: int):
        self.read_at = read_at
        if size < FOOTER.size:
            raise ValueError("no id file")
        magic, self.documents, self.unnamed, self.tokens, self.width, ends, docs, foot, _ = FOOTER.unpack(
            read_at(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC or foot + FOOTER.size != size or ends != self.tokens * self.width:
            raise ValueError("no id file, or a damaged one")
        self.ends = EliasFano.from_bytes(read_at(ends, docs - ends))
        self.docs = EliasFano.from_bytes(read_at(docs, foot - docs))
        if self.ends.n != self.documents or self.docs.n + self.unnamed != self.documents:
            raise ValueError("counts of documents differ")

    def span(self, i: int) -> tuple[int, int]:
        """Where document ``i`` of the file begins and ends."""
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def ids(self, i: int) -> np.ndarray:
        a, b = self.span(i)
        return self.range(a, b)

    def range(self, a: int, b: int) -> np.ndarray:
        return np.frombuffer(self.read_at(a * self.width, (b - a) * self.width), f"<u{self.width}").astype("<u4")

    def doc_id(self, i: int) -> int | None:
        return None if i < self.unnamed else self.docs.select(i - self.unnamed)

    def scan(self, tokens: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids) of every document, read in runs of about ``tokens``. Boundaries and ids
        of documents are selected a window at a time; no table of all of them is made."""
        begin = 0
        for first in range(0, self.documents, WINDOW):
            last = min(first + WINDOW, self.documents)
            ends = self.ends.run(first, last)
            named = self.docs.run(max(first - self.unnamed, 0), max(last - self.unnamed, 0)).tolist()
            names = [None] * (last - first - len(named)) + named
            lo = 0
            while lo < len(ends):
                hi = max(lo + 1, int(np.searchsorted(ends, begin + tokens, side="right")))
                block, start = self.range(begin, int(ends[hi - 1])), begin
                for i in range(lo, hi):
                    end = int(ends[i])
                    yield names[i], start, block[start - begin:end - begin]
                    start = end
                lo, begin = hi, start


def _store(folder: str):
    return pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def write(docs: DataFrame, tokenizer: str, end: int | None = END, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Id files under the shared folder, in ascending order of doc_id over all files; returns their
    list: path, folder, place (order of the files), documents, tokens, start (ids before the file).

    Reads ``doc_id`` and ``text``; a null text is empty. Documents without an id come first. Rows with
    the same id stand by the hash of their text; a range of equal ids can be cut between files, so an
    id that a third of all rows share does not end up in one task. The list is written by Spark's
    commit protocol: files of lost attempts are in no list."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        id_bytes = 2 if own.tokenizer.get_vocab_size() <= 1 << 16 else 4
        tail = b"" if end is None else end.to_bytes(4, "little")
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        writer, path, part, k = None, "", None, 0
        for batch in batches:
            for doc_id, text, at in zip(*[batch.column(c) for c in ("doc_id", "text", "_part")]):
                if writer is None:
                    path, part = f"{root}/{uuid.uuid4().hex}.ids", at.as_py()
                    writer = Writer(store.open_output_stream(path), id_bytes)
                writer.add(doc_id.as_py(), own.encode(text.as_py()) + tail)
                if writer.tokens >= file_tokens or len(writer.ends) >= FILE_DOCUMENTS:
                    yield _listed(path, part, k, writer)
                    writer, k = None, k + 1
        if writer is not None:
            yield _listed(path, part, k, writer)

    salted = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"),
                         F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)).alias("_salt"))
    keys = [F.col("doc_id").asc_nulls_first(), F.col("_text"), F.col("_salt")]
    ordered = (salted.repartitionByRange(*keys).sortWithinPartitions(*keys)
               .withColumn("_part", F.spark_partition_id()).drop("_text", "_salt"))
    made = stage(ordered.mapInArrow(tidy(run), "path string, part int, k int, documents long, tokens long"), "ids-list")
    # one row per file, of millions of ids each
    order = Window.orderBy("part", "k")
    return made.select("path", F.lit(folder).alias("folder"), F.row_number().over(order).alias("place"), "documents", "tokens",
                       (F.sum("tokens").over(order) - F.col("tokens")).alias("start"))


def _listed(path: str, part: int, k: int, writer: Writer) -> pa.RecordBatch:
    writer.close()
    return pa.RecordBatch.from_arrays(
        [pa.array([path]), pa.array([part], pa.int32()), pa.array([k], pa.int32()), pa.array([len(writer.ends)]), pa.array([writer.tokens])],
        names=["path", "part", "k", "documents", "tokens"])


def read(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids before the document over all files), n_tokens, ids_crc32 and, if asked for,
    ids of every document of the listed ``files``. A file is read by one task, run by run."""
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, folder, base in zip(*[batch.column(c).to_pylist() for c in ("path", "folder", "start")]):
                store, _ = _store(folder)
                with store.open_input_file(path) as f:
                    rows, held = [], 0
                    for doc_id, start, ids in Reader(lambda at, n: f.read_at(n, at), f.size()).scan():
                        data = ids.tobytes()
                        rows.append((doc_id, base + start, len(ids), zlib.crc32(data), data if with_ids else None))
                        held += 64 + with_ids * len(data)
                        if held > 1 << 24:
                            yield _rows(rows, kinds, names, with_ids)
                            rows, held = [], 0
                    if rows:
                        yield _rows(rows, kinds, names, with_ids)

    n = max(1, files.count())
    return files.repartition(n).select("path", "folder", "start").mapInArrow(tidy(run), kind)


def _rows(rows: list[tuple], kinds: list, names: list[str], with_ids: bool) -> pa.RecordBatch:
    n = 5 if with_ids else 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows))[:n], kinds)], names=names[:n])
