"""What the text operators share: scratch tables, words as numpy arrays, safe column choice."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ..session import scratch_path

CHUNK_BYTES = 1 << 18  # text worked on at once inside a task; a longer text is a chunk of its own
CHUNK_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: later steps neither repeat
    it nor depend on the executors that made it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def with_columns(df: DataFrame, **kinds: DataType) -> StructType:
    """The schema of ``df`` with further columns."""
    return StructType([*df.schema.fields, *[StructField(name, kind) for name, kind in kinds.items()]])


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, rules: dict[str, Callable] | None = None,
                    keep: Column | None = None) -> DataFrame:
    """``docs`` (doc_id, text) that carry one of at most ``rows`` labels, picked by a hash of the id,
    with the columns of ``labels`` that ``rules`` names. That bound is what allows the broadcast. An id
    with several labels counts with what its rule (an aggregate function) makes of them, in whatever
    order they come, and only if ``keep`` holds for that. Documents that repeat an id come along; ids
    without a document are lost. Ids are compared only below a hash that leaves some four times ``rows`` of them."""
    rules = rules or {}
    known = labels.where("doc_id is not null").select("doc_id", *rules, F.xxhash64("doc_id").alias("_hash"))
    total = known.count()
    share = 4 * rows / total if total > 8 * rows else 1.0
    while True:
        low = known if share >= 1 else known.where(F.col("_hash") < int(-(2**63) + 2**64 * share))
        single = low.groupBy("_hash", "doc_id").agg(*[f(c).alias(c) for c, f in rules.items()]) if rules else low.distinct()
        picked = (single if keep is None else single.where(keep)).orderBy("_hash", "doc_id").limit(rows).drop("_hash")
        if share >= 1 or picked.count() == rows:
            return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
        share *= 4


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, a function for ``mapInArrow``, that gives freed memory back to the system after its
    last batch. Workers outlive their tasks, and what they hold is missing to the stages that follow."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied


def give_back() -> None:
    """Memory that is free inside this process goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text (remainder 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE_CODES = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    done, step = 1, base % 2**64
    while done < n:
        take = min(done, n - done)
        out[done:done + take] = out[:take] * np.uint64(step)
        done, step = done + take, step * step % 2**64
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class BitSet:
    """A set of 64-bit hashes that holds a bit for each value of their leading bits. ``has`` may say
    yes to others, never no to one of the set."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.shift = np.uint64(64 - (len(words).bit_length() + 5))

    def has(self, codes: np.ndarray) -> np.ndarray:
        at = codes >> self.shift
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def bit_set(df: DataFrame, column: str, bits: int) -> BitSet:
    """The set of the hashes in a long column. ``bits`` is a power of two; at most a 64th of it in
    numbers comes to the driver, however many rows there are."""
    at = F.shiftrightunsigned(F.col(column), 64 - (bits.bit_length() - 1))
    found = df.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("mask")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return BitSet(words)


class Words(NamedTuple):
    """Words of several texts. ``buf``: bytes with A-Z lower-cased; text i has ``buf[cuts[i]:cuts[i+1]]``
    and the words ``first[i]:first[i+1]``; word j is ``buf[start[j]:end[j]]`` and hashes to ``code[j]``."""

    buf: np.ndarray
    cuts: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    code: np.ndarray


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES,
                rows: int = CHUNK_ROWS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bytes, cuts) for runs of texts of about ``limit`` bytes and at most ``rows`` texts;
    null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + rows, n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def words_of(raw: np.ndarray, cuts: np.ndarray, lower: bool = True) -> Words:
    """Words are runs of bytes other than blank and control characters 9 to 13."""
    buf = _LOWER[raw] if lower else raw
    inside = ~_SPACE[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    inner = cuts[:-1][cuts[:-1] < len(buf)]
    begins[inner] = inside[inner]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    last = cuts[1:] - 1
    last = last[(last >= 0) & (cuts[1:] > cuts[:-1])]
    stops[last] = inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    if len(start):
        sizes = end - start
        at = np.flatnonzero(inside)
        place = at - np.repeat(start, sizes)
        heads = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        code = mix(np.add.reduceat(_BYTE_CODES[buf[at]] * powers(int(sizes.max()))[place], heads)
                   + sizes.astype(np.uint64))
    else:
        code = np.zeros(0, np.uint64)
    return Words(buf, cuts, np.searchsorted(start, cuts), start, end, code)


def spans(inside: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): runs of true places that do not cross ``cuts`` (the places where texts
    begin and end), and for every cut the number of runs before it."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[cuts] = True
    start = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    end = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    return start, end, np.searchsorted(start, cuts)


def word_chunks(column: pa.Array, limit: int = CHUNK_BYTES, lower: bool = True) -> Iterator[tuple[int, int, Words]]:
    for lo, hi, raw, cuts in text_chunks(column, limit):
        yield lo, hi, words_of(raw, cuts, lower)


def shingle_codes(code: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words of one text."""
    if len(code) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(code) - n + 1, np.uint64)
    for i, p in enumerate(powers(n, 0xD1342543DE82EF95)):
        total += code[i:len(code) - n + 1 + i] * p
    return mix(total + np.uint64(n))
