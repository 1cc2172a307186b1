"""Resampling of documents towards the wording of a target set by importance weights.

Words and pairs of neighbouring words are hashed into buckets. How much likelier a bucket is in the
target than in the corpus is its gain; the mean gain of a document, plus Gumbel noise that depends on
its id alone, is its score, and the documents with the highest scores are drawn, which samples
without replacement in proportion to the weights. The steps:

1. One pass counts the features of every bucket: a task adds up one array and sends it once.
2. The gains are an array of one number a bucket; a second pass looks the features up in it.
3. Parallel sorting by regular sampling. Each task sorts its documents into runs and marks every
   stride-th row. The marked rows of all runs, in order, give splitters at regular distances; every
   run is cut at them, each segment is merged in a task of its own, and the counts of the segments
   before it turn places in a segment into exact ranks.

The keys that are sorted end with the place of the row, so they are all different: equal scores,
repeated ids and repeated rows are split over segments like any others. There are as many segments
as a quarter of the square root of the rows (50 000 for 4e10 rows, of 800 000 rows each), and
``OVERSAMPLE`` marked rows for each of them meet on the driver.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spans, stage, text_chunks, tidy

BUCKETS = 10_000
PERCENT = 25
MIN_WORDS = 20
SEED = 7
RUN_ROWS = 65_536  # documents sorted at once by a task
OVERSAMPLE = 16
TABLED = 64  # bytes; words up to this length take part in the vectorised checksums

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


def _byte_steps() -> np.ndarray:
    """What the checksum's register becomes for each value of its low byte."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_STEP = _byte_steps()


def _zero_steps(most: int) -> np.ndarray:
    """[n, i, b]: byte i of a register, of value b, after n zero bytes. The checksum is linear, so the
    four bytes can be looked up apart."""
    out = np.zeros((most + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    for n in range(1, most + 1):
        out[n] = _STEP[out[n - 1] & 255] ^ (out[n - 1] >> 8)
    return out


_ZEROS = _zero_steps(TABLED)


def _word_checksums(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of every word: byte by byte over all words that are long enough."""
    out = np.full(len(start), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-np.minimum(size, TABLED).astype(np.int16), kind="stable")
    at, sizes, run = start[order], size[order], out[order]
    for j in range(int(min(TABLED, sizes[0])) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -j, side="left")) if j < TABLED else len(sizes)
        c = run[:n]
        run[:n] = _STEP[(c ^ buf[at[:n] + j]) & 255] ^ (c >> 8)
    out[order] = run ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > TABLED):
        out[i] = zlib.crc32(buf[start[i]:start[i] + size[i]])
    return out


def _pair_checksums(buf: np.ndarray, start: np.ndarray, size: np.ndarray, single: np.ndarray) -> np.ndarray:
    """crc32 of every word, a blank and the word after it."""
    if len(single) < 2:
        return np.zeros(0, np.uint32)
    c = single[:-1] ^ np.uint32(0xFFFFFFFF)
    c = _STEP[(c ^ np.uint32(32)) & 255] ^ (c >> 8) ^ np.uint32(0xFFFFFFFF)
    n = np.minimum(size[1:], TABLED)
    out = single[1:].copy()
    for i in range(4):
        out ^= _ZEROS[n, i, (c >> np.uint32(8 * i)) & 255]
    for i in np.flatnonzero(size[1:] > TABLED):
        out[i] = zlib.crc32(buf[start[i + 1]:start[i + 1] + size[i + 1]], int(c[i]))
    return out


def _features(column: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first, singles, pairs) for runs of texts: text i has the words first[i]:first[i+1], whose
    buckets are in singles; pairs[j] is the bucket of words j and j + 1, also across texts."""
    for _, _, raw, cuts in text_chunks(column):
        buf = _LOWER[raw]
        start, end, first = spans(_WORD[buf], cuts)
        size = end - start
        single = _word_checksums(buf, start, size)
        yield first, single % np.uint32(buckets), _pair_checksums(buf, start, size, single) % np.uint32(buckets)


def _per_text(first: np.ndarray, singles: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Sums over the words and the pairs of each text."""
    a, b = np.concatenate(([0], np.cumsum(singles))), np.concatenate(([0], np.cumsum(pairs)))
    lo, hi = first[:-1], first[1:]
    return a[hi] - a[lo] + np.where(hi > lo, b[np.maximum(hi - 1, 0)] - b[np.minimum(lo, len(b) - 1)], 0)


def feature_counts(rows: DataFrame, buckets: int = BUCKETS, min_words: int = MIN_WORDS) -> tuple[np.ndarray, int]:
    """Features per bucket over all texts of ``rows``, and how many texts have ``min_words`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, long_enough = np.zeros(buckets, np.int64), 0
        for batch in batches:
            for first, singles, pairs in _features(batch.column("text"), buckets):
                counts += np.bincount(singles, minlength=buckets)
                inner = np.ones(len(pairs), bool)
                borders = first[1:-1]
                inner[borders[(borders > 0) & (borders <= len(pairs))] - 1] = False  # pairs across two texts
                counts += np.bincount(pairs[inner], minlength=buckets)
                long_enough += int((np.diff(first) >= min_words).sum())
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array([*used.tolist(), -1], pa.int32()), "n": pa.array([*counts[used].tolist(), long_enough], pa.int64())})

    summed = rows.select("text").mapInArrow(tidy(run), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out, long_enough = np.zeros(buckets, np.int64), 0
    for bucket, n in summed.collect():  # a row a bucket
        if bucket < 0:
            long_enough = n
        else:
            out[bucket] = n
    return out, long_enough


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """How much likelier each bucket is in the target, in thousandths of a natural logarithm."""
    n = len(corpus)
    s, t = float(corpus.sum() + n), float(target.sum() + n)
    ratios = (target + 1.0) * s / ((corpus + 1.0) * t)
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of a document in thousandths. A null id counts as the empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


_RUNS = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64()),
                   ("place", pa.int64()), ("eligible", pa.bool_()), ("marked", pa.bool_())])
_RUNS_SQL = "doc_id long, n_features long, weight long, score long, place long, eligible boolean, marked boolean"


def _keys(score: np.ndarray, doc_id: np.ndarray, missing: np.ndarray, n_features: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Texts of bytes that compare like the rows: higher scores first, then smaller ids, null last."""
    out = np.zeros((len(score), 33), np.uint8)
    flip = np.uint64(1 << 63)
    for at, x in ((0, ~(score.astype(np.int64).view(np.uint64) ^ flip)), (9, doc_id.astype(np.int64).view(np.uint64) ^ flip),
                  (17, n_features.astype(np.uint64)), (25, place.astype(np.uint64))):
        out[:, at:at + 8] = x.astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 8] = missing
    return np.ascontiguousarray(out).view("S33").ravel()


def _batch_keys(batch: pa.RecordBatch) -> np.ndarray:
    ids = batch.column("doc_id")
    return _keys(batch.column("score").to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False),
                 ids.is_null().to_numpy(zero_copy_only=False), batch.column("n_features").to_numpy(zero_copy_only=False),
                 batch.column("place").to_numpy(zero_copy_only=False))


def _in_order(batch: pa.RecordBatch, stride: int) -> pa.RecordBatch:
    """One run: sorted, with every ``stride``-th eligible row marked. Where the marks begin changes
    from run to run, so that short runs get their share."""
    eligible = batch.column("eligible").to_numpy(zero_copy_only=False)
    keys = _batch_keys(batch)
    order = np.lexsort((keys, ~eligible))
    n = int(eligible.sum())
    marked = np.zeros(len(order), bool)
    if n:
        begin = zlib.crc32(int(batch.column("place")[0].as_py()).to_bytes(8, "little")) % stride
        marked[begin:n:stride] = True
    out = batch.take(pa.array(order))
    return out.set_column(6, "marked", pa.array(marked))


def _runs(docs: DataFrame, worth: np.ndarray, stride: int, min_words: int, seed: int) -> DataFrame:
    """Scored documents in sorted runs."""
    buckets = len(worth)

    def scored(batch: pa.RecordBatch, place: int) -> pa.RecordBatch:
        n, total, words = [], [], []
        for first, singles, pairs in _features(batch.column("text"), buckets):
            count = np.diff(first)
            words.append(count)
            n.append(count + np.maximum(count - 1, 0))
            total.append(_per_text(first, worth[singles], worth[pairs]))
        n, total, words = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (n, total, words))
        weight = total // np.maximum(n, 1)
        chance = np.array([noise(i, seed) for i in batch.column("doc_id").to_pylist()], np.int64)
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(weight, pa.int64()), pa.array(weight + chance, pa.int64()),
            pa.array(np.arange(place, place + len(n)), pa.int64()), pa.array(words >= min_words),
            pa.array(np.zeros(len(n), bool))], schema=_RUNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, rows = TaskContext.get().partitionId() << 36, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(scored(batch, place))
            place, rows = place + batch.num_rows, rows + batch.num_rows
            if rows >= RUN_ROWS:
                yield _in_order(pa.Table.from_batches(held).combine_chunks().to_batches()[0], stride)
                held, rows = [], 0
        if held:
            yield _in_order(pa.Table.from_batches(held).combine_chunks().to_batches()[0], stride)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), _RUNS_SQL)


def _splitters(runs: DataFrame, segments: int) -> np.ndarray:
    """Keys at regular distances among the marked rows of all runs, at most ``segments`` - 1."""
    marked = runs.where("marked").select("doc_id", "n_features", "score", "place").toArrow().combine_chunks()
    if not marked.num_rows or segments < 2:
        return np.zeros(0, "S33")
    keys = np.sort(_batch_keys(marked.to_batches()[0]))
    return np.unique(keys[np.arange(1, segments) * len(keys) // segments])


def _ranked(runs: DataFrame, segments: int) -> DataFrame:
    """The eligible rows of ``runs`` with their ranks."""
    splitters = _splitters(runs, segments)
    segments = len(splitters) + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.searchsorted(splitters, _batch_keys(batch), side="right")
            yield batch.append_column("segment", pa.array(found, pa.int32()))

    columns = "doc_id long, n_features long, weight long, score long, place long"
    in_segments = (runs.where("eligible").drop("eligible", "marked")
                   .mapInArrow(tidy(cut), f"{columns}, segment int"))
    sizes = np.zeros(segments + 1, np.int64)
    for segment, n in in_segments.groupBy("segment").count().collect():  # a row a segment
        sizes[segment + 1] = n
    before = np.cumsum(sizes)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            segment = batch.column("segment").to_numpy(zero_copy_only=False)
            rank = np.zeros(len(segment), np.int64)
            for s in np.unique(segment):
                own = np.flatnonzero(segment == s)
                done = seen.get(int(s), 0)
                rank[own] = before[s] + done + 1 + np.arange(len(own))
                seen[int(s)] = done + len(own)
            yield batch.append_column("rank", pa.array(rank, pa.int64()))

    merged = in_segments.repartitionById(segments, F.col("segment")).sortWithinPartitions(
        "segment", F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features", "place")
    return merged.mapInArrow(tidy(number), f"{columns}, segment int, rank long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``, drawn towards ``target``.

    Reads ``doc_id`` and ``text`` of ``docs`` and ``text`` of ``target``. Of the documents with at
    least ``min_words`` words, ``percent`` in a hundred (rounded down) get a rank, from 1; the rest
    have none. Null and empty texts have no features and weight 0. A null id gets the noise of an
    empty id and comes last among equal scores. Rows that repeat an id are documents of their own;
    where their scores are equal too, the one with fewer features comes first, then either (the rows
    that come out are the same). Empty tables give no rows, or gains of an empty target.
    """
    corpus, n = feature_counts(docs, buckets, min_words)
    wanted, _ = feature_counts(target, buckets, min_words)
    segments = max(1, math.isqrt(n) // 4)
    stride = max(1, n // (segments * OVERSAMPLE))
    runs = stage(_runs(docs, gains(corpus, wanted), stride, min_words, seed), "runs")
    drawn = percent * n // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return _ranked(runs, segments).select(*columns, rank.alias("rank")).unionByName(
        runs.where("not eligible").select(*columns, F.lit(None).cast("long").alias("rank")))
