"""Packing documents into sequences of at most a fixed number of tokens.

Pieces of documents are known by their lengths. The histogram of lengths, at most ``room`` numbers
however many documents there are, is turned into a plan: patterns of up to three lengths that fill a
sequence exactly, and for each pattern how often it is used, by non-negative least squares against
the histogram (Krell et al. 2021). Repeat counts are rounded down, so that no length is used more
often than it occurs; the lengths left over are packed best-fit, longest first, by whole counts.

Pieces then take their places in the plan: the r-th piece of a length takes the r-th place that the
plan holds for it. Ranks come from counts per (length, bucket) and positions inside a bucket, so a
length that a third of all pieces share is not ranked in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import stage, tidy, with_columns
from .tokens import encoder

ROOM = 2048
END = 0  # id that ends a document
PIECES_PER_BUCKET = 20_000
STEPS = 400


def pieces(docs: DataFrame, tokenizer: str, room: int = ROOM, end: int | None = END,
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian unsigned 32-bit).

    Reads ``doc_id`` and ``text``; a null text is empty and consists of the end id. Documents longer
    than ``room`` are cut from their end, so that only the first piece is shorter. A row without a
    doc_id, and each of repeated rows, is a document of its own."""
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    tail = b"" if end is None else end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            held = 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = own.encode(text.as_py()) + tail
                n = len(ids) // 4
                first = n % room or min(n, room)
                starts = [0, *range(first, n, room)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                    part = ids[4 * a:4 * b]
                    for column, value in zip(rows, (doc_id, k, a, b - a, zlib.crc32(part), part)):
                        column.append(value)
                held += len(ids)
                if held > 1 << 24:
                    yield _piece_batch(rows, with_ids)
                    rows, held = [[], [], [], [], [], []], 0
            yield _piece_batch(rows, with_ids)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), kind)


def _piece_batch(rows: list[list], with_ids: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    n = 6 if with_ids else 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows[:n], kinds)], names=names[:n])


class Plan(NamedTuple):
    """Runs of places: pieces ``rank`` .. ``rank + times`` - 1 of ``length`` go to the sequences
    ``sequence``, ``sequence`` + 1, ..., each at ``offset``. Sorted by length and rank."""

    length: np.ndarray
    rank: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self._key(self.length, self.rank), self._key(length, rank), side="right") - 1
        return self.sequence[at] + (rank - self.rank[at]), self.offset[at]

    @staticmethod
    def _key(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return (length.astype(np.int64) << 48) + rank


def patterns(counts: np.ndarray) -> np.ndarray:
    """All (a, b, c), a >= b >= c >= 0, that add up to the room, of lengths that occur (0: none)."""
    room = len(counts) - 1
    there = counts > 0
    there[0] = True
    lengths = np.flatnonzero(there)
    out = []
    for c in lengths:
        b = lengths[(lengths >= c) & (lengths <= (room - c) // 2)] if c else lengths[lengths <= room // 2]
        a = room - c - b
        keep = (a >= b) & there[a] & (a > 0)
        out.append(np.column_stack([a[keep], b[keep], np.full(keep.sum(), c)]))
    return np.concatenate(out) if out else np.zeros((0, 3), int)


def fit_repeats(counts: np.ndarray, choices: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """How often to use each pattern: non-negative least squares, min |A x - counts|, x >= 0, by
    projected gradients with momentum. Column p of A counts the lengths of pattern p. Errors on long
    lengths weigh more, for short ones find a place anywhere."""
    n, bins = len(choices), len(counts)
    if not n:
        return np.zeros(0)
    weight = np.arange(bins) / bins
    weight[0] = 0.0
    target = counts * weight

    def forward(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(choices[:, k], x, minlength=bins) for k in range(3)) * weight

    def back(r: np.ndarray) -> np.ndarray:
        r = r * weight
        return r[choices[:, 0]] + r[choices[:, 1]] + r[choices[:, 2]]

    v = np.ones(n)
    for _ in range(12):  # largest eigenvalue, for the step
        v = back(forward(v))
        top = float(np.linalg.norm(v))
        v /= top
    x = np.zeros(n)
    y, t = x, 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - back(forward(y) - target) / (1.05 * top))
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / grown * (new - x)
        x, t = new, grown
    return x


def make_plan(histogram: dict[int, int], room: int = ROOM, steps: int = STEPS) -> Plan:
    """Patterns by least squares, then best fit for what is left. The work depends on the number of
    different lengths (``room`` at most), not on how many documents there are."""
    counts = np.zeros(room + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    left, used = counts.copy(), []
    choices = patterns(counts)
    repeats = fit_repeats(counts.astype(float), choices, steps)
    order = np.argsort(-repeats, kind="stable")
    order = order[repeats[order] >= 0.5]
    for pattern, times in zip(choices[order], repeats[order]):
        own, each = np.unique(pattern[pattern > 0], return_counts=True)
        times = int(min(round(times), (left[own] // each).min()))
        if times:
            left[own] -= times * each
            used.append(([int(x) for x in pattern if x], times))
    used += _best_fit(left, room)
    runs, taken, sequence = [], np.zeros(room + 1, np.int64), 0
    for lengths, times in used:
        offset = 0
        for length in lengths:
            runs.append((length, taken[length], times, sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    assert (taken == counts).all()
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return Plan(*table.T, sequence)


def _best_fit(left: np.ndarray, room: int) -> list[tuple[list[int], int]]:
    """Longest first, each into the open sequences with the least space that takes it. Sequences
    with the same content are one entry with a count; ``open_[s]`` has those with s tokens free."""
    open_: list[list[tuple[list[int], int]]] = [[] for _ in range(room + 1)]
    for length in range(room, 0, -1):
        todo = int(left[length])
        space = length
        while todo:
            while space <= room and not open_[space]:
                space += 1
            if space > room:  # new sequences, each taking as many of this length as fit
                each = room // length
                full, rest = divmod(todo, each)
                if full:
                    open_[room - each * length].append(([length] * each, full))
                if rest:
                    open_[room - rest * length].append(([length] * rest, 1))
                break
            content, times = open_[space].pop()
            each = min(space // length, -(-todo // times))
            if each * times <= todo:
                open_[space - each * length].append((content + [length] * each, times))
                todo -= each * times
            else:
                full, rest = divmod(todo, each)
                if full:
                    open_[space - each * length].append((content + [length] * each, full))
                if rest:
                    open_[space - rest * length].append((content + [length] * rest, 1))
                if times > full + bool(rest):
                    open_[space].append((content, times - full - bool(rest)))
                todo = 0
    return [entry for entries in open_ for entry in entries if entry[1]]


def pack(cut: DataFrame, room: int = ROOM, steps: int = STEPS) -> DataFrame:
    """``cut`` (``length`` from 1 to ``room``, any other columns) with sequence_id and offset.

    Sequences are filled without gaps from offset 0. Equal pieces are told apart by nothing; which
    of them goes where is left open. No pieces give no sequences."""
    cut = stage(cut.drop("sequence_id", "offset"), "cut")
    names = cut.columns
    total = cut.count()
    buckets = max(1, -(-total // PIECES_PER_BUCKET))
    spread = [F.col(c) for c in names if c in ("doc_id", "piece")] or [F.monotonically_increasing_id()]
    dealt = stage(cut.withColumn("_bucket", F.pmod(F.xxhash64(*spread, F.monotonically_increasing_id()), F.lit(buckets))), "dealt")
    counts = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("n")
    bases = counts.select("length", "_bucket", before.alias("_base"))
    histogram = {r[0]: r[1] for r in dealt.groupBy("length").count().collect()}
    plan = make_plan(histogram, room, steps)
    within = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("length")) - 1
    ranked = dealt.withColumn("_in", within).join(bases, ["length", "_bucket"]).select(
        *names, (F.col("_base") + F.col("_in")).alias("_rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = np.asarray(batch.column("length"), np.int64)
            sequence, offset = plan.places(length, np.asarray(batch.column("_rank"), np.int64))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(tidy(run), with_columns(cut, sequence_id=LongType(), offset=LongType()))


def fill(packed: DataFrame, room: int = ROOM) -> pd.Series:
    """Sequences, tokens and the least number of sequences that could hold them."""
    row = packed.agg((F.max("sequence_id") + 1).alias("sequences"), F.sum("length").alias("tokens")).first()
    return pd.Series({"sequences": row[0] or 0, "tokens": row[1] or 0, "least": -(-(row[1] or 0) // room)})
