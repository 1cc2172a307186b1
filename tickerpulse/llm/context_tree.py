"""Language model scores by context-tree weighting over bytes.

A byte is eight binary decisions, each at a node of a tree of bit prefixes. Every node has a context
tree over the bytes before: at each context, of 0 to ``DEPTH`` bytes, a Krichevsky-Trofimov estimate
from the training counts, and a weight for stopping there against going one byte deeper, by which all
depths are mixed (Willems, Shtarkov, Tjalkens 1995). The probability of a text is the product over
its bytes and the end mark; all texts are scored with the counts of the training texts.

On Spark: a task turns its texts into blocks of bounded size and counts the distinct runs of
``DEPTH`` + 1 bytes in each. The runs' totals are dealt out by the two bytes before the last one: what lies
deeper than two bytes of context is mixed there, and only sums per node of the upper two levels, at
most 256 x 256 of them whatever the corpus, pass the driver. Each block then gets the code length of its own distinct
runs back, packed into arrays before they are sent, and scores its texts. Runs unseen in training are
carried through with count 0. Words for the base score go the same way. A block is many rows, of a chunk of texts
or of ``SLICE`` keys: a row is held several times over where it passes between Spark and Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import CHUNK_ROWS, give_back, stage, text_chunks, tidy, words_of

DEPTH = 4
MARK = 255  # ends a text, and stands before its first byte; no byte of UTF-8
BLOCK_BYTES = 10 << 20
RUNS_PER_TASK = 40_000
SLICE = 1 << 15  # keys in a row
MERGED_AT = 1 << 18  # keys that a block holds unmerged, or as many as it has merged
PACKED_AT = 1 << 19  # rows that a task holds to pack them by block

_HALF = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, 4096) - 0.5))))  # ln of 1/2 * 3/2 * ... (n - 1/2)
_WHOLE = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, 4096)))))  # ln n!


def _log_rising(n: np.ndarray, table: np.ndarray, shift: float) -> np.ndarray:
    """ln of Gamma(n + shift) / Gamma(shift): by table, beyond it by Stirling's series."""
    n = n.astype(float)
    x = np.maximum(n + shift, 1.0)
    far = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    far -= 0.5 * np.log(np.pi) if shift == 0.5 else 0.0
    return np.where(n < len(table), table[np.minimum(n, len(table) - 1).astype(int)], far)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of any string with these counts."""
    return (_log_rising(zeros, _HALF, 0.5) + _log_rising(ones, _HALF, 0.5) - _log_rising(zeros + ones, _WHOLE, 1.0))


def byte_runs(raw: np.ndarray, cuts: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Of texts ``raw[cuts[i]:cuts[i + 1]]``: for every byte and the end mark, the run of ``depth``
    bytes before and itself as one number; and where each text's numbers begin."""
    sizes = np.diff(cuts)
    begin = np.concatenate(([0], np.cumsum(sizes + depth + 1)))
    buf = np.full(int(begin[-1]), MARK, np.uint8)
    buf[np.arange(len(raw)) + np.repeat(begin[:-1] + depth - cuts[:-1], sizes)] = raw
    code = np.zeros(max(0, len(buf) - depth), np.uint64)
    for i in range(depth + 1):
        code = (code << np.uint64(8)) | buf[i:len(code) + i]
    first = np.concatenate(([0], np.cumsum(sizes + 1)))
    at = np.arange(int(first[-1])) + np.repeat(np.arange(len(sizes)) * depth, sizes + 1)
    return code[at].view(np.int64), first


class Levels:
    """Context trees over a set of byte runs, from ``depth`` bytes of context up to ``top``.

    ``code``: distinct runs, ``count``: how often each occurs in training. For every level: the nodes
    (context and bit prefix), their bit counts, the probability of the estimate and of the mixture."""

    def __init__(self, code: np.ndarray, count: np.ndarray, depth: int, top: int):
        byte = (code & 255).astype(np.int64)
        steps = np.arange(7, -1, -1)
        prefix = (256 + byte[:, None]) >> (steps + 1)[None, :]  # 1, then 1 and the bits so far
        self.bit = ((byte[:, None] >> steps[None, :]) & 1).astype(bool)
        self.depth, self.top, self.levels = depth, top, {}
        context = (code >> 8).astype(np.int64)
        below = None
        for d in range(depth, top - 1, -1):
            key = ((context & ((1 << 8 * d) - 1))[:, None] << 8) | prefix
            node, place = np.unique(key.reshape(-1), return_inverse=True)
            flat = np.repeat(count, 8).astype(float)
            ones = np.bincount(place, flat * self.bit.reshape(-1), minlength=len(node))
            zeros = np.bincount(place, flat, minlength=len(node)) - ones
            estimate = log_kt(zeros, ones)
            mixed = estimate
            if below is not None:
                lower_node, lower_mixed = below
                parent = ((lower_node >> 8) & ((1 << 8 * d) - 1)) << 8 | (lower_node & 255)
                deeper = np.bincount(np.searchsorted(node, parent), lower_mixed, minlength=len(node))
                mixed = np.logaddexp(estimate, deeper) + np.log(0.5)
            self.levels[d] = (node, place, zeros, ones, estimate, mixed)
            below = node, mixed

    def upper(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        node, _, zeros, ones, _, mixed = self.levels[self.top]
        return node, zeros, ones, mixed

    def bits(self) -> np.ndarray:
        """Probability of each of the eight bits of each run, mixed from ``depth`` up to ``top``."""
        p = None
        for d in range(self.depth, self.top - 1, -1):
            _, place, zeros, ones, estimate, mixed = self.levels[d]
            p = mix_level(p, place, self.bit.reshape(-1), zeros, ones, estimate, mixed)
        return p.reshape(self.bit.shape)


def mix_level(deeper: np.ndarray | None, place: np.ndarray, bit: np.ndarray, zeros: np.ndarray, ones: np.ndarray,
              estimate: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    """Probabilities of bits at the nodes ``place``: the estimate there, and one level deeper."""
    seen = np.where(bit, ones[place], zeros[place])
    own = (seen + 0.5) / (zeros[place] + ones[place] + 1.0)
    if deeper is None:
        return own
    stop = np.exp(np.log(0.5) + estimate - mixed)[place]
    return stop * own + (1 - stop) * deeper


class Roof:
    """The levels of one and no byte of context, as full tables of 256 x 256 and 256 nodes."""

    def __init__(self, context: np.ndarray, prefix: np.ndarray, zeros: np.ndarray, ones: np.ndarray, deeper: np.ndarray):
        one = [np.zeros((256, 256)) for _ in range(3)]
        for table, values in zip(one, (zeros, ones, deeper)):
            table[context, prefix] = values
        self.zeros1, self.ones1, below = one
        self.estimate1 = log_kt(self.zeros1, self.ones1)
        self.mixed1 = np.logaddexp(self.estimate1, below) + np.log(0.5)
        self.zeros0, self.ones0 = self.zeros1.sum(0), self.ones1.sum(0)
        self.estimate0 = log_kt(self.zeros0, self.ones0)
        self.mixed0 = np.logaddexp(self.estimate0, self.mixed1.sum(0)) + np.log(0.5)

    def finish(self, code: np.ndarray, tree: Levels) -> np.ndarray:
        """log10 of the probability of each run's last byte after the others."""
        byte = (code & 255).astype(np.int64)
        prefix = (256 + byte[:, None]) >> np.arange(8, 0, -1)[None, :]
        context = ((code >> 8) & 255).astype(np.int64)
        bit, p = tree.bit.reshape(-1), tree.bits().reshape(-1)
        place = (context[:, None] << 8 | prefix).reshape(-1)
        p = mix_level(p, place, bit, *[x.reshape(-1) for x in (self.zeros1, self.ones1, self.estimate1, self.mixed1)])
        p = mix_level(p, prefix.reshape(-1), bit, self.zeros0, self.ones0, self.estimate0, self.mixed0)
        return np.log10(p).reshape(-1, 8).sum(1)


class _Counts:
    """Distinct codes, and how often each occurs in training (0: never). What was added is merged as it comes."""

    def __init__(self):
        self.merged = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, codes: np.ndarray, trains: np.ndarray) -> None:
        self.parts.append(np.unique(codes[trains], return_counts=True))
        rest = np.unique(codes[~trains])
        self.parts.append((rest, np.zeros(len(rest), np.int64)))
        self.waiting += sum(len(code) for code, _ in self.parts[-2:])
        if self.waiting > max(MERGED_AT, len(self.merged[0])):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        code, count = (np.concatenate(x) for x in zip(self.merged, *self.parts))
        self.parts, self.waiting = [], 0
        code, place = np.unique(code, return_inverse=True)
        self.merged = code, np.bincount(place, count, minlength=len(code)).astype(np.int64)
        return self.merged


class _Block:
    """The distinct runs and words of a block's texts met so far."""

    def __init__(self, depth: int):
        self.depth, self.bytes = depth, 0
        self.runs, self.words = _Counts(), _Counts()

    def add(self, raw: np.ndarray, cuts: np.ndarray, trains: np.ndarray) -> None:
        w = words_of(raw, cuts)
        code, first = byte_runs(w.buf, cuts, self.depth)
        for store, codes, starts in ((self.runs, code, first), (self.words, w.code.view(np.int64), w.first)):
            store.add(codes, np.repeat(trains, np.diff(starts)))
        self.bytes += len(raw) + len(cuts)


_BLOCKS = "block long, doc_id array<long>, held_out array<boolean>, texts array<binary>, word boolean, keys binary, counts binary"


def blocks(docs: DataFrame, held_out: Column, depth: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of about ``block_bytes`` of whole texts: rows of texts, and rows of the distinct byte runs
    (``word`` is false) and words (true) of the block with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, now = None, 0, _Block(depth)
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("_part")[0].as_py()
            ids, held = batch.column("doc_id").to_pylist(), np.array(batch.column("_held").to_pylist(), bool)
            for begin in range(0, batch.num_rows, CHUNK_ROWS):
                for lo, hi, raw, cuts in text_chunks(batch.column("text").slice(begin, CHUNK_ROWS)):
                    at = slice(begin + lo, begin + hi)
                    now.add(raw, cuts, ~held[at])
                    data = raw.tobytes()
                    texts = [data[cuts[i]:cuts[i + 1]] for i in range(hi - lo)]
                    yield _block_rows((part << 32) + k, ids[at], held[at].tolist(), texts)
                    if now.bytes >= block_bytes:
                        yield from _key_rows((part << 32) + k, now)
                        k, now = k + 1, _Block(depth)
        if now.bytes:
            yield from _key_rows((part << 32) + k, now)

    rows = docs.select(F.col("doc_id").cast("long"), "text", held_out.alias("_held"), F.spark_partition_id().alias("_part"))
    return rows.mapInArrow(tidy(run), _BLOCKS)


def _block_rows(block: int, ids: list | None = None, held: list | None = None, texts: list | None = None,
                word: bool | None = None, keys: bytes | None = None, counts: bytes | None = None) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.binary()), pa.bool_(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip((block, ids, held, texts, word, keys, counts), kinds)],
                                      names=["block", "doc_id", "held_out", "texts", "word", "keys", "counts"])


def _key_rows(block: int, found: _Block) -> Iterator[pa.RecordBatch]:
    for word, store in ((False, found.runs), (True, found.words)):
        keys, counts = store.merge()
        for lo in range(0, len(keys), SLICE):
            yield _block_rows(block, word=word, keys=keys[lo:lo + SLICE].tobytes(), counts=counts[lo:lo + SLICE].tobytes())


def _keys(made: DataFrame, word: bool) -> DataFrame:
    """(block, key, n): a row for every distinct run or word of every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, counts in zip(*batch.columns):
                keys, counts = (np.frombuffer(x.as_buffer(), np.int64) for x in (keys, counts))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block.as_py())), pa.array(keys), pa.array(counts)],
                                                 names=["block", "key", "n"])

    return made.where(F.col("word") == F.lit(word)).select("block", "keys", "counts").mapInArrow(
        tidy(run), "block long, key long, n long")


def _planes(x: np.ndarray) -> bytes:
    """Numbers of 8 bytes as the first bytes of all, then the second, and so on: equal ones get together and compress."""
    return x.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(parts: list, kind: type) -> np.ndarray:
    out = [np.frombuffer(x, np.uint8).reshape(8, -1).T.copy().view(kind).ravel() for x in parts]
    return np.concatenate(out) if out else np.zeros(0, kind)


def packed(rows: DataFrame, word: bool, at_once: int = PACKED_AT) -> DataFrame:
    """(block, word, keys, values) of rows (block, key, value): those of a block that a task meets among
    ``at_once`` rows become one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n += batch.num_rows
            if n >= at_once:
                yield _by_block(held, word)
                held, n = [], 0
        if n:
            yield _by_block(held, word)

    return rows.select("block", "key", "value").mapInArrow(tidy(run), "block long, word boolean, keys binary, values binary")


def _by_block(held: list[list[np.ndarray]], word: bool) -> pa.RecordBatch:
    block, key, value = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(block, kind="stable")
    block, key, value = block[order], key[order], value[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)]))
    spans = list(zip(cuts[:-1], cuts[1:]))
    return pa.RecordBatch.from_arrays(
        [pa.array(block[cuts[:-1]]), pa.array(np.full(len(spans), word)), pa.array([_planes(key[a:b]) for a, b in spans], pa.binary()),
         pa.array([_planes(value[a:b]) for a, b in spans], pa.binary())], names=["block", "word", "keys", "values"])


def model(totals: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, value): log10 probability of the last byte of each byte run of ``totals`` (key, n)."""
    tasks = max(1, -(-totals.count() // RUNS_PER_TASK))
    tail = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))
    dealt = totals.withColumn("_task", F.pmod(F.xxhash64(tail), F.lit(tasks)))

    def arrays(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return np.asarray(group["key"], np.int64), np.asarray(group["n"], np.int64)

    def up(group: pa.Table) -> pa.Table:
        node, zeros, ones, mixed = Levels(*arrays(group), depth, 2).upper()
        return pa.table({"node": node & 0xFFFF, "zeros": zeros, "ones": ones, "mixed": mixed})

    nodes = (dealt.groupBy("_task").applyInArrow(up, "node long, zeros double, ones double, mixed double")
             .groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("mixed")))
    top = np.array([tuple(r) for r in nodes.collect()], float).reshape(-1, 4)  # 65 536 rows at most
    node = top[:, 0].astype(np.int64)
    roof = Roof(node >> 8, node & 255, *top[:, 1:].T)

    def down(group: pa.Table) -> pa.Table:
        code, count = arrays(group)
        return pa.table({"key": code, "value": roof.finish(code, Levels(code, count, depth, 2))})

    return dealt.groupBy("_task").applyInArrow(down, "key long, value double")


def score(docs: DataFrame, held_out: Column, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    Learns from the rows where ``held_out`` is false and scores all. Reads ``doc_id`` and ``text``; a
    null text is empty and consists of the end alone. Repeated rows count as often as they occur. With
    no training text every bit has the probability 1/2; an empty table gives an empty result.

    score: log10 of the probability of the text's bytes, A-Z lower-cased, and its end. base_score: sum
    over words and the end of log10((c + 0.1) / (N + 0.1 (V + 1))) with the training counts."""
    made = stage(blocks(docs, held_out, depth, block_bytes), "blocks")
    totals = stage(_keys(made, False).groupBy("key").agg(F.sum("n").alias("n")), "runs")
    of_runs = _keys(made, False).join(model(totals, depth), "key")
    by_key = Window.partitionBy("key")
    of_words = stage(_keys(made, True).select(
        "block", "key", F.sum("n").over(by_key).alias("c"), (F.row_number().over(by_key.orderBy("block")) == 1).alias("once")), "words")
    words = of_words.where("once and c > 0").agg(F.sum("c"), F.count("*")).first()
    texts = made.select(F.explode("held_out").alias("h")).where("not h").count()
    n, v = (words[0] or 0) + texts, words[1] + (texts > 0)
    below = float(np.log10(n + 0.1 * (v + 1)))
    tables = packed(of_runs, False).unionByName(packed(of_words.select("block", "key", F.col("c").cast("double").alias("value")), True))

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        rows, found = list(zip(*(right[c].to_pylist() for c in ("word", "keys", "values")))), []
        for wanted in (False, True):
            own = _from_planes([keys for word, keys, _ in rows if word == wanted], np.int64)
            value = _from_planes([values for word, _, values in rows if word == wanted], np.float64)
            order = np.argsort(own)
            found.append((own[order], value[order]))
        (runs, length), (names, counts) = found
        out: dict[str, list] = {k: [] for k in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes")}
        for ids, held, data in zip(left["doc_id"].to_pylist(), left["held_out"].to_pylist(), left["texts"]):
            out["doc_id"] += ids
            out["held_out"] += held
            for lo, hi, raw, cuts in text_chunks(data.values.cast(pa.large_binary()).view(pa.large_string())):
                w = words_of(raw, cuts)
                code, first = byte_runs(w.buf, cuts, depth)
                out["score"] += np.add.reduceat(length[np.searchsorted(runs, code)], first[:-1]).tolist()
                c = counts[np.searchsorted(names, w.code.view(np.int64))] if len(w.code) else np.zeros(0)
                own = np.repeat(np.arange(hi - lo), np.diff(w.first))
                tokens = np.diff(w.first) + 1
                out["n_tokens"] += tokens.tolist()
                out["n_known"] += (np.bincount(own, c > 0, minlength=hi - lo) + (texts > 0)).astype(int).tolist()
                out["base_score"] += (np.bincount(own, np.log10(c + 0.1), minlength=hi - lo)
                                      + np.log10(texts + 0.1) - tokens * below).tolist()
                out["n_bytes"] += np.diff(cuts).tolist()
        give_back()
        return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "held_out": pa.array(out["held_out"], pa.bool_()),
                         **{k: pa.array(out[k], pa.int64()) for k in ("n_tokens", "n_known", "n_bytes")},
                         **{k: pa.array(out[k], pa.float64()) for k in ("base_score", "score")}})

    chunks = made.where("texts is not null").select("block", "doc_id", "held_out", "texts")
    scored = chunks.groupBy("block").cogroup(tables.groupBy("block")).applyInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, n_bytes long, base_score double, score double")
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", "n_bytes",
        (-F.col("score") * float(np.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
