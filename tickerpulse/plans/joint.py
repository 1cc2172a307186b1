"""Many classifiers trained together: every symbol, fold and setting of a family in the same passes.

A row belongs to one outer and one inner fold of its symbol. A model is trained on the rows of a
symbol that lie outside one outer fold, one inner fold, both or neither (``Subset``), with one setting.
All models of all symbols need the same few sums over the rows: each pass is one Spark job in which
every task adds up what its rows contribute to every model (numpy over whole batches), and Spark adds
up the tasks' sums by model. What comes to the driver are sums and coefficients, whose number depends on
the grid and the symbols, never on the rows; symbols are taken ``SYMBOLS_AT_ONCE`` at a time.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.indicators import FEATURES, KEY
from ..session import cut_lineage, ship_package

LABEL = "Target"
FOLDS = 5
SYMBOLS_AT_ONCE = 200
ROWS_OF_TASK = 1024  # fewer would make a task yield more sums than it reads rows
TASKS_ADDED_UP = 8  # by one


class Subset(NamedTuple):
    """Rows outside the folds named; -1 names none."""

    outer: int
    inner: int


def subsets(nested: bool, folds: int = FOLDS) -> tuple[Subset, ...]:
    """All rows and all but each inner fold; ``nested``: these again outside each outer fold."""
    return tuple(Subset(o, i) for o in range(-1, folds if nested else 0) for i in range(-1, folds))


def in_training(subset: Subset, outer: np.ndarray, inner: np.ndarray) -> np.ndarray:
    return (outer != subset.outer) & (inner != subset.inner)


def held_out(subset: Subset, outer: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """The rows that judge a model of this subset."""
    if subset.inner >= 0:
        return (outer != subset.outer) & (inner == subset.inner)
    return outer == subset.outer


def with_folds(rows: DataFrame, keys: Iterable[str], folds: int = FOLDS, column: str = "fold", salt: int = 0) -> DataFrame:
    """Add a fold number derived from the keys, so that it survives retries and reruns."""
    place = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(salt)), F.lit(folds))
    return rows.withColumn(column, place.cast("int"))


# scaling -------------------------------------------------------------------------------------

def extremes(rows: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``by``, the number of rows, and least and greatest value of each column (lo_*, hi_*)."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("lo", F.min), ("hi", F.max))])


def scale(value: Column, lo: Column, hi: Column) -> Column:
    """Into 0 to 1 by the range given; a range of one value gives 0 for it."""
    return (value - lo) / F.when(hi == lo, 1.0).otherwise(hi - lo)


def scaled_per_fold(rows: DataFrame, key: str, fold: str, columns: Sequence[str]) -> DataFrame:
    """Each row once for every fold of its symbol (``without``), its columns scaled by the rows of the
    symbol outside that fold. One pass finds the extremes of each (symbol, fold); those of the rest of
    a symbol are put together from these few rows and joined back by symbol. A symbol with one fold has
    no other rows and does not come out."""
    cells = extremes(rows, [key, fold], columns)
    others = cells.select(key, F.col(fold).alias("without")).join(cells, key).where(F.col("without") != F.col(fold))
    around = others.groupBy(key, "without").agg(
        *[f(f"{name}_{c}").alias(f"{name}_{c}") for c in columns for name, f in (("lo", F.min), ("hi", F.max))])
    scaled = {c: scale(F.col(c), F.col(f"lo_{c}"), F.col(f"hi_{c}")) for c in columns}
    return rows.join(around, key).withColumns(scaled).select(*rows.columns, "without")


# rows and passes --------------------------------------------------------------------------------

@dataclass(frozen=True)
class Problem:
    """Rows ready for passes, and what every family needs to know about them. ``lo`` and ``hi``:
    [symbol, subset, feature]; ``rows`` has symbol, x (features), label, outer, inner."""

    rows: DataFrame
    symbols: tuple[str, ...]
    subsets: tuple[Subset, ...]
    features: tuple[str, ...]
    lo: np.ndarray
    hi: np.ndarray
    counts: np.ndarray  # [symbol, subset, class]
    packed: RDD  # of Batch: the same rows

    @property
    def span(self) -> np.ndarray:
        return np.where(self.hi > self.lo, self.hi - self.lo, 1.0)


def prepare(build: DataFrame, keys: Sequence[str], nested: bool, symbols: Sequence[str] | None = None,
            features: Sequence[str] = FEATURES, folds: int = FOLDS) -> Problem:
    """Rows with folds, laid out by symbol, and the ranges of every subset. Rows with a null feature, label
    or symbol cannot be learnt from and are left out.

    What a pass costs beyond its rows is the sums that each task yields for every model of each symbol it
    meets, so tasks get ``ROWS_OF_TASK`` rows at least, and rows of one symbol lie together."""
    spark = build.sparkSession
    ship_package(spark)
    rows = with_folds(with_folds(build, keys, folds, "inner", 1), keys, folds, "outer", 2)
    rows = rows.select(F.col(KEY).alias("symbol"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                       F.col(LABEL).cast("double").alias("label"), "outer", "inner").dropna()
    if symbols is not None:
        rows = rows.where(F.col("symbol").isin(list(symbols)))
    rows = cut_lineage(rows)
    names = [f"x{i}" for i in range(len(features))]
    cells = extremes(rows, ["symbol", "outer", "inner", "label"], names).collect()  # 50 rows a symbol
    parts = min(-(-sum(r.n for r in cells) // ROWS_OF_TASK), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = cut_lineage(rows.repartitionByRange(max(parts, 1), "symbol", F.xxhash64(*names)))
    known = tuple(dict.fromkeys(symbols)) if symbols is not None else tuple(sorted({r.symbol for r in cells}))
    place = {s: i for i, s in enumerate(known)}
    chosen = subsets(nested, folds)
    lo = np.full((len(known), len(chosen), len(names)), np.inf)
    hi, counts = -lo, np.zeros((len(known), len(chosen), 2))
    for r in cells:
        own_lo, own_hi = np.array([r[f"lo_{c}"] for c in names]), np.array([r[f"hi_{c}"] for c in names])
        for u, subset in enumerate(chosen):
            if in_training(subset, r.outer, r.inner):
                at = place[r.symbol], u
                lo[at], hi[at] = np.minimum(lo[at], own_lo), np.maximum(hi[at], own_hi)
                counts[*at, int(r.label)] += r.n
    empty = ~np.isfinite(lo)
    lo[empty], hi[empty] = 0.0, 0.0
    return Problem(rows, known, chosen, tuple(features), lo, hi, counts, _packed(rows, known, len(names)))


class Batch(NamedTuple):
    """Rows of one symbol inside a task."""

    symbol: int
    x: np.ndarray
    label: np.ndarray
    outer: np.ndarray
    inner: np.ndarray


def batches_of(batch: pa.RecordBatch, symbols: dict[str, int], features: int) -> Iterator[Batch]:
    names = batch.column("symbol").dictionary_encode()
    x = np.column_stack([batch.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(features)])
    label, outer, inner = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "outer", "inner"))
    codes = names.indices.to_numpy(zero_copy_only=False)
    for code, name in enumerate(names.dictionary.to_pylist()):
        at = codes == code
        yield Batch(symbols[name], x[at], label[at], outer[at], inner[at])


def summed(problem: Problem, work: Callable[[Batch, object], Iterator[tuple[np.ndarray, np.ndarray]]], state: object,
           keys: Sequence[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, sums): ``work`` yields (whole numbers [rows, keys], doubles [rows, width]) for the rows of a
    symbol; rows with the same symbol and keys are added up over all tasks. The symbol's number is put first."""
    return tuple(_collected(_sums(problem, work, state, keys, width), ["symbol", *keys], width))


def added(problem: Problem, work: Callable[[Batch, object], Iterator[tuple[np.ndarray, np.ndarray]]],
          state: object) -> tuple[np.ndarray, np.ndarray]:
    """As ``summed``, for ``work`` whose keys depend on the state alone: what it yields with the same keys for a
    symbol is added up as whole arrays. Rows are kept as arrays from pass to pass, and no query is planned for one."""
    held = problem.rows.sparkSession.sparkContext.broadcast(state)

    def run(batches: Iterator[Batch]) -> Iterator[tuple[tuple[int, bytes, int], np.ndarray]]:
        sums: dict[tuple[int, bytes, int], np.ndarray] = {}
        for own in batches:
            for key, values in work(own, held.value):
                if len(key):
                    name = own.symbol, np.ascontiguousarray(key, np.int64).tobytes(), key.shape[1]
                    sums[name] = sums[name] + values if name in sums else np.asarray(values, float)
        yield from sums.items()

    # adding up is little work for a task
    parts = -(-problem.packed.getNumPartitions() // TASKS_ADDED_UP)
    found = problem.packed.mapPartitions(run).reduceByKey(np.add, parts).collect()
    held.destroy()
    if not found:
        return np.zeros((0, 2), np.int64), np.zeros((0, 1))
    keys = [np.frombuffer(k, np.int64).reshape(-1, n) for (_, k, n), _ in found]
    numbers = [np.column_stack([np.full(len(k), s, np.int64), k]) for ((s, _, _), _), k in zip(found, keys)]
    return np.concatenate(numbers), np.concatenate([v for _, v in found])


def _packed(rows: DataFrame, known: Sequence[str], features: int) -> RDD:
    """The rows as ``Batch``, kept for the passes by the executors."""
    symbols = {s: i for i, s in enumerate(known)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [pickle.dumps(tuple(own)) for own in batches_of(batch, symbols, features)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["rows"])

    return rows.mapInArrow(run, "rows binary").rdd.map(lambda r: Batch(*pickle.loads(r.rows))).persist(StorageLevel.MEMORY_AND_DISK)


def _sums(problem: Problem, work, state: object, keys: Sequence[str], width: int) -> DataFrame:
    spark = problem.rows.sparkSession
    held = spark.sparkContext.broadcast((state, {s: i for i, s in enumerate(problem.symbols)}))
    features = len(problem.features)
    names = ["symbol", *keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, symbols = held.value
        for batch in batches:
            for own in batches_of(batch, symbols, features):
                for key, values in work(own, known):
                    if len(key):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(key), own.symbol, np.int64)), *[pa.array(k.astype(np.int64)) for k in key.T],
                             *[pa.array(v.astype(np.float64)) for v in values.T]], names=[*names, *[f"v{i}" for i in range(width)]])

    schema = ", ".join([*[f"{k} long" for k in names], *[f"v{i} double" for i in range(width)]])
    return problem.rows.mapInArrow(run, schema).groupBy(*names).agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(width)])


def _collected(sums: DataFrame, names: Sequence[str], width: int) -> Iterator[np.ndarray]:
    table = sums.toArrow()
    yield np.column_stack([table.column(k).to_numpy() for k in names]) if table.num_rows else np.zeros((0, len(names)), np.int64)
    yield np.column_stack([table.column(f"v{i}").to_numpy() for i in range(width)]) if table.num_rows else np.zeros((0, width))


# choice of settings ----------------------------------------------------------------------------

class Scores(NamedTuple):
    """[symbol, subset, setting]: right predictions among ``n`` held-out rows [symbol, subset]."""

    right: np.ndarray
    n: np.ndarray

    def accuracy(self) -> np.ndarray:
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(self.n[..., None] > 0, self.right / self.n[..., None], np.nan)


def held_out_counts(problem: Problem) -> np.ndarray:
    """[symbol, subset]: rows that judge each subset."""
    def count(own: Batch, _: object) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n = np.array([held_out(u, own.outer, own.inner).sum() for u in problem_subsets], float)
        yield np.arange(len(n))[:, None], n[:, None]

    problem_subsets = problem.subsets
    keys, values = added(problem, count, None)
    out = np.zeros((len(problem.symbols), len(problem.subsets)))
    out[tuple(keys.T)] = values[:, 0]
    return out


def inner_accuracy(problem: Problem, scores: Scores, outer: int) -> np.ndarray:
    """[symbol, setting]: mean accuracy over the inner folds, outside one outer fold (-1: of all rows)."""
    at = [u for u, s in enumerate(problem.subsets) if s.outer == outer and s.inner >= 0]
    return np.nanmean(scores.accuracy()[:, at], axis=1)


def best_settings(problem: Problem, scores: Scores, outer: int = -1) -> np.ndarray:
    """[symbol]: the first of the settings with the best accuracy."""
    return np.argmax(np.nan_to_num(inner_accuracy(problem, scores, outer), nan=-1.0), axis=1)


def nested_rows(problem: Problem, scores: Scores, folds: int = FOLDS) -> list[tuple[str, int, int, float]]:
    """(symbol, outer fold, setting chosen outside it, accuracy on it)."""
    accuracy, out = scores.accuracy(), []
    for fold in range(folds):
        chosen = best_settings(problem, scores, fold)
        u = problem.subsets.index(Subset(fold, -1))
        out += [(s, fold, int(chosen[i]), float(accuracy[i, u, chosen[i]])) for i, s in enumerate(problem.symbols)]
    return out


def in_groups(symbols: Sequence[str], size: int = SYMBOLS_AT_ONCE) -> list[Sequence[str]]:
    return [symbols[i:i + size] for i in range(0, len(symbols), size)]


@functools.cache
def pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the upper triangle of a symmetric matrix."""
    return np.triu_indices(n)


def symmetric(upper: np.ndarray, n: int) -> np.ndarray:
    """[..., n, n] from the upper triangles in the last axis."""
    out = np.zeros((*upper.shape[:-1], n, n))
    a, b = pairs(n)
    out[..., a, b] = upper
    out[..., b, a] = upper
    return out


def distinct_symbols(build: DataFrame) -> list[str]:
    return sorted(r[0] for r in build.select(KEY).where(F.col(KEY).isNotNull()).distinct().collect())


