"""Support vector machines with the RBF kernel itself: every row that a model learns from may be a support vector.

A model minimises half the squared norm of its function + C * (sum of the losses of its rows); the loss is the hinge,
rounded off over ``ROUNDED`` at its corner. The minimum is a sum of kernels with the rows of its subset: a row
whose value is right by more than the margin has the coefficient 0, one short of it by ``ROUNDED`` or more has C
times its sign, and for those between, it follows from linear equations. Newton steps with an exact line search guess which rows these are
until the guess holds; that takes a few steps, as the function is made of finitely many quadratic pieces.

On Spark: the rows of a symbol meet in one task for each subset, which fits all settings there and counts what
is predicted right on the rows held out. Only these counts come to the driver, and the support vectors of
models that are asked for. Up to ``WORKING`` rows a task holds their kernels; of more, it takes that many rows at a
time, the ones furthest from the minimum, with the others fixed, until no two rows disagree about the offset by
more than ``TOLERANCE``. Time grows with the square of a symbol's rows at least, memory with the rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

from .joint import Batch, Problem, Scores, Subset, held_out, in_training
from .joint_kernel import ROUNDED, Setting, _distances, _loss

WORKING = 2048  # rows whose kernels with each other are held
CHUNK = 512  # rows whose kernels with all others are held
TOLERANCE = 1e-3  # of values; the loss ends within ROUNDED of them


def _wanted(g: np.ndarray, b: float, y: np.ndarray, c: float) -> np.ndarray:
    """The coefficients that go with the values ``g`` + ``b``."""
    return c * y * np.clip((1 - y * (g + b)) / ROUNDED, 0, 1)


def _offset(g: np.ndarray, y: np.ndarray, c: float, total: float) -> float:
    """The offset with which the coefficients wanted add up to ``total``; the middle, where a range of them does.

    Each row takes C from their sum while the offset goes over a stretch of length ``ROUNDED``."""
    begin = np.where(y > 0, 1 - ROUNDED, -1) - g
    at = np.concatenate([begin, begin + ROUNDED])
    order = np.argsort(at, kind="stable")
    at = at[order]
    steep = np.cumsum(np.where(order < len(g), 1, -1)) / ROUNDED
    taken = np.concatenate(([0.0], np.cumsum(steep[:-1] * np.diff(at))))
    due = (y > 0).sum() - total / c
    ends = []
    for i, aim in ((np.searchsorted(taken, due - 1e-9, "left"), due - 1e-9), (np.searchsorted(taken, due + 1e-9, "right"), due + 1e-9)):
        i = min(max(int(i), 1), len(at) - 1)
        share = (aim - taken[i - 1]) / max(taken[i] - taken[i - 1], 1e-300)
        ends.append(at[i - 1] + min(max(share, 0.0), 1.0) * (at[i] - at[i - 1]))
    return float(ends[0] + ends[1]) / 2


def minimum(kernel: np.ndarray, rest: np.ndarray, y: np.ndarray, c: float, total: float, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Coefficients and offset of the rows with these kernels, where other rows add ``rest`` to the values. The
    coefficients add up to ``total``."""
    beta, g, before = start, kernel @ start + rest, np.inf
    b = _offset(g, y, c, total)
    while True:
        wanted = _wanted(g, b, y, c)
        now = 0.5 * beta @ (g - rest) + c * _loss(y * (g + b))[0].sum() + total * b
        if np.abs(wanted - beta).max() <= 1e-7 * c or not now < before:  # nothing is gained any more: rounding
            return wanted, b
        before = now
        short = 1 - y * (g + b)
        between, full = np.flatnonzero((short > 0) & (short < ROUNDED)), short >= ROUNDED
        aim, aim_b = np.where(full, c * y, 0.0), b
        if len(between):
            own = kernel[np.ix_(between, between)]
            own[np.diag_indices(len(own))] += ROUNDED / c
            right = np.column_stack([y[between] - rest[between] - kernel[between] @ aim, np.ones(len(own))])
            u, v = np.linalg.solve(own, right).T
            aim_b = (u.sum() + aim.sum() - total) / v.sum()
            aim[between] = u - aim_b * v
        step, step_b = aim - beta, aim_b - b
        aim_g = kernel @ aim + rest
        move = aim_g - g

        def slope(t: float) -> float:
            ahead = _wanted(g + t * move, b + t * step_b, y, c)
            return float((beta + t * step - ahead) @ move - step_b * (ahead.sum() - total))

        t, low = 1.0, 0.0
        if slope(1.0) > 1e-12 * abs(slope(0.0)):
            high = 1.0
            while high - low > 1e-4 * high > 1e-16:
                t = (low + high) / 2
                low, high = (t, high) if slope(t) < 0 else (low, t)
        beta, g = (aim, aim_g) if t == 1.0 else (beta + t * step, g + t * move)
        b = _offset(g, y, c, total)


def _kernel(x: np.ndarray, z: np.ndarray, gamma: float) -> np.ndarray:
    out = _distances(x, z)
    out *= -gamma
    return np.exp(out, out=out)


def values(x: np.ndarray, support: np.ndarray, gamma: float, beta: np.ndarray) -> np.ndarray:
    """[row, ...]: sums of kernels with ``support`` times ``beta`` [..., support], without offsets."""
    parts = [_kernel(x[i:i + CHUNK], support, gamma) @ beta.T for i in range(0, len(x), CHUNK)]
    return np.concatenate(parts) if parts else np.zeros((0, *beta.shape[:-1]))


def _in_parts(x: np.ndarray, y: np.ndarray, gamma: float, c: float, working: int, beta: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients, and values without the offset, of more rows than can be held."""
    most, before = np.where(y > 0, c, 0.0), np.inf
    while True:
        pull = g + beta * ROUNDED / c - y
        now = 0.5 * beta @ (pull - y)
        if not now < before:  # rounding
            return beta, g
        before = now
        rise, fall = np.flatnonzero(beta < most), np.flatnonzero(beta > most - c)
        if pull[fall].max(initial=-np.inf) - pull[rise].min(initial=np.inf) <= TOLERANCE:
            return beta, g
        half = working // 2
        some = np.union1d(rise[np.argsort(pull[rise], kind="stable")[:half]], fall[np.argsort(-pull[fall], kind="stable")[:half]])
        kernel, old = _kernel(x[some], x[some], gamma), beta[some]
        new, _ = minimum(kernel, g[some] - kernel @ old, y[some], c, float(old.sum()), old)
        beta = beta.copy()
        beta[some] = new
        g = g + values(x, x[some], gamma, new - old)


def machines(x: np.ndarray, y: np.ndarray, gamma: float, penalties: Sequence[float], working: int = WORKING) -> tuple[np.ndarray, np.ndarray]:
    """[penalty, row] coefficients and [penalty] offsets of the rows ``x`` (scaled) with the signs ``y``."""
    out, offsets = np.zeros((len(penalties), len(x))), np.zeros(len(penalties))
    if not len(x) or (y == y[0]).all():  # one class only
        return out, np.full(len(penalties), y[0] if len(x) else -1.0)
    held = _kernel(x, x, gamma) if len(x) <= working else None
    beta = g = None
    for i in np.argsort(penalties, kind="stable"):
        c = float(penalties[i])
        if beta is None:  # the coefficients of a constant; later on, those of the penalty before
            nought = np.zeros(len(x))
            beta = _wanted(nought, _offset(nought, y, c, 0.0), y, c)
            g = values(x, x, gamma, beta) if held is None else nought
        if held is not None:
            beta, offsets[i] = minimum(held, nought, y, c, 0.0, beta)
        else:
            beta, g = _in_parts(x, y, gamma, c, working, beta, g)
            offsets[i] = _offset(g, y, c, 0.0)
        out[i] = beta
    return out, offsets


def _of_subset(problem: Problem, cells: Sequence[tuple[int, int]], work):
    """What ``work`` gives for (number of the cell, its training rows scaled and their labels, the rows held out
    and theirs), of cells of (symbol, subset). The rows of a cell meet in one task, in the order of their values."""
    of_symbol: dict[int, list[tuple[int, int]]] = {}
    for i, (symbol, subset) in enumerate(cells):
        of_symbol.setdefault(symbol, []).append((i, subset))
    held = problem.rows.sparkSession.sparkContext.broadcast((of_symbol, list(cells), problem.subsets, problem.lo, problem.span))

    def deal(own: Batch) -> Iterator[tuple[int, tuple]]:
        of_symbol, _, subsets, _, _ = held.value
        for i, u in of_symbol.get(own.symbol, ()):
            subset = Subset(*subsets[u])
            train = in_training(subset, own.outer, own.inner)
            rows = train | held_out(subset, own.outer, own.inner)
            if rows.any():
                yield i, (own.x[rows], own.label[rows], train[rows])

    def run(cell: tuple[int, Iterator]) -> tuple:
        x, label, train = (np.concatenate(part) for part in zip(*cell[1]))
        order = np.lexsort([train, label, *x.T])
        x, label, train = x[order], label[order], train[order]
        _, cells, _, lo, span = held.value
        x = (x - lo[cells[cell[0]]]) / span[cells[cell[0]]]
        return cell[0], work(cell[0], x[train], label[train], x[~train], label[~train])

    found = problem.packed.flatMap(deal).groupByKey(max(len(cells), 1), int).map(run).collect()
    held.destroy()
    return found


@dataclass(frozen=True)
class Search:
    """The settings tried on every subset of a problem, and how right they were."""

    problem: Problem
    settings: tuple[Setting, ...]
    scores: Scores
    working: int

    def models(self, wanted: Sequence[tuple[int, int, int]]) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """(support vectors, scaled; their coefficients; offset) of each (symbol, subset, setting)."""
        settings, working = [self.settings[k] for _, _, k in wanted], self.working
        features = len(self.problem.features)

        def fit(i: int, x: np.ndarray, label: np.ndarray, *_: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
            (beta,), (offset,) = machines(x, 2 * label - 1, settings[i].gamma, [settings[i].c], working)
            support = beta != 0
            return x[support], beta[support], float(offset)

        found = dict(_of_subset(self.problem, [(s, u) for s, u, _ in wanted], fit))
        return [found.get(i, (np.zeros((0, features)), np.zeros(0), -1.0)) for i in range(len(wanted))]


def search(problem: Problem, settings: Sequence[Setting], working: int = WORKING) -> Search:
    settings = tuple(settings)
    gammas = {g: [k for k, s in enumerate(settings) if s.gamma == g] for g in dict.fromkeys(s.gamma for s in settings)}
    cells = [(s, u) for s in range(len(problem.symbols)) for u in range(len(problem.subsets))]

    def judge(_: int, x: np.ndarray, label: np.ndarray, test: np.ndarray, truth: np.ndarray) -> tuple[np.ndarray, int]:
        right = np.zeros(len(settings))
        for gamma, own in gammas.items():
            beta, offset = machines(x, 2 * label - 1, gamma, [settings[k].c for k in own], working)
            right[own] = ((values(test, x, gamma, beta) + offset > 0) == (truth[:, None] > 0)).sum(0)
        return right, len(test)

    right, n = np.zeros((len(cells), len(settings))), np.zeros(len(cells))
    for i, (own, size) in _of_subset(problem, cells, judge):
        right[i], n[i] = own, size
    shape = len(problem.symbols), len(problem.subsets)
    return Search(problem, settings, Scores(right.reshape(*shape, len(settings)), n.reshape(shape)), working)
