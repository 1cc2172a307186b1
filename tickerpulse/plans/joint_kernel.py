"""Support vector machines with an approximated RBF kernel, all symbols, subsets and settings together. No entry
uses them: ``joint_support`` learns from every row.

The kernel is approximated from landmarks (Nystroem): rows of the symbol, chosen by a hash, to
which every row is compared; on the landmarks themselves it is exact. ``kernel_errors`` states how far it is off on
other rows, by width. A model minimises half its squared coefficients + C * (sum of the losses of
its rows); the loss is the hinge, rounded off over ``ROUNDED`` at its corner so that it has a slope
everywhere. Each pass adds up loss and slope of every model. Directions come from a quasi-Newton method
(L-BFGS), vectorised over the models, that starts from the second moments of the features; one pass adds these up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from .joint import Batch, Problem, Scores, Subset, added, held_out, held_out_counts, in_training

LANDMARKS = 64
ROUNDED = 0.25
PASSES = 60
TOLERANCE = 3e-3  # share of a model's values by which a last step may change them
MEMORY = 8
FLOOR = 1e-10  # of the eigenvalues among the landmarks, relative to the largest


class Setting(NamedTuple):
    c: float
    gamma: float


@dataclass(frozen=True)
class Machine:
    """``weights`` [symbol, subset, setting, landmark]: a row's value is the sum of weight * kernel(row,
    landmark), plus ``offset``. ``landmarks`` [symbol, landmark, feature] are not scaled yet."""

    settings: tuple[Setting, ...]
    landmarks: np.ndarray
    weights: np.ndarray
    offset: np.ndarray
    objective: np.ndarray
    passes: int
    moving: int


def _sample(problem: Problem, n: int, skip: int = 0) -> np.ndarray:
    """[symbol, n, feature]: rows in the order of a hash, after the first ``skip``. Symbols with fewer
    rows repeat their first one."""
    names = [f"x{i}" for i in range(len(problem.features))]
    rows = problem.rows.select("symbol", *names).distinct().withColumn("h", F.xxhash64(*names))
    for by in (["symbol", F.pmod("h", F.lit(64))], ["symbol"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("h", *names))
        rows = rows.withColumn("place", place).where(F.col("place") <= n + skip)
    out = np.zeros((len(problem.symbols), n, len(names)))
    found: dict[str, list] = {}
    for r in rows.orderBy("symbol", "place").collect():
        found.setdefault(r.symbol, []).append([r[c] for c in names])
    for s, symbol in enumerate(problem.symbols):
        own = found.get(symbol, [])[skip:]
        if own:
            out[s] = own[0]
            out[s, :len(own)] = own
    return out


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T, 0)


def _spread(landmarks: np.ndarray, gamma: float) -> np.ndarray:
    """[landmark, feature]: turns kernels with the landmarks into features whose products are the kernel."""
    values, vectors = np.linalg.eigh(np.exp(-gamma * _distances(landmarks, landmarks)))
    able = values > FLOOR * values[-1]
    return vectors * np.where(able, 1 / np.sqrt(np.where(able, values, 1)), 0)


def _loss(margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rounded hinge and its slope."""
    short = 1 - margin
    inside = np.clip(short, 0, ROUNDED)
    return np.where(short < ROUNDED, inside * inside / (2 * ROUNDED), short - ROUNDED / 2), -inside / ROUNDED


def _turned(points: np.ndarray, turn: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Each point through the matrix of its group, of which no copy is made for every point."""
    out, order = np.empty_like(points), np.argsort(group, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        if len(some):
            out[some] = points[some] @ turn[group[some[0]]].T
    return out


def _kernels(own: Batch, subset: Subset, lo: np.ndarray, span: np.ndarray, landmarks: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return _distances((own.x[rows] - lo) / span, (landmarks - lo) / span)


def _moments(own: Batch, state: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the second moments of (kernels, 1), per subset and width."""
    subsets, lo, span, landmarks, gammas = state
    s = own.symbol
    n = landmarks.shape[1] + 1
    for u, subset in enumerate(subsets):
        rows = in_training(Subset(*subset), own.outer, own.inner)
        if not rows.any():
            continue
        d = _kernels(own, subset, lo[s, u], span[s, u], landmarks[s], rows)
        for g, gamma in enumerate(gammas):
            k = np.column_stack([np.exp(-gamma * d), np.ones(len(d))])
            yield np.column_stack([np.full(n, u * len(gammas) + g), np.arange(n)]), k.T @ k


def _slopes(own: Batch, state: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per model: loss, and its slope along the weights and the offset."""
    subsets, lo, span, landmarks, gammas, of_width, weights, active = state
    s, settings = own.symbol, weights.shape[2]
    y = 2 * own.label - 1
    for u, subset in enumerate(subsets):
        rows = in_training(Subset(*subset), own.outer, own.inner)
        if not rows.any() or not active[s, u].any():
            continue
        d = _kernels(own, subset, lo[s, u], span[s, u], landmarks[s], rows)
        for g, gamma in enumerate(gammas):
            models = np.flatnonzero(active[s, u] & (of_width == g))
            if not len(models):
                continue
            k = np.column_stack([np.exp(-gamma * d), np.ones(len(d))])
            loss, slope = _loss(y[rows, None] * (k @ weights[s, u, models].T))
            yield (u * settings + models)[:, None], np.column_stack([loss.sum(0), (k.T @ (slope * y[rows, None])).T])


def fit(problem: Problem, settings: Sequence[Setting], landmarks: int = LANDMARKS, passes: int = PASSES,
        tolerance: float = TOLERANCE) -> Machine:
    shape = (len(problem.symbols), len(problem.subsets), len(settings))
    gammas = tuple(dict.fromkeys(s.gamma for s in settings))
    of_width = np.array([gammas.index(s.gamma) for s in settings])
    marks = _sample(problem, landmarks)
    n = landmarks + 1
    common = (tuple(problem.subsets), problem.lo, problem.span, marks, gammas)
    keys, rows = added(problem, _moments, common)
    moments = np.zeros((shape[0], shape[1] * len(gammas), n, n))
    moments[tuple(keys.T)] = rows
    # coordinates in which the second moments are a diagonal: weights = turn @ coordinates
    turn, bend = np.zeros_like(moments), np.zeros(moments.shape[:3])
    for s in range(shape[0]):
        for u in range(shape[1]):
            scaled = (marks[s] - problem.lo[s, u]) / problem.span[s, u]
            for g, gamma in enumerate(gammas):
                base = np.zeros((n, n))
                base[:-1, :-1], base[-1, -1] = _spread(scaled, gamma), 1
                values, vectors = np.linalg.eigh(base.T @ moments[s, u * len(gammas) + g] @ base)
                turn[s, u * len(gammas) + g], bend[s, u * len(gammas) + g] = base @ vectors, np.maximum(values, 0)
    models = int(np.prod(shape))
    c = np.tile([x.c for x in settings], models // len(settings))
    group = (np.arange(models // len(settings))[:, None] * len(gammas) + of_width).ravel()
    turn, bend = turn.reshape(-1, n, n), bend.reshape(-1, n)
    # the offset is free: its direction carries no penalty
    free = turn[:, -1, :]
    start = 1 / (1 + c[:, None] * bend[group] / ROUNDED / 4)

    def penalised(at: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Half the squares of the coordinates without the part that is the offset, and its slope."""
        offset = np.einsum("mi,mi->m", free[group[at]], p)
        rest = p - offset[:, None] * free[group[at]]
        return 0.5 * np.einsum("mi,mi->m", rest, rest), rest

    kept, tried, step = np.zeros((models, n)), np.zeros((models, n)), np.zeros((models, n))
    best, slope_at = np.full(models, np.inf), np.zeros((models, n))
    length, down = np.ones(models), np.zeros(models)
    moves, turns = np.zeros((MEMORY, models, n)), np.zeros((MEMORY, models, n))
    weight = np.zeros((MEMORY, models))  # 0: nothing remembered there
    seen = problem.counts.reshape(-1, 2).repeat(len(settings), 0)
    lone = (seen == 0).any(1)
    kept[lone] = free[group[lone]] * np.where(seen[lone, 1:] > 0, 1.0, -1.0)
    active, done = ~lone, 0
    while active.any() and done < passes:
        done += 1
        weights = np.zeros((models, n))
        weights[active] = _turned(tried[active], turn, group[active])
        state = (*common, of_width, weights.reshape(*shape, n), active.reshape(shape))
        keys, sums = added(problem, _slopes, state)
        at = keys[:, 0] * (models // shape[0]) + keys[:, 1]
        penalty, rest = penalised(at, tried[at])
        objective = penalty + c[at] * sums[:, 0]
        slope = rest + c[at, None] * _turned(sums[:, 1:], turn.transpose(0, 2, 1), group[at])
        lower = objective <= best[at] + 1e-4 * length[at] * down[at]
        lower |= ~np.isfinite(best[at])
        back = at[~lower]
        length[back] /= 2
        tried[back] = kept[back] + length[back, None] * step[back]
        good, i = at[lower], np.flatnonzero(lower)
        move, change = tried[good] - kept[good], slope[i] - slope_at[good]
        curve = np.einsum("mi,mi->m", move, change)
        # in the measure of the values that the models give to their rows
        small = np.einsum("mi,mi,mi->m", move, move, 1 / start[good]) <= tolerance**2 * np.einsum(
            "mi,mi,mi->m", tried[good], tried[good], 1 / start[good])
        small &= np.isfinite(best[good])
        place = done % MEMORY
        moves[place, good], turns[place, good] = move, change
        weight[place, good] = np.where((curve > 1e-12) & np.isfinite(best[good]), 1 / np.maximum(curve, 1e-12), 0)
        weight[place, back] = 0
        kept[good], best[good], slope_at[good], length[good] = tried[good], objective[i], slope[i], 1.0
        # two loops over what is remembered, newest first
        q, shares = slope[i].copy(), {}
        for j in range(MEMORY):
            k = (place - j) % MEMORY
            shares[k] = weight[k, good] * np.einsum("mi,mi->m", moves[k, good], q)
            q -= shares[k][:, None] * turns[k, good]
        q *= start[good]
        for j in range(MEMORY - 1, -1, -1):
            k = (place - j) % MEMORY
            again = weight[k, good] * np.einsum("mi,mi->m", turns[k, good], q)
            q += (shares[k] - again)[:, None] * moves[k, good]
        step[good] = -q
        down[good] = np.einsum("mi,mi->m", slope[i], -q)
        tried[good] = kept[good] + step[good]
        active[good[small]] = False
        active[back] &= length[back] > 1e-6
    final = _turned(kept, turn, group).reshape(*shape, n)
    return Machine(tuple(settings), marks, final[..., :-1], final[..., -1], best.reshape(shape), done, int(active.sum()))


def _right(own: Batch, state: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    subsets, lo, span, landmarks, gammas, of_width, weights = state
    s, settings = own.symbol, weights.shape[2]
    for u, subset in enumerate(subsets):
        rows = held_out(Subset(*subset), own.outer, own.inner)
        if not rows.any():
            continue
        d = _kernels(own, subset, lo[s, u], span[s, u], landmarks[s], rows)
        for g, gamma in enumerate(gammas):
            models = np.flatnonzero(of_width == g)
            value = np.column_stack([np.exp(-gamma * d), np.ones(len(d))]) @ weights[s, u, models].T
            yield (u * settings + models)[:, None], ((value > 0) == (own.label[rows, None] > 0)).sum(0)[:, None]


def scores(problem: Problem, machine: Machine) -> Scores:
    gammas = tuple(dict.fromkeys(s.gamma for s in machine.settings))
    of_width = np.array([gammas.index(s.gamma) for s in machine.settings])
    state = (tuple(problem.subsets), problem.lo, problem.span, machine.landmarks, gammas, of_width,
             np.concatenate([machine.weights, machine.offset[..., None]], -1))
    keys, values = added(problem, _right, state)
    right = np.zeros((len(problem.symbols), len(problem.subsets) * len(machine.settings)))
    right[tuple(keys.T)] = values[:, 0]
    return Scores(right.reshape(machine.weights.shape[:3]), held_out_counts(problem))


def kernel_errors(problem: Problem, landmarks: int = LANDMARKS, gammas: Sequence[float] = (), sample: int = 256) -> dict[float, float]:
    """The largest difference between the approximated and the exact kernel, by width, over all pairs
    of ``sample`` further rows of each symbol."""
    marks, others = _sample(problem, landmarks), _sample(problem, sample, landmarks)
    out = dict.fromkeys(gammas, 0.0)
    for s in range(len(problem.symbols)):
        m, x = ((v[s] - problem.lo[s, 0]) / problem.span[s, 0] for v in (marks, others))
        for gamma in gammas:
            z = np.exp(-gamma * _distances(x, m)) @ _spread(m, gamma)
            out[gamma] = max(out[gamma], float(np.abs(z @ z.T - np.exp(-gamma * _distances(x, x))).max()))
    return out


def norm(machine: Machine, problem: Problem, symbol: int, subset: int, setting: int) -> float:
    """The squared coefficients of one model in the feature space."""
    scaled = (machine.landmarks[symbol] - problem.lo[symbol, subset]) / problem.span[symbol, subset]
    w = machine.weights[symbol, subset, setting]
    return float(w @ np.exp(-machine.settings[setting].gamma * _distances(scaled, scaled)) @ w)
