"""Logistic regressions of all symbols, subsets and settings by Newton steps.

A model minimises C * (sum of the logistic losses of its rows) + its penalty: half the squared
coefficients (l2) or their absolute values (l1); the intercept is free. The features of a model are scaled by the
ranges of its own rows. One pass adds up loss, gradient and second derivatives, a few dozen sums a
model. The l2 step solves the linear system; the l1 step minimises the same quadratic form with the
absolute values by coordinate descent. A step that does not lower the objective is halved.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

from .joint import Batch, Problem, Scores, Subset, added, held_out, held_out_counts, in_training, pairs, symmetric

PASSES = 100
TOLERANCE = 1e-7  # of the coefficients of scaled features
SWEEPS = 1000


@dataclass(frozen=True)
class Logistic:
    """Coefficients [symbol, subset, setting, feature + 1], the intercept last, of scaled features."""

    settings: tuple[tuple[float, str], ...]  # (C, penalty)
    weights: np.ndarray
    passes: int
    moving: int  # models that had not come to rest


def _design(x: np.ndarray, lo: np.ndarray, span: np.ndarray) -> np.ndarray:
    return np.column_stack([(x - lo) / span, np.ones(len(x))])


def _losses(own: Batch, state: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per model: loss, gradient and the upper triangle of second derivatives."""
    subsets, lo, span, weights, active = state
    s, settings = own.symbol, weights.shape[2]
    for u, subset in enumerate(subsets):
        models = np.flatnonzero(active[s, u])
        rows = in_training(Subset(*subset), own.outer, own.inner)
        if not len(models) or not rows.any():
            continue
        z, y = _design(own.x[rows], lo[s, u], span[s, u]), own.label[rows]
        margin = z @ weights[s, u, models].T
        p = 0.5 * (1 + np.tanh(0.5 * margin))
        loss = np.logaddexp(0.0, margin).sum(0) - y @ margin
        a, b = pairs(z.shape[1])
        second = (z[:, a] * z[:, b]).T @ (p * (1 - p))
        yield (u * settings + models)[:, None], np.column_stack([loss, (z.T @ (p - y[:, None])).T, second.T])


def _l1_steps(weights: np.ndarray, gradient: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The steps that minimise gradient . d + d . second . d / 2 + |coefficients + d|, intercept free."""
    n = weights.shape[1]
    step = np.zeros_like(weights)
    slope = gradient.copy()  # of the quadratic part at the step so far
    bend = np.maximum(np.einsum("mii->mi", second), 1e-12)
    for _ in range(SWEEPS):
        most = 0.0
        for j in range(n):
            now = weights[:, j] + step[:, j]
            free = now - slope[:, j] / bend[:, j]
            goal = free if j == n - 1 else np.sign(free) * np.maximum(np.abs(free) - 1 / bend[:, j], 0)
            move = goal - now
            step[:, j] += move
            slope += second[:, :, j] * move[:, None]
            most = max(most, float(np.abs(move).max(initial=0.0)))
        if most < TOLERANCE / 100:
            break
    return step


def fit(problem: Problem, settings: Sequence[tuple[float, str]], passes: int = PASSES, tolerance: float = TOLERANCE) -> Logistic:
    shape = (len(problem.symbols), len(problem.subsets), len(settings))
    n = len(problem.features) + 1
    models = int(np.prod(shape))
    c = np.tile([x for x, _ in settings], models // len(settings))
    l1 = np.tile([p == "l1" for _, p in settings], models // len(settings))
    kept, step = np.zeros((models, n)), np.zeros((models, n))  # the last point that lowered the objective, the step from it
    tried, length, best = kept.copy(), np.ones(models), np.full(models, np.inf)
    # without both classes there is nothing to separate: such models keep their majority by the intercept
    seen = problem.counts.reshape(-1, 2).repeat(len(settings), 0)
    lone = (seen == 0).any(1)
    tried[lone, -1] = kept[lone, -1] = np.where(seen[lone, 1] > 0, 1.0, -1.0)
    active, done = ~lone, 0
    while active.any() and done < passes:
        done += 1
        state = (tuple(problem.subsets), problem.lo, problem.span, tried.reshape(*shape, n), active.reshape(shape))
        keys, sums = added(problem, _losses, state)
        at = keys[:, 0] * (models // shape[0]) + keys[:, 1]
        w, cost = tried[at], c[at]
        penalty = np.where(l1[at], np.abs(w[:, :-1]).sum(1), 0.5 * (w[:, :-1] ** 2).sum(1))
        objective = cost * sums[:, 0] + penalty
        lower = objective <= best[at] + 1e-12 * np.abs(best[at], where=np.isfinite(best[at]), out=np.zeros(len(at)))
        back = at[~lower]
        length[back] /= 2
        tried[back] = kept[back] + length[back, None] * step[back]
        good, i = at[lower], np.flatnonzero(lower)
        kept[good], best[good], length[good] = w[i], objective[i], 1.0
        gradient, second = cost[i, None] * sums[i, 1:n + 1], cost[i, None, None] * symmetric(sums[i, n + 1:], n)
        is_l1 = l1[good]
        step[good[is_l1]] = _l1_steps(kept[good[is_l1]], gradient[is_l1], second[is_l1])
        ridge = np.eye(n)
        ridge[-1, -1] = 1e-12
        slope = gradient[~is_l1].copy()
        slope[:, :-1] += kept[good[~is_l1], :-1]
        step[good[~is_l1]] = -np.linalg.solve(second[~is_l1] + ridge, slope[..., None])[..., 0]
        tried[good] = kept[good] + step[good]
        active[at] = np.abs(tried[at] - kept[at]).max(1) > tolerance
        active[back] &= length[back] > 1e-9
    return Logistic(tuple(settings), kept.reshape(*shape, n), done, int(active.sum()))


def _right(own: Batch, state: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    subsets, lo, span, weights = state
    s, settings = own.symbol, weights.shape[2]
    for u, subset in enumerate(subsets):
        rows = held_out(Subset(*subset), own.outer, own.inner)
        margin = _design(own.x[rows], lo[s, u], span[s, u]) @ weights[s, u].T
        yield (u * settings + np.arange(settings))[:, None], ((margin > 0) == (own.label[rows, None] > 0)).sum(0)[:, None]


def scores(problem: Problem, fitted: Logistic) -> Scores:
    """Right predictions on the held-out rows, all models in one pass."""
    state = (tuple(problem.subsets), problem.lo, problem.span, fitted.weights)
    keys, values = added(problem, _right, state)
    right = np.zeros((len(problem.symbols), len(problem.subsets) * len(fitted.settings)))
    right[tuple(keys.T)] = values[:, 0]
    return Scores(right.reshape(fitted.weights.shape[:3]), held_out_counts(problem))
