"""Machines with the kernel itself: every row counts, and the minimum is one by SQL, plain numpy and the optimality conditions."""

import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerpulse.operators.indicators import FEATURES
from tickerpulse.plans import classifiers as C
from tickerpulse.plans import joint, joint_kernel, joint_support
from tickerpulse.plans.joint_support import ROUNDED, Setting

KEYS = ("symbol", "dt")


@pytest.fixture(scope="module")
def rows(spark):
    rng, out = np.random.default_rng(5), []
    for symbol, n in (("A", 170), ("B", 120)):
        for i in range(n):
            x = rng.normal(size=len(FEATURES)) * [1, 5, 100, 0.1, 1, 1]
            out.append((symbol, dt.date(2020, 1, 1) + dt.timedelta(days=i), *map(float, x), int(x[0] * x[3] + 0.02 * rng.normal() > 0)))
    return spark.createDataFrame(out, "symbol string, dt date, " + ", ".join(f"{f} double" for f in FEATURES) + ", Target int").cache()


@pytest.fixture(scope="module")
def nested(rows):
    return joint.prepare(rows, KEYS, True, folds=3)


def _cloud(n, seed=0, noise=0.3):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 3))
    return x, np.where(np.sin(9 * x[:, 0]) + x[:, 1] - 0.5 + noise * rng.normal(size=n) > 0, 1.0, -1.0)


def _disagreement(x, y, gamma, c, beta):
    """By how much rows disagree about the offset; 0 at the minimum."""
    pull = np.exp(-gamma * joint_kernel._distances(x, x)) @ beta + beta * ROUNDED / c - y
    most = np.where(y > 0, c, 0.0)
    assert (beta <= most).all() and (beta >= most - c).all() and abs(beta.sum()) < 1e-9 * c * len(y)
    return pull[beta > most - c].max() - pull[beta < most].min()


@pytest.mark.parametrize("gamma", (100.0, 10.0, 1.0, 0.01))
def test_minimum_of_all_rows(gamma):
    x, y = _cloud(150)
    penalties = (1000.0, 0.001, 1.0, 50.0)
    whole, at = joint_support.machines(x, y, gamma, penalties)
    parts, at_parts = joint_support.machines(x, y, gamma, penalties, working=60)
    kernel = np.exp(-gamma * joint_kernel._distances(x, x))
    for i, c in enumerate(penalties):
        assert _disagreement(x, y, gamma, c, whole[i]) < 1e-3
        assert _disagreement(x, y, gamma, c, parts[i]) < 2e-3

        def objective(beta, b):
            return 0.5 * beta @ kernel @ beta + c * joint_kernel._loss(y * (kernel @ beta + b))[0].sum()

        least = objective(whole[i], at[i])
        assert objective(parts[i], at_parts[i]) == pytest.approx(least, rel=1e-4)
        rng = np.random.default_rng(1)
        for size in (1e-3, 1e-1):
            moved = whole[i] + size * c * rng.normal(size=len(y)) / len(y)
            assert objective(moved, at[i] + size * rng.normal()) > least * (1 - 1e-7)


def test_offset_is_the_middle_of_its_range():
    rng = np.random.default_rng(2)
    for n, c, spread in ((30, 0.1, 1e-4), (31, 0.1, 1e-4), (40, 7.0, 3.0), (2, 1.0, 0.0)):
        g, y = spread * rng.normal(size=n), np.where(np.arange(n) % 2, 1.0, -1.0)
        for total in (0.0, 0.3 * c, -0.55 * c):
            b = joint_support._offset(g, y, c, total)
            assert joint_support._wanted(g, b, y, c).sum() == pytest.approx(total, abs=1e-7 * c)
    assert joint_support._offset(np.zeros(30), np.tile([-1.0, 1.0], 15), 0.1, 0.0) == pytest.approx(0, abs=1e-9)
    assert joint_support._offset(np.full(4, 0.2), np.array([1.0, -1, 1, -1]), 1.0, 0.0) == pytest.approx(-0.2)


def test_odd_rows():
    x, y = _cloud(40)
    twice = joint_support.machines(np.concatenate([x, x]), np.concatenate([y, y]), 1.0, [2.0])
    once = joint_support.machines(x, y, 1.0, [4.0])  # not the same: the loss is rounded off by row
    assert twice[0].shape == (1, 80) and np.isfinite(twice[1]).all() and np.isfinite(once[1]).all()
    opposed = joint_support.machines(np.concatenate([x, x]), np.concatenate([y, -y]), 10.0, [1.0, 1000.0])
    assert np.isfinite(opposed[0]).all()
    for n, sign in ((5, 1.0), (5, -1.0), (0, -1.0)):
        beta, b = joint_support.machines(x[:n], np.full(n, sign), 1.0, [1.0, 10.0])
        assert not beta.any() and b.tolist() == [sign, sign]
    assert joint_support.machines(np.zeros((4, 3)), np.array([1.0, -1, 1, 1]), 1.0, [1.0])[1][0] > 0
    x, y = _cloud(41, noise=0)
    y[:] = np.where(np.arange(41) == 0, -1.0, 1.0)
    assert _disagreement(x, y, 1.0, 5.0, joint_support.machines(x, y, 1.0, [5.0])[0][0]) < 1e-3


def test_every_row_can_support(nested):
    """Before, models were sums of kernels with 64 rows picked by a hash; narrow kernels need all of them."""
    trained = C.train_family(nested, "svm", {"svm": {"C": (1000.0,), "gamma": (100.0,)}})
    models = trained.models([0, 0])
    local = nested.rows.toPandas()
    for s, model in enumerate(models):
        own = local[local.symbol == nested.symbols[s]]
        assert len(model["landmarks"]) == len(own) > 64
        x = (own[[f"x{i}" for i in range(len(FEATURES))]].to_numpy() - model["lo"]) / model["span"]
        value = joint_support.values(x, np.array(model["landmarks"]), 100.0, np.array(model["weights"])) + model["offset"]
        assert ((value > 0) == (own.label.to_numpy() > 0)).all()


def test_scores_of_every_subset(nested):
    settings = [Setting(c, g) for c, g in itertools.product((0.1, 10.0), (0.5, 20.0))]
    whole, parts = (joint_support.search(nested, settings, working) for working in (joint_support.WORKING, 50))
    assert np.array_equal(whole.scores.n, joint.held_out_counts(nested)) and np.array_equal(parts.scores.n, whole.scores.n)
    assert np.abs(whole.scores.right - parts.scores.right).max() <= 1  # of some 40
    local = nested.rows.toPandas()
    for s, u in itertools.product(range(2), range(len(nested.subsets))):
        own = local[local.symbol == nested.symbols[s]]
        outer, inner, label = own.outer.to_numpy(), own.inner.to_numpy(), own.label.to_numpy()
        x = (own[[f"x{i}" for i in range(len(FEATURES))]].to_numpy() - nested.lo[s, u]) / nested.span[s, u]
        a, b = joint.in_training(nested.subsets[u], outer, inner), joint.held_out(nested.subsets[u], outer, inner)
        for k, (c, gamma) in enumerate(settings):
            (beta,), (at,) = joint_support.machines(x[a], 2 * label[a] - 1, gamma, [c])
            value = joint_support.values(x[b], x[a], gamma, beta) + at
            assert abs(whole.scores.right[s, u, k] - ((value > 0) == (label[b] > 0)).sum()) <= (np.abs(value) < 1e-3).sum()


def test_objective_in_sql(spark, rows):
    problem = joint.prepare(rows, KEYS, False, folds=3)
    trained = C.train_family(problem, "svm", {"svm": {"C": (2.0,), "gamma": (5.0,)}})
    for symbol, model in zip(problem.symbols, trained.models([0, 0])):
        rows.where(F.col("symbol") == symbol).withColumn("value", C.decision(model)).createOrReplaceTempView("valued")
        loss = spark.sql(f"""
            SELECT sum(CASE WHEN short <= 0 THEN 0 WHEN short < {ROUNDED} THEN short * short / (2 * {ROUNDED})
                            ELSE short - {ROUNDED} / 2 END) AS loss
            FROM (SELECT 1 - (2 * Target - 1) * value AS short FROM valued)""").first().loss
        marks, w = np.array(model["landmarks"]), np.array(model["weights"])
        own = 0.5 * w @ np.exp(-5.0 * joint_kernel._distances(marks, marks)) @ w
        # the dual value of the coefficients is the same
        frame = rows.where(F.col("symbol") == symbol).toPandas()
        dual = np.abs(w).sum() - own - ROUNDED / 2 / 2.0 * w @ w
        assert len(marks) <= len(frame) and own + 2.0 * loss == pytest.approx(dual, rel=1e-4)
