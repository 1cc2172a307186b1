"""Classifiers trained together, against one fit at a time, plain Python and SQL."""

import datetime as dt
import itertools
import json

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import MinMaxScaler
from pyspark.sql import functions as F

from tickerpulse.operators.indicators import FEATURES
from tickerpulse.plans import classifiers as C
from tickerpulse.plans import joint, joint_kernel, joint_logistic, joint_trees, models

KEYS = ("symbol", "dt")
SMALL = {"lg": {"C": (0.1, 5), "penalty": ("l1", "l2")}, "svm": {"C": (0.1, 10), "gamma": (1, 0.1)},
         "dt": {"features": ("sqrt", "all"), "alpha": (0.02, 0.005), "depth": (2, 6), "criterion": ("gini", "entropy")}}


def _frame(spark, sizes, seed=0):
    rng, out = np.random.default_rng(seed), []
    for symbol, n in sizes.items():
        for i in range(n):
            x = rng.normal(size=len(FEATURES)) * [1, 5, 100, 0.1, 1, 1] + [0, 50, 0, 0, -3, 1]
            label = int(x[0] + 0.01 * x[2] + rng.normal() > 0) if symbol < "M" else int(x[0] * x[3] > 0)
            out.append((symbol, dt.date(2020, 1, 1) + dt.timedelta(days=i), *map(float, x), label, i))
    schema = "symbol string, dt date, " + ", ".join(f"{f} double" for f in FEATURES) + ", Target int, Index int"
    return spark.createDataFrame(out, schema)


@pytest.fixture(scope="module")
def rows(spark):
    return _frame(spark, {"A.X": 150, "Z-Y.CC": 200}).cache()


@pytest.fixture(scope="module")
def nested(rows):
    return joint.prepare(rows, KEYS, True, folds=3)


@pytest.fixture(scope="module")
def local(nested):
    return nested.rows.toPandas()


def _split(local, problem, symbol, subset):
    own = local[local.symbol == problem.symbols[symbol]]
    outer, inner = own.outer.to_numpy(), own.inner.to_numpy()
    x, y = own[[f"x{i}" for i in range(len(FEATURES))]].to_numpy(), own.label.to_numpy()
    u = problem.subsets[subset]
    a, b = joint.in_training(u, outer, inner), joint.held_out(u, outer, inner)
    return x[a], y[a], x[b], y[b]


def test_subsets_and_ranges(nested, local):
    assert len(nested.subsets) == 16 and len(set(nested.subsets)) == 16
    for s, u in itertools.product(range(2), range(16)):
        x, y, test, _ = _split(local, nested, s, u)
        assert np.array_equal(nested.lo[s, u], x.min(0)) and np.array_equal(nested.hi[s, u], x.max(0))
        assert nested.counts[s, u].tolist() == [(y == 0).sum(), (y == 1).sum()]
        outer, inner = nested.subsets[u]
        assert (len(test) == 0) == (outer < 0 and inner < 0)
    n = joint.held_out_counts(nested)
    assert all(n[s, u] == len(_split(local, nested, s, u)[2]) for s, u in itertools.product(range(2), range(16)))


def test_scaling_per_fold(spark):
    frame = spark.createDataFrame([("a", 0, 1.0), ("a", 0, 3.0), ("a", 1, 5.0), ("a", 1, 5.0), ("b", 0, 7.0), ("c", 0, None), ("c", 1, 2.0)],
                                  "symbol string, fold int, x double")
    got = sorted(map(tuple, joint.scaled_per_fold(frame, "symbol", "fold", ["x"]).collect()), key=str)
    assert got == sorted([("a", 0, -2.0, 0), ("a", 0, -4.0, 0),
                          ("a", 0, 0.0, 1), ("a", 0, 1.0, 1), ("a", 1, 2.0, 1), ("a", 1, 2.0, 1), ("a", 1, 0.0, 0), ("a", 1, 0.0, 0),
                          ("c", 0, None, 0), ("c", 0, None, 1), ("c", 1, 0.0, 0), ("c", 1, None, 1)], key=str)


def test_logistic_equals_one_fit_at_a_time(spark, nested, local):
    settings = C.settings_of("lg", SMALL)
    fitted = joint_logistic.fit(nested, settings)
    assert fitted.moving == 0
    for s, u in ((0, 0), (1, 6), (0, 15)):
        x, y, _, _ = _split(local, nested, s, u)
        frame = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], [*FEATURES, "label"])
        frame = models.with_features(frame)
        frame = MinMaxScaler(inputCol="features", outputCol="scaled").fit(frame).transform(frame).cache()
        for k, (c, penalty) in enumerate(settings):
            one = LogisticRegression(featuresCol="scaled", regParam=1 / (c * len(x)), elasticNetParam=float(penalty == "l1"),
                                     maxIter=1000, tol=1e-12, standardization=False).fit(frame)
            want = np.append(one.coefficients.toArray(), one.intercept)
            assert np.abs(fitted.weights[s, u, k] - want).max() < 1e-3


def test_logistic_scores(nested, local):
    settings = C.settings_of("lg", SMALL)
    fitted = joint_logistic.fit(nested, settings)
    scores = joint_logistic.scores(nested, fitted)
    for s, u, k in itertools.product(range(2), range(1, 16), range(4)):
        _, _, x, y = _split(local, nested, s, u)
        w = fitted.weights[s, u, k]
        value = (x - nested.lo[s, u]) / nested.span[s, u] @ w[:-1] + w[-1]
        assert scores.right[s, u, k] == ((value > 0) == (y > 0)).sum()


def test_nested_rows_choose_by_inner_folds_only(nested):
    scores = joint_logistic.scores(nested, joint_logistic.fit(nested, C.settings_of("lg", SMALL)))
    accuracy = scores.right / np.maximum(scores.n[..., None], 1)
    for symbol, fold, setting, got in joint.nested_rows(nested, scores, 3):
        s = nested.symbols.index(symbol)
        inner = [accuracy[s, nested.subsets.index((fold, i))] for i in range(3)]
        assert setting == int(np.argmax(np.mean(inner, axis=0)))
        assert got == accuracy[s, nested.subsets.index((fold, -1)), setting]


# --- trees

def _weakest_links(own, entropy, alpha, depth, root):
    """The pruned tree as a set of leaves, link by link."""
    share = own.classes.sum(1) / own.classes[own.tree].sum(1)
    cost = share * joint_trees.impurity(own.classes, entropy[own.tree])
    left = {n: (own.left[n], own.left[n] + 1) for n in range(len(cost)) if own.left[n] >= 0 and own.depth[n] < depth}

    def under(n):
        return [n] if n not in left else under(left[n][0]) + under(left[n][1])

    while True:
        inner = [n for n in left if own.tree[n] == root and n in reach(root, left)]
        if not inner:
            break
        gain = {n: (cost[n] - cost[under(n)].sum()) / (len(under(n)) - 1) for n in inner}
        weakest = min(gain, key=gain.get)
        if gain[weakest] > alpha + 1e-12:
            break
        del left[weakest]
    return set(under(root))


def reach(root, left):
    out, todo = set(), [root]
    while todo:
        n = todo.pop()
        out.add(n)
        todo += left.get(n, ())
    return out


@pytest.fixture(scope="module")
def forest(nested):
    return joint_trees.grow(nested, [joint_trees.Setting(*s) for s in C.settings_of("dt", SMALL)], bins=16)


def test_pruning_equals_weakest_links(nested, forest):
    entropy = np.tile([c == "entropy" for c, _ in forest.variants], len(nested.subsets))
    for own in forest.nodes:
        for alpha, depth in ((0.02, 2), (0.005, 6), (0.05, 6)):
            got = joint_trees.leaves(own, entropy, alpha, depth)
            for root in (0, 3, 9, 20):
                assert set(np.flatnonzero(got & (own.tree == root))) == _weakest_links(own, entropy, alpha, depth, root)


def test_splits_are_the_best_of_the_features_looked_at(nested, forest, local):
    """Every root and its children, against all cuts tried one by one."""
    for s, own in enumerate(forest.nodes):
        for tree in range(0, len(nested.subsets) * len(forest.variants), 5):
            u, (criterion, looked) = tree // len(forest.variants), forest.variants[tree % len(forest.variants)]
            x, y, _, _ = _split(local, nested, s, u)
            bins = joint_trees._binned(x, forest.edges[s])
            assert own.classes[tree].tolist() == [(y == 0).sum(), (y == 1).sum()]

            def weighted(label):
                classes = np.array([(label == 0).sum(), (label == 1).sum()])
                return classes.sum() * joint_trees.impurity(classes, np.array(criterion == "entropy"))

            drawn = joint_trees._drawn(own.path[[tree]], len(FEATURES))[0, :looked]
            best = max(weighted(y) - weighted(y[bins[:, f] <= b]) - weighted(y[bins[:, f] > b])
                       for f in drawn for b in range(15) if 0 < (bins[:, f] <= b).sum() < len(y))
            goes_left = bins[:, own.feature[tree]] <= own.cut[tree]
            assert weighted(y) - weighted(y[goes_left]) - weighted(y[~goes_left]) == pytest.approx(best, abs=1e-6)
            assert own.feature[tree] in drawn and own.classes[own.left[tree]].sum() == goes_left.sum()


def test_tree_predictions_follow_from_the_nodes_in_sql(spark, rows, nested, forest):
    setting = forest.settings[-1]
    nodes = joint_trees.node_table(nested, forest, 0, 0, setting)
    table = spark.createDataFrame([tuple(n[k] for k in ("node", "feature", "threshold", "left", "right", "prediction")) for n in nodes],
                                  "node int, feature int, threshold double, l int, r int, prediction int")
    table.createOrReplaceTempView("tree_nodes")
    model = {"family": "dt", "setting": setting._asdict(), "nodes": nodes}
    rows.withColumn("p", C.prediction(model)).withColumn("x", F.array(*FEATURES)).createOrReplaceTempView("tree_rows")
    wrong = spark.sql("""
        WITH RECURSIVE walk (symbol, dt, x, p, node) AS (
          SELECT symbol, dt, x, p, 0 FROM tree_rows
          UNION ALL
          SELECT w.symbol, w.dt, w.x, w.p, CASE WHEN w.x[t.feature] <= t.threshold THEN t.l ELSE t.r END
          FROM walk w JOIN tree_nodes t ON t.node = w.node WHERE t.feature IS NOT NULL)
        SELECT count(*) AS n, count_if(t.prediction <> w.p) AS wrong FROM walk w JOIN tree_nodes t ON t.node = w.node WHERE t.feature IS NULL
    """).first()
    assert wrong.n == rows.count() and wrong.wrong == 0
    assert all(n["feature"] is None or n["rows"] == nodes[n["left"]]["rows"] + nodes[n["right"]]["rows"] for n in nodes)


def test_tree_scores(nested, forest, local):
    scores = joint_trees.scores(nested, forest)
    for s, u, k in ((0, 1, 0), (1, 4, 7), (0, 9, 15), (1, 15, 12)):
        _, _, x, y = _split(local, nested, s, u)
        nodes = joint_trees.node_table(nested, forest, s, u, forest.settings[k])

        def predicted(row):
            at = nodes[0]
            while at["feature"] is not None:
                at = nodes[at["left"] if row[at["feature"]] <= at["threshold"] else at["right"]]
            return at["prediction"]

        assert scores.right[s, u, k] == sum(predicted(r) == t for r, t in zip(x, y))


# --- kernel machines

def test_kernel_objective_in_sql(spark, rows):
    problem = joint.prepare(rows, KEYS, False, folds=3)
    settings = [joint_kernel.Setting(1.0, 1.0), joint_kernel.Setting(10.0, 0.1)]
    machine = joint_kernel.fit(problem, settings, landmarks=32, tolerance=1e-6, passes=200)
    trained = C.Trained(problem, "svm", [tuple(s) for s in settings], machine, None)
    for s, k in itertools.product(range(2), range(2)):
        model = trained.model(s, 0, k)
        rows.where(F.col("symbol") == problem.symbols[s]).withColumn("value", C.decision(model)).createOrReplaceTempView("valued")
        loss = spark.sql(f"""
            SELECT sum(CASE WHEN short <= 0 THEN 0 WHEN short < {joint_kernel.ROUNDED} THEN short * short / (2 * {joint_kernel.ROUNDED})
                            ELSE short - {joint_kernel.ROUNDED} / 2 END) AS loss
            FROM (SELECT 1 - (2 * Target - 1) * value AS short FROM valued)""").first().loss
        whole = settings[k].c * loss + 0.5 * joint_kernel.norm(machine, problem, s, 0, k)
        assert whole == pytest.approx(machine.objective[s, 0, k], rel=1e-6)
        # no other point near it is lower
        rng = np.random.default_rng(k)
        frame = rows.where(F.col("symbol") == problem.symbols[s]).toPandas()
        x = (frame[list(FEATURES)].to_numpy() - problem.lo[s, 0]) / problem.span[s, 0]
        marks = (machine.landmarks[s] - problem.lo[s, 0]) / problem.span[s, 0]
        kernel = np.exp(-settings[k].gamma * joint_kernel._distances(x, marks))
        own = np.exp(-settings[k].gamma * joint_kernel._distances(marks, marks))
        sign = 2 * frame["Target"].to_numpy() - 1

        def objective(w, b):
            return settings[k].c * joint_kernel._loss(sign * (kernel @ w + b))[0].sum() + 0.5 * w @ own @ w

        w, b = machine.weights[s, 0, k], machine.offset[s, 0, k]
        assert objective(w, b) == pytest.approx(whole, rel=1e-6)
        for _ in range(30):
            move = rng.normal(size=len(w)) * np.abs(w).max() * 0.01
            assert objective(w + move, b + rng.normal() * 0.01) > whole * (1 - 1e-4)


def test_kernel_errors_are_those_of_the_approximation(rows):
    problem = joint.prepare(rows, KEYS, False, folds=3)
    wide, narrow = (joint_kernel.kernel_errors(problem, n, (10.0, 0.1), 50) for n in (16, 100))
    assert narrow[0.1] < wide[0.1] < 0.1 and narrow[0.1] < 1e-3 < narrow[10.0] <= 1
    marks = joint_kernel._sample(problem, 10)
    scaled = (marks[0] - problem.lo[0, 0]) / problem.span[0, 0]
    exact = np.exp(-2.0 * joint_kernel._distances(scaled, scaled))
    z = exact @ joint_kernel._spread(scaled, 2.0)
    assert np.abs(z @ z.T - exact).max() < 1e-6


# --- all of them

def test_train_save_load_predict(spark, rows, tmp_path):
    fitted = C.train_all(rows, KEYS, grids=SMALL, folds=3)
    assert set(fitted) == set(itertools.product(("A.X", "Z-Y.CC"), C.FAMILIES))
    C.save_models(spark, fitted, str(tmp_path / "m"))
    loaded = C.load_models(spark, str(tmp_path / "m"))
    assert {k: json.loads(json.dumps(m)) for k, m in fitted.items()} == loaded
    assert list(C.load_models(spark, str(tmp_path / "m"), ["lg-A.X-estimator"])) == [("A.X", "lg")]
    long = C.predict_long(rows, loaded)
    assert long.count() == rows.count() * 6
    accuracy = {(r.model_symbol, r.family): r.accuracy for r in models.accuracy(long.where("symbol = model_symbol")).collect()}
    assert accuracy["A.X", "lg"] > 0.7 and accuracy["A.X", "svm"] > 0.7 and accuracy["Z-Y.CC", "dt"] > 0.65
    assert "Exchange" not in long._jdf.queryExecution().executedPlan().toString()
    (one,) = models.rows_at(C.predict_nested(rows, loaded, {"A.X": "tesla", "Z-Y.CC": "bitcoin"}), 3).where("symbol = 'A.X'").first().stock_predictions
    assert list(one.tesla.asDict()) == ["logistic regression", "support vector machine", "decission tree"]
    empty = rows.limit(1).withColumn(FEATURES[2], F.lit(None).cast("double"))
    assert [r.prediction for r in C.predict_long(empty, loaded).collect()] == [None] * 6


def test_tables_and_groups_of_symbols(rows, monkeypatch):
    """Symbols taken one at a time give what they give together; nested rows have every fold."""
    grids = {"lg": SMALL["lg"], "dt": SMALL["dt"]}
    together = C.grid_table(rows, KEYS, ("lg", "dt"), grids=grids, folds=3)
    assert len(together) == 2 * (4 + 16)
    monkeypatch.setattr(joint.in_groups, "__defaults__", (1,))
    apart = C.grid_table(rows, KEYS, ("lg", "dt"), grids=grids, folds=3)
    assert sorted(together) == sorted(apart)
    nested = C.nested_table(rows, KEYS, ("lg",), grids=grids, folds=3)
    assert [(s, f, k) for s, f, k, _, _ in nested] == [(s, "lg", k) for s in ("A.X", "Z-Y.CC") for k in range(3)]


def test_tasks_follow_the_rows_and_hold_few_symbols(rows, monkeypatch):
    def held(problem):
        return problem.rows.select("symbol", F.spark_partition_id().alias("task")).groupBy("symbol", "task").count().collect()

    assert len({r.task for r in held(joint.prepare(rows, KEYS, False))}) == 1
    monkeypatch.setattr(joint, "ROWS_OF_TASK", 50)
    cells = held(joint.prepare(rows, KEYS, False))
    assert 3 <= len({r.task for r in cells}) <= 7 and len(cells) <= 8  # one task at most holds both symbols
    assert sum(r["count"] for r in cells) == 350


def test_passes_add_up_arrays_without_a_query(rows, monkeypatch):
    monkeypatch.setattr(joint, "ROWS_OF_TASK", 16)  # many tasks
    problem = joint.prepare(rows, KEYS, False, folds=3)

    def work(own, state):
        for u in state:
            inside = joint.in_training(u, own.outer, own.inner)
            if inside.any():
                yield np.array([[u.inner, 0], [u.inner, 1]]), np.stack([own.x[inside].sum(0), np.abs(own.x[inside]).sum(0)])

    def sums(found):
        return {tuple(k.tolist()): v for k, v in zip(*found)}

    one, other = (sums(f) for f in (joint.added(problem, work, problem.subsets),
                                    joint.summed(problem, work, problem.subsets, ["inner", "kind"], len(FEATURES))))
    assert len(one) == 2 * 4 * 2 and one.keys() == other.keys()
    assert all(np.allclose(one[k], other[k], rtol=1e-12) for k in one)
    assert problem.packed.getNumPartitions() > 1

    def planned(*_):
        raise AssertionError("a pass was planned as a query")

    for module in (joint, joint_logistic, joint_kernel):
        monkeypatch.setattr(module, "summed", planned, raising=False)
    for family in ("lg", "svm"):
        assert C.train_family(problem, family, SMALL).scores.n.sum() > 0


def test_odd_rows(spark, rows):
    """Null features and labels are left out; one class, one value or one row still give a model."""
    odd = _frame(spark, {"B": 12, "C": 40}, 3).withColumn("Target", F.when(F.col("symbol") == "B", 1).otherwise(F.col("Target")))
    odd = odd.withColumn(FEATURES[1], F.lit(2.0)).unionByName(rows.limit(2).withColumn("symbol", F.lit("D")))
    odd = odd.unionByName(odd.limit(5).withColumn(FEATURES[0], F.lit(None).cast("double"))).unionByName(
        odd.limit(5).withColumn("Target", F.lit(None).cast("int")))
    fitted = C.train_all(odd, KEYS, grids=SMALL, folds=3)
    got = C.predict_long(odd.where("symbol = 'B'").limit(3), {k: m for k, m in fitted.items() if k[0] == "B"})
    assert len(fitted) == 9 and {r.prediction for r in got.collect()} == {1}
    assert C.train_all(rows.limit(0), KEYS, grids=SMALL) == {}


def test_full_grids():
    assert {f: len(C.settings_of(f)) for f in C.FAMILIES} == {"lg": 18, "svm": 48, "dt": 96}
