import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerpulse.operators.indicators import FEATURES
from tickerpulse.plans import models as M

GRID = {"lg": {"C": (1,), "penalty": ("l2",)}, "svm": {"C": (10,), "gamma": (1,)},
        "dt": {"features": ("all",), "gain": (0.001,), "depth": (5,), "criterion": ("gini",)}}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    out = []
    for symbol, sign in (("A.X", 1), ("B-Y.CC", -1)):
        for i in range(120):
            x = rng.normal(size=len(FEATURES))
            out.append((symbol, dt.date(2020, 1, 1) + dt.timedelta(days=i), *map(float, x), int(sign * x[0] > 0), i))
    schema = "symbol string, dt date, " + ", ".join(f"{f} double" for f in FEATURES) + ", Target int, Index int"
    return spark.createDataFrame(out, schema).cache()


def test_train_save_load_predict(spark, rows, tmp_path):
    fitted = M.train_all(rows, ("A.X", "B-Y.CC"), ("symbol", "dt"), M.FAMILIES, GRID, folds=2)
    M.save_models(fitted, str(tmp_path))
    loaded = M.load_models(str(tmp_path), fitted)
    long = M.predict_long(rows, loaded).cache()
    assert long.count() == rows.count() * 6
    assert long.exceptAll(M.predict_long(rows, fitted)).count() == 0
    own = M.accuracy(long.where(F.col("symbol") == F.col("model_symbol"))).collect()
    assert all(r.accuracy > 0.85 for r in own) and len(own) == 6
    crossed = M.accuracy(long.where(F.col("symbol") != F.col("model_symbol"))).collect()
    assert all(r.accuracy < 0.3 for r in crossed)
    wide = M.rows_at(M.predict_wide(rows, loaded), 3).collect()
    nested = M.predict_nested(rows, loaded, {"A.X": "tesla", "B-Y.CC": "bitcoin"})
    (one,) = M.rows_at(nested, 3).where("symbol = 'A.X'").first().stock_predictions
    assert set(one.asDict()) == {"tesla", "bitcoin"}
    assert list(one.tesla.asDict()) == ["logistic regression", "support vector machine", "decission tree"]
    assert len(wide) == 2 and len(wide[0]) == len(rows.columns) + 6


def test_all_models_predict_in_one_scan(spark, rows):
    fitted = M.train_all(rows, ("A.X",), ("symbol", "dt"), ("lg", "dt"), GRID, folds=2)
    plan = M.predict_long(rows, fitted)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryTableScan") == 1 and "Exchange" not in plan


def test_nested_accuracy_and_grid(rows):
    one = M.symbol_rows(rows, "A.X", ["symbol", "dt"], folds=3).cache()
    space = M.search_space("A.X", "lg", one.count(), M.SMALL_GRIDS)
    scores = M.grid_scores(one, M.prediction_column("A.X", "lg"), space, folds=3)
    # a heavy penalty leaves little more than the majority class
    assert len(scores) == len(space.grid) and scores[0] < 0.7 < 0.9 < scores[1] <= 1
    assert all(s > 0.8 for s in M.nested_accuracy(one, "A.X", "lg", GRID, folds=2))


def test_folds_depend_on_the_keys_only(rows):
    a = M.with_folds(rows, ["symbol", "dt"]).select("symbol", "dt", "fold")
    b = M.with_folds(rows.repartition(7), ["symbol", "dt"]).select("symbol", "dt", "fold")
    assert a.exceptAll(b).count() == 0
    assert {r.fold for r in a.collect()} == {0, 1, 2, 3, 4}


def test_full_grids_have_the_stated_sizes():
    sizes = {f: len(M.search_space("A", f, 10, M.FULL_GRIDS).grid) for f in M.FAMILIES}
    assert sizes == {"lg": 18, "svm": 48, "dt": 96}


def test_kernel_features_approximate_rbf(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    data = np.random.default_rng(1).uniform(size=(6, 3))
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], "a double, b double, c double")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(df)
    out = M.RandomFourierFeatures(inputCol="v", outputCol="k", gamma=0.5, dims=2000, inputs=3).transform(df)
    z = np.array([r[0] for r in out.select(vector_to_array("k")).collect()])
    want = np.exp(-0.5 * ((data[:, None] - data[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - want).max() < 0.1
