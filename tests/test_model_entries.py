"""The registered classifier entries, run whole on the smallest tables."""

import os

import pytest

from tickerpulse.plans import classifiers
from workload import series_queries
from workload.catalog import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")


def test_nested_accuracy_has_every_symbol_family_and_fold(spark):
    rows = QUERIES["m7_nested_accuracy"](spark, SF).collect()
    assert {(r.symbol, r.family, r.fold) for r in rows} == {
        (s, f, k) for s in series_queries.SYMBOLS for f in classifiers.FAMILIES for k in range(5)}
    assert len(rows) == 75 and all(0 <= r.accuracy <= 1 for r in rows)
    assert all(0 <= r.setting < len(classifiers.settings_of(r.family)) for r in rows)


@pytest.mark.parametrize("name, family", [("m3_logistic_regression", "lg"), ("m5_decision_tree", "dt")])
def test_one_family_predicts_every_row_by_every_model(spark, name, family):
    rows = QUERIES[name](spark, SF).collect()
    _, verify = series_queries.frames(spark, SF)
    assert len(rows) == verify.count() * len(series_queries.SYMBOLS)
    assert {(r.model_symbol, r.family) for r in rows} == {(s, family) for s in series_queries.SYMBOLS}
    assert {r.prediction for r in rows} <= {0, 1}
