"""The classifiers of all symbols: search, nested validation, saving and prediction over the full grids.

The three families are trained by ``joint_logistic``, ``joint_support`` and ``joint_trees``; a trained
model is a plain dictionary that turns into built-in column functions.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.indicators import FEATURES
from . import joint, joint_kernel, joint_logistic, joint_support, joint_trees
from .models import FAMILIES, FAMILY_NAMES, prediction_column

# The searched settings, without those that name the same model twice.
GRIDS = {
    "lg": {"C": (0.0001, 0.0005, 0.001, 0.01, 0.3, 0.5, 1, 5, 10), "penalty": ("l1", "l2")},
    "svm": {"C": (0.0001, 0.0005, 0.001, 0.1, 1, 10, 100, 1000), "gamma": (100, 10, 1, 0.1, 0.01, 0.001)},
    "dt": {"features": ("sqrt", "log2"), "alpha": (0.1, 0.01, 0.001),
           "depth": (5, 6, 7, 8, 9, 12, 15, 18), "criterion": ("gini", "entropy")},
}
Models = dict[tuple[str, str], dict]


def settings_of(family: str, grids: dict = GRIDS) -> list[tuple]:
    return list(itertools.product(*grids[family].values()))


@dataclass(frozen=True)
class Trained:
    """All models of one family over one problem."""

    problem: joint.Problem
    family: str
    settings: list[tuple]
    fitted: object
    scores: joint.Scores

    def models(self, chosen: Sequence[int]) -> list[dict]:
        """Of each symbol the model of all its rows with the setting chosen."""
        if not isinstance(self.fitted, joint_support.Search):
            return [self.model(i, 0, int(k)) for i, k in enumerate(chosen)]
        found = self.fitted.models([(i, 0, int(k)) for i, k in enumerate(chosen)])
        return [self._scaled(i, 0, int(chosen[i])) | {"landmarks": x.tolist(), "weights": weights.tolist(), "offset": offset}
                for i, (x, weights, offset) in enumerate(found)]

    def model(self, symbol: int, subset: int, setting: int) -> dict:
        """One model with all that a prediction needs."""
        p, f = self.problem, self.fitted
        if self.family == "lg":
            *weights, offset = f.weights[symbol, subset, setting].tolist()
            return self._scaled(symbol, subset, setting) | {"weights": weights, "offset": offset}
        if self.family == "svm":
            marks = (f.landmarks[symbol] - p.lo[symbol, subset]) / p.span[symbol, subset]
            return self._scaled(symbol, subset, setting) | {
                "landmarks": marks.tolist(), "weights": f.weights[symbol, subset, setting].tolist(),
                "offset": float(f.offset[symbol, subset, setting])}
        return self._named(setting) | {
            "nodes": joint_trees.node_table(p, f, symbol, subset, joint_trees.Setting(*self.settings[setting]))}

    def _named(self, setting: int) -> dict:
        return {"family": self.family, "setting": dict(zip(GRIDS[self.family], self.settings[setting]))}

    def _scaled(self, symbol: int, subset: int, setting: int) -> dict:
        p = self.problem
        return self._named(setting) | {"lo": p.lo[symbol, subset].tolist(), "span": p.span[symbol, subset].tolist()}


def train_family(problem: joint.Problem, family: str, grids: dict = GRIDS) -> Trained:
    settings = settings_of(family, grids)
    if family == "lg":
        fitted = joint_logistic.fit(problem, settings)
        return Trained(problem, family, settings, fitted, joint_logistic.scores(problem, fitted))
    if family == "svm":
        fitted = joint_support.search(problem, [joint_kernel.Setting(float(c), float(g)) for c, g in settings])
        return Trained(problem, family, settings, fitted, fitted.scores)
    if family == "dt":
        fitted = joint_trees.grow(problem, [joint_trees.Setting(*s) for s in settings])
        return Trained(problem, family, settings, fitted, joint_trees.scores(problem, fitted))
    raise ValueError(f"unknown family {family}")


def _trained(build: DataFrame, keys: Sequence[str], families: Iterable[str], nested: bool, symbols: Sequence[str] | None,
             grids: dict, folds: int) -> Iterable[Trained]:
    families = list(families)
    for some in joint.in_groups(list(symbols) if symbols is not None else joint.distinct_symbols(build)):
        problem = joint.prepare(build, keys, nested, some, FEATURES, folds)
        for family in families:
            yield train_family(problem, family, grids)


def train_all(build: DataFrame, keys: Sequence[str], families: Iterable[str] = FAMILIES, symbols: Sequence[str] | None = None,
              grids: dict = GRIDS, folds: int = joint.FOLDS) -> Models:
    """One model per symbol and family: the setting with the best cross-validated accuracy, fitted on all rows."""
    out = {}
    for t in _trained(build, keys, families, False, symbols, grids, folds):
        chosen = joint.best_settings(t.problem, t.scores)
        out |= {(s, t.family): m for s, m in zip(t.problem.symbols, t.models(chosen))}
    return out


def grid_table(build: DataFrame, keys: Sequence[str], families: Iterable[str] = FAMILIES, symbols: Sequence[str] | None = None,
               grids: dict = GRIDS, folds: int = joint.FOLDS) -> list[tuple[str, str, int, float]]:
    """(symbol, family, setting, mean accuracy over the inner folds) for every setting of every grid."""
    out = []
    for t in _trained(build, keys, families, False, symbols, grids, folds):
        accuracy = joint.inner_accuracy(t.problem, t.scores, -1)
        out += [(s, t.family, k, float(accuracy[i, k])) for i, s in enumerate(t.problem.symbols) for k in range(len(t.settings))]
    return out


def nested_table(build: DataFrame, keys: Sequence[str], families: Iterable[str] = FAMILIES, symbols: Sequence[str] | None = None,
                 grids: dict = GRIDS, folds: int = joint.FOLDS) -> list[tuple[str, str, int, int, float]]:
    """(symbol, family, outer fold, setting chosen without it, accuracy on it)."""
    return [(s, t.family, fold, k, accuracy) for t in _trained(build, keys, families, True, symbols, grids, folds)
            for s, fold, k, accuracy in joint.nested_rows(t.problem, t.scores, folds)]


# saving ------------------------------------------------------------------------------------------

def model_name(symbol: str, family: str) -> str:
    return f"{family}-{symbol}-estimator"  # fixed value: the name a model is kept under


def save_models(spark: SparkSession, models: Models, folder: str) -> None:
    rows = [(model_name(s, f), s, f, json.dumps(m)) for (s, f), m in models.items()]
    spark.createDataFrame(rows, "name string, symbol string, family string, model string").write.mode("overwrite").parquet(folder)


def load_models(spark: SparkSession, folder: str, names: Iterable[str] | None = None) -> Models:
    """Saved models, all or those ``names``, in the order of symbol and family."""
    rows = spark.read.parquet(folder)
    if names is not None:
        rows = rows.where(F.col("name").isin(list(names)))
    return {(r.symbol, r.family): json.loads(r.model) for r in rows.orderBy("symbol", "family").collect()}


# prediction ----------------------------------------------------------------------------------------

def _literal(value: object, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def _scaled(model: dict) -> list[Column]:
    return [(F.col(c) - F.lit(lo)) / F.lit(span) for c, lo, span in zip(FEATURES, model["lo"], model["span"])]


def decision(model: dict) -> Column:
    """The value whose sign is the class (lg, svm)."""
    x = _scaled(model)
    if model["family"] == "lg":
        out = F.lit(model["offset"])
        for value, weight in zip(x, model["weights"]):
            out = out + value * F.lit(weight)
        return out
    marks = _literal([{"l": m, "w": w} for m, w in zip(model["landmarks"], model["weights"])], "array<struct<l:array<double>,w:double>>")
    gamma = -float(model["setting"]["gamma"])

    def part(total: Column, mark: Column) -> Column:
        apart = F.zip_with(F.array(*x), mark["l"], lambda a, b: (a - b) * (a - b))
        return total + mark["w"] * F.exp(F.lit(gamma) * F.aggregate(apart, F.lit(0.0), lambda t, d: t + d))

    return F.aggregate(marks, F.lit(model["offset"]), part)


def _leaf_class(model: dict) -> Column:
    nodes = _literal([{"f": n["feature"], "t": n["threshold"], "l": n["left"], "r": n["right"], "p": n["prediction"]}
                      for n in model["nodes"]], "array<struct<f:int,t:double,l:int,r:int,p:int>>")
    x = F.array(*[F.col(c).cast("double") for c in FEATURES])

    def turn(at: Column, _: Column) -> Column:
        node = F.get(nodes, at)
        return F.when(node["f"].isNull(), at).when(F.get(x, node["f"]) <= node["t"], node["l"]).otherwise(node["r"])

    depth = int(np.ceil(model["setting"]["depth"]))
    return F.get(nodes, F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), turn))["p"]


def prediction(model: dict) -> Column:
    """0 or 1; null where a feature is."""
    value = _leaf_class(model) if model["family"] == "dt" else (decision(model) > 0).cast("int")
    whole = F.lit(True)
    for c in FEATURES:
        whole = whole & F.col(c).isNotNull()
    return F.when(whole, value)


def predict_wide(rows: DataFrame, models: Models) -> DataFrame:
    """The prediction of every model as a column of its own, in one pass over the rows."""
    return rows.withColumns({prediction_column(*key): prediction(m) for key, m in models.items()})


def predict_long(rows: DataFrame, models: Models) -> DataFrame:
    """One row per input row and model: (model_symbol, family, prediction)."""
    cells = [F.struct(F.lit(s).alias("model_symbol"), F.lit(f).alias("family"), F.col(prediction_column(s, f)).alias("prediction"))
             for s, f in models]
    return predict_wide(rows, models).select(*rows.columns, F.inline(F.array(*cells)))


def predict_nested(rows: DataFrame, models: Models, names: dict[str, str]) -> DataFrame:
    """Rows with ``stock_predictions``: an array of one struct that holds, per company name, the
    prediction of each family. ``names`` gives the company name of a symbol."""
    def company(symbol: str) -> Column:
        return F.struct(*[F.col(prediction_column(symbol, f)).alias(FAMILY_NAMES[f]) for f in FAMILIES if (symbol, f) in models])

    symbols = list(dict.fromkeys(symbol for symbol, _ in models))
    nested = F.array(F.struct(*[company(s).alias(names[s]) for s in symbols]))
    return predict_wide(rows, models).select(*rows.columns, nested.alias("stock_predictions"))
