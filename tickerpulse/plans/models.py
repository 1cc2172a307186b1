"""Per-symbol classifiers: grids, nested cross-validation, saving, scoring.

Every fit runs on Spark ML over the rows of one symbol. The outer loop goes over symbols and
model families, whose number is fixed by the caller; rows never pass through the driver.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.indicators import FEATURES, KEY

LABEL = "Target"
FAMILIES = ("lg", "svm", "dt")
# Names of the families in the nested result.
FAMILY_NAMES = {"lg": "logistic regression", "svm": "support vector machine", "dt": "decission tree"}
PARALLEL_FITS = 4

# The full grids, without settings that name the same model twice.
FULL_GRIDS = {
    "lg": {"C": (0.0001, 0.0005, 0.001, 0.01, 0.3, 0.5, 1, 5, 10), "penalty": ("l1", "l2")},
    "svm": {"C": (0.0001, 0.0005, 0.001, 0.1, 1, 10, 100, 1000), "gamma": (100, 10, 1, 0.1, 0.01, 0.001)},
    "dt": {"features": ("sqrt", "log2"), "gain": (0.1, 0.01, 0.001),
           "depth": (5, 6, 7, 8, 9, 12, 15, 18), "criterion": ("gini", "entropy")},
}
# A fit costs far more here than in a single process, so the default grid is small.
SMALL_GRIDS = {
    "lg": {"C": (0.01, 1), "penalty": ("l2",)},
    "svm": {"C": (1,), "gamma": (1, 0.1)},
    "dt": {"features": ("sqrt",), "gain": (0.001,), "depth": (5, 8), "criterion": ("gini",)},
}


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Random features whose inner product approximates the RBF kernel (Rahimi & Recht 2007)."""

    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    dims = Param(Params._dummy(), "dims", "number of features made", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the projection", TypeConverters.toInt)
    inputs = Param(Params._dummy(), "inputs", "length of the input vector", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, gamma=1.0, dims=64, seed=1, inputs=len(FEATURES)):
        super().__init__()
        self._setDefault(gamma=1.0, dims=64, seed=1, inputs=len(FEATURES))
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        draw = np.random.default_rng(self.getOrDefault(self.seed))
        dims, inputs = self.getOrDefault(self.dims), self.getOrDefault(self.inputs)
        weights = draw.normal(0.0, math.sqrt(2.0 * self.getOrDefault(self.gamma)), (dims, inputs))
        shifts = draw.uniform(0.0, 2.0 * math.pi, dims)
        rows = [{"w": w.tolist(), "b": float(b)} for w, b in zip(weights, shifts)]
        projection = F.from_json(F.lit(json.dumps(rows)), "array<struct<w:array<double>,b:double>>")
        scale = F.lit(math.sqrt(2.0 / dims))

        def feature(row: Column) -> Column:
            products = F.zip_with(row["w"], F.col("_x"), lambda w, x: w * x)
            return F.cos(F.aggregate(products, row["b"], lambda total, p: total + p)) * scale

        arrays = dataset.withColumn("_x", vector_to_array(F.col(self.getInputCol())))
        return arrays.withColumn(
            self.getOutputCol(), array_to_vector(F.transform(projection, feature))).drop("_x")


def with_features(rows: DataFrame, columns: Iterable[str] = FEATURES) -> DataFrame:
    """Add the feature vector and the label as a double."""
    out = VectorAssembler(inputCols=list(columns), outputCol="features").transform(rows)
    return out.withColumn("label", F.col(LABEL).cast("double")) if LABEL in rows.columns else out


def with_folds(rows: DataFrame, keys: Iterable[str], folds: int = 5, column: str = "fold", salt: int = 0) -> DataFrame:
    """Add a fold number derived from the keys, so that it survives retries and reruns."""
    place = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(salt)), F.lit(folds))
    return rows.withColumn(column, place.cast("int"))


@dataclass(frozen=True)
class Search:
    """An estimator and the settings to try. ``tag`` names its columns."""

    estimator: Estimator
    grid: list


def prediction_column(symbol: str, family: str) -> str:
    return "p_" + re.sub(r"\W", "_", f"{symbol}_{family}")


def search_space(symbol: str, family: str, rows: int, grids: dict = SMALL_GRIDS) -> Search:
    """Scaler and classifier of one family. ``rows`` turns C into Spark's per-row penalty."""
    column = prediction_column(symbol, family)
    scaled = f"scaled_{column}"
    scaler = MinMaxScaler(inputCol="features", outputCol=scaled)
    grid = grids[family]
    common = {"labelCol": "label", "predictionCol": column}
    penalties = [1.0 / (c * max(rows, 1)) for c in grid.get("C", ())]
    build = ParamGridBuilder()
    if family == "lg":
        model = LogisticRegression(featuresCol=scaled, rawPredictionCol="", probabilityCol="", maxIter=200,
                                   standardization=False, **common)
        build.addGrid(model.regParam, penalties)
        build.addGrid(model.elasticNetParam, [1.0 if p == "l1" else 0.0 for p in grid["penalty"]])
        return Search(Pipeline(stages=[scaler, model]), build.build())
    if family == "svm":
        kernel = RandomFourierFeatures(inputCol=scaled, outputCol=f"kernel_{column}")
        model = LinearSVC(featuresCol=f"kernel_{column}", rawPredictionCol="", maxIter=50,
                          standardization=False, **common)
        build.addGrid(kernel.gamma, [float(g) for g in grid["gamma"]])
        build.addGrid(model.regParam, penalties)
        return Search(Pipeline(stages=[scaler, kernel, model]), build.build())
    if family == "dt":
        model = RandomForestClassifier(
            featuresCol=scaled, rawPredictionCol="", probabilityCol="", numTrees=1, bootstrap=False,
            seed=1024, **common)
        build.addGrid(model.featureSubsetStrategy, list(grid["features"]))
        build.addGrid(model.minInfoGain, list(grid["gain"]))
        build.addGrid(model.maxDepth, list(grid["depth"]))
        build.addGrid(model.impurity, list(grid["criterion"]))
        return Search(Pipeline(stages=[scaler, model]), build.build())
    raise ValueError(f"unknown family {family}")


def accuracy_of(predictions: DataFrame, column: str) -> float:
    right = (F.col(column) == F.col("label")).cast("double")
    return predictions.agg(F.avg(right).alias("accuracy")).first()["accuracy"]


def grid_scores(rows: DataFrame, column: str, space: Search, folds: int, fold_column: str = "inner_fold",
                parallelism: int = PARALLEL_FITS) -> list[float]:
    """Mean held-out accuracy of every setting of the grid; one pass over a fold scores all settings."""
    def fit(task: tuple[int, dict]) -> PipelineModel:
        fold, setting = task
        return space.estimator.fit(rows.where(F.col(fold_column) != fold), setting)

    def score(fold: int) -> list[float]:
        out, names = rows.where(F.col(fold_column) == fold).select("features", "label"), []
        for k, model in enumerate(models[fold * len(space.grid):(fold + 1) * len(space.grid)]):
            names.append(f"{column}_{k}")
            model.stages[-1].setPredictionCol(names[-1])
            out = model.transform(out).select("features", "label", *names)
        return list(out.agg(*[F.avg((F.col(n) == F.col("label")).cast("double")) for n in names]).first())

    with ThreadPoolExecutor(parallelism) as pool:
        models = list(pool.map(fit, [(fold, setting) for fold in range(folds) for setting in space.grid]))
        scores = list(pool.map(score, range(folds)))
    return [sum(own) / folds for own in zip(*scores)]


def grid_search(rows: DataFrame, symbol: str, family: str, grids: dict = SMALL_GRIDS, folds: int = 5) -> PipelineModel:
    """The setting with the best cross-validated accuracy, refitted on all rows given."""
    space = search_space(symbol, family, rows.count(), grids)
    best = space.grid[0]
    if len(space.grid) > 1:
        scores = grid_scores(rows, prediction_column(symbol, family), space, folds)
        best = space.grid[max(range(len(scores)), key=scores.__getitem__)]
    return space.estimator.fit(rows, best)


def nested_accuracy(rows: DataFrame, symbol: str, family: str, grids: dict = SMALL_GRIDS,
                    folds: int = 5) -> list[float]:
    """Accuracy on each outer fold of the setting chosen on the others."""
    column = prediction_column(symbol, family)

    def score(fold: int) -> float:
        chosen = grid_search(rows.where(F.col("outer_fold") != fold), symbol, family, grids, folds)
        return accuracy_of(chosen.transform(rows.where(F.col("outer_fold") == fold)), column)

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        return list(pool.map(score, range(folds)))


def symbol_rows(build: DataFrame, symbol: str, keys: Iterable[str], folds: int = 5) -> DataFrame:
    """Feature rows of one symbol with inner and outer folds."""
    keys = list(keys)
    rows = with_features(build.where(F.col(KEY) == symbol))
    inner = with_folds(rows, keys, folds, "inner_fold", salt=1)
    return with_folds(inner, keys, folds, "outer_fold", salt=2)


def by_symbol(build: DataFrame, symbols: Iterable[str], keys: Iterable[str], families: Iterable[str], folds: int,
              function: Callable[[DataFrame, str, str], object]) -> dict[tuple[str, str], object]:
    """``function`` of rows, symbol and family; symbols side by side, as a scheduler has room for them."""
    keys, families = list(keys), list(families)

    def run(symbol: str) -> list[tuple[tuple[str, str], object]]:
        rows = symbol_rows(build, symbol, keys, folds).persist()
        try:
            return [((symbol, f), function(rows, symbol, f)) for f in families]
        finally:
            rows.unpersist()

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        return dict(pair for found in pool.map(run, symbols) for pair in found)


def train_all(build: DataFrame, symbols: Iterable[str], keys: Iterable[str], families: Iterable[str] = FAMILIES,
              grids: dict = SMALL_GRIDS, folds: int = 5) -> dict[tuple[str, str], PipelineModel]:
    """One model per symbol and family."""
    return by_symbol(build, symbols, keys, families, folds, lambda rows, s, f: grid_search(rows, s, f, grids, folds))


def grid_table(build: DataFrame, symbols: Iterable[str], keys: Iterable[str], families: Iterable[str] = FAMILIES,
               grids: dict = SMALL_GRIDS, folds: int = 5) -> list[tuple[str, str, int, float]]:
    """(symbol, family, setting, accuracy) for every setting of every grid."""
    def score(rows: DataFrame, symbol: str, family: str) -> list[float]:
        return grid_scores(rows, prediction_column(symbol, family), search_space(symbol, family, rows.count(), grids), folds)

    found = by_symbol(build, symbols, keys, families, folds, score)
    return [(*key, k, x) for key, scores in found.items() for k, x in enumerate(scores)]


def nested_table(build: DataFrame, symbols: Iterable[str], keys: Iterable[str], families: Iterable[str] = FAMILIES,
                 grids: dict = SMALL_GRIDS, folds: int = 5) -> list[tuple[str, str, int, float]]:
    """(symbol, family, outer fold, accuracy) for every outer fold."""
    found = by_symbol(build, symbols, keys, families, folds, lambda rows, s, f: nested_accuracy(rows, s, f, grids, folds))
    return [(*key, k, x) for key, scores in found.items() for k, x in enumerate(scores)]


def model_path(folder: str, symbol: str, family: str) -> str:
    return f"{folder}/{family}-{symbol}-estimator"


def save_models(models: dict[tuple[str, str], PipelineModel], folder: str) -> None:
    def save(item: tuple) -> None:
        (symbol, family), model = item
        model.write().overwrite().save(model_path(folder, symbol, family))

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        list(pool.map(save, models.items()))


def load_models(folder: str, keys: Iterable[tuple[str, str]]) -> dict[tuple[str, str], PipelineModel]:
    return {(s, f): PipelineModel.load(model_path(folder, s, f)) for s, f in keys}


def predict_wide(rows: DataFrame, models: dict[tuple[str, str], PipelineModel]) -> DataFrame:
    """The prediction of every model as a column of its own, in one pass over the rows."""
    out = with_features(rows)
    for model in models.values():
        out = model.transform(out)
    return out.select(*rows.columns, *[prediction_column(*key) for key in models])


def predict_long(rows: DataFrame, models: dict[tuple[str, str], PipelineModel]) -> DataFrame:
    """One row per input row and model: (model_symbol, family, prediction)."""
    wide = predict_wide(rows, models)
    cells = [
        F.struct(F.lit(symbol).alias("model_symbol"), F.lit(family).alias("family"),
                 F.col(prediction_column(symbol, family)).cast("int").alias("prediction"))
        for symbol, family in models
    ]
    return wide.select(*rows.columns, F.inline(F.array(*cells)))


def predict_nested(rows: DataFrame, models: dict[tuple[str, str], PipelineModel],
                   names: dict[str, str]) -> DataFrame:
    """Rows with ``stock_predictions``: an array of one struct that holds, per company name, the
    prediction of each family. ``names`` gives the company name of a symbol."""
    def company(symbol: str) -> Column:
        return F.struct(*[
            F.col(prediction_column(symbol, f)).cast("int").alias(FAMILY_NAMES[f])
            for s, f in models if s == symbol])

    symbols = list(dict.fromkeys(symbol for symbol, _ in models))
    nested = F.array(F.struct(*[company(s).alias(names[s]) for s in symbols]))
    return predict_wide(rows, models).select(*rows.columns, nested.alias("stock_predictions"))


def accuracy(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """Share of right predictions per model."""
    right = (F.col("prediction") == F.col(label)).cast("double")
    return predictions.groupBy("model_symbol", "family").agg(F.avg(right).alias("accuracy"))


def rows_at(rows: DataFrame, index: int) -> DataFrame:
    """The row with this Index, of every symbol."""
    return rows.where(F.col("Index") == index)
