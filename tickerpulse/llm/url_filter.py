"""Verdicts on URLs: rules for hosts and paths, and a linear model where no rule fits.

All of it is DataFrame expressions and Spark ML, without Python in the tasks. The model is a logistic
regression on character n-grams of host and path, hashed into a fixed number of places and trained
from a small table of labelled URLs; texts are scored inside their rows, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAMS = (3, 4, 5)
PLACES = 1 << 14
TRAIN_ROWS = 20_000
PENALTY = 0.01
STEPS = 40


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str  # begins with /


def host_of(url: Column) -> Column:
    """From the first :// to the next /, ? or #, with A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as struct(size, rule, verdict), or null. A rule fits its host and all
    subdomains, where the path starts with the rule's. Of equal rules, block wins."""
    fitting = [
        F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
               F.struct(F.lit(len(r.host + r.path)).alias("size"), F.lit(r.host + r.path).alias("rule"),
                        F.lit(r.verdict).alias("verdict")))
        for r in rules]
    none = F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    return F.array_max(F.array(*fitting)) if fitting else none


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, told apart; ^ and $ mark where they begin and end."""

    def runs(text: Column, mark: str, n: int) -> Column:
        last = F.length(text) - (n - 1)
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substr(text, i, F.lit(n))))

    marked = [(F.concat(F.lit("^"), c, F.lit("$")), mark) for c, mark in ((host, "h"), (path, "p"))]
    return F.concat(*[runs(text, mark, n) for text, mark in marked for n in GRAMS])


def _features(urls: DataFrame) -> DataFrame:
    """Adds ``_features`` to rows with ``host`` and ``path``."""
    hashed = HashingTF(numFeatures=PLACES, binary=True, inputCol="_grams", outputCol="_features")
    return hashed.transform(urls.withColumn("_grams", grams(F.col("host"), F.col("path")))).drop("_grams")


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> LogisticRegressionModel | None:
    """Fits on at most ``rows`` of ``labelled`` (url, allowed: 1 or 0), picked by a hash of the URL.
    Rows without a label are left out; with no rows at all there is no model."""
    known = labelled.where("allowed is not null").select(F.coalesce("url", F.lit("")).alias("url"), F.col("allowed").cast("double"))
    picked = known.orderBy(F.xxhash64("url"), "url", "allowed").limit(rows)
    urls = _features(picked.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "allowed"))
    urls = urls.select("_features", "allowed").persist()
    try:
        if urls.isEmpty():
            return None
        return LogisticRegression(featuresCol="_features", labelCol="allowed", regParam=PENALTY, maxIter=STEPS,
                                  standardization=False).fit(urls)
    finally:
        urls.unpersist()


def judge(pages: DataFrame, rules: Sequence[Rule], model: LogisticRegressionModel | None) -> DataFrame:
    """``pages`` with host, path, rule, allow_score (the model's probability) and verdict; columns of
    these names are replaced.

    Reads ``url``. A null url, or one without ://, has an empty host and path: no rule with a host
    fits it, and the model judges it by its n-grams of nothing. Without a model, what no rule
    decides is allowed. Repeated rows get equal results."""
    pages = pages.drop("host", "path", "rule", "allow_score", "verdict")
    kept = [F.col(c) for c in pages.columns]
    parts = pages.select(*kept, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumn("_rule", best_rule(F.col("host"), F.col("path"), rules))
    if model is None:
        scored = parts.withColumn("allow_score", F.lit(1.0))
    else:
        model = model.copy()
        model.setRawPredictionCol("_raw").setProbabilityCol("_probability").setPredictionCol("")
        scored = model.transform(_features(parts)).withColumn("allow_score", vector_to_array("_probability")[1])
    return scored.select(*kept, "host", "path", F.col("_rule.rule").alias("rule"), "allow_score", F.coalesce(
        F.col("_rule.verdict"), F.when(F.col("allow_score") >= 0.5, "allow").otherwise("block")).alias("verdict"))


def ruled(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(url, allowed) for the pages that rules decide: labelled URLs to train on."""
    verdict = best_rule(host_of(F.col("url")), path_of(F.col("url")), rules)["verdict"]
    return pages.select("url", (verdict == "allow").cast("int").alias("allowed")).where("allowed is not null")
