"""From raw documents to packed sequences: drop toxic and poor texts, keep one of each group of near
copies, drop documents that hold test items, pack what is left.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read back as the
next stage's ``docs``. All but the last return the columns of ``documents``. A document without an id
cannot be labelled; it goes through every stage like the others. Empty texts are neither toxic nor near
copies; the quality model scores them like any text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerpulse.llm import decontaminate, near_dedup, packing, quality_model, toxicity
from tickerpulse.llm.common import stage, table
from tickerpulse.llm.queries import ship, tokenizer_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEEP_QUALITY = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain of toxicity classifiers does not reject."""
    ship(spark)
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, chain).where(~F.col("rejected")).select(docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled model takes for good."""
    ship(spark)
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, model).where(F.col("quality_score") >= KEEP_QUALITY).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest id, of those that repeat it any
    one; a row without an id only where the group has none. Rows are numbered for that, so copies that
    repeat an id or have none are told apart."""
    ship(spark)
    row = "_row" + "_" * max((len(c) for c in docs.columns), default=0)  # no other column has that name
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = near_dedup.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text")).select(
        F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    kept = numbered.select(row, "doc_id").join(groups, row).groupBy("component_id").agg(F.min(order).alias("first"))
    return numbered.join(kept.select(F.col("first")[row].alias(row)), row, "left_semi").drop(row)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no item of ``benchmark``."""
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    ship(spark)
    return packing.pack(packing.pieces(docs, tokenizer_file("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None  # no stage but decontamination and the near copies can be put in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
