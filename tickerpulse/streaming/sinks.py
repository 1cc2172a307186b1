"""Micro-batch sinks. A batch that is retried after a failure replaces what it wrote before."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import joined_row
from ..sources.files import csv_writer

BatchSink = Callable[[DataFrame, int], None]


def skip_empty(sink: BatchSink) -> BatchSink:
    """Call ``sink`` for batches with rows. The batch is kept for both, so that asking whether it is
    empty does not run a stateful query twice."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                sink(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def csv_batches(path: str) -> BatchSink:
    """CSV with header in one folder per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        csv_writer(batch, "overwrite").csv(f"{path}/batch={batch_id}")
    return skip_empty(write)


def parquet_batches(path: str) -> BatchSink:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return skip_empty(write)


def text_batches(path: str, columns: Sequence[str]) -> BatchSink:
    """Comma-joined rows as text, one folder per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        lines = batch.select(joined_row(*[F.col(c) for c in columns]).alias("value"))
        lines.write.mode("overwrite").text(f"{path}/batch={batch_id}")
    return skip_empty(write)


def jdbc_batches(url: str, table: str, properties: dict[str, str], connections: int = 8) -> BatchSink:
    """Append to a relational table over at most ``connections`` connections.

    Rows carry ``batch_id``. JDBC appends are at-least-once: a retried batch may repeat rows
    with the same (t_key, batch_id), which readers drop with ``latest_delivery``.
    Credentials come in through ``properties``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.drop("id").withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        (rows.write.mode("append").option("numPartitions", connections)
         .jdbc(url, table, properties=properties))
    return skip_empty(write)


def latest_delivery(rows: DataFrame) -> DataFrame:
    """One row per (t_key, batch_id)."""
    return rows.dropDuplicates(["t_key", "batch_id"])


def fan_out(*sinks: BatchSink) -> BatchSink:
    """Several sinks fed from one computation of the batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for sink in sinks:
                sink(kept, batch_id)
        finally:
            kept.unpersist()
    return write
