"""From the dump of raw posts to the records of the stream, and its replay in steps of so many records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import sanitize_body
from ..operators.enrich import attach_ticker
from ..operators.posts import encode_posts
from ..operators.series import number_rows

# After so many records the replay pauses for so long.
STEP_RECORDS, PAUSE = 10_000, "1 second"


def replay_records(dump: DataFrame, tickers: DataFrame, order: str = "line") -> DataFrame:
    """Raw posts with their ticker as (key, value) records. The dump knows no follower counts."""
    posts = attach_ticker(dump, tickers, order).select(
        F.col("tweet_id").cast("string").alias("t_key"), sanitize_body(F.col("body")).alias("text"),
        F.col("post_date").alias("created"), F.col("ticker_symbol").alias("search_term"),
        F.col("like_num").alias("like_count"), F.col("retweet_num").alias("retweet_count"),
        F.lit(0).alias("followers_count"))
    return encode_posts(posts)


def lay_out_steps(records: DataFrame, order: str, folder: str, step_records: int = STEP_RECORDS, width: int = 65_536) -> int:
    """Write ``records`` in the order of a whole-number column, ``step_records`` of them in each folder
    step=0, 1, ... (fewer in the last). Returns the number of steps."""
    numbered = number_rows(records, [], [order], F.floor(F.col(order) / F.lit(width)), levels=2)
    placed = numbered.withColumn("step", F.floor(F.col("rn") / F.lit(step_records)))
    placed.repartition("step").sortWithinPartitions("step", "rn").drop("n_rows").write.partitionBy("step").parquet(folder)
    last = placed.agg(F.max("step")).first()[0]
    return 0 if last is None else last + 1


def lay_out_files(records: DataFrame, folder: str, batches: int, file_records: int = STEP_RECORDS) -> int:
    """Write ``records`` as JSON to be replayed in so many batches, in files of about ``file_records`` at most, so that
    no task writes a batch alone. Returns the number of files that make up a batch."""
    files = max(1, -(-records.count() // (batches * file_records)))
    records.repartition(batches * files).write.json(folder)
    return files


def start_replay(spark: SparkSession, folder: str, send: Callable[[DataFrame, int], None], checkpoint: str,
                 pause: str = PAUSE, steps_at_once: int = 1) -> StreamingQuery:
    """A query that hands the next step to ``send`` (rows, step) after every pause. The number of the step
    is the offset of the stream, so a restart goes on where the last finished step ended and a
    step that failed is sent again under its number. Only the folder of that step is read; after the
    last one nothing is sent.

    Small steps can be handed over ``steps_at_once`` in one batch (fewer at the end), under the number of
    the first: the rows then say their ``step``, and the batch is what is sent again. The folders are listed
    once, so ``folder`` has to be laid out before."""
    steps = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", steps_at_once)
             .option("numPartitions", 1).load())
    laid_out = spark.read.parquet(folder)

    def hand_over(batch: DataFrame, _: int) -> None:
        numbers = [row.value for row in batch.select("value").collect()]  # ``steps_at_once`` rows
        if not numbers:
            return
        rows = laid_out.where(F.col("step").between(min(numbers), max(numbers)))
        if not rows.isEmpty():
            send(rows.sortWithinPartitions("rn").drop("rn", *(["step"] if steps_at_once == 1 else [])), min(numbers))

    return (steps.writeStream.foreachBatch(hand_over).option("checkpointLocation", checkpoint)
            .trigger(processingTime=pause).start())


def replay_all(spark: SparkSession, folder: str, steps: int, send: Callable[[DataFrame, int], None], checkpoint: str,
               pause: str = PAUSE, steps_at_once: int = 1) -> None:
    """Replay up to the last step and stop."""
    if not steps:
        return
    done = []

    def counted(rows: DataFrame, step: int) -> None:
        send(rows, step)
        done.append(step)

    query = start_replay(spark, folder, counted, checkpoint, pause, steps_at_once)
    try:
        while query.isActive and not (done and done[-1] + steps_at_once >= steps):
            query.awaitTermination(0.1)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
