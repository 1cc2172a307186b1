"""Streaming scoring and counting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.lexicon import Lexicon
from ..functions.timeparse import seconds_of
from ..operators.posts import decode_posts, quarantined, score_posts, usable
from .sinks import BatchSink, fan_out


def scored_stream(records: DataFrame, lexicon: Lexicon, weighted: bool = True) -> DataFrame:
    """(key, value) records to scored posts. Row-local, so it needs no state."""
    return scored_and_quarantined(records, lexicon, weighted)[0]


def scored_and_quarantined(records: DataFrame, lexicon: Lexicon, weighted: bool = True) -> tuple[DataFrame, DataFrame]:
    """Scored posts, and the decoded records that cannot be scored; each record is in one of them."""
    posts = decode_posts(records)
    return score_posts(usable(posts), lexicon, weighted), quarantined(posts)


def start_csv(scored: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds") -> StreamingQuery:
    """Append scored posts to CSV files with exactly-once file commits."""
    writer = (
        scored.writeStream.outputMode("append").format("csv").option("header", True).option("escape", '"')
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()


def start_batches(rows: DataFrame, sink: BatchSink, checkpoint: str,
                  every: str | None = "10 seconds") -> StreamingQuery:
    writer = rows.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def start_scoring(records: DataFrame, lexicon: Lexicon, sinks: list[BatchSink], bad_records: BatchSink,
                  checkpoint: str, every: str | None = "10 seconds") -> StreamingQuery:
    """Decode once per batch, then feed every sink; what cannot be scored goes to ``bad_records``."""
    def good(batch: DataFrame, batch_id: int) -> None:
        fan_out(*sinks)(score_posts(usable(batch), lexicon), batch_id)

    def bad(batch: DataFrame, batch_id: int) -> None:
        bad_records(quarantined(batch), batch_id)

    return start_batches(decode_posts(records), fan_out(good, bad), checkpoint, every)


def _trigger(writer, every: str | None):
    """A fixed interval, or with ``None`` everything available now and then stop."""
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def with_event_time(posts: DataFrame, column: str = "created") -> DataFrame:
    return posts.withColumn("ts", F.timestamp_seconds(seconds_of(posts, column)))


def term_counts(posts: DataFrame, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Posts per tumbling event-time window and term."""
    window = F.window("ts", width)
    return (
        posts.withWatermark("ts", late).groupBy(window, "search_term")
        .agg(F.count(F.lit(1)).alias("tweet_count"))
        .select(F.unix_seconds(F.col("window.start")).alias("time"), "search_term", "tweet_count")
    )


def drop_redelivered(posts: DataFrame, late: str = "1 day") -> DataFrame:
    """One row per post id among deliveries whose event times lie within ``late``."""
    return posts.withWatermark("ts", late).dropDuplicatesWithinWatermark(["t_key"])
