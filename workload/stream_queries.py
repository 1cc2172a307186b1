"""Streaming jobs, run over everything available and read back from what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerpulse.functions import text
from tickerpulse.operators import posts as P
from tickerpulse.plans import replay
from tickerpulse.schemas import SCORED_POST
from tickerpulse.session import scratch_path
from tickerpulse.sources import stream
from tickerpulse.streaming import jobs, sinks

from . import sql as q
from . import views as v
from .registry import query
from .sql import with_ctes as sql


def wire(spark, sf, times: int = 1) -> str:
    """The posts as JSON record files; ``times`` > 1 delivers each that often."""
    path = scratch_path(spark, "records")
    records = P.encode_posts(v.posts(spark, sf))
    for _ in range(times):
        records.write.mode("append").json(path)
    return path


def batches_of(spark, path: str, schema: str) -> DataFrame:
    rows = spark.read.schema(schema).parquet(path)
    return rows.drop("batch")


SCORED_OUT = f"""SELECT t_key, CAST(created AS VARCHAR) AS created, search_term, processed_text,
  round({q.WEIGHTED}, 4) AS polarity FROM cleaned JOIN compound USING (t_key)"""
TRIMMED_SQL = sql(
    q.POSTS, q.COMPOUND_CLEAN, select=SCORED_OUT.replace("processed_text,", "trim(processed_text) AS processed_text,"))
SCORED_SQL = sql(q.POSTS, q.COMPOUND_CLEAN, select=SCORED_OUT)


def scored_out(df: DataFrame) -> DataFrame:
    return df.select("t_key", "created", "search_term", "processed_text", F.round("polarity", 4).alias("polarity"))


@query("s1_record_stream", sql(q.POSTS, select="""
  SELECT t_key, text, CAST(created AS VARCHAR) AS created, search_term, like_count, retweet_count, followers_count
  FROM posts"""))
def _(spark, sf):
    out = scratch_path(spark, "decoded")
    decoded = P.decode_posts(stream.read_record_files(spark, wire(spark, sf)))
    jobs.start_batches(decoded, sinks.parquet_batches(out), scratch_path(spark, "checkpoint"), None).awaitTermination()
    return spark.read.schema(decoded.schema).parquet(out).select(*decoded.columns)


@query("s3_backlog_tag_counts", sql(q.POSTS, select="""
  SELECT t_key, length(text) - length(replace(text, '#', '')) AS tags FROM posts"""))
def _(spark, sf):
    out = scratch_path(spark, "tags")
    decoded = P.decode_posts(stream.read_record_files(spark, wire(spark, sf)))
    tags = decoded.select("t_key", text.hashtag_marks(F.col("text")).cast("bigint").alias("tags"))
    jobs.start_batches(tags, sinks.parquet_batches(out), scratch_path(spark, "checkpoint"), None).awaitTermination()
    return batches_of(spark, out, "t_key string, tags bigint")


@query("s11_csv_stream_sink", TRIMMED_SQL)
def _(spark, sf):
    out = scratch_path(spark, "scored-csv")
    scored = jobs.scored_stream(stream.read_record_files(spark, wire(spark, sf)), v.LEXICON)
    jobs.start_csv(scored, out, scratch_path(spark, "checkpoint"), None).awaitTermination()
    return scored_out(spark.read.schema(SCORED_POST).option("header", True).csv(out))


@query("r1_score_stream", SCORED_SQL)
def _(spark, sf):
    out = scratch_path(spark, "scored")
    scored = jobs.scored_stream(stream.read_record_files(spark, wire(spark, sf)), v.LEXICON)
    jobs.start_batches(scored, sinks.parquet_batches(out), scratch_path(spark, "checkpoint"), None).awaitTermination()
    return scored_out(spark.read.schema(SCORED_POST).parquet(out))


def two_sinks(spark, sf) -> tuple[str, str, str]:
    csv, table, bad = (scratch_path(spark, n) for n in ("csv", "table", "bad"))
    jobs.start_scoring(
        stream.read_record_files(spark, wire(spark, sf)), v.LEXICON,
        [sinks.csv_batches(csv), sinks.parquet_batches(table)], sinks.parquet_batches(bad),
        scratch_path(spark, "checkpoint"), None).awaitTermination()
    return csv, table, bad


@query("r2_two_sinks", sql(q.POSTS, q.COMPOUND_CLEAN, f"one AS ({SCORED_OUT})", select="""
  SELECT 'csv' AS sink, t_key, polarity FROM one UNION ALL SELECT 'table', t_key, polarity FROM one"""))
def _(spark, sf):
    csv, table, _ = two_sinks(spark, sf)
    first = spark.read.schema(SCORED_POST).option("header", True).csv(csv)
    second = spark.read.schema(SCORED_POST).parquet(table)
    parts = [df.select(F.lit(name).alias("sink"), "t_key", F.round("polarity", 4).alias("polarity"))
             for name, df in (("csv", first), ("table", second))]
    return parts[0].unionByName(parts[1])


@query("s12_batch_table_sink", SCORED_SQL)
def _(spark, sf):
    return scored_out(spark.read.schema(SCORED_POST).parquet(two_sinks(spark, sf)[1]))


PLAIN = ("t_key", "polarity", "processed_text", "created")


@query("r3_unweighted_stream", sql(q.POSTS, q.COMPOUND_CLEAN, select="""
  SELECT t_key, compound AS polarity, processed_text, CAST(created AS VARCHAR) AS created
  FROM cleaned JOIN compound USING (t_key)"""))
def _(spark, sf):
    out = scratch_path(spark, "plain")
    scored = jobs.scored_stream(stream.read_record_files(spark, wire(spark, sf)), v.LEXICON, weighted=False)
    rows = scored.select(*PLAIN)
    jobs.start_batches(rows, sinks.parquet_batches(out), scratch_path(spark, "checkpoint"), None).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out).select(*PLAIN)


@query("s14_text_sink", sql(q.POSTS, q.COMPOUND_CLEAN, select=f"""
  SELECT t_key || ',' || {q.LABEL} || ',' || processed_text || ',' || CAST(created AS VARCHAR) AS value
  FROM cleaned JOIN compound USING (t_key)"""))
def _(spark, sf):
    from tickerpulse.functions.sentiment import label

    out = scratch_path(spark, "lines")
    scored = jobs.scored_stream(stream.read_record_files(spark, wire(spark, sf)), v.LEXICON, weighted=False)
    rows = scored.withColumn("polarity", label(F.col("polarity"))).select(*PLAIN)
    jobs.start_batches(rows, sinks.text_batches(out, PLAIN), scratch_path(spark, "checkpoint"), None).awaitTermination()
    return spark.read.text(out).select("value")


@query("s17_throttled_replay", sql(select="""
  SELECT CAST(4 AS BIGINT) AS batches, CAST(count(*) AS BIGINT) AS records FROM documents"""))
def _(spark, sf):
    records, out = scratch_path(spark, "records"), scratch_path(spark, "replayed")
    files = replay.lay_out_files(P.encode_posts(v.posts(spark, sf)), records, 4)
    throttled = stream.read_record_files(spark, records, files_per_trigger=files).select("key")
    jobs.start_batches(throttled, sinks.parquet_batches(out), scratch_path(spark, "checkpoint"), None).awaitTermination()
    got = spark.read.schema("key string, batch int").option("basePath", out).parquet(out)
    return got.agg(F.count_distinct("batch").alias("batches"), F.count(F.lit(1)).alias("records"))


@query("s17_replay_in_steps", sql(q.POSTS, select="""
  SELECT step, CAST(count(*) AS BIGINT) AS records, CAST(min(t_key) AS VARCHAR) AS first_key FROM (
    SELECT t_key, (row_number() OVER (ORDER BY CAST(t_key AS BIGINT)) - 1) // 150 AS step FROM posts) GROUP BY 1"""))
def _(spark, sf):
    # 150 records a step, as the smallest tables hold few posts
    folder, out = scratch_path(spark, "steps"), scratch_path(spark, "replayed")
    posts = v.posts(spark, sf).select("t_key", F.col("t_key").cast("bigint").alias("place"))
    steps = replay.lay_out_steps(posts, "place", folder, 150)

    def send(rows: DataFrame, step: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={step}")

    # without a pause, as many small steps go at once as make up a step of the usual size
    replay.replay_all(spark, folder, steps, send, scratch_path(spark, "checkpoint"), "0 seconds",
                      steps_at_once=replay.STEP_RECORDS // 150)
    got = batches_of(spark, out, "t_key string, step bigint")
    return got.groupBy("step").agg(F.count(F.lit(1)).alias("records"), F.min("t_key").alias("first_key"))


@query("a20_micro_batch_counts", sql(select="SELECT CAST(count(*) AS BIGINT) AS records FROM documents"))
def _(spark, sf):
    out = scratch_path(spark, "counts")

    def count_batch(batch: DataFrame, batch_id: int) -> None:
        counted = batch.agg(F.count(F.lit(1)).alias("records"))
        counted.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    records = stream.read_record_files(spark, wire(spark, sf), files_per_trigger=2)
    jobs.start_batches(records, sinks.skip_empty(count_batch), scratch_path(spark, "checkpoint"), None).awaitTermination()
    return batches_of(spark, out, "records bigint").agg(F.sum("records").alias("records"))


@query("r4_running_word_counts", sql(q.POSTS, select=f"""
  SELECT word, CAST(count(*) AS BIGINT) AS count
  FROM (SELECT unnest(string_split({q.clean('text')}, ' ')) AS word FROM posts) WHERE word <> '' GROUP BY word"""))
def _(spark, sf):
    out = scratch_path(spark, "words")
    decoded = P.decode_posts(stream.read_record_files(spark, wire(spark, sf), files_per_trigger=4))
    counts = P.word_counts(decoded.select(text.clean_document(F.col("text")).alias("text")))

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    # update mode: each batch carries the words whose count changed
    (counts.writeStream.outputMode("update").foreachBatch(sinks.skip_empty(keep))
     .option("checkpointLocation", scratch_path(spark, "checkpoint")).trigger(availableNow=True)
     .start().awaitTermination())
    changes = spark.read.schema("word string, count bigint, batch int").option("basePath", out).parquet(out)
    return changes.groupBy("word").agg(F.max_by("count", "batch").alias("count"))


@query("r5_restart_from_checkpoint", SCORED_SQL)
def _(spark, sf):
    records, out = scratch_path(spark, "records"), scratch_path(spark, "scored")
    checkpoint = scratch_path(spark, "checkpoint")
    encoded = P.encode_posts(v.posts(spark, sf))
    first = F.col("key").cast("bigint") % 2 == 0
    # half of the records arrive before the restart and half after it
    for half in (first, ~first):
        encoded.where(half).write.mode("append").json(records)
        scored = jobs.scored_stream(stream.read_record_files(spark, records), v.LEXICON)
        jobs.start_batches(scored, sinks.parquet_batches(out), checkpoint, None).awaitTermination()
    return scored_out(spark.read.schema(SCORED_POST).parquet(out))


def event_stream(spark, sf) -> DataFrame:
    """The events file as a stream of (t_key, ts, search_term)."""
    schema = v.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return events.select(
        F.col("event_id").cast("string").alias("t_key"), F.timestamp_seconds(v.event_seconds()).alias("ts"),
        v.pick(F.col("event_type"), v.EVENT_TERMS).alias("search_term"))


@query("r6_term_counts_stream", sql(q.SCORED, """windows AS (
  SELECT created // 86400 * 86400 AS time, search_term, CAST(count(*) AS BIGINT) AS tweet_count FROM scored
  GROUP BY 1, 2)""", select="""
  SELECT * FROM windows WHERE time + 86400 <= (SELECT max(created) FROM scored) - 86400"""))
def _(spark, sf):
    # a window is final once the watermark, one day behind the newest event, has passed its end
    out = scratch_path(spark, "windows")
    counts = jobs.term_counts(event_stream(spark, sf))
    jobs.start_batches(counts, sinks.parquet_batches(out), scratch_path(spark, "checkpoint"), None).awaitTermination()
    return batches_of(spark, out, "time bigint, search_term string, tweet_count bigint")


@query("r7_redelivered_once_stream", sql(q.SCORED, select="SELECT t_key, search_term FROM scored"))
def _(spark, sf):
    out = scratch_path(spark, "once")
    twice = event_stream(spark, sf).unionByName(event_stream(spark, sf))
    once = jobs.drop_redelivered(twice).select("t_key", "search_term")
    jobs.start_batches(once, sinks.parquet_batches(out), scratch_path(spark, "checkpoint"), None).awaitTermination()
    return batches_of(spark, out, "t_key string, search_term string")
