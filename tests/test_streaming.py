import json

import pytest
from pyspark.sql import functions as F

from tickerpulse.functions.lexicon import Lexicon
from tickerpulse.operators import posts as P
from tickerpulse.plans import replay
from tickerpulse.schemas import SCORED_POST
from tickerpulse.sources import stream
from tickerpulse.streaming import jobs, sinks

LEX = Lexicon.of({"good": 2.0, "bad": -2.0})


def put(folder, name, values):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"key": k, "value": v}) for k, v in values]
    (folder / name).write_text("".join(line + "\n" for line in lines))


def message(key, text="good", created="1420070457"):
    return key, json.dumps({"key": key, "text": text, "created": created, "searchTerm": "T", "likeCount": 1,
                            "retweetCount": 0, "userFollowersCount": 0})


def keys(spark, path):
    return sorted(r.t_key for r in spark.read.schema(SCORED_POST).parquet(str(path)).collect())


def run(spark, tmp, out="out"):
    jobs.start_scoring(
        stream.read_record_files(spark, str(tmp / "in")), LEX, [sinks.parquet_batches(f"{tmp}/{out}")],
        sinks.parquet_batches(f"{tmp}/bad"), f"{tmp}/checkpoint", None).awaitTermination()


def test_restart_processes_only_new_files_and_keeps_bad_records(spark, tmp_path):
    put(tmp_path / "in", "1.json", [message("a"), ("x", "{broken"), message("b", "bad")])
    put(tmp_path / "in", "2.json", [])
    run(spark, tmp_path)
    put(tmp_path / "in", "3.json", [message("c"), message("a")])
    run(spark, tmp_path)
    assert keys(spark, tmp_path / "out") == ["a", "a", "b", "c"]
    bad = spark.read.schema("t_key string, text string").parquet(f"{tmp_path}/bad").collect()
    assert [(r.t_key, r.text) for r in bad] == [("x", None)]


def test_a_retried_batch_replaces_itself(spark, tmp_path):
    rows = spark.createDataFrame([("a", "1", "T", 0, "x", 1.0)], SCORED_POST)
    sink = sinks.parquet_batches(str(tmp_path / "out"))
    for _ in range(2):
        sink(rows, 7)
    assert keys(spark, tmp_path / "out") == ["a"]


def test_stream_equals_batch(spark, tmp_path):
    values = [message(str(i), ["good", "bad", "x", "good bad good"][i % 4]) for i in range(40)]
    put(tmp_path / "in", "1.json", values[:25])
    put(tmp_path / "in", "2.json", values[25:])
    scored = jobs.scored_stream(stream.read_record_files(spark, str(tmp_path / "in"), 1), LEX)
    jobs.start_csv(scored, f"{tmp_path}/csv", f"{tmp_path}/c", None).awaitTermination()
    got = spark.read.schema(SCORED_POST).option("header", True).csv(f"{tmp_path}/csv")
    batch = P.score_posts(P.decode_posts(spark.createDataFrame(values, "key string, value string")), LEX)
    # CSV keeps no blanks at the ends of a field, and an empty field reads as null
    batch = batch.withColumn("processed_text", F.nullif(F.trim("processed_text"), F.lit("")))
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty() and got.count() == 40


def test_both_sinks_get_one_computation(spark, tmp_path):
    counted = spark.sparkContext.accumulator(0)

    def bump(pdfs):
        for pdf in pdfs:
            counted.add(len(pdf))
            yield pdf

    df = spark.range(10).mapInPandas(bump, "id long")
    seen = []
    sinks.fan_out(lambda b, i: seen.append(b.count()), lambda b, i: seen.append(b.agg(F.sum("id")).first()[0]))(df, 0)
    assert seen == [10, 45] and counted.value == 10


def test_redelivery_within_watermark(spark, tmp_path):
    put(tmp_path / "in", "1.json", [message("a"), message("a"), message("b")])
    put(tmp_path / "in", "2.json", [message("b"), message("c")])
    posts = jobs.with_event_time(P.decode_posts(stream.read_record_files(spark, str(tmp_path / "in"), 1)))
    once = jobs.drop_redelivered(posts).select("t_key")
    jobs.start_batches(once, sinks.parquet_batches(f"{tmp_path}/out"), f"{tmp_path}/c", None).awaitTermination()
    rows = spark.read.schema("t_key string").parquet(f"{tmp_path}/out").collect()
    assert sorted(r.t_key for r in rows) == ["a", "b", "c"]


def test_jdbc_sink_appends_in_batches(spark, monkeypatch):
    calls = []
    writer = type(spark.range(1).write)

    def fake(self, url, table, mode=None, properties=None):
        calls.append((url, table, properties))

    monkeypatch.setattr(writer, "jdbc", fake)
    sink = sinks.jdbc_batches("jdbc:x", "tweets", {"user": "u"})
    rows = spark.createDataFrame([("a", "1", "T", 0, "x", 1.0)], SCORED_POST)
    sink(rows, 3)
    sink(rows.limit(0), 4)  # an empty batch is skipped
    assert calls == [("jdbc:x", "tweets", {"user": "u"})]


def test_reader_drops_rows_a_retried_append_repeated(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "t_key string, batch_id long")
    assert sinks.latest_delivery(rows).count() == 2


@pytest.mark.parametrize("every", ["10 seconds", None])
def test_triggers(spark, tmp_path, every):
    put(tmp_path / "in", "1.json", [message("a")])
    rows = stream.read_record_files(spark, str(tmp_path / "in"))
    query = jobs.start_batches(rows, lambda b, i: b.count(), f"{tmp_path}/c", every)
    query.processAllAvailable() if every else query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    query.stop()


def test_replay_in_steps_goes_on_after_a_restart(spark, tmp_path):
    """Exactly so many records a step, in order; a failed step is sent again, finished ones are not."""
    records = spark.range(1, 1048).select(F.col("id").alias("place"), F.concat(F.lit("k"), "id").alias("key")).repartition(5)
    steps = replay.lay_out_steps(records, "place", str(tmp_path / "steps"), 100, width=64)
    assert steps == 11
    sent, failing = [], [True]

    def send(rows, step):
        if step == 4 and failing:
            failing.clear()
            raise RuntimeError("lost")
        sent.append((step, sorted(r.place for r in rows.collect())))

    with pytest.raises(Exception, match="lost"):
        replay.replay_all(spark, str(tmp_path / "steps"), steps, send, str(tmp_path / "checkpoint"), "0 seconds")
    assert [s for s, _ in sent] == [0, 1, 2, 3]
    replay.replay_all(spark, str(tmp_path / "steps"), steps, send, str(tmp_path / "checkpoint"), "0 seconds")
    assert [s for s, _ in sent] == list(range(11))
    assert [p for _, places in sent for p in places] == list(range(1, 1048))
    assert [len(places) for _, places in sent] == [100] * 10 + [47]
    assert replay.lay_out_steps(records.limit(0), "place", str(tmp_path / "none"), 100) == 0


def test_replay_of_several_steps_at_once(spark, tmp_path):
    """A batch holds whole steps, each row says its own; the batch that failed is sent again whole."""
    records = spark.range(1, 1048).select(F.col("id").alias("place")).repartition(5)
    folder = str(tmp_path / "steps")
    steps = replay.lay_out_steps(records, "place", folder, 100, width=64)
    sent, failing = [], [True]

    def send(rows, step):
        if step == 4 and failing:
            failing.clear()
            raise RuntimeError("lost")
        sent.append((step, sorted((r.step, r.place) for r in rows.collect())))

    for again in (False, True):
        try:
            replay.replay_all(spark, folder, steps, send, str(tmp_path / "checkpoint"), "0 seconds", steps_at_once=4)
        except Exception as e:
            assert not again and "lost" in str(e)
    assert [s for s, _ in sent] == [0, 4, 8]
    assert [row for _, rows in sent for row in rows] == [((place - 1) // 100, place) for place in range(1, 1048)]
    replay.replay_all(spark, str(tmp_path / "none"), 0, send, str(tmp_path / "other"), "0 seconds")


def test_files_of_a_throttled_replay_stay_small(spark, tmp_path):
    """The batches stay as many, the files of one grow in number and not in size."""
    records = spark.range(0, 1000, 1, 3).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"))
    for limit, files in ((1000, 1), (100, 3)):
        folder, got = str(tmp_path / f"records{limit}"), []
        assert replay.lay_out_files(records, folder, 4, limit) == files
        sizes = [r["count"] for r in spark.read.json(folder).groupBy(F.input_file_name()).count().collect()]
        assert len(sizes) == 4 * files and sum(sizes) == 1000 and max(sizes) <= 1.2 * 1000 / (4 * files)
        throttled = stream.read_record_files(spark, folder, files_per_trigger=files)
        jobs.start_batches(throttled, lambda batch, _: got.append(batch.count()), str(tmp_path / f"check{limit}"), None).awaitTermination()
        assert len(got) == 4 and sum(got) == 1000
