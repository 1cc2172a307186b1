import json

from tickerpulse.functions.lexicon import Lexicon
from tickerpulse.operators import posts as P
from tickerpulse.plans import daily
from tickerpulse.sources import stream
from tickerpulse.streaming import jobs

LEX = Lexicon.of({"good": 2.0, "bad": -2.0})
GOOD = json.dumps({"text": "good", "created": "1420070457", "searchTerm": "T", "likeCount": 1, "retweetCount": 0,
                   "userFollowersCount": 0})
VALUES = [("a", GOOD), ("b", "{broken"), ("c", json.dumps({"text": None, "searchTerm": "T"})), ("d", GOOD), ("e", None)]


def test_batch_counts_add_up(spark):
    posts = P.decode_posts(spark.createDataFrame(VALUES, "key string, value string"))
    scored, aside = daily.scored_and_quarantined(posts, LEX)
    assert scored.count() + aside.count() == len(VALUES)
    rolled, aside = daily.roll_up_and_quarantined(posts, LEX)
    assert sorted(r.t_key for r in aside.collect()) == ["b", "c", "e"]
    assert rolled.exceptAll(daily.score_and_roll_up(posts, LEX)).count() == 0 and rolled.count() == 1


def test_stream_counts_add_up(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("".join(json.dumps({"key": k, "value": v}) + "\n" for k, v in VALUES))
    scored, aside = jobs.scored_and_quarantined(stream.read_record_files(spark, str(tmp_path / "in")), LEX)
    got = []
    for k, rows in enumerate((scored, aside)):
        rows.writeStream.format("memory").queryName(f"side{k}").option("checkpointLocation", str(tmp_path / f"c{k}")).trigger(
            availableNow=True).start().awaitTermination()
        got.append(sorted(r.t_key for r in spark.table(f"side{k}").collect()))
    assert got == [["a", "d"], ["b", "c", "e"]]
