import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickerpulse.functions import timeparse as tp
from tickerpulse.functions.lexicon import Lexicon
from tickerpulse.operators import dashboards as D
from tickerpulse.operators import eda as E
from tickerpulse.operators import enrich as J
from tickerpulse.operators import posts as P
from tickerpulse.operators import rollup
from tickerpulse.plans import daily
from tickerpulse.schemas import SCORED_POST, TERM_TARGETS, inline_table, instruments

LEX = Lexicon.of({"good": 2.0, "bad": -2.0})
DAY = 1_420_070_457  # 2015-01-01


def message(key="1", text="good stock", likes=2, retweets=3, followers=1, created="1420070457"):
    return json.dumps({"key": key, "text": text, "created": created, "searchTerm": "TSLA", "likeCount": likes,
                       "retweetCount": retweets, "userFollowersCount": followers})


def records(spark, *values):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "key string, value string")


def test_decode_score_and_weights(spark):
    rows = P.score_posts(P.usable(P.decode_posts(records(spark, message(), message(likes=None)))), LEX).collect()
    assert rows[0].asDict().keys() == set(SCORED_POST.fieldNames())
    compound = 0.4588  # 2 / sqrt(4 + 15)
    assert [r.polarity for r in rows] == pytest.approx([compound * 2 * 3 * 4, compound * 2 * 4])
    assert rows[0].processed_text == "good stock" and rows[0].id == 0


def test_malformed_messages_are_set_aside(spark):
    posts = P.decode_posts(records(spark, "{not json", message(), json.dumps({"key": "x"}), ""))
    assert P.usable(posts).count() == 1
    assert P.quarantined(posts).count() == 3


def test_round_trip(spark):
    posts = spark.createDataFrame([("7", 'a "b", \n ü', "1", "T", 1, None, 3)],
                                  "t_key string, text string, created string, search_term string, like_count int, "
                                  "retweet_count int, followers_count int")
    assert P.decode_posts(P.encode_posts(posts)).collect() == posts.collect()


def test_search_page(spark):
    page = json.dumps({"results": [
        {"id_str": "1", "text": "x", "created_at": "c", "favorite_count": 1, "retweet_count": 2,
         "user": {"followers_count": 3}},
        {"id_str": "2", "text": "y", "created_at": "d", "favorite_count": 4, "retweet_count": 5}], "next": "t"})
    df = spark.createDataFrame([("tesla", page), ("apple", '{"results": []}')], "search_term string, body string")
    rows = P.flatten_search_page(df).orderBy("t_key").collect()
    assert [(r.t_key, r.search_term, r.followers_count) for r in rows] == [("1", "tesla", 3), ("2", "tesla", None)]


def scored(spark, rows):
    return spark.createDataFrame(rows, SCORED_POST)


def test_rollup_signs_and_redelivery(spark):
    rows = [("a", str(DAY), "T", 0, "x", 2.0), ("b", str(DAY), "T", 0, "x", -1.0), ("c", str(DAY), "T", 0, "x", 0.0),
            ("d", str(DAY), "T", 0, "x", None)]
    out = daily.roll_up_at_rest(scored(spark, rows + rows[:2])).collect()
    assert [tuple(r) for r in out] == [(dt.date(2015, 1, 1), "T", 4, 1.0, 1, 1, 1)]


def test_rollup_reads_every_encoding_of_created(spark):
    written = [str(DAY), "2015-01-01T21:22:54Z", "Thu Jan 01 10:00:00 +0000 2015", "garbage"]
    rows = scored(spark, [(str(i), c, "T", 0, "x", 1.0) for i, c in enumerate(written)])
    got = {r.date: r["count"] for r in daily.roll_up_at_rest(rows).collect()}
    assert got == {dt.date(2015, 1, 1): 3, None: 1}
    numbers = rows.where("t_key = 0").withColumn("created", F.col("created").cast("int"))
    assert daily.roll_up_at_rest(numbers).first().date == dt.date(2015, 1, 1)


def test_distinct_is_by_all_columns(spark):
    rows = [("a", "1", "T", 0, "x", 2.0), ("a", "1", "T", 0, "y", 2.0), ("a", "1", "T", 0, None, 2.0),
            ("a", "1", "T", 0, None, 2.0)]
    assert rollup.distinct_rows(scored(spark, rows)).count() == 3


def test_hot_copies_collapse_before_the_shuffle(spark):
    row = scored(spark, [("a", str(DAY), "T", 0, "x", 1.0)])
    # one record delivered 5000 times
    hot = row.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("again")
    assert daily.roll_up_at_rest(hot).first()["count"] == 1
    plan = rollup.distinct_rows(hot)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2  # once before and once after the exchange


def test_created_encodings(spark):
    texts = ["1420070457", "2021-10-26T21:22:54Z", "Thu Feb 01 10:00:00 +0000 2018", "garbage", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.x for r in df.select("i", F.unix_seconds(tp.parse_created(F.col("t"))).alias("x")).orderBy("i").collect()]
    assert got == [1420070457, 1635283374, 1517479200, None, None, None]


def test_days(spark):
    df = spark.createDataFrame([(DAY,), (-1,), (86_399,)], "s bigint")
    assert [r.d for r in df.select(tp.day_of_epoch(F.col("s")).alias("d")).collect()] == [
        dt.date(2015, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1)]
    df = spark.createDataFrame([(dt.date(2016, 1, 1),)], "d date")
    assert df.select(tp.days_passed(F.col("d"))).first()[0] == 365


def test_ticker_lookup(spark):
    posts = spark.createDataFrame([(1,), (2,), (3,)], "tweet_id long")
    tickers = spark.createDataFrame([(1, "AAPL", 0), (1, "TSLA", 1), (2, "GOOGL", 2)],
                                    "tweet_id long, ticker_symbol string, line long")
    got = {r.tweet_id: r.ticker_symbol for r in J.attach_ticker(posts, tickers, "line").collect()}
    assert got == {1: "TSLA", 2: "GOOG", 3: ""}
    companies = spark.createDataFrame([("AAPL", "apple")], "ticker_symbol string, company_name string")
    got = {r.tweet_id: r.company_name for r in J.attach_company(posts, tickers, companies, "line").collect()}
    assert got == {1: None, 2: None, 3: None}  # the last ticker of post 1 has no name


def test_price_merge_reads_both_vocabularies(spark):
    d = dt.date(2020, 1, 2)
    prices = spark.createDataFrame([("TSLA.US", d, 1.0), ("AAPL.US", d, 2.0), ("BTC-USD.CC", d, None)],
                                   "symbol string, dt date, close double")
    rolled = spark.createDataFrame(
        [(d, "TSLA", 1, 1.0, 1, 0, 0), (d, "tesla", 2, -3.0, 0, 2, 0), (d, "bitcoin", 1, 1.0, 1, 0, 0),
         (d, "GOOGL", 1, 1.0, 1, 0, 0), (d, "oculus", 1, 1.0, 1, 0, 0)],
        "date date, search_term string, count long, agg_polarity double, positive_count long, "
        "negative_count long, neutral_count long")
    (row,) = J.merge_prices_polarity(prices, rolled, instruments(spark)).collect()
    assert (row.symbol, row.search_term, row["count"], row.agg_polarity) == ("TSLA.US", "tesla", 3, -2.0)


def test_unmatched_days(spark):
    days = [dt.date(2020, 1, i) for i in (1, 2, 3)]
    left = spark.createDataFrame([(days[0], None), (days[1], 1.0)], "day_date date, compound double")
    right = spark.createDataFrame([(days[1], "A"), (days[2], "A")], "day_date date, ticker_symbol string")
    got = {r.day_date: r._merge for r in J.unmatched_days(left, right).collect()}
    assert got == {days[0]: "left_only", days[2]: "right_only"}


def test_clamp(spark):
    df = spark.createDataFrame([(10001.0,), (-1e9,), (5.0,), (None,)], "x double")
    assert [r[0] for r in df.select(J.clamp(F.col("x"))).collect()] == [10000.0, -10000.0, 5.0, None]


def test_progress_keeps_terms_without_posts(spark):
    rows = scored(spark, [("a", "1", "TSLA", 0, "x", 2.0)])
    targets = inline_table(spark, ("search_term", "target"), TERM_TARGETS)
    got = {r.search_term: (r.value, r.progress) for r in D.progress_per_term(rows, targets).collect()}
    assert got["TSLA"] == (1, 1 / 799_999) and got["GOOG"] == (0, 0.0) and len(got) == 5


def test_worst_writers_ties_and_first_company(spark):
    rows = [(w, -1.0, c, i) for i, (w, c) in enumerate(
        [(f"w{i:02d}", None if i == 0 else f"c{i % 2}") for i in range(12)] + [("w00", "late")])]
    df = spark.createDataFrame(rows, "writer string, compound double, company_name string, row int")
    worst = [r.writer for r in E.worst_writers(df).collect()]
    assert worst == ["w00"] + [f"w{i:02d}" for i in range(1, 10)]
    got = {r.company: r["count"] for r in E.companies_trolled(df, "row").collect()}
    assert got == {None: 1, "c0": 4, "c1": 5}


def test_positional_sample(spark):
    df = spark.range(50).withColumnRenamed("id", "row")
    out = E.positional_sample(df, "row", width=7, head=3, slices=((10, 12), (12, 13)), tail=2)
    got = sorted((r.part, r.row) for r in out.collect())
    assert got == [(0, 0), (0, 1), (0, 2), (1, 10), (1, 11), (1, 12), (2, 12), (2, 13), (3, 48), (3, 49)]


def test_shares_leave_out_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "company_name string")
    got = {r.company_name: round(r.percent, 4) for r in E.share(df, "company_name").collect()}
    assert got == {"a": 66.6667, "b": 33.3333}


def test_flagship_shuffles_twice_and_never_text(spark):
    posts = spark.createDataFrame([("1", "good", 1, "T", 1, 1, 1)], "t_key string, text string, created long, "
                                  "search_term string, like_count int, retweet_count int, followers_count int")
    plan = daily.score_and_roll_up(posts, LEX)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange " in line]
    assert len(shuffles) == 2 and not any("text#" in line for line in shuffles)
    assert "Python" not in plan and "Join" not in plan
