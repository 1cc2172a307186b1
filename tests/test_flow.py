"""Files to rollup to prices to split to features to a model, end to end."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerpulse.functions.lexicon import Lexicon
from tickerpulse.operators import enrich as J
from tickerpulse.operators import indicators as I
from tickerpulse.operators import posts as P
from tickerpulse.plans import daily, exploration, models, replay, training
from tickerpulse.schemas import instruments, struct_of
from tickerpulse.sources import files

LEX = Lexicon.of({"good": 2.0, "bad": -2.0})
DAYS = 160


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("files")
    rnd = random.Random(0)
    start = dt.date(2016, 1, 1)
    posts, tickers, n = [], [], 0
    for day in range(DAYS):
        for ticker in ("TSLA", "AAPL"):
            n += 1
            seconds = int(dt.datetime(2016, 1, 1, 12, tzinfo=dt.timezone.utc).timestamp()) + day * 86_400
            posts.append(f'{n},w{n % 7},{seconds},"{rnd.choice(["good", "bad"])}, ""really"" so",0,1,2')
            tickers.append(f"{n},XXXX")
            tickers.append(f"{n},{ticker}")
    (at / "Tweet.csv").write_text(
        "tweet_id,writer,post_date,body,comment_num,retweet_num,like_num\n" + "\n".join(posts) + "\n")
    (at / "Company_Tweet.csv").write_text("tweet_id,ticker_symbol\n" + "\n".join(tickers) + "\n")
    (at / "Company.csv").write_text("ticker_symbol,company_name\nTSLA,Tesla Inc\nAAPL,apple\n")
    (at / "prices").mkdir()
    for symbol, shift in (("TSLA.US", 0), ("AAPL.US", 2)):
        rows = []
        for day in range(DAYS):
            close = round(100 + 10 * math.sin(day / 5 + shift) + rnd.random(), 2)
            rows.append(f"{start + dt.timedelta(days=day)},{close},{close + 1},{close - 1},{close},{close},100")
        (at / "prices" / f"{symbol}-daily-stocks.csv").write_text(
            "Date,Open,High,Low,Close,Adjusted_close,Volume\n" + "\n".join(rows) + "\n")
    return str(at)


def test_rollup_from_the_dump(spark, folder):
    dump = files.read_post_dump(spark, f"{folder}/Tweet.csv")
    tickers = files.read_post_tickers(spark, f"{folder}/Company_Tweet.csv")
    posts = P.decode_posts(replay.replay_records(dump, tickers))
    assert posts.where("search_term not in ('TSLA', 'AAPL')").isEmpty()
    assert {r.text for r in posts.select("text").distinct().collect()} == {"good really so", "bad really so"}
    rolled = daily.score_and_roll_up(posts, LEX)
    assert rolled.count() == 2 * DAYS
    # 2 / sqrt(19) = 0.4588, weighted by one follower, three likes, two retweets
    assert {round(abs(r.agg_polarity), 4) for r in rolled.collect()} == {2.7528}


def test_processed_posts(spark, folder):
    out = exploration.processed_posts(
        files.read_post_dump(spark, f"{folder}/Tweet.csv"), files.read_post_tickers(spark, f"{folder}/Company_Tweet.csv"),
        files.read_companies(spark, f"{folder}/Company.csv"), LEX)
    counts = {(r.company_name, r.n) for r in out.groupBy("company_name").agg(F.count("*").alias("n")).collect()}
    assert counts == {("Tesla Inc", DAYS), ("apple", DAYS)}
    assert out.where("day_date = '2016-01-01' and day_passed = 365").count() == 2


def test_prices_to_models(spark, folder, tmp_path):
    dump = files.read_post_dump(spark, f"{folder}/Tweet.csv")
    tickers = files.read_post_tickers(spark, f"{folder}/Company_Tweet.csv")
    rolled = daily.score_and_roll_up(P.decode_posts(replay.replay_records(dump, tickers)), LEX)
    prices = files.as_prices(files.read_symbol_files(spark, f"{folder}/prices"))
    merged = J.merge_prices_polarity(prices, rolled, instruments(spark))
    assert merged.count() == 2 * DAYS
    files.write_split(I.with_split(merged).select("split", "symbol", "dt", "close", "agg_polarity"), str(tmp_path))
    schema = struct_of(("dt", T.DateType()), ("close", T.DoubleType()), ("agg_polarity", T.DoubleType()))
    train = files.read_split(spark, str(tmp_path), "training", schema)
    test = files.read_split(spark, str(tmp_path), "testing", schema)
    assert (train.count(), test.count()) == (2 * 128, 2 * 32)
    assert train.agg(F.max("dt")).first()[0] < test.agg(F.min("dt")).first()[0]

    build = training.build_set(training.labelled_frame(train), purge=7)
    # 29 rows before the first complete window, 7 whose target looks past the end
    assert {r["count"] for r in build.groupBy("symbol").count().collect()} == {128 - 29 - 7}
    grids = {"dt": {"features": ("all",), "gain": (0.001,), "depth": (5,), "criterion": ("gini",)}}
    fitted = models.train_all(build, ("TSLA.US", "AAPL.US"), ("symbol", "dt"), ("dt",), grids, folds=2)
    own = models.predict_long(build, fitted).where("symbol = model_symbol")
    assert all(r.accuracy > 0.8 for r in models.accuracy(own).collect())
