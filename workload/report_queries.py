"""Rollup, dashboards, joins and exploratory reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerpulse.functions import timeparse
from tickerpulse.operators import dashboards as D
from tickerpulse.operators import eda as E
from tickerpulse.operators import enrich as J
from tickerpulse.operators import posts as P
from tickerpulse.operators import rollup
from tickerpulse.plans import daily, exploration, replay
from tickerpulse.schemas import TERM_TARGETS, TOTAL_TARGET, instruments

from . import sql as q
from . import views as v
from .registry import query
from .sql import with_ctes as sql

DAILY_OUT = """CAST(date AS VARCHAR) AS date, search_term, count, round(agg_polarity, 4) AS agg_polarity,
  positive_count, negative_count, neutral_count"""


def daily_out(df):
    return df.withColumns({"date": F.col("date").cast("string"), "agg_polarity": F.round("agg_polarity", 4)})


WEIGHTED_POSTS = f"weighted AS (SELECT p.*, {q.WEIGHTED} AS polarity FROM posts p JOIN compound USING (t_key))"


def score_and_roll_up(spark, sf):
    return daily_out(daily.score_and_roll_up(v.posts(spark, sf), v.LEXICON))


query("a1_score_and_roll_up", sql(
    q.POSTS, q.COMPOUND_CLEAN, WEIGHTED_POSTS, f"d AS ({q.daily('weighted')})",
    select=f"SELECT {DAILY_OUT} FROM d"))(score_and_roll_up)


@query("a1_daily_polarity", sql(q.SCORED, f"d AS ({q.daily('scored')})", select=f"SELECT {DAILY_OUT} FROM d"))
def _(spark, sf):
    return daily_out(rollup.daily_polarity(v.scored(spark, sf)))


@query("a2_redelivered_once", sql(q.SCORED, f"d AS ({q.daily('scored')})", select=f"SELECT {DAILY_OUT} FROM d"))
def _(spark, sf):
    s = v.scored(spark, sf)
    return daily_out(daily.roll_up_at_rest(s.unionByName(s)))


@query("a3_total_posts", sql(q.SCORED, select="SELECT CAST(count(*) AS BIGINT) AS value FROM scored"))
def _(spark, sf):
    return D.total_posts(v.scored(spark, sf))


@query("a4_posts_per_term", sql(q.SCORED, select="""
  SELECT search_term, CAST(count(*) AS BIGINT) AS total FROM scored GROUP BY search_term"""))
def _(spark, sf):
    return D.posts_per_term(v.scored(spark, sf))


@query("a5_progress_per_term", sql(q.SCORED, select=f"""
  SELECT search_term, CAST(coalesce(value, 0) AS BIGINT) AS value, CAST(target AS BIGINT) AS target,
    round(coalesce(value, 0) / CAST(target AS DOUBLE), 10) AS progress
  FROM (VALUES {q.values(TERM_TARGETS)}) AS t(search_term, target)
  LEFT JOIN (SELECT search_term, count(*) AS value FROM scored GROUP BY 1) USING (search_term)"""))
def _(spark, sf):
    out = D.progress_per_term(v.scored(spark, sf), v.targets(spark, TERM_TARGETS))
    return out.select("search_term", "value", F.col("target").cast("bigint").alias("target"),
                      F.round("progress", 10).alias("progress"))


@query("a5_total_progress", sql(q.SCORED, select=f"""
  SELECT CAST(count(*) AS BIGINT) AS value, round(count(*) / CAST({TOTAL_TARGET} AS DOUBLE), 10) AS progress
  FROM scored"""))
def _(spark, sf):
    return D.total_posts(v.scored(spark, sf)).withColumn(
        "progress", F.round(F.col("value") / F.lit(TOTAL_TARGET), 10))


for _term in ("TSLA", "MSFT", "AAPL", "GOOG"):
    query(f"p7_count_{_term.lower()}", sql(q.SCORED, select=f"""
      SELECT CAST(count(*) AS BIGINT) AS value FROM scored WHERE search_term = '{_term}'"""))(
        lambda spark, sf, term=_term: D.total_posts(D.term_is(v.scored(spark, sf), term)))


@query("p8_count_like_amzn", sql(q.SCORED, select="""
  SELECT CAST(count(*) AS BIGINT) AS value FROM scored WHERE search_term LIKE 'AMZN'"""))
def _(spark, sf):
    return D.total_posts(D.term_like(v.scored(spark, sf), "AMZN"))


# 2024-01-05 to 2024-01-20
RANGE = (1704412800, 1705708800)


@query("p10_time_range", sql(q.SCORED, select=f"""
  SELECT t_key, created FROM scored WHERE created BETWEEN {RANGE[0]} AND {RANGE[1]}"""))
def _(spark, sf):
    return D.in_time_range(v.scored(spark, sf), *RANGE).select("t_key", "created")


@query("a6_posts_over_time", sql(q.SCORED, select=f"""
  SELECT created // 3600 * 3600 AS time, CAST(count(id) AS BIGINT) AS tweet_count FROM scored
  WHERE created BETWEEN {RANGE[0]} AND {RANGE[1]} GROUP BY 1"""))
def _(spark, sf):
    return D.posts_over_time(D.in_time_range(v.scored(spark, sf), *RANGE), 3600)


@query("a7_posts_over_time_per_term", sql(q.SCORED, select=f"""
  SELECT created // 86400 * 86400 AS time, search_term, CAST(count(id) AS BIGINT) AS tweet_count FROM scored
  WHERE created BETWEEN {RANGE[0]} AND {RANGE[1]} GROUP BY 1, 2"""))
def _(spark, sf):
    return D.posts_over_time(D.in_time_range(v.scored(spark, sf), *RANGE), 86400, by_term=True)


@query("t1_order_by_time", sql(q.SCORED, select="""
  SELECT created // 86400 * 86400 AS time, CAST(count(id) AS BIGINT) AS tweet_count FROM scored
  GROUP BY 1 ORDER BY 1"""))
def _(spark, sf):
    return D.posts_over_time(v.scored(spark, sf), 86400)


@query("t3_limit", sql(q.SCORED, select="""
  SELECT created AS time, t_key FROM scored ORDER BY created, CAST(t_key AS BIGINT) LIMIT 25"""))
def _(spark, sf):
    s = v.scored(spark, sf)
    return s.orderBy("created", F.col("t_key").cast("bigint")).select(
        F.col("created").alias("time"), "t_key").limit(25)


@query("p16_polarity_series", sql(q.SCORED, select="SELECT created AS time, polarity FROM scored ORDER BY 1"))
def _(spark, sf):
    return D.polarity_series(v.scored(spark, sf))


# joins -------------------------------------------------------------------------------------

@query("p6_symbol_to_term", sql(q.PRICES, q.INSTRUMENTS_SQL, select="""
  SELECT symbol, CAST(dt AS VARCHAR) AS dt, term, company FROM prices LEFT JOIN instruments USING (symbol)"""))
def _(spark, sf):
    p = v.prices(spark, sf).select("symbol", F.col("dt").cast("string").alias("dt"))
    names = instruments(spark)
    return J.map_names(J.map_names(p, names, "symbol", "term"), names, "symbol", "company")


LAST_TICKER = """last_ticker AS (
  SELECT tweet_id, arg_max_null(CASE WHEN ticker_symbol = 'GOOGL' THEN 'GOOG' ELSE ticker_symbol END, line)
    AS ticker_symbol FROM tickers GROUP BY tweet_id)"""


@query("j1_last_ticker_of_post", sql(q.POSTS, q.TICKERS, LAST_TICKER, select="""
  SELECT tweet_id, created, coalesce(ticker_symbol, '') AS ticker_symbol
  FROM posts LEFT JOIN last_ticker USING (tweet_id)"""))
def _(spark, sf):
    return J.attach_ticker(v.posts(spark, sf).select("tweet_id", "created"), v.tickers(spark, sf), "line")


@query("s7_replay_records", sql(q.POSTS, q.TICKERS, LAST_TICKER, select="""
  SELECT t_key, replace(replace(text, ',', ''), '"', '') AS text, CAST(created AS VARCHAR) AS created,
    coalesce(ticker_symbol, '') AS search_term, like_count, retweet_count, 0 AS followers_count
  FROM posts LEFT JOIN last_ticker USING (tweet_id)"""))
def _(spark, sf):
    return P.decode_posts(replay.replay_records(v.dump(spark, sf), v.tickers(spark, sf)))


NAMES = (q.POSTS, q.TICKERS, q.INSTRUMENTS_SQL, q.COMPANIES)


@query("j2_company_of_post", sql(*NAMES, """last_company AS (
  SELECT tweet_id, arg_max_null(company_name, line) AS company_name
  FROM tickers LEFT JOIN companies USING (ticker_symbol) GROUP BY tweet_id)""", select="""
  SELECT tweet_id, writer, company_name FROM posts LEFT JOIN last_company USING (tweet_id)"""))
def _(spark, sf):
    return J.attach_company(v.posts(spark, sf).select("tweet_id", "writer"), v.tickers(spark, sf),
                            v.companies(spark), "line")


POST_DAILY = f"""named AS (
  SELECT p.*, {q.WEIGHTED} AS polarity, i.ticker FROM posts p JOIN compound USING (t_key)
  JOIN instruments i ON i.ticker = CASE WHEN search_term = 'GOOGL' THEN 'GOOG' ELSE search_term END
    OR i.term = search_term)"""

MERGED = f"""rolled AS (
  SELECT {q.day_of('created')} AS dt, ticker, CAST(count(*) AS BIGINT) AS count, sum(polarity) AS agg_polarity,
    CAST(count(*) FILTER (WHERE polarity > 0) AS BIGINT) AS positive_count,
    CAST(count(*) FILTER (WHERE polarity < 0) AS BIGINT) AS negative_count,
    CAST(count(*) FILTER (WHERE polarity = 0) AS BIGINT) AS neutral_count
  FROM named GROUP BY 1, 2),
merged AS (
  SELECT symbol, p.dt, open, high, low, close, volume, i.term AS search_term, r.count, r.agg_polarity,
    r.positive_count, r.negative_count, r.neutral_count
  FROM prices p JOIN instruments i USING (symbol) JOIN rolled r ON r.dt = p.dt AND r.ticker = i.ticker)"""

MERGED_CTES = (q.POSTS, q.COMPOUND_CLEAN, q.INSTRUMENTS_SQL, q.PRICES, POST_DAILY, MERGED)


def merged(spark, sf):
    rolled = daily.score_and_roll_up(v.posts(spark, sf), v.LEXICON)
    return J.merge_prices_polarity(v.prices(spark, sf), rolled, instruments(spark))


@query("j3_prices_with_polarity", sql(*MERGED_CTES, select="""
  SELECT * REPLACE (CAST(dt AS VARCHAR) AS dt, round(agg_polarity, 4) AS agg_polarity) FROM merged"""))
def _(spark, sf):
    return merged(spark, sf).withColumns({
        "dt": F.col("dt").cast("string"), "agg_polarity": F.round("agg_polarity", 4)})


@query("j4_prices_by_ticker_clamped", sql(
    q.POSTS, q.COMPOUND_CLEAN, q.PRICES, q.VALUES, WEIGHTED_POSTS, f"d AS ({q.daily('weighted')})", select="""
  SELECT ticker_symbol, CAST(day_date AS VARCHAR) AS day_date, close_value, round(agg_polarity, 4) AS agg_polarity,
    round(greatest(least(agg_polarity, 10000), -10000), 4) AS agg_polarity2
  FROM d JOIN cvalues ON d.date = day_date AND d.search_term = ticker_symbol"""))
def _(spark, sf):
    d = daily.score_and_roll_up(v.posts(spark, sf), v.LEXICON)
    joined = J.join_prices_by_ticker(d, v.company_values(spark, sf))
    return joined.select("ticker_symbol", F.col("day_date").cast("string").alias("day_date"), "close_value",
                         F.round("agg_polarity", 4).alias("agg_polarity"),
                         F.round("agg_polarity2", 4).alias("agg_polarity2"))


@query("p13_clamp", sql(q.SCORED, select="""
  SELECT t_key, CASE WHEN polarity * 100 > 10000 THEN 10000 WHEN polarity * 100 < -10000 THEN -10000
    ELSE polarity * 100 END AS clamped FROM scored"""))
def _(spark, sf):
    return v.scored(spark, sf).select("t_key", J.clamp(F.col("polarity") * 100).alias("clamped"))


# exploratory reports -----------------------------------------------------------------------

EDA_CTES = (*NAMES, q.COMPOUND_RAW, q.EDA)


def eda_posts(spark, sf):
    return exploration.processed_posts(v.dump(spark, sf), v.tickers(spark, sf), v.companies(spark), v.LEXICON)


@query("e5_processed_posts", sql(*EDA_CTES, select="""
  SELECT tweet_id, writer, created AS post_date, text AS body, company_name, compound, sentiment, day_date FROM eda"""))
def _(spark, sf):
    out = exploration.processed_posts(
        v.dump(spark, sf), v.tickers(spark, sf), v.companies(spark), v.LEXICON, keep_text=True)
    return out.select("tweet_id", "writer", "post_date", "body", "company_name", "compound", "sentiment", "day_date")


@query("a8_post_share_per_company", sql(*NAMES, """named AS (
  SELECT company_name FROM tickers JOIN companies USING (ticker_symbol))""", select="""
  SELECT company_name, CAST(count(*) AS BIGINT) AS n,
    round(count(*) * 100.0 / CAST((SELECT count(*) FROM named) AS DOUBLE), 6) AS percent
  FROM named GROUP BY company_name"""))
def _(spark, sf):
    named = J.map_names(v.tickers(spark, sf), v.companies(spark), "ticker_symbol", "company_name")
    return E.share(named, "company_name").withColumn("percent", F.round("percent", 6))


@query("a9_post_share_per_year", sql(q.POSTS, select=f"""
  SELECT CAST(year({q.day_of('created')}) AS BIGINT) AS year, CAST(count(*) AS BIGINT) AS n,
    round(count(*) * 100.0 / CAST((SELECT count(*) FROM posts) AS DOUBLE), 6) AS percent FROM posts GROUP BY 1"""))
def _(spark, sf):
    year = timeparse.year_of(timeparse.day_of_epoch(F.col("created"))).cast("bigint")
    return E.share(v.posts(spark, sf).select(year.alias("year")), "year").withColumn(
        "percent", F.round("percent", 6))


@query("a10_sentiment_share", sql(*EDA_CTES, select="""
  SELECT company_name, sentiment, round(count(*) * 100.0 /
    CAST(sum(count(*)) OVER (PARTITION BY company_name) AS DOUBLE), 6) AS percent
  FROM eda WHERE company_name IS NOT NULL GROUP BY company_name, sentiment"""))
def _(spark, sf):
    return E.sentiment_share(eda_posts(spark, sf)).withColumn("percent", F.round("percent", 6))


LONG_SHARE = f"""d AS ({q.daily('scored')}),
sums AS (SELECT search_term, sum(positive_count) * 100.0 / CAST(sum(count) AS DOUBLE) AS positive,
  sum(negative_count) * 100.0 / CAST(sum(count) AS DOUBLE) AS negative,
  sum(neutral_count) * 100.0 / CAST(sum(count) AS DOUBLE) AS neutral FROM d GROUP BY 1),
long AS (SELECT search_term, 'positive' AS sentiment, positive AS percent FROM sums UNION ALL
  SELECT search_term, 'negative', negative FROM sums UNION ALL SELECT search_term, 'neutral', neutral FROM sums)"""


@query("a11_sentiment_share_of_rollup", sql(q.SCORED, q.INSTRUMENTS_SQL, q.COMPANIES, LONG_SHARE, select="""
  SELECT company_name, sentiment, round(percent, 6) AS percent
  FROM long JOIN companies ON search_term = ticker_symbol"""))
def _(spark, sf):
    d = rollup.daily_polarity(v.scored(spark, sf))
    return E.sentiment_share_of_rollup(d, v.companies(spark)).withColumn("percent", F.round("percent", 6))


@query("u3_long_sentiment_rows", sql(q.SCORED, f"d AS ({q.daily('scored')})", select="""
  SELECT CAST(date AS VARCHAR) AS date, search_term, s.sentiment, s.n FROM d,
    LATERAL (VALUES ('positive_count', positive_count), ('negative_count', negative_count),
      ('neutral_count', neutral_count)) AS s(sentiment, n)"""))
def _(spark, sf):
    d = rollup.daily_polarity(v.scored(spark, sf)).withColumn("date", F.col("date").cast("string"))
    return d.unpivot(["date", "search_term"], [f"{s}_count" for s in E.SIGNS], "sentiment", "n")


SUMMED = """per_writer AS (
  SELECT writer, sum(compound) AS compound, arg_min_null(company_name, tweet_id) AS company FROM eda GROUP BY writer),
worst AS (SELECT * FROM per_writer ORDER BY round(compound, 6), writer LIMIT 10)"""


@query("a12_score_per_writer", sql(*EDA_CTES, SUMMED, select="""
  SELECT writer, round(compound, 4) + 0.0 AS compound FROM per_writer"""))
def _(spark, sf):
    return E.score_per_writer(eda_posts(spark, sf)).withColumn("compound", F.round("compound", 4) + 0.0)


@query("t2_worst_writers", sql(*EDA_CTES, SUMMED, select="""
  SELECT writer, round(compound, 4) + 0.0 AS compound FROM worst"""))
def _(spark, sf):
    return E.worst_writers(eda_posts(spark, sf)).withColumn("compound", F.round("compound", 4) + 0.0)


@query("j7_first_company_of_worst_writers", sql(*EDA_CTES, SUMMED, select="""
  SELECT writer AS author, company FROM worst"""))
def _(spark, sf):
    return E.first_company_of_worst_writers(eda_posts(spark, sf), "tweet_id")


@query("t4_companies_trolled", sql(*EDA_CTES, SUMMED, select="""
  SELECT company, CAST(count(*) AS BIGINT) AS count FROM worst GROUP BY company"""))
def _(spark, sf):
    return E.companies_trolled(eda_posts(spark, sf), "tweet_id")


@query("a13_company_frequency", sql(*EDA_CTES, """firsts AS (
  SELECT writer, arg_min_null(company_name, tweet_id) AS company FROM eda GROUP BY writer)""", select="""
  SELECT company, CAST(count(*) AS BIGINT) AS count FROM firsts GROUP BY company"""))
def _(spark, sf):
    named = J.attach_company(v.posts(spark, sf).select("tweet_id", "writer"), v.tickers(spark, sf),
                             v.companies(spark), "line")
    firsts = named.groupBy("writer").agg(F.min_by("company_name", "tweet_id").alias("company"))
    return firsts.groupBy("company").agg(F.count(F.lit(1)).alias("count"))


@query("a14_score_per_day", sql(*EDA_CTES, select="""
  SELECT day_date, round(sum(compound), 4) + 0.0 AS compound FROM eda GROUP BY day_date"""))
def _(spark, sf):
    return E.score_per_day(eda_posts(spark, sf)).withColumn("compound", F.round("compound", 4) + 0.0)


@query("a15_posts_per_day_and_company", sql(*EDA_CTES, select="""
  SELECT day_date, company_name, CAST(count(*) AS BIGINT) AS posts FROM eda
  WHERE company_name IS NOT NULL GROUP BY 1, 2"""))
def _(spark, sf):
    return E.posts_per_day_and_company(eda_posts(spark, sf))


@query("a16_sentiment_by_days_passed", sql(*EDA_CTES, select="""
  SELECT company_name, CAST(date_diff('day', DATE '2015-01-01', day) AS BIGINT) AS day_passed,
    CAST(count(*) FILTER (WHERE sentiment = 'positive') AS DOUBLE) AS positive,
    CAST(count(*) FILTER (WHERE sentiment = 'negative') AS DOUBLE) AS negative
  FROM eda WHERE company_name IS NOT NULL GROUP BY 1, 2"""))
def _(spark, sf):
    return E.sentiment_by_days_passed(eda_posts(spark, sf)).withColumn("day_passed", F.col("day_passed").cast("bigint"))


@query("a16_rollup_by_days_passed", sql(q.SCORED, f"d AS ({q.daily('scored')})", select="""
  SELECT search_term, CAST(date_diff('day', DATE '2015-01-01', date) AS BIGINT) AS day_passed,
    positive_count, negative_count FROM d"""))
def _(spark, sf):
    d = rollup.daily_polarity(v.scored(spark, sf))
    passed = timeparse.days_passed(F.col("date")).cast("bigint")
    return d.select("search_term", passed.alias("day_passed"), "positive_count", "negative_count")


@query("a17_close_by_days_passed", sql(q.PRICES, q.VALUES, select="""
  SELECT ticker_symbol, CAST(date_diff('day', DATE '2015-01-01', day_date) AS BIGINT) AS day_passed,
    round(sum(close_value), 2) AS close_value FROM cvalues GROUP BY 1, 2"""))
def _(spark, sf):
    c = v.company_values(spark, sf)
    passed = timeparse.days_passed(F.col("day_date")).cast("bigint")
    return E.close_by_days_passed(c.withColumn("day_passed", passed)).withColumn(
        "close_value", F.round("close_value", 2))


DAY_SCORES = """scores AS (
  SELECT CAST(day_date AS DATE) AS day_date, sum(compound) AS compound FROM eda GROUP BY 1)"""


def day_scores(spark, sf):
    return E.score_per_day(eda_posts(spark, sf)).withColumn("day_date", F.col("day_date").cast("date"))


@query("j5_day_scores_with_prices", sql(*EDA_CTES, q.PRICES, q.VALUES, DAY_SCORES, select="""
  SELECT CAST(day_date AS VARCHAR) AS day_date, round(compound, 4) + 0.0 AS compound, ticker_symbol, close_value
  FROM scores JOIN cvalues USING (day_date)"""))
def _(spark, sf):
    joined = J.join_day_scores(day_scores(spark, sf), v.company_values(spark, sf))
    return joined.select(F.col("day_date").cast("string").alias("day_date"),
                         (F.round("compound", 4) + 0.0).alias("compound"), "ticker_symbol", "close_value")


@query("j6_unmatched_days", sql(*EDA_CTES, q.PRICES, q.VALUES, DAY_SCORES, select="""
  SELECT CAST(day_date AS VARCHAR) AS day_date, ticker_symbol,
    CASE WHEN c.close_value IS NULL THEN 'left_only' ELSE 'right_only' END AS _merge
  FROM scores s FULL OUTER JOIN cvalues c USING (day_date)
  WHERE c.close_value IS NULL OR s.compound IS NULL"""))
def _(spark, sf):
    out = J.unmatched_days(day_scores(spark, sf), v.company_values(spark, sf))
    return out.select(F.col("day_date").cast("string").alias("day_date"), "ticker_symbol", "_merge")


@query("p15_positional_sample", sql(q.SCORED, """placed AS (
  SELECT *, row_number() OVER (ORDER BY CAST(t_key AS BIGINT)) - 1 AS rn, count(*) OVER () AS n FROM scored),
parts AS (SELECT 0 AS part, t_key FROM placed WHERE rn < 101
  UNION ALL SELECT 1, t_key FROM placed WHERE rn BETWEEN 2000 AND 7100
  UNION ALL SELECT 2, t_key FROM placed WHERE rn BETWEEN 7000 AND 9000
  UNION ALL SELECT 3, t_key FROM placed WHERE rn >= n - 100)""", select="SELECT part, t_key FROM parts"))
def _(spark, sf):
    rows = v.scored(spark, sf).withColumn("row", F.col("t_key").cast("bigint"))
    return E.positional_sample(rows, "row", width=4096, head=101, slices=((2000, 7100), (7000, 9000)),
                               tail=100).select("part", "t_key")


@query("u1_union_all", sql(q.SCORED, select="""
  SELECT t_key, search_term FROM scored UNION ALL
  SELECT t_key, search_term FROM scored WHERE search_term = 'TSLA'"""))
def _(spark, sf):
    s = v.scored(spark, sf).select("t_key", "search_term")
    return s.unionByName(D.term_is(s, "TSLA"))
