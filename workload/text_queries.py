"""Records, text, sentiment and time scalars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerpulse.functions import sentiment, text, timeparse
from tickerpulse.functions.named import register_functions
from tickerpulse.operators import enrich, posts as P
from tickerpulse.schemas import POST_DUMP
from tickerpulse.sources import files

from . import sql as q
from . import views as v
from .registry import query
from .sql import with_ctes as sql

POST_COLUMNS = "t_key, text, CAST(created AS VARCHAR) AS created, search_term, like_count, retweet_count, followers_count"


@query("s5_json_round_trip", sql(q.POSTS, select=f"SELECT {POST_COLUMNS} FROM posts"))
def _(spark, sf):
    return P.decode_posts(P.encode_posts(v.posts(spark, sf)))


def search_pages(spark, sf) -> DataFrame:
    """Result pages of up to 100 posts of one term, as JSON text."""
    hit = F.struct(
        F.col("t_key").alias("id_str"), "text", F.col("created").cast("string").alias("created_at"),
        F.col("like_count").alias("favorite_count"), "retweet_count", F.struct("followers_count").alias("user"))
    hundred = F.floor(F.col("tweet_id") / 100)
    pages = v.posts(spark, sf).groupBy("search_term", hundred.alias("next")).agg(
        F.collect_list(hit).alias("results"))
    return pages.select("search_term", F.to_json(F.struct("results", F.col("next").cast("string"))).alias("body"))


@query("s6_search_page_flatten", sql(q.POSTS, select=f"SELECT {POST_COLUMNS} FROM posts"))
def _(spark, sf):
    return P.flatten_search_page(search_pages(spark, sf))


def dump_lines(spark, sf) -> DataFrame:
    """The raw dump as text lines, with its header line."""
    body = text.sanitize_body(F.translate("text", "\n\r", "  "))
    lines = v.posts(spark, sf).select(F.concat_ws(
        ", ", "t_key", "writer", F.col("created").cast("string"), body, F.lit("0"),
        F.col("retweet_count").cast("string"), F.col("like_count").cast("string")).alias("value"))
    header = v.inline_table(spark, ("value",), ((",".join(POST_DUMP.fieldNames()),),))
    return lines.unionByName(header)


@query("s7_csv_line_split", sql(q.POSTS, select="""
  SELECT tweet_id, writer, created AS post_date,
    trim(replace(replace(translate(text, chr(10) || chr(13), '  '), ',', ''), '"', ''), ' ' || chr(9)) AS body,
    0 AS comment_num, retweet_count AS retweet_num, like_count AS like_num FROM posts"""))
def _(spark, sf):
    return files.split_lines(dump_lines(spark, sf), POST_DUMP, "tweet_id")


@query("p1_sanitize_body", sql(q.POSTS, select="""
  SELECT tweet_id, replace(replace(text, ',', ''), '"', '') AS body FROM posts"""))
def _(spark, sf):
    return v.posts(spark, sf).select("tweet_id", text.sanitize_body(F.col("text")).alias("body"))


@query("p2_parse_flatten_rename", sql(q.POSTS, select="""
  SELECT t_key, text, CAST(created AS VARCHAR) AS created, search_term FROM posts"""))
def _(spark, sf):
    return P.decode_posts(P.encode_posts(v.posts(spark, sf))).select("t_key", "text", "created", "search_term")


@query("p3_scored_post_layout", sql(q.POSTS, q.COMPOUND_CLEAN, select=f"""
  SELECT t_key, created, search_term, CAST(0 AS BIGINT) AS id, processed_text,
    round({q.WEIGHTED}, 4) AS polarity FROM cleaned JOIN compound USING (t_key)"""))
def _(spark, sf):
    return P.score_posts(v.posts(spark, sf), v.LEXICON).withColumn("polarity", F.round("polarity", 4))


@query("p4_positional_projection", sql(q.SCORED, select=f"""
  SELECT t_key, CAST({q.day_of('created')} AS VARCHAR) AS date, search_term, polarity FROM scored"""))
def _(spark, sf):
    rows = P.dated_polarity(v.scored(spark, sf), timeparse.day_of_epoch)
    return rows.withColumn("date", F.col("date").cast("string"))


@query("p5_ticker_normalize", sql(q.TICKERS, select="""
  SELECT line, CASE WHEN ticker_symbol = 'GOOGL' THEN 'GOOG' ELSE ticker_symbol END AS ticker FROM tickers"""))
def _(spark, sf):
    return v.tickers(spark, sf).select("line", enrich.normalize_ticker(F.col("ticker_symbol")).alias("ticker"))


@query("f1_clean_document", sql(q.POSTS, select=f"SELECT tweet_id, {q.clean('text')} AS clean FROM posts"))
def _(spark, sf):
    return v.posts(spark, sf).select("tweet_id", text.clean_document(F.col("text")).alias("clean"))


@query("f2_clean_without_stopwords", sql(q.POSTS, select=f"""
  SELECT tweet_id, array_to_string(list_filter(string_split(rtrim({q.clean('text')}), ' '),
    lambda x: x NOT IN ({q.stop_list()})), ' ') AS clean FROM posts"""))
def _(spark, sf):
    return v.posts(spark, sf).select(
        "tweet_id", text.clean_without_stopwords(F.col("text"), v.STOPWORDS).alias("clean"))


def _remove_class(name: str):
    pattern = text.REMOVAL_PATTERNS[name]
    # word boundaries are looked for once other characters are gone, as in the whole cleaning
    words = name in ("digits", "smallWords")
    source = "regexp_replace(text, '[^a-zA-Z0-9]', ' ', 'g')" if words else "text"

    @query(f"f3_remove_{name}", sql(q.POSTS, select=f"""
      SELECT tweet_id, regexp_replace({source}, '{pattern}', ' ', 'g') AS kept FROM posts"""))
    def _(spark, sf):
        given = text.remove_class(F.col("text"), "punctuation") if words else F.col("text")
        return v.posts(spark, sf).select("tweet_id", text.remove_class(given, name).alias("kept"))


for _name in text.REMOVAL_PATTERNS:
    _remove_class(_name)


@query("f4_alphabetic_words", sql(q.POSTS, select=rf"""
  SELECT tweet_id, array_to_string(list_filter(regexp_extract_all(text, '([\p{{L}}\p{{N}}_]+)'),
    lambda x: regexp_matches(x, '^\p{{L}}+$') AND x NOT IN ({q.stop_list()})), ' ') AS words FROM posts"""))
def _(spark, sf):
    return v.posts(spark, sf).select("tweet_id", text.alphabetic_words(F.col("text"), v.STOPWORDS).alias("words"))


@query("f4_word_tokens", sql(q.POSTS, rf"""split_up AS (
  SELECT tweet_id, regexp_extract_all(regexp_replace(regexp_replace(text, '([;@#$%&?!()\[\]{{}}<>"“”…]|--|``|'''')', ' \1 ', 'g'),
    '([:,])([^0-9]|$)', ' \1 \2', 'g'), '[^\s]+') AS w FROM posts),
tokens AS (
  SELECT tweet_id, i, w[i] AS t, w[i + 1] AS after FROM (SELECT tweet_id, w, unnest(range(1, len(w) + 1)) AS i FROM split_up)),
bare AS (
  SELECT tweet_id, i, regexp_replace(CASE WHEN t LIKE '%.' AND (after IS NULL OR regexp_matches(after, '^[\p{{Lu}}"''(“]')) THEN t[:-2]
    ELSE t END, '(?i)^(\p{{L}}+?)(n''t|''s|''m|''d|''ll|''re|''ve)$', '\1') AS t FROM tokens),
words AS (
  SELECT tweet_id, i, unnest(regexp_extract_all(regexp_replace(t, '(?i)^(?:(can)(not)|(gon|wan)(na)|(got)(ta)|(lem|gim)(me))$',
    '\1\3\5\7 \2\4\6\8'), '[^\s]+')) AS t FROM bare),
kept AS (
  SELECT tweet_id, string_agg(t, ' ' ORDER BY i) AS words FROM words
  WHERE regexp_matches(t, '^\p{{L}}+$') AND t NOT IN ({q.stop_list()}) GROUP BY 1)""", select="""
  SELECT tweet_id, CASE WHEN text IS NOT NULL THEN coalesce(words, '') END AS words FROM posts LEFT JOIN kept USING (tweet_id)"""))
def _(spark, sf):
    return v.posts(spark, sf).select("tweet_id", text.alphabetic_tokens(F.col("text"), v.STOPWORDS).alias("words"))


@query("f5_sentiment_clean", sql(q.POSTS, q.COMPOUND_CLEAN, select="SELECT t_key, compound FROM compound"))
def _(spark, sf):
    return v.posts(spark, sf).select("t_key", sentiment.score_words(
        text.clean_words(F.col("text")), v.LEXICON).alias("compound"))


@query("f5_sentiment_raw", sql(q.POSTS, q.COMPOUND_RAW, select="SELECT t_key, compound FROM compound"))
def _(spark, sf):
    return v.posts(spark, sf).select("t_key", sentiment.score_raw(F.col("text"), v.LEXICON).alias("compound"))


@query("f5_sentiment_lexicon_table",
       sql(q.POSTS, q.COMPOUND_CLEAN, select="SELECT t_key, compound FROM compound"))
def _(spark, sf):
    rows = tuple((w, x, b, n) for w, x, b, n in v.LEXICON.rows())
    lexicon = v.inline_table(spark, ("word", "valence", "boost", "negates"), rows)
    clean = v.posts(spark, sf).select("t_key", text.clean_document(F.col("text")).alias("clean"))
    return sentiment.score_with_table(clean, "t_key", "clean", lexicon)


@query("f6_weighted_polarity", sql(q.POSTS, q.COMPOUND_CLEAN, select=f"""
  SELECT t_key, round({q.WEIGHTED}, 4) AS polarity FROM posts JOIN compound USING (t_key)"""))
def _(spark, sf):
    return P.score_posts(v.posts(spark, sf), v.LEXICON).select("t_key", F.round("polarity", 4).alias("polarity"))


@query("m1_functions_by_name", sql(q.POSTS, q.COMPOUND_CLEAN, select=f"""
  SELECT t_key, processed_text, round({q.WEIGHTED}, 4) AS polarity FROM cleaned JOIN compound USING (t_key)"""))
def _(spark, sf):
    register_functions(spark, v.LEXICON)
    return spark.sql("""
      select t_key, processed_text,
        round(computePolarity(processed_text, like_count, retweet_count, followers_count), 4) as polarity
      from (select *, cleanTextUdf(text) as processed_text from {posts})""", posts=v.posts(spark, sf))


@query("e4_dashboard_sql", sql(q.SCORED, select="SELECT created AS seconds, polarity FROM scored"))
def _(spark, sf):
    register_functions(spark, v.LEXICON)
    tweets = v.scored(spark, sf).withColumn("created", iso_text(F.col("created")))
    series = spark.sql("""
      SELECT STR_TO_DATE(created, '%Y-%m-%dT%H:%i:%sZ') AS time, polarity FROM {tweets} ORDER BY created""",
      tweets=tweets)
    return series.select(F.unix_seconds("time").alias("seconds"), "polarity")


FLAGS = f"""{q.LABEL} AS sentiment,
  CASE WHEN compound > 0.05 THEN 1.0::DOUBLE ELSE 0 END AS positive,
  CASE WHEN compound < -0.05 THEN 1.0::DOUBLE ELSE 0 END AS negative,
  CASE WHEN compound BETWEEN -0.05 AND 0.05 THEN 1.0::DOUBLE ELSE 0 END AS neutral"""


@query("f7_sentiment_label", sql(q.POSTS, q.COMPOUND_RAW, select=f"SELECT t_key, compound, {FLAGS} FROM compound"))
def _(spark, sf):
    return P.with_compound(v.posts(spark, sf), v.LEXICON).select(
        "t_key", "compound", "sentiment", "positive", "negative", "neutral")


@query("u2_scores_beside_posts", sql(q.POSTS, q.COMPOUND_CLEAN, select=f"""
  SELECT t_key, writer, text, compound, {FLAGS} FROM posts JOIN compound USING (t_key)"""))
def _(spark, sf):
    return P.with_compound(v.posts(spark, sf), v.LEXICON, raw=False).select(
        "t_key", "writer", "text", "compound", "sentiment", "positive", "negative", "neutral")


@query("f8_sign_label", sql(q.SCORED, select="""
  SELECT t_key, CASE WHEN polarity > 0 THEN 'positive' WHEN polarity < 0 THEN 'negative'
    WHEN polarity = 0 THEN 'neutral' END AS label FROM scored"""))
def _(spark, sf):
    return v.scored(spark, sf).select("t_key", sentiment.sign_label(F.col("polarity")).alias("label"))


@query("f9_hashtag_marks", sql(q.POSTS, select="""
  SELECT t_key, length(text) - length(replace(text, '#', '')) AS tags FROM posts"""))
def _(spark, sf):
    return v.posts(spark, sf).select("t_key", text.hashtag_marks(F.col("text")).cast("bigint").alias("tags"))


@query("f10_epoch_to_date", sql(q.SCORED, select=f"""
  SELECT t_key, strftime(make_timestamp(created * 1000000), '%Y-%m-%d %H:%M:%S') AS ts,
    CAST({q.day_of('created')} AS VARCHAR) AS date FROM scored"""))
def _(spark, sf):
    s = v.scored(spark, sf)
    return s.select("t_key", F.date_format(F.timestamp_seconds("created"), "yyyy-MM-dd HH:mm:ss").alias("ts"),
                    timeparse.day_of_epoch(F.col("created")).cast("string").alias("date"))


@query("f11_epoch_to_day_string", sql(q.POSTS, select="""
  SELECT tweet_id, strftime(make_timestamp(created * 1000000), '%Y-%m-%d') AS day_date FROM posts"""))
def _(spark, sf):
    return v.posts(spark, sf).select("tweet_id", timeparse.day_string(F.col("created")).alias("day_date"))


ISO = "strftime(make_timestamp(created * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


def iso_text(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


@query("f12_iso_to_timestamp", sql(q.SCORED, select="SELECT t_key, created AS seconds FROM scored"))
def _(spark, sf):
    return v.scored(spark, sf).select(
        "t_key", F.unix_seconds(timeparse.parse_iso(iso_text(F.col("created")))).alias("seconds"))


@query("f13_parse_created", sql(q.SCORED, select="""
  SELECT t_key, CASE WHEN search_term = 'GOOG' THEN NULL ELSE created END AS seconds FROM scored"""))
def _(spark, sf):
    seconds, term = F.col("created"), F.col("search_term")
    # the three encodings, and one that is none of them
    provider = F.concat(F.lit("Thu "), F.date_format(F.timestamp_seconds(seconds), "MMM dd HH:mm:ss Z yyyy"))
    written = (F.when(term == "GOOG", F.concat(F.lit("on "), seconds.cast("string")))
               .when(term == "TSLA", seconds.cast("string")).when(term == "AMZN", iso_text(seconds))
               .otherwise(provider))
    return v.scored(spark, sf).select("t_key", F.unix_seconds(timeparse.parse_created(written)).alias("seconds"))


@query("f14_days_passed", sql(q.SCORED, select=f"""
  SELECT t_key, CAST(date_diff('day', DATE '2015-01-01', {q.day_of('created')}) AS BIGINT) AS day_passed
  FROM scored"""))
def _(spark, sf):
    day = timeparse.day_of_epoch(F.col("created"))
    return v.scored(spark, sf).select("t_key", timeparse.days_passed(day).cast("bigint").alias("day_passed"))


@query("f15_year", sql(q.POSTS, select=f"""
  SELECT tweet_id, CAST(year({q.day_of('created')}) AS BIGINT) AS year FROM posts"""))
def _(spark, sf):
    day = timeparse.day_of_epoch(F.col("created"))
    return v.posts(spark, sf).select("tweet_id", timeparse.year_of(day).cast("bigint").alias("year"))


@query("f16_joined_row", sql(q.SCORED, select="""
  SELECT t_key, t_key || ',' || CAST(created AS VARCHAR) || ',' || search_term || ','
    || CASE WHEN polarity IS NULL THEN '' WHEN polarity = 0 THEN 'zero' ELSE 'set' END || ','
    || processed_text AS line FROM scored"""))
def _(spark, sf):
    state = F.when(F.col("polarity") == 0, "zero").when(F.col("polarity").isNotNull(), "set")
    line = text.joined_row(F.col("t_key"), F.col("created"), F.col("search_term"), state, F.col("processed_text"))
    return v.scored(spark, sf).select("t_key", line.alias("line"))


@query("a18_word_counts", sql(q.POSTS, select=f"""
  SELECT word, CAST(count(*) AS BIGINT) AS count
  FROM (SELECT unnest(string_split({q.clean('text')}, ' ')) AS word FROM posts) WHERE word <> '' GROUP BY word"""))
def _(spark, sf):
    return P.word_counts(v.posts(spark, sf).select(text.clean_document(F.col("text")).alias("text")))


@query("a19_trending_hashtags", sql(q.POSTS, select=r"""
  SELECT label, CAST(count(*) AS BIGINT) AS mentions
  FROM (SELECT unnest(regexp_extract_all(text, '#(\w+)', 1)) AS label FROM posts)
  GROUP BY label ORDER BY mentions DESC, label LIMIT 10"""))
def _(spark, sf):
    return P.trending_hashtags(v.posts(spark, sf))
