"""Price series: indicators, targets, splits, and the files they are kept in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerpulse.operators import dashboards as D
from tickerpulse.operators import enrich as J
from tickerpulse.operators import indicators as I
from tickerpulse.operators import rollup
from tickerpulse.plans import classifiers, joint, models, training
from tickerpulse.schemas import INSTRUMENTS, struct_of
from tickerpulse.session import cut_lineage, scratch_path
from tickerpulse.sources import files
from pyspark.sql import types as T

from . import sql as q
from . import views as v
from .registry import query
from .report_queries import MERGED_CTES, daily_out, merged, DAILY_OUT
from .sql import with_ctes as sql

ORDERED = """numbered AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY dt) - 1 AS rn,
  count(*) OVER (PARTITION BY symbol) AS n FROM prices)"""

# the recurrences row by row
RECURRENCE = """seq AS (
  SELECT symbol, dt, rn, close, close AS e12, close AS e26, close AS e20, 0.0::DOUBLE AS macd, 0.0::DOUBLE AS signal
  FROM numbered WHERE rn = 0
  UNION ALL
  SELECT symbol, dt, rn, close, e12, e26, e20, e12 - e26, signal * (1 - 2.0::DOUBLE / 10) + (e12 - e26) * (2.0::DOUBLE / 10)
  FROM (SELECT n.symbol, n.dt, n.rn, n.close, s.signal,
      s.e12 * (1 - 2.0::DOUBLE / 13) + n.close * (2.0::DOUBLE / 13) AS e12,
      s.e26 * (1 - 2.0::DOUBLE / 27) + n.close * (2.0::DOUBLE / 27) AS e26,
      s.e20 * (1 - 2.0::DOUBLE / 21) + n.close * (2.0::DOUBLE / 21) AS e20
    FROM seq s JOIN numbered n ON n.symbol = s.symbol AND n.rn = s.rn + 1))"""

SMA = """CASE WHEN count(close) OVER w30 = 30 THEN avg(close) OVER w30 END"""
MOVES = """moves AS (SELECT *, close - lag(close) OVER (PARTITION BY symbol ORDER BY dt) AS delta FROM numbered),
means AS (SELECT *, CASE WHEN count(delta) OVER w = 14 THEN avg(greatest(delta, 0)) OVER w END AS gain,
  CASE WHEN count(delta) OVER w = 14 THEN abs(avg(least(delta, 0)) OVER w) END AS loss FROM moves
  WINDOW w AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
rsi AS (SELECT symbol, dt, CASE WHEN loss = 0 THEN CASE WHEN gain > 0 THEN 100.0::DOUBLE END
  ELSE 100.0::DOUBLE - 100.0::DOUBLE / (1 + gain / loss) END AS rsi FROM means)"""
W30 = "WINDOW w30 AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"


def dated(df: DataFrame, *rounded: str, day: str = "dt") -> DataFrame:
    out = df.withColumn(day, F.col(day).cast("string"))
    return out.withColumns({c: F.round(c, 4) + F.lit(0.0) for c in rounded}) if rounded else out


@query("p12_derived_prices", sql(q.PRICES, q.VALUES, select="""
  SELECT ticker_symbol, CAST(day_date AS VARCHAR) AS day_date, round(high_value - low_value, 2) AS fluctuation,
    round(close_value - open_value, 2) AS price_gain, round(volume * close_value, 2) AS total_valuation
  FROM cvalues"""))
def _(spark, sf):
    out = J.derived_prices(v.company_values(spark, sf))
    return out.select("ticker_symbol", F.col("day_date").cast("string").alias("day_date"),
                      F.round("fluctuation", 2).alias("fluctuation"), F.round("price_gain", 2).alias("price_gain"),
                      F.round("total_valuation_EOD", 2).alias("total_valuation"))


@query("w1_sma", sql(q.PRICES, ORDERED, select=f"""
  SELECT symbol, CAST(dt AS VARCHAR) AS dt, round({SMA}, 4) AS SMA FROM numbered {W30}"""))
def _(spark, sf):
    return dated(I.with_sma(v.prices(spark, sf)).select("symbol", "dt", "SMA"), "SMA")


@query("w2_ema", sql(q.PRICES, ORDERED, RECURRENCE, recursive=True, select="""
  SELECT symbol, CAST(dt AS VARCHAR) AS dt, round(e20, 4) AS EMA FROM seq"""))
def _(spark, sf):
    return dated(I.with_ema(v.prices(spark, sf), {"EMA": 20}).select("symbol", "dt", "EMA"), "EMA")


@query("w3_macd", sql(q.PRICES, ORDERED, RECURRENCE, recursive=True, select="""
  SELECT symbol, CAST(dt AS VARCHAR) AS dt, round(macd, 4) + 0.0 AS MACD, round(signal, 4) + 0.0 AS Signal_Line
  FROM seq"""))
def _(spark, sf):
    out = I.with_macd(v.prices(spark, sf)).select("symbol", "dt", "MACD", "Signal_Line")
    return dated(out, "MACD", "Signal_Line")


@query("w4_rsi", sql(q.PRICES, ORDERED, MOVES, select="""
  SELECT symbol, CAST(dt AS VARCHAR) AS dt, round(rsi, 4) AS RSI FROM rsi"""))
def _(spark, sf):
    return dated(I.with_rsi(v.prices(spark, sf)).select("symbol", "dt", "RSI"), "RSI")


@query("w5_target", sql(q.PRICES, select="""
  SELECT symbol, CAST(dt AS VARCHAR) AS dt,
    CAST(CASE WHEN lead(close, 7) OVER (PARTITION BY symbol ORDER BY dt) > close THEN 1 ELSE 0 END AS BIGINT) AS Target
  FROM prices"""))
def _(spark, sf):
    out = I.with_target(v.prices(spark, sf))
    return dated(out.select("symbol", "dt", F.col("Target").cast("bigint").alias("Target")))


@query("w6_close_delta", sql(q.PRICES, q.VALUES, select="""
  SELECT ticker_symbol, CAST(day_date AS VARCHAR) AS day_date, round(coalesce(close_value
    - lag(close_value) OVER (PARTITION BY ticker_symbol ORDER BY day_date), 0), 4) + 0.0 AS delta_close_value
  FROM cvalues"""))
def _(spark, sf):
    out = I.with_delta(v.company_values(spark, sf), "close_value", "ticker_symbol", "day_date")
    return dated(out.select("ticker_symbol", "day_date", "delta_close_value"), "delta_close_value", day="day_date")


SPLIT = "CASE WHEN rn < floor(0.8::DOUBLE * n) THEN 'training' ELSE 'testing' END"


@query("w7_chronological_split", sql(q.PRICES, ORDERED, select=f"""
  SELECT symbol, CAST(dt AS VARCHAR) AS dt, {SPLIT} AS split FROM numbered"""))
def _(spark, sf):
    return dated(I.with_split(v.prices(spark, sf)).select("symbol", "dt", "split"))


@query("w8_row_index", sql(q.PRICES, ORDERED, select="""
  SELECT symbol, CAST(dt AS VARCHAR) AS dt, CAST(rn AS BIGINT) AS "Index" FROM numbered"""))
def _(spark, sf):
    return dated(I.with_index(v.prices(spark, sf)).select("symbol", "dt", F.col("Index").cast("bigint").alias("Index")))


# the reference ranges, moved to the years the test prices cover
BUILD, VERIFY = ("1995-06-01", "2000-12-24"), ("2000-12-24", "2001-06-29")

FRAME = f"""sma AS (SELECT symbol, dt, {SMA} AS sma FROM numbered {W30}),
complete AS (SELECT symbol, dt, s.close, macd, signal, rsi, sma, e20
  FROM seq s JOIN rsi USING (symbol, dt) JOIN sma USING (symbol, dt)
  WHERE rsi IS NOT NULL AND sma IS NOT NULL),
labelled AS (SELECT *, CASE WHEN lead(close, 7) OVER (PARTITION BY symbol ORDER BY dt) > close THEN 1 ELSE 0 END
  AS target FROM complete)"""
FRAME_CTES = (q.PRICES, ORDERED, RECURRENCE, MOVES, FRAME)
FRAME_OUT = """symbol, CAST(dt AS VARCHAR) AS dt, round(close, 4) AS close, round(macd, 4) + 0.0 AS MACD,
  round(signal, 4) + 0.0 AS Signal_Line, round(rsi, 4) AS RSI, round(sma, 4) AS SMA, round(e20, 4) AS EMA,
  CAST(target AS BIGINT) AS Target"""


def frame_out(df: DataFrame) -> DataFrame:
    return dated(df, *I.FEATURES).withColumn("Target", F.col("Target").cast("bigint"))


@query("w9_feature_frame", sql(*FRAME_CTES, recursive=True, select=f"""
  SELECT {FRAME_OUT} FROM labelled WHERE dt >= DATE '{BUILD[0]}' AND dt < DATE '{BUILD[1]}'"""))
def _(spark, sf):
    return frame_out(training.build_set(training.labelled_frame(v.prices(spark, sf)), BUILD))


@query("w9_verification_set", sql(*FRAME_CTES, recursive=True, select=f"""
  SELECT {FRAME_OUT}, CAST(row_number() OVER (PARTITION BY symbol ORDER BY dt) - 1 AS BIGINT) AS "Index"
  FROM labelled WHERE dt >= DATE '{VERIFY[0]}' AND dt < DATE '{VERIFY[1]}'"""))
def _(spark, sf):
    out = training.verification_set(cut_lineage(training.labelled_frame(v.prices(spark, sf))), VERIFY)
    return frame_out(out).withColumn("Index", F.col("Index").cast("bigint"))


@query("p9_date_range", sql(q.PRICES, select=f"""
  SELECT symbol, CAST(dt AS VARCHAR) AS dt, close FROM prices
  WHERE dt >= DATE '{VERIFY[0]}' AND dt < DATE '{VERIFY[1]}'"""))
def _(spark, sf):
    return dated(I.between_days(v.prices(spark, sf), *VERIFY).select("symbol", "dt", "close"))


@query("p11_drop_incomplete", sql(q.SCORED, select="SELECT t_key, polarity FROM scored WHERE polarity IS NOT NULL"))
def _(spark, sf):
    return I.drop_incomplete(v.scored(spark, sf)).select("t_key", "polarity")


@query("p14_feature_columns", sql(q.PRICES, select="SELECT close, volume FROM prices"))
def _(spark, sf):
    return v.prices(spark, sf).select("close", "volume")


# files -------------------------------------------------------------------------------------

@query("s8_csv_directory", sql(q.SCORED, select="SELECT * FROM scored"))
def _(spark, sf):
    path = scratch_path(spark, "scored")
    s = v.scored(spark, sf)
    files.write_scored_posts(D.term_is(s, "TSLA"), f"{path}/a/b")
    files.write_scored_posts(s.where(F.col("search_term") != "TSLA"), f"{path}/c")
    return files.read_scored_posts(spark, path).withColumn("created", F.col("created").cast("bigint"))


PRICE_FILE = struct_of(("dt", T.DateType()), ("open", T.DoubleType()), ("high", T.DoubleType()),
                     ("low", T.DoubleType()), ("close", T.DoubleType()), ("volume", T.LongType()))


@query("s9_symbol_files", sql(q.PRICES, select="SELECT * REPLACE (CAST(dt AS VARCHAR) AS dt) FROM prices"))
def _(spark, sf):
    path = scratch_path(spark, "bars")
    v.prices(spark, sf).select("symbol", *PRICE_FILE.fieldNames()).write.partitionBy("symbol").option(
        "header", True).csv(path)
    return dated(files.read_symbol_files(spark, path, PRICE_FILE, files.SYMBOL_FOLDER))


DAILY = sql(q.SCORED, f"d AS ({q.daily('scored')})", select=f"SELECT {DAILY_OUT} FROM d")
DAILY_FULL = sql(q.SCORED, f"d AS ({q.daily('scored')})", select=f"SELECT {DAILY_OUT} FROM d WHERE agg_polarity IS NOT NULL")


@query("s10_latest_rollup", DAILY_FULL)
def _(spark, sf):
    path = scratch_path(spark, "rollups")
    d = rollup.daily_polarity(v.scored(spark, sf))
    files.write_daily_polarity(d.withColumn("count", F.lit(0).cast("bigint")), f"{path}/run=1")
    files.write_daily_polarity(d, f"{path}/run=2")
    return daily_out(files.read_daily_polarity(spark, path, latest_only=True))


@query("s15_rollup_csv", DAILY_FULL)
def _(spark, sf):
    path = scratch_path(spark, "rollup")
    files.write_daily_polarity(rollup.daily_polarity(v.scored(spark, sf)), path)
    return daily_out(files.read_daily_polarity(spark, path))


@query("s16_split_files", sql(*MERGED_CTES, """placed AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY dt) - 1 AS rn, count(*) OVER (PARTITION BY symbol) AS n
  FROM merged)""", select=f"""
  SELECT symbol, {SPLIT} AS split, CAST(dt AS VARCHAR) AS dt, close, count FROM placed"""))
def _(spark, sf):
    path = scratch_path(spark, "merged")
    rows = cut_lineage(merged(spark, sf))
    files.write_split(I.with_split(rows).select("split", "symbol", "dt", "close", "count"), path)
    schema = "dt date, close double, count bigint, split string, symbol string"
    return dated(spark.read.schema(schema).option("header", True).csv(path))


@query("s18_mock_polarity", sql(q.PRICES, select="""
  SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS whole_0_to_5, CAST(6 AS BIGINT) AS kinds
  FROM prices"""))
def _(spark, sf):
    p = F.col("Polarity")
    mocked = files.with_mock_polarity(v.prices(spark, sf), KEYS, seed=7)
    return mocked.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(p.between(0, 5) & (p == F.floor(p))).alias("whole_0_to_5"),
        F.count_distinct(p).alias("kinds"))


@query("s8_parquet_days", sql(q.SCORED, select=f"""
  SELECT t_key, search_term, polarity FROM scored
  WHERE {q.day_of('created')} BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""))
def _(spark, sf):
    path = scratch_path(spark, "scored-days")
    files.write_scored_table(v.scored(spark, sf).withColumn("created", F.col("created").cast("string")), path)
    return files.read_scored_table(spark, path, "2024-01-05", "2024-01-20").select("t_key", "search_term", "polarity")


# classifiers -------------------------------------------------------------------------------

KEYS = ("symbol", "dt")
SYMBOLS = tuple(v.PRICE_SYMBOLS.values())


def frames(spark, sf):
    frame = cut_lineage(training.labelled_frame(v.prices(spark, sf)))
    return training.build_set(frame, BUILD), training.verification_set(frame, VERIFY)


@query("m2_min_max_scaling", sql(q.PRICES, select="""
  SELECT symbol, CAST(dt AS VARCHAR) AS dt,
    round((close - min(close) OVER ()) / (max(close) OVER () - min(close) OVER ()), 6) AS close,
    round((volume - min(volume) OVER ()) / CAST(max(volume) OVER () - min(volume) OVER () AS DOUBLE), 6) AS volume
  FROM prices"""))
def _(spark, sf):
    from pyspark.ml.feature import MinMaxScaler
    from pyspark.ml.functions import vector_to_array

    rows = models.with_features(v.prices(spark, sf), ("close", "volume"))
    scaled = MinMaxScaler(inputCol="features", outputCol="scaled").fit(rows).transform(rows)
    x = vector_to_array(F.col("scaled"))
    return scaled.select("symbol", F.col("dt").cast("string").alias("dt"),
                         F.round(x[0], 6).alias("close"), F.round(x[1], 6).alias("volume"))


M2_COLUMNS = ("close", "volume")


@query("m2_scaling_per_fold", sql(q.PRICES, ORDERED, """placed AS (SELECT *, CAST(rn % 5 AS BIGINT) AS fold FROM numbered),
folds AS (SELECT DISTINCT symbol, fold FROM placed),
ranges AS (
  SELECT f.symbol, f.fold AS without, min(close) AS lo_c, max(close) AS hi_c, min(volume) AS lo_v, max(volume) AS hi_v
  FROM folds f JOIN placed p ON p.symbol = f.symbol AND p.fold <> f.fold GROUP BY 1, 2)""", select="""
  SELECT p.symbol, CAST(dt AS VARCHAR) AS dt, fold, without, round((close - lo_c) / (hi_c - lo_c), 6) AS close,
    round((volume - lo_v) / CAST(hi_v - lo_v AS DOUBLE), 6) AS volume
  FROM placed p JOIN ranges r ON r.symbol = p.symbol"""))
def _(spark, sf):
    placed = cut_lineage(I.with_index(v.prices(spark, sf)).select(
        "symbol", "dt", *M2_COLUMNS, (F.col("Index") % 5).cast("bigint").alias("fold")))
    out = joint.scaled_per_fold(placed, "symbol", "fold", M2_COLUMNS)
    return dated(out.select("symbol", "dt", "fold", "without", *[F.round(c, 6).alias(c) for c in M2_COLUMNS]))


def _one_family(name: str, family: str) -> None:
    @query(name)
    def _(spark, sf):
        build, verify = frames(spark, sf)
        fitted = classifiers.train_all(build, KEYS, (family,), SYMBOLS)
        out = classifiers.predict_long(verify, fitted)
        return dated(out.select("symbol", "dt", "model_symbol", "family", "prediction", "Target"))


_one_family("m3_logistic_regression", "lg")
_one_family("m4_rbf_svm", "svm")
_one_family("m5_decision_tree", "dt")


@query("m6_grid_search")
def _(spark, sf):
    build, _ = frames(spark, sf)
    return v.inline_table(spark, ("symbol", "family", "setting", "accuracy"),
                          tuple(classifiers.grid_table(build, KEYS, symbols=SYMBOLS)))


@query("m7_nested_accuracy")
def _(spark, sf):
    build, _ = frames(spark, sf)
    return v.inline_table(spark, ("symbol", "family", "fold", "setting", "accuracy"),
                          tuple(classifiers.nested_table(build, KEYS, symbols=SYMBOLS)))


@query("m8_folds", sql(q.PRICES, ORDERED, select="""
  SELECT symbol, CAST(rn % 5 AS BIGINT) AS fold, CAST(count(*) AS BIGINT) AS n FROM numbered GROUP BY 1, 2"""))
def _(spark, sf):
    placed = I.with_index(v.prices(spark, sf)).withColumn("fold", F.col("Index") % 5)
    return placed.groupBy("symbol", F.col("fold").cast("bigint").alias("fold")).agg(F.count(F.lit(1)).alias("n"))


@query("m8_hash_folds", sql(q.PRICES, select="""
  SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS out_of_range, CAST(5 AS BIGINT) AS folds FROM prices"""))
def _(spark, sf):
    rows = models.with_folds(v.prices(spark, sf), KEYS)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("fold").between(0, 4)).alias("out_of_range"),
                    F.count_distinct("fold").alias("folds"))


@query("m9_saved_models", sql(*FRAME_CTES, f"""models AS (
  SELECT symbol AS model_symbol, family FROM (SELECT DISTINCT symbol FROM prices), (VALUES ('lg'), ('svm'), ('dt')) AS f(family)),
verify AS (SELECT count(*) AS n FROM labelled WHERE dt >= DATE '{VERIFY[0]}' AND dt < DATE '{VERIFY[1]}')""",
    recursive=True, select="""
  SELECT model_symbol, family, CAST(n AS BIGINT) AS n, CAST(n AS BIGINT) AS same FROM models, verify"""))
def _(spark, sf):
    # the loaded models have to predict what the fitted ones do
    build, verify = frames(spark, sf)
    path = scratch_path(spark, "models")
    fitted = classifiers.train_all(build, KEYS, symbols=SYMBOLS)
    classifiers.save_models(spark, fitted, path)
    loaded = classifiers.load_models(spark, path)
    key = ["symbol", "dt", "model_symbol", "family"]
    before = classifiers.predict_long(verify, fitted).select(*key, "prediction")
    after = classifiers.predict_long(verify, loaded).select(*key, F.col("prediction").alias("again"))
    return before.join(after, key).groupBy("model_symbol", "family").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") == F.col("again")).alias("same"))


@query("m10_predictions_of_all_models")
def _(spark, sf):
    build, verify = frames(spark, sf)
    fitted = classifiers.train_all(build, KEYS, symbols=SYMBOLS)
    terms = {row[0]: row[2] for row in INSTRUMENTS if row[0]}
    nested = classifiers.predict_nested(verify, fitted, terms)
    return dated(nested.select("symbol", "dt", "Index", "Target",
                               F.to_json("stock_predictions").alias("stock_predictions")))


@query("m11_row_by_index", sql(*FRAME_CTES, f"""verify AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY dt) - 1 AS ix FROM labelled
  WHERE dt >= DATE '{VERIFY[0]}' AND dt < DATE '{VERIFY[1]}')""", recursive=True, select=f"""
  SELECT {FRAME_OUT}, CAST(ix AS BIGINT) AS "Index" FROM verify WHERE ix = 17"""))
def _(spark, sf):
    _, verify = frames(spark, sf)
    return frame_out(models.rows_at(verify, 17)).withColumn("Index", F.col("Index").cast("bigint"))


@query("m12_accuracy", sql(q.PRICES, ORDERED, """marked AS (
  SELECT symbol, CASE WHEN lead(close, 7) OVER (PARTITION BY symbol ORDER BY dt) > close THEN 1 ELSE 0 END AS target,
    CASE WHEN close > open THEN 1 ELSE 0 END AS guess FROM prices)""", select="""
  SELECT symbol AS model_symbol, 'up' AS family, round(avg(CASE WHEN guess = target THEN 1.0::DOUBLE ELSE 0 END), 6)
    AS accuracy FROM marked GROUP BY symbol"""))
def _(spark, sf):
    rows = I.with_target(v.prices(spark, sf)).select(
        F.col("symbol").alias("model_symbol"), F.lit("up").alias("family"), "Target",
        F.when(F.col("close") > F.col("open"), 1).otherwise(0).alias("prediction"))
    return models.accuracy(rows).withColumn("accuracy", F.round("accuracy", 6))


@query("m12_model_accuracy")
def _(spark, sf):
    build, verify = frames(spark, sf)
    fitted = classifiers.train_all(build, KEYS, symbols=SYMBOLS)
    return models.accuracy(classifiers.predict_long(verify, fitted))
