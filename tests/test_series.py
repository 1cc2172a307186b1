import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerpulse.operators import eda
from tickerpulse.operators import indicators as I
from tickerpulse.operators import series
from tickerpulse.plans import training

DAY0 = dt.date(2015, 1, 1)


def prices(spark, data: dict, gap=1):
    rows = [(s, DAY0 + dt.timedelta(days=i * gap), None if c is None else float(c))
            for s, closes in data.items() for i, c in enumerate(closes)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "symbol string, dt date, close double")


def walk(n, seed=0):
    return (100 + np.random.default_rng(seed).normal(0, 1, n).cumsum()).round(2).tolist()


def column(df, name, symbol):
    return [r[name] for r in df.where(F.col("symbol") == symbol).orderBy("dt").collect()]


def same(got, want, tol=1e-9):
    got = np.array([np.nan if x is None else x for x in got], dtype=float)
    np.testing.assert_allclose(got, np.asarray(want, dtype=float), rtol=tol, atol=tol)


def pandas_rsi(c, n=14):
    d = c.diff()
    gain, loss = d.clip(lower=0).rolling(n).mean(), d.clip(upper=0).rolling(n).mean().abs()
    return 100 - 100 / (1 + gain / loss)


@pytest.mark.parametrize("chunk", [8192, 100, 37])
def test_indicators_equal_pandas(spark, chunk):
    # one symbol far longer than the others, cut into many chunks when they are short
    data = {"HOT": walk(900), "B": walk(60, 1), "C": walk(13, 2)}
    df = prices(spark, data).repartition(3)
    sma, rsi = I.with_sma(df, chunk=chunk), I.with_rsi(df, chunk=chunk)
    ema, macd = I.with_ema(df, {"EMA": 20}, chunk=chunk), I.with_macd(df, chunk=chunk)
    for symbol, closes in data.items():
        c = pd.Series(closes)
        same(column(sma, "SMA", symbol), c.rolling(30).mean())
        same(column(ema, "EMA", symbol), c.ewm(span=20, adjust=False).mean())
        line = c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()
        same(column(macd, "MACD", symbol), line)
        same(column(macd, "Signal_Line", symbol), line.ewm(span=9, adjust=False).mean())
        same(column(rsi, "RSI", symbol), pandas_rsi(c), 1e-7)


@pytest.mark.parametrize("spans", [(3, 200), (1, 26), (2, 500), (1,)])
def test_mixed_spans(spark, spans):
    data = {"A": walk(2500, 5)}
    out = I.with_ema(prices(spark, data), {f"E{s}": s for s in spans}, chunk=700)
    for span in spans:
        same(column(out, f"E{span}", "A"), pd.Series(data["A"]).ewm(span=span, adjust=False).mean())


@pytest.mark.parametrize("first", [1e5, 1e20])
def test_means_of_a_series_that_falls_far(spark, first):
    closes = [first] + [1e-4] * 5000
    df = prices(spark, {"A": closes})
    out = I.with_ema(df, {"E2": 2, "E20": 20}, chunk=256)
    for span in (2, 20):
        want = [first]
        for x in closes[1:]:
            want.append(x * 2 / (span + 1) + want[-1] * (1 - 2 / (span + 1)))
        np.testing.assert_allclose(column(out, f"E{span}", "A"), want, rtol=1e-9)


def test_flat_and_rising_series(spark):
    df = prices(spark, {"FLAT": [5] * 60, "UP": range(1, 61), "SHORT": range(13)})
    out = I.with_rsi(df)
    assert column(out, "RSI", "FLAT") == [None] * 60
    assert column(out, "RSI", "UP") == [None] * 14 + [100.0] * 46
    assert column(out, "RSI", "SHORT") == [None] * 13


@pytest.mark.parametrize("chunk", [8192, 10])
def test_target_and_delta(spark, chunk):
    data = {"A": walk(45), "B": [1, 2, 3]}
    df = prices(spark, data)
    target, delta = I.with_target(df, chunk=chunk), I.with_delta(df, chunk=chunk)
    for s, closes in data.items():
        c = pd.Series(closes)
        assert column(target, "Target", s) == list(np.where(c.shift(-7) > c, 1, 0))
        same(column(delta, "delta_close_value", s), c.diff().fillna(0))


def test_split_sizes(spark):
    df = prices(spark, {"N1": [1], "N4": range(4), "N5": range(5), "N9": range(9)})
    out = I.with_split(df)
    train = {s: column(out, "split", s).count("training") for s in ("N1", "N4", "N5", "N9")}
    assert train == {"N1": 0, "N4": 3, "N5": 4, "N9": 7}
    assert column(out, "split", "N5") == ["training"] * 4 + ["testing"]


def test_index(spark):
    out = I.with_index(prices(spark, {"A": range(70), "B": range(2)}, gap=20))
    assert column(out, "Index", "A") == list(range(70)) and column(out, "Index", "B") == [0, 1]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 500)), min_size=1, max_size=120, unique=True),
       st.integers(1, 50))
def test_numbering_equals_a_plain_sort(spark, pairs, width):
    df = spark.createDataFrame(pairs, "k string, x int")
    out = series.number_rows(df, ["k"], ["x"], F.floor(F.col("x") / width)).collect()
    want = {(k, x): i for key in "abc" for i, (k, x) in enumerate(sorted(p for p in pairs if p[0] == key))}
    assert {(r.k, r.x): r.rn for r in out} == want
    assert all(r.n_rows == sum(p[0] == r.k for p in pairs) for r in out)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_counts_in_levels(spark, levels, monkeypatch):
    monkeypatch.setattr(series, "GROUP_BITS", 2)
    xs = [x * x % 997 for x in range(300)] + [-5, -77]
    df = spark.createDataFrame([(x,) for x in sorted(set(xs))], "x int")
    out = series.number_rows(df, [], ["x"], F.floor(F.col("x") / 3), levels)
    got = {r.x: (r.rn, r.n_rows) for r in out.collect()}
    assert got == {x: (i, len(set(xs))) for i, x in enumerate(sorted(set(xs)))}


def test_numbering_reads_its_input_once(spark, tmp_path):
    prices(spark, {"A": walk(200), "B": walk(50)}).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    seen = []

    def cut(rows):
        seen.append(rows._jdf.queryExecution().executedPlan().toString().count("FileScan"))
        return rows.cache()

    bucket, levels = series.calendar_bucket(df)
    placed = series.number_rows(df, ["symbol"], ["dt"], bucket, levels, cut)
    assert placed.count() == 250 and seen == [1]
    numbered = I.numbered(df)
    assert numbered._jdf.queryExecution().executedPlan().toString().count("FileScan") == 0
    sample = eda.positional_sample(spark.range(500).toDF("x"), "x", width=10, head=3, slices=((100, 101),), tail=2)
    assert "SinglePartition" not in sample._jdf.queryExecution().executedPlan().toString()


def test_ticks_of_one_day_are_spread_over_tasks(spark):
    ticks = spark.range(200_000).select(
        F.lit("A").alias("symbol"), F.timestamp_millis(F.lit(1_577_836_800_000) + F.col("id") * 400).alias("dt"), F.col("id").alias("close"))
    out = I.numbered(ticks)
    wrong, n = out.agg(F.count_if(F.col("rn") != F.col("close")), F.count("*")).first()
    assert (wrong, n) == (0, 200_000)
    bucket, _ = series.calendar_bucket(ticks)
    assert ticks.groupBy(bucket.alias("b")).count().agg(F.max("count")).first()[0] == 150


def test_minute_bars(spark):
    c = walk(3000, 11)
    rows = [("A", dt.datetime(2020, 1, 1) + dt.timedelta(minutes=i), x) for i, x in enumerate(c)]
    df = spark.createDataFrame(rows, "symbol string, dt timestamp, close double")
    same(column(I.with_sma(df, chunk=500), "SMA", "A"), pd.Series(c).rolling(30).mean())


def test_ema_stays_between_extremes(spark):
    c = walk(400, 9)
    ema = column(I.with_ema(prices(spark, {"A": c}), {"EMA": 20}, chunk=50), "EMA", "A")
    assert min(c) - 1e-9 <= min(ema) and max(ema) <= max(c) + 1e-9


def test_one_symbol_is_spread_over_tasks(spark):
    df = prices(spark, {"HOT": walk(2000)})
    chunked = series.in_chunks(I.numbered(df), ["symbol"], before=29, chunk=50)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = chunked.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_task) == 4
    widest = chunked.groupBy("symbol", "_chunk").count().agg(F.max("count")).first()[0]
    assert widest <= 50 + 29


def frame_by_pandas(closes, start, end):
    d = pd.DataFrame({"close": closes})
    d["dt"] = [DAY0 + dt.timedelta(days=i) for i in range(len(d))]
    d["MACD"] = d.close.ewm(span=12, adjust=False).mean() - d.close.ewm(span=26, adjust=False).mean()
    d["Signal_Line"] = d.MACD.ewm(span=9, adjust=False).mean()
    d["RSI"], d["SMA"] = pandas_rsi(d.close), d.close.rolling(30).mean()
    d["EMA"] = d.close.ewm(span=20, adjust=False).mean()
    d = d.dropna()
    d["Target"] = np.where(d.close.shift(-7) > d.close, 1, 0)
    return d[(d.dt >= start) & (d.dt < end)]


def test_feature_frame_equals_pandas(spark):
    # a flat stretch makes RSI undefined in the middle, so the target skips over those rows
    closes = walk(80, 3) + [100.0] * 25 + walk(80, 4)
    start, end = DAY0 + dt.timedelta(days=40), DAY0 + dt.timedelta(days=170)
    got = training.build_set(training.labelled_frame(prices(spark, {"A": closes})), (str(start), str(end)))
    want = frame_by_pandas(closes, start, end)
    rows = got.orderBy("dt").collect()
    assert [r.dt for r in rows] == list(want.dt)
    for name in ("close", "MACD", "Signal_Line", "SMA", "EMA", "Target"):
        same([r[name] for r in rows], want[name])
    same([r.RSI for r in rows], want.RSI, 1e-6)


def test_purge_drops_rows_that_look_past_the_end(spark):
    closes = walk(120, 6)
    frame = training.labelled_frame(prices(spark, {"A": closes, "B": closes}))
    end = str(DAY0 + dt.timedelta(days=100))
    kept = training.build_set(frame, ("2015-01-01", end))
    purged = training.build_set(frame, ("2015-01-01", end), purge=7)
    assert kept.count() - purged.count() == 14
    last = purged.agg(F.max("dt")).first()[0]
    assert last == DAY0 + dt.timedelta(days=92)


def test_drop_incomplete_takes_nan_for_null(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "i int, x double")
    assert [r.i for r in I.drop_incomplete(df).collect()] == [1]


def test_doubled_days_do_not_depend_on_partitioning(spark):
    rows = [("A", dt.date(2020, 1, 1) + dt.timedelta(days=i // 2), float((i * 37) % 11), i) for i in range(80)]
    df = spark.createDataFrame(rows, "symbol string, dt date, close double, volume long")
    got = [sorted(map(tuple, I.with_delta(df.repartition(n)).collect())) for n in (1, 4, 32)]
    assert got[0] == got[1] == got[2]
