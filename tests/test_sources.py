import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickerpulse import session
from tickerpulse.schemas import DAILY_BARS, POST_DUMP, SCORED_POST
from tickerpulse.sources import files, stream

HEADER = "Date,Open,High,Low,Close,Adjusted_close,Volume\n"


def test_symbol_comes_from_the_file_name(spark, tmp_path):
    for name in ("BTC-USD.CC-daily-stocks.csv", "MSFT.US-with-polarity.csv", "AAPL.US-historical-stocks.csv"):
        (tmp_path / name).write_text(HEADER + "2020-01-02,1,2,0.5,1.5,1.5,10\n")
    rows = files.read_symbol_files(spark, str(tmp_path)).collect()
    assert {r.symbol for r in rows} == {"BTC-USD.CC", "MSFT.US", "AAPL.US"}
    assert {r.Date for r in rows} == {dt.date(2020, 1, 2)}
    assert set(DAILY_BARS.fieldNames()) | {"symbol"} == set(rows[0].asDict())


def test_files_of_other_symbols_are_not_read(spark, tmp_path):
    for name in ("BTC-USD.CC-daily-stocks.csv", "MSFT.US-with-polarity.csv", "sub/AAPL.US-historical-stocks.csv", "AAPL.US2-daily-stocks.csv"):
        (tmp_path / "names" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "names" / name).write_text(HEADER + "2020-01-02,1,2,0.5,1.5,1.5,10\n")
    some = files.read_symbol_files(spark, str(tmp_path / "names"), symbols=["AAPL.US", "BTC-USD.CC", "NONE"])
    assert sorted(f.rpartition("/")[2] for f in some.inputFiles()) == ["AAPL.US-historical-stocks.csv", "BTC-USD.CC-daily-stocks.csv"]
    assert {r.symbol for r in some.collect()} == {"AAPL.US", "BTC-USD.CC"}
    rows = spark.createDataFrame([("A.US", 1.0), ("B", 2.0), ("C", 3.0)], "symbol string, close double")
    rows.write.partitionBy("symbol").option("header", True).csv(str(tmp_path / "folders"))
    schema = spark.createDataFrame([], "close double").schema
    two = files.read_symbol_files(spark, str(tmp_path / "folders"), schema, files.SYMBOL_FOLDER, ["A.US", "C", "D"])
    assert len(two.inputFiles()) == 2 and {(r.symbol, r.close) for r in two.collect()} == {("A.US", 1.0), ("C", 3.0)}
    assert files.read_symbol_files(spark, str(tmp_path), schema, symbols=[]).collect() == []


def test_dump_with_quotes_commas_and_line_breaks(spark, tmp_path):
    (tmp_path / "Tweet.csv").write_text(
        ",".join(POST_DUMP.fieldNames()) + '\n1,w,1420070457,"a, ""b""\nc",0,1,2\n2,w,1420070458,plain,0,0,0\n')
    rows = files.read_post_dump(spark, str(tmp_path)).orderBy("tweet_id").collect()
    assert [r.body for r in rows] == ['a, "b"\nc', "plain"] and rows[0].like_num == 2


def test_line_split_drops_headers_and_bad_fields(spark):
    lines = spark.createDataFrame([("tweet_id,writer,post_date",), (" 1 , w ,5, body\t,0,x,2",)], "value string")
    (row,) = files.split_lines(lines, POST_DUMP, "tweet_id").collect()
    assert tuple(row) == (1, "w", 5, "body", 0, None, 2)


def test_scored_csv_in_nested_folders(spark, tmp_path):
    rows = spark.createDataFrame([("1", "5", "T", 0, 'say "hi", now', 1.25), ("2", "6", "T", 0, "x", None)], SCORED_POST)
    files.write_scored_posts(rows.where("t_key = 1"), f"{tmp_path}/a/b")
    files.write_scored_posts(rows.where("t_key = 2"), f"{tmp_path}/c")
    assert files.read_scored_posts(spark, str(tmp_path)).orderBy("t_key").collect() == rows.collect()


HEAD = "date,search_term,count,agg_polarity,positive_count,negative_count,neutral_count\n"


def test_latest_rollup_file(spark, tmp_path):
    (tmp_path / "daily-1.csv").write_text(HEAD + "2020-01-01,T,1,0.5,1,0,0\n")
    (tmp_path / "daily-2.csv").write_text(HEAD + "2020-01-02,T,2,0.5,1,1,0\n2020-01-03,T,,0.5,1,1,0\n")
    (tmp_path / "daily-3.txt").write_text("other")
    assert files.read_daily_polarity(spark, f"{tmp_path}/*.csv").count() == 2
    (row,) = files.read_daily_polarity(spark, str(tmp_path), latest_only=True).collect()
    assert row.date == dt.date(2020, 1, 2)


def test_latest_rollup_of_several_parts(spark, tmp_path):
    for run, parts in (("run=1", 1), ("run=2", 3)):
        (tmp_path / run).mkdir()
        for i in range(parts):
            (tmp_path / run / f"part-{i}.csv").write_text(HEAD + f"2020-01-0{i + 1},{run},1,0.5,1,0,0\n")
    rows = files.read_daily_polarity(spark, str(tmp_path), latest_only=True).collect()
    assert [r.search_term for r in rows] == ["run=2"] * 3
    (tmp_path / "empty").mkdir()
    assert files.read_daily_polarity(spark, f"{tmp_path}/empty", latest_only=True).isEmpty()


def test_rollup_write_refuses_to_overwrite(spark, tmp_path):
    df = spark.range(1)
    files.write_daily_polarity(df, f"{tmp_path}/out", single_file=True)
    with pytest.raises(Exception, match="already exists"):
        files.write_daily_polarity(df, f"{tmp_path}/out")
    files.write_daily_polarity(df, f"{tmp_path}/out", mode="overwrite")


def test_mock_polarity(spark):
    draw = files.with_mock_polarity(spark.range(500), ["id"], seed=1)
    assert {r.Polarity for r in draw.collect()} == {0.0, 1.0, 2.0, 3.0, 4.0, 5.0}
    again = files.with_mock_polarity(spark.range(500).repartition(7), ["id"], seed=1)
    assert draw.exceptAll(again).isEmpty()


def test_scored_table_prunes_days_and_columns(spark, tmp_path):
    day = 86_400
    rows = spark.createDataFrame(
        [(str(i), str(i * day), "T", 0, "text", float(i)) for i in range(10)], SCORED_POST)
    files.write_scored_table(rows, f"{tmp_path}/t")
    kept = files.read_scored_table(spark, f"{tmp_path}/t", "1970-01-03", "1970-01-05").where("polarity > 2")
    assert sorted(r.t_key for r in kept.collect()) == ["3", "4"]
    plan = kept.select("t_key")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(polarity,2.0)" in plan and "PartitionFilters: [isnotnull(date" in plan
    assert "ReadSchema: struct<t_key:string,polarity:double>" in plan


def test_kafka_options():
    o = stream.kafka_options("k:9092", topic="posts", per_trigger=10_000)
    assert o == {"kafka.bootstrap.servers": "k:9092", "startingOffsets": "latest", "subscribe": "posts",
                 "maxOffsetsPerTrigger": "10000"}
    assert stream.kafka_options("k", pattern="posts.*", starting="earliest")["subscribePattern"] == "posts.*"
    with pytest.raises(ValueError):
        stream.kafka_options("k")


def test_cut_lineage_writes_to_the_shared_folder(spark):
    out = session.cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
    assert "Range" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.agg(F.sum("x")).first()[0] == 90
    assert session.scratch_path(spark, "a").startswith(session.shared_dir(spark))


class _Conf:
    def __init__(self, folder):
        self.folder = folder

    def get(self, _, default):
        return self.folder or default


class _Context:
    folder = None

    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, folder=None):
        self.conf, self.sparkContext = _Conf(folder), _Context(master)


def test_shared_folder_is_the_configured_one():
    assert session.shared_dir(_Session("spark://m", "s3://bucket/ck/")) == "s3://bucket/ck"
    with pytest.raises(RuntimeError):
        session.shared_dir(_Session("spark://m"))
    local = _Session("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local) != ""


def test_shuffle_partitions_follow_the_data():
    sizes = [session.shuffle_partitions(n) for n in (0, 10 * 2**40, 100 * 2**40)]
    assert sizes == [200, 81_920, 819_200]
