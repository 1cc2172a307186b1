"""Batch readers and writers for the files the collection keeps."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.timeparse import day_of_epoch, seconds_of

# The endings of per-symbol price files.
SYMBOL_FILE = r"([^/]+)-(?:with-polarity|daily-stocks|historical-stocks)\.csv$"
SYMBOL_ENDINGS = "{with-polarity,daily-stocks,historical-stocks}.csv"
SYMBOL_FOLDER = r"/symbol=([^/]+)/[^/]+$"


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
             multi_line: bool = False, names: str = "*") -> DataFrame:
    """CSV files under ``path`` and its subfolders; quoted fields may hold commas.

    ``multi_line`` also allows line breaks inside quotes, but then a file is read by one task.
    ``names`` is a pattern that the names of the files have to fit.
    """
    return (
        spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)
        .option("escape", '"').option("multiLine", multi_line).option("pathGlobFilter", names).csv(path)
    )


def split_lines(lines: DataFrame, schema: T.StructType, header_mark: str, column: str = "value") -> DataFrame:
    """Comma-split, trimmed lines; lines that contain ``header_mark`` are headers and dropped.

    For bodies without commas (see functions.text.sanitize_body). Fields that do not fit their
    type give null.
    """
    parts, blanks = F.split(F.col(column), ","), F.lit(" \t\r\n")
    fields = [
        F.btrim(F.get(parts, F.lit(i)), blanks).try_cast(f.dataType).alias(f.name)
        for i, f in enumerate(schema.fields)
    ]
    return lines.where(~F.col(column).contains(header_mark)).select(*fields)


def csv_writer(df: DataFrame, mode: str = "errorifexists"):
    """CSV with header; quotes are doubled, as other tools expect, and blanks at the ends trimmed."""
    return df.write.mode(mode).option("header", True).option("escape", '"')


def write_scored_posts(scored: DataFrame, path: str, mode: str = "append") -> None:
    csv_writer(scored.select(*schemas.SCORED_POST.fieldNames()), mode).csv(path)


def read_scored_posts(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.SCORED_POST)


def read_split(spark: SparkSession, path: str, side: str, schema: T.StructType) -> DataFrame:
    """The training or the testing rows of ``write_split``; the other folders are not read.

    ``schema`` lists the file's columns, without split and symbol.
    """
    folders = [T.StructField("split", T.StringType()), T.StructField("symbol", T.StringType())]
    rows = spark.read.schema(T.StructType([*schema.fields, *folders])).option("header", True).option(
        "escape", '"').csv(path)
    return rows.where(F.col("split") == side).drop("split")


def write_scored_table(scored: DataFrame, path: str, mode: str = "append") -> None:
    """Scored posts as Parquet in ``date=`` folders; a day with many posts gets several files."""
    dated = scored.withColumn("date", day_of_epoch(seconds_of(scored)))
    dated.hint("rebalance", "date").write.mode(mode).partitionBy("date").parquet(path)


def read_scored_table(spark: SparkSession, path: str, first_day: str | None = None,
                      last_day: str | None = None) -> DataFrame:
    """Scored posts from the Parquet folders; days outside the range are not read."""
    dated = T.StructType([*schemas.SCORED_POST.fields, T.StructField("date", T.DateType())])
    rows = spark.read.schema(dated).parquet(path)
    if first_day is not None:
        rows = rows.where(F.col("date") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        rows = rows.where(F.col("date") <= F.lit(last_day).cast("date"))
    return rows


def read_post_dump(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The dump of raw posts, whose bodies may hold line breaks."""
    return read_csv(spark, path, schemas.POST_DUMP, multi_line)


def with_line_order(scan: DataFrame) -> DataFrame:
    """Add ``line``, which sorts rows of a text scan as they stand in their files.

    Within a block of a file, rows are numbered by the one task that reads it.
    """
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                     F.monotonically_increasing_id().alias("row"))
    return scan.withColumn("line", place)


def read_post_tickers(spark: SparkSession, path: str) -> DataFrame:
    """(tweet_id, ticker_symbol, line) in file order."""
    return with_line_order(read_csv(spark, path, schemas.POST_TICKER))


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.COMPANY)


def read_company_values(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.COMPANY_VALUES)


def symbol_from_path(path: Column, pattern: str = SYMBOL_FILE) -> Column:
    return F.url_decode(F.regexp_extract(path, pattern, 1))


def _any_of(symbols: Sequence[str]) -> str:
    """A file pattern that fits each of the symbols."""
    return "{" + ",".join(re.sub(r"([\\{}\[\]*?,])", r"\\\1", s) for s in sorted(set(symbols))) + "}"


def read_symbol_files(spark: SparkSession, path: str, schema: T.StructType = schemas.DAILY_BARS,
                      pattern: str = SYMBOL_FILE, symbols: Sequence[str] | None = None) -> DataFrame:
    """The per-symbol files of a folder in one scan, with ``symbol`` taken from the file or folder
    name: all, or those of ``symbols`` only, whose files alone are then read (of folders, at least one has to
    be there)."""
    if symbols is not None and not symbols:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("symbol", T.StringType())]))
    if symbols is None:
        scan = read_csv(spark, path, schema)
    elif pattern == SYMBOL_FOLDER:
        scan = read_csv(spark, f"{path}/symbol={_any_of(symbols)}", schema)
    else:
        scan = read_csv(spark, path, schema, names=f"{_any_of(symbols)}-{SYMBOL_ENDINGS}")
    return scan.withColumn("symbol", symbol_from_path(F.col("_metadata.file_path"), pattern))


def as_prices(bars: DataFrame) -> DataFrame:
    """Provider bars under the names the series operators use: symbol, dt, open, ..., volume."""
    renamed = bars.withColumnsRenamed({c: c.lower() for c in bars.columns})
    return renamed.withColumnRenamed("date", "dt")


def latest_output(spark: SparkSession, path: str, glob: str = "*.csv") -> str | None:
    """The last file in name order, or its whole folder if it is one part of a distributed write.

    Only the listing is read, not the files.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).load(path)
    )
    last = listing.agg(F.max("path").alias("path")).first()["path"]
    if last is None:
        return None
    folder, _, name = last.rpartition("/")
    return folder if name.startswith("part-") else last


def read_daily_polarity(spark: SparkSession, path: str, latest_only: bool = False) -> DataFrame:
    """Daily polarity files without incomplete rows; all of them or just the latest rollup."""
    if latest_only:
        last = latest_output(spark, path)
        if last is None:
            return spark.createDataFrame([], schemas.DAILY_POLARITY)
        path = last
    return read_csv(spark, path, schemas.DAILY_POLARITY).dropna("any")


def write_daily_polarity(daily: DataFrame, path: str, mode: str = "errorifexists",
                         single_file: bool = False) -> None:
    """CSV with header. ``single_file`` is for this small daily result only."""
    out = daily.coalesce(1) if single_file else daily
    csv_writer(out, mode).csv(path)


def write_split(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Training and testing rows as CSV in ``split=<side>/symbol=<symbol>`` folders.

    Rows of a folder are brought together first, and large folders split over several tasks.
    """
    csv_writer(rows.hint("rebalance", "split", "symbol"), mode).partitionBy("split", "symbol").csv(path)


def with_mock_polarity(prices: DataFrame, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """Add Polarity, a whole number from 0 to 5 as a double.

    Drawn from a hash of the keys, so that a recomputed task draws the same again.
    """
    draw = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(6))
    return prices.withColumn("Polarity", draw.cast("double"))
