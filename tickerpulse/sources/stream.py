"""Streaming sources with the (key, value) record contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RECORD = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])


def kafka_options(servers: str, topic: str | None = None, pattern: str | None = None,
                  starting: str = "latest", per_trigger: int | None = None, **extra: str) -> dict[str, str]:
    """Options for the Kafka source: one topic or a topic pattern, start position, rate limit."""
    if (topic is None) == (pattern is None):
        raise ValueError("give either a topic or a pattern")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": starting}
    options["subscribe" if topic else "subscribePattern"] = topic or pattern
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return {**options, **extra}


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """(key, value) strings from Kafka; needs the Kafka connector on the class path.

    Offsets belong to the checkpoint of the query. ``pattern`` with ``starting="earliest"`` and
    an ``availableNow`` trigger consumes what is there and stops.
    """
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.selectExpr("cast(key as string) as key", "cast(value as string) as value")


def read_record_files(spark: SparkSession, path: str, files_per_trigger: int | None = None,
                      fmt: str = "json", glob: str | None = None,
                      schema: T.StructType = RECORD) -> DataFrame:
    """The same contract from files that arrive in a folder, optionally rate-limited."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)
