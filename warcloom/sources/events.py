"""Crawl-event sources: Kafka topic or a folder of JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CRAWL_EVENT


_BROKEN = "_broken"


def _parsed(raw: DataFrame, value: str) -> DataFrame:
    schema = T.StructType([*CRAWL_EVENT.fields, T.StructField(_BROKEN, T.StringType())])
    text = F.col(value).cast("string")
    return raw.select(text.alias("value"), F.from_json(text, schema, {"columnNameOfCorruptRecord": _BROKEN}).alias("e"))


def parse_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """Messages as events; those that cannot be read are listed by :func:`rejected_events`."""
    return _parsed(raw, value).filter(F.col("e").isNotNull() & F.col(f"e.{_BROKEN}").isNull()).select("e.*").drop(_BROKEN)


def rejected_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """(value) of the messages that are no JSON object of the events' types."""
    return _parsed(raw, value).filter(F.col("value").isNotNull() & (F.col("e").isNull() | F.col(f"e.{_BROKEN}").isNotNull())).select("value")


def read_crawl_events_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", max_per_trigger: int | None = None) -> DataFrame:
    """Crawl events of a Kafka topic. Progress lives in the query's
    checkpoint. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return parse_events(reader.load())


def read_event_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """JSON lines of files that appear in a folder, as a stream of texts."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


def read_crawl_events_files(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The same events from JSON-line files that appear in a folder."""
    return parse_events(read_event_lines(spark, folder, max_files))
