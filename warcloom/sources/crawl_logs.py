"""Crawl-log readers. Bad lines go to a quarantine frame, never fail the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import logs as L
from ..schemas import CRAWL_LOG_FIELDS

_EDGE_SPACE = r"^\s+|\s+$"
# Seed lines of old logs leave out path and referrer.
_SHORT_FIELDS = [f for f in CRAWL_LOG_FIELDS if f not in ("hop_path", "via")]


def _named(fields: Column, names: list[str]) -> dict[str, Column]:
    return {name: fields[i] for i, name in enumerate(names)}


def parse_crawl_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Strict form: twelve fields split on runs of spaces, with annotations
    split and a trailing JSON object taken off."""
    f = F.split(F.regexp_replace(F.col(value), _EDGE_SPACE, ""), " +", 12)
    fields = lines.select(f.alias("_f")).filter(F.size("_f") == 12)
    return _finish(fields.select(*[c.alias(n) for n, c in _named(F.col("_f"), CRAWL_LOG_FIELDS).items()]))


def parse_crawl_log_lenient(lines: DataFrame, value: str = "value") -> DataFrame:
    """Twelve fields, or ten with path and referrer taken as ``-``, split on
    any white space."""
    f = F.split(F.regexp_replace(F.col(value), _EDGE_SPACE, ""), r"\s+", 12)
    fields = lines.select(f.alias("_f")).filter(F.size("_f").isin(10, 12))
    full, short = _named(F.col("_f"), CRAWL_LOG_FIELDS), _named(F.col("_f"), _SHORT_FIELDS)
    is_full = F.size("_f") == 12
    columns = [F.when(is_full, full[n]).otherwise(short.get(n, F.lit("-"))).alias(n) for n in CRAWL_LOG_FIELDS]
    return _finish(fields.select(*columns))


def rejected_lines(lines: DataFrame, value: str = "value", lenient: bool = False) -> DataFrame:
    """Lines the parser leaves out, with their field count."""
    n = F.size(F.split(F.regexp_replace(F.col(value), _EDGE_SPACE, ""), r"\s+" if lenient else " +", 12))
    good = n.isin(10, 12) if lenient else n == 12
    return lines.select(F.col(value).alias("line"), n.alias("n_fields")).filter(~good)


def _finish(fields: DataFrame) -> DataFrame:
    raw = F.col("annotation_string")
    return (
        fields.withColumn("extra_json", L.extra_json(raw))
        .withColumn("annotation_string", L.strip_extra_json(raw))
        .withColumn("annotations", L.annotation_list(raw))
    )


def read_crawl_log(spark: SparkSession, *paths: str) -> DataFrame:
    return parse_crawl_log(spark.read.text(list(paths)))


def read_crawl_log_lenient(spark: SparkSession, *paths: str) -> DataFrame:
    return parse_crawl_log_lenient(spark.read.text(list(paths)))


def to_log_line(log: DataFrame) -> DataFrame:
    """Log text of parsed rows, the inverse of parse_crawl_log."""
    tail = F.when(F.col("extra_json").isNotNull(), F.concat(F.lit(" "), "extra_json")).otherwise(F.lit(" {}"))
    return log.select(F.concat(F.concat_ws(" ", *CRAWL_LOG_FIELDS), tail).alias("value"))
