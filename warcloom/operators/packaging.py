"""Crawl packages built up stage by stage.

Version n of a package holds the first n stages of its launch. What a version
holds is told by intervals: each entry carries the first and the last version it
belongs to, so results have a row per entry, not one per entry and version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LAUNCH = ["job", "launch"]


def _stage_order() -> list[Column]:
    # Checkpoints by their time stamp, the final chunk last.
    return [F.when(F.col("stage") == "final", 1).otherwise(0), F.col("stage")]


def incremental_packages(stages: DataFrame) -> DataFrame:
    """(job, launch, stage, first_version, last_version): the versions that hold each stage.

    stages: job, launch, stage ("final" or a time stamp). A launch has as many
    stages as checkpoints, so numbering them is a small window.
    """
    distinct = stages.select(*_LAUNCH, "stage").distinct()
    launch = Window.partitionBy(*_LAUNCH)
    return distinct.select(
        *_LAUNCH, "stage", F.row_number().over(launch.orderBy(*_stage_order())).alias("first_version"), F.count("*").over(launch).cast("int").alias("last_version"))


def running_lists(stages: DataFrame) -> DataFrame:
    """Running lists (cp1), (cp1 cp2), ... per (job, launch): (job, launch, stage, version, stages).

    Each version written out, named by the stage that it adds. A launch has as many
    stages as checkpoints, so its lists are a small window.
    """
    upto = Window.partitionBy(*_LAUNCH).orderBy("first_version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return incremental_packages(stages).select(
        *_LAUNCH, "stage", F.col("first_version").alias("version"), F.collect_list("stage").over(upto).alias("stages"))


def holding(entries: DataFrame, version: Column | int) -> DataFrame:
    """The rows of an interval frame that a version holds."""
    number = version if isinstance(version, Column) else F.lit(version)
    return entries.filter(number.between(F.col("first_version"), F.col("last_version")))


def _until_replaced(rows: DataFrame, key: list[str]) -> DataFrame:
    """Ends each interval where the next value of the same key begins."""
    w = Window.partitionBy(*_LAUNCH, *key).orderBy("first_version")
    return rows.withColumn("last_version", F.coalesce(F.lead("first_version").over(w) - 1, "last_version"))


def package_merge(items: DataFrame, scalars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merged content of the cumulative packages, as intervals of versions.

    items: job, launch, stage, field, key (NULL for list entries), value;
    scalars: job, launch, stage, field, value. List entries stay from their
    stage on; a map entry and a non-empty scalar stay until a later stage brings
    another value (the greatest, if one stage brings several). Returns
    (job, launch, field, key, value, first_version, last_version) of the items and
    the same without key of the scalars.
    """
    versions = incremental_packages(scalars.select(*_LAUNCH, "stage").unionByName(items.select(*_LAUNCH, "stage")))
    listed = items.filter("key IS NULL").join(versions, [*_LAUNCH, "stage"])
    mapped = items.filter("key IS NOT NULL").groupBy(*_LAUNCH, "stage", "field", "key").agg(F.max("value").alias("value"))
    mapped = _until_replaced(mapped.join(versions, [*_LAUNCH, "stage"]), ["field", "key"])
    last = scalars.filter("value IS NOT NULL AND value <> ''").groupBy(*_LAUNCH, "stage", "field").agg(F.max("value").alias("value"))
    last = _until_replaced(last.join(versions, [*_LAUNCH, "stage"]), ["field"])
    interval = ["value", "first_version", "last_version"]
    columns = [*_LAUNCH, "field", "key", *interval]
    return listed.select(*columns).unionByName(mapped.select(*columns)), last.select(*_LAUNCH, "field", *interval)
