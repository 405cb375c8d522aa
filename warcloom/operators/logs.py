"""Crawl-log filters and summaries. Input: rows with the schemas.CRAWL_LOG_FIELDS
columns plus ``annotations`` (see sources.crawl_logs)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import DASH
from ..functions import logs as L
from ..functions import urls as U


def seed_results(log: DataFrame) -> DataFrame:
    """Lines that are seeds: no hops and no other page led here."""
    return log.filter((F.col("hop_path") == DASH) & ((F.col("via") == DASH) | (F.col("via") == F.col("url"))))


def dead_seed_rows(log: DataFrame) -> DataFrame:
    """Seed lines that are neither 2xx nor 3xx; a missing status is dead."""
    alive = F.coalesce(L.status_class(F.col("status_code")).isin(2, 3), F.lit(False))
    return log.filter(~alive & (F.col("hop_path") == DASH) & (F.col("via") == DASH))


def logs_for_host(log: DataFrame, host: str, tie_break: list[str] | None = None) -> DataFrame:
    order = ["start_time_plus_duration", *(tie_break or ["url"])]
    return log.filter(U.url_host(F.col("url")) == host).orderBy(*order)


def lines_with_valid_status(log: DataFrame, allow_negative: bool = False) -> DataFrame:
    return log.filter(L.is_numeric_status(F.col("status_code"), allow_negative))


def line_facts(log: DataFrame) -> DataFrame:
    """(day, host, source, property, amount), one row per fact of a line."""
    return log.select(
        L.log_day(F.col("timestamp")).alias("day"),
        U.url_host(F.col("url")).alias("host"),
        "source",
        F.explode(L.line_stats()).alias("fact"),
    ).select(
        "day", "host", "source", L.stat_property(F.col("fact")).alias("property"),
        L.stat_amount(F.col("fact")).alias("amount"),
    )


def summarise_logs(log: DataFrame) -> DataFrame:
    """Totals by day, host and source in long form.

    Facts are exploded before grouping, so each task sends one partial row per
    distinct property and a host with a third of all lines stays cheap.
    """
    return line_facts(log).groupBy("day", "host", "source", "property").agg(F.sum("amount").alias("amount"))


def _with_host_state(log: DataFrame) -> DataFrame:
    live = L.is_live_status(F.col("status_code"))
    dead = L.is_dead_seed_line(F.col("status_code"), F.col("hop_path"), F.col("via"))
    return (
        log.withColumn("_live", live)
        .withColumn("_dead", dead)
        .filter(F.col("_live") | F.col("_dead"))
        .withColumn("host", U.url_netloc_nowww(F.col("url")))
    )


def summarise_hosts(log: DataFrame) -> DataFrame:
    """One row per host: state, labels and how many live lines it has."""
    return (
        _with_host_state(log)
        .groupBy("host")
        .agg(
            F.max("_dead").alias("_any_dead"),
            F.count_if("_live").alias("live_lines"),
            F.count_if("_dead").alias("dead_seed_lines"),
        )
        .select(
            "host",
            F.when(F.col("_any_dead"), "Has Dead Seeds").otherwise("Live").alias("url_state"),
            U.tld(F.col("host")).alias("tld"),
            U.second_level(F.col("host")).alias("second_level"),
            "live_lines",
            "dead_seed_lines",
        )
    )


def host_histograms(log: DataFrame) -> DataFrame:
    """(host, dimension, value, n) over live lines; dimensions ip, mime, virus."""
    def entry(dimension: str, value: Column) -> Column:
        return F.struct(F.lit(dimension).alias("dimension"), value.alias("value"))

    entries = F.array(
        entry("ip", L.annotation_ip(F.col("annotations"))),
        entry("mime", L.ascii_only(F.col("mime"))),
        entry("virus", L.annotation_virus(F.col("annotations"))),
    )
    return (
        _with_host_state(log)
        .filter("_live")
        .select("host", F.explode(entries).alias("e"))
        .filter("e.value IS NOT NULL")
        .groupBy("host", "e.dimension", "e.value")
        .agg(F.count("*").alias("n"))
    )


def dead_seeds(log: DataFrame) -> DataFrame:
    """Seed URLs that returned 404 and never succeeded."""
    return (
        log.groupBy("url")
        .agg(
            F.max(L.is_dead_seed_line(F.col("status_code"), F.col("hop_path"), F.col("via"))).alias("_dead"),
            F.max(L.is_live_status(F.col("status_code"))).alias("_live"),
        )
        .filter("_dead AND NOT _live")
        .select("url")
    )


def count_status_codes(log: DataFrame) -> DataFrame:
    return (
        lines_with_valid_status(log, allow_negative=True)
        .groupBy("status_code")
        .agg(F.count("*").alias("n"))
    )


def first_n_per_host(log: DataFrame, n: int = 5, tie_break: list[str] | None = None) -> DataFrame:
    """Earliest n lines of each host.

    The rank filter is applied in each task before the exchange, so a hot host
    sends n rows per task, not its whole log.
    """
    w = Window.partitionBy("host").orderBy("timestamp", *(tie_break or ["url", "start_time_plus_duration"]))
    return (
        log.withColumn("host", U.url_host(F.col("url")))
        .withColumn("rank_in_host", F.row_number().over(w))
        .filter(F.col("rank_in_host") <= n)
    )


def host_log_stats(log: DataFrame) -> DataFrame:
    """(host, status_code, n, bytes, reached_cap) for http hosts, counts per code."""
    host = F.regexp_extract("url", "^https?://([^/]+)/", 1)
    return (
        log.withColumn("host", host)
        .filter(F.col("host") != "")
        .groupBy("host", "status_code")
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(F.col("content_length").try_cast("bigint")), F.lit(0)).alias("bytes"),
            F.max(F.col("annotation_string").contains("serverMaxSuccessKb")).alias("reached_cap"),
        )
    )


def host_class_report(log: DataFrame) -> DataFrame:
    """2XX to 5XX counts, bytes and cap flag per host, largest first."""
    stats = host_log_stats(log)
    classes = [
        F.sum(F.when(F.col("status_code").startswith(str(c)), F.col("n")).otherwise(0)).alias(f"n_{c}xx")
        for c in (2, 3, 4, 5)
    ]
    return (
        stats.groupBy("host")
        .agg(*classes, F.sum("bytes").alias("data_size"), F.max("reached_cap").alias("reached_cap"))
        .orderBy(F.desc("data_size"), "host")
    )


def log_start(log: DataFrame) -> DataFrame:
    """Earliest line time, to the second."""
    first = F.min(L.log_datetime(F.col("timestamp")))
    return log.agg(F.date_format(first, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("start_date"))


def combine_logs(*logs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)
