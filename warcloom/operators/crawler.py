"""Crawler status snapshots as metric tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OFFSET_LINE = r"partition: *(\d+), *offset: *(\d+)"

# Fixed values: (metric, kind, path below the job report).
REPORT_METRICS = [
    ("uris", "downloaded", "uriTotalsReport.downloadedUriCount"),
    ("uris", "queued", "uriTotalsReport.totalUriCount"),
    ("uris", "novel", "sizeTotalsReport.novelCount"),
    ("uris", "deduplicated", "sizeTotalsReport.dupByHashCount"),
    ("uris", "deepest-queue-depth", "loadReport.deepestQueueDepth"),
    ("uris", "average-queue-depth", "loadReport.averageQueueDepth"),
    ("bytes", "novel", "sizeTotalsReport.novel"),
    ("bytes", "deduplicated", "sizeTotalsReport.dupByHash"),
    ("bytes", "warc-novel-content", "sizeTotalsReport.warcNovelContentBytes"),
    ("queues", "total", "frontierReport.totalQueues"),
    ("queues", "in-process", "frontierReport.inProcessQueues"),
    ("queues", "ready", "frontierReport.readyQueues"),
    ("queues", "snoozed", "frontierReport.snoozedQueues"),
    ("queues", "active", "frontierReport.activeQueues"),
    ("queues", "inactive", "frontierReport.inactiveQueues"),
    ("queues", "ineligible", "frontierReport.ineligibleQueues"),
    ("queues", "retired", "frontierReport.retiredQueues"),
    ("queues", "exhausted", "frontierReport.exhaustedQueues"),
    ("threads", "total", "loadReport.totalThreads"),
    ("threads", "busy", "loadReport.busyThreads"),
    ("threads", "congestion-ratio", "loadReport.congestionRatio"),
    ("threads", "toe-count", "threadReport.toeCount"),
]


def partition_offsets(reports: DataFrame) -> DataFrame:
    """(service, partition, offset) from the report text. reports: service, message."""
    lines = reports.select("service", F.explode(F.split("message", "\n")).alias("line")).filter(F.col("line").rlike(_OFFSET_LINE))
    return lines.select(
        "service", F.regexp_extract("line", _OFFSET_LINE, 1).cast("int").alias("partition"),
        F.regexp_extract("line", _OFFSET_LINE, 2).cast("bigint").alias("offset"),
    )


def kafka_offsets(reports: DataFrame) -> DataFrame:
    """Offsets consumed per service and overall (service NULL), with the number
    of partitions that more than one report names."""
    offsets = partition_offsets(reports)
    shared = offsets.groupBy("partition").agg((F.count_distinct("service") > 1).alias("_shared"))
    rows = offsets.join(shared, "partition")
    return rows.rollup("service").agg(
        F.sum("offset").alias("kafka_consumed"), F.count_distinct("partition").alias("n_partitions"),
        F.count_distinct(F.when(F.col("_shared"), F.col("partition"))).alias("n_shared_partitions"),
    )


def crawler_with_kafka(status: DataFrame, reports: DataFrame) -> DataFrame:
    """Status rows with what their service has consumed. status: url, ...;
    reports: service is that url."""
    consumed = partition_offsets(reports).groupBy(F.col("service").alias("url")).agg(
        F.sum("offset").alias("kafka_consumed"), F.count("*").alias("kafka_partitions")
    )
    return status.join(consumed, "url", "left")


def _finite(value: Column) -> Column:
    """The number; 0 where the counter is missing, NULL where it is not finite."""
    number = value.try_cast("double")
    return F.when(value.isNull(), F.lit(0.0)).when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def crawler_metrics(status: DataFrame) -> DataFrame:
    """Long metrics (metric, job, deployment, id, kind, value).

    status: job_name, deployment, id, report (a struct holding the reports
    named in REPORT_METRICS, all numbers as text, plus threadReport.steps and
    threadReport.processors as arrays of "12 STEP" lines). NaN and infinite
    values become NULL; lines that are not "count name" are left out.
    """
    fixed = [
        F.struct(F.lit(metric).alias("metric"), F.lit(kind).alias("kind"), _finite(F.col(f"report.{path}")).alias("value"))
        for metric, kind, path in REPORT_METRICS
    ]

    def counted(path: str, prefix: str) -> Column:
        lines = F.filter(F.coalesce(F.col(path), F.array().cast("array<string>")), lambda s: s.rlike(r"^\d+ .+"))
        return F.transform(
            lines,
            lambda s: F.struct(
                F.lit("threads").alias("metric"), F.concat(F.lit(prefix), F.lower(F.regexp_extract(s, r"^\d+ (.+)$", 1))).alias("kind"),
                F.regexp_extract(s, r"^(\d+) ", 1).cast("double").alias("value"),
            ),
        )

    everything = F.concat(
        F.array(*fixed), counted("report.threadReport.steps", "step-"), counted("report.threadReport.processors", "processor-")
    )
    return status.select(F.col("job_name").alias("job"), "deployment", "id", F.explode(everything).alias("m")).select(
        "m.metric", "job", "deployment", "id", "m.kind", "m.value"
    )
