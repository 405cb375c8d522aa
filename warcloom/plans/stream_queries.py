"""Streaming queries: the events table read as a stream, everything available
handled, results read back. Each is checked against batch SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..streaming import operators as ops
from ..streaming import tables
from ..streaming.runner import run_available
from . import frames as fx
from .registry import query


def _folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _finish(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    base = _folder(spark, name)
    run_available(stream, f"{base}/progress", path=f"{base}/table")
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


_EVENT_DOCS = "(SELECT * FROM fx_candidates WHERE event_id % 17 <> 0)"


@query("sr_1_stream_documents", f"""
SELECT DISTINCT url AS document_url, 'frequent-npld' AS job_name, 'NEW' AS status FROM {_EVENT_DOCS}""")
def sr_1(spark, sf):
    base = _folder(spark, "documents")
    events = fx.crawl_events(spark, sf, fx.event_stream(spark, sf))
    found = ops.event_documents(events, fx.targets(spark, sf))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    run_available(found, f"{base}/progress", batch=ops.store_documents(f"{base}/table"))
    return ops.stored_documents(spark, f"{base}/table", schema).select("document_url", "job_name", "status")


@query("fl_22_heritrix_event", "SELECT event_id FROM fx_log WHERE event_id % 17 <> 0")
def fl_22(spark, sf):
    events = fx.crawl_events(spark, sf, fx.event_stream(spark, sf))
    return _finish(spark, ops.crawler_events(events).select("event_id"), "crawler-events")


_EVENT_LINE = """'- ' || start_ts || ' ' || url || ' ' || CASE WHEN annotation_string LIKE '%duplicate:digest%' THEN 'warc/revisit -' ELSE mime || ' ' || status_code END || ' ' || hash || ' '
  || CASE WHEN status_code = '302' THEN via ELSE '-' END || ' - - ' || (event_id * 1000) || ' /archive/output/warcs/frequent-npld/20240101000000/w' || (user_id % 20) || '.warc.gz'"""
_EVENT_CDX = f"SELECT {_EVENT_LINE} AS line FROM fx_log WHERE url LIKE 'http%' AND TRY_CAST(status_code AS INTEGER) > 0 AND event_id % 19 <> 0"


@query("fn_24_event_to_cdx", _EVENT_CDX)
def fn_24(spark, sf):
    return ops.event_cdx(fx.crawl_events(spark, sf), "/archive")


@query("sr_4_stream_cdx", _EVENT_CDX)
def sr_4(spark, sf):
    return _finish(spark, ops.event_cdx(fx.crawl_events(spark, sf, fx.event_stream(spark, sf)), "/archive"), "cdx")


@query("sr_6_stream_log_summary", r"""
WITH facts AS (
  SELECT event_id, 'lines' AS property, 1 AS amount FROM fx_log
  UNION ALL SELECT event_id, 'status_code:' || status_code, 1 FROM fx_log UNION ALL SELECT event_id, 'content_type:' || mime, 1 FROM fx_log
  UNION ALL SELECT event_id, 'hop:' || right(hop_path, 1), 1 FROM fx_log
  UNION ALL SELECT event_id, CASE WHEN content_length = '-' THEN 'sum:content_length:-' ELSE 'sum:content_length' END, CASE WHEN content_length = '-' THEN 1 ELSE CAST(content_length AS BIGINT) END FROM fx_log
  UNION ALL SELECT event_id, CASE WHEN regexp_full_match(a, '[0-9]+t') THEN 'tries:' || a ELSE a END, 1
    FROM (SELECT DISTINCT event_id, unnest(string_split(annotation_string, ',')) AS a FROM fx_log) WHERE a <> '-' AND a NOT LIKE 'launchTimestamp:%')
SELECT strftime(date_trunc('hour', l.ts), '%Y-%m-%dT%H:%M:%SZ') AS hour, CASE WHEN l.url LIKE 'dns:%' THEN substr(l.url, 5) ELSE l.host END AS host, l.source, property, CAST(sum(amount) AS BIGINT) AS amount
FROM facts JOIN fx_log l USING (event_id) GROUP BY ALL""")
def sr_6(spark, sf):
    """Update mode: each batch writes the totals that it changed."""
    base = _folder(spark, "summary")
    summary = ops.log_summary(fx.crawl_log(spark, sf, fx.event_stream(spark, sf)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in summary.schema)
    run_available(summary, f"{base}/progress", mode="update", batch=tables.upserted(f"{base}/table", ops.SUMMARY_KEY), disk_state=True)
    return tables.newest(spark, f"{base}/table", schema, ops.SUMMARY_KEY)


@query("sr_7_stream_dedup_urls", f"SELECT DISTINCT url AS document_url FROM {_EVENT_DOCS}")
def sr_7(spark, sf):
    """Two runs over the same events: the second one's copies are beyond the state, not beyond the table."""
    base = _folder(spark, "dedup")
    schema = None
    for run in ("first", "again"):
        events = fx.crawl_events(spark, sf, fx.event_stream(spark, sf))
        found = ops.event_documents(events, fx.targets(spark, sf)).withColumn(
            "seen_at", F.try_to_timestamp("wayback_timestamp", F.lit("yyyyMMddHHmmss")))
        unique = ops.dedup_urls(found, "seen_at").drop("seen_at")
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in unique.schema)
        store = ops.store_documents(f"{base}/table")
        later = 0 if run == "first" else 1000  # another query on the table counts its batches on
        run_available(unique, f"{base}/progress-{run}", batch=lambda batch, n, store=store, later=later: store(batch, n + later))
    return ops.stored_documents(spark, f"{base}/table", schema).select("document_url")


_WAIT = "INTERVAL 12 HOUR"


@query("sr_5_stream_launch_check", f"""
WITH c AS (SELECT url, date_trunc('second', ts) AS captured FROM fx_log WHERE url LIKE 'http%'),
mark AS (SELECT least((SELECT max(captured) FROM c), (SELECT max(launch_ts) FROM fx_launches)) - INTERVAL 1 HOUR AS t),
found AS (SELECT l.launch_no, l.url, l.launch_ts, min(captured) AS captured FROM fx_launches l LEFT JOIN c ON c.url = l.url AND captured BETWEEN launch_ts AND launch_ts + {_WAIT} GROUP BY ALL)
SELECT launch_no, strftime(captured, '%Y%m%d%H%M%S') AS captured_at,
       CASE WHEN captured IS NOT NULL THEN 'CAPTURED' WHEN launch_ts + {_WAIT} < t THEN 'FAILED' ELSE 'PENDING' END AS outcome
FROM found, mark""")
def sr_5(spark, sf):
    """Every launch, with what is known of it when both streams have ended."""
    base = _folder(spark, "launch-input")
    fx.launches(spark, sf).write.parquet(f"{base}/launches")
    launches = spark.readStream.schema(spark.read.parquet(f"{base}/launches").schema).parquet(f"{base}/launches")
    captures = fx.crawl_log(spark, sf, fx.event_stream(spark, sf)).filter("url LIKE 'http%'").select(
        "url", F.date_trunc("second", F.col("ts").cast("timestamp")).alias("captured_at"))
    run_available(ops.launch_check(launches, captures), f"{base}/progress", mode="update", batch=ops.store_launches(f"{base}/table"))
    return ops.launch_outcomes(spark, f"{base}/table").select(
        "launch_no", F.date_format("captured_at", "yyyyMMddHHmmss").alias("captured_at"), "outcome")


@query("sr_8_stream_log_files", "SELECT status_code, count(*) AS n FROM fx_log GROUP BY status_code")
def sr_8(spark, sf):
    """Log files written from the log frame, picked up by a file stream in
    small triggers and parsed."""
    from ..sources.crawl_logs import parse_crawl_log, to_log_line

    base = _folder(spark, "logs")
    to_log_line(fx.crawl_log(spark, sf)).write.text(f"{base}/input")
    stream = spark.readStream.option("maxFilesPerTrigger", 2).text(f"{base}/input")
    parsed = _finish(spark, parse_crawl_log(stream).select("status_code"), "parsed-logs")
    return parsed.groupBy("status_code").agg(F.count("*").alias("n"))


@query("sr_2_bounded_run", "SELECT event_id, status_code FROM fx_log")
def sr_2(spark, sf):
    """Everything there is, in triggers of one file each, then stop."""
    base = _folder(spark, "bounded")
    fx.crawl_log(spark, sf).select("event_id", "status_code").repartition(5).write.parquet(f"{base}/input")
    stream = spark.readStream.schema("event_id long, status_code string").option("maxFilesPerTrigger", 1).parquet(f"{base}/input")
    return _finish(spark, stream, "bounded-run")


@query("sr_3_offset_tracking", "SELECT event_id, status_code FROM fx_log")
def sr_3(spark, sf):
    """Two runs on one progress folder with input added in between: the second
    run only handles what is new."""
    base = _folder(spark, "offsets")
    log = fx.crawl_log(spark, sf).select("event_id", "status_code")
    for part in (log.filter("status_code = '200'"), log.filter("status_code <> '200'")):
        part.write.mode("append").parquet(f"{base}/input")
        stream = spark.readStream.schema(log.schema).parquet(f"{base}/input")
        run_available(stream, f"{base}/progress", path=f"{base}/table")
    return spark.read.schema(log.schema).parquet(f"{base}/table")


@query("snk_3_write_cdx", 'SELECT urlkey, timestamp, original, "offset", filename FROM fx_cdx')
def snk_3(spark, sf):
    from ..sources.cdx import write_cdx

    base = _folder(spark, "cdx-table")
    for _ in range(2):  # a batch that runs again replaces itself
        write_cdx(fx.cdx(spark, sf), base, "b1", buckets=16)
    return spark.read.parquet(base).select("urlkey", "timestamp", "original", "offset", "filename")


@query("snk_3_lookup_cdx", """
SELECT c.urlkey, c.timestamp, c."offset", c.filename FROM fx_cdx c WHERE c.original IN (SELECT url FROM fx_pages WHERE page_id % 10 = 0)""")
def snk_3_lookup(spark, sf):
    from ..sources.cdx import lookup_cdx, write_cdx

    base = _folder(spark, "cdx-lookup")
    rows = fx.cdx(spark, sf)
    write_cdx(rows, base, "b1", buckets=16)
    wanted = fx.pages(spark, sf).filter("page_id % 10 = 0").select(F.col("url").alias("original"))
    return lookup_cdx(spark.read.parquet(base), wanted, 16).select("urlkey", "timestamp", "offset", "filename")
