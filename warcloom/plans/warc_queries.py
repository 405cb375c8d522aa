"""WARC files written from the pages table and read back, range by range."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cdx as X
from ..sources import warc
from . import frames as fx
from .registry import query
from .stream_queries import _folder

#: Small, so that files are read in several ranges whatever the table's size.
_RANGE = 40_000


def warc_content(spark: SparkSession, sf: str) -> DataFrame:
    """Three records per page: a response, the request it answers (some with a form) and metadata."""
    pages = fx.table(spark, sf, "pages")
    i = F.col("page_id")
    date = F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + i * 61), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    posted = i % 7 == 3
    form = fx._cat("item=", i, "&by=form")
    request = F.when(posted, fx._cat("POST / HTTP/1.1\r\nContent-Type: application/x-www-form-urlencoded\r\n\r\n", form)).otherwise("GET / HTTP/1.1\r\n\r\n")
    status = F.when(i % 9 == 4, "301 Moved").when(i % 9 == 5, "404 Not Found").otherwise("200 OK")
    location = F.when(i % 9 == 4, fx._cat("Location: /moved/", i, "\r\n")).otherwise("")
    response = F.concat(fx._cat("HTTP/1.1 ", status, "\r\nContent-Type: Text/HTML; charset=utf-8\r\n", location, "\r\n"), F.col("html")).cast("binary")

    def record(kind: str, content_type: str, content, digest) -> F.Column:
        return F.struct(
            F.lit(kind).alias("rec_type"), F.lit(content_type).alias("content_type"), fx._cat("<urn:", kind, ":", i, ">").alias("record_id"),
            (F.lit(None).cast("string") if kind == "response" else fx._cat("<urn:response:", i, ">")).alias("concurrent_to"),
            digest.alias("digest"), content.cast("binary").alias("content"))

    none = F.lit(None).cast("string")
    records = F.array(
        record("response", "application/http; msgtype=response", response, F.sha1("html")), record("request", "application/http; msgtype=request", request, none),
        record("metadata", "application/warc-fields", fx._cat("via: x\r\noutlink: http://out.example/", i, " L a/@href\r\nfetchTimeMs: 3\r\n"), none))
    return fx.spread(pages).select(F.col("url").alias("target_uri"), date.alias("warc_date"), F.explode(records).alias("r")).select("target_uri", "warc_date", "r.*")


def range_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a range: a small table's files are still read in several, a large table's
    in some for each core, so that ranges do not outnumber the cores without end."""
    total = sum(size for _, size in warc.listed(path))
    return max(_RANGE, min(total // (4 * spark.sparkContext.defaultParallelism), 128 << 20))


def warc_folder(spark: SparkSession, sf: str) -> str:
    path = _folder(spark, "warcs")
    warc.write_warc(warc_content(spark, sf), path)
    return path


@query("src_7_read_warc_records", r"""
SELECT url AS target_uri, 'response' AS rec_type, CASE page_id % 9 WHEN 4 THEN 301 WHEN 5 THEN 404 ELSE 200 END AS http_status,
       CASE WHEN page_id % 9 = 4 THEN '/moved/' || page_id END AS location, 'Text/HTML' AS mime, sha1(html) AS digest, NULL AS http_method, NULL AS post_query,
       NULL AS outlink, sha256(html) AS body FROM pages
UNION ALL SELECT url, 'request', NULL, NULL, 'application/http', NULL, CASE WHEN page_id % 7 = 3 THEN 'POST' ELSE 'GET' END,
       CASE WHEN page_id % 7 = 3 THEN '__wb_method=POST&item=' || page_id || '&by=form' END, NULL,
       sha256(CASE WHEN page_id % 7 = 3 THEN 'item=' || page_id || '&by=form' ELSE '' END) FROM pages
UNION ALL SELECT url, 'metadata', NULL, NULL, 'application/warc-fields', NULL, NULL, NULL, 'http://out.example/' || page_id,
       sha256('via: x' || chr(13) || chr(10) || 'outlink: http://out.example/' || page_id || ' L a/@href' || chr(13) || chr(10) || 'fetchTimeMs: 3' || chr(13) || chr(10)) FROM pages""")
def src_7(spark, sf):
    path = warc_folder(spark, sf)
    records = warc.read_warc_records(spark, path, keep_content=True, range_bytes=range_bytes(spark, path))
    # A broken place would show as a row of its own.
    return records.select(
        "target_uri", F.coalesce("rec_type", "warc_error").alias("rec_type"), "http_status", "location", "mime", "digest", "http_method", "post_query",
        F.col("outlinks")[0].alias("outlink"), F.sha2("content", 256).alias("body"))


@query("fn_25_warc_to_cdx", r"""
WITH p AS (
  SELECT p.page_id, p.url, f.surt,
         lower(regexp_extract(p.url, '\?([^#]*)', 1)) AS qry, CASE WHEN p.page_id % 7 = 3 THEN '__wb_method=post&item=' || p.page_id || '&by=form' END AS post
  FROM pages p JOIN fx_pages f USING (page_id))
SELECT CASE WHEN post IS NULL THEN surt
            ELSE string_split(surt, '?')[1] || '?' || array_to_string(list_sort(string_split(CASE WHEN qry = '' THEN post ELSE qry || '&' || post END, '&')), '&') END AS urlkey,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id * 61), '%Y%m%d%H%M%S') AS timestamp, url AS original, 'text/html' AS mimetype,
       CASE page_id % 9 WHEN 4 THEN '301' WHEN 5 THEN '404' ELSE '200' END AS statuscode,
       CASE WHEN page_id % 9 = 4 THEN '/moved/' || page_id ELSE '-' END AS redirecturl, sha1(html) AS digest
FROM p JOIN pages USING (page_id, url)
UNION ALL SELECT surt, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id * 61), '%Y%m%d%H%M%S'), url, 'application/warc-fields', '-', '-', '-' FROM p""")
def fn_25_warc(spark, sf):
    """WARC bytes to index lines, with the arguments of POST requests in the key."""
    path = warc_folder(spark, sf)
    records = warc.read_warc_records(spark, path, range_bytes=range_bytes(spark, path))
    lines = warc.with_post_query(records).select(X.record_to_cdx(post_query=F.col("post_query")).alias("line"))
    field = F.split("line", " ")
    names = ("urlkey", "timestamp", "original", "mimetype", "statuscode", "digest", "redirecturl")
    return lines.select(*[field[i].alias(n) for i, n in enumerate(names)])


@query("ag_31_file_hashes", """
SELECT bucket, CAST(octet_length(encode(body)) AS BIGINT) AS length, sha256(body) AS sha256
FROM (SELECT page_id % 8 AS bucket, string_agg(html || chr(10), '' ORDER BY page_id) AS body FROM pages GROUP BY ALL)""")
def ag_31(spark, sf):
    """Files of page sources, one per bucket, hashed as streams."""
    path = _folder(spark, "page-files")
    buckets = fx.table(spark, sf, "pages").withColumn("bucket", F.col("page_id") % 8)
    buckets.repartition(8, "bucket").sortWithinPartitions("bucket", "page_id").select("bucket", F.col("html").alias("value")).write.partitionBy("bucket").text(path)
    found = warc.file_hashes(spark, f"{path}/bucket=*/*.txt", "sha256")
    return found.select(F.regexp_extract("path", "bucket=([0-9]+)", 1).cast("bigint").alias("bucket"), "length", "sha256")


@query("ud_2_record_mapper", """
SELECT 'response' AS kind, CASE page_id % 9 WHEN 4 THEN 3 WHEN 5 THEN 4 ELSE 2 END AS status_class, count(*) AS n, CAST(sum(strlen(html)) AS BIGINT) AS payload
FROM pages GROUP BY ALL UNION ALL SELECT 'request', NULL, count(*), CAST(sum(CASE WHEN page_id % 7 = 3 THEN strlen('item=&by=form' || page_id) ELSE 0 END) AS BIGINT) FROM pages
UNION ALL SELECT 'metadata', NULL, count(*), CAST(sum(strlen('via: x..outlink: http://out.example/ L a/@href..fetchTimeMs: 3..' || page_id)) AS BIGINT) FROM pages""")
def ud_2(spark, sf):
    """A user's mapper sees batches of records and sums them up before Spark does."""
    def sizes(batches):
        for batch in batches:
            batch["payload"] = batch["content"].map(len)
            batch["status_class"] = (batch["http_status"] // 100).fillna(-1).astype("int64")
            yield batch.groupby(["rec_type", "status_class"], as_index=False).agg(n=("payload", "size"), payload=("payload", "sum")).rename(
                columns={"rec_type": "kind"})

    path = warc_folder(spark, sf)
    part = warc.warc_job(spark, path, sizes, "kind string, status_class long, n long, payload long", keep_content=True, range_bytes=range_bytes(spark, path))
    return part.groupBy("kind", F.nullif("status_class", F.lit(-1).cast("long")).alias("status_class")).agg(F.sum("n").alias("n"), F.sum("payload").alias("payload"))
