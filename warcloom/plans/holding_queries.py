"""File-store queries: path functions, filters, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import formats, paths
from ..operators import holdings as ops
from . import frames as fx
from .registry import query

_ISO = "%Y-%m-%dT%H:%M:%S.%g"


def _iso(name):
    return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias(name)


@query("fn_1_classify_path", """
SELECT file_path, recognised, collection, stream, job, launch, layout, kind, file_name, file_ext FROM fx_files""")
def fn_1(spark, sf):
    return fx.files(spark, sf).select(
        "file_path", "recognised", "collection", "stream", "job", "launch", "layout", "kind", "file_name", "file_ext")


@query("fn_2_refine_kind", """
SELECT filename, CASE WHEN filename LIKE '%.warc.gz' THEN 'warcs' WHEN filename LIKE '%.warc.cdx' THEN 'cdx' ELSE 'warcs-invalid' END AS as_warc,
       CASE WHEN filename LIKE '%/crawl.log%' THEN 'crawl-logs' ELSE 'logs' END AS as_log FROM fx_listing""")
def fn_2(spark, sf):
    name = paths.file_name(F.col("filename"))
    return fx.listing(spark, sf).select(
        "filename", paths.refine_kind(F.lit("warcs"), F.lit("selective"), name).alias("as_warc"),
        paths.refine_kind(F.lit("logs"), F.lit("npld"), name).alias("as_log"))


@query("fn_3_file_timestamp", f"SELECT file_path, strftime(file_ts, '{_ISO}') AS timestamp FROM fx_files")
def fn_3(spark, sf):
    return fx.files(spark, sf).select("file_path", _iso("timestamp"))


@query("fn_4_file_name_ext", "SELECT file_path, file_name, file_ext FROM fx_files")
def fn_4(spark, sf):
    p = F.col("file_path")
    return fx.files(spark, sf).select("file_path", paths.file_name(p).alias("file_name"), paths.file_ext(p).alias("file_ext"))


@query("fn_5_launch_datetime", """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00' AS from_8, strftime(l_shipdate, '%Y-%m-%d') || 'T12:30:00' AS from_12,
       strftime(l_shipdate, '%Y-%m-%d') || 'T12:03:00' AS from_12_short, strftime(l_shipdate, '%Y-%m-%d') || 'T12:30:45' AS from_14
FROM lineitem""")
def fn_5(spark, sf):
    def stamp(c):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")

    d = F.date_format("l_shipdate", "yyyyMMdd")
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", stamp(paths.launch_datetime(d)).alias("from_8"),
        stamp(paths.launch_datetime(F.concat(d, F.lit("1230")))).alias("from_12"),
        stamp(paths.launch_datetime(F.concat(d, F.lit("1230")), short_minutes=True)).alias("from_12_short"),
        stamp(paths.launch_datetime(F.concat(d, F.lit("123045")))).alias("from_14"))


@query("fn_6_permissions_to_string", """
SELECT l_partkey, l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN 'd' ELSE '-' END ||
       array_to_string(list_transform([l_partkey % 8, l_suppkey % 8, l_orderkey % 8],
         lambda x: ['---', '--x', '-w-', '-wx', 'r--', 'r-x', 'rw-', 'rwx'][x + 1]), '') AS permissions
FROM lineitem""")
def fn_6(spark, sf):
    octal = F.concat(*[(F.col(c) % 8).cast("string") for c in ("l_partkey", "l_suppkey", "l_orderkey")])
    return fx.table(spark, sf, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber",
        paths.permissions_to_string(octal, F.col("l_linenumber") == 1).alias("permissions"))


@query("fn_26_humanbytes", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN b < 1000 THEN CAST(CAST(b AS DOUBLE) AS VARCHAR) || ' Byte' WHEN b < 1000000 THEN format('{:.2f} KB', b / 1000.0)
     WHEN b < 1000000000 THEN format('{:.2f} MB', b / 1e6) ELSE format('{:.2f} GB', b / 1e9) END AS size
FROM (SELECT *, (CASE l_linenumber % 4 WHEN 0 THEN l_suppkey WHEN 1 THEN l_partkey * 1000 WHEN 2 THEN l_partkey * 10000000 ELSE l_orderkey * 100 END) AS b FROM lineitem)""")
def fn_26(spark, sf):
    line = F.col("l_linenumber") % 4
    size = (F.when(line == 0, F.col("l_suppkey")).when(line == 1, F.col("l_partkey") * 1000)
            .when(line == 2, F.col("l_partkey") * 10000000).otherwise(F.col("l_orderkey") * 100))
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", formats.humanbytes(size).alias("size"))


@query("fn_28_month_prefix", """
SELECT filename, CASE WHEN k = 0 THEN strftime(l_shipdate, '%Y-%m') ELSE 'none' END AS month FROM fx_listing""")
def fn_28(spark, sf):
    return fx.listing(spark, sf).select("filename", paths.month_prefix(F.col("filename")).alias("month"))


@query("fn_29_index_name", """
SELECT file_path, CASE WHEN stream = 'domain' THEN 'NPLD-DC' || year(file_ts) WHEN stream = 'selective' THEN 'selective' ELSE 'NPLD-FC' || year(file_ts) END AS index_name
FROM fx_files""")
def fn_29(spark, sf):
    return fx.files(spark, sf).select("file_path", paths.index_name(F.col("stream"), F.year("timestamp")).alias("index_name"))


_RENDERED = """(SELECT '/heritrix/wren/BL-' || lpad(CAST(l_linenumber AS VARCHAR), CASE WHEN l_partkey % 5 = 0 THEN 3 ELSE 4 END, '0') || '-WEBRENDER-frequent-npld-' || strftime(l_shipdate, '%Y%m%d%H%M%S') || '-'
  || l_partkey || '.warc.gz' AS path, l_partkey, l_shipdate FROM lineitem)"""


def _rendered(spark, sf):
    width = F.when(F.col("l_partkey") % 5 == 0, 3).otherwise(4)
    return fx.table(spark, sf, "lineitem").select(
        F.concat(F.lit("/heritrix/wren/BL-"), F.lpad(F.col("l_linenumber").cast("string"), width, F.lit("0")),
                 F.lit("-WEBRENDER-frequent-npld-"), F.date_format("l_shipdate", "yyyyMMddHHmmss"), F.lit("-"),
                 F.col("l_partkey").cast("string"), F.lit(".warc.gz")).alias("path"))


@query("fn_38_wren_destination", f"""
SELECT path, CASE WHEN l_partkey % 5 <> 0 THEN '/heritrix/output/frequent-npld/' || strftime(l_shipdate, '%Y%m%d%H%M%S') || '/warcs' END AS destination FROM {_RENDERED}""")
def fn_38(spark, sf):
    return _rendered(spark, sf).select("path", paths.wren_destination(F.col("path")).alias("destination"))


@query("fn_39_sha512_ok", """
SELECT page_id, page_id % 3 <> 0 AS ok FROM pages""")
def fn_39(spark, sf):
    h = F.when(F.col("page_id") % 3 == 0, F.sha2("url", 256)).otherwise(F.sha2("url", 512))
    return fx.pages(spark, sf).select("page_id", paths.sha512_ok(h).alias("ok"))


@query("fn_40_job_launch_ok", r"""
SELECT l_orderkey, l_linenumber, msg, regexp_full_match(msg, '[a-z]+/[0-9]+') AS ok, regexp_matches(msg, '^[^/]+/[0-9]+') AS ok_any
FROM (SELECT l_orderkey, l_linenumber, CASE l_orderkey % 3 WHEN 0 THEN 'weekly/' || l_partkey WHEN 1 THEN 'frequent-npld/' || l_partkey ELSE l_returnflag || '/x' || l_partkey END AS msg FROM lineitem)""")
def fn_40(spark, sf):
    m, part = F.col("l_orderkey") % 3, F.col("l_partkey").cast("string")
    msg = (F.when(m == 0, F.concat(F.lit("weekly/"), part)).when(m == 1, F.concat(F.lit("frequent-npld/"), part))
           .otherwise(F.concat("l_returnflag", F.lit("/x"), part)))
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", msg.alias("msg")).select(
        "*", paths.job_launch_ok(F.col("msg")).alias("ok"), paths.job_launch_ok(F.col("msg"), any_job=True).alias("ok_any"))


@query("fn_42_add_months_clamped", """
SELECT l_orderkey, l_linenumber, strftime(CAST(l_shipdate AS DATE) + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month,
       strftime(CAST(l_shipdate AS DATE) - INTERVAL 4 MONTH, '%Y-%m-%d') AS four_before FROM lineitem""")
def fn_42(spark, sf):
    d = F.to_date("l_shipdate")
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.date_format(formats.add_months_clamped(d, 1), "yyyy-MM-dd").alias("next_month"),
        F.date_format(formats.add_months_clamped(d, -4), "yyyy-MM-dd").alias("four_before"))


@query("fn_43_listing_record", f"""
SELECT 'hdfs://store' || file_path AS id, 'now' AS refresh_date_dt, file_path AS file_path_s, file_size AS file_size_l, file_ext AS file_ext_s, file_name AS file_name_s,
       permissions AS permissions_s, number_of_replicas AS hdfs_replicas_i, user_id AS hdfs_user_s, group_id AS hdfs_group_s,
       strftime(modified_at, '{_ISO}Z') AS modified_at_dt, strftime(file_ts, '{_ISO}Z') AS timestamp_dt, CAST(year(file_ts) AS INTEGER) AS year_i,
       recognised AS recognised_b, kind AS kind_s, collection AS collection_s, stream AS stream_s, job AS job_s, layout AS layout_s,
       'h3' AS hdfs_service_id_s, 'file' AS hdfs_type_s, 'http://gateway/webhdfs/v1' || file_path || '?op=OPEN&user.name=access' AS access_url_s
FROM fx_files""")
def fn_43(spark, sf):
    return ops.listing_record(fx.files(spark, sf), "h3", "hdfs://store", "http://gateway", refreshed_at=F.lit("now"))


@query("src_5_read_object_inventory", f"""
SELECT 's3a://archive-dc-' || l_linenumber || filename AS id, 'aws_s3' AS hdfs_service_id_s, filename AS file_path_s, filesize AS file_size_l,
       'http://archive-dc-' || l_linenumber || '.s3-website.eu-west-2.amazonaws.com' || filename AS access_url_s,
       'archive-dc-' || l_linenumber AS aws_bucket_name_s, md5(filename) AS aws_e_tag_s, strftime(modified_at, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS aws_modified_at_dt,
       CASE WHEN l_linenumber % 2 = 0 THEN userid ELSE 'id:' || userid END AS hdfs_user_s
FROM fx_listing WHERE l_linenumber < 5""")
def src_5(spark, sf):
    from ..sources.listings import read_object_inventory

    raw = fx.listing_with_line(spark, sf)
    inventory = raw.select(
        F.concat(F.when(F.col("line") < 5, "archive-dc-").otherwise("other-"), F.col("line").cast("string")).alias("bucket"),
        F.expr("substring(filename, 2)").alias("key"), F.col("filesize").alias("size"), F.col("modified_at").alias("last_modified"),
        F.when(F.col("line") % 2 == 0, F.col("userid")).alias("owner_name"), F.col("userid").alias("owner_id"),
        F.lit("STANDARD").alias("storage_class"), F.lit("CRC64").alias("checksum_algorithm"),
        F.concat(F.lit('"'), F.md5("filename"), F.lit('"')).alias("e_tag"), F.lit("eu-west-2").alias("region"))
    return read_object_inventory(inventory, bucket_prefix="archive-dc").select(
        "id", "hdfs_service_id_s", "file_path_s", "file_size_l", "access_url_s", "aws_bucket_name_s", "aws_e_tag_s",
        "aws_modified_at_dt", "hdfs_user_s")


@query("fl_8_empty_files", "SELECT file_path, file_size FROM fx_files WHERE file_size = 0")
def fl_8(spark, sf):
    return ops.empty_files(fx.files(spark, sf)).select("file_path", "file_size")


@query("fl_9_web_archive_files", "SELECT file_path FROM fx_files WHERE file_path LIKE '%.warc.gz'")
def fl_9(spark, sf):
    return ops.web_archive_files(fx.files(spark, sf)).select("file_path")


@query("fl_10_archive_subset", """
SELECT 'selective' AS subset, file_path FROM fx_files WHERE file_path LIKE '%.warc.gz' AND file_path LIKE '/data/%'
UNION ALL SELECT 'npld', file_path FROM fx_files WHERE file_path LIKE '%.warc.gz' AND file_path LIKE '/heritrix/%'""")
def fl_10(spark, sf):
    f = fx.files(spark, sf)
    return (ops.archive_subset(f, "selective").select(F.lit("selective").alias("subset"), "file_path")
            .unionByName(ops.archive_subset(f, "npld").select(F.lit("npld").alias("subset"), "file_path")))


@query("fl_11_path_prefix", """
SELECT file_path, (row_number() OVER (ORDER BY file_path) - 1) // 100 AS chunk
FROM (SELECT DISTINCT file_path FROM fx_files WHERE file_path LIKE '/heritrix/output/%')""")
def fl_11(spark, sf):
    return ops.path_prefix(fx.files(spark, sf), "/heritrix/output/")


@query("fl_12_live_holdings", "SELECT file_path, kind FROM fx_files WHERE kind <> 'to-be-deleted'")
def fl_12(spark, sf):
    return ops.live_holdings(fx.files(spark, sf)).select("file_path", "kind")


@query("fl_13_npld_core", """
SELECT file_path, kind FROM fx_files WHERE collection = 'npld' AND kind IN ('warcs', 'crawl-logs', 'viral')""")
def fl_13(spark, sf):
    return ops.npld_core(fx.files(spark, sf)).select("file_path", "kind")


@query("fl_20_log_files", "SELECT file_path FROM fx_files WHERE file_path LIKE '%/crawl.log%' AND job = 'dc2024'")
def fl_20(spark, sf):
    return ops.log_files(fx.files(spark, sf), job="dc2024").select("file_path")


@query("fl_25_launches_in_interval", """
SELECT DISTINCT job, launch FROM fx_files
WHERE (substr(launch, 1, 8) BETWEEN '19950101' AND '19971231') AND length(launch) >= 8""")
def fl_25(spark, sf):
    return ops.launches_in_interval(fx.files(spark, sf), "1995-01-01", "1997-12-31")


@query("fl_25_warcs_of_launch", """
SELECT f.file_path FROM fx_files f JOIN (SELECT max(launch) AS launch FROM fx_files WHERE job = 'frequent-npld') m USING (launch)
WHERE job = 'frequent-npld' AND file_name LIKE '%.warc.gz'""")
def fl_25w(spark, sf):
    f = fx.files(spark, sf)
    newest = f.filter("job = 'frequent-npld'").agg(F.max("launch").alias("launch"))
    return ops.warcs_of_launch(f, "frequent-npld", newest.scalar())


@query("fl_26_move_plan", f"""
SELECT filename AS file_path, 'copy' AS action, filename AS destination FROM fx_listing
WHERE k = 0 OR (k = 1)
UNION ALL SELECT path, 'move-to-warcs', '/heritrix/output/frequent-npld/' || strftime(l_shipdate, '%Y%m%d%H%M%S') || '/warcs/' || string_split(path, '/')[-1]
FROM {_RENDERED} WHERE l_partkey % 5 <> 0""")
def fl_26(spark, sf):
    both = fx.listing(spark, sf).select("filename").unionByName(_rendered(spark, sf).withColumnRenamed("path", "filename"))
    return ops.move_plan(both)


_KINDS = ["warcs", "crawl-logs", "viral", "logs", "cdx", "dlx", "warcs-invalid", "to-be-deleted", "unknown"]


def _pivot_sql(agg):
    cols = ", ".join(f"CAST({agg} FILTER (WHERE kind = '{k}') AS BIGINT) AS \"{k}\"" for k in _KINDS)
    return f"SELECT collection, stream, CAST(year(file_ts) AS INTEGER) AS year, {cols} FROM fx_files WHERE kind <> 'to-be-deleted' AND collection IS NOT NULL AND stream IS NOT NULL GROUP BY ALL"


@query("ag_6_holdings_by_stream", _pivot_sql("sum(file_size)"))
def ag_6(spark, sf):
    return ops.holdings_by_stream(fx.files(spark, sf), "size")


@query("ag_6_holdings_file_count", "SELECT collection, stream, year, " + ", ".join(f'nullif("{k}", 0) AS "{k}"' for k in _KINDS) + " FROM (" + _pivot_sql("count(file_size)") + ")")
def ag_6c(spark, sf):
    return ops.holdings_by_stream(fx.files(spark, sf), "count")


_CORE = "(SELECT * FROM fx_files WHERE collection = 'npld' AND kind IN ('warcs', 'crawl-logs', 'viral') AND stream IS NOT NULL)"
_HUMAN = "CASE WHEN b < 1000 THEN CAST(CAST(b AS DOUBLE) AS VARCHAR) || ' Byte' WHEN b < 1000000 THEN format('{{:.2f}} KB', b / 1000.0) WHEN b < 1000000000 THEN format('{{:.2f}} MB', b / 1e6) ELSE format('{{:.2f}} GB', b / 1e9) END"


@query("ag_7_npld_by_year", f"""
SELECT year, max({_HUMAN}) FILTER (WHERE stream = 'domain') AS domain, max({_HUMAN}) FILTER (WHERE stream = 'frequent') AS frequent
FROM (SELECT CAST(year(file_ts) AS INTEGER) AS year, stream, sum(file_size) AS b FROM {_CORE} GROUP BY ALL) GROUP BY year""".replace("{{", "{").replace("}}", "}"))
def ag_7(spark, sf):
    return ops.npld_by_year(fx.files(spark, sf))


@query("ag_8_npld_by_month", f"""
SELECT strftime(file_ts, '%Y-%m') AS month, stream, CAST(sum(file_size) AS BIGINT) AS file_size FROM {_CORE} GROUP BY 1, 2""")
def ag_8(spark, sf):
    return ops.npld_by_month(fx.files(spark, sf))


@query("ag_9_npld_totals", f"""
SELECT stream, CAST(sum(file_size) AS BIGINT) AS file_size, count(*) AS file_count FROM {_CORE} GROUP BY stream
UNION ALL SELECT 'total', CAST(sum(file_size) AS BIGINT), count(*) FROM {_CORE}""")
def ag_9(spark, sf):
    return ops.npld_totals(fx.files(spark, sf))




@query("ag_10_collection_by_year", """
SELECT collection, CAST(year(file_ts) AS INTEGER) AS year, CAST(sum(file_size) AS BIGINT) AS file_size FROM fx_files WHERE collection IS NOT NULL GROUP BY ALL""")
def ag_10(spark, sf):
    return ops.size_by_collection_and_year(fx.files(spark, sf))


@query("ag_11_duplicate_files", """
SELECT file_name, count(*) AS n_locations, min(file_path) AS first_path, max(file_path) AS last_path FROM fx_files GROUP BY file_name HAVING count(*) > 1""")
def ag_11(spark, sf):
    return ops.duplicate_files(fx.files(spark, sf))


@query("ag_11_duplicate_locations", """
SELECT file_name, n AS n_locations, file_path FROM (SELECT file_name, file_path, count(*) OVER (PARTITION BY file_name) AS n FROM fx_files) WHERE n > 1""")
def ag_11l(spark, sf):
    return ops.duplicate_locations(fx.files(spark, sf))


@query("ag_11_duplicate_counts", """
SELECT count(*) FILTER (WHERE n > 1) AS duplicated, count(*) FILTER (WHERE n = 1) AS unduplicated FROM (SELECT count(*) AS n FROM fx_files GROUP BY file_name)""")
def ag_11c(spark, sf):
    return ops.duplicate_counts(fx.files(spark, sf))


@query("ag_12_crawl_packages", """
SELECT job, launch, strftime(d, '%Y-%m-%dT%H:%M:%S') AS date, stream, 'crawl-' || stream || ' crawl-' || stream || '-' || job AS tags,
       CASE WHEN stream IN ('frequent', 'domain') THEN 'NPLD ' || job || ' crawl, launched ' || coalesce(strftime(d, '%d %b %Y'), '?')
            WHEN stream = 'selective' THEN 'Selective ' || job || ' crawl, launched ' || coalesce(strftime(d, '%d %b %Y'), '?') END AS title,
       CASE WHEN stream IN ('frequent', 'domain') THEN 'legal-deposit crawls|' || split_part(job, '-', 1) || ' crawl'
            WHEN stream = 'selective' THEN 'selective crawls|' || split_part(job, '-', 1) || ' crawl' END AS categories, total_files, total_bytes
FROM (SELECT job, launch, max(stream) AS stream, max(launch_datetime) AS d, count(*) AS total_files, CAST(sum(file_size) AS BIGINT) AS total_bytes
      FROM fx_files WHERE recognised AND job IS NOT NULL GROUP BY job, launch)""")
def ag_12(spark, sf):
    return ops.crawl_packages(fx.files(spark, sf)).withColumn("tags", F.concat_ws(" ", "tags")).withColumn(
        "categories", F.array_join("categories", "|"))


@query("ag_12_package_files", f"""
SELECT job, launch, file_path AS path, kind, strftime(file_ts, '{_ISO}') AS timestamp, file_size AS filesize, strftime(modified_at, '{_ISO}') AS modified_at
FROM fx_files WHERE recognised AND job IS NOT NULL""")
def ag_12f(spark, sf):
    return ops.package_files(fx.files(spark, sf)).withColumn("timestamp", _iso("timestamp")).withColumn("modified_at", _iso("modified_at"))


@query("ag_13_totals_by_kind", """
SELECT CASE WHEN s IN ('frequent', 'domain') THEN 'npld' WHEN s = 'selective' THEN 'selective' ELSE 'no-collection' END AS collection, s AS stream, kind, n_files, bytes
FROM (SELECT coalesce(stream, 'no-stream') AS s, kind, count(*) AS n_files, CAST(sum(file_size) AS BIGINT) AS bytes FROM fx_files GROUP BY ALL
      UNION ALL SELECT coalesce(stream, 'no-stream'), 'all', count(*), CAST(sum(file_size) AS BIGINT) FROM fx_files GROUP BY ALL)""")
def ag_13(spark, sf):
    return ops.totals_by_kind(fx.files(spark, sf))


@query("ag_14_unparsed_paths", """
SELECT regexp_extract(file_path, '^(.*)/[^/]*$', 1) AS folder, count(*) AS n_files FROM fx_files WHERE NOT recognised GROUP BY 1""")
def ag_14(spark, sf):
    return ops.unparsed_paths(fx.files(spark, sf))


@query("ag_15_listing_totals", """
SELECT count(*) FILTER (WHERE permissions LIKE 'd%') AS n_dirs, count(*) FILTER (WHERE permissions NOT LIKE 'd%') AS n_files,
       CAST(sum(filesize) FILTER (WHERE permissions NOT LIKE 'd%') AS BIGINT) AS n_bytes,
       count(*) FILTER (WHERE permissions NOT LIKE 'd%' AND number_of_replicas < 3) AS n_under_replicated FROM fx_listing""")
def ag_15(spark, sf):
    return ops.listing_totals(fx.listing(spark, sf))


@query("ag_16_extension_counts", """
SELECT file_ext, count(*) AS n_files FROM fx_files GROUP BY file_ext ORDER BY n_files DESC, file_ext NULLS FIRST LIMIT 20""")
def ag_16(spark, sf):
    return ops.extension_counts(fx.files(spark, sf))


@query("st_1_largest_files", """
SELECT file_path, file_size, format('{:.2f} KB', file_size / 1000.0) AS human_size FROM fx_files ORDER BY file_size DESC, file_path LIMIT 20""")
def st_1(spark, sf):
    return ops.largest_files(fx.files(spark, sf))


@query("st_3_logs_by_time", f"""
SELECT strftime(file_ts, '%Y-%m-%d') AS date, strftime(file_ts, '{_ISO}') AS timestamp, collection, stream, job, file_path FROM fx_files WHERE kind = 'crawl-logs'""")
def st_3(spark, sf):
    return ops.logs_by_time(fx.files(spark, sf)).withColumn("date", F.col("date").cast("string")).withColumn("timestamp", _iso("timestamp"))


@query("st_4_warcs_by_date", """
SELECT strftime(file_ts, '%Y-%m-%d') AS date, collection, stream, job, file_path FROM fx_files WHERE kind = 'warcs'""")
def st_4(spark, sf):
    return ops.warcs_by_date(fx.files(spark, sf)).withColumn("date", F.col("date").cast("string"))


@query("wn_4_latest_launch", "SELECT job, max(launch) AS launch FROM fx_files WHERE job IS NOT NULL GROUP BY job")
def wn_4(spark, sf):
    return ops.latest_launch(fx.files(spark, sf))


@query("wn_5_sample_per_class", """
SELECT collection, stream, layout, year, kind, file_path, CAST(rn AS INTEGER) AS sample_no FROM (
  SELECT *, CAST(year(file_ts) AS INTEGER) AS year, row_number() OVER (PARTITION BY collection, stream, layout, year(file_ts), kind ORDER BY md5('42:' || file_path), file_path) AS rn
  FROM fx_files) WHERE rn <= 2""")
def wn_5(spark, sf):
    return ops.sample_per_class(fx.files(spark, sf))


@query("ag_26_tidy_metrics", f"""
SELECT (SELECT count(*) FROM {_RENDERED}) AS wren_warcs, (SELECT count(*) FROM {_RENDERED} WHERE l_partkey % 5 <> 0) AS wren_warcs_matched,
       (SELECT count(*) FROM {_RENDERED} WHERE l_partkey % 5 = 0) AS wren_warcs_nomatch,
       count(*) FILTER (WHERE filename LIKE '/heritrix/output/%warc.gz') AS warcs, count(*) FILTER (WHERE filename LIKE '/heritrix/output/%warc.gz.open') AS warcs_open,
       count(*) FILTER (WHERE filename LIKE '/heritrix/output/%' AND filename NOT LIKE '%warc.gz' AND filename NOT LIKE '%warc.gz.open') AS other_files
FROM fx_listing""")
def ag_26(spark, sf):
    both = fx.listing(spark, sf).select(F.col("filename").alias("file_path")).unionByName(_rendered(spark, sf).withColumnRenamed("path", "file_path"))
    return ops.tidy_metrics(both)


@query("ag_27_log_size_report", """
WITH newest AS (SELECT job, max(launch) AS launch FROM fx_files WHERE job IS NOT NULL GROUP BY job HAVING max(launch) IS NOT NULL),
logs AS (SELECT unnest(['alerts.log', 'crawl.log', 'nonfatal-errors.log', 'progress-statistics.log', 'runtime-errors.log', 'uri-errors.log']) AS log)
SELECT n.job, n.launch, l.log, coalesce(max(f.file_size), 0) AS size FROM newest n CROSS JOIN logs l
LEFT JOIN fx_files f ON f.job = n.job AND f.launch = n.launch AND f.file_name = l.log GROUP BY n.job, n.launch, l.log""")
def ag_27(spark, sf):
    return ops.log_size_report(fx.files(spark, sf))


@query("ag_30_recent_modified_count", """
SELECT count(*) AS n_recent FROM fx_files WHERE modified_at BETWEEN TIMESTAMP '1997-02-28 00:00:00' AND TIMESTAMP '1997-03-31 00:00:00'""")
def ag_30(spark, sf):
    return ops.recent_modified_count(fx.files(spark, sf), F.lit("1997-03-31 00:00:00").cast("timestamp"))
