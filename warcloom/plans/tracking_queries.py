"""Tracking, reconciliation, packaging and crawler-status queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import crawler, packaging, recon
from ..operators import tracking as ops
from . import frames as fx
from . import workflows
from .registry import query

_TS = "%Y-%m-%dT%H:%M:%S.%g"


def _lit_ts(text):
    return F.lit(text).cast("timestamp")


_NOT_INDEXED = "NOT coalesce(list_has_any(cdx_index_ss, ['npld-cdx', 'npld-cdx-v2']), false)"


@query("fl_1_track_query", f"""
SELECT id, stream_s, file_size_l FROM fx_tracked WHERE kind_s = 'warcs' AND stream_s = 'frequent' AND year_i = 1996 AND {_NOT_INDEXED}
""")
def fl_1(spark, sf):
    return ops.track_query(fx.tracked(spark, sf), "warcs", stream="frequent", year=1996, field="-cdx_index_ss", value="npld-cdx*").select(
        "id", "stream_s", "file_size_l")


@query("fl_1_track_unset", "SELECT id FROM fx_tracked WHERE kind_s = 'warcs-invalid' AND cdx_index_ss IS NULL")
def fl_1u(spark, sf):
    return ops.track_query(fx.tracked(spark, sf), "warcs-invalid", field="cdx_index_ss", value="_NONE_").select("id")


@query("fl_2_track_get", "SELECT id, kind_s FROM fx_tracked WHERE id = (SELECT min(id) FROM fx_tracked WHERE kind_s = 'cdx') AND kind_s = 'cdx'")
def fl_2(spark, sf):
    t = fx.tracked(spark, sf)
    one = t.filter("kind_s = 'cdx'").agg(F.min("id").alias("id")).first().id
    return ops.track_get(t, "cdx", one).select("id", "kind_s")


@query("fl_3_that_day", f"""
SELECT file_path, strftime(modified_at, '{_TS}') AS modified_at FROM fx_files WHERE modified_at BETWEEN TIMESTAMP '1996-05-01' AND TIMESTAMP '1996-05-02'""")
def fl_3(spark, sf):
    return fx.files(spark, sf).filter(ops.on_that_day(F.col("modified_at"), _lit_ts("1996-05-01 09:30:00"))).select(
        "file_path", F.date_format("modified_at", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("modified_at"))


@query("fl_14_recent_tracked", """
SELECT id, kind_s FROM fx_tracked WHERE kind_s IN ('warcs', 'crawl-logs', 'logs') AND modified_at_dt >= TIMESTAMP '1998-11-01 12:00:00'""")
def fl_14(spark, sf):
    t = fx.tracked(spark, sf).withColumn("refresh_date_dt", F.col("modified_at_dt"))
    return ops.recent_tracked(t, _lit_ts("1998-11-02 12:00:00")).select("id", "kind_s")


@query("fl_24_delete_by_values", "SELECT id, job_s FROM fx_tracked WHERE job_s IS NULL OR job_s NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size > 10)")
def fl_24(spark, sf):
    values = fx.table(spark, sf, "part").filter("p_size > 10").select(F.col("p_partkey").cast("string").alias("value"))
    return ops.delete_by_values(fx.tracked(spark, sf), "job_s", values).select("id", "job_s")


@query("fl_24_delete_preview", "SELECT count(*) AS n_matching FROM fx_tracked WHERE job_s IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size > 10)")
def fl_24p(spark, sf):
    values = fx.table(spark, sf, "part").filter("p_size > 10").select(F.col("p_partkey").cast("string").alias("value"))
    return ops.delete_preview(fx.tracked(spark, sf), "job_s", values)


@query("jn_6_not_yet_indexed", f"SELECT id FROM fx_tracked WHERE kind_s = 'warcs' AND {_NOT_INDEXED}")
def jn_6(spark, sf):
    return ops.not_yet_indexed(fx.tracked(spark, sf), "cdx_index_ss", "npld-cdx").select("id")


@query("st_6_warcs_for_dates", """
SELECT file_path_s FROM fx_tracked WHERE kind_s = 'warcs' AND stream_s = 'frequent' AND CAST(timestamp_dt AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'
  AND NOT coalesce(list_contains(cdx_index_ss, 'npld-cdx'), false)""")
def st_6(spark, sf):
    return ops.warcs_for_dates(fx.tracked(spark, sf), "1996-01-01", "1996-06-30", "frequent", "cdx_index_ss", "npld-cdx")


_INCOMING = """(SELECT 'hdfs://' || filename AS id, filesize, l_linenumber FROM fx_listing WHERE permissions NOT LIKE 'd%')"""


@query("snk_4_upsert_ignore", f"""
SELECT id, min((filesize, l_linenumber))[1] AS filesize, min((filesize, l_linenumber))[2] AS line FROM {_INCOMING}
WHERE id NOT IN (SELECT id FROM fx_tracked WHERE file_size_l % 2 = 0) GROUP BY id""")
def snk_4(spark, sf):
    incoming = fx.listing_with_line(spark, sf).filter(~F.col("permissions").startswith("d")).select(
        F.concat(F.lit("hdfs://"), "filename").alias("id"), "filesize", "line")
    existing = fx.tracked(spark, sf).filter("file_size_l % 2 = 0")
    return ops.upsert_ignore(existing, incoming, "id", [F.col("filesize"), F.col("line")])


def _updates(spark, sf):
    """Updates from order lines: by line number set, clear, add, remove, inc."""
    line = F.col("l_linenumber")
    rows = fx.table(spark, sf, "lineitem").select(
        F.concat(F.lit("order:"), F.col("l_orderkey").cast("string")).alias("id"),
        F.when(line.isin(1, 2), "status_s").when(line.isin(3, 4, 5), "tags_ss").otherwise("count_l").alias("field"),
        F.when(line.isin(1, 2), "set").when(line.isin(3, 4), "add-distinct").when(line == 5, "remove").otherwise("inc").alias("action"),
        F.when(line == 1, F.col("l_returnflag")).when(line == 2, F.when(F.col("l_partkey") % 2 == 0, "").otherwise(F.col("l_linestatus")))
        .when(line.isin(3, 4, 5), F.concat(F.lit("t"), (F.col("l_suppkey") % 3).cast("string")))
        .otherwise((F.col("l_partkey") % 10).cast("string")).alias("value"),
        (line * 100000000000000 + F.col("l_partkey") * 100000000 + F.floor("l_extendedprice")).alias("seq"))
    return rows


@query("snk_5_apply_updates", """
WITH u AS (SELECT 'order:' || l_orderkey AS id, l_linenumber AS line, l_linenumber * 100000000000000 + l_partkey * 100000000 + CAST(floor(l_extendedprice) AS BIGINT) AS seq, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem),
s AS (SELECT id, arg_max(CASE WHEN line = 1 THEN l_returnflag WHEN l_partkey % 2 = 0 THEN '' ELSE l_linestatus END, seq) AS v FROM u WHERE line IN (1, 2) GROUP BY id),
m AS (SELECT id, 't' || (l_suppkey % 3) AS tag, arg_max(line = 5, seq) AS gone FROM u WHERE line IN (3, 4, 5) GROUP BY ALL),
c AS (SELECT id, CAST(sum(l_partkey % 10) AS BIGINT) AS n FROM u WHERE line > 5 GROUP BY id),
b AS (SELECT 'order:' || o_orderkey AS id, o_orderstatus AS status_s, o_custkey AS count_l, ['t' || (o_custkey % 3)] AS tags FROM orders WHERE o_orderkey % 2 = 0),
ids AS (SELECT id FROM b UNION SELECT id FROM u),
tags AS (SELECT id, string_agg(tag, ' ' ORDER BY tag) AS tags_ss FROM (
   SELECT id, tags[1] AS tag FROM b WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.id = b.id AND m.tag = b.tags[1] AND gone) UNION SELECT id, tag FROM m WHERE NOT gone) GROUP BY id)
SELECT ids.id, CASE WHEN s.id IS NOT NULL THEN nullif(s.v, '') ELSE b.status_s END AS status_s, coalesce(tags.tags_ss, '') AS tags_ss,
       CASE WHEN c.id IS NOT NULL THEN coalesce(b.count_l, 0) + c.n ELSE b.count_l END AS count_l
FROM ids LEFT JOIN b USING (id) LEFT JOIN s USING (id) LEFT JOIN c USING (id) LEFT JOIN tags USING (id)""")
def snk_5(spark, sf):
    base = fx.table(spark, sf, "orders").filter("o_orderkey % 2 = 0").select(
        F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_orderstatus").alias("status_s"),
        F.array(F.concat(F.lit("t"), (F.col("o_custkey") % 3).cast("string"))).alias("tags_ss"), F.col("o_custkey").alias("count_l"))
    return ops.apply_updates(base, _updates(spark, sf)).withColumn("tags_ss", F.coalesce(F.array_join(F.array_sort("tags_ss"), " "), F.lit("")))


@query("snk_5_refused_updates", "SELECT 'order:' || l_orderkey AS id, 'new_s' AS field, l_returnflag AS value FROM lineitem")
def snk_5_refused(spark, sf):
    base = fx.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status_s"))
    known = _updates(spark, sf).filter("field = 'status_s'")
    unknown = fx.table(spark, sf, "lineitem").select(
        F.concat(F.lit("order:"), F.col("l_orderkey").cast("string")).alias("id"), F.lit("new_s").alias("field"), F.lit("set").alias("action"),
        F.col("l_returnflag").alias("value"), F.col("l_linenumber").cast("bigint").alias("seq"))
    return ops.refused_updates(base, known.select("id", "field", "action", "value", "seq").unionByName(unknown)).select("id", "field", "value")


@query("snk_6_import_records", """
SELECT CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN k = 5 THEN filename ELSE 'hdfs://' || filename END AS id, 'warcs' AS kind_s,
       CASE WHEN l_orderkey % 7 = 0 THEN 'id missing' WHEN k = 5 THEN 'id is not a store id' END AS import_error FROM fx_listing""")
def snk_6(spark, sf):
    # Same rows as the listing, ids spoiled by order key.
    lines = fx.listing_with_order(spark, sf)
    records = lines.select(
        F.when(F.col("l_orderkey") % 7 == 0, F.lit(None)).when(F.col("l_orderkey") % 6 == 5, F.col("filename"))
        .otherwise(F.concat(F.lit("hdfs://"), "filename")).alias("id"))
    return ops.import_records(records, "warcs")


@query("jn_7_verify_search_index", """
SELECT t.file_path_s AS file_path, coalesce(d.n, 0) AS n_documents, d.n IS NOT NULL AS found FROM fx_tracked t
LEFT JOIN (SELECT file_name, count(*) AS n FROM fx_files WHERE file_size % 3 = 0 GROUP BY 1) d ON d.file_name = t.file_name_s WHERE t.kind_s = 'warcs'""")
def jn_7(spark, sf):
    warcs = fx.tracked(spark, sf).filter("kind_s = 'warcs'").select(F.col("file_path_s").alias("file_path"))
    docs = fx.files(spark, sf).filter("file_size % 3 = 0").select(F.col("file_path").alias("source_file"))
    return ops.verify_search_index(warcs, docs)


@query("jn_7_verify_totals", """
SELECT count(*) FILTER (WHERE f) AS found, count(*) FILTER (WHERE NOT f) AS missing FROM (SELECT file_name_s IN (SELECT file_name FROM fx_files WHERE file_size % 3 = 0) AS f FROM fx_tracked WHERE kind_s = 'warcs')""")
def jn_7t(spark, sf):
    return ops.verify_totals(jn_7(spark, sf))


_FILE_METRICS = """(SELECT file_path AS filename, count(*) AS warc_record_count, CAST(sum(file_size) AS BIGINT) AS warc_record_bytes FROM fx_files WHERE file_size % 2 = 0 GROUP BY 1)"""


@query("jn_8_merge_item_metrics", f"""
SELECT t.id, warc_record_count, warc_record_bytes, 'npld-cdx' AS cdx_status FROM fx_tracked t LEFT JOIN {_FILE_METRICS} m ON m.filename = t.file_path_s WHERE kind_s = 'warcs'""")
def jn_8(spark, sf):
    items = fx.tracked(spark, sf).filter("kind_s = 'warcs'").select(F.concat(F.lit("hdfs://store:54310"), "file_path_s").alias("id"))
    metrics = fx.files(spark, sf).filter("file_size % 2 = 0").groupBy(F.col("file_path").alias("filename")).agg(
        F.count("*").alias("warc_record_count"), F.sum("file_size").alias("warc_record_bytes"))
    return ops.merge_item_metrics(items, metrics, "cdx_status", "npld-cdx").withColumn("id", F.regexp_replace("id", "store:54310", ""))


@query("jn_9_tracked_status", """
SELECT count(*) FILTER (WHERE d) AS warcs, count(*) FILTER (WHERE d AND t) AS warcs_in_tracking, count(*) FILTER (WHERE d AND NOT t) AS warcs_not_in_tracking,
       count(*) FILTER (WHERE filename LIKE '%warc.gz.open') AS warcs_open, count(*) FILTER (WHERE NOT d AND filename NOT LIKE '%warc.gz.open') AS other_files
FROM (SELECT filename, filename LIKE '%warc.gz' AS d, filename IN (SELECT file_path_s FROM fx_tracked WHERE file_size_l % 2 = 0) AS t FROM fx_listing)""")
def jn_9(spark, sf):
    disk = fx.listing(spark, sf).select(F.col("filename").alias("file_path"))
    return ops.tracked_status(disk, fx.tracked(spark, sf).filter("file_size_l % 2 = 0"))


def _task_events(spark, sf):
    e = fx.table(spark, sf, "events")
    return e.select(
        F.concat(F.lit("user-"), (F.col("user_id") % 10).cast("string")).alias("task"), F.col("event_id").alias("id"), F.col("ts").alias("finished_at"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"), F.floor("value").alias("runtime_secs"))


@query("ag_29_task_outcomes", """
SELECT 'user-' || (user_id % 10) AS task, count(*) AS runs, count(*) FILTER (WHERE event_type <> 'error') AS successes,
       arg_max(CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END, (ts, event_id)) AS last_status,
       CAST(arg_max(floor(value), (ts, event_id)) AS BIGINT) AS last_runtime_secs, CAST(sum(floor(value)) AS BIGINT) AS total_runtime_secs FROM events GROUP BY 1""")
def ag_29(spark, sf):
    return ops.task_outcomes(_task_events(spark, sf))


def _unindexed_cdx(spark, sf):
    """Index rows spread over the stored WARC paths."""
    f = fx.files(spark, sf).filter("kind = 'warcs'")
    return f.select(
        F.lit("com,example)/").alias("urlkey"), F.date_format("timestamp", "yyyyMMddHHmmss").alias("timestamp"), F.lit("http://example.com/").alias("original"),
        F.when(F.col("file_size") % 5 == 0, "999").otherwise("200").alias("statuscode"), F.col("file_size").alias("length"), F.col("file_size").alias("offset"),
        F.col("file_path").alias("filename"))


@query("wf_1_index_batch", f"""
WITH items AS (SELECT id, file_path_s FROM fx_tracked WHERE kind_s = 'warcs' AND {_NOT_INDEXED})
SELECT i.id, 'npld-cdx' AS status, count(*) FILTER (WHERE file_size % 5 <> 0) AS warc_record_count, CAST(coalesce(sum(file_size) FILTER (WHERE file_size % 5 <> 0), 0) AS BIGINT) AS warc_record_bytes,
  count(*) FILTER (WHERE file_size % 5 = 0) AS malformed_status_count
FROM items i JOIN fx_files f ON f.file_path = i.file_path_s AND f.kind = 'warcs' GROUP BY i.id""")
def wf_1(spark, sf):
    items, _ = workflows.index_batch(fx.tracked(spark, sf), _unindexed_cdx(spark, sf), "npld-cdx")
    return items.select("id", "status", "warc_record_count", "warc_record_bytes", "malformed_status_count")


@query("wf_3_log_analysis_run", """
SELECT 'summary' AS output, count(*) AS n FROM (SELECT DISTINCT CASE WHEN url LIKE 'dns:%' THEN substr(url, 5) ELSE host END, source FROM fx_log WHERE timestamp LIKE '2024-01-10%')
UNION ALL SELECT 'documents', count(*) FROM fx_candidates WHERE timestamp LIKE '2024-01-10%'
UNION ALL SELECT 'seeds', count(*) FROM fx_log WHERE timestamp LIKE '2024-01-10%' AND hop_path = '-' AND (via = '-' OR via = url)""")
def wf_3(spark, sf):
    out = workflows.log_analysis_run(fx.crawl_log(spark, sf), fx.targets(spark, sf), "2024-01-10")
    parts = [out["summary"].filter("property = 'lines'"), out["documents"], out["seeds"]]
    rows = [d.agg(F.count("*").alias("n")).select(F.lit(name).alias("output"), "n") for name, d in zip(("summary", "documents", "seeds"), parts)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("wf_5_daily_reports", """
SELECT 'duplicates' AS report, count(*) AS n FROM (SELECT 1 FROM fx_files GROUP BY file_name HAVING count(*) > 1)
UNION ALL SELECT 'empty', count(*) FROM fx_files WHERE file_size = 0
UNION ALL SELECT 'unparsed-file-paths', count(DISTINCT regexp_extract(file_path, '^(.*)/[^/]*$', 1)) FROM fx_files WHERE NOT recognised
UNION ALL SELECT 'totals-by-kind', count(*) FROM (SELECT 1 FROM fx_files GROUP BY GROUPING SETS ((stream, kind), (stream)))""")
def wf_5(spark, sf):
    reports = workflows.daily_reports(fx.files(spark, sf), fx.stored(spark, sf))
    rows = [reports[name].agg(F.count("*").alias("n")).select(F.lit(name).alias("report"), "n")
            for name in ("duplicates", "empty", "unparsed-file-paths", "totals-by-kind")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query("wf_6_job_sanity", """
SELECT filename, 'warc_record_count is zero' AS problem FROM (SELECT file_path AS filename, count(*) FILTER (WHERE file_size % 5 <> 0) AS n FROM fx_files WHERE kind = 'warcs' GROUP BY 1) WHERE n = 0""")
def wf_6(spark, sf):
    from ..operators.captures import cdx_file_metrics

    return workflows.sanity_problems(cdx_file_metrics(_unindexed_cdx(spark, sf)), "warc_record_count").select("filename", "problem")


# Reconciliation

def _stores(spark, sf):
    """Source: parts by size; target: parts as suppliers' lines saw them."""
    part = fx.table(spark, sf, "part")
    name = F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("name")
    source = part.filter("p_partkey % 7 <> 0").select(name, F.col("p_size").cast("bigint").alias("length"), F.md5("p_name").alias("hash"))
    target = part.filter("p_partkey % 3 <> 0").select(
        name, F.when(F.col("p_partkey") % 5 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")).cast("bigint").alias("length"),
        F.when(F.col("p_partkey") % 11 == 0, F.md5("p_brand")).otherwise(F.md5("p_name")).alias("hash"))
    return source, target


@query("jn_13_reconcile_stores", """
SELECT 'f' || p_partkey AS name, CASE WHEN p_partkey % 7 = 0 THEN 'target-only' WHEN p_partkey % 3 = 0 THEN 'move' WHEN p_partkey % 5 = 0 THEN 'size-conflict'
  WHEN p_partkey % 11 = 0 THEN 'hash-conflict' ELSE 'same' END AS action FROM part WHERE NOT (p_partkey % 7 = 0 AND p_partkey % 3 = 0)""")
def jn_13(spark, sf):
    return recon.reconcile_stores(*_stores(spark, sf))


@query("jn_14_sync_needed", """
SELECT 'f' || p_partkey AS path, CAST(p_size AS BIGINT) AS length, CASE WHEN p_partkey % 3 = 0 THEN 'missing' ELSE 'size-differs' END AS reason
FROM part WHERE p_partkey % 7 <> 0 AND p_size > 0 AND (p_partkey % 3 = 0 OR p_partkey % 5 = 0)""")
def jn_14(spark, sf):
    s, t = (d.withColumnRenamed("name", "path") for d in _stores(spark, sf))
    return recon.sync_needed(s, t)


@query("jn_14_merged_sync_needed", """
SELECT p_brand AS "group", CAST(sum(p_size) AS BIGINT) AS parts_length, CASE WHEN p_brand LIKE '%1' THEN NULL ELSE CAST(sum(p_size) AS BIGINT) + 1 END AS merged_length
FROM part WHERE p_brand LIKE '%1' OR p_brand LIKE '%2' GROUP BY p_brand""")
def jn_14m(spark, sf):
    part = fx.table(spark, sf, "part")
    parts = part.select(F.col("p_brand").alias("group"), F.col("p_size").cast("bigint").alias("length"))
    merged = parts.filter("group NOT LIKE '%1'").groupBy("group").agg(F.sum("length").alias("length"))
    merged = merged.withColumn("length", F.when(F.col("group").endswith("2"), F.col("length") + 1).otherwise(F.col("length")))
    return recon.merged_sync_needed(parts, merged)


@query("jn_15_hash_match", """
SELECT p_partkey AS path, CASE WHEN p_partkey % 7 = 0 THEN 'missing' WHEN p_partkey % 5 = 0 THEN 'malformed' WHEN p_partkey % 11 = 0 THEN 'differs' ELSE 'ok' END AS outcome FROM part""")
def jn_15(spark, sf):
    part, k = fx.table(spark, sf, "part"), F.col("p_partkey")
    local = part.select(k.alias("path"), F.sha2("p_name", 512).alias("sha512"))
    remote = part.filter("p_partkey % 7 <> 0").select(
        k.alias("path"), F.when(k % 5 == 0, F.md5("p_name")).when(k % 11 == 0, F.sha2(F.concat("p_name", F.lit("x")), 512))
        .otherwise(F.upper(F.sha2("p_name", 512))).alias("sha512"))
    return recon.hash_match(local, remote)


@query("jn_16_sip_arks_available", """
WITH per AS (SELECT l_orderkey, count(*) AS n, bool_and(p_size > 5) AS ok FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'bad message ' || o_orderkey ELSE 'weekly/' || o_orderkey END AS message, coalesce(n, 0) AS n_arks,
  CASE WHEN o_orderkey % 10 = 0 THEN 'error' WHEN o_orderdate >= TIMESTAMP '1998-06-01' - INTERVAL 7 DAY THEN 'embargo' WHEN n IS NULL THEN 'no-arks' WHEN ok THEN 'ok' ELSE 'retry' END AS outcome
FROM orders LEFT JOIN per ON l_orderkey = o_orderkey""")
def jn_16(spark, sf):
    orders, lines, part = (fx.table(spark, sf, t) for t in ("orders", "lineitem", "part"))

    def message(k):
        return F.concat(F.when(F.col(k) % 10 == 0, "bad message ").otherwise("weekly/"), F.col(k).cast("string")).alias("message")

    sips = orders.select(message("o_orderkey"), F.col("o_orderdate").alias("launched_at"))
    arks = lines.select(message("l_orderkey"), F.col("l_partkey").alias("ark"))
    return recon.sip_arks_available(sips, arks, part.filter("p_size > 5").select(F.col("p_partkey").alias("ark")), _lit_ts("1998-06-01 00:00:00"))


@query("jn_17_mets_files", """
SELECT l_orderkey AS package, l_linenumber AS admid, min(l_partkey) AS ark, n <> s OR n <> i AS count_mismatch, count(*) AS n
FROM (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem) JOIN (SELECT l_orderkey AS o, count(*) AS n, count(DISTINCT l_linenumber) AS i, count(DISTINCT l_linenumber) FILTER (WHERE l_linenumber < 6) AS s FROM lineitem GROUP BY 1) ON o = l_orderkey
WHERE l_linenumber < 6 GROUP BY ALL HAVING true""".replace("min(l_partkey) AS ark, ", ""))
def jn_17(spark, sf):
    lines = fx.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("package"), F.col("l_linenumber").alias("admid"))
    secs = lines.distinct().withColumn("ark", F.when(F.col("admid") < 6, F.concat(F.lit("ark:/"), F.col("admid").cast("string"))))
    return recon.mets_files(lines, secs).groupBy("package", "admid", "count_mismatch").agg(F.count("*").alias("n"))


@query("jn_18_warc_to_ark", """
SELECT file_path AS path, CASE WHEN k THEN 'ark:/1/' || md5(file_name) END AS ark FROM (SELECT file_path, file_name, file_name IN (SELECT file_name FROM fx_files GROUP BY 1 HAVING max(file_size) % 2 = 0) AS k FROM fx_files WHERE kind = 'warcs')""")
def jn_18(spark, sf):
    f = fx.files(spark, sf)
    arks = f.groupBy(F.col("file_name").alias("name")).agg(F.max("file_size").alias("m")).filter("m % 2 = 0").select(
        "name", F.concat(F.lit("ark:/1/"), F.md5("name")).alias("ark"))
    return recon.warc_to_ark(f.filter("kind = 'warcs'").select(F.col("file_path").alias("path")), arks).select("path", "ark")


@query("so_5_outside_manifest", "SELECT file_path AS path FROM fx_files WHERE file_path NOT IN (SELECT file_path FROM fx_files WHERE file_size % 2 = 0)")
def so_5(spark, sf):
    f = fx.stored(spark, sf).select(F.col("file_path").alias("path"), "file_size")
    return recon.outside_manifest(f.select("path"), f.filter("file_size % 2 = 0"))


@query("wn_9_assign_identifiers", """
SELECT path, kind, n AS ordinal, 'ark:/1/x' || lpad(CAST(n AS VARCHAR), 6, '0') AS identifier, lpad(CAST(n AS VARCHAR), CAST(greatest(4, length(CAST(n AS VARCHAR))) AS INTEGER), '0') AS admin_id
FROM (SELECT path, kind, row_number() OVER (ORDER BY CASE kind WHEN 'warcs' THEN 0 WHEN 'viral' THEN 1 ELSE 2 END, path) AS n
      FROM (SELECT DISTINCT file_path AS path, CASE WHEN kind = 'crawl-logs' THEN 'logs' ELSE kind END AS kind FROM fx_files WHERE kind IN ('warcs', 'crawl-logs')))""")
def wn_9(spark, sf):
    f = fx.files(spark, sf).filter("kind IN ('warcs', 'crawl-logs')").select(
        F.col("file_path").alias("path"), F.when(F.col("kind") == "crawl-logs", "logs").otherwise(F.col("kind")).alias("kind")).distinct()
    return recon.assign_identifiers(f, "ark:/1/x")


# Packaging

def _stages(spark, sf, job=None):
    job = F.concat(F.lit("job-"), F.col("user_id").cast("string")) if job is None else job
    return fx.table(spark, sf, "events").select(
        job.alias("job"), F.lit("20240101000000").alias("launch"),
        F.when(F.col("event_id") % 50 == 7, "final").otherwise(F.date_format("ts", "yyyyMMdd000000")).alias("stage"), "event_id", "event_type", "ts")


_STAGES = """(SELECT 'job-' || user_id AS job, CASE WHEN event_id % 50 = 7 THEN 'final' ELSE strftime(ts, '%Y%m%d') || '000000' END AS stage, event_id, event_type FROM events)"""
_VERSIONS = f"""(SELECT job, stage, row_number() OVER (PARTITION BY job ORDER BY stage = 'final', stage) AS version FROM (SELECT DISTINCT job, stage FROM {_STAGES}))"""


# The packages of five jobs, as long as the log has days.
_JOB_STAGES = """(SELECT 'job-' || (user_id % 5) AS job, CASE WHEN event_id % 50 = 7 THEN 'final' ELSE strftime(ts, '%Y%m%d') || '000000' END AS stage, event_id, event_type FROM events)"""
_JOB_VERSIONS = f"""(SELECT job, stage, row_number() OVER (PARTITION BY job ORDER BY stage = 'final', stage) AS version FROM (SELECT DISTINCT job, stage FROM {_JOB_STAGES}))"""


@query("wn_7_incremental_packages", f"""
SELECT a.job, a.stage, CAST(a.version AS INTEGER) AS version, string_agg(b.stage, ' ' ORDER BY b.version) AS stages FROM {_JOB_VERSIONS} a JOIN {_JOB_VERSIONS} b ON a.job = b.job AND b.version <= a.version GROUP BY ALL""")
def wn_7(spark, sf):
    job = F.concat(F.lit("job-"), (F.col("user_id") % 5).cast("string"))
    return packaging.running_lists(_stages(spark, sf, job)).select("job", "stage", "version", F.array_join("stages", " ").alias("stages"))


@query("wn_7_running_lists", f"""
SELECT a.job, CAST(a.version AS INTEGER) AS version, string_agg(b.stage, ' ' ORDER BY b.version) AS stages FROM {_VERSIONS} a JOIN {_VERSIONS} b ON a.job = b.job AND b.version <= a.version GROUP BY ALL""")
def wn_7_lists(spark, sf):
    """The stages of each version, written out: as many lists as stages, each as long as its number."""
    stages = packaging.incremental_packages(_stages(spark, sf))
    held = stages.withColumn("version", F.explode(F.sequence("first_version", "last_version")))
    lists = held.groupBy("job", "version").agg(F.sort_array(F.collect_list(F.struct("first_version", "stage"))).alias("held"))
    return lists.select("job", "version", F.array_join(F.col("held.stage"), " ").alias("stages"))


def _package_parts(spark, sf):
    s = _stages(spark, sf)
    items = s.select("job", "launch", "stage", F.lit("hashes").alias("field"), F.col("event_type").alias("key"), F.col("event_id").cast("string").alias("value"))
    listed = s.filter("event_id % 3 = 0").select("job", "launch", "stage", F.lit("files").alias("field"), F.lit(None).cast("string").alias("key"), F.col("event_id").cast("string").alias("value"))
    items = items.unionByName(listed)
    scalars = s.groupBy("job", "launch", "stage").agg(F.min("event_id").cast("string").alias("value")).withColumn("field", F.lit("start_date"))
    return packaging.package_merge(items, scalars)


@query("ag_25_package_merge", f"""
WITH per AS (SELECT job, stage, event_type AS key, max(CAST(event_id AS VARCHAR)) AS value FROM {_STAGES} GROUP BY ALL),
sc AS (SELECT job, stage, CAST(min(event_id) AS VARCHAR) AS value FROM {_STAGES} GROUP BY ALL),
v AS (SELECT *, max(version) OVER (PARTITION BY job) AS versions FROM {_VERSIONS}),
x AS (SELECT job, 'hashes' AS field, key, value, version, lead(version) OVER (PARTITION BY job, key ORDER BY version) - 1 AS until, versions FROM per JOIN v USING (job, stage)
  UNION ALL SELECT job, 'start_date', NULL, value, version, lead(version) OVER (PARTITION BY job ORDER BY version) - 1, versions FROM sc JOIN v USING (job, stage)
  UNION ALL SELECT job, 'files', NULL, CAST(event_id AS VARCHAR), version, NULL, versions FROM {_STAGES} JOIN v USING (job, stage) WHERE event_id % 3 = 0)
SELECT job, field, key, value, CAST(version AS INTEGER) AS first_version, CAST(coalesce(until, versions) AS INTEGER) AS last_version FROM x""")
def ag_25(spark, sf):
    entries, scalars = _package_parts(spark, sf)
    columns = ["job", "field", "key", "value", "first_version", "last_version"]
    return entries.select(*columns).unionByName(scalars.withColumn("key", F.lit(None).cast("string")).select(*columns))


@query("ag_25_package_version", f"""
WITH per AS (SELECT job, stage, event_type AS key, max(CAST(event_id AS VARCHAR)) AS value FROM {_STAGES} GROUP BY ALL)
SELECT p.job, p.key, arg_max(p.value, b.version) AS value FROM {_VERSIONS} b JOIN per p ON p.job = b.job AND p.stage = b.stage WHERE b.version <= 3 GROUP BY ALL""")
def ag_25_version(spark, sf):
    """The map entries that the third version of each package holds, or the last one of shorter packages."""
    entries, _ = _package_parts(spark, sf)
    wanted = F.least(F.lit(3), F.max("last_version").over(Window.partitionBy("job", "launch")))
    return packaging.holding(entries.filter("key IS NOT NULL").withColumn("wanted", wanted), F.col("wanted")).select("job", "key", "value")


# Crawler status

def _reports(spark, sf):
    per = fx.table(spark, sf, "events").groupBy((F.col("user_id") % 20).alias("s"), (F.col("event_id") % 16).alias("p")).agg(F.max("event_id").alias("o"))
    line = F.concat(F.lit("  partition: "), F.col("p").cast("string"), F.lit(", offset: "), F.col("o").cast("string"))
    # At most sixteen lines per service.
    return per.groupBy(F.concat(F.lit("http://crawler-"), F.col("s").cast("string")).alias("service")).agg(
        F.concat_ws("\n", F.lit("report"), F.sort_array(F.collect_list(line))).alias("message"))


_OFFSETS = "(SELECT 'http://crawler-' || (user_id % 20) AS service, event_id % 16 AS p, max(event_id) AS o FROM events GROUP BY ALL)"


@query("ag_23_kafka_offsets", f"""
WITH x AS (SELECT *, count(DISTINCT service) OVER (PARTITION BY p) > 1 AS shared FROM {_OFFSETS})
SELECT service, CAST(sum(o) AS BIGINT) AS kafka_consumed, count(DISTINCT p) AS n_partitions, count(DISTINCT CASE WHEN shared THEN p END) AS n_shared_partitions
FROM x GROUP BY GROUPING SETS ((service), ())""")
def ag_23(spark, sf):
    return crawler.kafka_offsets(_reports(spark, sf))


@query("jn_27_crawler_with_kafka", f"""
SELECT url, status, kafka_consumed, kafka_partitions FROM (SELECT 'http://crawler-' || user_id AS url, min(event_type) AS status FROM events GROUP BY 1) s
LEFT JOIN (SELECT service, CAST(sum(o) AS BIGINT) AS kafka_consumed, count(*) AS kafka_partitions FROM {_OFFSETS} GROUP BY 1) k ON k.service = s.url""")
def jn_27(spark, sf):
    status = fx.table(spark, sf, "events").groupBy(F.concat(F.lit("http://crawler-"), F.col("user_id").cast("string")).alias("url")).agg(F.min("event_type").alias("status"))
    return crawler.crawler_with_kafka(status, _reports(spark, sf))


def _status(spark, sf):
    agg = fx.table(spark, sf, "events").groupBy("user_id").agg(
        F.count("*").alias("n"), F.sum(F.floor("value")).alias("v"), F.count_if(F.col("event_type") == "click").alias("c"))
    text = lambda c: F.col(c).cast("string")
    names = {}
    for _, _, path in crawler.REPORT_METRICS:
        group, name = path.split(".")
        names.setdefault(group, []).append(name)
    known = {"downloadedUriCount": text("n"), "totalUriCount": text("v"), "congestionRatio": F.when(F.col("n") % 2 == 0, "NaN").otherwise("0.5")}
    zero = F.when(F.col("n") % 2 == 0, F.lit(None).cast("string")).otherwise("0")  # a missing counter counts as 0
    groups = []
    for group, fields in names.items():
        columns = [known.get(f, zero).alias(f) for f in fields]
        if group == "threadReport":
            columns.append(F.array(F.concat(text("c"), F.lit(" ABOUT_TO_GET_URI")), F.lit("noise")).alias("steps"))
            columns.append(F.array(F.concat(text("n"), F.lit(" noActiveProcessor"))).alias("processors"))
        groups.append(F.struct(*columns).alias(group))
    return agg.select(F.lit("frequent").alias("job_name"), F.lit("prod").alias("deployment"), text("user_id").alias("id"), F.struct(*groups).alias("report"))


@query("ag_24_crawler_metrics", """
WITH a AS (SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS n, sum(floor(value)) AS v, count(*) FILTER (WHERE event_type = 'click') AS c FROM events GROUP BY 1)
SELECT metric, 'frequent' AS job, 'prod' AS deployment, id, kind, value FROM (
  SELECT id, 'uris' AS metric, 'downloaded' AS kind, CAST(n AS DOUBLE) AS value FROM a UNION ALL SELECT id, 'uris', 'queued', CAST(v AS DOUBLE) FROM a
  UNION ALL SELECT id, 'threads', 'congestion-ratio', CASE WHEN n % 2 = 0 THEN NULL ELSE 0.5 END FROM a
  UNION ALL SELECT id, 'threads', 'step-about_to_get_uri', CAST(c AS DOUBLE) FROM a UNION ALL SELECT id, 'threads', 'processor-noactiveprocessor', CAST(n AS DOUBLE) FROM a
  UNION ALL SELECT id, m[1], m[2], 0.0 FROM a, (SELECT unnest([['uris', 'novel'], ['uris', 'deduplicated'], ['uris', 'deepest-queue-depth'], ['uris', 'average-queue-depth'], ['bytes', 'novel'], ['bytes', 'deduplicated'],
    ['bytes', 'warc-novel-content'], ['queues', 'total'], ['queues', 'in-process'], ['queues', 'ready'], ['queues', 'snoozed'], ['queues', 'active'], ['queues', 'inactive'], ['queues', 'ineligible'], ['queues', 'retired'],
    ['queues', 'exhausted'], ['threads', 'total'], ['threads', 'busy'], ['threads', 'toe-count']]) AS m))""")
def ag_24(spark, sf):
    return crawler.crawler_metrics(_status(spark, sf))


@query("jn_26_totals_with_counts", """
SELECT stream, CAST(sum(file_size) AS BIGINT) AS file_size, count(*) AS file_count FROM fx_files WHERE collection = 'npld' AND kind IN ('warcs', 'crawl-logs', 'viral') GROUP BY 1
UNION ALL SELECT 'total', CAST(sum(file_size) AS BIGINT), count(*) FROM fx_files WHERE collection = 'npld' AND kind IN ('warcs', 'crawl-logs', 'viral')""")
def jn_26(spark, sf):
    from ..operators.holdings import npld_totals

    return npld_totals(fx.files(spark, sf))

