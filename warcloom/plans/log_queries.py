"""Crawl-log queries: line functions, filters, summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import formats
from ..functions import logs as L
from ..functions import urls as U
from ..operators import logs as ops
from . import frames as fx
from .registry import query

_SEED = "hop_path = '-' AND (via = '-' OR via = url)"
_LIVE = "(regexp_full_match(status_code, '[0-9]+') AND TRY_CAST(status_code AS INTEGER) BETWEEN 200 AND 399)"
_DEAD = "(status_code = '404' AND hop_path = '-' AND via = '-')"


@query("ag_4_count_status_codes", """
SELECT status_code, count(*) AS n FROM fx_log WHERE regexp_matches(status_code, '^-*[0-9]+$') GROUP BY status_code""")
def ag_4(spark, sf):
    return ops.count_status_codes(fx.crawl_log(spark, sf))


@query("fn_7_url_host", """
SELECT event_id, CASE WHEN url LIKE 'dns:%' THEN substr(url, 5) ELSE host END AS host FROM fx_log""")
def fn_7(spark, sf):
    return fx.crawl_log(spark, sf).select("event_id", U.url_host(F.col("url")).alias("host"))


@query("fn_8_url_netloc_nowww", r"""
SELECT event_id, CASE WHEN url LIKE 'dns:%' THEN '' ELSE regexp_replace(split_part(split_part(split_part(url, '/', 3), '?', 1), '#', 1), '^www[0-9]*\.', '') END AS netloc
FROM fx_log""")
def fn_8(spark, sf):
    return fx.crawl_log(spark, sf).select("event_id", U.url_netloc_nowww(F.col("url")).alias("netloc"))


@query("fn_9_tld_second_level", """
SELECT id, split_part(u, '.', -1) AS tld,
       CASE WHEN len(string_split(u, '.')) > 2 AND split_part(u, '.', -2) IN ('ac','co','gov','judiciary','ltd','me','mod','net','nhs','nic','org','parliament','plc','sch')
            THEN split_part(u, '.', -2) END AS second_level, pos
FROM (SELECT id, pos, rtrim(substr(u, 8), '/') AS u FROM
      (SELECT id, unnest(urls) AS u, generate_subscripts(urls, 1) AS pos FROM fx_targets)) WHERE pos = 2""")
def fn_9(spark, sf):
    urls = fx.targets(spark, sf).select("id", F.posexplode("urls").alias("pos", "u")).filter("pos = 1")
    host = U.url_netloc(F.col("u"))
    return urls.select("id", U.tld(host).alias("tld"), U.second_level(host).alias("second_level"),
                       (F.col("pos") + 1).cast("bigint").alias("pos"))


@query("fn_10_surt_simple", r"""
SELECT page_id, 'http://(' || array_to_string(list_reverse(string_split(host, '.')), ',') || ',' ||
       CASE WHEN d IN ('', '/') THEN d ELSE rtrim(d, '/') END AS surt
FROM (SELECT page_id, host, regexp_extract(regexp_extract(url, '^https?://[^/]*([^?#]*)', 1), '^(.*/)', 1) AS d FROM fx_pages)""")
def fn_10(spark, sf):
    return fx.pages(spark, sf).select("page_id", U.surt_simple(F.col("url")).alias("surt"))


@query("fn_11_surt_canonical", "SELECT page_id, surt FROM fx_pages")
def fn_11(spark, sf):
    return fx.pages(spark, sf).select("page_id", U.surt_canonical(F.col("url")).alias("surt"))


_ODD_URLS = ["/a/../b/.//C", "/a%2520b+%C3%89", "/x;jsessionid={id}?q=1", "/x?b=2&sid={id}&a=%31", "/\u00e9 x/..%2Fy", "/%zz/%41?PHPSESSID={id}"]
_ODD_KEYS = ["/b/c", "/a%20b+%c3%89", "/x?q=1", "/x?a=1&b=2", "/y", "/%25zz/a"]


@query("fn_11_surt_of_odd_urls", f"""
SELECT page_id, split_part(surt, ')', 1) || ')' || CASE page_id % 6 {' '.join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_ODD_KEYS))} END AS surt FROM fx_pages""")
def fn_11_odd(spark, sf):
    """Dot segments, nested escapes and session ids on every host."""
    rest = F.replace(F.element_at(F.array(*[F.lit(u) for u in _ODD_URLS]), (F.col("page_id") % 6 + 1).cast("int")), F.lit("{id}"), F.md5("url"))
    return fx.pages(spark, sf).select("page_id", U.surt_canonical(F.concat(F.lit("http://"), F.col("host"), rest)).alias("surt"))


@query("fn_12_surt_authority", """
SELECT page_id, 'http://(' || array_to_string(list_reverse(string_split(host, '.')), ',') || ',' AS surt FROM fx_pages""")
def fn_12(spark, sf):
    return fx.pages(spark, sf).select("page_id", U.surt_authority(F.col("url")).alias("surt"))


@query("fn_13_acl_surt", r"""
SELECT page_id, 'http://(' || CASE WHEN surt LIKE '%)/' THEN substr(surt, 1, length(surt) - 2) || ',' ELSE surt END AS surt
FROM fx_pages""")
def fn_13(spark, sf):
    return fx.pages(spark, sf).select("page_id", U.acl_surt(F.col("url")).alias("surt"))


@query("fn_14_log_day_hour", """
SELECT event_id, strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%SZ') AS day, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS hour
FROM fx_log""")
def fn_14(spark, sf):
    t = F.col("timestamp")
    return fx.crawl_log(spark, sf).select("event_id", L.log_day(t).alias("day"), L.log_hour(t).alias("hour"))


@query("fn_15_log_datetime", "SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms FROM fx_log")
def fn_15(spark, sf):
    return fx.crawl_log(spark, sf).select(
        "event_id", F.unix_millis(L.log_datetime(F.col("timestamp"))).alias("epoch_ms"))


_FACTS = r"""
SELECT event_id, 'lines' AS property, 1 AS amount FROM fx_log
UNION ALL SELECT event_id, 'status_code:' || status_code, 1 FROM fx_log
UNION ALL SELECT event_id, 'content_type:' || mime, 1 FROM fx_log
UNION ALL SELECT event_id, 'hop:' || right(hop_path, 1), 1 FROM fx_log
UNION ALL SELECT event_id, CASE WHEN content_length = '-' THEN 'sum:content_length:-' ELSE 'sum:content_length' END,
                 CASE WHEN content_length = '-' THEN 1 ELSE CAST(content_length AS BIGINT) END FROM fx_log
UNION ALL SELECT event_id, CASE WHEN regexp_full_match(a, '[0-9]+t') THEN 'tries:' || a
                                WHEN regexp_full_match(a, '[0-9]{1,3}(\.[0-9]{1,3}){3}') THEN 'ip:' || a ELSE a END, 1
          FROM (SELECT DISTINCT event_id, unnest(string_split(annotation_string, ',')) AS a FROM fx_log)
          WHERE a <> '-' AND a NOT LIKE 'launchTimestamp:%'"""


@query("fn_16_line_stats", f"SELECT event_id, property, CAST(amount AS BIGINT) AS amount FROM ({_FACTS})")
def fn_16(spark, sf):
    f = F.col("fact")
    return fx.crawl_log(spark, sf).select("event_id", F.explode(L.line_stats()).alias("fact")).select(
        "event_id", L.stat_property(f).alias("property"), L.stat_amount(f).alias("amount"))


@query("fn_17_annotation_kv", r"""
SELECT event_id, regexp_extract(annotation_string, 'ip:([0-9.]+)', 1) AS ip,
       CASE WHEN annotation_string LIKE '%,1: %' THEN regexp_extract(annotation_string, '([^ ]+) FOUND', 1) END AS virus
FROM fx_log WHERE annotation_string <> '-'""")
def fn_17(spark, sf):
    a = F.col("annotations")
    return fx.crawl_log(spark, sf).filter("annotation_string <> '-'").select(
        "event_id", L.annotation_ip(a).alias("ip"), L.annotation_virus(a).alias("virus"))


@query("fn_18_extra_info", """
SELECT event_id, json_extract_string(extra_json, '$.warcFilename') AS warc_filename, json_extract_string(extra_json, '$.warcPrefix') AS warc_prefix
FROM fx_log""")
def fn_18(spark, sf):
    info = L.extra_info(F.col("extra_json"))
    return fx.crawl_log(spark, sf).select(
        "event_id", info["warcFilename"].alias("warc_filename"), info["warcPrefix"].alias("warc_prefix"))


@query("fn_19_wayback_timestamp", "SELECT event_id, start_ts AS wayback_timestamp FROM fx_log")
def fn_19(spark, sf):
    return fx.crawl_log(spark, sf).select(
        "event_id", L.wayback_timestamp(F.col("start_time_plus_duration")).alias("wayback_timestamp"))


@query("fn_20_document_filename", r"""
SELECT page_id, regexp_extract(split_part(split_part(url, '#', 1), '?', 1), '([^/]*)$', 1) AS filename FROM fx_pages""")
def fn_20(spark, sf):
    return fx.pages(spark, sf).select("page_id", U.document_filename(F.col("url")).alias("filename"))


@query("fl_5_seed_results", f"SELECT event_id, url, status_code FROM fx_log WHERE {_SEED}")
def fl_5(spark, sf):
    return ops.seed_results(fx.crawl_log(spark, sf)).select("event_id", "url", "status_code")


@query("fl_6_dead_seed_rows", """
SELECT event_id, url, status_code FROM fx_log
WHERE hop_path = '-' AND via = '-' AND status_code NOT LIKE '2__' AND status_code NOT LIKE '3__'""")
def fl_6(spark, sf):
    return ops.dead_seed_rows(fx.crawl_log(spark, sf)).select("event_id", "url", "status_code")


@query("fl_7_logs_for_host", """
SELECT event_id, url, start_time_plus_duration FROM fx_log
WHERE CASE WHEN url LIKE 'dns:%' THEN substr(url, 5) ELSE host END = 'spam-farm.example.org'""")
def fl_7(spark, sf):
    return ops.logs_for_host(fx.crawl_log(spark, sf), "spam-farm.example.org", ["event_id"]).select(
        "event_id", "url", "start_time_plus_duration")


@query("fl_23_lines_with_valid_status", """
SELECT event_id, status_code FROM fx_log WHERE status_code IN ('200', '302', '304', '404')""")
def fl_23(spark, sf):
    return ops.lines_with_valid_status(fx.crawl_log(spark, sf)).select("event_id", "status_code")


@query("ag_1_summarise_logs", f"""
SELECT strftime(date_trunc('day', l.ts), '%Y-%m-%dT%H:%M:%SZ') AS day,
       CASE WHEN l.url LIKE 'dns:%' THEN substr(l.url, 5) ELSE l.host END AS host, l.source, f.property,
       CAST(sum(f.amount) AS BIGINT) AS amount
FROM ({_FACTS}) f JOIN fx_log l USING (event_id) GROUP BY ALL""")
def ag_1(spark, sf):
    return ops.summarise_logs(fx.crawl_log(spark, sf))


@query("ag_2_summarise_hosts", rf"""
SELECT h AS host, CASE WHEN bool_or({_DEAD}) THEN 'Has Dead Seeds' ELSE 'Live' END AS url_state, split_part(h, '.', -1) AS tld,
       CASE WHEN len(string_split(h, '.')) > 2 AND split_part(h, '.', -2) IN ('ac','co','gov','judiciary','ltd','me','mod','net','nhs','nic','org','parliament','plc','sch')
            THEN split_part(h, '.', -2) END AS second_level,
       count(*) FILTER (WHERE {_LIVE}) AS live_lines, count(*) FILTER (WHERE {_DEAD}) AS dead_seed_lines
FROM (SELECT *, CASE WHEN url LIKE 'dns:%' THEN '' ELSE regexp_replace(host, '^www[0-9]*\.', '') END AS h FROM fx_log)
WHERE {_LIVE} OR {_DEAD} GROUP BY h""")
def ag_2(spark, sf):
    return ops.summarise_hosts(fx.crawl_log(spark, sf))


@query("ag_2_host_histograms", rf"""
WITH live AS (SELECT *, CASE WHEN url LIKE 'dns:%' THEN '' ELSE regexp_replace(host, '^www[0-9]*\.', '') END AS h FROM fx_log WHERE {_LIVE})
SELECT h AS host, 'mime' AS dimension, mime AS value, count(*) AS n FROM live GROUP BY ALL
UNION ALL SELECT h, 'ip', regexp_extract(annotation_string, 'ip:([0-9.]+)', 1) AS v, count(*) FROM live WHERE annotation_string LIKE '%ip:%' GROUP BY h, v
UNION ALL SELECT h, 'virus', 'Eicar-Test-Signature', count(*) FROM live WHERE annotation_string LIKE '%,1: %' GROUP BY h""")
def ag_2h(spark, sf):
    return ops.host_histograms(fx.crawl_log(spark, sf))


@query("ag_3_dead_seeds", f"""
SELECT url || '?u=' || user_id AS url FROM fx_log GROUP BY url, user_id HAVING bool_or({_DEAD}) AND NOT bool_or({_LIVE})""")
def ag_3(spark, sf):
    # One URL per page and user, so that some never succeed.
    log = fx.crawl_log(spark, sf)
    return ops.dead_seeds(log.withColumn("url", F.concat("url", F.lit("?u="), F.col("user_id").cast("string"))))


@query("wn_1_first_n_per_host", """
SELECT h AS host, event_id, CAST(rn AS INTEGER) AS rank_in_host FROM (
  SELECT *, row_number() OVER (PARTITION BY h ORDER BY timestamp, event_id) AS rn
  FROM (SELECT *, CASE WHEN url LIKE 'dns:%' THEN substr(url, 5) ELSE host END AS h FROM fx_log)) WHERE rn <= 5""")
def wn_1(spark, sf):
    return ops.first_n_per_host(fx.crawl_log(spark, sf), 5, ["event_id"]).select("host", "event_id", "rank_in_host")


_HOST_STATS = r"""
SELECT regexp_extract(url, '^https?://([^/]+)/', 1) AS host, status_code, count(*) AS n,
       CAST(coalesce(sum(TRY_CAST(content_length AS BIGINT)), 0) AS BIGINT) AS bytes,
       bool_or(annotation_string LIKE '%serverMaxSuccessKb%') AS reached_cap
FROM fx_log WHERE regexp_extract(url, '^https?://([^/]+)/', 1) <> '' GROUP BY 1, 2"""


@query("ag_19_host_log_stats", _HOST_STATS)
def ag_19(spark, sf):
    return ops.host_log_stats(fx.crawl_log(spark, sf))


@query("ag_20_host_class_report", f"""
SELECT host, CAST(sum(CASE WHEN status_code LIKE '2%' THEN n ELSE 0 END) AS BIGINT) AS n_2xx,
       CAST(sum(CASE WHEN status_code LIKE '3%' THEN n ELSE 0 END) AS BIGINT) AS n_3xx,
       CAST(sum(CASE WHEN status_code LIKE '4%' THEN n ELSE 0 END) AS BIGINT) AS n_4xx,
       CAST(sum(CASE WHEN status_code LIKE '5%' THEN n ELSE 0 END) AS BIGINT) AS n_5xx,
       CAST(sum(bytes) AS BIGINT) AS data_size, bool_or(reached_cap) AS reached_cap
FROM ({_HOST_STATS}) GROUP BY host""")
def ag_20(spark, sf):
    return ops.host_class_report(fx.crawl_log(spark, sf))


@query("ag_22_log_start", "SELECT strftime(min(ts), '%Y-%m-%dT%H:%M:%SZ') AS start_date FROM fx_log")
def ag_22(spark, sf):
    return ops.log_start(fx.crawl_log(spark, sf))


@query("so_3_combine_logs", """
SELECT event_id, count(*) AS n FROM (SELECT event_id FROM fx_log WHERE hop_path = '-' UNION ALL SELECT event_id FROM fx_log) GROUP BY event_id""")
def so_3(spark, sf):
    log = fx.crawl_log(spark, sf)
    return ops.combine_logs(log.filter("hop_path = '-'"), log).groupBy("event_id").agg(F.count("*").alias("n"))


@query("fn_27_human_readable_binary", """
SELECT event_id, CASE WHEN b = 1 THEN '1 byte' WHEN b >= 1099511627776 THEN (b // 1099511627776) || '.0 TB' WHEN b >= 1073741824 THEN (b // 1073741824) || '.0 GB'
       WHEN b >= 1048576 THEN (b // 1048576) || '.0 MB' WHEN b >= 1024 THEN (b // 1024) || '.0 kB' ELSE b || '.0 bytes' END AS size
FROM (SELECT event_id, CAST(content_length AS BIGINT) * event_id AS b FROM fx_log WHERE content_length <> '-')""")
def fn_27(spark, sf):
    size = F.col("content_length").cast("bigint") * F.col("event_id")
    return fx.crawl_log(spark, sf).filter("content_length <> '-'").select(
        "event_id", formats.human_readable_binary(size).alias("size"))
