"""Document-harvest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import harvest as ops
from ..operators.captures import available_in_index
from ..session import cut_lineage
from . import frames as fx
from .capture_queries import cdx_table, with_misses
from .registry import query

_DOC_NAME = r"regexp_extract(regexp_replace(split_part(split_part(url, '#', 1), '?', 1), '^dns:', ''), '([^/]*)$', 1)"


@query("jn_1_watched_prefix_join", "SELECT event_id, url, via FROM fx_watched_hits")
def jn_1(spark, sf):
    return ops.watched_prefix_join(fx.crawl_log(spark, sf), fx.targets(spark, sf)).select("event_id", "url", "via")


@query("jn_1_watched_prefix_both", """
SELECT event_id, url, via FROM fx_log l
WHERE EXISTS (SELECT 1 FROM fx_seed_surts s WHERE s.watched AND starts_with(l.url_surt, s.seed_surt) AND starts_with(l.via_surt, s.seed_surt))""")
def jn_1b(spark, sf):
    log = fx.crawl_log(spark, sf)
    return ops.watched_prefix_join(log, fx.targets(spark, sf), both=True).select("event_id", "url", "via")


@query("fl_4_document_candidates", f"""
SELECT url AS document_url, start_ts AS wayback_timestamp, {_DOC_NAME} AS filename, source, via AS landing_page_url, 'frequent-npld' AS job_name,
       TRY_CAST(content_length AS BIGINT) AS size, 'NEW' AS status FROM fx_candidates""")
def fl_4(spark, sf):
    return ops.document_candidates(fx.crawl_log(spark, sf), fx.targets(spark, sf), "frequent-npld").drop("launch_id", "title", "target_id")


@query("jn_2_target_by_source", "SELECT event_id, (SELECT max(id) FROM fx_seeds s WHERE s.seed = 'http://' || l.host || '/') AS target_id FROM fx_log l")
def jn_2(spark, sf):
    log = fx.crawl_log(spark, sf).withColumn("host", F.lower(F.coalesce(F.nullif(F.regexp_extract("url", "^https?://([^/?#:]+)", 1), F.lit("")), F.expr("substring(url, 5)"))))
    return ops.target_by_source(log.withColumn("source", F.concat(F.lit("http://"), "host", F.lit("/"))), fx.targets(spark, sf)).select("event_id", "target_id")


def documents(spark, sf):
    """Candidates, first per URL, with the publishers a landing page names."""
    c = ops.document_candidates(fx.crawl_log(spark, sf), fx.targets(spark, sf))
    c = c.groupBy("document_url").agg(F.min(F.struct("wayback_timestamp", "landing_page_url", "size", "source")).alias("d")).select("document_url", "d.*")
    label = F.element_at(F.split(U.url_netloc(F.col("landing_page_url")), r"\."), 1)
    return c.withColumn("publishers", F.array(F.lit(""), F.upper(label))).withColumn("status", F.lit("NEW"))


_DOCS = """(SELECT url AS document_url, min((start_ts, via, TRY_CAST(content_length AS BIGINT), source))[1] AS wayback_timestamp,
  min((start_ts, via, TRY_CAST(content_length AS BIGINT), source))[2] AS landing_page_url FROM fx_candidates GROUP BY url)"""
_RESOLVED = rf"""(SELECT d.*, CASE WHEN n = 1 THEN first_id ELSE by_title END AS target_id FROM {_DOCS} d LEFT JOIN (
  SELECT document_url, count(DISTINCT t.id) AS n, min(t.id) AS first_id, min(t.id) FILTER (WHERE contains(lower(t.title), lower(split_part(h, '.', 1)))) AS by_title
  FROM (SELECT *, regexp_extract(landing_page_url, '^https?://([^/?#]+)', 1) AS h FROM {_DOCS}) x JOIN fx_seeds t ON t.watched
    AND (h = regexp_extract(t.seed, '^http://([^/]+)', 1) OR h LIKE '%.' || regexp_extract(t.seed, '^http://([^/]+)', 1)) GROUP BY 1) USING (document_url))"""


@query("jn_3_resolve_target", f"SELECT document_url, landing_page_url, target_id FROM {_RESOLVED}")
def jn_3(spark, sf):
    return ops.resolve_target(documents(spark, sf), fx.targets(spark, sf)).select("document_url", "landing_page_url", "target_id")


@query("jn_4_available_in_index", f"""
SELECT document_url, wayback_timestamp FROM {_DOCS} d WHERE EXISTS (SELECT 1 FROM fx_cdx c WHERE CASE WHEN "offset" % 3000 = 0 THEN original || '#gone' ELSE original END = d.document_url AND c.timestamp = d.wayback_timestamp AND mimetype <> 'warc/revisit')""")
def jn_4(spark, sf):
    index = cdx_table(spark, sf, with_misses(fx.cdx(spark, sf)))
    return available_in_index(documents(spark, sf), index, buckets=16).select("document_url", "wayback_timestamp")


_NOW = "2024-04-10 00:00:00"


@query("wn_8_next_batch", f"""
SELECT document_url FROM {_DOCS} WHERE wayback_timestamp > strftime(TIMESTAMP '{_NOW}' - INTERVAL 90 DAY, '%Y%m%d%H%M%S')
ORDER BY md5('42:' || document_url), document_url LIMIT 100""")
def wn_8(spark, sf):
    return ops.next_batch(documents(spark, sf), 100, F.lit(_NOW).cast("timestamp")).select("document_url")


@query("wf_2_process_documents", f"""
SELECT document_url, target_id, CASE WHEN target_id IS NULL THEN 'REJECTED' ELSE 'ACCEPTED' END AS status FROM {_RESOLVED} d
WHERE EXISTS (SELECT 1 FROM fx_cdx c WHERE c.original = d.document_url AND c.timestamp = d.wayback_timestamp AND mimetype <> 'warc/revisit')""")
def wf_2(spark, sf):
    return ops.process_documents(documents(spark, sf), fx.cdx(spark, sf), fx.targets(spark, sf)).select("document_url", "target_id", "status")


@query("fl_27_document_urls", """
SELECT DISTINCT url FROM fx_log WHERE mime = 'application/pdf'""")
def fl_27(spark, sf):
    return ops.document_urls(fx.crawl_log(spark, sf))


@query("jn_20_trace_routes", """
WITH RECURSIVE links AS (SELECT DISTINCT url, via AS referrer FROM fx_log WHERE status_code IN ('200', '302', '304') AND url LIKE 'http%' AND via LIKE 'http%'),
home AS (SELECT url FROM fx_pages WHERE page_id % 6 = 0),
walk(document, route, node, done) AS (
  SELECT url, [url], url, false FROM fx_pages
  UNION ALL
  SELECT w.document, list_append(w.route, l.referrer), l.referrer, l.referrer IN (SELECT url FROM home) FROM walk w JOIN links l ON l.url = w.node
  WHERE NOT w.done AND len(w.route) <= 20 AND NOT list_contains(w.route, l.referrer)),
arrived AS (SELECT document, route, len(route) - 1 AS hops FROM walk WHERE done),
kept AS (SELECT *, min(hops) OVER (PARTITION BY document) AS nearest FROM arrived),
best AS (SELECT document, route FROM kept WHERE hops = nearest)
SELECT document, route[-1] AS seed, route[2] AS landing_page, array_to_string(route, ' ') AS route FROM best
UNION ALL SELECT DISTINCT url, NULL, NULL, NULL FROM fx_pages WHERE url NOT IN (SELECT document FROM best)""")
def jn_20(spark, sf):
    log = fx.crawl_log(spark, sf)
    p = fx.pages(spark, sf)
    out = cut_lineage(ops.trace_routes(p, ops.referrer_links(log), p.filter("page_id % 6 = 0")))
    none = F.lit(None).cast("string")
    lost = ops.unreached(p, out).select("document", none.alias("seed"), none.alias("landing_page"), none.alias("route"))
    return out.withColumn("route", F.array_join("route", " ")).unionByName(lost)


def _stored(spark, sf):
    """Stored WARC paths: numbered crawler files and rendered ones, from the events' users."""
    e = fx.table(spark, sf, "events")
    n = F.col("user_id") % 20
    place = F.when(n % 5 == 0, "viral").when(n % 5 == 1, "wren").otherwise("warcs")
    crawler = e.filter("user_id % 20 < 15").select(F.concat(F.lit("/out/"), place, F.lit("/w"), n.cast("string"), F.when(n % 2 == 0, ".warc.gz").otherwise(".warc.gz.open")).alias("path"))
    rendered = e.filter("user_id % 7 < 5").select(F.concat(F.lit("/out/wren/wren-"), (F.col("user_id") % 7).cast("string"), F.lit("-"), (F.col("user_id") % 3).cast("string"), F.lit(".warc.gz")).alias("path"))
    return crawler.unionByName(rendered).distinct()


_STORED = """(SELECT DISTINCT path, replace(string_split(path, '/')[-1], '.open', '') AS name FROM (
  SELECT '/out/' || CASE (user_id % 20) % 5 WHEN 0 THEN 'viral' WHEN 1 THEN 'wren' ELSE 'warcs' END || '/w' || (user_id % 20) || CASE WHEN user_id % 2 = 0 THEN '.warc.gz' ELSE '.warc.gz.open' END AS path FROM events WHERE user_id % 20 < 15
  UNION ALL SELECT '/out/wren/wren-' || (user_id % 7) || '-' || (user_id % 3) || '.warc.gz' FROM events WHERE user_id % 7 < 5))"""
_MENTIONED = f"""(SELECT DISTINCT json_extract_string(extra_json, '$.warcFilename') AS name FROM fx_log WHERE TRY_CAST(status_code AS INTEGER) > 0 AND extra_json LIKE '%warcFilename%'
  UNION SELECT s.name FROM {_STORED} s JOIN (SELECT DISTINCT json_extract_string(extra_json, '$.warcPrefix') AS p FROM fx_log WHERE TRY_CAST(status_code AS INTEGER) > 0 AND extra_json LIKE '%warcPrefix%') x
  ON starts_with(s.name, x.p))"""


@query("jn_21_warcs_for_logs", f"""
SELECT m.name, CASE WHEN s.path IS NULL THEN 'missing' ELSE string_split(s.path, '/')[3] END AS place, s.path FROM {_MENTIONED} m LEFT JOIN {_STORED} s USING (name)""")
def jn_21(spark, sf):
    return ops.warcs_for_logs(fx.crawl_log(spark, sf), _stored(spark, sf))


@query("so_4_additional_warcs", f"""
SELECT name, path FROM (SELECT name, path FROM {_STORED} UNION ALL SELECT DISTINCT 'extra-' || user_id || '.warc.gz', '/extra/extra-' || user_id || '.warc.gz' FROM fx_log)
WHERE name NOT IN (SELECT name FROM {_MENTIONED})""")
def so_4(spark, sf):
    extra = fx.crawl_log(spark, sf).select(F.concat(F.lit("/extra/extra-"), F.col("user_id").cast("string"), F.lit(".warc.gz")).alias("path")).distinct()
    stored = _stored(spark, sf).select("path").unionByName(extra).withColumn("name", F.regexp_replace(U.basename(F.col("path")), r"\.open$", ""))
    return ops.additional_warcs(stored, ops.warcs_for_logs(fx.crawl_log(spark, sf), _stored(spark, sf)))
