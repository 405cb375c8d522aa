"""Curation queries: schedules, feeds, collections, titles, access lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import curation as C
from ..functions import formats
from ..functions import urls as U
from ..operators import curation as ops
from . import frames as fx
from .registry import query

OPEN, RESTRICTED = "https://archive.example/open/", "https://archive.example/reading-room?"
NOW = "2024-01-31 00:00:00"


def _ts(text):
    return F.lit(text).cast("timestamp")


def _walk(extra="true"):
    """SQL tree walk; ``extra`` prunes subtrees."""
    return f"""RECURSIVE tree(id, parent_id, name, full_name, order_path, start_date, end_date) AS (
  SELECT id, parent_id, name, name, [id], start_date, end_date FROM fx_collections WHERE parent_id IS NULL AND {extra}
  UNION ALL
  SELECT c.id, c.parent_id, c.name, t.full_name || '|' || c.name, list_append(t.order_path, c.id), c.start_date, c.end_date
  FROM fx_collections c JOIN tree t ON c.parent_id = t.id WHERE {extra.replace('publish', 'c.publish')})"""


@query("fn_30_access_rights", f"""
SELECT id, CASE WHEN is_oa THEN '***Free access' ELSE '***Available only in our Reading Rooms' END AS rights,
       CASE WHEN is_oa THEN '{OPEN}' ELSE '{RESTRICTED}' END || '20240101000000/' || urls[1] AS url FROM fx_targets WHERE len(urls) > 0""")
def fn_30(spark, sf):
    return fx.targets(spark, sf).filter(F.size("urls") > 0).select(
        "id", C.access_rights(F.col("isOA")).alias("rights"),
        C.access_url(F.col("isOA"), F.lit("20240101000000"), F.col("urls")[0], OPEN, RESTRICTED).alias("url"))


@query("fn_31_record_id", "SELECT page_id, '20240101000000/' || to_base64(unhex(md5(url))) AS record_id FROM pages")
def fn_31(spark, sf):
    return fx.pages(spark, sf).select("page_id", formats.record_id(F.lit("20240101000000"), F.col("url")).alias("record_id"))


@query("fn_32_registered_domain", """
SELECT id, u AS host, CASE WHEN u LIKE '%.co.uk' THEN array_to_string(string_split(u, '.')[-3:], '.') ELSE array_to_string(string_split(u, '.')[-2:], '.') END AS domain
FROM (SELECT id, unnest([host, rtrim(substr(urls[2], 8), '/')]) AS u FROM fx_targets WHERE len(urls) > 0)""")
def fn_32(spark, sf):
    hosts = fx.targets(spark, sf).filter(F.size("urls") > 0).select(
        "id", F.explode(F.array("host", U.url_host(F.col("urls")[1]))).alias("host"))
    return hosts.select("id", "host", U.registered_domain(F.col("host")).alias("domain"))


_SUFFIX_LINES = ["// rules", "com", "org", "au", "com.au", "uk", "co.uk  ", "*.ck", "!www.ck", ""]


@query("fn_32_public_suffixes", """
SELECT id, host, CASE WHEN id % 6 = 4 THEN NULL WHEN id % 6 = 5 THEN 'www.ck' ELSE regexp_replace(host, '^www\\.', '') END AS domain FROM (
  SELECT id, CASE id % 6 WHEN 0 THEN 'www.' || l || '.com.au' WHEN 1 THEN 'www.' || l || '.co.uk' WHEN 2 THEN 'www.' || l || '.x' || id || '.ck'
     WHEN 3 THEN 'www.' || l || '.nowhere' WHEN 4 THEN 'x' || l || '.ck' ELSE l || '.www.ck' END AS host
  FROM (SELECT id, string_split(host, '.')[1] AS l FROM fx_targets))""")
def fn_32_suffixes(spark, sf):
    """Hosts under plain, wildcard and exception rules, and under none."""
    i, label = F.col("id"), F.element_at(F.split("host", r"\."), 1)
    forms = [("www.", ".com.au"), ("www.", ".co.uk"), ("www.", None), ("www.", ".nowhere"), ("x", ".ck"), ("", ".www.ck")]
    hosts = [F.concat(F.lit(a), label, F.concat(F.lit(".x"), i.cast("string"), F.lit(".ck")) if b is None else F.lit(b)) for a, b in forms]
    frame = fx.targets(spark, sf).select("id", F.element_at(F.array(*hosts), (i % 6 + 1).cast("int")).alias("host"))
    rules = U.suffix_rules(spark.createDataFrame([(line,) for line in _SUFFIX_LINES], "value string"))
    return U.with_registered_domain(frame, rules)


@query("fn_33_uk_scope", r"""
SELECT id, u, CASE WHEN suffix IN ('uk', 'london', 'wales', 'cymru', 'scot') THEN '.' || suffix ELSE 'not_uk' END AS scope
FROM (SELECT id, u, regexp_extract(u, '\.([a-z]+)/', 1) AS suffix FROM (SELECT id, unnest(urls) AS u FROM fx_targets) WHERE u NOT LIKE '%example%'
      UNION ALL SELECT id, u, 'x' FROM (SELECT id, unnest(urls) AS u FROM fx_targets) WHERE u LIKE '%example%')""")
def fn_33(spark, sf):
    return fx.targets(spark, sf).select("id", F.explode("urls").alias("u")).withColumn("scope", U.uk_scope(F.col("u")))


@query("fn_34_crawl_sheets", """
SELECT id, array_to_string(list_filter([CASE WHEN ignore_robots THEN 'ignoreRobots' END, CASE WHEN scope = 'subdomains' THEN 'subdomainsScope' END,
       CASE depth WHEN 'CAPPED_LARGE' THEN 'higherLimit' WHEN 'DEEP' THEN 'noLimit' END], lambda x: x IS NOT NULL), ',') AS sheets, 1 AS queues FROM fx_targets""")
def fn_34(spark, sf):
    return fx.targets(spark, sf).select(
        "id", F.array_join(C.crawl_sheets(F.col("ignoreRobotsTxt"), F.col("scope"), F.col("depth")), ",").alias("sheets"),
        C.parallel_queues(F.col("seeds")[0]).alias("queues"))


@query("fn_36_seed_variants", r"""
SELECT DISTINCT page_id, variant FROM (
  SELECT page_id, url AS variant FROM pages UNION ALL SELECT page_id, split_part(url, '#', 1) FROM pages
  UNION ALL SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) FROM pages
  UNION ALL SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) || '/' FROM pages)""")
def fn_36(spark, sf):
    p = fx.pages(spark, sf)
    seeds = p.select("page_id", F.explode(F.array("url", F.regexp_extract("url", "^(https?://[^/]+)", 1))).alias("seed"))
    return seeds.select("page_id", F.explode(U.seed_variants(F.col("seed"))).alias("variant")).distinct()


@query("fn_37_resolve_redirect", "SELECT url, location, resolved FROM fx_redirects")
def fn_37(spark, sf):
    return fx.redirects(spark, sf).withColumn("resolved", U.resolve_redirect(F.col("url"), F.col("location")))


@query("fn_41_source_tag", "SELECT id, 'tid:' || id || ':http://' || host || '/' AS source FROM fx_targets")
def fn_41(spark, sf):
    return fx.targets(spark, sf).select("id", C.source_tag(F.col("id"), F.col("seeds")).alias("source"))


@query("fn_44_target_fields", """
SELECT id, title, crawl_frequency, array_to_string(seeds, ' ') AS seeds, watched FROM fx_targets""")
def fn_44(spark, sf):
    return ops.target_fields(fx.targets(spark, sf), ["id", "title", "crawl_frequency", "not_a_field"]).withColumn(
        "seeds", F.array_join("seeds", " "))


@query("fl_15_targets_for_frequency", "SELECT id, title FROM fx_targets WHERE lower(crawl_frequency) = 'daily'")
def fl_15(spark, sf):
    return ops.targets_for_frequency(fx.targets(spark, sf), "Daily").select("id", "title")


_DUE_NOW = "2024-01-29 01:00:00"


@query("fl_16_due_schedules", f"""
SELECT id, frequency, seed, '20240129010000' AS launch_ts, 'tid:' || id || ':' || seeds[1] AS source, 1 AS parallel_queues,
       array_to_string(list_filter([CASE WHEN ignore_robots THEN 'ignoreRobots' END, CASE WHEN scope = 'subdomains' THEN 'subdomainsScope' END,
       CASE depth WHEN 'CAPPED_LARGE' THEN 'higherLimit' WHEN 'DEEP' THEN 'noLimit' END], lambda x: x IS NOT NULL), ',') AS sheets
FROM (SELECT *, unnest(seeds) AS seed FROM (SELECT *, crawl_frequency AS frequency, CAST(schedule_start AS TIMESTAMP) AS s, TIMESTAMP '{_DUE_NOW}' AS n FROM fx_targets)
      WHERE s <= n AND (schedule_end IS NULL OR n <= CAST(schedule_end AS TIMESTAMP)) AND hour(n) = hour(s)
        AND CASE frequency WHEN 'DAILY' THEN true WHEN 'WEEKLY' THEN isodow(n) = isodow(s) WHEN 'MONTHLY' THEN day(n) = day(s)
            WHEN 'QUARTERLY' THEN day(n) = day(s) AND month(n) % 3 = month(s) % 3 WHEN 'SIXMONTHLY' THEN day(n) = day(s) AND month(n) % 6 = month(s) % 6
            WHEN 'ANNUAL' THEN day(n) = day(s) AND month(n) = month(s) ELSE false END)""")
def fl_16(spark, sf):
    return ops.due_schedules(fx.targets(spark, sf), _ts(_DUE_NOW)).drop("id").withColumn(
        "sheets", F.array_join("sheets", ",")).withColumn("id", F.regexp_extract("source", "^tid:([0-9]+):", 1).cast("bigint"))


@query("fl_17_crawl_feed", """
SELECT id, title, array_to_string(seeds, ' ') AS seeds, watched, depth, scope, ignore_robots AS "ignoreRobotsTxt" FROM fx_targets
WHERE crawl_frequency IS NOT NULL AND crawl_frequency <> 'NEVERCRAWL' AND (uk_hosting OR uk_postal_address OR via_correspondence OR professional_judgement)
  AND NOT coalesce(CAST(schedule_end AS TIMESTAMP) < TIMESTAMP '2024-06-01 00:00:00', false)""")
def fl_17(spark, sf):
    t = fx.targets(spark, sf).withColumn(
        "isNPLD", F.col("uk_hosting") | F.col("uk_postal_address") | F.col("via_correspondence") | F.col("professional_judgement"))
    return ops.crawl_feed(t, "all", "npld", _ts("2024-06-01 00:00:00")).drop("schedules").withColumn("seeds", F.array_join("seeds", " "))


@query("fl_18_embargo", f"""
SELECT event_id, start_ts FROM fx_log WHERE floor((epoch(TIMESTAMP '{NOW}') - floor(epoch(ts))) / 86400) > 7""")
def fl_18(spark, sf):
    log = fx.crawl_log(spark, sf).select("event_id", F.substr("start_time_plus_duration", F.lit(1), F.lit(14)).alias("start_ts"))
    return ops.embargo(log, F.try_to_timestamp("start_ts", F.lit("yyyyMMddHHmmss")), _ts(NOW))


_NOW_TITLES = "2024-01-10 00:00:00"
_ELIGIBLE = f"""(SELECT t.*, urls[1] AS url1, f.first_ts, CASE WHEN crawl_frequency = 'NEVERCRAWL' THEN 'blocked' WHEN len(urls) = 0 THEN 'no-urls' WHEN f.first_ts IS NULL THEN 'missing'
  WHEN floor((epoch(TIMESTAMP '{_NOW_TITLES}') - epoch(strptime(f.first_ts, '%Y%m%d%H%M%S'))) / 86400) <= 7 THEN 'embargoed' ELSE 'complete' END AS outcome
  FROM fx_targets t LEFT JOIN (SELECT original, min(timestamp) AS first_ts FROM fx_cdx GROUP BY original) f ON f.original = t.urls[1])"""


@query("fl_19_title_eligibility", f"SELECT id, url1 AS url, first_ts AS first_timestamp, outcome FROM {_ELIGIBLE}")
def fl_19(spark, sf):
    return ops.title_eligibility(fx.targets(spark, sf), fx.cdx(spark, sf), _ts(_NOW_TITLES)).select("id", "url", "first_timestamp", "outcome")


@query("fl_19_title_outcomes", f"SELECT outcome, count(*) AS n FROM {_ELIGIBLE} GROUP BY outcome")
def fl_19o(spark, sf):
    return ops.title_outcomes(ops.title_eligibility(fx.targets(spark, sf), fx.cdx(spark, sf), _ts(_NOW_TITLES)))


@query("jn_12_title_records", f"""
SELECT first_ts || '/' || to_base64(unhex(md5(url1))) AS id, strftime(strptime(first_ts, '%Y%m%d%H%M%S'), '%Y-%m-%dT%H:%M:%S') AS date, url1 AS url, title,
       CASE WHEN is_oa THEN '***Free access' ELSE '***Available only in our Reading Rooms' END AS rights, array_to_string(string_split(host, '.')[-2:], '.') AS publisher,
       CASE WHEN is_oa THEN '{OPEN}' ELSE '{RESTRICTED}' END || first_ts || '/' || url1 AS wayback_url, s.name AS subject
FROM {_ELIGIBLE} e LEFT JOIN fx_subjects s ON s.id = e.subject_ids[1] WHERE outcome = 'complete'""")
def jn_12(spark, sf):
    return ops.title_records(fx.targets(spark, sf), fx.cdx(spark, sf), fx.subjects(spark, sf), _ts(_NOW_TITLES), OPEN, RESTRICTED)


_ANNOTATED = """(SELECT t.scope, unnest(t.urls) AS url, tree.full_name, tree.order_path, t.subject_ids
  FROM fx_collection_targets ct JOIN tree ON tree.id = ct.collection_id JOIN fx_targets t ON t.id = ct.target_id WHERE t.scope IS NOT NULL)"""


@query("jn_10_collection_annotations", f"""
WITH {_walk()} SELECT scope, url, arg_min(full_name, order_path) AS collection, count(DISTINCT full_name) AS n_collections FROM {_ANNOTATED} GROUP BY scope, url""")
def jn_10(spark, sf):
    return ops.collection_annotations(fx.targets(spark, sf), fx.collections(spark, sf), fx.collection_targets(spark, sf))


@query("jn_10_annotation_collections", f"""
WITH {_walk()} SELECT DISTINCT scope, url, full_name FROM {_ANNOTATED}""")
def jn_10c(spark, sf):
    return ops.annotation_collections(fx.targets(spark, sf), fx.collections(spark, sf), fx.collection_targets(spark, sf)).drop("order_path")


@query("jn_10_annotation_subjects", f"""
WITH {_walk()} SELECT DISTINCT scope, url, s.name AS subject FROM (SELECT scope, url, unnest(subject_ids) AS sid FROM {_ANNOTATED}) a JOIN fx_subjects s ON s.id = a.sid""")
def jn_10s(spark, sf):
    return ops.annotation_subjects(fx.targets(spark, sf), fx.collections(spark, sf), fx.collection_targets(spark, sf), fx.subjects(spark, sf))


@query("jn_10_collection_date_ranges", f"WITH {_walk()} SELECT full_name, start_date, end_date FROM tree")
def jn_10d(spark, sf):
    return ops.collection_date_ranges(fx.collections(spark, sf))


@query("jn_11_published_collections", f"""
WITH {_walk('publish')}
SELECT CAST(id AS VARCHAR) AS id, 'collection' AS type, parent_id, name AS title, CAST(NULL AS VARCHAR) AS url, '' AS additional_urls, '' AS licences FROM tree
UNION ALL SELECT 'cid:' || ct.collection_id || '-tid:' || t.id, 'target', ct.collection_id, t.title, t.urls[1], array_to_string(t.urls[2:], ' '),
  CASE WHEN is_oa THEN CASE WHEN len(license_ids) > 0 THEN array_to_string(license_ids, ' ') ELSE '1000' END ELSE '' END
FROM fx_collection_targets ct JOIN tree ON tree.id = ct.collection_id JOIN fx_targets t ON t.id = ct.target_id WHERE len(t.urls) > 0""")
def jn_11(spark, sf):
    out = ops.published_collections(fx.targets(spark, sf), fx.collections(spark, sf), fx.collection_targets(spark, sf))
    return out.withColumns({c: F.coalesce(F.array_join(c, " "), F.lit("")) for c in ("additional_urls", "licences")})


@query("ag_21_scope_counts", r"""
WITH per AS (SELECT *, list_filter(urls, lambda u: u LIKE '%.co.uk/') AS a, list_filter(urls, lambda u: u LIKE '%.london/') AS b, list_filter(urls, lambda u: u LIKE '%.wales/') AS c,
   list_filter(urls, lambda u: u LIKE '%.cymru/') AS d, list_filter(urls, lambda u: u LIKE '%.scot/') AS e FROM fx_targets WHERE crawl_frequency IS NOT NULL),
n AS (SELECT *, len(a) + len(b) + len(c) + len(d) + len(e) AS uk FROM per)
SELECT coalesce(crawl_frequency, 'total') AS frequency, CAST(sum(len(a)) AS BIGINT) AS uk, CAST(sum(len(b)) AS BIGINT) AS london, CAST(sum(len(c)) AS BIGINT) AS wales,
   CAST(sum(len(d)) AS BIGINT) AS cymru, CAST(sum(len(e)) AS BIGINT) AS scot, CAST(sum(len(urls) - uk) AS BIGINT) AS not_uk, CAST(sum(uk) AS BIGINT) AS uk_domain,
   count(*) FILTER (WHERE uk_hosting) AS uk_hosting, count(*) FILTER (WHERE uk_postal_address) AS uk_postal_address,
   count(*) FILTER (WHERE via_correspondence) AS via_correspondence, count(*) FILTER (WHERE professional_judgement) AS professional_judgement
FROM n GROUP BY GROUPING SETS ((crawl_frequency), ())""")
def ag_21(spark, sf):
    return ops.scope_counts(fx.targets(spark, sf))


_SURTS = """(SELECT DISTINCT 'http://(' || CASE WHEN seed_surt LIKE '%)/' THEN substr(seed_surt, 1, length(seed_surt) - 2) || ',' ELSE seed_surt END AS surt, seed AS url FROM fx_seed_surts
  UNION SELECT s, s FROM (SELECT unnest(['http://(com,wp,s0', 'http://(com,wp,s1', 'http://(com,wp,s2', 'http://(com,wordpress,files,', 'http://(com,twimg,', 'http://(com,blogspot,bp,',
  'http://(com,blogblog,img1', 'http://(com,blogblog,img2', 'http://(com,squarespace,static)', 'http://(net,typekit,use)', 'http://(com,blogger,www)/img/', 'http://(com,blogger,www)/static/',
  'http://(com,blogger,www)/dyn-css/', 'http://(net,cloudfront,', 'http://(com,googleusercontent,']) AS s))"""


@query("so_1_access_surts", f"SELECT surt, url FROM {_SURTS}")
def so_1(spark, sf):
    return ops.access_surts(fx.targets(spark, sf))


@query("st_5_acl_rules", f"""
SELECT DISTINCT rtrim(replace(surt, 'http://(', ''), ',') || ' - {{"access": "allow", "url": "' || url || '"}}' AS rule FROM {_SURTS}""")
def st_5(spark, sf):
    return ops.acl_rules(ops.access_surts(fx.targets(spark, sf)))


@query("st_5_acl_whitelist", f"SELECT DISTINCT surt FROM {_SURTS}")
def st_5w(spark, sf):
    return ops.acl_whitelist(ops.access_surts(fx.targets(spark, sf)))


@query("ag_33_acl_counts", f"SELECT count(DISTINCT surt) AS n_surts FROM {_SURTS}")
def ag_33(spark, sf):
    return ops.acl_counts(ops.access_surts(fx.targets(spark, sf)))


@query("so_2_scope_lists", """
SELECT DISTINCT list, seed FROM (SELECT 'in-scope' AS list, unnest(seeds) AS seed FROM fx_targets WHERE crawl_frequency <> 'NEVERCRAWL'
  UNION ALL SELECT 'watched', unnest(seeds) FROM fx_targets WHERE crawl_frequency <> 'NEVERCRAWL' AND watched
  UNION ALL SELECT 'blocked', unnest(seeds) FROM fx_targets WHERE crawl_frequency = 'NEVERCRAWL')""")
def so_2(spark, sf):
    t = fx.targets(spark, sf)
    return ops.scope_lists(ops.crawl_feed(t, "all", "all", include_expired=True), ops.targets_for_frequency(t, "nevercrawl"))


@query("jn_22_new_seeds_only", """
SELECT id, CASE WHEN len(urls) = 0 THEN 'no-urls' WHEN list_has_any(urls, (SELECT list(url) FROM pages WHERE page_id % 2 = 0)) THEN 'known' ELSE 'new' END AS outcome FROM fx_targets""")
def jn_22(spark, sf):
    candidates = fx.targets(spark, sf).select("id", F.col("urls").alias("seeds"))
    existing = fx.pages(spark, sf).filter("page_id % 2 = 0")
    return ops.new_seeds_only(candidates, existing).select("id", "outcome")


def _old_tool(spark, sf):
    """Orders as old-tool targets, their lines as seeds and permissions."""
    orders, lines = fx.table(spark, sf, "orders"), fx.table(spark, sf, "lineitem")
    targets = orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("Target "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderpriority").alias("organisation"), F.concat(F.lit("Customer#"), F.col("o_custkey").cast("string")).alias("owner"))
    seeds = lines.select(
        F.col("l_orderkey").alias("target_id"), F.concat(F.lit("http://site"), F.col("l_partkey").cast("string"), F.lit(".example/")).alias("seed"),
        (F.col("l_linenumber") == 2).alias("primary"))
    permissions = lines.select(
        F.col("l_orderkey").alias("target_id"), F.col("l_shipdate").alias("start_date"), F.col("l_returnflag").alias("agent"),
        F.when(F.col("l_returnflag") == "A", 3).otherwise(2).alias("status"))
    orgs = orders.select(F.col("o_orderpriority").alias("name")).distinct().filter("name NOT LIKE '4%'").select(
        "name", F.substr("name", F.lit(1), F.lit(1)).cast("int").alias("id"))
    people = fx.table(spark, sf, "customer").filter("c_custkey % 2 = 0").select(
        F.concat(F.lit("Customer#"), F.col("c_custkey").cast("string")).alias("name"), F.col("c_custkey").alias("id"))
    groups = lines.select(
        F.col("l_orderkey").alias("target_id"), F.concat(F.lit("NATION_"), (F.col("l_suppkey") % 40).cast("string")).alias("group_name"),
        F.when(F.col("l_linenumber") % 2 == 0, "Subject").otherwise("Collection").alias("group_type"))
    return targets, seeds, permissions, orgs, people, groups


@query("jn_23_migrate_targets", """
SELECT o.o_orderkey AS id, 'Target ' || o.o_orderkey AS title, CASE WHEN o.o_orderpriority NOT LIKE '4%' THEN CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) END AS organisation_id,
       c.c_custkey AS selector_id, s.first_seed, s.n_seeds, CASE WHEN p.target IS NOT NULL THEN 'GRANTED' END AS licence_status, epoch_ms(p.start_date) AS permission_created, p.agent
FROM orders o JOIN (SELECT l_orderkey, count(*) AS n_seeds, arg_min('http://site' || l_partkey || '.example/', (CASE WHEN l_linenumber = 2 THEN 0 ELSE 1 END, 'http://site' || l_partkey || '.example/')) AS first_seed FROM lineitem GROUP BY 1) s ON s.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey AND c.c_custkey % 2 = 0
LEFT JOIN (SELECT l_orderkey AS target, max(l_shipdate) AS start_date, arg_max(l_returnflag, (l_shipdate, l_returnflag)) AS agent FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1) p ON p.target = o.o_orderkey""")
def jn_23(spark, sf):
    targets, seeds, permissions, orgs, people, _ = _old_tool(spark, sf)
    return ops.migrate_targets(targets, seeds, permissions, orgs, people)


@query("jn_23_migrated_links", """
SELECT DISTINCT l_orderkey AS target_id, CASE WHEN l_linenumber % 2 = 0 THEN 'subject' ELSE 'collection' END AS kind,
       CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey % 40 ELSE 100 + l_suppkey % 40 END AS linked_id FROM lineitem WHERE l_suppkey % 40 < 25""")
def jn_23l(spark, sf):
    groups = _old_tool(spark, sf)[5]
    nation = fx.table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("bigint").alias("id"))
    return ops.migrated_links(groups, nation.withColumn("id", F.col("id") + 100), nation)
