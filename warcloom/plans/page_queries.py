"""Web-page, reader and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import curation as C
from ..operators import curation, pages
from ..schemas import CRAWL_LOG_FIELDS
from ..sources import cdx as cdx_source
from ..sources import crawl_logs, listings, packages, sinks
from . import frames as fx
from .registry import query

_NAV = r"""(SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) AS n FROM pages)"""
_ROOT = r"regexp_extract(url, '^(https?://[^/?#]+)', 1)"


def _html(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", "url", "html")


@query("tx_7_page_outlinks", f"SELECT DISTINCT {_ROOT} || href AS url, url AS referrer FROM {_NAV}")
def tx_7(spark, sf):
    return pages.page_outlinks(_html(spark, sf))


@query("tx_1_landing_page_title", f"""
WITH hit AS (SELECT {_ROOT} || l.href AS document_url, url AS landing_page_url, n, l.href FROM {_NAV} l
  UNION ALL SELECT 'http://nowhere.example/' || page_id, url, 99, NULL FROM pages),
 first_link AS (SELECT DISTINCT h.document_url, h.landing_page_url, (SELECT min(n) FROM {_NAV} k WHERE k.url = h.landing_page_url AND contains(regexp_extract(k.url, '^(https?://[^/?#]+)', 1) || k.href, h.document_url)) AS m FROM hit h)
SELECT f.document_url, f.landing_page_url, CASE WHEN f.m IS NOT NULL THEN substr(k.href, 2)
   ELSE replace(trim(regexp_extract(p.html, '<h1>([^<]*)</h1>', 1)), '&amp;', '&') END AS title
FROM first_link f JOIN pages p ON p.url = f.landing_page_url LEFT JOIN {_NAV} k ON k.url = f.landing_page_url AND k.n = f.m""")
def tx_1(spark, sf):
    p = _html(spark, sf)
    root = F.regexp_extract("url", "^(https?://[^/?#]+)", 1)
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), 1)
    linked = p.select(F.col("url").alias("landing_page_url"), root.alias("root"), F.explode(hrefs).alias("href")).select(
        F.concat("root", "href").alias("document_url"), "landing_page_url")
    absent = p.select(F.concat(F.lit("http://nowhere.example/"), F.col("page_id").cast("string")).alias("document_url"), F.col("url").alias("landing_page_url"))
    return pages.landing_page_title(p, linked.unionByName(absent))


def _publication_page(spark, sf):
    """The pages' own bodies inside the publication and schema.org markup."""
    attachment = F.concat(
        F.lit('<div class="attachment-details"><h2 class="title"><a href="/files/d'), F.col("page_id").cast("string"), F.lit('.pdf">Report '),
        F.col("page_id").cast("string"), F.lit('</a></h2><p><span class="references"><span class="isbn"> 978'), F.col("page_id").cast("string"),
        F.lit("</span><span>"), F.when(F.col("page_id") % 3 == 0, "HC 12").otherwise("Ref 12"), F.lit("</span></span></p></div>"))
    schema = F.concat(
        F.lit('<div itemscope itemtype="http://schema.org/CreativeWork"><h2 itemprop="name">Paper '), F.col("page_id").cast("string"),
        F.lit('</h2><meta itemprop="datePublished" content="2019-01-0'), (F.col("page_id") % 9 + 1).cast("string"),
        F.lit('"><span itemprop="author"><a>A. Writer</a></span><table><tr><td>ISBN:</td><td>978-'), F.col("page_id").cast("string"),
        F.lit('</td></tr><tr><td>DOI:</td><td><a>10.1/'), F.col("page_id").cast("string"),
        F.lit('</a></td></tr></table></div><footer><div itemtype="http://schema.org/Organization"><b itemprop="name">Org</b></div></footer>'))
    return _html(spark, sf).select("page_id", "url", F.concat("html", attachment, schema).alias("html"))


@query("tx_2_publication_metadata", """
SELECT 'http://host/files/d' || page_id || '.pdf' AS document_url, true AS matched, 'Report ' || page_id AS title, '978' || page_id AS isbn,
       CASE WHEN page_id % 3 = 0 THEN 'Command and Act Papers' END AS publisher FROM pages""")
def tx_2(spark, sf):
    p = _publication_page(spark, sf)
    name = F.concat(F.lit("d"), F.col("page_id").cast("string"), F.lit(".pdf"))
    docs = p.select(F.concat(F.lit("http://host/files/"), name).alias("document_url"), name.alias("filename"), F.col("url").alias("landing_page_url"))
    return pages.publication_metadata(p, docs)


@query("tx_4_schema_org_metadata", f"""
SELECT {_ROOT} || '/d.pdf' AS document_url, url AS landing_page_url, 'Paper ' || page_id AS title, '2019-01-0' || (page_id % 9 + 1) AS publication_date, 'A. Writer' AS authors, 'Org' AS publishers,
       '978-' || page_id AS isbn, '10.1/' || page_id AS doi FROM pages WHERE {_ROOT} LIKE '%example.org%'""")
def tx_4(spark, sf):
    p = _publication_page(spark, sf)
    docs = p.select(F.concat(F.regexp_extract("url", "^(https?://[^/?#]+)", 1), F.lit("/d.pdf")).alias("document_url"), F.col("url").alias("landing_page_url"))
    return pages.schema_org_metadata(p, docs, "example.org").withColumns({c: F.array_join(c, " ") for c in ("authors", "publishers")})


@query("tx_3_content_api_metadata", """
SELECT url, 'P' || page_id AS title, CASE WHEN page_id % 2 = 0 THEN '2020-02-02' ELSE '2019-01-01' END AS publication_date, 'Dept A|' || host AS publishers FROM fx_pages""")
def tx_3(spark, sf):
    p = fx.pages(spark, sf)
    body = F.to_json(F.struct(
        F.concat(F.lit("P"), F.col("page_id").cast("string")).alias("title"), F.lit("2019-01-01").alias("first_published_at"),
        F.when(F.col("page_id") % 2 == 0, "2020-02-02").alias("public_updated_at"),
        F.struct(F.array(F.struct(F.lit("Dept A").alias("title")), F.struct(F.col("host").alias("title"))).alias("organisations")).alias("links")))
    out = pages.content_api_metadata(p.select("url", body.alias("body")))
    return out.withColumn("publishers", F.array_join("publishers", "|"))


@query("tx_5_route_extractor", """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'publication' WHEN 1 THEN 'schema-org' ELSE 'default' END AS extractor FROM pages""")
def tx_5(spark, sf):
    k = F.col("page_id") % 3
    url = F.when(k == 0, F.concat(F.lit("https://dept.gov.uk/"), F.md5("url"))).when(k == 1, F.concat(F.lit("http://www.ifs.org.uk/"), F.md5("url"))).otherwise(F.col("url"))
    return fx.pages(spark, sf).select("page_id", pages.route_extractor(url).alias("extractor"))


def har(spark, sf):
    """HAR captures: one per page, its transfers being the events' pages."""
    log = fx.crawl_log(spark, sf).filter("via <> '-'")
    header = lambda name, value: F.array(F.struct(F.lit(name).alias("name"), value.alias("value")))
    entry = F.struct(
        F.struct(F.lit("GET").alias("method"), F.col("url").alias("url"), header("Accept", F.when(F.col("event_id") % 3 == 0, "text/html,*/*").otherwise("*/*")).alias("headers")).alias("request"),
        F.struct(F.lit(200).alias("status"), header("Content-Type", F.col("mime")).alias("headers")).alias("response"))
    link = F.struct(F.col("via").alias("parent"), F.col("url").alias("href"))
    return log.select(
        "event_id", F.col("via").alias("parent"),
        F.struct(F.array(entry).alias("entries"), F.array(F.struct(F.array(F.struct(link["href"].alias("href")), F.struct(link["parent"].alias("href"))).alias("map"))).alias("pages")).alias("log"))


@query("tx_6_har_links", """
SELECT via AS parent, via AS url, '' AS hop FROM fx_log WHERE via <> '-'
UNION ALL SELECT via, url, CASE WHEN event_id % 3 = 0 OR mime = 'text/html' THEN 'L' ELSE 'E' END FROM fx_log WHERE via <> '-' AND url LIKE 'http%' AND url <> via
UNION ALL SELECT via, url, 'L' FROM fx_log WHERE via <> '-' AND url <> via""")
def tx_6(spark, sf):
    return pages.har_links(har(spark, sf))


@query("fn_35_is_embed", "SELECT event_id, NOT (event_id % 3 = 0 OR mime = 'text/html') AS embed FROM fx_log WHERE via <> '-'")
def fn_35(spark, sf):
    e = F.col("log.entries")[0]
    return har(spark, sf).select("event_id", C.is_embed(e["request"]["headers"], e["response"]["headers"]).alias("embed"))


@query("tx_8_record_metadata", """
SELECT '{"original":"' || original || '","timestamp":"' || timestamp || '","offset":' || "offset" || '}' AS value FROM fx_cdx""")
def tx_8(spark, sf):
    c = fx.cdx(spark, sf)
    records = c.select("original", "timestamp", "offset", F.encode(F.col("mimetype"), "UTF-8").alias("content"))
    return pages.record_metadata(records)


@query("tx_9_search_documents")
def tx_9(spark, sf):
    t = fx.targets(spark, sf)
    notes = curation.collection_annotations(t, fx.collections(spark, sf), fx.collection_targets(spark, sf))
    return pages.search_documents(_html(spark, sf), notes, curation.access_surts(t.filter("isOA")))


@query("tx_9_open_urls", """
SELECT DISTINCT p.url FROM fx_pages p WHERE EXISTS (SELECT 1 FROM fx_seed_surts s WHERE s.is_oa AND (split_part(p.surt, ')', 1) || ',') LIKE split_part(s.seed_surt, ')', 1) || ',%'
  AND (s.seed_surt LIKE '%)/' OR starts_with(p.surt, s.seed_surt)))""")
def tx_9o(spark, sf):
    return pages.open_urls(fx.pages(spark, sf), curation.access_surts(fx.targets(spark, sf).filter("isOA")))


@query("tx_10_page_count_seeds", """
SELECT url AS seed, url || '&page=' || i AS page_seed FROM (SELECT url, unnest(generate_series(2, page_id % 9 + 1)) AS i FROM pages)""")
def tx_10(spark, sf):
    return pages.page_count_seeds(fx.pages(spark, sf).select(
        F.col("url").alias("seed"), F.concat(F.lit("1 of "), (F.col("page_id") % 9 + 1).cast("string")).alias("page_numbers")))


@query("tx_11_validate_document", """
SELECT page_id, CASE WHEN page_id % 2 = 1 THEN true ELSE page_id % 4 = 0 END AS valid FROM pages""")
def tx_11(spark, sf):
    p = F.col("page_id")
    docs = fx.pages(spark, sf).select(
        "page_id", F.when(p % 2 == 0, F.concat(F.lit("https://www.gov.uk/"), F.md5("url"))).otherwise(F.col("url")).alias("landing_page_url"),
        F.array(F.lit("Ministry X"), F.concat(F.lit("Office "), p.cast("string"))).alias("departments"),
        F.when(p % 4 == 0, F.concat(F.lit("The Office "), p.cast("string"), F.lit(" papers"))).otherwise("Papers").alias("target_title"))
    return pages.validate_document(docs).select("page_id", "valid")


_WORDS = r"""(SELECT doc_id % 12 AS month, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents)"""


@query("ag_28_word_counts", f"SELECT month, word1, count(*) AS n FROM (SELECT month, unnest(w) AS word1 FROM {_WORDS}) GROUP BY ALL")
def ag_28(spark, sf):
    return pages.word_colocations(fx.table(spark, sf, "documents"), F.col("doc_id") % 12)[0]


@query("ag_28_word_colocations", f"""
SELECT month, p[1] AS word1, p[2] AS word2, count(*) AS n FROM (SELECT month, unnest(list_zip(w[:-2], w[2:])) AS p FROM {_WORDS} WHERE len(w) > 1) GROUP BY ALL""")
def ag_28p(spark, sf):
    return pages.word_colocations(fx.table(spark, sf, "documents"), F.col("doc_id") % 12)[1]


# Readers: the text forms are written from the derived frames and parsed back.

_PARSED = """timestamp, status_code, content_length, url, hop_path, via, mime, source, annotation_string, extra_json"""


@query("src_1_read_crawl_log", f"SELECT {_PARSED}, thread, start_time_plus_duration, hash FROM fx_log")
def src_1(spark, sf):
    return crawl_logs.parse_crawl_log(crawl_logs.to_log_line(fx.crawl_log(spark, sf))).drop("annotations")


def _short_lines(spark, sf):
    """Log lines where seeds lack path and referrer and some lines are cut."""
    one_word = fx.crawl_log(spark, sf).withColumn("annotation_string", F.regexp_replace("annotation_string", " ", "_"))
    line = one_word.select(F.concat_ws(" ", *CRAWL_LOG_FIELDS).alias("value"))
    short = F.regexp_replace("value", r"^(\S+ +\S+ +\S+ +\S+) - - ", "$1 ")
    return line.select(F.when(F.col("value").rlike(r"^(\S+ +){4}- - "), short).when(
        F.col("value").rlike(r"^\S+ 404 "), F.regexp_extract("value", r"^((?:\S+ +){8}\S+)", 1)).otherwise(F.col("value")).alias("value"))


@query("src_2_read_crawl_log_lenient", """
SELECT timestamp, status_code, url, hop_path, via, source FROM fx_log WHERE hop_path = '-' OR status_code <> '404'""")
def src_2(spark, sf):
    return crawl_logs.parse_crawl_log_lenient(_short_lines(spark, sf)).select("timestamp", "status_code", "url", "hop_path", "via", "source")


@query("src_2_rejected_lines", "SELECT 9 AS n_fields, count(*) AS n FROM fx_log WHERE hop_path <> '-' AND status_code = '404'")
def src_2r(spark, sf):
    return crawl_logs.rejected_lines(_short_lines(spark, sf), lenient=True).groupBy("n_fields").agg(F.count("*").alias("n"))


@query("src_3_read_lsr", """
SELECT permissions, number_of_replicas, userid, groupid, filesize, strftime(modified_at, '%Y-%m-%d %H:%M') AS modified_at, filename || ' copy 1' AS filename FROM fx_listing""")
def src_3(spark, sf):
    lines = fx.listing(spark, sf).select(F.concat_ws(
        "   ", "permissions", "number_of_replicas", "userid", "groupid", "filesize", F.date_format("modified_at", "yyyy-MM-dd HH:mm"),
        F.concat("filename", F.lit(" copy 1"))).alias("value"))
    banner = spark.range(1).select(F.lit("lsr: DEPRECATED: Please use 'ls -R' instead.").alias("value"))
    return listings.parse_lsr(lines.unionByName(banner)).withColumn("modified_at", F.date_format("modified_at", "yyyy-MM-dd HH:mm"))


@query("src_6_read_cdx11", 'SELECT urlkey, timestamp, original, mimetype, statuscode, digest, length, "offset", filename FROM fx_cdx')
def src_6(spark, sf):
    from ..functions.cdx import cdx_line

    lines = fx.cdx(spark, sf).select(cdx_line().alias("value"))
    header = lines.limit(1).select(F.lit(" CDX N b a m s k r M S V g").alias("value"))
    return cdx_source.parse_cdx11(lines.unionByName(header)).select(
        "urlkey", "timestamp", "original", "mimetype", "statuscode", "digest", "length", "offset", "filename")


@query("src_14_read_hash_manifest", """
SELECT sha256(filename) AS sha512, filesize AS length, filename AS path, CASE WHEN filename LIKE '%/output/warcs/%' THEN 'warcs' ELSE 'logs' END AS kind FROM fx_listing""")
def src_14(spark, sf):
    lines = fx.listing(spark, sf).select(F.concat(
        F.regexp_extract("filename", "^(.*)/[^/]*$", 1), F.lit("\t"), F.sha2("filename", 256), F.lit(" "), F.col("filesize").cast("string"), F.lit(" "), "filename").alias("value"))
    return packages.parse_hash_manifest(lines)


@query("snk_1_write_tsv_json", """SELECT status_code || chr(9) || '{"n":' || count(*) || '}' AS value FROM fx_log GROUP BY status_code""")
def snk_1(spark, sf):
    counts = fx.crawl_log(spark, sf).groupBy("status_code").agg(F.count("*").alias("n"))
    return sinks.tsv_json(counts, ["status_code"])


@query("src_6_rejected_cdx11", """SELECT 10 AS n_fields, original || ' a b c d e f g h i' AS value FROM fx_cdx""")
def src_6_rejected(spark, sf):
    from ..functions.cdx import cdx_line

    good = fx.cdx(spark, sf).select(cdx_line().alias("value"))
    short = fx.cdx(spark, sf).select(F.concat("original", F.lit(" a b c d e f g h i")).alias("value"))
    return cdx_source.rejected_cdx11(good.unionByName(short))


@query("src_14_rejected_manifest_lines", """SELECT 'no digest ' || filename AS value FROM fx_listing""")
def src_14_rejected(spark, sf):
    listing = fx.listing(spark, sf)
    good = listing.select(F.concat(F.lit("/"), F.lit("\t"), F.sha2("filename", 256), F.lit(" 1 "), "filename").alias("value"))
    return packages.rejected_manifest_lines(good.unionByName(listing.select(F.concat(F.lit("no digest "), "filename").alias("value"))))
