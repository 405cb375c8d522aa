"""Files of every kind the readers know, written from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import harvest, pages, tracking
from ..sources import curation, events, listings, packages, sinks
from ..streaming.runner import run_available
from . import frames as fx
from .capture_queries import cdx_table
from .harvest_queries import _DOCS, documents
from .registry import query
from .stream_queries import _folder


@query("src_4_read_listing_csv", """
SELECT permissions, number_of_replicas, userid, groupid, filesize, strftime(modified_at, '%Y-%m-%d %H:%M:%S') AS modified_at, filename FROM fx_listing""")
def src_4(spark, sf):
    """Several headed files read as one, so headers come back in the middle."""
    path = _folder(spark, "listing-csv")
    # Five files at least, and one for each split of a large table.
    files = max(5, fx.table(spark, sf, "lineitem").rdd.getNumPartitions())
    fx.listing(spark, sf).repartition(files).write.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return listings.read_listing_csv(spark, path).withColumn("modified_at", F.date_format("modified_at", "yyyy-MM-dd HH:mm:ss"))


@query("src_3_rejected_lsr", """
SELECT CASE l_linenumber % 3 WHEN 0 THEN 'ls: ' || filename || ': No such file' WHEN 1 THEN permissions || ' 3 u g many 2020-01-01 00:00 ' || filename
       ELSE permissions || ' 3 u g 5 yesterday noon ' || filename END AS value FROM fx_listing""")
def src_3_rejected(spark, sf):
    name = F.col("filename")
    lines = fx.listing_with_line(spark, sf).select(
        F.when(F.col("line") % 3 == 0, fx._cat("ls: ", name, ": No such file")).when(F.col("line") % 3 == 1, fx._cat(F.col("permissions"), " 3 u g many 2020-01-01 00:00 ", name))
        .otherwise(fx._cat(F.col("permissions"), " 3 u g 5 yesterday noon ", name)).alias("bad"), fx._cat(F.col("permissions"), " 3 u g 5 2020-01-01 00:00 ", name).alias("good"))
    texts = lines.select(F.explode(F.array("bad", "good", F.lit(""), F.lit("lsr: DEPRECATED: Please use"))).alias("value"))
    return listings.rejected_lsr(texts).select("value")


@query("src_8_read_targets", """
SELECT id, title, array_to_string(seeds, ' ') AS seeds, watched, scope, depth, crawl_frequency, is_oa, array_to_string(subject_ids, ' ') AS subject_ids, schedule_start, schedule_end FROM fx_targets""")
def src_8(spark, sf):
    path = f"{_folder(spark, 'targets')}.jsonl"
    fx.targets(spark, sf).write.json(path)
    schedule = F.col("schedules")[0]
    return curation.read_targets(spark, path).select(
        "id", "title", F.array_join("seeds", " ").alias("seeds"), "watched", "scope", "depth", "crawl_frequency", F.col("isOA").alias("is_oa"),
        F.array_join("subject_ids", " ").alias("subject_ids"), schedule["startDate"].alias("schedule_start"), schedule["endDate"].alias("schedule_end"))


def _export(spark, sf):
    """Curation exports of at most a thousand entries of each kind."""
    def keyed(df, name):
        return df.groupBy(F.floor(F.col("id") / 1000).alias("part")).agg(
            F.map_from_entries(F.collect_list(F.struct(F.col("id").cast("string"), F.struct(*df.columns)))).alias(name))

    pairs = fx.collection_targets(spark, sf).groupBy(F.col("collection_id").alias("id"), F.floor(F.col("target_id") / 1000).alias("few")).agg(F.collect_list("target_id").alias("target_ids"))
    # Members of a collection come in lists of at most a thousand targets, each in an export of its own.
    collections = fx.collections(spark, sf).join(pairs, "id", "left")
    first = F.coalesce("few", F.lit(0))
    held = collections.withColumn("few", first).groupBy(F.floor(F.col("id") / 1000).alias("part"), "few").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("id").cast("string"), F.struct("id", "parent_id", "name", "publish", "start_date", "end_date", "target_ids")))).alias("collections"))
    path = _folder(spark, "curation")
    for name, df in (("targets", keyed(fx.targets(spark, sf), "targets")), ("collections", held), ("subjects", keyed(fx.subjects(spark, sf), "subjects"))):
        df.select(name).write.option("maxRecordsPerFile", 1).json(f"{path}/{name}")
    return f"{path}/*"


@query("src_9_read_curation", """
SELECT 'target' AS kind, id, CAST(NULL AS BIGINT) AS other, title AS name FROM fx_targets
UNION ALL SELECT 'collection', id, parent_id, name FROM fx_collections UNION ALL SELECT 'subject', id, NULL, name FROM fx_subjects
UNION ALL SELECT 'member', collection_id, target_id, NULL FROM fx_collection_targets WHERE collection_id IN (SELECT id FROM fx_collections)""")
def src_9(spark, sf):
    targets, collections, pairs, subjects = curation.read_curation(spark, _export(spark, sf))
    none = F.lit(None).cast("long")
    rows = [
        targets.select(F.lit("target").alias("kind"), "id", none.alias("other"), F.col("title").alias("name")),
        # A collection whose members fill several exports is in each of them.
        collections.distinct().select(F.lit("collection"), "id", "parent_id", "name"), subjects.select(F.lit("subject"), "id", none, "name"),
        pairs.select(F.lit("member"), "collection_id", "target_id", F.lit(None).cast("string"))]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3])


@query("src_9_flatten_tree", """
WITH lines AS (SELECT l_orderkey * 1000 + l_linenumber * 10 AS id, l_orderkey * 1000 AS parent_id, CAST(l_suppkey AS VARCHAR) AS name FROM lineitem)
SELECT o_orderkey * 1000 AS id, CAST(NULL AS BIGINT) AS parent_id, 0 AS depth, o_orderpriority AS name FROM orders UNION ALL SELECT id, parent_id, 1, name FROM lines
UNION ALL SELECT id + k, id + k - 1, 1 + k, 'level ' || k FROM lines, range(1, 6) AS levels(k)""")
def src_9_tree(spark, sf):
    """Trees of seven levels: an order, its lines, and a chain below each line."""
    def node(line):
        number = F.col("l_orderkey") * 1000 + line["l_linenumber"] * 10
        below = F.array()
        for k in range(5, 0, -1):
            below = F.array(F.struct((number + k).alias("id"), F.lit(f"level {k}").alias("name"), below.alias("children")))
        return F.struct(number.alias("id"), line["l_suppkey"].cast("string").alias("name"), below.alias("children"))

    # Rows are dealt as they are in the tables; trees are made where they are read.
    tasks = fx.tasks_for(spark, sf, "lineitem")
    lines = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey").repartition(tasks, "l_orderkey").groupBy("l_orderkey").agg(
        F.collect_list(F.struct("l_linenumber", "l_suppkey")).alias("lines"))
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority").repartition(tasks, "o_orderkey")
    orders = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("children", F.transform("lines", node))
    trees = orders.select(F.to_json(F.struct((F.col("o_orderkey") * 1000).alias("id"), F.col("o_orderpriority").alias("name"), "children")).alias("tree"))
    return curation.flatten_tree(trees, "id long, name string").select("id", "parent_id", "depth", "name")


def _event_lines(spark, sf):
    e = fx.crawl_events(spark, sf)
    text = F.to_json(F.struct(*[c for c in e.columns if c not in ("event_id", "ts")]))
    # Every line comes once whole and, for some, once cut.
    return e.select(F.explode(F.array_compact(F.array(text, F.when(F.col("event_id") % 10 == 0, F.substring(text, 1, 40))))).alias("value"))


@query("src_10_read_crawl_events_stream", """
SELECT timestamp, url, TRY_CAST(status_code AS INTEGER) AS status_code, mime AS mimetype, TRY_CAST(content_length AS BIGINT) AS size, CASE WHEN event_id % 17 <> 0 THEN '0' END AS thread, hash AS content_digest FROM fx_log""")
def src_10(spark, sf):
    base = _folder(spark, "event-lines")
    _event_lines(spark, sf).repartition(6).write.text(f"{base}/input")
    found = events.read_crawl_events_files(spark, f"{base}/input", max_files=2).select("timestamp", "url", "status_code", "mimetype", "size", "thread", "content_digest")
    run_available(found, f"{base}/progress", path=f"{base}/table")
    return spark.read.schema(found.schema).parquet(f"{base}/table")


@query("src_10_rejected_events", """SELECT count(*) AS n FROM fx_log WHERE event_id % 10 = 0""")
def src_10_rejected(spark, sf):
    base = _folder(spark, "event-lines")
    _event_lines(spark, sf).write.text(f"{base}/input")
    broken = events.rejected_events(events.read_event_lines(spark, f"{base}/input"))
    run_available(broken, f"{base}/progress", path=f"{base}/table")
    return spark.read.schema(broken.schema).parquet(f"{base}/table").agg(F.count("*").alias("n"))


def _mets_folder(spark, sf):
    """A METS package per page, with two files whose sections name their ARKs."""
    i, url = F.col("page_id").cast("string"), F.regexp_replace(F.regexp_replace("url", "&", "&amp;"), "<", "&lt;")

    def file(k, href):
        return fx._cat(f'<mets:file ID="f{k}" ADMID="a{k}-', i, f'" MIMETYPE="text/html" SIZE="{k}', i, '" CHECKSUM="', F.md5(fx._cat(i, str(k))), '" CHECKSUMTYPE="MD5"><mets:FLocat xlink:href="', href, '"/></mets:file>')

    def section(k):
        return fx._cat(f'<mets:amdSec ID="a{k}-', i, '"><mets:digiprovMD><mets:mdWrap><mets:xmlData><premis:object><premis:objectIdentifier><premis:objectIdentifierValue>ark:/1/p',
                       i, f'.{k}</premis:objectIdentifierValue></premis:objectIdentifier></premis:object></mets:xmlData></mets:mdWrap></mets:digiprovMD></mets:amdSec>')

    date = F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + F.col("page_id")), "yyyyMMddHHmmss")
    xml = fx._cat(
        '<mets:mets xmlns:mets="http://www.loc.gov/METS/" xmlns:xlink="http://www.w3.org/1999/xlink" xmlns:premis="http://www.loc.gov/standards/premis/v1">', section(1), section(2),
        "<mets:fileSec><mets:fileGrp>", file(1, fx._cat("http://resolve/", date, "/", url)), file(2, fx._cat("/data/", i)), '</mets:fileGrp></mets:fileSec><mets:structMap><mets:div CONTENTIDS="ark:/1/d', i, '"/></mets:structMap></mets:mets>')
    path = _folder(spark, "mets")
    # Bundles of at most a hundred packages, one a file.
    bundles = fx.table(spark, sf, "pages").groupBy(F.floor(F.col("page_id") / 100).alias("part")).agg(F.array_join(F.collect_list(xml), "").alias("all"))
    bundles.select(fx._cat("<packages>", F.col("all"), "</packages>").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


@query("src_11_read_mets", """
SELECT 'a' || k || '-' || page_id AS admid, CASE k WHEN 1 THEN 'http://resolve/' || strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id), '%Y%m%d%H%M%S') || '/' || url ELSE '/data/' || page_id END AS path,
       'text/html' AS mimetype, CAST(k || page_id AS BIGINT) AS size, 'MD5' AS checksum_type, md5(page_id || k) AS checksum, 'ark:/1/p' || page_id || '.' || k AS ark FROM (SELECT page_id, url, unnest(['1', '2']) AS k FROM pages)""")
def src_11(spark, sf):
    return packages.read_mets(spark, _mets_folder(spark, sf)).select("admid", "path", "mimetype", "size", "checksum_type", "checksum", "ark")


@query("src_12_read_sip_ark_map", """
SELECT 'ark:/1/d' || page_id AS ark, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id), '%Y%m%d%H%M%S') AS timestamp, url FROM pages""")
def src_12(spark, sf):
    return packages.read_sip_ark_map(spark, _mets_folder(spark, sf), "http://resolve/")


@query("src_13_read_harvest_state", f"""
SELECT document_url, wayback_timestamp, landing_page_url, CAST(NULL AS VARCHAR) AS title, CAST(NULL AS BIGINT) AS target_id, 'NEW' AS status FROM {_DOCS}""")
def src_13(spark, sf):
    """Folders of one-document files, as an older harvest left them."""
    base = _folder(spark, "harvest-state")
    docs = documents(spark, sf).select("document_url", "wayback_timestamp", "landing_page_url", "size", F.substr("wayback_timestamp", F.lit(7), F.lit(2)).alias("day"))
    for half, name in ((0, "documents-2024-01"), (1, "documents-2024-02")):
        docs.filter(F.col("day").cast("int") % 2 == half).drop("day").write.option("maxRecordsPerFile", 1).json(f"{base}/{name}")
    return curation.read_harvest_state(spark, base).select("document_url", "wayback_timestamp", "landing_page_url", "title", "target_id", "status")


def _scan_folder(spark, sf):
    path = _folder(spark, "block-scan")
    e = fx.table(spark, sf, "events").groupBy((F.col("user_id") % 20).alias("node")).agg(F.count("*").alias("n"), F.sum(F.col("event_id") % 7).alias("s"))
    lines = F.array(
        F.lit("Report of 12:00:00"), fx._cat("Total Blocks : ", F.col("n")), fx._cat("Verified Since : ", F.col("s") % 100, "%"),
        fx._cat("Current Scan Rate KBPS : ", F.col("s")), F.lit(""), F.lit("no value here"))
    e.select("node", F.explode(lines).alias("value")).write.partitionBy("node").text(path)
    return path


@query("src_15_read_block_scan", """
WITH e AS (SELECT CAST(user_id % 20 AS VARCHAR) AS node, count(*) AS n, CAST(sum(event_id % 7) AS BIGINT) AS s FROM events GROUP BY 1)
SELECT node, 'total_blocks_count' AS key, CAST(n AS DOUBLE) AS value FROM e UNION ALL SELECT node, 'verified_since_percent', (s % 100) / 100.0::DOUBLE FROM e
UNION ALL SELECT node, 'current_scan_rate_kbps', s FROM e""")
def src_15(spark, sf):
    return listings.read_block_scan(spark, f"{_scan_folder(spark, sf)}/*/*.txt", "node=([^/]*)/")


@query("src_15_rejected_block_scan", """
SELECT DISTINCT CAST(user_id % 20 AS VARCHAR) AS node, unnest(['Report of 12:00:00', 'no value here']) AS value FROM events""")
def src_15_rejected(spark, sf):
    return listings.rejected_block_scan(spark, f"{_scan_folder(spark, sf)}/*/*.txt", "node=([^/]*)/")


@query("src_16_read_har", "SELECT url, 200 AS status, mime AS content_type, count(*) AS n FROM fx_log WHERE via <> '-' GROUP BY ALL")
def src_16(spark, sf):
    """HAR documents of up to a hundred transfers each."""
    from .page_queries import har

    path = _folder(spark, "har")
    entries = har(spark, sf).select(F.floor(F.col("event_id") / 100).alias("part"), F.col("log.entries")[0].alias("entry"))
    whole = entries.groupBy("part").agg(F.struct(F.collect_list("entry").alias("entries")).alias("log"))
    whole.select("log").write.option("maxRecordsPerFile", 1).json(path)
    found = curation.read_har(spark, path).select(F.explode("log.entries").alias("e"))
    return found.groupBy(F.col("e.request.url").alias("url"), F.col("e.response.status").alias("status"), F.col("e.response.headers")[0]["value"].alias("content_type")).agg(F.count("*").alias("n"))


@query("snk_2_write_report_csv", "SELECT host, status_code, CAST(count(*) AS VARCHAR) AS n FROM fx_log WHERE url LIKE 'http%' GROUP BY ALL")
def snk_2(spark, sf):
    path = _folder(spark, "report")
    report = fx.crawl_log(spark, sf).filter("url LIKE 'http%'").groupBy(F.lower(F.regexp_extract("url", "//([^/?#:]+)", 1)).alias("host"), "status_code").agg(F.count("*").alias("n"))
    for _ in range(2):  # a report written again replaces itself
        sinks.write_report_csv(report, path, ["host", "status_code"])
    return spark.read.option("header", True).csv(path)


def _runs(spark, sf):
    e = fx.table(spark, sf, "events")
    return e.select(
        fx._cat("user-", F.col("user_id") % 10).alias("task"), F.date_format("ts", "yyyy-MM-dd").alias("date"), F.date_trunc("second", F.col("ts").cast("timestamp")).alias("started"),
        F.when(F.col("event_id") % 50 != 0, F.date_trunc("second", F.col("ts").cast("timestamp")) + F.make_dt_interval(secs=F.col("event_id") % 300)).alias("finished"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.create_map(F.lit("run"), F.col("event_id").cast("string"), F.lit("type"), F.col("event_type")).alias("params"),
        F.create_map(F.lit("records"), F.col("event_id") % 1000, F.lit("dropped"), F.col("event_id") % 3).alias("metrics"), "event_id")


@query("wf_4_task_events", """
SELECT 'task:user-' || (user_id % 10) || ':' || strftime(ts, '%Y-%m-%d') || ':run=' || event_id || ':type=' || event_type AS id, 'tasks' AS kind_s,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS task_status_s, CASE WHEN event_id % 50 <> 0 THEN CAST(event_id % 300 AS DOUBLE) END AS runtime_secs, event_id % 1000 AS records FROM events""")
def wf_4(spark, sf):
    return tracking.task_events(_runs(spark, sf)).select("id", "kind_s", "task_status_s", "runtime_secs", F.col("metrics")["records"].alias("records"))


@query("ag_29_task_metrics", """
WITH r AS (SELECT 'user-' || (user_id % 10) AS task, CASE WHEN event_id % 50 <> 0 THEN date_trunc('second', ts) + to_seconds(event_id % 300) END AS finished, strftime(ts, '%Y-%m-%d') AS date, event_id FROM events),
m AS (SELECT task, 'records' AS metric, event_id % 1000 AS n, finished, date FROM r UNION ALL SELECT task, 'dropped', event_id % 3, finished, date FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY task, metric ORDER BY finished DESC NULLS LAST, date DESC, n DESC) AS k FROM m)
SELECT task, metric, CAST(sum(n) AS BIGINT) AS total, max(n) FILTER (WHERE k = 1) AS last, count(*) AS runs FROM o GROUP BY ALL""")
def ag_29_metrics(spark, sf):
    return tracking.task_metrics(_runs(spark, sf))


@query("ud_3_document_updater", f"""
SELECT document_url, CASE WHEN length(document_url) % 3 = 1 THEN 7 END AS target_id, CASE length(document_url) % 3 WHEN 1 THEN 'ACCEPTED' ELSE 'HELD' END AS status FROM {_DOCS} d
WHERE length(document_url) % 3 <> 0 AND EXISTS (SELECT 1 FROM fx_cdx c WHERE c.original = d.document_url AND c.timestamp = d.wayback_timestamp AND mimetype <> 'warc/revisit')""")
def ud_3(spark, sf):
    """A user's rule: leaves some documents alone, accepts some and holds the others back."""
    def update(docs):
        n = F.length("document_url") % 3
        return docs.filter(n != 0).withColumns({"target_id": F.when(n == 1, F.lit(7)), "status": F.when(n == 2, "HELD")})

    index = cdx_table(spark, sf)
    return harvest.process_documents(documents(spark, sf), index, fx.targets(spark, sf), update, buckets=16).select("document_url", F.col("target_id").cast("int").alias("target_id"), "status")


@query("ud_4_validators", """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN page_id % 2 = 0 WHEN 1 THEN false ELSE true END AS valid FROM pages""")
def ud_4(spark, sf):
    """A user's rules by host; hosts without a rule are always valid."""
    i = F.col("page_id")
    host = F.when(i % 3 == 0, "a.example").when(i % 3 == 1, "b.example").otherwise("c.example")
    docs = fx.pages(spark, sf).select(
        "page_id", fx._cat("http://", host, "/").alias("landing_page_url"), F.array(F.when(i % 2 == 0, "Office").otherwise("Bureau")).alias("departments"), F.lit("Report of the Office").alias("target_title"))
    rules = {"a.example": pages.department_in_title, "b.example": lambda departments, title: F.size(departments) > 5}
    return pages.validate_document(docs, rules).select("page_id", "valid")
