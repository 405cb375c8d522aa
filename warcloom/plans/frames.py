"""Archive-shaped frames derived from the given tables.

Each frame grows with its tables. Where the library has an operator for the
raw shape (path classification, SURTs) the frame uses it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import logs as L
from ..functions import urls as U
from ..operators import holdings

_D14 = "yyyyMMddHHmmss"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when the input is read by fewer tasks than that, as
    one small file is. Large tables have more splits than cores and stay put."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Rows of a table that one task derives its lines from.
_DEALT_ROWS = 250_000


def tasks_for(spark: SparkSession, sf: str, name: str) -> int:
    """How many tasks should derive lines from a table; its rows are counted in file footers."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf, name).count() // _DEALT_ROWS))


def _s(text: str) -> Column:
    return F.lit(text)


def _cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def page_count(spark: SparkSession, sf: str) -> Column:
    # Answered from file footers; a scalar subquery is not allowed in a hash-join key.
    return F.lit(table(spark, sf, "pages").count())


def pages(spark: SparkSession, sf: str) -> DataFrame:
    host = F.regexp_extract("url", "^https?://([^/?#:]+)", 1)
    return table(spark, sf, "pages").select("page_id", "url", host.alias("host"))


def crawl_log(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Log lines of the events table, or of a stream with its columns."""
    n = page_count(spark, sf)
    p = pages(spark, sf)
    names = ["event_id", "ts", "user_id", "event_type", "value"]
    # A row becomes a long line, so a split of a compressed table is far more than a task should hold.
    e = events if events is not None else table(spark, sf, "events").select(*names).repartition(tasks_for(spark, sf, "events"))
    m5, m7, m11, m13 = (F.col("event_id") % k for k in (5, 7, 11, 13))
    d14 = F.date_format("ts", _D14)
    joined = (
        e.join(p.select(F.col("page_id").alias("p_id"), F.col("url").alias("page_url"), F.col("host").alias("page_host")),
               F.col("p_id") == F.col("event_id") % n)
        .join(p.select(F.col("page_id").alias("v_id"), F.col("url").alias("via_url")),
              F.col("v_id") == (F.col("event_id") + 1) % n)
    )
    if events is not None:
        # A stream may be joined in the few tasks that read its file or the pages.
        joined = joined.repartition(tasks_for(spark, sf, "events"))
    status = (
        F.when(F.col("event_type") == "view", "200")
        .when(F.col("event_type") == "click", F.when(m5 == 0, "304").otherwise("200"))
        .when(F.col("event_type") == "signup", "302")
        .when(F.col("event_type") == "purchase", "404")
        .otherwise(F.when(m5 == 0, "-").otherwise("-5"))
    )
    annotations = F.when(m5 == 3, "-").otherwise(
        _cat(
            "ip:10.0.0.", F.col("user_id") % 9,
            F.when(m11 == 3, ",duplicate:digest").otherwise(""),
            F.when(m7 == 5, ",3t").otherwise(""),
            F.when(m13 == 0, _cat(",launchTimestamp:", d14)).otherwise(""),
            F.when(m13 == 5, ",1: stream: Eicar-Test-Signature FOUND").otherwise(""),
        )
    )
    extra = F.when(F.col("event_id") % 2 == 0, _cat('{"warcFilename":"w', F.col("user_id") % 20, '.warc.gz"}')).when(
        F.col("event_id") % 10 == 1, _cat('{"warcPrefix":"wren-', F.col("user_id") % 7, '-"}')
    )
    return joined.select(
        "event_id", "user_id", "value", "ts",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        status.alias("status_code"),
        F.when(m5 == 4, "-").otherwise(F.floor(F.col("value") * 100).cast("string")).alias("content_length"),
        F.when(m11 == 0, _cat("dns:", F.col("page_host"))).otherwise(F.col("page_url")).alias("url"),
        F.when(m7 == 0, "-").when(m7 == 1, "LE").when(m7 == 2, "L").when(m7 == 3, "I").otherwise("LLR").alias("hop_path"),
        F.when(m7 == 0, "-").otherwise(F.col("via_url")).alias("via"),
        F.when(m5.isin(0, 3), "text/html").when(m5 == 1, "application/pdf").when(m5 == 2, "image/png")
        .otherwise("unknown").alias("mime"),
        F.lit("#0").alias("thread"),
        _cat(d14, "000+", F.col("user_id")).alias("start_time_plus_duration"),
        F.md5("page_url").alias("hash"),
        _cat("tid:", F.col("user_id"), ":", F.col("via_url")).alias("source"),
        annotations.alias("annotation_string"),
        L.annotation_list(annotations).alias("annotations"),
        extra.alias("extra_json"),
    )


def listing(spark: SparkSession, sf: str) -> DataFrame:
    return listing_with_line(spark, sf).drop("line", "l_orderkey")


def listing_with_order(spark: SparkSession, sf: str) -> DataFrame:
    return listing_with_line(spark, sf).select("filename", "l_orderkey")


def listing_with_line(spark: SparkSession, sf: str) -> DataFrame:
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    k = F.col("l_orderkey") % 6
    d14, d8 = F.date_format("l_shipdate", _D14), F.date_format("l_shipdate", "yyyyMMdd")
    line5 = F.lpad(line.cast("string"), 5, "0")
    path = (
        F.when(k == 0, _cat("/heritrix/output/", F.when(line % 2 == 0, "frequent-bypm").otherwise("frequent-npld"), "/", d14,
                            "/warcs/BL-NPLD-", d14, "123-", line5, "-h.warc.gz"))
        .when(k == 1, _cat("/heritrix/output/dc2024/", d14, "/logs/crawl.log.cp", line5, ".gz"))
        .when(k == 2, _cat("/heritrix/output/warcs/dc", line % 4, "-", d8, "/BL-", part, ".warc.gz"))
        .when(k == 3, _cat("/data/", part, "/", supp, "/WARCS/f", line,
                           F.when(supp % 2 == 0, ".warc.cdx").otherwise(".warc.gz")))
        .when(k == 4, _cat("/1_data/bypm/webrecorder/job_", supp % 5, "/warcs/x", part, ".warc.gz.open"))
        .when(part % 4 == 0, _cat("/_to_be_deleted/t", part, ".tmp"))
        .when(part % 4 == 1, _cat("/heritrix/output/warcs/odd", part))
        .when(part % 4 == 2, _cat("/user/ops/notes/n", part, ".txt"))
        .otherwise(_cat("/heritrix/output/logs/weekly/", d14, "/alerts.log"))
    )
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    return spread(lines).select(
        F.when(part % 97 == 0, "drwxr-xr-x").otherwise("-rw-r--r--").alias("permissions"),
        (1 + line % 3).alias("number_of_replicas"),
        _cat("user", supp % 3).alias("userid"),
        F.lit("archive").alias("groupid"),
        F.when(part % 50 == 0, F.lit(0).cast("bigint")).otherwise(F.floor("l_extendedprice")).alias("filesize"),
        (F.col("l_shipdate").cast("timestamp") + F.expr("INTERVAL 36 HOURS")).alias("modified_at"),
        path.alias("filename"),
        line.alias("line"),
        "l_orderkey",
    )


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """Listed files by path, directories left out as the listing reader does; for what reads no facts from a path."""
    return listing(spark, sf).filter(~F.col("permissions").startswith("d")).withColumnsRenamed({"filename": "file_path", "filesize": "file_size"})


def files(spark: SparkSession, sf: str) -> DataFrame:
    """Classified listing, directories left out as the listing reader does."""
    return holdings.classify_listing(listing(spark, sf).filter(~F.col("permissions").startswith("d")))


def targets(spark: SparkSession, sf: str) -> DataFrame:
    base = pages(spark, sf).groupBy(F.lower("host").alias("host")).agg(
        F.min("page_id").alias("id"), F.min("url").alias("first_url")
    )
    i, host = F.col("id"), F.col("host")
    label = F.element_at(F.split(host, r"\."), 1)
    home = _cat("http://", host, "/")
    suffix = F.element_at(F.array(*[F.lit(s) for s in (".co.uk", ".scot", ".wales", ".london", ".cymru", ".info")]),
                          (i % 6 + 1).cast("int"))
    frequency = F.element_at(
        F.array(*[F.lit(s) for s in ("DAILY", "WEEKLY", "MONTHLY", "QUARTERLY", "SIXMONTHLY", "ANNUAL", "NEVERCRAWL")]),
        (i % 7 + 1).cast("int"))
    frequency = F.when(i % 13 != 12, frequency)
    start = F.date_format(
        F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp")) + (i % 60) * 86400 + (i % 3) * 3600),
        "yyyy-MM-dd HH:mm:ss")
    return base.select(
        "id", _cat("Site ", F.upper(label), " of ", host).alias("title"), "host",
        F.when(i % 2 == 0, F.array(home, _cat("http://", host, "/en"))).otherwise(F.array(home)).alias("seeds"),
        F.when(i % 17 == 4, F.array().cast("array<string>"))
        .otherwise(F.array("first_url", _cat("http://", label, suffix, "/"))).alias("urls"),
        (i % 3 == 0).alias("watched"),
        F.when(i % 11 != 5, F.element_at(F.array(*[F.lit(s) for s in ("root", "subdomains", "resource", "plus1")]),
                                         (i % 4 + 1).cast("int"))).alias("scope"),
        F.element_at(F.array(*[F.lit(s) for s in ("CAPPED", "CAPPED_LARGE", "DEEP")]), (i % 3 + 1).cast("int")).alias("depth"),
        frequency.alias("crawl_frequency"),
        (i % 2 == 0).alias("isOA"),
        F.when(i % 4 == 0, F.array(F.lit("295"))).otherwise(F.array().cast("array<string>")).alias("license_ids"),
        F.array(i % 25, (i * 7) % 25).alias("subject_ids"),
        F.array(F.struct(start.alias("startDate"), F.when(i % 5 == 0, "2024-03-01 00:00:00").alias("endDate"),
                         frequency.alias("frequency"))).alias("schedules"),
        (i % 5 == 0).alias("ignoreRobotsTxt"),
        (i % 2 == 1).alias("uk_hosting"), (i % 3 == 1).alias("uk_postal_address"),
        (i % 4 == 1).alias("via_correspondence"), (i % 5 == 1).alias("professional_judgement"),
    )


def collections(spark: SparkSession, sf: str) -> DataFrame:
    region, nation, supplier = (table(spark, sf, t) for t in ("region", "nation", "supplier"))
    none = F.lit(None).cast("string")
    top = region.select(
        F.col("r_regionkey").cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("parent_id"),
        F.col("r_name").alias("name"), (F.col("r_regionkey") % 4 != 3).alias("publish"),
        F.lit("2013-01-01").alias("start_date"), none.alias("end_date"))
    middle = nation.select(
        (100 + F.col("n_nationkey")).cast("bigint").alias("id"), F.col("n_regionkey").cast("bigint").alias("parent_id"),
        F.col("n_name").alias("name"), (F.col("n_nationkey") % 4 != 0).alias("publish"),
        none.alias("start_date"), F.when(F.col("n_nationkey") % 2 == 0, "2020-12-31").alias("end_date"))
    leaf = supplier.select(
        (10000 + F.col("s_suppkey")).cast("bigint").alias("id"), (100 + F.col("s_nationkey")).cast("bigint").alias("parent_id"),
        F.col("s_name").alias("name"), (F.col("s_suppkey") % 3 != 0).alias("publish"),
        none.alias("start_date"), none.alias("end_date"))
    return top.unionByName(middle).unionByName(leaf)


def collection_targets(spark: SparkSession, sf: str) -> DataFrame:
    t = targets(spark, sf).select("id")
    return (
        t.select((100 + F.col("id") % 25).alias("collection_id"), F.col("id").alias("target_id"))
        .unionByName(t.select((F.col("id") % 5).alias("collection_id"), F.col("id").alias("target_id")))
        .unionByName(table(spark, sf, "supplier").select(
            (10000 + F.col("s_suppkey")).cast("bigint").alias("collection_id"), F.col("s_suppkey").alias("target_id")))
    )


def subjects(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id"), _cat("About ", F.col("n_name")).alias("name"),
        (F.col("n_nationkey") % 3 != 0).alias("publish"))


def cdx(spark: SparkSession, sf: str) -> DataFrame:
    log = crawl_log(spark, sf)
    shot = (F.col("event_id") % 97 == 0) & F.col("url").startswith("http")
    dup = F.col("annotation_string").contains("duplicate:digest")
    original = F.when(shot, _cat("screenshot:", F.col("url"))).otherwise(F.col("url"))
    return log.select(
        U.surt_canonical(original).alias("urlkey"),
        L.wayback_timestamp(F.col("start_time_plus_duration")).alias("timestamp"),
        original.alias("original"),
        F.when(dup, "warc/revisit").when(F.col("event_id") % 6 == 0, F.upper("mime")).otherwise(F.col("mime")).alias("mimetype"),
        F.when(dup, "-").otherwise(F.col("status_code")).alias("statuscode"),
        F.col("hash").alias("digest"), F.lit("-").alias("redirecturl"), F.lit("-").alias("robotflags"),
        F.col("content_length").try_cast("bigint").alias("length"),
        (F.col("event_id") * 1000).alias("offset"),
        _cat("/heritrix/output/frequent-npld/20240101000000/warcs/w", F.col("user_id") % 20, ".warc.gz").alias("filename"),
    )


def redirects(spark: SparkSession, sf: str) -> DataFrame:
    """(url, location) of redirect records; locations absolute or scheme-relative."""
    p = pages(spark, sf).select("page_id", "url")
    q = pages(spark, sf).select(F.col("page_id").alias("to_id"), F.col("url").alias("to_url"))
    next_id = F.when(F.col("page_id") == 0, F.lit(1).cast("bigint")).otherwise(F.floor(F.col("page_id") / 2))
    rest = F.regexp_extract("to_url", "(//.*)$", 1)
    return p.join(q, F.col("to_id") == next_id).select(
        "url", F.when(F.col("page_id") % 4 == 3, rest).otherwise(F.col("to_url")).alias("location"))


def launches(spark: SparkSession, sf: str) -> DataFrame:
    start = F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    p = pages(spark, sf).select("page_id", "url")
    return (
        table(spark, sf, "orders")
        .join(p, F.col("page_id") == F.col("o_orderkey") % page_count(spark, sf))
        .select(F.col("o_orderkey").alias("launch_no"), "url",
                F.timestamp_seconds(start + (F.col("o_orderkey") * 173) % 2592000).alias("launch_ts"))
    )


def tracked(spark: SparkSession, sf: str) -> DataFrame:
    """One tracking record per stored path.

    What a path tells is read once per path, after copies are folded: kind, names and
    so on depend on the path alone, and the date of the content is fixed by the path or
    the time of modification, so the greatest of the latter gives the greatest date.
    """
    lines = listing(spark, sf).filter(~F.col("permissions").startswith("d"))
    # Numbers and times are folded in hash tables; the columns that no record needs are dropped from the plan.
    paths = lines.groupBy("filename").agg(*[F.max(c).alias(c) for c in lines.columns if c != "filename"])
    return holdings.classify_listing(paths).select(
        "file_path", F.col("kind").alias("kind_s"), F.col("stream").alias("stream_s"), F.col("collection").alias("collection_s"),
        F.col("job").alias("job_s"), F.col("file_size").alias("file_size_l"), F.col("file_name").alias("file_name_s"),
        F.col("modified_at").alias("modified_at_dt"), F.col("timestamp").alias("timestamp_dt"),
    ).select(
        _cat("hdfs://", F.col("file_path")).alias("id"), "kind_s", "stream_s", "collection_s", "job_s", "file_size_l",
        F.col("file_path").alias("file_path_s"), "file_name_s", "modified_at_dt", "timestamp_dt",
        F.year("timestamp_dt").alias("year_i"),
        F.when(F.col("file_size_l") % 3 == 0, F.array(F.lit("npld-cdx")))
        .when(F.col("file_size_l") % 3 == 1, F.array(F.lit("npld-cdx-v2"), F.lit("other"))).alias("cdx_index_ss"),
    )


def crawl_events(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Crawl-event messages (schemas.CRAWL_EVENT columns used by the stream
    operators) behind the log lines; other producers' messages lack ``thread``."""
    log = crawl_log(spark, sf, events)
    dash = lambda c: F.nullif(c, F.lit("-"))
    return log.select(
        "event_id", "ts", "timestamp", "url", F.col("status_code").try_cast("int").alias("status_code"),
        F.col("mime").alias("mimetype"), F.col("content_length").try_cast("bigint").alias("size"),
        "start_time_plus_duration", dash(F.col("hop_path")).alias("hop_path"), dash(F.col("via")).alias("via"),
        F.col("source").alias("seed"), dash(F.col("annotation_string")).alias("annotations"),
        F.when(F.col("event_id") % 17 != 0, "0").alias("thread"), F.lit("frequent-npld").alias("crawl_name"),
        F.lit("frequent-npld").alias("job_name"), F.lit("20240101000000").alias("launch_id"), F.col("hash").alias("content_digest"),
        F.when(F.col("status_code") == "302", dash(F.col("via"))).alias("redirecturl"),
        F.when(F.col("event_id") % 19 != 0, _cat("w", F.col("user_id") % 20, ".warc.gz")).alias("warc_filename"),
        (F.col("event_id") * 1000).alias("warc_offset"),
    )


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream source (a glob, since it is a single file)."""
    return spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/event[s].parquet")
