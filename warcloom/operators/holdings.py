"""File-store listings: classification, reports, packages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import ARCHIVE_FILE_PATTERN, STANDARD_LOGS
from ..functions import formats, paths
from ..functions import urls as U
from .ordering import with_ordinal

# Every kind the classification rules can give.
KINDS = ["warcs", "crawl-logs", "viral", "logs", "cdx", "dlx", "warcs-invalid", "to-be-deleted", "unknown"]
_CLASS_FIELDS = ["recognised", "collection", "stream", "job", "launch", "layout", "kind", "file_name", "file_ext"]


def classify_listing(listing: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """schemas.LISTING rows to classified files; ``keep`` carries extra columns."""
    path = F.col("filename")
    # Staged through a one-element explode: the rules run once per path, and later
    # filters on kind or stream are not pushed below and evaluated a second time.
    staged = listing.withColumn("_facts", paths.path_facts(path)).withColumn(
        "_c", F.explode(F.array(paths.facts_struct(F.col("_facts"), path)))
    )
    c = F.col("_c")
    kind = paths.refine_kind(c["kind"], c["collection"], c["file_name"])
    staged = staged.withColumn("_kind", kind)
    staged = staged.withColumn(
        "launch_datetime", F.when(c["layout"] != "wct", paths.launch_datetime(c["launch"]))
    )
    return staged.select(
        path.alias("file_path"),
        "permissions",
        "number_of_replicas",
        F.col("userid").alias("user_id"),
        F.col("groupid").alias("group_id"),
        F.col("filesize").alias("file_size"),
        "modified_at",
        *[(F.col("_kind") if f == "kind" else c[f]).alias(f) for f in _CLASS_FIELDS],
        "launch_datetime",
        paths.file_timestamp(
            F.col("modified_at"), F.col("_kind"), c["file_name"], c["stream"], F.col("launch_datetime")
        ).alias("timestamp"),
        *(keep or []),
    )


def _iso_z(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def listing_record(
    files: DataFrame, service: str, id_prefix: str, web_prefix: str, web_user: str = "access",
    refreshed_at: Column | None = None, keep: list[str] | None = None,
) -> DataFrame:
    """Tracking-record projection of classified files."""
    directory = F.col("permissions").startswith("d")
    op = F.when(directory, "LISTSTATUS").otherwise("OPEN")
    return files.select(
        F.concat(F.lit(id_prefix), "file_path").alias("id"),
        (refreshed_at if refreshed_at is not None else _iso_z(F.current_timestamp())).alias("refresh_date_dt"),
        F.col("file_path").alias("file_path_s"),
        F.col("file_size").alias("file_size_l"),
        F.col("file_ext").alias("file_ext_s"),
        F.col("file_name").alias("file_name_s"),
        paths.permissions_to_string(F.col("permissions"), directory).alias("permissions_s"),
        F.col("number_of_replicas").alias("hdfs_replicas_i"),
        F.col("user_id").alias("hdfs_user_s"),
        F.col("group_id").alias("hdfs_group_s"),
        _iso_z(F.col("modified_at")).alias("modified_at_dt"),
        _iso_z(F.col("timestamp")).alias("timestamp_dt"),
        F.year("timestamp").alias("year_i"),
        F.col("recognised").alias("recognised_b"),
        F.col("kind").alias("kind_s"),
        F.col("collection").alias("collection_s"),
        F.col("stream").alias("stream_s"),
        F.col("job").alias("job_s"),
        F.col("layout").alias("layout_s"),
        F.lit(service).alias("hdfs_service_id_s"),
        F.when(directory, "directory").otherwise("file").alias("hdfs_type_s"),
        F.concat(F.lit(f"{web_prefix}/webhdfs/v1"), "file_path", F.lit("?op="), op, F.lit(f"&user.name={web_user}")).alias("access_url_s"),
        *(keep or []),
    )


def empty_files(files: DataFrame) -> DataFrame:
    return files.filter(~F.col("permissions").startswith("d") & (F.col("file_size") == 0))


def web_archive_files(files: DataFrame, path: str = "file_path") -> DataFrame:
    return files.filter(F.col(path).rlike(ARCHIVE_FILE_PATTERN))


def archive_subset(files: DataFrame, subset: str = "all", path: str = "file_path") -> DataFrame:
    """Archive files of the ``selective`` tree, the ``npld`` tree, or both."""
    selective, npld = F.col(path).startswith("/data/"), F.col(path).startswith("/heritrix/")
    chosen = {"selective": selective, "npld": npld, "all": selective | npld}[subset]
    return web_archive_files(files, path).filter(chosen)


def path_prefix(files: DataFrame, prefix: str, chunk: int = 100, path: str = "file_path") -> DataFrame:
    """Distinct paths under a prefix, numbered into chunks in path order."""
    chosen = files.filter(F.col(path).startswith(prefix)).select(path).distinct()
    numbered = with_ordinal(chosen, [F.col(path)], start=0)
    return numbered.select(path, F.floor(F.col("ordinal") / chunk).alias("chunk"))


def live_holdings(files: DataFrame) -> DataFrame:
    return files.filter(F.col("kind") != "to-be-deleted")


def npld_core(files: DataFrame) -> DataFrame:
    return files.filter((F.col("collection") == "npld") & F.col("kind").isin("warcs", "crawl-logs", "viral"))


def holdings_by_stream(files: DataFrame, metric: str = "size", kinds: list[str] | None = None) -> DataFrame:
    """Collection, stream and year rows by kind columns; sizes or file counts.

    The kind set is closed, so the pivot needs no extra pass to discover it.
    """
    value = {"size": F.sum("file_size"), "count": F.count("file_size")}[metric]
    return (
        live_holdings(files)
        .filter(F.col("collection").isNotNull() & F.col("stream").isNotNull())
        .groupBy("collection", "stream", F.year("timestamp").alias("year"))
        .pivot("kind", kinds or KINDS)
        .agg(value)
    )


def npld_by_year(files: DataFrame, streams: list[str] | None = None) -> DataFrame:
    """Year rows by stream columns, human-readable sizes."""
    sizes = (
        npld_core(files).filter(F.col("stream").isNotNull())
        .groupBy(F.year("timestamp").alias("year"), "stream")
        .agg(F.sum("file_size").alias("file_size"))
    )
    return sizes.groupBy("year").pivot("stream", streams).agg(F.first(formats.humanbytes(F.col("file_size"))))


def npld_by_month(files: DataFrame) -> DataFrame:
    return (
        npld_core(files).filter(F.col("stream").isNotNull())
        .groupBy(F.date_format("timestamp", "yyyy-MM").alias("month"), "stream")
        .agg(F.sum("file_size").alias("file_size"))
    )


def npld_totals(files: DataFrame) -> DataFrame:
    """Size and count per stream and in total, from one pass."""
    return (
        npld_core(files).filter(F.col("stream").isNotNull())
        .rollup("stream")
        .agg(F.grouping("stream").alias("_total"), F.sum("file_size").alias("file_size"), F.count("*").alias("file_count"))
        .select(F.when(F.col("_total") == 1, "total").otherwise(F.col("stream")).alias("stream"), "file_size", "file_count")
    )


def size_by_collection_and_year(files: DataFrame) -> DataFrame:
    """Total size per collection and year, every year that occurs (NULL where the date is unknown)."""
    return (
        files.filter(F.col("collection").isNotNull()).groupBy("collection", F.year("timestamp").alias("year"))
        .agg(F.sum("file_size").alias("file_size"))
    )


def collection_by_year(files: DataFrame, years: list[int] | None = None) -> DataFrame:
    """The same as a table with a column per year; without ``years`` they are
    looked up first, with ``years`` the others are not shown."""
    sizes = size_by_collection_and_year(files)
    return sizes.groupBy("collection").pivot("year", years).agg(F.sum("file_size"))


def duplicate_files(files: DataFrame, name: Column | None = None) -> DataFrame:
    """Names stored at more than one place, with how many."""
    key = name if name is not None else U.basename(F.col("file_path"))
    return (
        files.groupBy(key.alias("file_name"))
        .agg(F.count("*").alias("n_locations"), F.min("file_path").alias("first_path"), F.max("file_path").alias("last_path"))
        .filter("n_locations > 1")
    )


def duplicate_locations(files: DataFrame) -> DataFrame:
    """Every location of every duplicated name, one row each.

    Rows rather than lists: one name may have millions of copies.
    """
    named = files.withColumn("file_name", U.basename(F.col("file_path")))
    return named.join(duplicate_files(files).select("file_name", "n_locations"), "file_name").select(
        "file_name", "n_locations", "file_path"
    )


def duplicate_counts(files: DataFrame) -> DataFrame:
    per_name = files.groupBy(U.basename(F.col("file_path")).alias("file_name")).agg(F.count("*").alias("n"))
    return per_name.agg(F.count_if(F.col("n") > 1).alias("duplicated"), F.count_if(F.col("n") == 1).alias("unduplicated"))


def _packaged(files: DataFrame) -> DataFrame:
    return files.filter(F.col("recognised") & F.col("job").isNotNull())


def crawl_packages(files: DataFrame) -> DataFrame:
    """One header per (job, launch). The files themselves are package_files()."""
    head = _packaged(files).groupBy("job", "launch").agg(
        F.max("stream").alias("stream"), F.max("launch_datetime").alias("launch_datetime"), F.count("*").alias("total_files"),
        F.sum("file_size").alias("total_bytes"),
    )
    launched = F.coalesce(F.date_format("launch_datetime", "dd MMM yyyy"), F.lit("?"))
    npld, selective = F.col("stream").isin("frequent", "domain"), F.col("stream") == "selective"
    job_family = F.concat(F.substring_index("job", "-", 1), F.lit(" crawl"))
    return head.select(
        "job",
        "launch",
        F.date_format("launch_datetime", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        "stream",
        F.array(F.concat(F.lit("crawl-"), "stream"), F.concat_ws("-", F.lit("crawl"), "stream", "job")).alias("tags"),
        F.when(npld, F.concat(F.lit("NPLD "), "job", F.lit(" crawl, launched "), launched))
        .when(selective, F.concat(F.lit("Selective "), "job", F.lit(" crawl, launched "), launched)).alias("title"),
        F.when(npld, F.array(F.lit("legal-deposit crawls"), job_family))
        .when(selective, F.array(F.lit("selective crawls"), job_family)).alias("categories"),
        "total_files",
        "total_bytes",
    )


def package_files(files: DataFrame) -> DataFrame:
    return _packaged(files).select(
        "job", "launch", F.col("file_path").alias("path"), "kind", "timestamp", F.col("file_size").alias("filesize"), "modified_at"
    )


def totals_by_kind(files: DataFrame) -> DataFrame:
    """Count and bytes per stream and kind, plus an ``all`` row per stream."""
    stream = F.coalesce("stream", F.lit("no-stream"))
    rows = files.select(stream.alias("stream"), "kind", "file_size")
    totals = rows.groupingSets([[rows.stream, rows.kind], [rows.stream]], rows.stream, rows.kind).agg(
        F.grouping("kind").alias("_all"), F.count("*").alias("n_files"), F.sum("file_size").alias("bytes")
    )
    return totals.select(
        F.when(F.col("stream").isin("frequent", "domain"), "npld").when(F.col("stream") == "selective", "selective")
        .otherwise("no-collection").alias("collection"),
        "stream",
        F.when(F.col("_all") == 1, "all").otherwise(F.col("kind")).alias("kind"),
        "n_files",
        "bytes",
    )


def unparsed_paths(files: DataFrame) -> DataFrame:
    """Folders holding unrecognised files, with file counts, in folder order."""
    folder = F.regexp_extract("file_path", "^(.*)/[^/]*$", 1)
    return (
        files.filter(~F.col("recognised")).groupBy(folder.alias("folder")).agg(F.count("*").alias("n_files")).orderBy("folder")
    )


def listing_totals(listing: DataFrame) -> DataFrame:
    """Directories, files, bytes and files with fewer than three replicas."""
    directory = F.col("permissions").startswith("d")
    return listing.agg(
        F.count_if(directory).alias("n_dirs"),
        F.count_if(~directory).alias("n_files"),
        F.sum(F.when(~directory, F.col("filesize")).otherwise(0)).alias("n_bytes"),
        F.count_if(~directory & (F.col("number_of_replicas") < 3)).alias("n_under_replicated"),
    )


def extension_counts(files: DataFrame, n: int = 20) -> DataFrame:
    return files.groupBy("file_ext").agg(F.count("*").alias("n_files")).orderBy(F.desc("n_files"), F.asc_nulls_first("file_ext")).limit(n)


def largest_files(files: DataFrame, n: int = 20) -> DataFrame:
    return (
        files.select("file_path", "file_size", formats.humanbytes(F.col("file_size")).alias("human_size"))
        .orderBy(F.desc("file_size"), "file_path").limit(n)
    )


def logs_by_time(files: DataFrame) -> DataFrame:
    return (
        files.filter(F.col("kind") == "crawl-logs")
        .select(F.to_date("timestamp").alias("date"), "timestamp", "collection", "stream", "job", "file_path")
        .orderBy("date", "timestamp", "file_path")
    )


def warcs_by_date(files: DataFrame) -> DataFrame:
    return (
        files.filter(F.col("kind") == "warcs")
        .select(F.to_date("timestamp").alias("date"), "collection", "stream", "job", "file_path")
        .orderBy("date", "collection", "stream", "job", "file_path")
    )


def sample_per_class(files: DataFrame, k: int = 2, seed: int = 42) -> DataFrame:
    """k rows of each (collection, stream, layout, year, kind), chosen by a
    seeded hash so the sample is repeatable. Ranked per task before the exchange."""
    keys = ["collection", "stream", "layout", "year", "kind"]
    w = Window.partitionBy(*keys).orderBy("pick", "file_path")
    return (
        files.withColumn("year", F.year("timestamp"))
        .withColumn("pick", F.md5(F.concat(F.lit(f"{seed}:"), "file_path")))
        .withColumn("sample_no", F.row_number().over(w))
        .filter(F.col("sample_no") <= k)
        .select(*keys, "file_path", "sample_no")
    )


def launches_in_interval(files: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct (job, launch) launched between two days, both included."""
    day = F.try_to_timestamp(F.substr("launch", F.lit(1), F.lit(8)), F.lit("yyyyMMdd")).cast("date")
    return files.filter(day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select("job", "launch").distinct()


def warcs_of_launch(files: DataFrame, job: str, launch: str) -> DataFrame:
    return files.filter((F.col("job") == job) & (F.col("launch") == launch) & F.col("file_name").endswith(".warc.gz")).select("file_path")


def move_plan(listing: DataFrame, path: str = "filename") -> DataFrame:
    """What transfer each crawl-output file needs: action and destination.

    Rendered WARCs go to their launch's folder, finished WARCs and rotated
    logs are copied, logs still being written wait, locks are skipped.
    """
    p = F.col(path)
    name = U.basename(p)
    target = paths.wren_destination(p)
    is_warc = p.rlike(r"^/heritrix/output/[^/]+/[^/]+/(warcs|viral)/[^/]+\.warc\.gz$")
    is_log = p.rlike(r"^/heritrix/output/[^/]+/[^/]+/logs/[^/]*\.log[^/]*$")
    action = (
        F.when(p.startswith("/heritrix/wren/") & target.isNotNull(), "move-to-warcs")
        .when(is_warc, "copy")
        .when(is_log & name.endswith(".lck"), "skip-lock")
        .when(is_log & name.endswith(".log"), "copy-when-stopped")
        .when(is_log, "copy")
    )
    return listing.select(
        p.alias("file_path"), action.alias("action"),
        F.when(action == "move-to-warcs", F.concat_ws("/", target, name)).when(action.isNotNull(), p).alias("destination"),
    ).filter("action IS NOT NULL")


def log_files(files: DataFrame, job: str | None = None, launch: str | None = None, path: str = "file_path") -> DataFrame:
    """Crawl-log files of a launch, locks left out."""
    name = U.basename(F.col(path))
    out = files.filter(name.startswith("crawl.log") & ~name.endswith(".lck"))
    if job is not None:
        out = out.filter(F.col("job") == job)
    if launch is not None:
        out = out.filter(F.col("launch") == launch)
    return out


def latest_launch(files: DataFrame) -> DataFrame:
    """Newest launch id of every job."""
    return files.filter(F.col("job").isNotNull()).groupBy("job").agg(F.max("launch").alias("launch"))


def tidy_metrics(files: DataFrame, render_folder: str = "/heritrix/wren/", output_folder: str = "/heritrix/output/", path: str = "file_path") -> DataFrame:
    """Counts of rendered WARCs by name check, and of finished, open and other output files."""
    p = F.col(path)
    rendered = p.startswith(render_folder) & p.endswith(".warc.gz")
    matched = paths.wren_destination(p).isNotNull()
    output = p.startswith(output_folder)
    done, still_open = p.endswith("warc.gz"), p.endswith("warc.gz.open")
    return files.agg(
        F.count_if(rendered).alias("wren_warcs"),
        F.count_if(rendered & matched).alias("wren_warcs_matched"),
        F.count_if(rendered & ~matched).alias("wren_warcs_nomatch"),
        F.count_if(output & done).alias("warcs"),
        F.count_if(output & still_open).alias("warcs_open"),
        F.count_if(output & ~done & ~still_open).alias("other_files"),
    )


def log_size_report(files: DataFrame) -> DataFrame:
    """Size of each standard log in the newest launch of every job; 0 when missing."""
    newest = latest_launch(files).filter("launch IS NOT NULL")
    expected = newest.withColumn("log", F.explode(F.array(*[F.lit(n) for n in STANDARD_LOGS])))
    sizes = (
        files.filter(F.col("file_name").isin(STANDARD_LOGS))
        .groupBy("job", "launch", F.col("file_name").alias("log")).agg(F.max("file_size").alias("size"))
    )
    return expected.join(sizes, ["job", "launch", "log"], "left").select(
        "job", "launch", "log", F.coalesce("size", F.lit(0)).alias("size")
    )


def recent_modified_count(files: DataFrame, now: Column, months: int = 1) -> DataFrame:
    since = F.add_months(now, -months)
    return files.agg(F.count_if((F.col("modified_at") >= since) & (F.col("modified_at") <= now)).alias("n_recent"))
