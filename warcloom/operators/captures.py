"""Index (CDX) and WARC-record operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import LAUNCH_TIMEOUT_SECONDS, REVISIT_MIME
from ..functions import cdx as X
from ..functions import urls as U
from ..session import cut_lineage
from ..sources.cdx import lookup_cdx, pruned_cdx
from .ordering import asof_forward

_D14 = "yyyyMMddHHmmss"


def indexable_rows(cdx: DataFrame) -> DataFrame:
    """Rows that go to the index, with host key and normalised type."""
    host_key = X.cdx_host_key(F.col("original"), F.col("urlkey"))
    return (
        cdx.withColumn("host_key", host_key)
        .filter(~F.col("host_key").startswith("dns:") & X.cdx_status_ok(F.col("statuscode")))
        .withColumn("mimetype", X.normalise_mime(F.col("mimetype")))
    )


def cdx_file_metrics(cdx: DataFrame, position: str = "offset") -> DataFrame:
    """Per-file counters. First and last capture and the extended-scheme count
    cover every row; record and byte counts only indexable ones."""
    dns = X.cdx_host_key(F.col("original"), F.col("urlkey")).startswith("dns:")
    ok = X.cdx_status_ok(F.col("statuscode"))
    label = F.concat("timestamp", F.lit("/"), "original")
    return cdx.groupBy("filename").agg(
        F.count_if(~dns & ok).alias("warc_record_count"),
        F.coalesce(F.sum(F.when(~dns & ok, F.col("length"))), F.lit(0)).alias("warc_record_bytes"),
        F.count_if(~dns & ~ok).alias("malformed_status_count"),
        F.count_if(X.is_extended_scheme(F.col("original"))).alias("extended_scheme_url_count"),
        F.min_by(label, position).alias("first_url_ts"),
        F.max_by(label, position).alias("last_url_ts"),
    )


def cdx_job_totals(file_metrics: DataFrame) -> DataFrame:
    return file_metrics.agg(
        F.sum("warc_record_count").alias("total_record_count"), F.count("*").alias("warc_file_count")
    )


def first_last_capture(cdx: DataFrame, position: str = "offset") -> DataFrame:
    label = F.concat("timestamp", F.lit("/"), "original")
    return cdx.groupBy("filename").agg(F.min_by(label, position).alias("first_url_ts"), F.max_by(label, position).alias("last_url_ts"))


def _rows_of(cdx: DataFrame, url: str, buckets: int | None) -> DataFrame:
    if buckets is None:
        return cdx.filter(F.col("original") == url)
    return pruned_cdx(cdx, cdx.sparkSession.createDataFrame([(url,)], "original string"), buckets).filter(F.col("original") == url)


def captures(cdx: DataFrame, url: str, limit: int | None = None, reverse: bool = True, revisits: bool = True, buckets: int | None = None) -> DataFrame:
    """Captures of one URL, newest first unless ``reverse`` is off; all unless a limit is given.

    With ``buckets``, here and below, ``cdx`` is a table that ``write_cdx`` made with
    as many, and only the wanted buckets and key ranges of it are read.
    """
    rows = _rows_of(cdx, url, buckets)
    if not revisits:
        rows = rows.filter(F.col("mimetype") != REVISIT_MIME)
    order = F.desc("timestamp") if reverse else F.asc("timestamp")
    rows = rows.orderBy(order, "filename", "offset")
    return rows if limit is None else rows.limit(limit)


def capture_dates(cdx: DataFrame, url: str, buckets: int | None = None) -> DataFrame:
    return _rows_of(cdx, url, buckets).select("timestamp").orderBy(F.desc("timestamp"))


def first_capture(cdx: DataFrame, url: str, buckets: int | None = None) -> DataFrame:
    return _rows_of(cdx, url, buckets).agg(F.min("timestamp").alias("first_timestamp"))


def _held(cdx: DataFrame, urls: DataFrame, buckets: int | None) -> DataFrame:
    """Index rows of some URLs (column original)."""
    return cdx.join(urls.distinct(), "original", "left_semi") if buckets is None else lookup_cdx(cdx, urls, buckets)


def last_event_wins(cdx: DataFrame) -> DataFrame:
    """One row per key and timestamp: the last index line in line order.

    A maximum of structs, so copies of one capture are folded in each task
    before the exchange.
    """
    fields = [c for c in X.CDX_FIELDS if c in cdx.columns]
    return (
        cdx.groupBy("urlkey", "timestamp")
        .agg(F.max_by(F.struct(*fields), X.cdx_line()).alias("row"))
        .select("row.*")
    )


def sorted_cdx(*parts: DataFrame) -> DataFrame:
    """All index lines in one total order."""
    lines = parts[0].select(X.cdx_line().alias("line"))
    for part in parts[1:]:
        lines = lines.unionByName(part.select(X.cdx_line().alias("line")))
    return lines.orderBy("line")


def host_sets(cdx: DataFrame) -> DataFrame:
    """Distinct (file, host key, type) of indexable rows."""
    return indexable_rows(cdx).select("filename", "host_key", "mimetype").distinct()


def approx_host_counts(cdx: DataFrame) -> DataFrame:
    return indexable_rows(cdx).groupBy("filename").agg(
        F.approx_count_distinct("host_key").alias("n_hosts"), F.approx_count_distinct("mimetype").alias("n_mimes")
    )


def _is_http_response() -> Column:
    return (F.col("rec_type") == "response") & F.col("content_type").contains("application/http")


def http_responses(records: DataFrame) -> DataFrame:
    return records.filter(_is_http_response())


def indexable_record(records: DataFrame, max_url: int | None = None) -> DataFrame:
    """Response records; those with a longer URL than ``max_url`` are left out if one is given."""
    found = http_responses(records)
    return found if max_url is None else found.filter(F.length("target_uri") <= max_url)


def warc_host_status(records: DataFrame) -> DataFrame:
    return http_responses(records).groupBy(U.url_host(F.col("target_uri")).alias("host"), "http_status").agg(F.count("*").alias("n"))


def warc_stats(records: DataFrame) -> DataFrame:
    """(host, measure, value, n): record count and mime, type and status
    histograms for all records (host NULL) and per host."""
    def measure(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("measure"), value.cast("string").alias("value"))

    long = records.select(
        U.url_host(F.col("target_uri")).alias("host"),
        F.explode(
            F.array(
                measure("record_count", F.lit("")), measure("mime", F.col("mime")),
                measure("content_type", F.col("content_type")), measure("status", F.col("http_status")),
            )
        ).alias("m"),
    ).select("host", "m.measure", "m.value").filter("value IS NOT NULL")
    host, measure_name, value = F.col("host"), F.col("measure"), F.col("value")
    totals = long.groupingSets(
        [[host, measure_name, value], [measure_name, value]], host, measure_name, value
    ).agg(F.grouping("host").alias("_all"), F.count("*").alias("n"))
    return totals.select(
        F.when(F.col("_all") == 1, "total").otherwise("host").alias("level"), "host", "measure", "value", "n"
    )


def available_in_index(docs: DataFrame, cdx: DataFrame, buckets: int | None = None) -> DataFrame:
    """Documents whose exact URL and time are captured, revisits not counting."""
    rows = _held(cdx, docs.select(F.col("document_url").alias("original")), buckets)
    held = rows.filter(F.col("mimetype") != REVISIT_MIME).select(
        F.col("original").alias("document_url"), F.col("timestamp").alias("wayback_timestamp")
    )
    return docs.join(held, ["document_url", "wayback_timestamp"], "left_semi")


def _pick(key: Column, rate: int) -> Column:
    return F.conv(F.substr(F.md5(key), F.lit(1), F.lit(8)), 16, 10).cast("bigint") % rate == 0


def spot_checks(records: DataFrame, rate: int = 500, limit: int = 10) -> DataFrame:
    """The first indexable record of each WARC and about one in ``rate`` of the others,
    ``limit`` per WARC at most. The choice is a hash, so a re-run checks the same records."""
    rows = records.withColumn("_ts", F.substr(F.regexp_replace("warc_date", "[^0-9]", ""), F.lit(1), F.lit(14)))
    usable = indexable_record(rows).select("filename", "offset", "target_uri", "_ts")
    first = usable.groupBy("filename").agg(F.min(F.struct("offset", "target_uri", "_ts")).alias("r")).select("filename", "r.*")
    some = usable.filter(_pick(F.concat_ws("|", "filename", "offset"), rate))
    w = Window.partitionBy("filename").orderBy("offset")
    return first.unionByName(some).distinct().withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= limit)


def verify_index(records: DataFrame, cdx: DataFrame, rate: int = 500, limit: int = 10, buckets: int | None = None) -> DataFrame:
    """Looks the :func:`spot_checks` of each WARC up in the index; ``untried`` says
    how many indexable records were not looked up."""
    # A few rows per WARC, looked up first and read again for the counts.
    tried = cut_lineage(spot_checks(records, rate, limit))
    held = _held(cdx, tried.select(F.col("target_uri").alias("original")), buckets)
    held = held.select(F.col("original").alias("target_uri"), F.col("timestamp").alias("_ts"), F.lit(True).alias("_hit")).distinct()
    checked = tried.join(held, ["target_uri", "_ts"], "left").groupBy("filename").agg(
        F.count("*").alias("tries"), F.count_if("_hit").alias("hits")
    )
    all_rows = records.groupBy("filename").agg(F.count("*").alias("records"), F.count_if(_is_http_response()).alias("indexable"))
    tries, hits = F.coalesce("tries", F.lit(0)), F.coalesce("hits", F.lit(0))
    return all_rows.join(checked, "filename", "left").select(
        "filename", "records", tries.alias("tries"), hits.alias("hits"), (F.col("indexable") - tries).alias("untried"), (tries == hits).alias("verified"))


def launch_latency(launches: DataFrame, cdx: DataFrame, now: Column, bucket_seconds: int = 86400) -> DataFrame:
    """First capture at or after each launch, how long it took, and outcome.

    CAPTURED within twelve hours; FAILED when twelve hours passed without a
    capture; PENDING otherwise.
    """
    # Captures of URLs that were never launched are dropped before the sort.
    seen = cdx.select(
        F.col("original").alias("url"), F.try_to_timestamp("timestamp", F.lit(_D14)).alias("captured_at")
    ).filter("captured_at IS NOT NULL").join(launches.select("url").distinct(), "url", "left_semi")
    found = asof_forward(launches, seen, "url", "launch_ts", F.struct("captured_at"), "_hit", bucket_seconds)
    hit = F.col("_hit.captured_at")
    seconds = F.unix_seconds(hit) - F.unix_seconds("launch_ts")
    waited = F.unix_seconds(now) - F.unix_seconds("launch_ts")
    return found.withColumns(
        {
            "captured_at": hit,
            "duration_seconds": seconds,
            "outcome": F.when(seconds <= LAUNCH_TIMEOUT_SECONDS, "CAPTURED")
            .when(hit.isNotNull() | (waited > LAUNCH_TIMEOUT_SECONDS), "FAILED")
            .otherwise("PENDING"),
        }
    ).drop("_hit")


def nearest_capture(urls: DataFrame, cdx: DataFrame, merged: bool = False) -> DataFrame:
    """For (url, target_ts): the first capture at or after that time, else the
    last one; NULL when there is none."""
    seen = cdx.select(
        F.col("original").alias("url"), F.try_to_timestamp("timestamp", F.lit(_D14)).alias("at"), "filename", "offset"
    ).filter("at IS NOT NULL").join(urls.select("url").distinct(), "url", "left_semi")
    last = seen.groupBy("url").agg(F.max_by(F.struct("at", "filename", "offset"), F.struct("at", F.col("filename"), "offset")).alias("_last"))
    found = asof_forward(urls, seen, "url", "target_ts", F.struct("at", "filename", "offset"), "_next", merged=merged)
    return (
        found.join(last, "url", "left").withColumn("_c", F.coalesce("_next", "_last"))
        .select(*urls.columns, F.date_format("_c.at", _D14).alias("timestamp"), F.col("_c.filename").alias("filename"), F.col("_c.offset").alias("offset"))
    )


def follow_redirects(starts: DataFrame, redirects: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """(start, url) for every URL that redirects lead to from each start.

    redirects: url, location (raw header). A visited set ends cycles. Each
    round is one join on the new URLs only; rounds go on until nothing new is
    found, and running out of rounds is an error, not a shorter answer.
    """
    edges = cut_lineage(
        redirects.select("url", U.resolve_redirect(F.col("url"), F.col("location")).alias("next")).distinct()
    )
    frontier = starts.select(F.col("url").alias("start"), "url").distinct()
    visited = None
    for _ in range(max_rounds):
        found = frontier.join(edges, "url").select("start", F.col("next").alias("url")).distinct()
        if visited is not None:
            found = found.join(visited, ["start", "url"], "left_anti")
        frontier = cut_lineage(found)
        if frontier.isEmpty():
            return visited if visited is not None else frontier
        visited = frontier if visited is None else visited.unionByName(frontier)
    raise RuntimeError(f"redirects still growing after {max_rounds} rounds")


def trace_captures(starts: DataFrame, cdx: DataFrame, records: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """(start, hop, url, timestamp, filename, offset, http_status, location): how captures redirect from each start.

    starts: url, target_ts. At each hop the nearest capture of the URL is looked up
    (:func:`nearest_capture`), then its record (filename, offset), whose Location
    leads on while the status is a redirect. A URL without a capture or a record ends
    its chain as a row of NULLs. No URL is visited twice for one start.

    Every round reads the captures and the records, so both are made once and kept in
    the columns that it needs: the driver then plans and follows a few stages a round.
    """
    frontier = cut_lineage(starts.select(F.col("url").alias("start"), "url", "target_ts").distinct())
    told, visited = None, frontier.select("start", "url")
    held = cut_lineage(records.select("filename", "offset", "http_status", "location"))
    captures = cut_lineage(cdx.select("original", "timestamp", "filename", "offset"))
    for hop in range(max_rounds):
        wanted = frontier.select("url", "target_ts").distinct()
        nearest = nearest_capture(wanted, captures, merged=True)
        found = nearest.join(held, ["filename", "offset"], "left")
        level = cut_lineage(
            frontier.join(found, ["url", "target_ts"])
            .select("start", F.lit(hop).alias("hop"), "url", "target_ts", "timestamp", "filename", "offset", "http_status", "location"))
        told = level if told is None else told.unionByName(level)
        onward = level.filter(F.col("http_status").between(300, 399) & F.col("location").isNotNull()).select(
            "start", U.resolve_redirect(F.col("url"), F.col("location")).alias("url"), "target_ts").distinct()
        frontier = cut_lineage(onward.join(visited, ["start", "url"], "left_anti"))
        if frontier.isEmpty():
            return told.drop("target_ts")
        visited = visited.unionByName(frontier.select("start", "url"))
        if hop % 10 == 9:
            told, visited = cut_lineage(told), cut_lineage(visited)
    raise RuntimeError(f"redirects still growing after {max_rounds} rounds")
