"""Document harvesting: candidates, watched targets, routes, batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DEDUPED, DOCUMENT_EXTENSIONS, LOCAL_DNS_STATUS, PDF_MIME, REVISIT_MIME
from ..functions import logs as L
from ..functions import urls as U
from ..session import cut_lineage
from .captures import available_in_index


def watched_prefixes(targets: DataFrame) -> DataFrame:
    """Distinct SURT prefixes of watched seeds."""
    seeds = targets.filter("watched").select(F.explode("seeds").alias("seed"))
    return seeds.select(U.surt_canonical(F.col("seed")).alias("prefix")).distinct()


def prefix_roots(prefixes: DataFrame) -> DataFrame:
    """Prefixes not covered by a shorter one, with their host key.

    A text starts with some prefix exactly when it starts with a root, and it
    starts with at most one root. Coverage is an equi-join on each prefix's own
    shorter leading parts (a few dozen), never a comparison of all pairs.
    """
    host = U.surt_host_key(F.col("prefix"))
    keyed = prefixes.withColumn("host_key", host)
    shorter = keyed.filter(F.length("prefix") > F.length("host_key") + 1).select(
        F.col("prefix").alias("covered"),
        F.explode(
            F.transform(
                F.sequence(F.length("host_key") + 1, F.length("prefix") - 1), lambda n: F.substr("prefix", F.lit(1), n)
            )
        ).alias("prefix"),
    )
    covered = shorter.join(prefixes, "prefix", "left_semi").select(F.col("covered").alias("prefix")).distinct()
    return keyed.join(covered, "prefix", "left_anti")


def watched_prefix_join(log: DataFrame, targets: DataFrame, both: bool = False) -> DataFrame:
    """Lines whose URL or referrer lies under a watched seed; ``both`` asks for
    URL and referrer under the same seed. At most one row per line.

    A prefix holds its whole host part, so the prefix join is an equi-join on
    host plus a startswith test. Because roots are prefix-free each side gives
    at most one match, so a left join keeps one row per line. No hint is set:
    the seed side is broadcast when its measured size allows, else both sides
    shuffle by host and adaptive execution splits a hot host.
    """
    roots = prefix_roots(watched_prefixes(targets))

    def side(name: str) -> tuple[DataFrame, Column]:
        r = roots.select(F.col("host_key").alias(f"_{name}_key"), F.col("prefix").alias(f"_{name}_root"))
        surt = F.col(f"_{name}_surt")
        return r, (U.surt_host_key(surt) == F.col(f"_{name}_key")) & surt.startswith(F.col(f"_{name}_root"))

    # Computed once in a projection, then passed through a one-element explode so
    # that the join conditions refer to them instead of repeating them.
    rows = log.withColumns({"_u": U.surt_canonical(F.col("url")), "_v": U.surt_canonical(F.col("via"))}).withColumn(
        "_s", F.explode(F.array(F.struct("_u", "_v")))
    ).withColumns({"_url_surt": F.col("_s._u"), "_via_surt": F.col("_s._v")})
    url_side, url_match = side("url")
    via_side, via_match = side("via")
    joined = rows.join(url_side, url_match, "left").join(via_side, via_match, "left")
    hit = (
        F.col("_url_root") == F.col("_via_root") if both else F.col("_url_root").isNotNull() | F.col("_via_root").isNotNull()
    )
    return joined.filter(hit).select(*log.columns)


def is_document_line(status: Column, mime: Column, annotations: Column | None) -> Column:
    """2xx PDF. ``annotations`` is an array (log lines) or text (stream events)."""
    keep = (L.status_class(status) == 2) & mime.contains(PDF_MIME)
    return F.coalesce(keep if annotations is None else keep & ~annotations, F.lit(False))


def document_candidates(
    log: DataFrame, targets: DataFrame, job_name: str | None = None, launch_id: str | None = None, skip_duplicates: bool = True
) -> DataFrame:
    """Harvestable documents of a log. ``skip_duplicates=False`` is the older
    rule that also took de-duplicated transfers."""
    repeated = F.array_contains("annotations", DEDUPED) if skip_duplicates else None
    lines = log.filter(is_document_line(F.col("status_code"), F.col("mime"), repeated))
    return watched_prefix_join(lines, targets).select(*document_columns(job_name, launch_id))


def document_columns(job_name: str | None, launch_id: str | None) -> list[Column]:
    return [
        F.col("url").alias("document_url"),
        L.wayback_timestamp(F.col("start_time_plus_duration")).alias("wayback_timestamp"),
        U.document_filename(F.col("url")).alias("filename"),
        F.col("source"),
        F.col("via").alias("landing_page_url"),
        F.lit(launch_id).cast("string").alias("launch_id"),
        F.lit(job_name).cast("string").alias("job_name"),
        F.col("content_length").try_cast("bigint").alias("size"),
        F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("bigint").alias("target_id"),
        F.lit("NEW").alias("status"),
    ]


def target_by_source(log: DataFrame, targets: DataFrame) -> DataFrame:
    """Target of each line's source; when targets share a seed the later wins."""
    seeds = targets.select(F.col("id"), F.explode("seeds").alias("source")).groupBy("source").agg(F.max("id").alias("target_id"))
    return log.join(seeds, "source", "left")


def resolve_target(docs: DataFrame, targets: DataFrame, key: str = "document_url") -> DataFrame:
    """Watched target of each document by landing page, then by publisher.

    docs: key, landing_page_url, publishers. A target matches when the host of
    one of its seeds covers the landing page. One match decides, except on
    sites many publishers share; else the first match (lowest id) whose title
    holds a publisher decides. The host prefixes of the landing page make this
    an equi-join, and candidates are only counted and minimised, never listed.
    """
    hosts = targets.filter("watched").select(
        F.col("id").alias("_tid"), F.col("title").alias("_title"), F.explode("seeds").alias("_seed")
    ).select("_tid", "_title", U.surt_authority(F.col("_seed")).alias("_host")).distinct()
    publisher_in_title = F.exists(
        "publishers", lambda p: (p != "") & F.contains(F.lower("_title"), F.lower(p))
    )
    candidates = (
        docs.select(key, "landing_page_url", "publishers", F.explode(U.surt_host_prefixes(F.col("landing_page_url"))).alias("_host"))
        .join(hosts, "_host")
        .groupBy(key)
        .agg(
            F.count_distinct("_tid").alias("_n"),
            F.min("_tid").alias("_first"),
            F.min(F.when(F.coalesce(publisher_in_title, F.lit(False)), F.col("_tid"))).alias("_by_title"),
        )
    )
    shared_site = F.col("landing_page_url").contains("://www.gov.uk/")
    return docs.join(candidates, key, "left").withColumn(
        "target_id", F.when((F.col("_n") == 1) & ~shared_site, F.col("_first")).otherwise(F.col("_by_title"))
    ).drop("_n", "_first", "_by_title")


def next_batch(docs: DataFrame, n: int, now: Column, days: int = 90, seed: int = 42) -> DataFrame:
    """n new documents of the last ``days`` days in a seeded random order."""
    since = F.date_format(F.timestamp_seconds(F.unix_seconds(now) - days * 86400), "yyyyMMddHHmmss")
    return (
        docs.filter((F.col("status") == "NEW") & (F.col("wayback_timestamp") > since))
        .orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "document_url")), "document_url")
        .limit(n)
    )


def process_documents(
    batch: DataFrame, cdx: DataFrame, targets: DataFrame, update: Callable[[DataFrame], DataFrame] | None = None, buckets: int | None = None,
) -> DataFrame:
    """Updates for a batch: available documents become ACCEPTED with a target
    or REJECTED without one; the rest are not returned and stay as they are.

    ``update`` replaces the look-up of targets: a function from the available
    documents to those it decides on, with ``target_id`` and whatever else it
    fills in. Documents it leaves out stay as they are. A ``status`` that it sets counts.
    """
    ready = available_in_index(batch, cdx, buckets).drop("target_id")
    if update is None:
        decided = resolve_target(ready, targets).drop("status")
    else:
        decided = update(ready.drop("status"))
    outcome = F.when(F.col("target_id").isNull(), "REJECTED").otherwise("ACCEPTED")
    return decided.withColumn("status", F.coalesce("status", outcome) if "status" in decided.columns else outcome)


def document_urls(crawled: DataFrame, extensions: list[str] | None = None) -> DataFrame:
    """Distinct URLs that end like a document in path or type; crawled: url, mime."""
    alternatives = "|".join(extensions or DOCUMENT_EXTENSIONS)
    path = F.lower(U.url_path(F.col("url")))
    fits = path.rlike(rf"\.({alternatives})$") | F.lower("mime").rlike(f"({alternatives})$")
    return crawled.filter(F.col("mime").isNotNull() & (F.col("mime") != REVISIT_MIME) & fits).select("url").distinct()


def referrer_links(log: DataFrame) -> DataFrame:
    """Distinct (url, referrer) of successful http lines."""
    status = L.status_int(F.col("status_code"))
    return log.filter(
        L.is_numeric_status(F.col("status_code")) & (status > 1) & (status < 400)
        & F.col("url").startswith("http") & F.col("via").startswith("http")
    ).select("url", F.col("via").alias("referrer")).distinct()


def trace_routes(docs: DataFrame, links: DataFrame, seeds: DataFrame, max_hops: int = 3, widest: int | None = None) -> DataFrame:
    """Routes from documents back to seeds: (document, seed, landing_page, route).

    docs and seeds: url; links: url, referrer. Routes of up to ``max_hops``
    hops count; a document without any is searched further, hop by hop, until no
    new page is reached, or up to ``widest`` where it is given. Documents that no
    seed reaches have no row; ``unreached`` lists them. A branch ends at its first seed and never repeats a page. The
    landing page is the commonest first referrer over a document's routes, and
    one shortest route per seed is returned.

    Distances to the nearest seed are found first, page by page. A document whose
    nearest seed is ``max_hops`` or more away has shortest routes only; those are
    counted, not listed. For the others paths of up to ``max_hops`` hops are
    extended where a seed is still within reach.
    """
    links = cut_lineage(links.select("url", "referrer").distinct())
    seeds = cut_lineage(seeds.select("url").distinct())
    level = seeds.withColumn("dist", F.lit(0))
    distances = level
    hop = 0
    while widest is None or hop < widest:
        hop += 1
        onward = links.join(level.select(F.col("url").alias("referrer")), "referrer", "left_semi").select("url").distinct()
        level = cut_lineage(onward.join(distances, "url", "left_anti").withColumn("dist", F.lit(hop)))
        if level.isEmpty():
            break
        distances = distances.unionByName(level)
        if hop % 10 == 0:
            distances = cut_lineage(distances)

    onward = cut_lineage(links.join(distances.select(F.col("url").alias("referrer"), "dist"), "referrer"))
    # A document that is itself a seed still has to be reached from a seed.
    first = docs.select("url").distinct().join(onward, "url").groupBy("url").agg((F.min("dist") + 1).alias("near"))
    is_seed = seeds.withColumn("_seed", F.lit(True))
    first = cut_lineage(first.join(is_seed, "url", "left").withColumn("far", F.col("_seed").isNull() & (F.col("near") >= max_hops)).drop("_seed"))
    counted = _counted_routes(first.filter("far").select("url", "near"), onward, distances)
    return counted.unionByName(_listed_routes(first.filter("NOT far").select("url", "near"), onward, max_hops))


_ROUTES = "document string, seed string, landing_page string, route array<string>"
#: Where counts of routes end; beyond it the commonest referrer is the last by name.
_MOST_ROUTES = "99999999999999999999999999999999999999"


def _counted_routes(docs: DataFrame, onward: DataFrame, distances: DataFrame) -> DataFrame:
    """Routes of documents for which only shortest ones count, without listing them.

    On a shortest route each page is one hop nearer to its seed, so numbers of
    routes and the first route per seed follow page by page, level by level, from
    those of the referrers one level below. A grid of links has exponentially many
    routes but a row per page, and per page and seed.
    """
    count = "decimal(38,0)"
    down = onward.join(distances.select("url", F.col("dist").alias("own")), "url").filter("own = dist + 1").select("url", "referrer", "own")
    frontier = needed = cut_lineage(docs.select("url"))
    rounds = 0
    while not frontier.isEmpty():
        rounds += 1
        below = down.filter("own > 1").join(frontier, "url", "left_semi").select(F.col("referrer").alias("url")).distinct()
        frontier = cut_lineage(below.join(needed, "url", "left_anti"))
        needed = needed.unionByName(frontier) if rounds % 10 else cut_lineage(needed.unionByName(frontier))
    steps = cut_lineage(down.join(needed, "url", "left_semi"))
    # One seed ends a branch: the smallest, where several referrers are seeds.
    ends = steps.filter("own = 1").groupBy("url").agg(F.min("referrer").alias("referrer"))
    through = cut_lineage(ends.withColumn("n", F.lit(1).cast(count)))
    routes = cut_lineage(ends.select("url", F.col("referrer").alias("seed"), F.array("url", "referrer").alias("route")))
    top = docs.agg(F.max("near")).first()[0] or 0
    told = []
    for level in range(1, top + 1):
        if level > 1:
            here = steps.filter(F.col("own") == level)
            totals = through.groupBy(F.col("url").alias("referrer")).agg(F.coalesce(F.try_sum("n").cast(count), F.lit(_MOST_ROUTES).cast(count)).alias("n"))
            onto = routes.select(F.col("url").alias("referrer"), "seed", "route")
            through = cut_lineage(here.select("url", "referrer").join(totals, "referrer").select("url", "referrer", "n"))
            routes = cut_lineage(
                here.select("url", "referrer").join(onto, "referrer").groupBy("url", "seed").agg(F.min(F.concat(F.array("url"), F.col("route"))).alias("route")))
        own = docs.filter(F.col("near") == level).select("url")
        landing = through.join(own, "url", "left_semi").groupBy("url").agg(F.max_by("referrer", F.struct("n", "referrer")).alias("landing_page"))
        told.append(routes.join(landing, "url").select(F.col("url").alias("document"), "seed", "landing_page", "route"))
    out = docs.sparkSession.createDataFrame([], _ROUTES)
    for rows in told:
        out = out.unionByName(rows)
    return out


def _listed_routes(first: DataFrame, onward: DataFrame, max_hops: int) -> DataFrame:
    """Routes of documents with a seed within ``max_hops``, or that are seeds: all are followed."""
    paths = first.select(
        F.col("url").alias("document"), F.array("url").alias("route"), F.col("url").alias("at"),
        F.greatest(F.lit(max_hops), "near").alias("limit"),
    )
    routes = None
    hop = 0
    while True:
        hop += 1
        step = onward.select(F.col("url").alias("at"), "referrer", "dist")
        grown = paths.join(step, "at").filter(
            (F.col("dist") + hop <= F.col("limit")) & ~F.array_contains("route", F.col("referrer"))
        ).select("document", F.concat("route", F.array("referrer")).alias("route"), F.col("referrer").alias("at"), "limit",
                 F.col("at").alias("parent"), (F.col("dist") == 0).alias("done"))
        grown = cut_lineage(grown)
        if grown.isEmpty():
            break
        arrived = grown.filter("done").select("document", "route", F.col("at").alias("seed"))
        # One seed ends its branch: the smallest, where several referrers are seeds.
        parent = F.slice("route", F.lit(1), F.size("route") - 1)
        arrived = arrived.groupBy("document", parent.alias("_parent")).agg(F.min_by("route", "seed").alias("route"), F.min("seed").alias("seed"))
        ended = arrived.select("document", F.col("_parent"))
        routes = arrived.drop("_parent") if routes is None else routes.unionByName(arrived.drop("_parent"))
        paths = (
            grown.filter("NOT done").withColumn("_parent", parent).join(ended, ["document", "_parent"], "left_anti")
            .select("document", "route", "at", "limit")
        )
    if routes is None:
        return first.sparkSession.createDataFrame([], _ROUTES)
    landing = (
        routes.groupBy("document", F.element_at("route", 2).alias("landing_page")).agg(F.count("*").alias("n"))
        .groupBy("document").agg(F.max_by("landing_page", F.struct("n", "landing_page")).alias("landing_page"))
    )
    shortest = routes.groupBy("document").agg(F.min(F.size("route")).alias("_len"))
    return (
        routes.join(shortest, "document").filter(F.size("route") == F.col("_len"))
        .groupBy("document", "seed").agg(F.min("route").alias("route"))
        .join(landing, "document").select("document", "seed", "landing_page", "route")
    )


def unreached(docs: DataFrame, routes: DataFrame) -> DataFrame:
    """(document, outcome): documents that ``trace_routes`` found no route for."""
    return docs.select(F.col("url").alias("document")).distinct().join(routes.select("document"), "document", "left_anti").withColumn(
        "outcome", F.lit("NO SEED"))


def logged_warc_names(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct WARC names and WARC name prefixes that successful lines mention."""
    status = L.status_int(F.col("status_code"))
    info = L.extra_info(F.col("extra_json"))
    told = log.filter((status > 0) & (status != LOCAL_DNS_STATUS)).select(
        info["warcFilename"].alias("name"), info["warcPrefix"].alias("prefix")
    )
    names = told.filter("name IS NOT NULL").select("name").distinct()
    prefixes = told.filter("name IS NULL AND prefix IS NOT NULL").select("prefix").distinct()
    return names, prefixes


def warcs_for_logs(
    log: DataFrame, listing: DataFrame, viral: str = "/viral/", wren: str = "/wren/", warcs: str = "/warcs/"
) -> DataFrame:
    """(name, place, path) of every WARC a log mentions; place is viral, wren,
    warcs, or missing.

    listing: path. Prefix mentions are matched by an equi-join on leading
    parts of the stored names, restricted to lengths that occur as prefixes.
    """
    names, prefixes = logged_warc_names(log)
    stored = listing.select("path").distinct().withColumn("name", F.regexp_replace(U.basename(F.col("path")), r"\.open$", ""))
    stored = stored.filter(F.col("name").endswith(".warc.gz"))
    # At most one entry per name length, so the array stays small.
    lengths = prefixes.agg(F.collect_set(F.length("prefix")).alias("lengths")).scalar()
    by_prefix = (
        stored.filter(F.col("path").contains(wren) | F.col("path").contains(warcs))
        .select("name", F.explode(lengths).alias("n"))
        .select("name", F.substr("name", F.lit(1), F.col("n")).alias("prefix"))
        .join(prefixes, "prefix", "left_semi").select("name")
    )
    wanted = names.unionByName(by_prefix).distinct()
    rank = (
        F.when(F.col("path").contains(viral), 1).when(F.col("path").contains(wren), 2).when(F.col("path").contains(warcs), 3)
    )
    places = stored.withColumn("_rank", rank).filter("_rank IS NOT NULL").groupBy("name").agg(
        F.min(F.struct("_rank", "path")).alias("best")
    )
    best = F.col("best._rank")
    place = F.when(best == 1, "viral").when(best == 2, "wren").when(best == 3, "warcs")
    return wanted.join(places, "name", "left").select(
        "name", F.coalesce(place, F.lit("missing")).alias("place"), F.col("best.path").alias("path")
    )


def additional_warcs(listed: DataFrame, referenced: DataFrame, key: str = "name") -> DataFrame:
    """Listed WARCs that no log line mentions."""
    return listed.join(referenced.select(key).distinct(), key, "left_anti")
