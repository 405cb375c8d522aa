"""Targets, collections and subjects: feeds, scopes, annotations, access lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CDN_SURTS, INHERITED_LICENCE, UK_SUFFIXES
from ..functions import curation as C
from ..functions import formats
from ..functions import urls as U
from ..session import cut_lineage

FEED_FIELDS = ["id", "title", "seeds", "watched", "depth", "scope", "ignoreRobotsTxt", "schedules"]


def targets_for_frequency(targets: DataFrame, frequency: str) -> DataFrame:
    return targets.filter(F.lower("crawl_frequency") == frequency.lower())


def target_fields(nodes: DataFrame, fields: list[str]) -> DataFrame:
    """Keep the listed fields that exist, with seeds and watched flag."""
    wanted = [f for f in fields if f in nodes.columns]
    return nodes.select(*wanted, *[f for f in ("seeds", "watched") if f not in wanted])


def due_schedules(targets: DataFrame, now: Column) -> DataFrame:
    """Launch rows, one per seed, for every schedule that fires this hour."""
    due = (
        targets.filter(F.size("seeds") > 0)
        .withColumn("schedule", F.explode("schedules"))
        .filter(C.schedule_is_due(F.col("schedule"), now))
    )
    return due.select(
        "id",
        F.col("schedule.frequency").alias("frequency"),
        C.source_tag(F.col("id"), F.col("seeds")).alias("source"),
        C.crawl_sheets(F.col("ignoreRobotsTxt"), F.col("scope"), F.col("depth")).alias("sheets"),
        F.date_format(now, "yyyyMMddHHmmss").alias("launch_ts"),
        F.explode("seeds").alias("seed"),
    ).withColumn("parallel_queues", C.parallel_queues(F.col("seed")))


def crawl_feed(
    targets: DataFrame, frequency: str = "all", terms: str = "npld", now: Column | None = None,
    include_expired: bool = False, include_hidden: bool = True,
) -> DataFrame:
    """Feed of targets to crawl.

    ``frequency`` "all" means every set frequency but NEVERCRAWL; ``terms``
    is npld (isNPLD), oa (isOA) or all. A target is expired when all its
    schedules ended before ``now``; hidden targets have ``hidden`` set.
    """
    out = targets.filter(F.col("crawl_frequency").isNotNull())
    if frequency == "all":
        out = out.filter(F.upper("crawl_frequency") != "NEVERCRAWL")
    else:
        out = targets_for_frequency(out, frequency)
    if terms != "all":
        out = out.filter(F.col({"npld": "isNPLD", "oa": "isOA"}[terms]))
    if not include_expired:
        now = now if now is not None else F.current_timestamp()
        ended = F.forall("schedules", lambda s: F.coalesce(s["endDate"].cast("timestamp") < now, F.lit(False)))
        out = out.filter(~((F.size("schedules") > 0) & ended))
    if not include_hidden and "hidden" in out.columns:
        out = out.filter(~F.coalesce("hidden", F.lit(False)))
    return out.select(*[f for f in FEED_FIELDS if f in out.columns])


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no rows for {what}")
    return df


def is_embargoed(timestamp: Column, now: Column, days: int = 7) -> Column:
    """Whole days passed are at most ``days``."""
    return F.floor((F.unix_seconds(now) - F.unix_seconds(timestamp)) / 86400) <= days


def embargo(df: DataFrame, timestamp: Column, now: Column, days: int = 7) -> DataFrame:
    return df.filter(~is_embargoed(timestamp, now, days))


def first_captures(cdx: DataFrame) -> DataFrame:
    return cdx.groupBy(F.col("original").alias("url")).agg(F.min("timestamp").alias("first_timestamp"))


def title_eligibility(targets: DataFrame, cdx: DataFrame, now: Column) -> DataFrame:
    """Targets with their first URL, first capture and outcome: blocked,
    no-urls, missing, embargoed or complete."""
    with_url = targets.withColumn("url", F.try_element_at("urls", F.lit(1)))
    # Only captures of target URLs are aggregated.
    wanted = with_url.filter("url IS NOT NULL").select(F.col("url").alias("original")).distinct()
    first = first_captures(cdx.select("original", "timestamp").join(wanted, "original", "left_semi"))
    at = F.try_to_timestamp("first_timestamp", F.lit("yyyyMMddHHmmss"))
    return with_url.join(first, "url", "left").withColumn(
        "outcome",
        F.when(F.col("crawl_frequency") == "NEVERCRAWL", "blocked")
        .when(F.size("urls") == 0, "no-urls")
        .when(F.col("first_timestamp").isNull(), "missing")
        .when(is_embargoed(at, now), "embargoed")
        .otherwise("complete"),
    )


def title_outcomes(eligibility: DataFrame) -> DataFrame:
    return eligibility.groupBy("outcome").agg(F.count("*").alias("n"))


def title_records(
    targets: DataFrame, cdx: DataFrame, subjects: DataFrame, now: Column, open_prefix: str, restricted_prefix: str
) -> DataFrame:
    """Catalogue rows of the complete targets."""
    done = title_eligibility(targets, cdx, now).filter("outcome = 'complete'").withColumn(
        "subject_id", F.try_element_at("subject_ids", F.lit(1)).cast("bigint")
    )
    names = subjects.select(F.col("id").alias("subject_id"), F.col("name").alias("subject"))
    ts, url, is_open = F.col("first_timestamp"), F.col("url"), F.col("isOA")
    return done.join(names, "subject_id", "left").select(
        formats.record_id(ts, url).alias("id"),
        F.date_format(F.try_to_timestamp(ts, F.lit("yyyyMMddHHmmss")), "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        "url",
        "title",
        C.access_rights(is_open).alias("rights"),
        U.registered_domain(U.url_host(url)).alias("publisher"),
        C.access_url(is_open, ts, url, open_prefix, restricted_prefix).alias("wayback_url"),
        "subject",
    )


def walk_tree(nodes: DataFrame, separator: str = "|", keep: Column | None = None) -> DataFrame:
    """Nodes reachable from the roots with their joined name and order path.

    ``nodes``: id, parent_id, name and more. ``keep`` prunes whole subtrees:
    a node that fails it is left out together with everything below.
    Works level by level; a level is one join on parent_id.
    """
    nodes = cut_lineage(nodes if keep is None else nodes.filter(keep))
    level = nodes.filter("parent_id IS NULL").withColumns(
        {"full_name": F.col("name"), "order_path": F.array("id"), "depth": F.lit(0)}
    )
    found = level
    child = nodes.filter("parent_id IS NOT NULL")
    depth = 0
    while True:
        depth += 1
        above = level.select(F.col("id").alias("parent_id"), F.col("full_name").alias("_name"), F.col("order_path").alias("_path"))
        level = cut_lineage(
            child.join(above, "parent_id").withColumns(
                {
                    "full_name": F.concat("_name", F.lit(separator), "name"),
                    "order_path": F.concat("_path", F.array("id")),
                    "depth": F.lit(depth),
                }
            ).drop("_name", "_path")
        )
        if level.isEmpty():
            return found
        found = found.unionByName(level)


def _annotated(targets: DataFrame, collections: DataFrame, collection_targets: DataFrame) -> DataFrame:
    """(scope, url, order_path, full_name, subject_ids) of targets in the tree."""
    tree = walk_tree(collections).select(F.col("id").alias("collection_id"), "full_name", "order_path")
    chosen = targets.filter(F.col("scope").isNotNull() & (F.col("scope") != "")).select(
        F.col("id").alias("target_id"), "scope", "urls", "subject_ids"
    )
    return (
        collection_targets.join(tree, "collection_id").join(chosen, "target_id")
        .select("scope", F.explode("urls").alias("url"), "order_path", "full_name", "subject_ids")
    )


def collection_annotations(targets: DataFrame, collections: DataFrame, collection_targets: DataFrame) -> DataFrame:
    """Per (scope, url): the first collection in tree order and how many there are."""
    return _annotated(targets, collections, collection_targets).groupBy("scope", "url").agg(
        F.min_by("full_name", "order_path").alias("collection"), F.count_distinct("full_name").alias("n_collections")
    )


def annotation_collections(targets: DataFrame, collections: DataFrame, collection_targets: DataFrame) -> DataFrame:
    """Every distinct collection of every (scope, url) with its place in tree order."""
    return _annotated(targets, collections, collection_targets).groupBy("scope", "url", "full_name").agg(
        F.min("order_path").alias("order_path")
    )


def annotation_subjects(targets: DataFrame, collections: DataFrame, collection_targets: DataFrame, subjects: DataFrame) -> DataFrame:
    names = subjects.select(F.col("id").alias("subject_id"), F.col("name").alias("subject"))
    return (
        _annotated(targets, collections, collection_targets)
        .select("scope", "url", F.explode("subject_ids").alias("subject_id")).distinct()
        .join(names, "subject_id").select("scope", "url", "subject").distinct()
    )


def collection_date_ranges(collections: DataFrame) -> DataFrame:
    return walk_tree(collections).select("full_name", "start_date", "end_date")


def published_collections(targets: DataFrame, collections: DataFrame, collection_targets: DataFrame) -> DataFrame:
    """Search rows of published collections and of the targets inside them."""
    tree = walk_tree(collections, keep=F.col("publish"))
    no_list = F.lit(None).cast("array<string>")
    heads = tree.select(
        F.col("id").cast("string").alias("id"), F.lit("collection").alias("type"), F.col("parent_id"), F.col("name").alias("title"),
        F.lit(None).cast("string").alias("url"), no_list.alias("additional_urls"), no_list.alias("licences"),
    )
    licences = F.when(
        F.coalesce("isOA", F.lit(False)),
        F.when(F.size("license_ids") > 0, F.col("license_ids")).otherwise(F.array(F.lit(INHERITED_LICENCE))),
    ).otherwise(F.array().cast("array<string>"))
    members = (
        collection_targets.join(tree.select(F.col("id").alias("collection_id")), "collection_id", "left_semi")
        .join(targets.filter(F.size("urls") > 0).withColumnRenamed("id", "target_id"), "target_id")
        .select(
            F.format_string("cid:%d-tid:%d", "collection_id", "target_id").alias("id"), F.lit("target").alias("type"),
            F.col("collection_id").alias("parent_id"), "title", F.col("urls")[0].alias("url"),
            F.slice("urls", F.lit(2), F.size("urls")).alias("additional_urls"), licences.alias("licences"),
        )
    )
    return heads.unionByName(members)


_FLAGS = ["uk_hosting", "uk_postal_address", "via_correspondence", "professional_judgement"]


def scope_counts(targets: DataFrame) -> DataFrame:
    """URL endings and scope flags per crawl frequency, plus a ``total`` row."""
    per_target = targets.filter(F.col("crawl_frequency").isNotNull()).withColumn(
        "_scopes", F.transform("urls", lambda u: U.uk_scope(u))
    )

    def urls_with(scope: str) -> Column:
        return F.sum(F.size(F.filter("_scopes", lambda s: s == scope))).cast("bigint").alias(scope.lstrip("."))

    return (
        per_target.rollup("crawl_frequency")
        .agg(
            F.grouping("crawl_frequency").alias("_total"),
            *[urls_with(s) for s in [*UK_SUFFIXES, "not_uk"]],
            F.sum(F.size(F.filter("_scopes", lambda s: s != "not_uk"))).cast("bigint").alias("uk_domain"),
            *[F.count_if(flag).alias(flag) for flag in _FLAGS],
        )
        .withColumn("frequency", F.when(F.col("_total") == 1, "total").otherwise(F.col("crawl_frequency")))
        .drop("_total", "crawl_frequency")
    )


def access_surts(targets: DataFrame) -> DataFrame:
    """Distinct (surt, url) that are open: delivery networks and seeds."""
    seeds = targets.select(F.explode("seeds").alias("url")).select(U.acl_surt(F.col("url")).alias("surt"), "url").filter("surt IS NOT NULL")
    fixed = targets.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in CDN_SURTS])).alias("surt"))
    return seeds.unionByName(fixed.select("surt", F.col("surt").alias("url"))).distinct()


def acl_whitelist(surts: DataFrame) -> DataFrame:
    return surts.select("surt").distinct().orderBy("surt")


def acl_rules(surts: DataFrame) -> DataFrame:
    """Rule lines ``surt - {json}``, distinct, descending."""
    key = F.rtrim(F.regexp_replace("surt", r"^http://\(", ""), F.lit(","))
    url = F.regexp_replace(F.to_json(F.struct("url")), r'^\{"url":', "")
    return (
        surts.select(F.concat(key, F.lit(' - {"access": "allow", "url": '), url).alias("rule"))
        .distinct().orderBy(F.desc("rule"))
    )


def acl_counts(surts: DataFrame) -> DataFrame:
    return surts.agg(F.count_distinct("surt").alias("n_surts"))


def scope_lists(all_targets: DataFrame, blocked: DataFrame) -> DataFrame:
    """(list, seed) for in-scope, watched and blocked seeds."""
    def seeds(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("list"), F.explode("seeds").alias("seed"))

    return (
        seeds(all_targets, "in-scope").unionByName(seeds(all_targets.filter("watched"), "watched"))
        .unionByName(seeds(blocked, "blocked")).distinct()
    )


def new_seeds_only(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates with outcome new, no-urls, or known when any seed exists
    already. ``existing`` has a ``url`` column."""
    seeds = candidates.select("id", F.explode("seeds").alias("url"))
    known = seeds.join(existing.select("url").distinct(), "url", "left_semi").select("id").distinct().withColumn("_known", F.lit(True))
    return candidates.join(known, "id", "left").withColumn(
        "outcome",
        F.when(F.size("seeds") == 0, "no-urls").when(F.col("_known"), "known").otherwise("new"),
    ).drop("_known")


def migrate_targets(
    targets: DataFrame, seeds: DataFrame, permissions: DataFrame, organisations: DataFrame, selectors: DataFrame
) -> DataFrame:
    """Old-tool targets with new ids looked up; unmatched names become NULL.

    targets: id, name, organisation, owner. seeds: target_id, seed, primary.
    permissions: target_id, start_date, agent, status (2 granted, 3 pending).
    Lookups: name, id. Targets without seeds are left out; the newest granted
    permission wins. Lists are migrated_links().
    """
    first_seed = seeds.groupBy(F.col("target_id").alias("id")).agg(
        F.min_by("seed", F.struct(~F.col("primary"), F.col("seed"))).alias("first_seed"), F.count("*").alias("n_seeds")
    )
    granted = permissions.filter("status = 2").groupBy(F.col("target_id").alias("id")).agg(
        F.max_by(F.struct("start_date", "agent"), F.struct("start_date", "agent")).alias("p")
    )
    orgs = organisations.select(F.col("name").alias("organisation"), F.col("id").alias("organisation_id"))
    people = selectors.select(F.col("name").alias("owner"), F.col("id").alias("selector_id"))
    return (
        targets.join(first_seed, "id").join(orgs, "organisation", "left").join(people, "owner", "left").join(granted, "id", "left")
        .select(
            "id", F.col("name").alias("title"), "organisation_id", "selector_id", "first_seed", "n_seeds",
            F.when(F.col("p").isNotNull(), "GRANTED").alias("licence_status"),
            F.unix_millis(F.col("p.start_date").cast("timestamp")).alias("permission_created"), F.col("p.agent").alias("agent"),
        )
    )


def migrated_links(groups: DataFrame, collections: DataFrame, subjects: DataFrame) -> DataFrame:
    """(target_id, kind, id) links of a target to renamed groups.

    groups: target_id, group_name, group_type ("Subject" or other); names that
    have no counterpart are dropped.
    """
    def link(kind: str, lookup: DataFrame, chosen: Column) -> DataFrame:
        names = lookup.select(F.col("name").alias("group_name"), F.col("id").alias("linked_id"))
        return groups.filter(chosen).join(names, "group_name").select("target_id", F.lit(kind).alias("kind"), "linked_id")

    is_subject = F.col("group_type") == "Subject"
    return link("subject", subjects, is_subject).unionByName(link("collection", collections, ~is_subject)).distinct()
