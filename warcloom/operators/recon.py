"""Reconciliation between stores, packages and identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths
from ..functions import urls as U
from .ordering import with_ordinal


def reconcile_stores(source: DataFrame, target: DataFrame) -> DataFrame:
    """What merging source into target would do to each file.

    Both: name, length, hash. same: may be removed from the source; move: only
    in the source; size-conflict and hash-conflict; target-only. NULL when the
    hash is unusable.
    """
    s = source.select("name", F.col("length").alias("s_length"), F.col("hash").alias("s_hash"))
    t = target.select("name", F.col("length").alias("t_length"), F.col("hash").alias("t_hash"))
    return s.join(t, "name", "full").select(
        "name",
        F.when(F.col("s_length").isNull(), "target-only")
        .when(F.col("t_length").isNull(), "move")
        .when(F.col("s_length") != F.col("t_length"), "size-conflict")
        .when(F.col("s_hash") != F.col("t_hash"), "hash-conflict")
        .when(F.col("s_hash") == F.col("t_hash"), "same").alias("action"),
    )


def sync_needed(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Non-empty local files that are missing remotely or differ in size.
    Both: path, length."""
    r = remote.select("path", F.col("length").alias("_r"))
    return (
        local.filter("length > 0").join(r, "path", "left").filter(F.col("_r").isNull() | (F.col("_r") != F.col("length")))
        .select("path", "length", F.when(F.col("_r").isNull(), "missing").otherwise("size-differs").alias("reason"))
    )


def merged_sync_needed(parts: DataFrame, merged: DataFrame) -> DataFrame:
    """Merged indexes whose size is not the sum of their parts.
    parts: group, length; merged: group, length."""
    total = parts.groupBy("group").agg(F.sum("length").alias("parts_length"))
    return total.join(merged, "group", "left").filter(
        F.col("length").isNull() | (F.col("length") != F.col("parts_length"))
    ).select("group", "parts_length", F.col("length").alias("merged_length"))


def hash_match(local: DataFrame, remote: DataFrame, fail: bool = False) -> DataFrame:
    """(path, outcome): ok, differs, malformed or missing. ``fail`` raises on
    the first path that is not ok. Both: path, sha512."""
    joined = local.select("path", F.col("sha512").alias("l")).join(remote.select("path", F.col("sha512").alias("r")), "path", "left")
    outcome = (
        F.when(F.col("r").isNull(), "missing")
        .when(~paths.sha512_ok(F.col("l")) | ~paths.sha512_ok(F.col("r")), "malformed")
        .when(F.lower("l") != F.lower("r"), "differs").otherwise("ok")
    )
    if fail:
        outcome = F.when(outcome == "ok", outcome).otherwise(
            F.raise_error(F.concat(F.lit("hash check failed: "), "path", F.lit(" "), outcome))
        )
    return joined.select("path", outcome.alias("outcome"))


def sip_arks_available(sips: DataFrame, sip_arks: DataFrame, available: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Whether each SIP may be indexed.

    sips: message, launched_at; sip_arks: message, ark; available: ark.
    error: malformed message; embargo: too young; no-arks: none found;
    ok: every ARK available; retry: some still missing.
    """
    held = available.select("ark", F.lit(True).alias("_held")).distinct()
    per_sip = sip_arks.join(held, "ark", "left").groupBy("message").agg(
        F.count("*").alias("n_arks"), F.bool_and(F.col("_held").isNotNull()).alias("_all")
    )
    young = F.unix_seconds(F.col("launched_at").cast("timestamp")) >= F.unix_seconds(now) - days * 86400
    return sips.join(per_sip, "message", "left").select(
        "message", F.coalesce("n_arks", F.lit(0)).alias("n_arks"),
        F.when(~paths.job_launch_ok(F.col("message"), any_job=True), "error").when(young, "embargo")
        .when(F.col("n_arks").isNull(), "no-arks").when(F.col("_all"), "ok").otherwise("retry").alias("outcome"),
    )


def mets_files(files: DataFrame, amdsecs: DataFrame) -> DataFrame:
    """Files with the ARK of their administrative section; ``count_mismatch``
    flags packages whose files and identified sections do not pair up.

    files: package, admid, path, mimetype, size, checksum_type, checksum;
    amdsecs: package, admid, ark.
    """
    known = amdsecs.filter("ark IS NOT NULL")
    per_file = files.groupBy("package").agg(F.count("*").alias("n_files"), F.count_distinct("admid").alias("n_ids"))
    per_sec = known.groupBy("package").agg(F.count("*").alias("n_secs"))
    flags = per_file.join(per_sec, "package", "left").select(
        "package", ((F.col("n_files") != F.coalesce("n_secs", F.lit(0))) | (F.col("n_files") != F.col("n_ids"))).alias("count_mismatch")
    )
    return files.join(known, ["package", "admid"]).join(flags, "package")


def warc_to_ark(warcs: DataFrame, arks: DataFrame, path: str = "path") -> DataFrame:
    """WARCs with the ARK listed for their base name. arks: name, ark."""
    return warcs.withColumn("name", U.basename(F.col(path))).join(arks, "name", "left")


def outside_manifest(files: DataFrame, known: DataFrame, path: str = "path") -> DataFrame:
    return files.join(known.select(path).distinct(), path, "left_anti")


def assign_identifiers(files: DataFrame, prefix: str, pool: DataFrame | None = None) -> DataFrame:
    """Identifier and four-digit admin counter for every file of a package run.

    files: path, kind. Order is warcs, viral, then logs, by path. Identifiers
    come from ``pool`` (identifier) in order, else are prefix + six digits.
    """
    rank = F.when(F.col("kind") == "warcs", 0).when(F.col("kind") == "viral", 1).otherwise(2)
    numbered = with_ordinal(files.withColumn("_rank", rank), [F.col("_rank"), F.col("path")]).drop("_rank")
    numbered = numbered.withColumn("admin_id", F.lpad(F.col("ordinal").cast("string"), F.greatest(F.lit(4), F.length(F.col("ordinal").cast("string"))), F.lit("0")))
    if pool is not None:
        ids = with_ordinal(pool.select("identifier"), [F.col("identifier")])
        return numbered.join(ids, "ordinal", "left")
    return numbered.withColumn("identifier", F.format_string(f"{prefix}%06d", "ordinal"))
