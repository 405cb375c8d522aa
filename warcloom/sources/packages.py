"""Readers for submission packages and hash manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.recon import mets_files

_FLOCAT = "struct<_href:string,`_xlink:href`:string>"
_METS_FILES = f"""
`mets:fileSec` struct<`mets:fileGrp`:array<struct<`mets:file`:array<struct<
  _ADMID:string,_MIMETYPE:string,_SIZE:bigint,_CHECKSUM:string,_CHECKSUMTYPE:string,`mets:FLocat`:{_FLOCAT}>>>>>,
`mets:amdSec` array<struct<_ID:string,`mets:digiprovMD`:struct<`mets:mdWrap`:struct<`mets:xmlData`:struct<`premis:object`:
  struct<`premis:objectIdentifier`:struct<`premis:objectIdentifierValue`:string>>>>>>>,
`mets:structMap` struct<`mets:div`:struct<_CONTENTIDS:string>>"""


def _mets(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("xml").option("rowTag", "mets:mets").schema(_METS_FILES).load(path)
        .withColumn("package", F.input_file_name())
    )


def read_mets(spark: SparkSession, path: str) -> DataFrame:
    """(package, admid, path, mimetype, size, checksum_type, checksum, ark, count_mismatch)."""
    docs = _mets(spark, path)
    file_rows = (
        docs.select("package", F.explode("`mets:fileSec`.`mets:fileGrp`").alias("g"))
        .select("package", F.explode("g.`mets:file`").alias("f"))
        .select(
            "package", F.col("f._ADMID").alias("admid"),
            F.coalesce("f.`mets:FLocat`.`_xlink:href`", "f.`mets:FLocat`._href").alias("path"), F.col("f._MIMETYPE").alias("mimetype"),
            F.col("f._SIZE").alias("size"), F.col("f._CHECKSUMTYPE").alias("checksum_type"), F.col("f._CHECKSUM").alias("checksum"),
        )
    )
    sections = docs.select("package", F.explode("`mets:amdSec`").alias("s")).select(
        "package", F.col("s._ID").alias("admid"),
        F.col("s.`mets:digiprovMD`.`mets:mdWrap`.`mets:xmlData`.`premis:object`.`premis:objectIdentifier`.`premis:objectIdentifierValue`").alias("ark"),
    )
    return mets_files(file_rows, sections)


def read_sip_ark_map(spark: SparkSession, path: str, resolve_prefix: str) -> DataFrame:
    """(ark, timestamp, url) of document packages whose first file location is
    ``resolve_prefix`` + 14 digits + separator + URL."""
    docs = _mets(spark, path)
    href = F.col("`mets:fileSec`.`mets:fileGrp`")[0]["mets:file"][0]["mets:FLocat"]
    location = F.coalesce(href["_xlink:href"], href["_href"])
    rest = F.substr(location, F.lit(len(resolve_prefix) + 1))
    return docs.select(
        F.col("`mets:structMap`.`mets:div`._CONTENTIDS").alias("ark"), F.substr(rest, F.lit(1), F.lit(14)).alias("timestamp"),
        F.substr(rest, F.lit(16)).alias("url"),
    )


# The two manifest line forms.
_MANIFEST = {"tsv": r"^([^\t]*)\t([0-9a-fA-F]+) ([0-9]+) (.*\S)\s*$", "star": r"^([0-9a-fA-F]+) \*(.*\S)\s*$"}


def rejected_manifest_lines(lines: DataFrame, fmt: str = "tsv", value: str = "value") -> DataFrame:
    """Lines of a manifest that do not have the form; blank lines are not reported."""
    return lines.filter(~F.col(value).rlike(_MANIFEST[fmt]) & (F.btrim(value) != "")).select(F.col(value).alias("value"))


def parse_hash_manifest(lines: DataFrame, fmt: str = "tsv", value: str = "value") -> DataFrame:
    """``tsv``: folder, tab, "sha512 length path". ``star``: "sha512 *path".
    Rows carry kind viral, warcs or logs by path."""
    v = F.col(value)
    if fmt == "tsv":
        pattern = _MANIFEST[fmt]
        rows = lines.filter(v.rlike(pattern)).select(
            F.regexp_extract(v, pattern, 2).alias("sha512"), F.regexp_extract(v, pattern, 3).cast("bigint").alias("length"),
            F.regexp_extract(v, pattern, 4).alias("path"),
        )
    elif fmt == "star":
        pattern = _MANIFEST[fmt]
        rows = lines.filter(v.rlike(pattern)).select(
            F.regexp_extract(v, pattern, 1).alias("sha512"), F.lit(None).cast("bigint").alias("length"),
            F.regexp_extract(v, pattern, 2).alias("path"),
        )
    else:
        raise ValueError(f"unknown manifest format {fmt}")
    return rows.withColumn(
        "kind", F.when(F.col("path").contains("/output/viral/"), "viral").when(F.col("path").contains("/output/warcs/"), "warcs").otherwise("logs")
    )


def read_hash_manifest(spark: SparkSession, path: str, fmt: str = "tsv") -> DataFrame:
    return parse_hash_manifest(spark.read.text(path), fmt)
