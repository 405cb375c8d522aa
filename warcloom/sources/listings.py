"""File-store listings and reports about it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import holdings

_DEPRECATED = "lsr: DEPRECATED"


def parse_lsr(lines: DataFrame, value: str = "value") -> DataFrame:
    """``ls -lsr`` text to schemas.LISTING rows: permissions, replicas, user,
    group, size, date, time, path (which may hold spaces). Times are UTC."""
    f = F.split(F.regexp_replace(F.col(value), r"^\s+|\s+$", ""), r"\s+", 8)
    # One-element explodes: a line is made once and split once, filters are not pushed below and evaluated again.
    return (
        lines.select(F.explode(F.array(value)).alias(value))
        .filter(~F.col(value).contains(_DEPRECATED))
        .select(F.explode(F.array(f)).alias("f"))
        .filter(F.size("f") == 8)
        .select(
            F.col("f")[0].alias("permissions"),
            F.col("f")[1].try_cast("int").alias("number_of_replicas"),
            F.col("f")[2].alias("userid"),
            F.col("f")[3].alias("groupid"),
            F.col("f")[4].try_cast("bigint").alias("filesize"),
            F.try_to_timestamp(F.concat_ws(" ", F.col("f")[5], F.col("f")[6]), F.lit("yyyy-MM-dd HH:mm")).alias("modified_at"),
            F.col("f")[7].alias("filename"),
        )
    )


def rejected_lsr(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that are no listing row: fewer than eight fields, or a size or time that cannot be read."""
    f = F.split(F.regexp_replace(F.col(value), r"^\s+|\s+$", ""), r"\s+", 8)
    fits = (F.size(f) == 8) & F.get(f, F.lit(4)).try_cast("bigint").isNotNull() & F.try_to_timestamp(
        F.concat_ws(" ", F.get(f, F.lit(5)), F.get(f, F.lit(6))), F.lit("yyyy-MM-dd HH:mm")).isNotNull()
    return lines.filter((F.btrim(value) != "") & ~F.col(value).contains(_DEPRECATED) & ~fits).select(F.col(value).alias("value"), F.size(f).alias("n_fields"))


def read_lsr(spark: SparkSession, path: str, directories: bool = False) -> DataFrame:
    rows = parse_lsr(spark.read.text(path))
    return rows if directories else rows.filter(~F.col("permissions").startswith("d"))


def read_listing_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV listing whose header row may come back anywhere in the file."""
    text = [f"{f.name} string" for f in schemas.LISTING.fields]
    raw = spark.read.csv(path, schema=", ".join(text)).filter(F.col("permissions") != "permissions")
    return raw.select(
        "permissions",
        F.col("number_of_replicas").try_cast("int").alias("number_of_replicas"),
        "userid",
        "groupid",
        F.col("filesize").try_cast("bigint").alias("filesize"),
        F.col("modified_at").try_cast("timestamp").alias("modified_at"),
        "filename",
    )


def read_object_inventory(inventory: DataFrame, bucket_prefix: str) -> DataFrame:
    """Object-store inventory rows to tracking records.

    ``inventory``: bucket, key, size, last_modified, owner_name, owner_id,
    storage_class, checksum_algorithm, e_tag, region. Only buckets with the
    given prefix are kept.
    """
    path = F.concat(F.lit("/"), "key")
    chosen = inventory.filter(F.col("bucket").startswith(bucket_prefix))
    listing = chosen.select(
        F.lit("-").alias("permissions"),
        F.lit(1).alias("number_of_replicas"),
        F.coalesce(F.nullif("owner_name", F.lit("")), F.concat(F.lit("id:"), "owner_id")).alias("userid"),
        F.lit("").alias("groupid"),
        F.col("size").alias("filesize"),
        F.col("last_modified").alias("modified_at"),
        path.alias("filename"),
        F.struct("bucket", "storage_class", "checksum_algorithm", "e_tag", "region", "last_modified").alias("aws"),
    )
    aws = F.col("aws")
    classified = holdings.classify_listing(listing, keep=["aws"])
    records = holdings.listing_record(classified, "aws_s3", "", "", keep=["aws"])
    return records.withColumns(
        {
            "id": F.concat(F.lit("s3a://"), aws["bucket"], "file_path_s"),
            "access_url_s": F.concat(F.lit("http://"), aws["bucket"], F.lit(".s3-website."), aws["region"],
                                     F.lit(".amazonaws.com"), "file_path_s"),
            "hdfs_type_s": F.lit("file"),
            "aws_bucket_name_s": aws["bucket"],
            "aws_storage_class_s": aws["storage_class"],
            "aws_checksum_algorithm_s": aws["checksum_algorithm"],
            "aws_e_tag_s": F.btrim(aws["e_tag"], F.lit('"')),
            "aws_region_s": aws["region"],
            "aws_modified_at_dt": F.date_format(aws["last_modified"], "yyyy-MM-dd'T'HH:mm:ss'.000Z'"),
        }
    ).drop("aws")


_ONE_COLON = r"^[^:]*:[^:]*$"


def _scan_lines(spark: SparkSession, path: str, node_pattern: str) -> DataFrame:
    return spark.read.text(path).select(F.regexp_extract(F.input_file_name(), node_pattern, 1).alias("node"), "value")


def rejected_block_scan(spark: SparkSession, path: str, node_pattern: str = r"([^/]*)$") -> DataFrame:
    """(node, value) of the lines that are no "key : value", blank ones left out."""
    return _scan_lines(spark, path, node_pattern).filter(~F.col("value").rlike(_ONE_COLON) & (F.btrim("value") != ""))


def read_block_scan(spark: SparkSession, path: str, node_pattern: str = r"([^/]*)$") -> DataFrame:
    """Block-scan reports to (node, key, value), the node being what the pattern
    takes from the path: the file name, if none is given.

    Keys become snake case; percentages become fractions with ``_percent``,
    other values get ``_count`` unless they are rates in kbps.
    """
    lines = _scan_lines(spark, path, node_pattern).filter(F.col("value").rlike(_ONE_COLON))
    key = F.regexp_replace(F.lower(F.btrim(F.regexp_extract("value", "^([^:]*):", 1))), " ", "_")
    text = F.btrim(F.regexp_extract("value", ":(.*)$", 1))
    percent = text.endswith("%")
    return lines.select(
        "node",
        F.when(percent, F.concat(key, F.lit("_percent"))).when(key.endswith("_kbps"), key).otherwise(F.concat(key, F.lit("_count"))).alias("key"),
        F.when(percent, F.regexp_replace(text, "%$", "").try_cast("double") / 100).otherwise(text.try_cast("double")).alias("value"),
    )
