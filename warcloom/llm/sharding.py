"""Two-pass external shuffle into shards.

Pass one scatters records into buckets of bounded size by a seeded hash of their
key and content. Pass two takes each bucket into memory, puts it in a fixed
order and applies a Fisher-Yates permutation seeded by bucket. The buckets one
after the other are a uniform shuffle of the whole; records are dealt from it to
the shards in turn, so shard sizes differ by at most one record (law ``rows``).

Only bucket sizes are summed up between the passes: one number per bucket, in
two levels of running sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage

_GROUP = 1000


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform permutation: from the last place down, swap with a random earlier or equal place."""
    draw = np.random.default_rng([seed, bucket])
    order = np.arange(n)
    for i, j in zip(range(n - 1, 0, -1), draw.integers(0, np.arange(n, 1, -1)).tolist(), strict=True):
        order[i], order[j] = order[j], order[i]
    return order


def external_shuffle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 17, bucket_bytes: int = 16_000_000,
) -> DataFrame:
    """``docs`` plus ``position``: its place in a seeded uniform shuffle of all rows, from 0.

    The shuffle depends on the seed, the ids, the texts and the number of
    buckets only, not on how the input is split. Null ids and texts are
    ordinary values; repeated rows each get a place. An input column named
    position is replaced; none may be named _bucket, _crc or _place.
    """
    docs = docs.drop("position")
    total = docs.agg(F.sum(record_size(F.col(text_col)))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    # The content joins the hash so that rows sharing an id are scattered too.
    crc = F.crc32(F.coalesce(F.col(text_col), F.lit("")))
    keyed = docs.withColumn("_crc", crc).withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), id_col, "_crc"), F.lit(buckets)))

    def permute(table: pa.Table) -> pa.Table:
        bucket = table.column("_bucket")[0].as_py()
        order = pc.sort_indices(table.select([id_col, "_crc"]), sort_keys=[(id_col, "ascending"), ("_crc", "ascending")]).to_numpy()
        mixed = table.take(pa.array(order[_fisher_yates(len(order), seed, bucket)]))
        return mixed.append_column("_place", pa.array(np.arange(len(order), dtype=np.int64)))

    schema = StructType([*keyed.schema.fields]).add("_place", "long")
    mixed = keyed.groupBy("_bucket").applyInArrow(permute, schema)
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_n")).withColumn("_group", F.floor(F.col("_bucket") / _GROUP))
    before = [Window.unboundedPreceding, -1]
    groups = sizes.groupBy("_group").agg(F.sum("_n").alias("_m"))
    # One row per thousand buckets, then one per bucket inside its thousand.
    groups = groups.select("_group", F.coalesce(F.sum("_m").over(Window.orderBy("_group").rowsBetween(*before)), F.lit(0)).alias("_base"))
    inside = F.coalesce(F.sum("_n").over(Window.partitionBy("_group").orderBy("_bucket").rowsBetween(*before)), F.lit(0))
    offsets = cut_lineage(sizes.withColumn("_inside", inside).join(groups, "_group").select("_bucket", (F.col("_base") + F.col("_inside")).alias("_first")))
    return (
        mixed.join(offsets, "_bucket").withColumn("position", F.col("_first") + F.col("_place"))
        .select(*docs.columns, "position")
    )


def deal(shuffled: DataFrame, shards: int = 8) -> DataFrame:
    """Adds ``shard`` and ``slot`` (gapless from 0 in each shard) to shuffled rows, in place of columns so named."""
    return shuffled.withColumn("shard", (F.col("position") % shards).cast("int")).withColumn(
        "slot", F.floor(F.col("position") / shards).cast("long")).drop("position")


def write_shards(dealt: DataFrame, path: str) -> None:
    """A folder per shard with its records in slot order; a shard may be several files, in name order."""
    dealt.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
