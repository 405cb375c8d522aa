"""Exact top-k inner products by norm buckets with local pruning.

Vectors are grouped by length into buckets of about ``bucket_rows``, longest
first, and each bucket becomes one block of integers. Queries are taken in
blocks too. A first round scores every query against the longest bucket, which
gives a lower bound on its k-th best score. With that bound a bucket is worth
visiting only if |query| times the bucket's greatest length reaches it, and
inside a bucket the bound becomes a local threshold on the cosine:

* above 1, the bucket is skipped for this query;
* high, few candidates are left by coordinate pruning: a vector whose cosine
  with the query is at least t has each coordinate of its direction within a
  known interval around the query's, tested on the query's heaviest coordinates;
* otherwise, length pruning alone: vectors are sorted by length, so those too
  short are a suffix.

What is left is verified by the exact integer product. Equal vectors are
collapsed first (they tie on every query, so only their smallest ids can be
among the best), which keeps one very common vector from filling a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: A local cosine threshold from which coordinates are tested before products.
COORDINATE_FROM = 0.6
_COORDINATES = 6


def quantised(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as double; null where the vector takes no part."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(vector.isNotNull() & good, whole)


def _collapsed(vectors: DataFrame, k: int) -> DataFrame:
    """(vec, ids, norm2): the k + 1 smallest ids of each distinct vector, counted in two steps.

    The first step works inside each task, so a vector that a third of all rows
    share reaches its group as a few lists.
    """
    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            groups: dict[tuple, list[int]] = {}
            for i, v in zip(ids, batch.column("vec").to_pylist(), strict=True):
                groups.setdefault(tuple(v), []).append(i)
            yield pa.record_batch({
                "vec": pa.array([list(v) for v in groups], pa.list_(pa.int64())),
                "ids": pa.array([sorted(g)[:k + 1] for g in groups.values()], pa.list_(pa.int64())),
            })

    rows = vectors.mapInArrow(inside, "vec array<bigint>, ids array<bigint>")
    merged = rows.groupBy("vec").agg(F.flatten(F.collect_list("ids")).alias("ids"))
    norm2 = F.aggregate("vec", F.lit(0).cast("bigint"), lambda total, x: total + x * x)
    return merged.select("vec", F.slice(F.array_sort("ids"), 1, k + 1).alias("ids"), norm2.alias("norm2"))


def _blocks(table: pa.Table) -> pa.Table:
    """One group (a bucket of distinct vectors) as a single row."""
    order = np.argsort(-table.column("norm2").to_numpy(), kind="stable")
    vectors = np.array(table.column("vec").to_pylist(), np.int64)[order]
    ids = [table.column("ids")[int(i)].as_py() for i in order]
    lengths = np.array([len(i) for i in ids], np.int32)
    return pa.table({
        "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int64()), "width": pa.array([vectors.shape[1]], pa.int32()),
        "vectors": pa.array([vectors.tobytes()], pa.binary()),
        "ids": pa.array([np.array([x for i in ids for x in i], np.int64).tobytes()], pa.binary()),
        "counts": pa.array([lengths.tobytes()], pa.binary()),
    })


def _query_blocks(table: pa.Table) -> pa.Table:
    vectors = np.array(table.column("vec").to_pylist(), np.int64)
    return pa.table({
        "qblock": pa.array([table.column("qblock")[0].as_py()], pa.int64()),
        "queries": pa.array([vectors.tobytes()], pa.binary()),
        "qids": pa.array([table.column("id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
        "qwidth": pa.array([vectors.shape[1]], pa.int32()),
    })


def _candidates(query: np.ndarray, length: float, vectors: np.ndarray, lengths: np.ndarray, bound: float) -> np.ndarray:
    """Rows of a bucket that may score ``bound`` or more; lengths fall."""
    if length == 0:
        return np.arange(len(vectors)) if bound <= 0 else np.zeros(0, np.int64)
    if bound <= 0:
        return np.arange(len(vectors))
    # Length pruning; a hair of slack keeps rounding from dropping a tie.
    n = int(np.searchsorted(-lengths * length, -bound * (1 - 1e-9), "right"))
    if not n:
        return np.zeros(0, np.int64)
    cosine = bound / (length * lengths[0])
    if cosine < COORDINATE_FROM:
        return np.arange(n)
    # Coordinate pruning: with unit vectors, sum of squared differences is 2 - 2 cos, so each is at most its root.
    direction = query / length
    heavy = np.argsort(-np.abs(direction))[:_COORDINATES]
    reach = np.sqrt(max(0.0, 2 - 2 * cosine)) * (1 + 1e-9) + 1e-9
    rows = np.arange(n)
    squared = np.zeros(n)
    for axis in heavy:
        squared = squared + (vectors[rows, axis] / lengths[rows] - direction[axis]) ** 2
        near = squared <= reach * reach
        rows, squared = rows[near], squared[near]
    return rows


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _search(batches: Iterator[pa.RecordBatch], k: int, bounded: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out_q, out_v, out_s = [], [], []
        for row in batch.to_pylist():
            vectors = np.frombuffer(row["vectors"], np.int64).reshape(-1, row["width"])
            queries = np.frombuffer(row["queries"], np.int64).reshape(-1, row["qwidth"])
            if row["width"] != row["qwidth"]:
                continue  # no inner product between different dimensions
            qids = np.frombuffer(row["qids"], np.int64)
            ids, counts = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["counts"], np.int32)
            starts = np.concatenate([[0], np.cumsum(counts)])
            lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
            bounds = np.frombuffer(row["bounds"], np.float64) if bounded else np.full(len(qids), -np.inf)
            for query, qid, bound in zip(queries, qids, bounds, strict=True):
                length = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
                rows = _candidates(query, length, vectors, lengths, float(bound))
                if not len(rows):
                    continue
                products = vectors[rows] @ query
                enough = products >= bound
                rows, products = rows[enough], products[enough]
                if len(rows) > k + 1:
                    # Rows are distinct vectors; the k + 1 best scores and all that tie with the last.
                    edge = np.partition(products, len(products) - k - 1)[len(products) - k - 1]
                    rows, products = rows[products >= edge], products[products >= edge]
                many = counts[rows]
                flat = np.repeat(starts[rows], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                scores, found = np.repeat(products, many), ids[flat]
                other = found != qid
                scores, found = _best(scores[other], found[other], k)
                out_q += [int(qid)] * len(found)
                out_v += found.tolist()
                out_s += scores.tolist()
        yield pa.record_batch({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.int64())})


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", *,
    bucket_rows: int = 4096, query_rows: int = 1024, scale: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest products with every other row.

    Ties go to the smaller id. Vectors that are null or hold a null or
    non-finite component, and rows without an id, take no part; neither do pairs
    of different dimensions. A query id that repeats is one query, whose best are
    taken over its vectors, and rows with its id are not its candidates. Fewer than k
    candidates give fewer rows. Other columns are not read.
    """
    whole = cut_lineage(
        vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("vec"), is_query.alias("is_query"))
        .where(F.col("vec").isNotNull() & F.col("id").isNotNull())
    )
    distinct = cut_lineage(_collapsed(whole.select("id", "vec"), k))
    n = distinct.count()
    if not n:
        return whole.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score")).limit(0)
    buckets = -(-n // bucket_rows)
    # A range partition by falling length; ties are split by the vectors themselves.
    # Range bounds are sampled anew by each run of the plan, so the buckets are fixed before they are read twice.
    ranged = cut_lineage(
        distinct.repartitionByRange(buckets, F.desc("norm2"), F.xxhash64("vec"), "vec").withColumn("bucket", F.spark_partition_id().cast("long")))
    blocks = cut_lineage(
        ranged.withColumn("width", F.size("vec")).groupBy("bucket", "width").applyInArrow(
            _blocks, "bucket long, width int, vectors binary, ids binary, counts binary"))
    limits = ranged.groupBy("bucket", F.size("vec").alias("qwidth")).agg(F.max("norm2").alias("longest"))
    queries = whole.where("is_query").select("id", "vec").distinct()
    asked = queries.count()
    qblocks = max(1, -(-asked // query_rows))
    packed = cut_lineage(
        queries.withColumn("qblock", F.pmod(F.xxhash64("id", "vec"), F.lit(qblocks))).withColumn("qwidth", F.size("vec"))
        .groupBy("qblock", "qwidth").applyInArrow(_query_blocks, "qblock long, queries binary, qids binary, qwidth int"))

    # Round one: every query block meets the bucket of the longest vectors of its dimension.
    first = blocks.groupBy(F.col("width").alias("qwidth")).agg(F.min("bucket").alias("bucket"))
    found = cut_lineage(
        packed.join(first, "qwidth").join(blocks, "bucket").where("width = qwidth")
        .mapInArrow(lambda it: _search(it, k, False), "query_id long, vec_id long, score long"))
    bound = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).select(
        "query_id", F.when(F.col("n") >= k, F.col("least").cast("double")).otherwise(F.lit(float("-inf"))).alias("bound"))
    known = (
        queries.withColumn("qblock", F.pmod(F.xxhash64("id", "vec"), F.lit(qblocks))).withColumn("qwidth", F.size("vec"))
        .withColumn("length", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda t, x: t + x.cast("double") * x)))
        .join(bound, queries["id"] == bound["query_id"], "left")
        .withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    )
    # What a bucket must reach to matter to any query of a block.
    needs = known.groupBy("qblock", "qwidth").agg(F.min(F.when(F.col("bound") > 0, F.col("bound") / F.greatest("length", F.lit(1e-300))).otherwise(0.0)).alias("need"))
    visits = (
        needs.join(limits, "qwidth").join(first.withColumnRenamed("bucket", "done"), "qwidth")
        .where((F.col("bucket") != F.col("done")) & (F.sqrt(F.col("longest").cast("double")) * (1 + 1e-9) >= F.col("need")))
        .select("qblock", "qwidth", "bucket")
    )
    bounds = known.groupBy("qblock", "qwidth").agg(F.collect_list(F.struct("id", "vec", "bound")).alias("rows"))
    return _finish(packed, bounds, visits, blocks, found, k)


def _finish(packed: DataFrame, bounds: DataFrame, visits: DataFrame, blocks: DataFrame, found: DataFrame, k: int) -> DataFrame:
    def lined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bounds in the order of the block's queries (at most a block's worth of rows)."""
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                queries = np.frombuffer(row["queries"], np.int64).reshape(-1, row["qwidth"])
                by_query = {(r["id"], tuple(r["vec"])): r["bound"] for r in row["rows"]}
                ids = np.frombuffer(row["qids"], np.int64)
                out.append(np.array([by_query[int(i), tuple(q.tolist())] for i, q in zip(ids, queries, strict=True)], np.float64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("qblock", "queries", "qids", "qwidth")), pa.array(out, pa.binary())],
                ["qblock", "queries", "qids", "qwidth", "bounds"])

    ready = packed.join(bounds, ["qblock", "qwidth"]).mapInArrow(
        lined_up, "qblock long, queries binary, qids binary, qwidth int, bounds binary")
    more = (
        ready.join(visits, ["qblock", "qwidth"]).join(blocks, "bucket").where("width = qwidth")
        .mapInArrow(lambda it: _search(it, k, True), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.union(more).distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
