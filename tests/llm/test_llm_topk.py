import numpy as np
from llm_frames import read
from pyspark.sql import functions as F

from warcloom.llm import topk_products as T


def brute(rows, k, is_query):
    usable = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q, v in usable:
        if is_query(q):
            best = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable if i != q and len(w) == len(v)))[:k]
            out[q] = [(rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return out


def run(df, k=10, step=100, **options):
    got = {}
    for r in T.top_k(df, F.col("vec_id") % step == 0, k, **options).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in got.items()}


def test_table_equals_brute_force(spark):
    df = read(spark, "embeddings").select("vec_id", "embedding")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    assert run(df, bucket_rows=32, query_rows=2) == brute(rows, 10, lambda q: q % 100 == 0)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=4) * (5 if i % 7 == 0 else 0.3)).tolist()) for i in range(120)]
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(40)]  # one very common vector
    rows += [(300, None), (310, [1.0, None, 0.0, 1.0]), (320, [float("nan"), 1.0, 1.0, 1.0]), (330, [float("inf"), 0.0, 0.0, 0.0]),
             (340, [0.0, 0.0, 0.0, 0.0]), (350, [-1.0, -1.0, -1.0, -1.0]), (None, [9.0, 9.0, 9.0, 9.0]), (360, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "extra") for i, v in rows], "vec_id long, embedding array<double>, score string")
    want = brute(rows, 5, lambda q: q % 10 == 0)
    assert run(df, 5, 10, bucket_rows=16, query_rows=4) == {q: v for q, v in want.items() if v}


def test_empty(spark):
    assert T.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>"), F.lit(True)).count() == 0
    one = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert T.top_k(one, F.lit(True)).count() == 0


def test_table_larger_than_the_range_sample(spark):
    """Each query's best vector is the only one just above the bound of round one, so a bucket whose greatest length is told too small loses it."""
    n, many, longest = 8000, 24, 1000.0
    rows = [(1000 + i, [longest * (0.5 + 0.5 * i / (n - 1)), *[0.0] * many]) for i in range(n)]
    for i in range(many):
        near = 0.55 + 0.4 * i / many
        for number, length in ((i, 1.0), (100 + i, longest * near * 1.0005)):
            axes = [0.0] * many
            axes[i] = length * (1 - near * near) ** 0.5
            rows.append((number, [length * near, *axes]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    size = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    spark.conf.set(size, "4")
    try:
        got = T.top_k(df, F.col("vec_id") < many, 1, bucket_rows=200, query_rows=1).collect()
    finally:
        spark.conf.unset(size)
    vectors = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64)
    ids = np.array([i for i, _ in rows])
    want = {}
    for i in range(many):
        scores = vectors @ vectors[int(np.flatnonzero(ids == i)[0])]
        scores[ids == i] = np.iinfo(np.int64).min
        want[i] = (int(ids[scores.argmax()]), int(scores.max()))
    assert {r.query_id: (r.vec_id, r.score) for r in got} == want
