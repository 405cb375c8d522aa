"""Small tests of the reviewer's third round of findings."""

import glob
import random
import string

import numpy as np
from pyspark.sql import functions as F

from warcloom.llm import secrets
from warcloom.operators import packaging
from warcloom.plans import frames as fx
from warcloom.plans import reader_queries
from warcloom.streaming import operators as stream_ops


def test_running_lists_write_every_version_out(spark):
    rows = [("a", "l", "20240102"), ("a", "l", "final"), ("a", "l", "20240101"), ("a", "l", "20240102"), (None, "l", "x")]
    got = {(r.job, r.stage): (r.version, r.stages) for r in packaging.running_lists(spark.createDataFrame(rows, "job string, launch string, stage string")).collect()}
    assert got == {
        ("a", "20240101"): (1, ["20240101"]), ("a", "20240102"): (2, ["20240101", "20240102"]),
        ("a", "final"): (3, ["20240101", "20240102", "final"]), (None, "x"): (1, ["x"])}


def test_secret_model_learns_from_every_finding(spark, monkeypatch):
    """More findings of one label than a group holds; each one is trained on or held out."""
    draw = random.Random(4)

    def key(n, letters=string.ascii_letters + string.digits):
        return "".join(draw.choice(letters) for _ in range(n))

    rows = [(i, f"secret = {key(24)} then {'x ' * 30}{key(12, string.ascii_lowercase)}") for i in range(5000)]
    seen = []
    monkeypatch.setattr(secrets, "GROUP", 1000)
    monkeypatch.setattr(secrets, "_averaged", lambda groups, weights, epochs, seed: seen.append((groups.count(), groups.select("shard").distinct().count())) or weights)
    assert secrets.fit(spark.createDataFrame(rows, "doc_id long, text string")) is not None
    trained, groups = seen[0]
    assert 7800 < trained < 8200 and groups == -(-trained // 1000)  # four fifths of ten thousand


def test_secret_model_is_the_mean_of_its_groups(spark, monkeypatch):
    """Every weight comes back, whatever the number of groups, and the same each time."""
    rows = [(i % 2, f"word{i}", 0, 5) for i in range(300)]
    groups = spark.createDataFrame(rows, "label int, text string, start int, stop int").selectExpr("*", "pmod(xxhash64(text), 3) AS shard")
    start = secrets.CharCnn.fresh(np.random.default_rng(1)).weights
    one, again = (secrets._averaged(d, start, 1, 5) for d in (groups, groups.repartition(7)))
    assert {k: v.shape for k, v in one.items()} == {k: v.shape for k, v in start.items()}
    assert all(np.allclose(one[k], again[k]) for k in one) and not np.allclose(one["out"], start["out"])


def test_launches_go_to_the_states_of_their_waits_only(spark):
    """Any capture within the wait is in one of at most two states, not in all of them."""
    wait = 43_200_000
    starts = [wait * k // 5 + d for k in range(-30, 60) for d in (-1, 0, 1)]
    rows = spark.createDataFrame([(s, c) for s in starts for c in (0, 1, wait // 2, wait - 1, wait)], "start long, later long")
    rows = rows.withColumn("copies", stream_ops._launch_parts(F.timestamp_millis("start"), wait, 8))
    got = rows.select("copies", stream_ops._part(F.col("start") + F.col("later"), wait, 8).alias("part")).collect()
    assert all(r.part in r.copies for r in got) and {len(r.copies) for r in got} == {1, 2}
    assert sum(len(r.copies) for r in got) < 1.4 * len(got)


def test_listing_files_grow_with_the_splits_of_the_table(spark, monkeypatch, tmp_path):
    spark.range(4000).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "CAST(id % 7 AS INT) AS l_linenumber", "CAST(id AS DOUBLE) AS l_extendedprice",
        "DATE '1996-01-01' AS l_shipdate").repartition(12).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(reader_queries, "_folder", lambda spark, name: f"{tmp_path}/csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert reader_queries.src_4(spark, str(tmp_path)).count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(glob.glob(f"{tmp_path}/csv/part-*")) >= 12


def test_tracked_folds_copies_of_a_path_before_reading_it(spark, tmp_path):
    rows = [(1, 4, 3, n, price, day) for n, price, day in ((1, 5.0, "1996-01-01"), (1, 9.0, "1995-01-01"), (1, 7.0, "1997-01-01"))]
    rows += [(0, 4, 3, 2, 8.0, "1996-01-01"), (5, 98, 3, 2, None, None)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, day string").selectExpr(
        "*", "to_date(day) AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(3, 4, 3, 1, price, day) for price, day in ((5.0, "1996-01-01"), (9.0, "1995-01-01"))], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, day string").selectExpr(
        "*", "to_date(day) AS l_shipdate").write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    frame = fx.tracked(spark, str(tmp_path))
    got = {r.file_path_s: (r.kind_s, r.file_size_l, str(r.timestamp_dt)) for r in frame.collect()}
    assert got["/data/4/3/WARCS/f1.warc.gz"] == ("warcs", 9, "1996-01-02 12:00:00")
    assert got["/heritrix/output/frequent-bypm/19960101000000/warcs/BL-NPLD-19960101000000123-00002-h.warc.gz"] == ("warcs", 8, "1996-01-01 00:00:00.123000")
    assert len(got) == 6
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.index("Generate") < plan.index("HashAggregate")  # the plan's top comes first
