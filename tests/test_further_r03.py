"""Small tests of the third round's remaining findings on time and memory: work is dealt to tasks by rows."""

from pyspark.sql import functions as F

from warcloom.operators.ordering import asof_forward
from warcloom.plans import frames as fx


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark, folder) -> str:
    spark.range(60).selectExpr(
        "id AS event_id", "TIMESTAMP '2024-01-01 00:00:00' AS ts", "id AS user_id", "'view' AS event_type", "1.0D AS value").coalesce(1).write.parquet(f"{folder}/events.parquet")
    spark.range(5).selectExpr("id AS page_id", "'http://h/' || id AS url", "'' AS html").coalesce(1).write.parquet(f"{folder}/pages.parquet")
    return str(folder)


def test_rows_of_one_split_are_dealt_to_tasks(spark, tmp_path, monkeypatch):
    sf = _tables(spark, tmp_path)
    monkeypatch.setattr(fx, "_DEALT_ROWS", 3)
    assert fx.tasks_for(spark, sf, "events") == max(20, spark.sparkContext.defaultParallelism)
    n = fx.tasks_for(spark, sf, "events")
    assert f"RoundRobinPartitioning({n})" in _physical(fx.crawl_log(spark, sf))
    assert fx.crawl_log(spark, sf).count() == 60
    lines = fx.crawl_log(spark, sf, fx.event_stream(spark, sf))
    assert f"Repartition {n}, true" in lines._jdf.queryExecution().logical().toString()


def test_as_of_join_has_all_tasks_of_a_shuffle(spark):
    left = spark.createDataFrame([("k", 5, 1), ("k", 9, 2), (None, 5, 3)], "key string, t int, no int").withColumn("t", F.timestamp_seconds("t"))
    right = spark.createDataFrame([("k", 7, "a"), ("k", 7, "b")], "key string, t int, v string").withColumn("t", F.timestamp_seconds("t"))
    found = asof_forward(left, right, "key", "t", F.struct("t", "v"), "hit")
    assert "REPARTITION_BY_NUM" in _physical(found)
    assert {(r.no, r.hit.v if r.hit else None) for r in found.collect()} == {(1, "a"), (2, None), (3, None)}
