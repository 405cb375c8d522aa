"""Streams over several runs: keyed tables, repeated batches, timers and bounded state."""

import random
from datetime import datetime, timedelta

from warcloom.streaming import operators as ops
from warcloom.streaming import tables
from warcloom.streaming.runner import run_available

START = datetime(2024, 1, 1)
SCHEMA = "k string, at long, v string"


def test_first_row_of_a_key_is_kept_whatever_runs_again(spark, tmp_path):
    path = str(tmp_path / "t")
    store = tables.first_kept(path, ["k"], ["at"], buckets=4)
    batches = [[("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], [("a", 0, "late"), ("c", 1, "n"), ("b", 5, "z")], []]

    def held():
        return sorted((r.k, r.v) for r in tables.read_batches(spark, path, SCHEMA).collect())

    for number, rows in enumerate(batches):
        for _ in range(2):  # a batch that fails at its end runs again
            store(spark.createDataFrame(rows, SCHEMA), number)
    assert held() == [("a", "y"), ("b", "z"), ("c", "n")]
    store(spark.createDataFrame(batches[1], SCHEMA), 1)
    assert held() == [("a", "y"), ("b", "z"), ("c", "n")]


def test_look_ups_read_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_batch(spark.createDataFrame([(f"k{i}", i, "v") for i in range(200)], SCHEMA), path, 0, ["k"], 8)
    plan = tables.read_batches(spark, path, SCHEMA).where("_bucket IN (3) AND _batch < 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters")[1].split("]")[0]


def test_newest_row_of_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.newest(spark, path, SCHEMA, ["k"]).count() == 0
    write = tables.upserted(path, ["k"])
    for number, rows in enumerate([[("a", 1, "x"), ("b", 1, None)], [("a", 2, None)], [("c", 3, "q")]]):
        write(spark.createDataFrame(rows, SCHEMA), number)
        write(spark.createDataFrame(rows, SCHEMA), number)
    assert sorted(tuple(r) for r in tables.newest(spark, path, SCHEMA, ["k"]).collect()) == [("a", 2, None), ("b", 1, None), ("c", 3, "q")]


def test_launches_over_several_runs(spark, tmp_path):
    """Against brute force after every run; one URL has a third of everything; captures may come before their launches."""
    rnd = random.Random(7)
    urls = ["hot"] * 3 + [f"u{i}" for i in range(6)]
    launches = [(n, rnd.choice(urls), START + timedelta(minutes=rnd.randrange(3000))) for n in range(150)]
    captures = [(rnd.choice(urls), START + timedelta(minutes=rnd.randrange(3000))) for _ in range(60)]
    ins, table, progress = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "progress")
    rows_l, rows_c = "launch_no long, url string, launch_ts timestamp", "url string, captured_at timestamp"
    wait, late = timedelta(hours=12), timedelta(hours=1)
    seen_l, seen_c, mark, query = [], [], datetime.min, None
    for step in range(0, 3000, 500):
        low, high = START + timedelta(minutes=step), START + timedelta(minutes=step + 500)
        new_l = [x for x in launches if low <= x[2] < high]
        new_c = [x for x in captures if low - timedelta(minutes=30) <= x[1] < high - timedelta(minutes=30)]
        seen_l, seen_c = seen_l + new_l, seen_c + new_c
        spark.createDataFrame(new_l, rows_l).coalesce(1).write.mode("append").parquet(f"{ins}/launches")
        spark.createDataFrame(new_c, rows_c).coalesce(1).write.mode("append").parquet(f"{ins}/captures")
        stream = ops.launch_check(spark.readStream.schema(rows_l).parquet(f"{ins}/launches"), spark.readStream.schema(rows_c).parquet(f"{ins}/captures"), parts=3)
        query = run_available(stream, progress, mode="update", batch=ops.store_launches(table))
        mark = min(max(x[2] for x in seen_l), max(x[1] for x in seen_c)) - late
        want = {}
        for n, url, at in seen_l:
            first = min((c for u, c in seen_c if u == url and at <= c <= at + wait), default=None)
            want[n] = (first, "CAPTURED" if first else "FAILED" if at + wait < mark else "PENDING")
        got = {r.launch_no: (r.captured_at, r.outcome) for r in ops.launch_outcomes(spark, table, parts=3).collect()}
        assert got == want
    assert {o for _, o in got.values()} == {"CAPTURED", "FAILED", "PENDING"}
    # What has ended has left the state: at most the open keys of 7 URLs in 3 parts.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 21


def test_launches_state_ends(spark, tmp_path):
    ins, table = tmp_path / "in", str(tmp_path / "table")
    rows_l, rows_c = "launch_no long, url string, launch_ts timestamp", "url string, captured_at timestamp"

    def run(new_l, new_c):
        spark.createDataFrame(new_l, rows_l).coalesce(1).write.mode("append").parquet(f"{ins}/launches")
        spark.createDataFrame(new_c, rows_c).coalesce(1).write.mode("append").parquet(f"{ins}/captures")
        stream = ops.launch_check(spark.readStream.schema(rows_l).parquet(f"{ins}/launches"), spark.readStream.schema(rows_c).parquet(f"{ins}/captures"), parts=2)
        return run_available(stream, str(tmp_path / "progress"), mode="update", batch=ops.store_launches(table))

    first = run([(i, f"u{i}", START) for i in range(40)], [(f"u{i}", START + timedelta(hours=1)) for i in range(20)])
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in first.recentProgress) >= 40
    far = START + timedelta(days=9)
    last = run([(900, "far", far)], [("far", far)])
    assert last.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
    outcomes = [r.outcome for r in ops.launch_outcomes(spark, table, parts=2).collect()]
    assert (outcomes.count("CAPTURED"), outcomes.count("FAILED"), outcomes.count("PENDING")) == (21, 20, 0)


def test_summary_totals_grow_over_runs(spark, tmp_path):
    fields = "ts timestamp, url string, source string, status_code string, mime string, hop_path string, content_length string, annotations array<string>"
    table, schema = str(tmp_path / "table"), "hour string, host string, source string, property string, amount long"
    sizes = []
    for run in range(3):
        rows = [(START + timedelta(hours=5 * run, minutes=i), "http://a.example/", "s", "200", "text/html", "L", "10", []) for i in range(30)]
        spark.createDataFrame(rows, fields).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        summary = ops.log_summary(spark.readStream.schema(fields).parquet(str(tmp_path / "in")))
        query = run_available(summary, str(tmp_path / "progress"), mode="update", batch=tables.upserted(table, ops.SUMMARY_KEY))
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    lines = [r for r in tables.newest(spark, table, schema, ops.SUMMARY_KEY).collect() if r.property == "lines"]
    assert [r.amount for r in lines] == [30, 30, 30] and len({r.hour for r in lines}) == 3
    assert sizes[2] <= sizes[0]  # windows that have ended left the state
