"""Small tests of the fourth round's findings on time, disk and memory."""

from datetime import datetime, timedelta

import pytest

from warcloom.operators import captures
from warcloom.sources import curation
from warcloom.streaming import operators as ops
from warcloom.streaming import tables
from warcloom.streaming.runner import DISK_STATE, run_available

START = datetime(2024, 1, 1)


def test_launches_of_many_urls_share_states(spark, tmp_path):
    ins, table = tmp_path / "in", str(tmp_path / "table")
    rows_l, rows_c = "launch_no long, url string, launch_ts timestamp", "url string, captured_at timestamp"
    big = 2**53 + 1
    urls = ["a b", "é", "", None] + [f"u{i}" for i in range(30)]
    launches = [(big + i, u, START + timedelta(hours=7 * (i % 9))) for i, u in enumerate(urls)]
    captures = [(u, START + timedelta(hours=13 + 5 * (i % 8))) for i, u in enumerate(urls) if u and i % 3] + [("a b", START + timedelta(hours=3)), ("a b", None)]
    want = {}
    for n, url, at in launches:
        want[n] = url, min((c for u, c in captures if u == url and c and at <= c <= at + timedelta(hours=12)), default=None)
    for step in range(2):  # what one run leaves in a state, the next one reads
        spark.createDataFrame([x for x in launches if x[0] % 2 == step], rows_l).coalesce(1).write.mode("append").parquet(f"{ins}/launches")
        if step == 0:
            spark.createDataFrame(captures, rows_c).coalesce(1).write.parquet(f"{ins}/captures")
        stream = ops.launch_check(
            spark.readStream.schema(rows_l).parquet(f"{ins}/launches"), spark.readStream.schema(rows_c).parquet(f"{ins}/captures"), late="9 days", buckets=3)
        query = run_available(stream, str(tmp_path / "progress"), mode="update", batch=ops.store_launches(table))
        assert 0 < query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3
    assert {r.launch_no: (r.url, r.captured_at) for r in ops.launch_outcomes(spark, table).collect()} == want
    assert any(c for _, c in want.values()) and not all(c for _, c in want.values())


def test_trees_are_flattened_without_storing_them(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(type(spark.range(0)), "checkpoint", lambda self, *a, **k: stored.append(self))
    deep = '{"id": 100, "name": "bottom"}'
    for k in range(99, 0, -1):
        deep = f'{{"id": {k}, "name": "n{k}", "children": [{deep}], "more": {{"x": [1.50, true, null, "y"]}}}}'
    texts = [
        deep, ' [{"id": 200, "name": 1.50, "children": null}, {"id": "201", "name": "q\\"\\u00e9\\ud83d\\ude00\\n", "children": [null, 7, [], {"name": true}]}]', "[]", None, "null", '{"children": [{}]}']
    rows = curation.flatten_tree(spark.createDataFrame([(t,) for t in texts], "tree string"), "id long, name string")
    assert rows.columns == ["id", "name", "parent_id", "depth"] and not stored
    want = [(k, f"n{k}" if k < 100 else "bottom", k - 1 or None, k - 1) for k in range(1, 101)]
    want += [(200, "1.5", None, 0), (201, "q\"é😀\n", None, 0), *[(None, None, 201, 1)] * 3, (None, "true", 201, 1), *[(None, None, None, 0)] * 3, (None, None, None, 1)]
    assert sorted(map(str, (tuple(r) for r in rows.collect()))) == sorted(map(str, want))
    for wrong in ('{"id": 1', '{"id": NaN}', '{"id": 1, "id": 2}', '{"children": {"id": 1}}', ""):
        with pytest.raises(Exception):
            curation.flatten_tree(spark.createDataFrame([(wrong,)], "tree string"), "id long").collect()


def test_tree_fields_of_other_types_are_cast(spark):
    rows = curation.flatten_tree(spark.createDataFrame([('{"id": 1, "on": "true", "children": [{"id": "2", "on": false}]}',)], "tree string"), "id int, on boolean")
    assert sorted(tuple(r) for r in rows.collect()) == [(1, True, None, 0), (2, False, 1, 1)]


def test_summary_state_is_on_disk(spark, tmp_path):
    fields = "ts timestamp, url string, source string, status_code string, mime string, hop_path string, content_length string, annotations array<string>"
    table, schema = str(tmp_path / "table"), "hour string, host string, source string, property string, amount long"
    before = {k: spark.conf.get(k, None) for k in DISK_STATE}
    for run in range(2):
        rows = [(START + timedelta(minutes=i), "http://a.example/", f"s{i % 3}", "200", "text/html", "L", "10", ["3t"]) for i in range(30)]
        spark.createDataFrame(rows, fields).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        summary = ops.log_summary(spark.readStream.schema(fields).parquet(str(tmp_path / "in")))
        query = run_available(summary, str(tmp_path / "progress"), mode="update", batch=tables.upserted(table, ops.SUMMARY_KEY), disk_state=True)
        state = query.lastProgress["stateOperators"][0]
        assert any(k.startswith("rocksdb") for k in state["customMetrics"])
        assert {k: spark.conf.get(k, None) for k in DISK_STATE} == before
    totals = {(r.source, r.property): r.amount for r in tables.newest(spark, table, schema, ops.SUMMARY_KEY).collect()}
    assert len(totals) == 18 and totals["s1", "lines"] == 20 and totals["s1", "sum:content_length"] == 200 and totals["s2", "tries:3t"] == 20


def test_trace_reads_captures_and_records_once(spark):
    read = {"cdx": spark.sparkContext.accumulator(0), "records": spark.sparkContext.accumulator(0)}

    def counted(rows, schema, name):
        n = read[name]

        def seen(row):
            n.add(1)
            return row

        return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(seen), schema)

    urls = [f"http://h/{i}" for i in range(5)]
    cdx = counted([(u, "20240101000000", "f", i) for i, u in enumerate(urls)], "original string, timestamp string, filename string, offset long", "cdx")
    records = counted([("f", i, 302, urls[(i + 1) % 5]) for i in range(5)], "filename string, offset long, http_status int, location string", "records")
    rows = captures.trace_captures(spark.createDataFrame([(urls[0], START)], "url string, target_ts timestamp"), cdx, records)
    assert sorted((r.hop, r.url, r.offset) for r in rows.collect()) == [(i, u, i) for i, u in enumerate(urls)]
    assert {k: v.value for k, v in read.items()} == {"cdx": 5, "records": 5}
