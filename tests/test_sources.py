"""File readers and sinks on small hand-written files."""

import gzip
import hashlib
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from warcloom.plans import workflows
from warcloom.operators import tracking
from warcloom.sources import cdx, curation, listings, packages, sinks, warc


def record(kind, uri, content_type, body, **extra):
    head = [f"WARC-Type: {kind}", f"WARC-Target-URI: {uri}", "WARC-Date: 2020-01-02T03:04:05Z", f"Content-Type: {content_type}", f"Content-Length: {len(body)}"]
    head += [f"{k.replace('_', '-')}: {v}" for k, v in extra.items()]
    return ("WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


RECORDS = [
    record("warcinfo", "", "application/warc-fields", b"software: x"),
    record("response", "http://a.example/", "application/http; msgtype=response", b"HTTP/1.1 301 Moved\r\nLocation: /b\r\nContent-Type: text/html; charset=x\r\n\r\nbody", WARC_Payload_Digest="sha1:ABC"),
    record("metadata", "http://a.example/", "application/warc-fields", b"outlink: http://b.example/ L a/@href\r\nfetchTimeMs: 3\r\n"),
    record("response", "http://big.example/", "application/http; msgtype=response", b"HTTP/1.1 200 OK\r\nContent-Type: TEXT/plain\r\n\r\n" + b"z" * 3_000_000),
]


@pytest.fixture(scope="module")
def warcs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("warcs")
    (folder / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in RECORDS))
    (folder / "b.warc").write_bytes(b"".join(RECORDS))
    (folder / "broken.warc.gz").write_bytes(gzip.compress(RECORDS[0]) + gzip.compress(RECORDS[1])[:-20])
    return folder


@pytest.mark.parametrize("name", ["a.warc.gz", "b.warc"])
def test_warc_records(spark, warcs, name):
    rows = warc.read_warc_records(spark, str(warcs / name)).orderBy("offset").collect()
    assert [r.rec_type for r in rows] == ["warcinfo", "response", "metadata", "response"]
    moved = rows[1]
    assert (moved.http_status, moved.location, moved.mime, moved.digest) == (301, "/b", "text/html", "ABC")
    assert rows[2].outlinks == ["http://b.example/"]
    data = (warcs / name).read_bytes()
    chunk = data[moved.offset : moved.offset + moved.length]
    assert b"301 Moved" in (gzip.decompress(chunk) if name.endswith("gz") else chunk)


def test_broken_warc_becomes_an_error_row(spark, warcs):
    rows = warc.read_warc_records(spark, str(warcs / "broken.warc.gz")).orderBy("offset").collect()
    assert len(rows) == 2 and rows[0].rec_type == "warcinfo" and "EOFError" in rows[1].warc_error


def archive_of(tmp_path, name, parts):
    path = tmp_path / f"{name}.warc.gz"
    path.write_bytes(b"".join(parts))
    return str(path), path.stat().st_size


def test_ranges_give_the_rows_of_the_whole(tmp_path):
    """Whatever the cuts: with an archive inside a record, with broken records and rubbish between."""
    rng = random.Random(1)

    def response(i, body):
        return gzip.compress(record("response", f"http://o{i}/", "application/http; msgtype=response", b"HTTP/1.1 200 OK\r\n\r\n" + body))

    nested = b"".join(response(f"inner{i}", rng.randbytes(3000)) for i in range(100))
    parts = [response(i, nested if i == 20 else rng.randbytes(rng.randint(1, 9000))) for i in range(60)]
    for name, pieces, errors in (
        ("whole", parts, 0), ("broken", [*parts[:10], parts[10][:-30], *parts[11:40], b"junk" * 100, *parts[40:]], 2), ("cut", [*parts[:-1], parts[-1][:50]], 1),
        ("twice", [*parts[:5], gzip.compress(RECORDS[0] + RECORDS[2]), *parts[5:]], 1),
    ):
        path, size = archive_of(tmp_path, name, pieces)
        whole = list(warc.read_range(path, 0, None, True))
        assert sum("warc_error" in r for r in whole) == errors
        assert not any("inner" in (r.get("target_uri") or "") for r in whole)
        for step in (1000, 10_000, 150_000, size):
            assert [r for at in range(0, size, step) for r in warc.read_range(path, at, at + step, True)] == whole


def test_source_reads_ranges_globs_and_folders(spark, warcs, tmp_path):
    folder = str(tmp_path / "out")
    rows = [("response", f"http://x{i}/", "2020-01-01T00:00:00Z", "application/http; msgtype=response", f"<urn:{i}>", None, None,
             b"HTTP/1.1 200 OK\r\n\r\n" + random.Random(i).randbytes(2000)) for i in range(200)]
    warc.write_warc(spark.createDataFrame(rows, warc.WRITTEN), folder)
    (tmp_path / "out" / ".left-by-a-failed-task.warc.gz").write_bytes(b"x")
    want = sorted((r[1], hashlib.md5(r[-1][19:]).hexdigest()) for r in rows)
    for path in (folder, f"{folder}/*.warc.gz"):
        found = warc.read_warc_records(spark, path, keep_content=True, range_bytes=30_000)
        assert found.rdd.getNumPartitions() > 8
        assert sorted((r.target_uri, hashlib.md5(r.content).hexdigest()) for r in found.collect()) == want
    assert warc.read_warc_records(spark, f"{folder}/none*").count() == 0
    assert {r.warc_error for r in warc.read_warc_records(spark, folder).collect()} == {None}


def test_request_bodies_as_arguments():
    assert warc.post_query("POST", "application/x-www-form-urlencoded; charset=x", b"a=1+2&b=%C3%A9") == "__wb_method=POST&a=1 2&b=\u00e9"
    assert warc.post_query("PUT", "application/json", b'{"a": {"b": [1, "x"]}, "c": null}') == "__wb_method=PUT&b=1&b=x&c=null"
    assert warc.post_query("POST", "text/plain", b"\xff") == "__wb_method=POST&__wb_post_data=/w=="
    assert warc.post_query("POST", "application/json", b"{") == "__wb_method=POST&__wb_post_data=ew=="
    body = b'--X\r\nContent-Disposition: form-data; name="f"\r\n\r\nv w\r\n--X--\r\n'
    assert warc.post_query("POST", "multipart/form-data; boundary=X", body) == "__wb_method=POST&f=v+w"


def test_records_find_the_request_they_answer(spark):
    fields = "filename string, rec_type string, record_id string, concurrent_to string, post_query string"
    rows = [("f", "response", "r1", None, None), ("f", "request", "q1", "r1", "a"), ("f", "response", "r2", "q2", None), ("f", "request", "q2", None, "b"),
            ("f", "metadata", "m1", "r1", None), ("g", "response", "r1", None, None), ("f", "response", None, None, None), ("f", "request", None, None, "c")]
    got = warc.with_post_query(spark.createDataFrame(rows, fields)).collect()
    assert sorted(((r.filename, r.rec_type, r.record_id, r.post_query) for r in got), key=repr) == sorted(
        [("f", "response", "r1", "a"), ("f", "response", "r2", "b"), ("f", "metadata", "m1", None), ("g", "response", "r1", None), ("f", "response", None, None)], key=repr)


def test_whole_content_is_kept(spark, warcs):
    big = warc.read_warc_records(spark, str(warcs / "a.warc.gz"), keep_content=True).filter("target_uri = 'http://big.example/'").first()
    assert len(big.content) == 3_000_000


def test_record_mapper(spark, warcs):
    def count(batches):
        for batch in batches:
            yield pd.DataFrame({"kind": batch["rec_type"], "n": 1})

    got = warc.warc_job(spark, str(warcs / "a.warc.gz"), count, "kind string, n int").groupBy("kind").sum("n").collect()
    assert {r.kind: r[1] for r in got} == {"warcinfo": 1, "response": 2, "metadata": 1}


def test_file_hashes(spark, warcs):
    got = {r.path.rsplit("/", 1)[1]: (r.length, r.sha512) for r in warc.file_hashes(spark, str(warcs)).collect()}
    for name in ("a.warc.gz", "b.warc"):
        data = (warcs / name).read_bytes()
        assert got[name] == (len(data), hashlib.sha512(data).hexdigest())


def test_targets_formats(spark, tmp_path):
    targets = [{"id": 1, "title": "A", "seeds": ["http://a/"], "watched": True}, {"id": 2, "title": "B", "seeds": [], "watched": False}]
    (tmp_path / "t.json").write_text(json.dumps(targets, indent=1))
    (tmp_path / "t.jsonl").write_text("\n".join(json.dumps(t) for t in targets))
    for name in ("t.json", "t.jsonl"):
        assert {r.id: r.watched for r in curation.read_targets(spark, str(tmp_path / name)).collect()} == {1: True, 2: False}
    with pytest.raises(ValueError):
        curation.read_targets(spark, str(tmp_path / "t.xml"))


def test_curation_export(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({
        "targets": {"1": {"id": 1, "title": "A", "seeds": ["http://a/"]}}, "collections": {"9": {"id": 9, "name": "C", "publish": True, "target_ids": [1, 2]}},
        "subjects": {"4": {"id": 4, "name": "S"}}}))
    targets, collections, pairs, subjects = curation.read_curation(spark, str(tmp_path / "c.json"))
    assert targets.first().title == "A" and collections.first().name == "C" and subjects.first().name == "S"
    assert sorted((r.collection_id, r.target_id) for r in pairs.collect()) == [(9, 1), (9, 2)]


def test_flatten_tree_of_any_depth(spark):
    deep = {"id": 12}
    for i in range(11, 2, -1):
        deep = {"id": i, "name": f"n{i}", "children": [deep]}
    trees = [json.dumps({"id": 1, "name": "a", "children": [{"id": 2, "children": []}, deep]}), json.dumps([{"id": 20}, {"id": 21, "children": None}]), None]
    rows = curation.flatten_tree(spark.createDataFrame([(t,) for t in trees], "tree string"), "id long, name string").collect()
    want = [(1, None, 0), (2, 1, 1), (3, 1, 1), *[(i, i - 1, i - 2) for i in range(4, 13)], (20, None, 0), (21, None, 0)]
    assert sorted((r.id, r.parent_id, r.depth) for r in rows if r.id) == want
    assert {r.id: r.name for r in rows}[7] == "n7"


def test_harvest_state_and_har(spark, tmp_path):
    folder = tmp_path / "documents-2020-01-01"
    folder.mkdir()
    (folder / "d1").write_text(json.dumps({"document_url": "http://d", "size": 5}))
    row = curation.read_harvest_state(spark, str(tmp_path)).first()
    assert (row.document_url, row.title, row.target_id, row.status) == ("http://d", None, None, "NEW")
    har = {"log": {"entries": [{"request": {"method": "GET", "url": "http://x/i.png", "headers": []}, "response": {"status": 200, "headers": []}}], "pages": [{"map": [{"href": "http://x/l"}, {"onclick": "f()"}]}]}}
    (tmp_path / "h.har").write_text(json.dumps(har))
    from warcloom.operators.pages import har_links

    got = har_links(curation.read_har(spark, str(tmp_path / "h.har")).withColumn("parent", F.lit("http://x/")))
    assert sorted((r.url, r.hop) for r in got.collect()) == [("http://x/", ""), ("http://x/i.png", "E"), ("http://x/l", "L")]


METS = """<mets:mets xmlns:mets="http://www.loc.gov/METS/" xmlns:xlink="http://www.w3.org/1999/xlink" xmlns:premis="info:lc/xmlns/premis-v2">
<mets:amdSec ID="AMD1"><mets:digiprovMD><mets:mdWrap><mets:xmlData><premis:object><premis:objectIdentifier><premis:objectIdentifierValue>ark:/1/x1</premis:objectIdentifierValue></premis:objectIdentifier></premis:object></mets:xmlData></mets:mdWrap></mets:digiprovMD></mets:amdSec>
<mets:amdSec ID="AMD2"><mets:digiprovMD/></mets:amdSec>
<mets:fileSec><mets:fileGrp><mets:file ADMID="AMD1" MIMETYPE="application/warc" SIZE="7" CHECKSUM="ff" CHECKSUMTYPE="SHA-512"><mets:FLocat xlink:href="https://archive.example/resolve/20200102030405/http://d.example/x.pdf"/></mets:file></mets:fileGrp></mets:fileSec>
<mets:structMap><mets:div CONTENTIDS="ark:/1/top"/></mets:structMap></mets:mets>"""


def test_mets_and_ark_map(spark, tmp_path):
    (tmp_path / "m.xml").write_text(METS)
    row = packages.read_mets(spark, str(tmp_path / "m.xml")).first()
    assert (row.admid, row.ark, row.size, row.checksum, row.count_mismatch) == ("AMD1", "ark:/1/x1", 7, "ff", False)
    ark = packages.read_sip_ark_map(spark, str(tmp_path / "m.xml"), "https://archive.example/resolve/").first()
    assert tuple(ark) == ("ark:/1/top", "20200102030405", "http://d.example/x.pdf")


def test_manifests(spark):
    star = spark.createDataFrame([("ab12 */heritrix/output/viral/x y.warc.gz",)], "value string")
    row = packages.parse_hash_manifest(star, "star").first()
    assert (row.sha512, row.path, row.kind, row.length) == ("ab12", "/heritrix/output/viral/x y.warc.gz", "viral", None)


def test_listing_csv_with_repeated_header(spark, tmp_path):
    head = "permissions,number_of_replicas,userid,groupid,filesize,modified_at,filename"
    (tmp_path / "l.csv").write_text(f"{head}\n-rw-r--r--,3,u,g,12,2020-01-02T03:04:00,/a/b\n{head}\n-rw-r--r--,1,u,g,x,2020-01-02T03:04:00,/a/c\n")
    rows = listings.read_listing_csv(spark, str(tmp_path / "l.csv")).orderBy("filename").collect()
    assert [(r.filename, r.filesize) for r in rows] == [("/a/b", 12), ("/a/c", None)]


def test_lsr_skips_banner_and_folders(spark, tmp_path):
    (tmp_path / "l.txt").write_text("lsr: DEPRECATED: Please use 'ls -R' instead.\ndrwxr-xr-x   - u g 0 2020-01-02 03:04 /a\n-rw-r--r--   3 u g 12 2020-01-02 03:04 /a/b c\n")
    rows = listings.read_lsr(spark, str(tmp_path / "l.txt")).collect()
    assert [(r.filename, str(r.modified_at)) for r in rows] == [("/a/b c", "2020-01-02 03:04:00")]


def test_block_scan(spark, tmp_path):
    (tmp_path / "node1").write_text("Total Blocks : 10\nVerified in last hour : 50%\nCurrent scan rate KBps : 7\nno value here\n")
    got = {r.key: r.value for r in listings.read_block_scan(spark, str(tmp_path / "node1")).collect()}
    assert got == {"total_blocks_count": 10.0, "verified_in_last_hour_percent": 0.5, "current_scan_rate_kbps": 7.0}


def index_rows(spark):
    return cdx.parse_cdx11(spark.createDataFrame([
        (" CDX N b a m s k r M S V g",), ("com,a)/ 20200101000000 http://a.com/ text/html 200 D - - 5 0 f.warc.gz",),
        ("com,a)/ 20200101000001 http://a.com/ text/html - D - - - 7 f.warc.gz",)], "value string"))


def test_cdx_table_and_remote_sink(spark, tmp_path):
    rows = index_rows(spark)
    seen = cdx.write_cdx(rows, str(tmp_path / "cdx"), "b1", buckets=4)
    assert seen.get["total_sent_record_count"] == 2
    assert spark.read.parquet(str(tmp_path / "cdx")).filter("length IS NULL").count() == 1
    assert cdx.send_cdx(rows, lambda batch: True, batch=1) == 2
    with pytest.raises(Exception, match="refused"):
        cdx.send_cdx(rows, lambda batch: False)


def test_report_and_text_sinks(spark, tmp_path):
    df = spark.createDataFrame([("k", 1, "v")], "key string, n int, text string")
    sinks.write_tsv_json(df, ["key"], str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).first().value == 'k\t{"n":1,"text":"v"}'
    sinks.write_report_csv(df, str(tmp_path / "r"), ["key"])
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).first().n == "1"


def test_append_new_keeps_first(spark, tmp_path):
    rows = lambda *v: spark.createDataFrame(list(v), "k string, t int")
    path = str(tmp_path / "table")
    assert sinks.append_new(path, rows(("a", 2), ("a", 1), ("b", 5)), "k", [F.col("t")]) == 2
    assert sinks.append_new(path, rows(("a", 0), ("c", 1)), "k", [F.col("t")]) == 1
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 5), ("c", 1)]


def test_task_event_and_sanity(spark):
    runs = spark.sql("SELECT 'cdx' AS task, '2020-01-01' AS date, timestamp '2020-01-01 00:00:00' AS started, timestamp '2020-01-01 00:01:30' AS finished, 'success' AS status, map('op', 'x') AS params, map('n', 4L) AS metrics")
    event = tracking.task_events(runs).first()
    assert (event.id, event.runtime_secs, event.metrics) == ("task:cdx:2020-01-01:op=x", 90.0, {"n": 4})
    bad = spark.createDataFrame([(0, 1)], "n int, d int")
    with pytest.raises(RuntimeError, match="zero"):
        workflows.check_job(bad, "n")
    with pytest.raises(RuntimeError, match="above"):
        workflows.check_job(bad.withColumn("n", F.lit(3)), "n", "d")
    workflows.check_job(bad.withColumn("n", F.lit(3)), "n")
