"""Plan shapes that must hold whatever the data size."""

import os

import pytest
from pyspark.sql import functions as F

from warcloom.plans import catalogue, frames

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k in catalogue.QUERIES if not k.startswith("sr_")))
def test_no_all_pairs_joins_and_no_row_python(spark, key):
    plan = plan_of(catalogue.QUERIES[key](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, f"{key}: {bad}"


@pytest.mark.parametrize("key", ["wn_1_first_n_per_host", "wn_5_sample_per_class"])
def test_rank_limits_apply_before_the_exchange(spark, key):
    assert "WindowGroupLimit" in plan_of(catalogue.QUERIES[key](spark, SF))


def test_spot_checks_are_limited_before_the_exchange(spark):
    from warcloom.operators import captures
    from warcloom.plans import capture_queries as q

    assert "WindowGroupLimit" in plan_of(captures.spot_checks(q.records(spark, SF)))


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(frames.crawl_log(spark, SF).groupBy("status_code").count())
    assert "html" not in plan and "props" not in plan


def test_filter_reaches_the_scan(spark):
    plan = plan_of(frames.table(spark, SF, "lineitem").filter("l_partkey = 5").select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_partkey), EqualTo(l_partkey,5)]" in plan


def test_index_look_ups_read_wanted_buckets_and_keys(spark):
    from warcloom.operators import captures
    from warcloom.plans import capture_queries as q

    index = q.cdx_table(spark, SF)
    docs = spark.createDataFrame([("http://nowhere.example/x", "20240101000000")], "document_url string, wayback_timestamp string")
    found = [captures.captures(index, q._a_url(spark, SF), buckets=16), captures.available_in_index(docs, index, buckets=16)]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    scans = [plan_of(df) for df in found]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for scan in scans:
        assert "bucket" in scan.split("PartitionFilters: [")[1].split("]")[0]
        assert "GreaterThanOrEqual(urlkey," in scan and "LessThan(urlkey," in scan


def test_pruned_look_up_finds_every_form_of_key(spark, tmp_path):
    from warcloom.functions.urls import surt_canonical
    from warcloom.sources import cdx

    urls = ["http://a.example/x", "http://a.example/", "https://a.example:8443/x?b=2&a=1", "screenshot:http://a.example/x", "dns:a.example", "http://b.a.example/", "http://a.example.org/", "http://%41.example/", "urn:x"]
    fields = {f: F.lit("-") for f in cdx.CDX_FIELDS}
    rows = spark.createDataFrame([(u,) for u in urls], "original string").withColumns({**fields, "original": F.col("original"), "urlkey": surt_canonical(F.col("original"))})
    posted = rows.filter("original LIKE 'http%'").withColumn("urlkey", F.concat("urlkey", F.lit("?__wb_method=post&x=1")))
    cdx.write_cdx(rows.unionByName(posted), str(tmp_path / "i"), "b", 8)
    index = spark.read.parquet(str(tmp_path / "i"))
    for wanted in [[u] for u in urls] + [urls[:3], urls]:
        got = cdx.lookup_cdx(index, spark.createDataFrame([(u,) for u in wanted], "original string"), 8)
        assert sorted(r.original for r in got.collect()) == sorted(wanted + [u for u in wanted if u.startswith("http")])
    assert cdx.lookup_cdx(index, spark.createDataFrame([], "original string"), 8).count() == 0
