"""Small tests of the third round's findings on time: what is costly is made once."""

from pyspark.sql import functions as F

from warcloom.functions import paths
from warcloom.operators import pages, recon
from warcloom.plans import frames as fx
from warcloom.plans import warc_queries, workflows
from warcloom.sources import listings


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _lineitem(spark, folder) -> str:
    spark.range(60).selectExpr(
        "id AS l_orderkey", "id * 7 AS l_partkey", "id AS l_suppkey", "CAST(id % 7 AS INT) AS l_linenumber", "CAST(id AS DOUBLE) AS l_extendedprice",
        "DATE '1996-01-01' AS l_shipdate").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_listing_lines_are_split_once(spark):
    lines = spark.createDataFrame([
        ("  -rw-r--r-- 3 u g 5 2020-01-01 00:00 /a b  c ",), ("lsr: DEPRECATED: Please use 'ls -R' instead.",), ("a b c",), (None,), ("",),
        ("\td 3 u g x 2020-01-01 noon /d",)], "value string")
    rows = listings.parse_lsr(lines)
    assert _plan(rows).count("split(") == 1
    got = {r.filename: (r.permissions, r.filesize, str(r.modified_at)) for r in rows.collect()}
    assert got == {"/a b  c": ("-rw-r--r--", 5, "2020-01-01 00:00:00"), "/d": ("d", None, "None")}


def test_texts_are_split_once_for_word_pairs(spark):
    docs = spark.createDataFrame([(1, "A b, a B!"), (1, "one"), (2, None), (2, ""), (2, "--x--y")], "m int, text string")
    single, double = pages.word_colocations(docs, F.col("m"))
    assert _plan(double).count("split(") == 1 and "zip_with" not in _plan(double)
    assert {tuple(r) for r in double.collect()} == {(1, "a", "b", 2), (1, "b", "a", 1), (2, "x", "y", 1)}
    assert {tuple(r) for r in single.collect()} == {(1, "a", 2), (1, "b", 2), (1, "one", 1), (2, "x", 1), (2, "y", 1)}


def test_reports_on_paths_read_no_facts_from_them(spark, tmp_path):
    sf = _lineitem(spark, tmp_path)
    files, stored = fx.files(spark, sf), fx.stored(spark, sf)
    reports, plain = workflows.daily_reports(files, stored), workflows.daily_reports(files)
    for name in ("duplicates", "empty"):
        counts = reports[name].agg(F.count("*").alias("n"))
        assert "_facts" not in _plan(counts) and counts.first().n == plain[name].count()
    assert sorted(r.file_path for r in stored.collect()) == sorted(r.file_path for r in files.collect())


def test_outside_manifest_query_reads_no_facts(spark, tmp_path):
    from warcloom.plans.catalogue import QUERIES

    sf = _lineitem(spark, tmp_path)
    rows = QUERIES["so_5_outside_manifest"](spark, sf)
    f = fx.files(spark, sf).select(F.col("file_path").alias("path"), "file_size")
    assert "_facts" not in _plan(rows)
    assert sorted(r.path for r in rows.collect()) == sorted(r.path for r in recon.outside_manifest(f.select("path"), f.filter("file_size % 2 = 0")).collect())


def test_each_path_rule_is_named_once(spark):
    given = ["/data/1/2/WARCS/a|b.warc.gz", "/data/|/x", "/user|x/y", "", "/", "/heritrix/output/dc2x/202401011200/warcs/y", "/heritrix/output/frequent-x/z", "/_to_be_deleted/q", None]
    facts = spark.createDataFrame([(i, p) for i, p in enumerate(given)], "i int, p string").select("i", paths.path_facts(F.col("p")).alias("f"))
    plan = _plan(facts)
    assert plan.count("RLIKE(") == len(paths.LAYOUT_RULES) + len(paths.ROOT_RULES) and "translate(" not in plan
    none = ["", "", "", "", "unknown", "false"]  # what follows the first folder
    assert [r.f for r in facts.orderBy("i").collect()] == [
        ["selective", "selective", "1", "2", "wct", "WARCS", "true"], ["data", "selective", "", "", "wct", "unknown", "false"], ["user\x1fx", *none],
        ["", *none], ["", *none], ["npld", "domain", "dc2x", "202401011200", "npld-2018", "warcs", "true"],
        ["heritrix", "", "", "", "npld-2018", "unknown", "false"], ["", "", "", "", "", "to-be-deleted", "true"], ["", *none]]


def test_warc_ranges_grow_with_the_files(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    for total in (1000, 10**6, 10**9, 10**12):
        monkeypatch.setattr(warc_queries.warc, "listed", lambda path, total=total: [("a.warc.gz", total // 2), ("b.warc.gz", total - total // 2)])
        size = warc_queries.range_bytes(spark, "x")
        assert 40_000 <= size <= 128 << 20
        assert total // size <= max(4 * cores + 2, total // (128 << 20)) or size == 40_000
    monkeypatch.setattr(warc_queries.warc, "listed", lambda path: [("a.warc.gz", 10**9)])
    assert 10**9 // warc_queries.range_bytes(spark, "x") <= 4 * cores + 1
