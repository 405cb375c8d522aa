"""Hand-written expectations for parsing and classification quirks."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from warcloom.functions import cdx as X
from warcloom.functions import curation as C
from warcloom.functions import formats, paths
from warcloom.functions import logs as L
from warcloom.functions import urls as U
from warcloom.operators import logs as log_ops
from warcloom.sources import crawl_logs


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("path, want", [
    ("/data/1234/5678/WARCS/a.warc.gz", ("selective", "selective", "1234", "5678", "wct", "warcs", True)),
    ("/data/1234/5678/WARCS/a.warc.cdx", ("selective", "selective", "1234", "5678", "wct", "cdx", True)),
    ("/data/1234/5678/readme", ("selective", "selective", "1234", "5678", "wct", "unknown", True)),
    ("/data/1234/5678/Logs/crawl.log", ("selective", "selective", "1234", "5678", "wct", "crawl-logs", True)),
    ("/data/1234/x/readme", ("data", "selective", None, None, "wct", "unknown", False)),
    ("/heritrix/output/warcs/dc0-20150827/XX.warc.gz", ("npld", "domain", "dc2015", "20150827", "npld-2013", "warcs", True)),
    ("/heritrix/output/viral/crawl3-20150827101112/x.warc.gz", ("npld", "domain", "dc2015", "20150827", "npld-2013", "viral", True)),
    ("/heritrix/output/logs/weekly/20140207041736/crawl.log.gz", ("npld", "frequent", "weekly", "20140207041736", "npld-2013", "crawl-logs", True)),
    ("/heritrix/output/frequent-bypm/20201215145330/warcs/x.warc.gz", ("bypm", "frequent", "frequent-bypm", "20201215145330", "npld-2018", "warcs", True)),
    ("/heritrix/output/dc2019/20190714151618/viral/x.warc.gz.open", ("npld", "domain", "dc2019", "20190714151618", "npld-2018", "viral", True)),
    ("/heritrix/output/frequent-npld/odd/x", ("heritrix", None, None, None, "npld-2018", "unknown", False)),
    ("/1_data/npld/domain/j_1/warcs/y.warc.gz.open", ("npld", "domain", "j_1", None, "npld-2018-project", "warcs-invalid", True)),
    ("/_to_be_deleted/z", (None, None, None, None, None, "to-be-deleted", True)),
    ("/heritrix/output/warcs/odd", ("heritrix", None, None, None, "npld-2013", "unknown", False)),
    ("/user/a/b", ("user", None, None, None, None, "unknown", False)),
])
def test_classify_path(spark, path, want):
    r = one(spark, path, paths.classify_path)
    assert (r.collection, r.stream, r.job, r.launch, r.layout, r.kind, r.recognised) == want


def test_file_ext_from_first_dot(spark):
    assert one(spark, "/a/b.c/x.warc.gz", paths.file_ext) == ".warc.gz"
    assert one(spark, "/a/b.c/readme", paths.file_ext) is None


@pytest.mark.parametrize("octal, folder, want", [("750", True, "drwxr-x---"), ("644", False, "-rw-r--r--"), ("-rwxrwxrwx", False, "-rwxrwxrwx")])
def test_permissions(spark, octal, folder, want):
    assert one(spark, octal, lambda v: paths.permissions_to_string(v, F.lit(folder))) == want


def test_month_prefix(spark):
    assert one(spark, "/x/a-20170102030405-b.warc.gz", paths.month_prefix) == "2017-01"
    assert one(spark, "/x/a-20170102030405678-b.warc.gz", paths.month_prefix) == "2017-01"
    assert one(spark, "/x/20170102030405", paths.month_prefix) == "none"


@pytest.mark.parametrize("url, want", [
    ("http://archive.org/goo/", "org,archive)/goo"),
    ("http://archive.org/goo/?b&a", "org,archive)/goo?a&b"),
    ("http://www.archive.org/goo/?a=2&b&a=1", "org,archive)/goo?a=1&a=2&b"),
    ("http://www2.Example.CO.UK:80/A/B?x=1#frag", "uk,co,example)/a/b?x=1"),
    ("https://user:pw@example.com:443/", "com,example)/"),
    ("http://example.com:8080", "com,example:8080)/"),
    ("http://example.com/?", "com,example)/"),
    ("http://example.com/?a1=x&a=y", "com,example)/?a=y&a1=x"),
    ("dns:Example.com", "dns:example.com"),
    ("-", "-"),
])
def test_surt_canonical(spark, url, want):
    assert one(spark, url, U.surt_canonical) == want


@pytest.mark.parametrize("url, want", [
    ("http://www.example.com/a/b/c.html", "http://(com,example,www,/a/b"),
    ("http://example.com/", "http://(com,example,/"),
    ("http://example.com", "http://(com,example,"),
    ("http://example.com:8080/a/", "http://(com:8080,example,/a"),
])
def test_surt_simple(spark, url, want):
    assert one(spark, url, U.surt_simple) == want


def test_acl_surt(spark):
    assert one(spark, "http://www.example.com/", U.acl_surt) == "http://(com,example,"
    assert one(spark, "http://example.com/a", U.acl_surt) == "http://(com,example)/a"
    for accepted in ("http://example.com/a b", "http://example.com/it's", "http://example.com/a#b"):
        assert one(spark, accepted, U.acl_surt) is not None
    for refused in "()[]!*":
        assert one(spark, f"http://example.com/a{refused}b", U.acl_surt) is None


@pytest.mark.parametrize("base", ["http://a.example/b/c/d?q=1", "https://a.example", "http://a.example/x/"])
@pytest.mark.parametrize("location", ["http://o.example/z", "//o.example/z", "/r/s?t", "s", "../s", "./s?u=1", "../../../s", "?n=2", "x/../y/", ".."])
def test_resolve_redirect_like_urljoin(spark, base, location):
    got = spark.createDataFrame([(base, location)], "b string, l string").select(U.resolve_redirect(F.col("b"), F.col("l")).alias("r")).first().r
    assert got == urljoin(base, location)


def test_host_forms(spark):
    assert one(spark, "dns:a.example", U.url_host) == "a.example"
    assert one(spark, "http://A_b.Example:81/x", U.url_host) == "a_b.example"
    assert one(spark, "not a url", U.url_host) is None
    assert one(spark, "http://www3.example.co.uk:81/x", U.url_netloc_nowww) == "example.co.uk:81"
    assert one(spark, "a.gov.uk", U.second_level) == "gov"
    assert one(spark, "gov.uk", U.second_level) is None
    assert one(spark, "x.y.co.uk", U.registered_domain) == "y.co.uk"
    assert one(spark, "x.y.com", U.registered_domain) == "y.com"


def test_seed_variants(spark):
    assert one(spark, "http://a.example#x", U.seed_variants) == ["http://a.example#x", "http://a.example", "http://a.example#x/"]


@pytest.mark.parametrize("size, want", [
    (0, "0.0 Byte"), (999, "999.0 Byte"), (1605000, "1.60 MB"), (125, "125.0 Byte"), (1234, "1.23 KB"), (10**12, "1.00 TB"), (1125, "1.12 KB"),
])
def test_humanbytes_rounds_like_the_binary_value(spark, size, want):
    assert spark.range(1).select(formats.humanbytes(F.lit(size)).alias("r")).first().r == want


def test_cdx_rules(spark):
    for status, ok in (("-", True), ("200", True), ("599", True), ("600", False), ("-5", False), ("abc", False)):
        assert one(spark, status, X.cdx_status_ok) is ok
    assert one(spark, "screenshot:http://H.example/x", lambda v: X.cdx_host_key(v, F.lit("k"))) == "screenshot-http-h.example"
    assert one(spark, "http://h.example/", lambda v: X.cdx_host_key(v, F.lit("example,h)/x"))) == "example,h"


@pytest.mark.parametrize("frequency, start, now, due", [
    ("DAILY", "2024-01-01 03:00:00", "2024-02-05 03:30:00", True),
    ("DAILY", "2024-01-01 03:00:00", "2024-02-05 04:30:00", False),
    ("WEEKLY", "2024-01-01 03:00:00", "2024-02-05 03:00:00", True),
    ("WEEKLY", "2024-01-02 03:00:00", "2024-02-05 03:00:00", False),
    ("QUARTERLY", "2024-01-05 03:00:00", "2024-04-05 03:00:00", True),
    ("SIXMONTHLY", "2024-01-05 03:00:00", "2024-04-05 03:00:00", False),
    ("ANNUAL", "2023-04-05 03:00:00", "2024-04-05 03:00:00", True),
    ("DOMAINCRAWL", "2023-04-05 03:00:00", "2024-04-05 03:00:00", False),
    ("DAILY", None, "2024-02-05 03:00:00", False),
])
def test_schedules(spark, frequency, start, now, due):
    row = spark.createDataFrame([((start, None, frequency),)], "s struct<startDate:string,endDate:string,frequency:string>")
    assert row.select(C.schedule_is_due(F.col("s"), F.lit(now).cast("timestamp")).alias("r")).first().r is due


LINES = [
    "2017-06-08T14:00:00.000Z 200 100 http://a.example/x.pdf L http://a.example/ application/pdf #1 20170608140000000+1 sha1:A tid:1:http://a.example/ ip:1.2.3.4,3t,3t,launchTimestamp:20170608 {}",
    "2017-06-08T14:00:01.000Z   404     -  http://b.example/robots.txt - - text/html #1 20170608140001000+1 sha1:B - - {\"warcFilename\":\"w.warc.gz\"}",
    "2017-06-08T14:00:02.000Z -5 - http://c.example/ L http://a.example/ unknown #1 20170608140002000+1 - - -",
    "2017-06-08T14:00:03.000Z 404 10 http://d.example/ - - text/html #1 20170608140003000+1 - - -",
    "2017-06-08T14:00:04.000Z 200 10 http://d.example/ L http://a.example/ text/html #1 20170608140004000+1 - - -",
    "2017-06-08T14:00:05.000Z 1 10 dns:d.example P http://a.example/ text/dns #1 20170608140005000+1 - - -",
    "  2017-06-08T14:00:06.000Z 404 10 http://e.example/ text/html #1 20170608140006000+1 - - -",
    "only eleven fields a b c d e f g h",
]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


def test_strict_parser(lines):
    rows = {r.url: r for r in crawl_logs.parse_crawl_log(lines).collect()}
    assert len(rows) == 5 and len(crawl_logs.rejected_lines(lines).collect()) == 2
    assert rows["http://a.example/x.pdf"].annotations == ["ip:1.2.3.4", "3t", "3t", "launchTimestamp:20170608"]
    assert rows["http://a.example/x.pdf"].extra_json is None
    assert rows["http://b.example/robots.txt"].extra_json == '{"warcFilename":"w.warc.gz"}'
    assert rows["http://b.example/robots.txt"].annotation_string == "-"


def test_lenient_parser_fills_short_seed_lines(lines):
    rows = {r.url: r for r in crawl_logs.parse_crawl_log_lenient(lines).collect()}
    short = rows["http://e.example/"]
    assert (short.hop_path, short.via, short.mime, short.source) == ("-", "-", "text/html", "-")
    assert [r.n_fields for r in crawl_logs.rejected_lines(lines, lenient=True).collect()] == [11]


def test_line_stats_count_each_annotation_once(lines):
    log = crawl_logs.parse_crawl_log(lines)
    totals = {(r.host, r.property): r.amount for r in log_ops.summarise_logs(log).collect()}
    assert totals["a.example", "tries:3t"] == 1
    assert totals["a.example", "sum:content_length"] == 100
    assert totals["b.example", "sum:content_length:-"] == 1
    assert totals["a.example", "hop:L"] == 1
    assert not any("launchTimestamp" in p for _, p in totals)


def test_dead_seeds_and_states(lines):
    log = crawl_logs.parse_crawl_log_lenient(lines)
    assert {r.url for r in log_ops.dead_seeds(log).collect()} == {"http://b.example/robots.txt", "http://e.example/"}
    states = {r.host: r.url_state for r in log_ops.summarise_hosts(log).collect()}
    assert states == {"a.example": "Live", "b.example": "Has Dead Seeds", "d.example": "Has Dead Seeds", "e.example": "Has Dead Seeds"}
    assert {r.status_code: r.n for r in log_ops.count_status_codes(log).collect()} == {"200": 2, "404": 3, "-5": 1, "1": 1}


def test_annotation_virus(spark):
    got = spark.createDataFrame([(["ip:1.1.1.1", "1: stream: Eicar-Test FOUND"],)], "a array<string>").select(L.annotation_virus(F.col("a")).alias("r")).first().r
    assert got == "Eicar-Test"


def test_annotation_that_spells_a_fixed_key_replaces_it(spark):
    row = spark.createDataFrame([("200", "text/html", "L", "5", ["lines", "hop"])], "status_code string, mime string, hop_path string, content_length string, annotations array<string>")
    facts = {f.key: f.value for f in row.select(L.line_stats().alias("f")).first().f}
    assert facts["hop"] == "" and facts["lines"] == "" and facts["status_code"] == "200"


def test_path_with_bar_or_without_folders(spark):
    from warcloom.functions.paths import classify_path

    rows = spark.createDataFrame([("/a|b/c",), ("name",), ("",), ("/x/y.warc.gz",)], "path string").select(classify_path(F.col("path")).alias("f"))
    got = [r.f for r in rows.collect()]
    assert [(g.collection, g.stream, g.recognised) for g in got] == [("a|b", None, False), (None, None, False), (None, None, False), ("x", None, False)]


@pytest.mark.parametrize(("url", "want"), [
    ("http://e.com/a/../b/./c//d/..", "com,e)/b/c"), ("http://e.com/../..", "com,e)/"), ("http://e.com/a%2520b", "com,e)/a%20b"),
    ("http://e.com/a%25252Fb", "com,e)/a/b"), ("http://e.com/%zz%", "com,e)/%25zz%25"), ("http://e.com/%C3%A9 x", "com,e)/%c3%a9%20x"),
    ("http://e.com/\u00e9\U0001f600", "com,e)/%c3%a9%f0%9f%98%80"), ("http://e.com/x;jsessionid=" + "aB" * 16 + "?q=1", "com,e)/x?q=1"),
    ("http://e.com/x?b=2&sid=" + "0a" * 16 + "&a=%31", "com,e)/x?a=1&b=2"), ("http://e.com/x?sid=short&a=1", "com,e)/x?a=1&sid=short"),
    ("http://e.com/x?CFID=1&CFTOKEN=2", "com,e)/x"), ("http://e.com/(" + "a" * 24 + ")/p.aspx", "com,e)/p.aspx"), ("http://e.com/?q=a%2Bb+c", "com,e)/?q=a+b+c"),
])
def test_odd_urls_have_one_key(spark, url, want):
    assert one(spark, url, U.surt_canonical) == want


def test_registered_domains_by_suffix_rules(spark):
    hosts = {"www.example.com.au": "example.com.au", "com.au": None, "a.b.c.ck": "b.c.ck", "foo.ck": None, "www.ck": "www.ck", "x.www.ck": "www.ck", "example.com": "example.com",
             "x.unknown": "x.unknown", "localhost": None, None: None, "A.CO.UK.": "a.co.uk", "1.2.3.4": None}
    rules = U.suffix_rules(spark.createDataFrame([(x,) for x in ["com", "au", "com.au", "*.ck", "!www.ck", "uk", "co.uk note", "// x", ""]], "value string"))
    rows = U.with_registered_domain(spark.createDataFrame([(h,) for h in hosts] * 2, "host string"), rules).collect()
    assert len(rows) == 2 * len(hosts) and {r.host: r.domain for r in rows} == hosts
