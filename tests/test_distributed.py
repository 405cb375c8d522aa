"""Operators with their own distribution logic against brute force, with one
key holding a large share of the rows."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from warcloom.operators import captures, harvest, ordering, packaging, pages, tracking
from warcloom.session import ensure_checkpoint_dir


def test_checkpoint_dir_comes_from_the_session(spark):
    assert spark.conf.get("spark.checkpoint.dir") in ensure_checkpoint_dir(spark)


def test_with_ordinal_is_dense_and_ordered(spark):
    values = list(range(5000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    rows = ordering.with_ordinal(df, [F.col("v")], start=0).collect()
    assert sorted((r.ordinal, r.v) for r in rows) == [(i, i) for i in range(5000)]


def test_asof_forward_with_hot_key(spark):
    rnd = random.Random(2)
    start = datetime(2024, 1, 1)
    def when():
        return start + timedelta(seconds=rnd.randrange(20 * 86400))
    keys = ["hot"] * 10 + ["a", "b", "c"]
    left = [(i, rnd.choice(keys), when()) for i in range(800)]
    right = [(rnd.choice(keys), when()) for _ in range(300)]
    right.append(("hot", left[0][2]))
    got = ordering.asof_forward(
        spark.createDataFrame(left, "i int, k string, t timestamp"), spark.createDataFrame(right, "k string, c timestamp"),
        "k", "t", F.struct("c"), "hit", bucket_seconds=3600).collect()
    assert len(got) == len(left)
    for r in got:
        want = min((c for k, c in right if k == r.k and c >= r.t), default=None)
        assert (r.hit.c if r.hit else None) == want


def test_prefix_roots_keep_only_uncovered(spark):
    p = ["com,a)/", "com,a)/x", "com,a)/x/y", "com,b)/x", "com,b)/xy", "com,c)/q?a", "com,c)/q"]
    got = {r.prefix for r in harvest.prefix_roots(spark.createDataFrame([(x,) for x in p], "prefix string")).collect()}
    assert got == {"com,a)/", "com,b)/x", "com,c)/q"}


def test_watched_join_gives_each_line_once(spark):
    targets = spark.createDataFrame(
        [(1, True, ["http://a.example/", "http://a.example/x"]), (2, True, ["http://b.example/deep"]), (3, False, ["http://c.example/"])],
        "id long, watched boolean, seeds array<string>")
    urls = [("http://a.example/x/1", "http://a.example/x"), ("http://b.example/deeper", "-"), ("http://b.example/", "http://a.example/"), ("http://c.example/", "http://c.example/")]
    log = spark.createDataFrame(urls, "url string, via string")
    assert sorted(r.url for r in harvest.watched_prefix_join(log, targets).collect()) == ["http://a.example/x/1", "http://b.example/", "http://b.example/deeper"]
    assert [r.url for r in harvest.watched_prefix_join(log, targets, both=True).collect()] == ["http://a.example/x/1"]


def test_resolve_target_rules(spark):
    targets = spark.createDataFrame(
        [(5, True, "Health Board", ["http://www.gov.uk/h"]), (6, True, "Ministry of Tests", ["http://www.gov.uk/m"]), (7, True, "Lone", ["http://lone.example/"])],
        "id long, watched boolean, title string, seeds array<string>")
    docs = spark.createDataFrame(
        [("d1", "http://www.gov.uk/x", ["ministry of tests"]), ("d2", "http://www.gov.uk/x", ["", "Nobody"]), ("d3", "http://sub.lone.example/x", []), ("d4", "http://other.example/", ["Lone"])],
        "document_url string, landing_page_url string, publishers array<string>")
    got = {r.document_url: r.target_id for r in harvest.resolve_target(docs, targets).collect()}
    assert got == {"d1": 6, "d2": None, "d3": 7, "d4": None}


def test_follow_redirects_ends_on_cycles(spark):
    hops = spark.createDataFrame([("http://x/a", "/b"), ("http://x/b", "/c"), ("http://x/c", "http://x/a"), ("http://x/d", "http://x/a")], "url string, location string")
    got = {(r.start, r.url) for r in captures.follow_redirects(spark.createDataFrame([("http://x/d",), ("http://x/a",)], "url string"), hops).collect()}
    ring = {"http://x/a", "http://x/b", "http://x/c"}
    assert got == {("http://x/d", u) for u in ring} | {("http://x/a", u) for u in ring}


def brute_routes(docs, links, seeds, max_hops=3, widest=20):
    refs = {}
    for u, r in links:
        refs.setdefault(u, set()).add(r)
    def walk(path, limit):
        if len(path) > limit:
            return
        found = [r for r in refs.get(path[-1], ()) if r not in path]
        at_seed = sorted(r for r in found if r in seeds)
        if at_seed:
            yield path + [at_seed[0]]
            return
        for r in found:
            yield from walk(path + [r], limit)
    out = {}
    for d in docs:
        for limit in range(max_hops, widest + 1):
            routes = list(walk([d], limit))
            if routes:
                short = min(map(len, routes))
                best = {}
                for route in sorted(r for r in routes if len(r) == short):
                    best.setdefault(route[-1], route)
                counts = {}
                for r in routes:
                    counts[r[1]] = counts.get(r[1], 0) + 1
                landing = max(counts, key=lambda k: (counts[k], k))
                for seed, route in best.items():
                    out[d, seed] = (landing, route)
                break
    return out


def test_trace_routes_like_brute_force(spark):
    rnd = random.Random(3)
    nodes = [f"n{i}" for i in range(40)]
    links = {(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(70)} | {(f"n{i}", f"n{i + 1}") for i in range(20, 28)}
    links = {(a, b) for a, b in links if a != b}
    seeds = set(nodes[::9])
    docs = [n for n in nodes if n not in seeds]
    got = harvest.trace_routes(
        spark.createDataFrame([(d,) for d in docs], "url string"), spark.createDataFrame(list(links), "url string, referrer string"),
        spark.createDataFrame([(s,) for s in seeds], "url string")).collect()
    assert {(r.document, r.seed): (r.landing_page, r.route) for r in got} == brute_routes(docs, links, seeds)


def test_trace_routes_over_a_grid_of_links(spark):
    """Sixteen levels of three pages, each linked with all of the next: 3 ** 15 routes."""
    links = [(f"l{i:02d}-{a}", f"l{i + 1:02d}-{b}") for i in range(16) for a in range(3) for b in range(3) if (i, a, b) != (0, 0, 2)]
    seeds = [f"l16-{b}" for b in range(3)]
    frame = lambda rows, names: spark.createDataFrame(rows, names)
    got = harvest.trace_routes(frame([("l00-0",), ("l03-1",)], "url string"), frame(links, "url string, referrer string"), frame([(s,) for s in seeds], "url string")).collect()
    assert {(r.document, r.seed): (r.landing_page, r.route) for r in got} == {
        ("l00-0", "l16-0"): ("l01-1", ["l00-0"] + [f"l{i:02d}-0" for i in range(1, 17)]),
        ("l03-1", "l16-0"): ("l04-2", ["l03-1"] + [f"l{i:02d}-0" for i in range(4, 17)])}


def test_trace_routes_beyond_twenty_hops(spark):
    links = [(f"n{i}", f"n{i + 1}") for i in range(23)] + [("x", "y")]
    docs = spark.createDataFrame([("n0",), ("x",)], "url string")
    routes = harvest.trace_routes(
        docs, spark.createDataFrame(links, "url string, referrer string"), spark.createDataFrame([("n23",)], "url string"))
    assert [(r.document, r.seed, len(r.route)) for r in routes.collect()] == [("n0", "n23", 24)]
    assert [tuple(r) for r in harvest.unreached(docs, routes).collect()] == [("x", "NO SEED")]


def test_apply_updates_order_and_new_records(spark):
    base = spark.createDataFrame([("a", "old", ["x"], 1), ("b", "old", None, None)], "id string, s string, tags array<string>, n long")
    u = [("a", "s", "set", "1", 1), ("a", "s", "set", "", 2), ("a", "tags", "add-distinct", "y", 1), ("a", "tags", "remove", "x", 2), ("a", "tags", "add-distinct", "y", 3),
         ("b", "n", "inc", "2", 1), ("b", "n", "inc", "3", 2), ("b", "tags", "add-distinct", "q", 1), ("b", "tags", "remove", "q", 2), ("c", "s", "set", "new", 1), ("a", "_version_", "set", "9", 1),
         ("c", "tags", "add-distinct", "k", 1), ("c", "tags", "set", "z", 2)]
    got = {r.id: (r.s, r.tags, r.n) for r in tracking.apply_updates(base, spark.createDataFrame(u, "id string, field string, action string, value string, seq int")).collect()}
    assert got == {"a": (None, ["y"], 1), "b": ("old", None, 5), "c": ("new", ["z"], None)}


def test_import_records_refuses_bad_ids(spark):
    rows = spark.createDataFrame([("hdfs://x/a",), ("/x/a",), (None,)], "id string")
    got = [r.import_error for r in tracking.import_records(rows, "warcs").orderBy(F.desc("id")).collect()]
    assert got == [None, "id is not a store id", "id missing"]
    docs = tracking.import_records(spark.createDataFrame([("http://d",)], "document_url string"), "documents").first()
    assert docs.id == "document:document_url:http://d" and docs.kind_s == "documents"
    assert tracking.accepted(tracking.import_records(rows, "other")).count() == 0


def test_incremental_packages_put_final_last(spark):
    s = spark.createDataFrame([("j", "l", "20200102000000"), ("j", "l", "final"), ("j", "l", "20200101000000"), ("j", "l", "final"), ("k", "l", "final")], "job string, launch string, stage string")
    got = {(r.job, r.stage): (r.first_version, r.last_version) for r in packaging.incremental_packages(s).collect()}
    assert got == {("j", "20200101000000"): (1, 3), ("j", "20200102000000"): (2, 3), ("j", "final"): (3, 3), ("k", "final"): (1, 1)}


def test_package_versions_hold_what_a_running_merge_holds(spark):
    rnd = random.Random(5)
    stages = [f"2020010{i}000000" for i in range(1, 6)] + ["final"]
    items = [(rnd.choice("jk"), "l", rnd.choice(stages), "f", rnd.choice(["a", "b", None]), str(rnd.randrange(100))) for _ in range(60)]
    scalars = [(rnd.choice("jk"), "l", s, "s", rnd.choice(["", None, str(rnd.randrange(9))])) for s in stages for _ in range(2)]
    entries, last = packaging.package_merge(
        spark.createDataFrame(items, "job string, launch string, stage string, field string, key string, value string"),
        spark.createDataFrame(scalars, "job string, launch string, stage string, field string, value string"))
    assert entries.count() <= len(items) and last.count() <= len(scalars)
    for job in "jk":
        own = [s for s in stages if any(r[0] == job and r[2] == s for r in [*items, *scalars])]
        for version in range(1, len(own) + 1):
            mapped, listed, scalar = {}, [], None
            for stage in own[:version]:
                here = [r for r in items if r[0] == job and r[2] == stage]
                listed += [r[5] for r in here if r[4] is None]
                for key in {r[4] for r in here if r[4]}:
                    mapped[key] = max(r[5] for r in here if r[4] == key)
                scalar = max((r[4] for r in scalars if r[0] == job and r[2] == stage and r[4]), default=scalar)
            got = packaging.holding(entries, version).filter(F.col("job") == job).collect()
            assert sorted(r.value for r in got if r.key is None) == sorted(listed)
            assert {r.key: r.value for r in got if r.key} == mapped and sum(r.key is not None for r in got) == len(mapped)
            assert [r.value for r in packaging.holding(last, version).filter(F.col("job") == job).collect()] == ([scalar] if scalar else [])


HTML = """<html><head><title> T </title></head><body><h1>Main</h1><div><a href="/first.pdf">first</a></div>
<h3>Papers</h3><p><a href="x/second.pdf">second</a></p></body></html>"""


def test_landing_page_titles(spark):
    p = spark.createDataFrame(
        [("http://s.example/a/", HTML), ("http://s.example/b/", "<body><p><a href='http://s.example/q.pdf'>Just text</a></p><h2>Later</h2></body>"),
         ("http://s.example/c/", "<body><title>Only title</title></body>"), ("http://s.example/d/", "<body><a href='/z.pdf'>Plain <b>link</b></a></body>")],
        "url string, html string")
    d = spark.createDataFrame(
        [("http://s.example/first.pdf", "http://s.example/a/"), ("http://s.example/a/x/second.pdf", "http://s.example/a/"), ("http://s.example/none.pdf", "http://s.example/a/"),
         ("http://s.example/q.pdf", "http://s.example/b/"), ("http://s.example/none.pdf", "http://s.example/c/"), ("http://s.example/z.pdf", "http://s.example/d/")],
        "document_url string, landing_page_url string")
    got = {(r.document_url[17:], r.landing_page_url[-2]): r.title for r in pages.landing_page_title(p, d).collect()}
    assert got == {("first.pdf", "a"): "Main", ("a/x/second.pdf", "a"): "Papers", ("none.pdf", "a"): "Main", ("q.pdf", "b"): "Later", ("none.pdf", "c"): "Only title", ("z.pdf", "d"): "Plain link"}


def test_open_urls_follow_prefixes(spark):
    surts = spark.createDataFrame([("http://(com,example,",), ("http://(com,blogger)/img/",)], "surt string")
    urls = ["http://www.example.com/x", "http://sub.example.com/", "http://examples.com/", "http://blogger.com/img/a", "http://blogger.com/other"]
    got = {r.url for r in pages.open_urls(spark.createDataFrame([(u,) for u in urls], "url string"), surts).collect()}
    assert got == {urls[0], urls[1], urls[3]}


def test_search_documents_text(spark):
    recs = spark.createDataFrame([("http://e.example/", "<p>Hi</p><script>x<1</script><!-- no --> there")], "url string, html string")
    notes = spark.createDataFrame([("http://e.example/", "C|D")], "url string, collection string")
    row = pages.search_documents(recs, notes, spark.createDataFrame([("http://(example,e,",)], "surt string")).first()
    assert (row.text, row.collection, row.open_access) == ("Hi there", "C|D", True)


def test_trace_captures_like_a_plain_walk(spark):
    """The capture nearest to the wanted time decides where a URL leads; cycles and missing records end a chain."""
    from urllib.parse import urljoin

    rnd = random.Random(11)
    urls = [f"http://x/{i}" for i in range(12)]
    rows = [(rnd.choice(urls), f"202401{rnd.randrange(1, 29):02d}000000", "w", i, rnd.choice([200, 301, 302, 404]), rnd.choice([f"/{rnd.randrange(14)}", None])) for i in range(40)]
    records = {(f, o): (s, loc) for _, _, f, o, s, loc in rows if o % 9}
    starts = [(rnd.choice(urls), datetime(2024, 1, rnd.randrange(1, 29))) for _ in range(8)]
    want = set()
    for start, at in set(starts):
        url, hop, seen = start, 0, set()
        while url and url not in seen:
            seen.add(url)
            held = sorted((t, f, o) for u, t, f, o, _, _ in rows if u == url)
            hit = next((h for h in held if h[0] >= at.strftime("%Y%m%d%H%M%S")), held[-1] if held else None)
            status, location = records.get((hit[1], hit[2]), (None, None)) if hit else (None, None)
            want.add((start, at, hop, url, hit[0] if hit else None, hit[2] if hit else None, status))
            url = urljoin(url, location) if status in (301, 302) and location else None
            hop += 1
    cdx = spark.createDataFrame([r[:4] for r in rows], "original string, timestamp string, filename string, offset long")
    frame = spark.createDataFrame([(f, o, s, loc) for (f, o), (s, loc) in records.items()], "filename string, offset long, http_status int, location string")
    got = set()
    for start, at in set(starts):
        one = captures.trace_captures(spark.createDataFrame([(start, at)], "url string, target_ts timestamp"), cdx, frame)
        got |= {(r.start, at, r.hop, r.url, r.timestamp, r.offset, r.http_status) for r in one.collect()}
        break
    assert got == {w for w in want if (w[0], w[1]) == (start, at)}
    first = {s: t for s, t in reversed(starts)}
    many = captures.trace_captures(spark.createDataFrame(list(first.items()), "url string, target_ts timestamp"), cdx, frame)
    assert {(r.start, first[r.start], r.hop, r.url, r.timestamp, r.offset, r.http_status) for r in many.collect()} == {w for w in want if first[w[0]] == w[1]}
