import collections
import hashlib
import random
import re
import string

import numpy as np
from llm_frames import SF, docs, plain, read

from warcloom.llm import secrets as S
from warcloom.llm import url_filter as U
from warcloom.llm.queries import QUERIES, URL_RULES


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = []
    for decision, rule in URL_RULES:
        domain, below = rule.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + below):
            fits.append((len(rule), rule, decision))
    return max(fits)[1:] if fits else (None, None)


URLS = ["http://EXAMPLE.net/en/x", "https://a.b.example.net/en/", "http://example.net", "x.net/", None, "", "http://fr.org/fr/", "ftp://É.ORG/fr/?q#f",
        "http://notexample.com/de/", "http://example.com/de/a?b=c&d=e#g", "://net/", "http://a.net?x=/en/", "http://h\nost.net/a", "http://" + "9" * 5000 + ".com/"]


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u, "clash", 1, "h") for i, u in enumerate(URLS * 2)], "page_id long, url string, label string, labels int, host string")
    rows = U.verdicts(pages, URL_RULES).collect()
    assert len(rows) == len(URLS) * 2
    for r in rows:
        host, path = split_url(r.url)
        rule, decision = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (decision or r.verdict) and r.verdict in ("block", "allow")
    assert U.verdicts(pages.limit(0), URL_RULES).count() == 0


def test_learned_verdicts_on_held_out_urls(spark):
    draw = random.Random(3)
    rows = []
    for i in range(400):
        bad = i % 2
        host = f"site{draw.randint(0, 30)}.example.{'biz' if draw.random() < (0.8 if bad else 0.2) else 'com'}"
        tail = "".join(draw.choice("0123456789") for _ in range(20)) if bad else "news/" + draw.choice(["a", "b"])
        rows.append((f"http://{host}/{tail}{'?a=1&b=2' if bad else ''}", bad))
    model = U.fit(spark.createDataFrame(rows[:300], "url string, label int"))
    held = U.lexical(spark.createDataFrame(rows[300:], "url string, label int"))
    got = model.probability(held).select("label", "block_probability").collect()
    assert sum((r.block_probability >= 0.5) == bool(r.label) for r in got) >= 97


def test_entropy(spark):
    row = spark.createDataFrame([("aabb",), ("aaaa",), ("",), (None,)], "url string")
    assert [round(r.entropy, 6) for r in U.lexical(row).collect()] == [1.0, 0.0, 0.0, 0.0]


def test_url_query(spark):
    rows = {r.page_id: r for r in QUERIES["op6_url_filter"](spark, SF).collect()}
    for p in read(spark, "pages").collect():
        host, path = split_url(p.url)
        rule, decision = rule_of(host, path)
        r = rows[p.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and (decision is None or r.verdict == decision)
    plan = U.verdicts(read(spark, "pages").select("page_id", "url"), URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def base(text):
    out = []
    for m in re.finditer(r"""(?:(?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], S.KINDS.index(s[0])))


SECRETS = ["Token = 'abcdef' token: abc", "API_KEY=\"x/y+z==\" apikey:ABCDEFG password : secret=abcdef1", "AKIA" + "A" * 16 + " AKIAA", "tokentoken=abcdefg",
           "é😀 secret=" + "a1" * 20, "f" * 24 + "g" + "0" * 23, None, "", "a" * 100_000, "x1" * 40_000, "passwd=" + "p" * 50_000, "ſecret=abcdefgh toKen=abcdefgh"]


def test_base_findings(spark):
    rows = list(enumerate(SECRETS)) + [(0, SECRETS[0])]
    for r in S.scan(docs(spark, rows), None).collect():
        assert [(s.kind, s.start, s.stop) for s in r.base] == base(r.text or "") and not r.added


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    model = S.CharCnn.fresh(rng, 3, 3, 4, 5)
    contexts, bodies, y = rng.integers(0, 98, (6, S.BEFORE + S.AFTER)), rng.integers(0, 98, (6, S.BODY)), np.array([0, 1, 1, 0, 1, 0.0])

    def loss():
        p = 1 / (1 + np.exp(-model.raw(contexts, bodies)))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = model.gradients(contexts, bodies, y)
    for name, g in grads.items():
        flat = model.weights[name].reshape(-1)
        for at in rng.integers(0, flat.size, 5):
            kept, step = flat[at], 1e-6
            flat[at] = kept + step
            up = loss()
            flat[at] = kept - step
            down = loss()
            flat[at] = kept
            assert abs((up - down) / (2 * step) - g.reshape(-1)[at]) < 1e-5, name


def test_learned_secrets_on_held_out_findings(spark):
    draw = random.Random(9)

    def key(n, letters):
        return "".join(draw.choice(letters) for _ in range(n))

    rows = []
    for i in range(600):
        words = " ".join(key(draw.randint(3, 14), string.ascii_lowercase) for _ in range(20))
        kind = i % 3
        if kind == 0:
            rows.append((i, f"{words} token = {key(32, string.ascii_letters + string.digits)} end"))
        elif kind == 1:
            rows.append((i, f"{words} see chapter_{draw.randint(1, 99)}_of_the_handbook and {words}"))
        else:
            rows.append((i, words))
    model = S.fit(plain(spark, rows))
    hits = misses = wrong = 0
    for _ in range(100):
        text = f"we use bearer {key(32, string.ascii_letters + string.digits)} today"
        ok = model.judge(text, S.candidates(text))[0] >= model.threshold
        hits, misses = hits + ok, misses + (not ok)
        text = f"see section_{draw.randint(1, 99)}_of_the_handbook"
        wrong += model.judge(text, S.candidates(text))[0] >= model.threshold
    assert hits >= 90 and wrong <= 5, (hits, wrong)
    assert S.fit(plain(spark, [])) is None and S.scan(plain(spark, []), None).count() == 0


def test_secret_query(spark):
    texts = {r.doc_id: r.text or "" for r in read(spark, "documents").collect()}
    for r in QUERIES["op7_secret_scan"](spark, SF).collect():
        want = base(texts[r.doc_id])
        counts = collections.Counter(s[0] for s in want)
        listed = ",".join("%s:%d:%d" % s for s in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(counts[k] for k in S.KINDS)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("learned")] == [s for s in listed.split(",") if s]
