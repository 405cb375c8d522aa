import collections
import hashlib
import re

from llm_frames import SF, docs, plain, read

from warcloom.llm import pii
from warcloom.llm.queries import QUERIES


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


ODD = [
    "a@b.c@d.e x@y", "a@b.c_x@d.e", "..@..a.b %@a.b.c.", "é😀 me@mail.example.com 😀 1.2.3.4", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.03.4 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111", "4111  1111 1111 1111", "+1 (222) 333-4444 +12 +1((((((((2 ++123456789",
    "1 " * 5000, "1" * 20_000, "a" * 50_000 + "@x.y", "@" * 1000, "+1" + " 2" * 4000, "a.b" * 3000, "", None, "x@y.z" * 500,
    "0 0 0 0 0 0 0 0 0 0 0 0 0", "1.2.3.04444444444444444444", "1.2.3.4+5 000 000 00",
]


def test_base_spans_equal_patterns(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(99, ODD[0])]
    for r in pii.find(plain(spark, rows)).collect():
        assert [(s.kind, s.start, s.stop) for s in r.base] == base(r.text or ""), (r.text or "")[:60]


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in read(spark, "documents").collect()}
    rows = QUERIES["op3_pii"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id] or "")
        listed = ",".join("%s:%d:%d" % s for s in want)
        counts = collections.Counter(s[0] for s in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and r.spans.startswith(listed)


def test_disclosing_terms_are_added(spark):
    fill = ["alpha beta gamma", "delta epsilon zeta", "eta theta iota", "kappa lambda omicron"]
    rows = [(i, f"{fill[i]} Zebulon writes from zeb@mail.example.com about {fill[3 - i]}") for i in range(4)]
    rows += [(10 + i, "alpha beta writes from about gamma delta " + str(i)) for i in range(40)]
    found = {r.doc_id: r for r in pii.find(plain(spark, rows)).collect()}
    text = rows[0][1]
    assert [text[s.start:s.stop] for s in found[0].added] == ["Zebulon"]
    assert not found[10].added
    clean = {r.doc_id: r.text for r in pii.sanitise(plain(spark, rows)).collect()}
    assert clean[0] == "alpha beta gamma [TERM] writes from [EMAIL] about kappa lambda omicron" and clean[10] == rows[4][1]
    removed = {r.doc_id: r.text for r in pii.sanitise(plain(spark, rows), "remove").collect()}
    assert removed[0] == "alpha beta gamma  writes from [EMAIL] about kappa lambda omicron"


def test_awkward_tables(spark):
    wide = docs(spark, [(1, None), (2, ""), (3, "a@b.c"), (3, "a@b.c"), (None, "1.1.1.1")])
    got = pii.sanitise(wide).collect()
    assert sorted(str(r.text) for r in got) == ["", "None", "[EMAIL]", "[EMAIL]", "[IP]"] and got[0].label == 1 and got[0].base == "x"
    assert pii.find(plain(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = pii.find(plain(spark, [(1, "a@b.c")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_terms_of_rare_entities_are_added_at_any_distance(spark):
    fill = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omicron"
    one = f"Zebulon {fill} one@mail.example.com"
    two = [f"{fill} Quillon {n} {fill} +1 222 333 4444" for n in ("alpha", "beta")]
    rows = [(1, one), (2, two[0]), (3, two[1]), (4, two[1])] + [(10 + i, f"{fill} {i}") for i in range(60)]
    found = {r.doc_id: [r.text[s.start:s.stop] for s in r.added] for r in pii.find(plain(spark, rows)).collect()}
    assert found[1] == ["Zebulon"] and found[2] == found[3] == found[4] == ["Quillon"] and not found[10]
    # Copies are documents too, and change neither side of the comparison alone.
    copied = {r.doc_id: len(r.added) for r in pii.find(plain(spark, rows + [(5, one), (6, one)])).collect()}
    assert copied[1] == copied[5] == copied[6] == 1


def test_pairs_equal_brute_force(spark):
    texts = [r.text for r in read(spark, "documents").select("text").collect() if r.text]
    frame = plain(spark, list(enumerate(texts)))
    got = {(r.entity, r.term) for r in pii.disclosing_terms(frame, frame.withColumn("base", pii.base_spans(frame["text"])).where("size(base) > 0")).collect()}
    words = [{w for w in re.findall(r"[^\W\d_]+", t.lower()) if len(w) >= 3} for t in texts]
    holders = collections.defaultdict(set)
    for i, t in enumerate(texts):
        for _, start, stop in base(t):
            holders[t[start:stop]].add(i)
    counts = collections.Counter(w for ws in words for w in ws)
    want = set()
    for entity, held in holders.items():
        for w in set().union(*(words[i] for i in held)):
            both = [i for i in held if w in words[i]]
            share = both and len(both) * len(texts) / (counts[w] * len(held))
            enough = len({texts[i] for i in both}) >= min(3, len({texts[i] for i in held}))
            if enough and len(held) < len(texts) and share >= (len(texts) / len(held)) ** 0.9 * (1 - 1e-12):
                want.add((entity, w))
    assert got == want and want


def test_terms_carry_a_number_for_their_text(spark, monkeypatch):
    from pyspark.sql import functions as F

    from warcloom.llm import pii

    kept = []
    monkeypatch.setattr(pii, "cut_lineage", lambda df, cut=pii.cut_lineage: kept.append(df.columns) or cut(df))
    rows = spark.createDataFrame([(1, "mail a@b.cd of Zebedee here"), (2, "other words here")], "doc_id long, text string")
    held = rows.withColumn("base", pii.base_spans(F.col("text"))).where(F.size("base") > 0)
    found = {(r.entity, r.term) for r in pii.disclosing_terms(rows, held).collect()}
    assert ("a@b.cd", "zebedee") in found and ("a@b.cd", "here") not in found
    assert ["_key", "text", "most", "_id"] in kept
