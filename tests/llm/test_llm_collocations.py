import re
from collections import Counter

import numpy as np
import pytest
from llm_frames import SF, read
from oracle_check import compare, connect

from warcloom.llm import catalogue
from warcloom.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, threshold, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= threshold}
    dropped = set()
    for (lang, w), longer in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if 100 * longer >= 80 * cand[lang, w[i:i + k]]:
                    dropped.add((lang, w[i:i + k]))
    found = {}
    for (lang, w), a in cand.items():
        if (lang, w) not in dropped:
            score, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -s)
        for lang, rows in found.items() for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def run(df, **options):
    return sorted(tuple(r) for r in C.collocations(df, **options).collect())


def test_table_equals_sql(spark):
    assert compare(spark, connect(SF), SF, catalogue.QUERIES["op11_phrase_collocations"], catalogue.ORACLES["op11_phrase_collocations"]) is None


def test_table_equals_brute_force(spark):
    df = read(spark, "documents")
    rows = [(r.text, r.lang) for r in df.select("text", "lang").collect()]
    want = brute(rows, 12, 50)
    assert len(want) > 50
    assert run(df, threshold=12, top=50) == want


AWKWARD = [
    (None, "en"), ("", "en"), (" \t .,; ", None), ("Red Fox\tred  fox; red fox", None), ("red fox red fox", "und"), ("a b c d e", "en"),
    ("a b c d e", "en"), ("A B\x0bC D.a b c d", "en"), ("ÄÖ x y ÄÖ x y", "de"), ("same same same same same same", "de"),
    ("a b c d e", "en"), ("one", "fr"), ("x\x00y z x\x00y z x\x00y z", "fr"), ("nul \U0001f600 nul \U0001f600 nul \U0001f600", ""),
]


def test_awkward_rows(spark):
    df = spark.createDataFrame(
        [(i, t, lang, 1, 2.0, "q", 3) for i, (t, lang) in enumerate(AWKWARD)], "doc_id long, text string, lang string, f int, n double, phrase string, words int")
    for threshold in (2, 3):
        want = brute(AWKWARD, threshold, 2000)
        assert want and run(df, threshold=threshold) == want


def test_long_text_is_cut_between_pieces_only(spark, monkeypatch):
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(["ab ", "cd ", "ef ", "gh ", ". "], 30_000).tolist())
    parts = list(C._parts(text.encode()))
    assert b"".join(parts) == text.encode()
    monkeypatch.setattr(C, "BLOCK_BYTES", 200)
    parts = list(C._parts(text.encode()))
    assert len(parts) > 100 and b"".join(parts) == text.encode() and all(p.endswith(b".") for p in parts[:-1])
    monkeypatch.undo()
    no_break = "kl mn " * 200_000
    df = spark.createDataFrame([(text, "en"), (no_break, "en")], "text string, lang string")
    assert run(df, threshold=1000) == brute([(text, "en"), (no_break, "en")], 1000, 2000)


def test_empty_table(spark):
    assert run(spark.createDataFrame([], "text string, lang string")) == []


@pytest.mark.parametrize("capacity", [1, 40, 400])
def test_summary_keeps_every_frequent_item(capacity):
    rng = np.random.default_rng(capacity)
    threshold = 30
    summary, exact = C.Summary(capacity, threshold), Counter()
    for _ in range(60):
        items = np.concatenate([rng.integers(0, 40, 30), rng.integers(100, 10**6, 200)])
        keys, counts = np.unique(items, return_counts=True)
        exact.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        summary.add(keys.astype(np.uint64), counts.astype(np.int64))
    found = set(summary.survivors().tolist())
    assert summary.error < threshold
    assert {k for k, f in exact.items() if f >= threshold} <= found
    if sum(exact.values()) / threshold < capacity:
        assert summary.error > 0 or len(exact) <= capacity


def test_phrases_with_one_hash_are_counted_apart(monkeypatch):
    """All words share the first hash; the second tells them apart."""
    block = C._read([(b"p q p r q p", "en")], 2)
    counter = C._Counter()
    for _ in range(2):
        counter.add(block, 1, np.arange(6), np.zeros(6, np.uint64), block.hashes[1])
    got = Counter()
    for batch in counter.rows():
        for row in batch.to_pylist():
            got[row["phrase"]] += row["f"]
    assert got == {"p": 6, "q": 4, "r": 2}


def everywhere(spark, parts, phrases):
    """Each phrase once in each of ``parts`` partitions, in a text of its own."""
    text = ". ".join(f"a{j} b{j} c{j}" for j in range(phrases))
    rows = [(f"{i}x. {text}. y{i}", "en") for i in range(parts)]
    return rows, spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), "text string, lang string")


def test_a_phrase_is_not_sent_by_every_task(spark, monkeypatch, tmp_path):
    """Rows with a phrase's words are as many as there are phrases, not phrases times tasks."""
    made = str(tmp_path / "made")
    frame = type(spark.range(0))
    plain = frame.mapInArrow

    def counted(self, fn, schema, *args, **options):
        def run(batches):
            for batch in fn(batches):
                if "phrase" in batch.schema.names:
                    with open(made, "a") as out:
                        out.write("".join(f"{n}\n" for n in batch.column("words").to_pylist() if n > 1))
                yield batch

        return plain(self, run, schema, *args, **options)

    monkeypatch.setattr(frame, "mapInArrow", counted)
    rows, df = everywhere(spark, 16, 40)
    found = Counter((r.phrase, r.f) for r in C.phrase_counts(df, 16)[0].collect())
    assert found == Counter((w, 16) for j in range(40) for w in (f"a{j}", f"b{j}", f"c{j}", f"a{j} b{j}", f"b{j} c{j}", f"a{j} b{j} c{j}"))
    with open(made) as lines:
        assert 120 <= len(lines.readlines()) < 2 * 120


@pytest.mark.parametrize("names", [1, 3, 64])
def test_phrases_with_one_name_are_counted_by_their_words(spark, monkeypatch, names):
    """All n-grams share a few 64-bit names; counts are exact nevertheless."""
    frame = type(spark.range(0))
    plain = frame.mapInArrow

    def few(self, fn, schema, *args, **options):
        def run(batches):
            from warcloom.llm import collocations

            kept = collocations._grams

            def grams(block, n, family=0):
                name = kept(block, n, family)
                return name if family else collocations.mix64(name % np.uint64(names))

            collocations._grams = grams
            try:
                yield from fn(batches)
            finally:
                collocations._grams = kept

        return plain(self, run, schema, *args, **options)

    monkeypatch.setattr(frame, "mapInArrow", few)
    rows, df = everywhere(spark, 4, 6)
    rows += [("a0 b0 c0 a1 b1", "de"), ("a0 b0 c0. a0 b0", "de"), ("c0 b0 a0", "en")]
    df = df.union(spark.createDataFrame(rows[4:], "text string, lang string"))
    for threshold in (2, 4):
        want = brute(rows, threshold, 2000)
        assert want and run(df, threshold=threshold) == want


def test_false_positives_of_the_filters_are_dropped(spark):
    """Bitmaps of 64 bits let nearly everything pass; infrequent phrases stay out, frequent ones stay exact."""
    rows, df = everywhere(spark, 4, 30)
    rows += [(f"r{i} s{i} t{i} a0", "en") for i in range(50)]
    df = df.union(spark.createDataFrame(rows[4:], "text string, lang string"))
    want = Counter()
    for text, _ in rows:
        for piece in text.split("."):
            words = piece.split()
            want.update(" ".join(words[i:i + n]) for n in range(1, 5) for i in range(len(words) - n + 1))
    assert {r.phrase: r.f for r in C.phrase_counts(df, 4, filter_bits=6)[0].collect()} == {p: f for p, f in want.items() if f >= 4}
