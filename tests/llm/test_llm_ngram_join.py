import random
import re
from collections import defaultdict

import pytest
from llm_frames import SF, docs, plain, read

from warcloom.llm import ngram_join as J
from warcloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) >= 5:
        return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    return frozenset([tuple(words)]) if words else frozenset()


def brute(rows):
    """[(id, size, component)] by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            index[x].append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in index[x] if j < i}:
            common = len(s & sets[j])
            if 100 * common >= 80 * (len(s) + len(sets[j]) - common):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((str(doc), len(sets[i]), str(least.get(find(i)))) for i, (doc, _) in enumerate(rows))


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in J.near_duplicate_components(df).collect())


def variants(seed, families, size, edits):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    passage = [draw.choice(vocabulary) for _ in range(30)]
    for _ in range(families):
        words = [draw.choice(vocabulary) for _ in range(draw.randint(3, 120))] + (passage if draw.random() < 0.5 else [])
        for _ in range(draw.randint(1, size)):
            copy = list(words)
            for _ in range(draw.randint(0, edits)):
                copy[draw.randrange(len(copy))] = f"e{draw.randrange(10 ** 6)}"
            if draw.random() < 0.3:
                copy = copy[:len(copy) - draw.randint(0, 6)] or copy
            rows.append((n, " ".join(copy)))
            n += 1
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,families,size,edits", [(1, 60, 5, 3), (2, 6, 70, 4), (3, 200, 2, 2)])
def test_random_families_equal_brute_force(spark, seed, families, size, edits):
    rows = variants(seed, families, size, edits)
    assert got(plain(spark, rows)) == brute(rows)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, "documents").collect()]
    found = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in QUERIES["op5_ngram_jaccard_join"](spark, SF).collect())
    assert found == brute(rows)


def test_awkward_rows(spark):
    long = " ".join(f"z{i}" for i in range(60_000))
    rows = [(9, None), (8, ""), (7, " \t\n"), (6, "A b"), (5, "a B"), (4, "a b c"), (3, long), (2, long + " end"), (1, "p q r s t u"), (1, "p q r s t u"),
            (None, "p q r s t u"), (None, "alone in the whole wide world"), (11, "é b"), (12, "É b")]
    assert got(docs(spark, rows)) == brute(rows)
    assert got(plain(spark, [])) == []
    assert got(plain(spark, [(1, "a"), (2, None)])) == [("1", 1, "1"), ("2", 0, "2")]


def test_one_per_component(spark):
    rows = [(3, "a b c d e f"), (1, "A B C D E F"), (1, "A B C D E F"), (2, "x y"), (None, "x y"), (4, None), (4, None), (5, "")]
    kept = J.one_per_component(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns
    assert sorted((r.doc_id, str(r.text)) for r in kept.collect()) == [
        (1, "A B C D E F"), (2, "x y"), (4, "None"), (4, "None"), (5, "")]


def test_members_of_a_family_that_cannot_link_make_no_pairs(spark):
    # 40 sets of 146 shingles, 20 of their own each: n - a = 16, so the first common shingle may lie no later.
    rows = [((40, 1, 2), g, 146, 20, g, 1) for g in range(40)]
    # Two that may link, by two lists of 6 and 4 shingles; and one pair with too few of them.
    rows += [((2, 5, 6), g, 146, 16, g, 6) for g in (50, 51)] + [((2, 7, 8), g, 146, 18, g, 4) for g in (50, 51)]
    rows += [((2, 9, 9), g, 146, 16, g, 9) for g in (60, 61)]
    left = spark.createDataFrame(rows, "same struct<held:long,h0:long,h1:long>, grp long, n long, pos long, label long, weight long")
    met = J._met(left)
    assert sorted((r.g, r.h) for r in met.collect()) == [(50, 51), (60, 61)]
    assert [(r.g, r.h) for r in J._sharing(met.distinct(), left).collect()] == [(50, 51)]
