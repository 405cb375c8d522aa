import random
import re

from llm_frames import SF, docs, plain, read

from warcloom.llm import decontaminate as D
from warcloom.llm.queries import QUERIES


def distance_in(segment, text):
    """Least edits between the segment and any part of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(segment, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def sentence(draw, words):
    return " ".join("".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 9))) for _ in range(words))


def test_every_region_within_the_budget_is_found():
    draw = random.Random(7)
    for _ in range(60):
        item = sentence(draw, 16)
        index = D.build_index([(1, item)], 0.06, 120)
        passage = list(item)
        for _ in range(draw.randint(0, 9)):
            at = draw.randrange(len(passage))
            kind = draw.random()
            if kind < 0.4:
                passage[at] = draw.choice("xyz")
            elif kind < 0.7:
                del passage[at]
            else:
                passage.insert(at, draw.choice("qkw"))
        text = sentence(draw, 10) + " " + "".join(passage) + " " + sentence(draw, 10)
        plain_text = D.plain_form(text)
        want = {s for s, segment in enumerate(index.texts) if distance_in(segment, plain_text) <= index.edits[s]}
        assert {s for _, s, *_ in D.scan(index, ["other text", text, None])} == want


def test_query_finds_whole_items(spark):
    texts = {r.doc_id: D.plain_form(r.text) for r in read(spark, "documents").collect()}
    items = {r.item_id: D.plain_form(r.text) for r in read(spark, "benchmark").collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if x and x in t}
    rows = QUERIES["op10_benchmark_decontamination"](spark, SF).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    assert exact <= found
    for r in rows:
        assert distance_in(D.segments_of(items[r.item_id], 120)[0][:40], texts[r.doc_id]) <= 8 or r.segments >= 1


def test_noise_case_and_parts(spark):
    item = "The quick brown fox jumps over the lazy dog while seventeen purple elephants dance around the silver fountain at midnight in spring"
    noisy = re.sub(" ", "%%% ", item.upper())
    half = " ".join(item.split()[:12])
    rows = [(1, "intro " + item), (2, noisy), (3, half + " and then something else altogether follows here"), (4, "quick brown fox"), (5, None), (6, ""),
            (7, "x" * 300_000 + " " + item), (1, "intro " + item)]
    bench = spark.createDataFrame([(1, item, 0.1), (1, item, 0.2), (2, None, 0.1), (3, "", 0.1), (4, "short", 0.1)], "item_id long, text string, score double")
    got = sorted((r.doc_id, r.item_id) for r in D.leaks(docs(spark, rows), bench).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (7, 1)]
    kept = D.drop_leaked(docs(spark, rows), bench)
    assert kept.columns == docs(spark, []).columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 6]


def test_blocks_and_empty_tables(spark):
    draw = random.Random(1)
    items = [(i, sentence(draw, 20)) for i in range(30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, "before " + t + " after") for i, t in items]
    one = {(r.doc_id, r.item_id) for r in D.leaks(plain(spark, rows), bench).collect()}
    many = {(r.doc_id, r.item_id) for r in D.leaks(plain(spark, rows), bench, block_chars=500).collect()}
    assert one == many == {(i, i) for i in range(30)}
    assert D.leaks(plain(spark, rows), bench.limit(0)).count() == 0 and D.leaks(plain(spark, []), bench).count() == 0
    assert D.drop_leaked(plain(spark, rows), bench.limit(0)).count() == 30


def test_part_of_an_item_is_found_wherever_it_begins():
    draw = random.Random(5)
    for words in (12, 30, 55):
        item = D.plain_form(sentence(draw, words))
        index = D.build_index([(1, item)], 0.06, 120)
        length = D.windows_of(item)[0] + D.STEP - 1
        texts = [f"{sentence(draw, 8)} {item[at:at + length]} {sentence(draw, 8)}" for at in range(len(item) - length + 1)]
        assert {t for t, *_ in D.scan(index, texts)} == set(range(len(texts)))
    # One edit in the middle of a part, and the ends of the item missing.
    part = item[20:110]
    noisy = part[:45] + "%q" + part[46:]
    assert {t for t, *_ in D.scan(index, [noisy, sentence(draw, 40)])} == {0}


def test_part_that_no_segment_fits_leaks(spark):
    draw = random.Random(11)
    items = [(i, sentence(draw, 22)) for i in range(20)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, f"before {' '.join(t.split()[3:-3])} after") for i, t in items]
    assert {(r.doc_id, r.item_id) for r in D.leaks(plain(spark, rows), bench).collect()} == {(i, i) for i, _ in items}
    assert D.drop_leaked(plain(spark, rows), bench).count() == 0
