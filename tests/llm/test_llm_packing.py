import collections
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from llm_frames import SF, docs, read
from tokenizers import Tokenizer

from warcloom.llm import packing
from warcloom.llm.queries import QUERIES
from warcloom.llm.word_bpe import WordBpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_fullest_equals_all_subsets():
    draw = random.Random(1)
    for _ in range(200):
        lengths = [draw.randint(1, 20) for _ in range(draw.randint(0, 8))]
        room = draw.randint(0, 40)
        best = max(sum(c) for n in range(len(lengths) + 1) for c in itertools.combinations(lengths, n) if sum(c) <= room)
        got = packing.fullest(dict(collections.Counter(lengths)), room)
        assert sum(got) == best and not collections.Counter(got) - collections.Counter(lengths)


def test_plan_uses_every_piece_once():
    draw = random.Random(2)
    pieces = collections.Counter(draw.randint(1, 64) for _ in range(3000))
    used, bins = collections.Counter(), 0
    for combination, times in packing.plan(pieces, 64):
        assert sum(combination) <= 64
        bins += times
        for length in combination:
            used[length] += times
    assert used == pieces and bins <= 1.02 * sum(k * v for k, v in pieces.items()) / 64


def test_ids_equal_the_library():
    library, own = Tokenizer.from_file(PATH), WordBpe(PATH)
    texts = ["", "İstanbul ΣΑΣ", "a<|endoftext|>b <|", "étude café", "x y\u0085z\x1c q", "²³ 1/2 ½", "don't I'LL 's we've", "日本語 テスト",
             "ŉ ſ ß ÿ Ÿ ŀ", "😀😀 hi", "a​b", "x" * 5000]
    draw = random.Random(4)
    letters = [chr(c) for c in range(0x180)] + ["'s", " ", "\n"]
    texts += ["".join(draw.choice(letters) for _ in range(40)) for _ in range(500)]
    for text in texts:
        assert own.encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text[:40]


def check(rows, texts):
    library = Tokenizer.from_file(PATH)
    by_doc, bins = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    want = collections.defaultdict(list)
    for i, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        want[i] += [(p, s, len(ids[s:s + 2048]), zlib.crc32(np.array(ids[s:s + 2048], "<u4").tobytes())) for p, s in enumerate(range(0, len(ids), 2048))]
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    return len(bins), -(-total // 2048)


def test_query_equals_brute_force(spark):
    texts = [(r.doc_id, r.text) for r in read(spark, "documents").collect()]
    used, least = check(QUERIES["op4_best_fit_packing"](spark, SF).collect(), texts)
    assert used <= least + 2


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "word " * 9000), (4, "a b"), (4, "a b"), (None, "c")]
    check(packing.pack(docs(spark, rows), PATH).collect(), rows)
    got = packing.pack(docs(spark, rows), PATH, keep=["doc_id", "score", "base"], with_ids=True).collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and r.base == "x" for r in got)
    assert packing.pack(docs(spark, []), PATH).count() == 0
