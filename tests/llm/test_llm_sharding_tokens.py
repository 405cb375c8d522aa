import collections
import random
import zlib

import numpy as np
import public_tokenizers
from llm_frames import SF, docs, plain, read
from tokenizers import Tokenizer

from warcloom.llm import sharding
from warcloom.llm.queries import QUERIES
from warcloom.llm.token_counts import TokenCounter, with_token_counts

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_permutation_is_uniform():
    seen = collections.Counter(tuple(sharding._fisher_yates(4, seed, 0)) for seed in range(4800))
    assert len(seen) == 24 and min(seen.values()) > 120
    assert list(sharding._fisher_yates(0, 1, 1)) == [] and list(sharding._fisher_yates(1, 1, 1)) == [0]


def slots(rows, shards):
    by_shard = collections.defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values()) and set(by_shard) <= set(range(shards))
    sizes = [len(by_shard[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_query_law(spark):
    texts = {r.doc_id: (r.text or "").encode() for r in read(spark, "documents").collect()}
    rows = QUERIES["op8_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots(rows, 8)
    assert all(r["size"] == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) and r.law == "rows" and r.grown_shard is None for r in rows)


def test_shuffle_is_seeded_and_whole(spark):
    rows = [(i, f"text {i}" * (i % 50)) for i in range(500)] + [(7, "same")] * 30 + [(None, None)] * 5 + [(8, ""), (9, "y" * 200_000)]
    one = sharding.external_shuffle(docs(spark, rows), bucket_bytes=5000).collect()
    two = sharding.external_shuffle(docs(spark, rows).repartition(5), bucket_bytes=5000).collect()
    other = sharding.external_shuffle(docs(spark, rows), seed=3, bucket_bytes=5000).collect()
    assert sorted(r.position for r in one) == list(range(len(rows)))
    order = [[(r.doc_id, r.text) for r in sorted(x, key=lambda r: r.position)] for x in (one, two, other)]
    assert order[0] == order[1] != order[2] and collections.Counter(order[0]) == collections.Counter(rows)
    slots(sharding.deal(sharding.external_shuffle(docs(spark, rows), bucket_bytes=5000), 3).collect(), 3)
    assert sharding.external_shuffle(plain(spark, [])).count() == 0


def test_written_shards_read_back(spark, tmp_path):
    rows = [(i, f"t{i}") for i in range(100)]
    dealt = sharding.deal(sharding.external_shuffle(plain(spark, rows), bucket_bytes=100), 4)
    sharding.write_shards(dealt, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.text) for r in back.collect()) == rows
    slots(back.collect(), 4)


ODD = ["", None, "  a", "a  ", "  ", "\n\n a", "don't", "I'll've 're 'r 'rx 've' 'l 'll", "''s 's's", "a<|endoftext|>b <|endoftext|>", "日本語 テスト", "😀😀 hi",
       "\t\t\tx\n\ny", "\n's", "1'2 '3 ' ''", "é'té", "'" * 20, "' s", "a" * 5000, "ab" * 4000 + " " + "x1" * 2000, "<|endoftext|><|endoftext|>  x",
       "12½²Ⅷx", "क्षि", " " * 3000 + "x", "x" + "\n" * 3000, "!?" * 3000]


def test_counts_equal_the_library():
    library, own = Tokenizer.from_file(BYTES), TokenCounter(BYTES)
    draw = random.Random(3)
    letters = list("abcdeorstlmv'' \n\t  12.,!?-é日😀́RSΣ")
    texts = ODD + ["".join(draw.choice(letters) for _ in range(60)) for _ in range(1500)]
    assert own.count(texts) == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_counts_when_states_run_out(monkeypatch):
    from warcloom.llm import token_counts
    monkeypatch.setattr(token_counts, "MAX_STATES", 200)
    monkeypatch.setattr(token_counts, "TABLE_STATES", 50)
    library, own = Tokenizer.from_file(BYTES), TokenCounter(BYTES)
    texts = ["tokenization of unbelievably long constructions", "x1" * 3000, "the end " * 400]
    assert own.count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_state_maps_equal_plain_run():
    own = TokenCounter(BYTES).splitter
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 12, (40, 30)).astype(np.uint8)
    maps = own._maps(symbols)
    for c in range(30):
        for s in range(13):
            state = s
            for x in symbols[:, c]:
                state = own.GOES[state, x]
            assert maps[c, s] == state


def test_token_query(spark):
    library = Tokenizer.from_file(BYTES)
    texts = {r.doc_id: r.text or "" for r in read(spark, "documents").collect()}
    rows = QUERIES["op9_token_counts"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)


def test_awkward_rows(spark):
    got = with_token_counts(docs(spark, [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c")]), BYTES).collect()
    assert sorted(r.n_tokens for r in got) == [0, 0, 1, 2, 2] and all(r.base == "x" for r in got)
    assert with_token_counts(plain(spark, []), BYTES).count() == 0
