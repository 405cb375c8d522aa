import collections

from llm_frames import SF, read
from test_llm_decontaminate import D
from test_llm_ngram_join import brute
from test_llm_packing import check
from test_llm_pii import base

import corpus_pipeline
from warcloom.llm import toxicity


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage on all that its predecessor kept."""
    docs = read(spark, "documents")
    kept = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        kept[name] = (before, docs)
        if number < 4:
            assert docs.columns == read(spark, "documents").columns

    before, after = kept["toxicity"]
    model = toxicity.fit(before, read(spark, "labels"))
    scores = {r.doc_id: r.predicted for r in toxicity.score(before, model).collect()}
    assert {r.doc_id for r in after.collect()} == {d for d, p in scores.items() if not p}

    before, after = kept["ngram_jaccard_join"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert {r.doc_id for r in after.collect()} == {int(c) for _, n, c in brute(rows) if n} | {int(d) for d, n, _ in brute(rows) if not n}

    before, after = kept["benchmark_decontamination"]
    items = [D.plain_form(r.text) for r in read(spark, "benchmark").collect()]
    gone = {r.doc_id: D.plain_form(r.text) for r in before.collect()}
    for r in after.collect():
        del gone[r.doc_id]
        assert not any(x in D.plain_form(r.text) for x in items)
    assert all(any(seg in t for x in items for seg in D.segments_of(x, 120)) for t in gone.values())

    before, after = kept["pii"]
    clean = {r.doc_id: r for r in after.collect()}
    assert len(clean) == before.count()
    for r in before.collect():
        if base(r.text or ""):
            assert not base(clean[r.doc_id].text) and "[" in clean[r.doc_id].text
        assert clean[r.doc_id].n_chars == len(clean[r.doc_id].text)

    before, after = kept["best_fit_packing"]
    used, least = check(after.collect(), [(r.doc_id, r.text) for r in before.collect()])
    assert used <= least + 2


def test_run_equals_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and not [k for k, n in collections.Counter((r.doc_id, r.piece) for r in rows).items() if n > 1]
